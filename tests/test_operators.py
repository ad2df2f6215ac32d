import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkgauge.operators import aggregates as A
from sparkgauge.operators import detect as D
from sparkgauge.operators import expand as E
from sparkgauge.operators import graph as G
from sparkgauge.operators import joins as J
from sparkgauge.operators import predicates as P
from sparkgauge.operators import series as T
from sparkgauge.operators import windows as W
from sparkgauge.sources import sinks as K

DAY0 = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- filters -------------------------------------------------------------------------------


def test_long_pattern_lists_equal_short_ones(spark, monkeypatch):
    rng = random.Random(3)
    names = ["".join(rng.choice("ab_%.") for _ in range(6)) for _ in range(300)]
    patterns = ["".join(rng.choice("ab_%\\_.") for _ in range(4)) for _ in range(40)]
    patterns = [p for p in patterns if not p.replace("\\_", "").endswith("\\") and "\\" not in p.replace("\\_", "").replace("\\%", "")]
    data = spark.createDataFrame([(n,) for n in names], "name string")
    inc = spark.createDataFrame([(p,) for p in patterns[:20]], "pattern string")
    exc = spark.createDataFrame([(p,) for p in patterns[20:]], "pattern string")
    want = rows(data.filter(P.like_lists(F.col("name"), patterns[:20], patterns[20:])), "name")
    assert rows(P.include_exclude(data, "name", inc, exc), "name") == want


def test_empty_lists(spark):
    data = spark.createDataFrame([("a",)], "name string")
    none = spark.createDataFrame([], "pattern string")
    every = spark.createDataFrame([("%",)], "pattern string")
    assert P.include_exclude(data, "name", none, none).count() == 0
    assert P.include_exclude(data, "name", every, none).count() == 1


def test_time_bound_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kept = P.since_last_run(events, "ts", dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 20), hours=1000)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in plan(kept)
    assert P.since_last_run(events, "ts", dt.datetime(2024, 1, 31), None, hours=24).count() < kept.count()


def test_three_valued_noise_filter(spark):
    data = spark.createDataFrame([(None, "v", "LOG"), ("app", None, "LOG"), ("app", "v", None), ("app", "v", "LOG"), ("SELF_OTLP", "v", "LOG")], "s string, v string, r string")
    none = F.lit(None).cast("string")
    kept = data.filter(
        P.event_log_noise(scope=F.col("s"), value=F.col("v"), record_type=F.col("r"), database=none, severity=none, application=none, own_scope=r"SELF(_\S*)?_OTLP", family="SELF%\\_DB")
    )
    assert rows(kept, "s") == [("app", "v", "LOG")]


# --- joins ---------------------------------------------------------------------------------


def monitors(spark):
    m = spark.createDataFrame([("M1", "WAREHOUSE"), ("ACC", "ACCOUNT"), ("M2", "WAREHOUSE")], "name string, level string")
    w = spark.createDataFrame([("A", "M1"), ("B", None), ("C", "null"), ("D", "GONE"), ("E", "ACC")], "name string, resource_monitor string")
    return m, w


def test_monitor_join_without_nested_loop(spark):
    m, w = monitors(spark)
    joined = J.monitor_to_warehouses(m, w)
    got = {r["name"]: r["warehouses"] for r in joined.collect()}
    assert got == {"M1": ["A"], "ACC": ["B", "C", "E"], "M2": [], None: ["D"]}
    for text in (plan(joined), plan(J.warehouse_to_monitor(w, m, ["level"]))):
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_object_access_without_double_explode(spark):
    obj = "array<struct<name:string,domain:string>>"
    data = spark.createDataFrame(
        [("q1", [("D.S.T", "Table"), ("D.S.T", "Table"), ("E.S.V", "View")], [("F.S.W", "View")]), ("q2", [("D.S.T", "Table")], []), ("q3", None, [("x", "View")])],
        f"query_id string, base_objects {obj}, direct_objects {obj}",
    )
    out = E.flatten_pair_distinct(data)
    assert rows(out, "query_id") == [("q1", ["D.S.T"], ["E.S.V", "F.S.W"], ["D", "E", "F"])]
    assert "Generate" not in plan(out)


def test_flags_with_null_and_unknown_parents(spark):
    data = spark.createDataFrame([("a", None), ("b", "a"), ("c", "zz"), ("d", "b")], "id string, parent string")
    assert rows(J.parent_flags(data, "id", "parent"), "id") == [("a", None, True, True), ("b", "a", True, False), ("c", "zz", False, True), ("d", "b", False, False)]


def test_latest_keeps_ties(spark):
    data = spark.createDataFrame([("k", 1, "x"), ("k", 2, "y"), ("k", 2, "z"), ("l", 5, "w")], "k string, ts int, v string")
    assert rows(J.latest_per_key(data, "k", "ts").select("k", "v"), "k", "v") == [("k", "y"), ("k", "z"), ("l", "w")]


def test_closure_over_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "b")], "parent string, child string")
    roles = spark.createDataFrame([("a",), ("x",)], "name string")
    got = {(p, ch): d for p, ch, d in G.role_closure(edges, roles.limit(1)).filter("depth > 0").collect()}
    assert got == {("a", "b"): 1, ("a", "c"): 2, ("a", "a"): 3, ("a", "d"): 3, ("b", "c"): 1, ("b", "a"): 2, ("b", "d"): 2, ("b", "b"): 3, ("c", "a"): 1, ("c", "d"): 1, ("c", "b"): 2, ("c", "c"): 3}
    assert G.role_closure(edges.limit(0), roles).count() == 2


def test_only_role_grants_are_followed(spark):
    grants = spark.createDataFrame(
        [("a", "USAGE", "ROLE", "b"), ("b", "SELECT", "TABLE", "t"), ("t", "SELECT", "TABLE", "never")], "parent string, privilege string, granted_on string, child string"
    )
    roles = spark.createDataFrame([("a",)], "name string")
    got = {(r["parent"], r["child"], r["depth"]) for r in G.privilege_closure(grants, roles).collect()}
    assert got == {("a", "b", 1), ("b", "t", 1), ("a", "t", 2), ("t", "never", 1), ("a", "a", 0)}


def test_span_tree_inherits_trace(spark):
    data = spark.createDataFrame(
        [("r", None, "t1"), ("m", "r", "x"), ("l", "m", "y"), ("o", "missing", "t2"), ("c1", "c2", "z"), ("c2", "c1", "z")], "id string, parent string, trace string"
    )
    got = {r["span_id"]: (r["trace_id"], r["level"], r["kind"]) for r in G.span_tree(data, "id", "parent", "trace").collect()}
    assert got == {
        "r": ("t1", 0, "SERVER"), "m": ("t1", 1, "INTERNAL"), "l": ("t1", 2, "INTERNAL"), "o": ("t2", 0, "SERVER"),
        "c1": ("z", 0, "SERVER"), "c2": ("z", 0, "SERVER"),
    }
    assert {r["span_id"] for r in G.span_tree(data, "id", "parent", "trace").filter("cyclic").collect()} == {"c1", "c2"}
    assert G.span_tree(data.limit(0), "id", "parent", "trace").count() == 0


def test_deep_chain_takes_few_steps(spark, monkeypatch):
    steps = []
    cut = G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: steps.append(1) or cut(df))
    n = 1000
    data = spark.createDataFrame([(i, i - 1 if i else None, f"t{i}") for i in range(n)] + [(n, n + 1, "x"), (n + 1, n, "y"), (n + 2, n, "z")], "id int, parent int, trace string")
    got = {r["span_id"]: r for r in G.span_tree(data, "id", "parent", "trace").collect()}
    assert len(got) == n + 3 and len(steps) <= 13
    assert all(got[i]["level"] == i and got[i]["root_id"] == 0 and got[i]["trace_id"] == "t0" for i in range(n))
    assert all(got[i]["cyclic"] and got[i]["root_id"] == i for i in range(n, n + 3))


# --- aggregates and windows ----------------------------------------------------------------


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_percentile_in_bins(spark, p):
    rng = random.Random(5)
    data = [("hot", rng.choice([1, 1, 1, 7, 1000, rng.randint(0, 5000)])) for _ in range(3000)] + [("one", 4), ("two", 1), ("two", 2), (None, 9), ("same", 3), ("same", 3), ("gap", None)]
    df = spark.createDataFrame(data, "k string, v int")
    want = {}
    for k in {k for k, _ in data}:
        values = [v for kk, v in data if kk == k and v is not None]
        if values:
            want[k] = float(np.percentile(values, 100 * p))
    got = {r["k"]: r["x"] for r in A.exact_percentile(df, ["k"], "v", p, "x").collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("p", [0.0, 0.01, 0.5, 0.95, 0.9995, 1.0])
def test_percentile_of_long_tails(spark, p):
    # Groups of distinct values with one outlier; nearly all would fall in one bin of equal width.
    sizes = [1, 2, 3, 9, 21, 1001, 60_000]
    df = spark.createDataFrame([(n,) for n in sizes], "k int").select("k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
    df = df.select("k", F.when(F.col("i") == F.col("k") - 1, F.lit(1e15)).otherwise(F.col("i") * 1.5).alias("v"))
    got = {r["k"]: r["x"] for r in A.exact_percentile(df, ["k"], "v", p, "x").collect()}
    assert got == pytest.approx({n: float(np.percentile([i * 1.5 for i in range(n - 1)] + [1e15], 100 * p)) for n in sizes})


def test_ranks_and_lags_split_by_bin(spark):
    rng = random.Random(7)
    data = [(rng.choice("aab"), DAY0 + dt.timedelta(hours=rng.randint(0, 200)), i) for i in range(400)]
    df = spark.createDataFrame(data, "k string, ts timestamp, id int")
    ranked = {r["id"]: r["position"] for r in W.ranked_in_order(df, ["k"], ["ts", "id"], F.date_trunc("day", "ts")).collect()}
    before = {r["id"]: r["previous"] for r in W.previous_in_order(df, ["k"], "ts", ["ts", "id"], F.date_trunc("day", "ts")).collect()}
    for k in "ab":
        ordered = sorted([(ts, i) for kk, ts, i in data if kk == k])
        for n, (ts, i) in enumerate(ordered, 1):
            assert ranked[i] == n
            assert before[i] == (ordered[n - 2][0] if n > 1 else None)


def test_unpaired_start_has_no_finish(spark):
    data = [("w", DAY0, "S", 1), ("w", DAY0 + dt.timedelta(hours=1), "F", 2), ("w", DAY0 + dt.timedelta(days=2), "S", 3), ("v", DAY0, "F", 4)]
    df = spark.createDataFrame(data, "k string, ts timestamp, e string, id int")
    out = E.zip_in_order(df, ["k"], F.when(F.col("e") == "S", F.col("ts")), F.when(F.col("e") == "F", F.col("ts")), ["ts", "id"], F.date_trunc("day", "ts"))
    assert rows(out.select("k", "position", "finish_at"), "position") == [("w", 1, DAY0 + dt.timedelta(hours=1)), ("w", 2, None)]


def test_first_of_duplicates_is_deterministic(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, None), ("k", 1, "a")], "k string, o int, v string")
    assert A.dedup(df, ["k"], ["o", "v"]).first()["v"] is None
    assert df.groupBy("k").agg(A.take_last(F.col("v"), "o").alias("v")).first()["v"] == "b"
    assert A.listagg_distinct(df, ["k"], "v", "x", distinct=False).first()["x"] == "a,b"


def test_object_agg_takes_last_of_duplicates(spark):
    df = spark.createDataFrame([("k", "m", 1, 1), ("k", "m", 2, 2), ("k", "n", None, 3)], "k string, name string, v int, o int")
    assert A.object_agg(df, ["k"], "name", "v", ["o"], "x").first()["x"] == {"m": 2}


def test_top_n_keeps_one_less(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, m int")
    assert [r["id"] for r in W.top_n_slowest(df, "m", 4, "id").collect()] == [2, 5, 8]
    assert W.top_n_slowest(df, "m", 1, "id").count() == 0


# --- series and detection ------------------------------------------------------------------


def test_gaps_are_filled_per_series(spark):
    df = spark.createDataFrame([("a", DAY0), ("a", DAY0 + dt.timedelta(days=3)), ("b", DAY0 + dt.timedelta(days=1)), (None, DAY0)], "k string, ts timestamp")
    got = rows(T.make_timeseries(df, "ts", ["k"], step_s=T.DAY, n=F.count("*")), F.col("k").asc_nulls_first(), "bin")
    assert [(k, b.day, n) for k, b, n in got] == [
        (None, 1, 1), (None, 2, None), (None, 3, None), (None, 4, None), ("a", 1, 1), ("a", 2, None), ("a", 3, None), ("a", 4, 1), ("b", 1, None), ("b", 2, 1), ("b", 3, None), ("b", 4, None),
    ]
    assert T.make_timeseries(df.limit(0), "ts", ["k"], step_s=T.DAY, n=F.count("*")).count() == 0
    padded = T.make_timeseries(df.filter("k = 'b'"), "ts", step_s=T.DAY, start=DAY0, end=DAY0 + dt.timedelta(days=2), default=0, n=F.count("*"))
    assert [r["n"] for r in padded.orderBy("bin").collect()] == [0, 1]


def test_series_range_is_half_open(spark):
    df = spark.createDataFrame([("a", DAY0 + dt.timedelta(days=i)) for i in range(5)], "k string, ts timestamp")
    day = lambda i: DAY0 + dt.timedelta(days=i)
    got = T.make_timeseries(df, "ts", ["k"], step_s=T.DAY, start=day(1), end=day(3), n=F.count("*"))
    assert [(r["bin"].day, r["n"]) for r in got.orderBy("bin").collect()] == [(2, 1), (3, 1)]
    got = T.make_timeseries(df, "ts", ["k"], step_s=T.DAY, start=day(2), n=F.count("*"))
    assert [(r["bin"].day, r["n"]) for r in got.orderBy("bin").collect()] == [(3, 1), (4, 1), (5, 1)]


def test_series_window_is_bounded_by_bins(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") % 5 * 86400).alias("ts"))
    text = plan(T.make_timeseries(df, "ts", ["k"], step_s=T.DAY, start=DAY0, end=DAY0 + dt.timedelta(days=5), n=F.count("*")))
    assert text.rindex("Window") < text.rindex("HashAggregate")


def brute_alerts(flags, window, violating, dealerting):
    out, on, start = [], False, None
    for i in range(len(flags)):
        if sum(flags[max(0, i - window + 1) : i + 1]) >= violating:
            state = True
        elif i + 1 >= dealerting and sum(flags[i - dealerting + 1 : i + 1]) == 0:
            state = False
        else:
            state = on
        if state and not on:
            start = i
        if on and not state:
            out.append((start, i - 1, False))
        on = state
    return out + ([(start, len(flags) - 1, True)] if on else [])


def test_alert_windows_against_brute_force(spark):
    rng = random.Random(11)
    series = {f"k{i}": [rng.random() < 0.35 for _ in range(60)] for i in range(8)}
    data = [(k, DAY0 + dt.timedelta(days=i), v) for k, flags in series.items() for i, v in enumerate(flags)]
    df = spark.createDataFrame(data, "k string, bin timestamp, violation boolean")
    for window, violating, dealerting in ((5, 3, 5), (3, 2, 3), (1, 1, 1)):
        got = {}
        for r in D.alert_windows(df, ["k"], window, violating, dealerting).collect():
            got.setdefault(r["k"], []).append(((r["start_at"] - DAY0).days, (r["end_at"] - DAY0).days, r["is_open"]))
        assert {k: sorted(v) for k, v in got.items()} == {k: a for k, flags in series.items() if (a := brute_alerts(flags, window, violating, dealerting))}


def test_forecast_of_a_line(spark):
    data = [("up", DAY0 + dt.timedelta(days=i), 10.0 * i) for i in range(5)] + [("short", DAY0, 1.0), ("short", DAY0 + dt.timedelta(days=1), 2.0)]
    df = spark.createDataFrame(data, "k string, bin timestamp, v double")
    out = D.forecast_quota(df, ["k"], "v", now=DAY0 + dt.timedelta(days=5), horizon=8)
    up = {r["day"]: r for r in out.filter("k = 'up'").collect()}
    assert up[1]["point"] == pytest.approx(50) and up[8]["upper"] == pytest.approx(120) and up[8]["lower"] == pytest.approx(120)
    assert {(r["quality"], r["point"]) for r in out.filter("k = 'short'").collect()} == {("NO_DATA", None)}
    alerts = D.exhaustion_alerts(out, ["k"], 100.0).collect()
    assert [(r["k"], r["day_of_crossing"]) for r in alerts] == [("up", 7)]


def test_missing_bins_violate_only_when_asked(spark):
    df = spark.createDataFrame([("k", DAY0 + dt.timedelta(days=i), v) for i, v in enumerate([1.0, 1.0, 1.0, None, 9.0])], "k string, bin timestamp, v double")
    for missing, want in ((False, [False, False, False, False, True]), (True, [False, False, False, True, True])):
        out = D.adaptive_anomaly(df, ["k"], "v", train_from=DAY0, train_to=DAY0 + dt.timedelta(days=3), missing=missing)
        assert [r["violation"] for r in out.orderBy("bin").collect()] == want


# --- sinks ---------------------------------------------------------------------------------


def test_batches_against_brute_force(spark):
    rng = random.Random(13)
    data = [(rng.choice("ab"), i, rng.randint(1, 60)) for i in range(500) if i != 250] + [("b", 250, 5000), ("a", 999, 5000)]
    df = spark.createDataFrame(data, "lane string, i int, size bigint")
    got = {r["i"]: r["batch_no"] for r in K.pack_batches(df, ["lane"], ["i"], "size", max_bytes=200, max_count=6).collect()}
    want = {}
    for lane in "ab":
        batch, used, held = 0, 0, 0
        for _, i, size in sorted((r for r in data if r[0] == lane), key=lambda r: r[1]):
            if held and (used + size > 200 or held >= 6):
                batch, used, held = batch + 1, 0, 0
            used, held = used + size, held + 1
            want[i] = batch
    assert got == want
    lanes = {i: lane for lane, i, _ in data}
    for i in (250, 999):
        assert [j for j in got if lanes[j] == lanes[i] and got[j] == got[i]] == [i]


def test_monitor_warning_depends_on_account_level(spark):
    from sparkgauge.plans.collectors.warehouses import monitor_warnings

    some = spark.createDataFrame([("a", "WAREHOUSE"), ("b", None)], "name string, level string")
    assert monitor_warnings(some).count() == 1
    assert monitor_warnings(some.limit(0)).count() == 1
    assert monitor_warnings(some.union(spark.createDataFrame([("c", "ACCOUNT")], some.schema))).count() == 0


def test_rename_members_joins_by_name(spark):
    from sparkgauge.sources.readers import rename_members, renames

    names = renames(spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "c"), (None, "z"), ("d", None)], "old string, new string"))
    members = spark.createDataFrame(
        [(1, "a", "1"), (1, "b", "2"), (2, "a", "3"), (2, "x", "4"), (3, "c", "5"), (3, "d", None)], "id int, key string, value string"
    )
    found = {(r.id, r.key, r.value) for r in rename_members(members, names, ["id"]).collect()}
    assert found == {(1, "x", "1"), (2, "x", "4"), (3, "c", "5"), (3, "d", None)}


def test_cut_properties_are_marked(spark):
    from sparkgauge.sources.sinks import truncated_events

    rows = spark.sql("SELECT 1 AS id, map('a', 'abcdef', 'b', 'ab', 'c', '{}') AS properties")
    row = truncated_events(rows, max_chars=4).first()
    assert row.properties == {"a": "abcd", "b": "ab"} and row.cut_properties == {"a": 6}


# --- whole lists, groups, batches and chains -------------------------------------------------


def test_patterns_of_wildcards_and_escapes(spark):
    names = ["", "a", "ab", "abc", "a_b", "a%b", "x.y.z", "日本語", None]
    lists = [["%"], ["__", "%y%", ""], ["a\\_b", "a\\%%"], ["%本_", "_%_", None], []]
    data = spark.createDataFrame([(n,) for n in names], "name string")
    none = spark.createDataFrame([], "pattern string")
    for patterns in lists:
        inc = spark.createDataFrame([(p,) for p in patterns], "pattern string")
        known = [p for p in patterns if p is not None]
        want = rows(data.filter(P.like_lists(F.col("name"), known)), "name")
        assert rows(P.include_exclude(data, "name", inc, none), "name") == want, patterns
        every = spark.createDataFrame([("%",)], "pattern string")
        gone = rows(data.filter(P.like_lists(F.col("name"), ["%"], known)), "name")
        assert rows(P.include_exclude(data, "name", every, inc), "name") == gone, patterns


def test_leading_wildcards_meet_few_names(spark):
    names = spark.range(2000).select(F.concat(F.lit("DB.SCHEMA_"), F.col("id") % 7, F.lit(".T"), F.col("id")).alias("_name"))
    patterns = spark.range(2000).select(F.concat(F.lit("%.T1"), F.col("id")).alias("_like"), F.lit(True).alias("_in"))
    found = P.like_any(names, patterns)
    assert {r[0].rpartition(".T")[2] for r in found.select("_name").collect()} == {str(i) for i in range(2000) if str(i)[0] == "1" and len(str(i)) > 1 and not (str(i)[1] == "0" and len(str(i)) > 2)}
    assert not any(x in plan(found) for x in ("CartesianProduct", "NestedLoop"))


def test_patterns_meet_only_names_that_hold_their_whole_texts(spark, monkeypatch):
    met = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(name, like):
        met.add(1)
        return re.fullmatch(like.replace("\\_", "\0").replace("%", ".*").replace("\0", "_"), name) is not None

    n = 2000
    names = spark.range(n).select(F.concat(F.lit("DB"), F.col("id") % 7, F.lit(".LONG_NAME_"), F.col("id"), F.lit(".PART_"), F.col("id") % 10).alias("_name"))
    flagged = [(f"DB{i % 7}.LONG\\_NAME\\_{i}.PART\\_{i % 10}", False) for i in range(n)]
    flagged += [(f"DB{i}.%\\_{j}", True) for i in range(7) for j in range(20)] + [(f"%NAME\\_{i}.%", True) for i in range(0, n, 2)]
    monkeypatch.setattr(P.F, "like", counted)
    got = [tuple(r) for r in P.like_any(names, spark.createDataFrame(flagged, "_like string, _in boolean")).collect()]
    listed = [f"DB{i % 7}.LONG_NAME_{i}.PART_{i % 10}" for i in range(n)]
    assert sorted(got) == sorted([(x, False) for x in listed] + [(x, True) for x in listed] + [(x, True) for x in listed[::2]])
    # Names equal to a pattern are not verified; of the others, each pair met is a match.
    assert met.value == n + n // 2


def test_long_texts_escapes_and_ends_overlapping(spark):
    names = ["abcabc", "abc", "abcd", "a%c", "a_b.c", "a\\b", "ab\nc", "xabcdefy", "abcdef", "日本語日本", "日本"]
    likes = ["abc%abc", "abc%c", "a\\%c", "a\\_b_c", "a\\\\%", "%\\\\b", "ab\nc", "ab%c", "%bcdef%", "x%cde%y", "%abcdef_", "日本%日本", "%本語_%", "a_c%", "%%c_", "abc"]
    data = spark.createDataFrame([(n,) for n in names], "_name string")
    wanted = spark.createDataFrame([(p, i % 2 == 0) for i, p in enumerate(likes)], "_like string, _in boolean")
    want = data.crossJoin(wanted).filter(F.like("_name", F.col("_like"))).select("_name", "_in").distinct()
    assert rows(P.like_any(data, wanted).distinct(), "_name", "_in") == rows(want, "_name", "_in")


def test_batches_are_plain_filters(spark, monkeypatch):
    rng = random.Random(11)
    times = [None, DAY0, DAY0 + dt.timedelta(microseconds=1), *(DAY0 + dt.timedelta(seconds=rng.randint(0, 10**6)) for _ in range(300)), DAY0 + dt.timedelta(days=9999)]
    data = [(rng.choice(times[:3] + times), i) for i in range(1500)]
    df = spark.createDataFrame(data, "ts timestamp, id long").repartition(5)
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or DAY0, r[1]))
    for few in (3, 50, 10_000):
        monkeypatch.setattr(W, "SORTED_ROWS", few)
        monkeypatch.setattr(W, "PARTS", 16)
        for n in (1, 2, 400, 1499):
            part = W.batch_limit_oldest(df, "ts", "id", n)
            assert {r["id"] for r in part.collect()} == {i for _, i in ordered[:n]}
            assert "Limit" not in plan(part) and "Sort" not in plan(part)
        after = ordered[600]
        assert {r["id"] for r in W.batch_limit_oldest(df, "ts", "id", 77, after).collect()} == {i for _, i in ordered[601:678]}
        assert W.batch_limit_oldest(df, "ts", "id", 1500).count() == 1500


@pytest.mark.parametrize("p", [0.0, 0.3, 0.95, 1.0])
def test_percentile_narrows_large_groups(spark, monkeypatch, p):
    monkeypatch.setattr(A, "ORDERED_VALUES", 40)
    rng = random.Random(13)
    data = [("ties", rng.choice([1.0, 1.0, 1.0, 2.0, 5.5])) for _ in range(3000)] + [("tail", 1.5 ** rng.randint(0, 80)) for _ in range(3000)]
    data += [("small", float(i)) for i in range(7)] + [("same", 4.0)] * 500 + [(None, float(rng.randint(-9, 9))) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, v double")
    want = {k: float(np.percentile([v for kk, v in data if kk == k], 100 * p)) for k in {k for k, _ in data}}
    assert {r["k"]: r["x"] for r in A.exact_percentile(df, ["k"], "v", p, "x").collect()} == pytest.approx(want)


def test_percentile_between_two_frequent_values(spark, monkeypatch):
    # The lower rank is the last of the ones, the upper rank the first of the twos.
    monkeypatch.setattr(A, "ORDERED_VALUES", 40)
    large = 2**60 + 100
    df = spark.createDataFrame([(k, v) for k, low in (("a", 1), ("b", large)) for v in [low] * 100 + [low + 1] * 100], "k string, v long")
    got = {r["k"]: r["x"] for r in A.exact_percentile(df, ["k"], "v", 0.5, "x").collect()}
    assert got == {"a": 1.5, "b": float(large)}


def test_percentile_with_a_sketch_that_is_off(spark, monkeypatch):
    monkeypatch.setattr(A, "ORDERED_VALUES", 40)
    monkeypatch.setattr(A, "SKETCH_ACCURACY", 3)
    values = [float(i * i % 7919) for i in range(4000)]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    for p in (0.1, 0.5, 0.95):
        assert A.exact_percentile(df, ["k"], "v", p, "x").first()["x"] == pytest.approx(float(np.percentile(values, 100 * p)))


def test_deep_chains_take_few_steps(spark, monkeypatch):
    steps = []
    cut = G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: steps.append(1) or cut(df))
    n = 1000
    chain = spark.range(n).selectExpr("'r' || id AS parent", "'r' || (id + 1) AS child")
    got = G.role_closure(chain)
    assert got.count() == n * (n + 1) // 2 and len(steps) <= 12
    assert got.filter("CAST(substr(child, 2) AS INT) - CAST(substr(parent, 2) AS INT) <> depth").count() == 0
    m = 60
    ring = spark.range(m).selectExpr("'c' || id AS parent", f"'c' || ((id + 1) % {m}) AS child")
    got = G.role_closure(ring)
    assert got.count() == m * m and got.agg(F.max("depth")).first()[0] == m
