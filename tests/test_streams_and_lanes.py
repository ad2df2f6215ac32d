"""Streams that forget by timers and watermarks; packing of long lanes against the greedy rule."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import GroupedData
from pyspark.sql.streaming import DataStreamWriter

from sparkgauge.operators.detect import alert_windows
from sparkgauge.session import fresh_path
from sparkgauge.sources.sinks import pack_batches, pack_long_lanes
from sparkgauge.streaming import jobs as SJ

DAY0 = dt.datetime(2024, 1, 1)


def feed(spark, schema, batches):
    path = fresh_path(spark, "feed")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return SJ.read_stream(spark, path, "*.parquet", spark.createDataFrame([], schema).schema, 1)


def run(stream, name):
    query = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True)
    query = query.option("checkpointLocation", fresh_path(stream.sparkSession, name)).start()
    query.awaitTermination()
    return sorted(map(tuple, stream.sparkSession.table(name).collect()), key=str), query.lastProgress["stateOperators"]


def test_daily_report_and_expired_keys(spark):
    def at(day, hour):
        return DAY0 + dt.timedelta(days=day, hours=hour)

    batches = [
        [(1, "a", at(0, 1)), (1, "a", at(0, 2)), (1, "b", at(0, 3)), (1, "b", at(0, 3)), (2, None, at(0, 1)), (None, "z", at(0, 1))],
        [(1, "a", at(1, 1)), (1, "b", at(1, 2)), (1, "c", at(1, 3)), (2, None, at(1, 2))],
        [(3, "x", at(30, 1))],
        [(1, "c", at(60, 1)), (1, "a", at(60, 2))],
    ]
    stream = SJ.daily_diff_stream(feed(spark, "id int, role string, ts timestamp", batches), ["id"], ["role"], "ts", keep_days=3)
    got, state = run(stream, "daily")
    want = [
        (1, "a", at(0, 1), "full"), (1, "b", at(0, 3), "changed"), (2, None, at(0, 1), "full"), (None, "z", at(0, 1), "full"),
        (1, "a", at(1, 1), "full"), (1, "c", at(1, 3), "changed"), (2, None, at(1, 2), "full"),
        (3, "x", at(30, 1), "full"), (1, "c", at(60, 1), "full"), (1, "a", at(60, 2), "changed"),
    ]
    assert got == sorted(want, key=str)
    assert state[0]["numRowsTotal"] == 1  # only the key of the last day is left


def test_daily_report_of_odd_rows(spark):
    """Two versions at a day's first instant, rows that come twice, a late row of an earlier day, rows without a time, key or version."""
    def at(day, hour):
        return DAY0 + dt.timedelta(days=day, hours=hour)

    batches = [
        [(1, "b", at(1, 1)), (1, "a", at(1, 1)), (1, "b", at(1, 1)), (1, "a", at(1, 2)), (1, "c", at(1, 0)), (1, "x", None), (None, None, None)],
        [(1, "d", at(0, 23)), (1, "d", at(0, 23)), (1, "d", at(1, 3)), (None, None, at(1, 1)), (None, None, at(1, 2)), (None, "a", at(1, 2))],
        [(1, "b", at(2, 1)), (1, "e", at(2, 2)), (1, "e", at(2, 2)), (1, "d", at(2, 3))],
    ]
    stream = SJ.daily_diff_stream(feed(spark, "id int, role string, ts timestamp", batches), ["id"], ["role"], "ts", keep_days=3)
    got, _ = run(stream, "daily_odd")
    want = [
        (1, "c", at(1, 0), "full"), (1, "a", at(1, 1), "changed"), (1, "b", at(1, 1), "changed"), (1, "d", at(0, 23), "changed"),
        (None, None, at(1, 1), "full"), (None, "a", at(1, 2), "changed"), (1, "b", at(2, 1), "full"), (1, "e", at(2, 2), "changed"),
    ]
    assert got == sorted(want, key=str)
    assert stream.columns == ["id", "role", "ts", "report"]


def test_daily_report_does_not_sort_or_join_a_frame_per_key(spark, monkeypatch):
    """Frame operations of each key were most of the job's time; a key's rows in one chunk are taken as they are."""
    taken = {}

    def keep(grouped, step, out, *_):
        taken.update(step=step)
        return spark.createDataFrame([], out)

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", keep)
    SJ.daily_diff_stream(feed(spark, "id int, role string, ts timestamp", [[(1, "a", DAY0)]]), ["id"], ["role"], "ts", keep_days=3)

    def refuse(*_, **__):
        raise AssertionError("an operation on the frame of one key")

    class State:
        exists = hasTimedOut = False

        def update(self, kept):
            self.kept = kept

        def setTimeoutTimestamp(self, at):
            self.at = at

    hour, day = pd.Timedelta(hours=1), (DAY0 - dt.datetime(1970, 1, 1)).days
    rows = pd.DataFrame({"id": [1, 1, 1], "role": ["b", "a", "a"], "ts": [DAY0 + 2 * hour, DAY0 + hour, DAY0 + hour], "_version": ["vb", "va", "va"]})
    with monkeypatch.context() as m:
        for name in ("sort_values", "drop_duplicates"):
            m.setattr(pd.DataFrame, name, refuse)
        m.setattr(pd, "concat", refuse)
        state = State()
        found = list(taken["step"]((1,), iter([rows]), state))
    assert found[0][["role", "report"]].values.tolist() == [["a", "full"], ["b", "changed"]]
    assert state.kept == (day, ["va", "vb"], [day, day]) and state.at == (day + 4) * SJ.DAY_MS

    halves = list(taken["step"]((1,), iter([rows[:2], rows[2:]]), State()))
    assert halves[0][["role", "report"]].values.tolist() == [["a", "full"], ["b", "changed"]]


def test_open_items_appear_when_no_finish_can_come(spark):
    def at(minute):
        return DAY0 + dt.timedelta(minutes=minute)

    starts = [[("a", at(0)), ("b", at(1)), ("c", at(2))], [("d", at(300))], [("e", at(600))]]
    ends = [[("a", at(5))], [("b", at(20)), ("c", at(6)), ("c", at(6))], [(None, at(599)), ("x", at(600))]]
    started = feed(spark, "id string, began timestamp", starts)
    finished = feed(spark, "id string, ended timestamp", ends)
    got, _ = run(SJ.still_open_stream(started, finished, "id", "began", "ended", within="10 minutes", late="1 hour"), "open_items")
    assert got == [("b", at(1)), ("d", at(300))]


def test_runs_to_the_end_do_not_count_the_rows_of_their_state(spark, monkeypatch):
    """Same rows of odd items, among them none, repeated and null keys, with fewer look-ups in the state; settings are as before afterwards."""
    def at(minute):
        return DAY0 + dt.timedelta(minutes=minute)

    starts = [[("a", at(0)), ("a", at(0)), ("b", at(1)), (None, at(1)), ("c", at(2)), ("n", None)], [("d", at(300)), ("a", at(301))], [("e", at(600))]]
    ends = [[("a", at(5)), ("a", at(6)), (None, at(1)), ("b", at(0))], [("c", None), ("d", at(300)), ("d", at(310))], [("x", at(600))]]

    def items():
        started = feed(spark, "id string, began timestamp", starts)
        return SJ.still_open_stream(started, feed(spark, "id string, ended timestamp", ends), "id", "began", "ended", within="10 minutes", late="1 hour")

    def look_ups(query):
        return sum(op["customMetrics"]["rocksdbGetCount"] for p in query.recentProgress for op in p["stateOperators"])

    begun, begin = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **b: begun.append(begin(self, *a, **b)) or begun[-1])
    watched, _ = run(items(), "watched_items")
    key = next(iter(SJ.NO_ROW_COUNT))
    before = spark.conf.get(key, None)
    assert sorted(map(tuple, SJ.materialise(items(), "unwatched").collect()), key=str) == watched == sorted([("a", at(301)), ("b", at(1)), ("c", at(2)), (None, at(1))], key=str)
    assert 0 < look_ups(begun[1]) < 0.8 * look_ups(begun[0])
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("max_bytes,max_count,block_rows", [(50, 4, 1), (50, 4, 10), (50, 1, 3), (0, 3, 5), (10_000, 7, 8), (10_000, 500, 16)])
def test_long_lanes_are_packed_greedily(spark, max_bytes, max_count, block_rows):
    rng = random.Random(max_count * 31 + block_rows)
    rows = [("big", i, rng.choice([0, 1, 7, 20, 49, 50, 51, 400, None])) for i in range(400)]
    rows += [(f"l{n}", i, rng.randrange(60)) for n in range(6) for i in range(n * n)] + [(None, i, 10) for i in range(30)]
    events = spark.createDataFrame(rows, "lane string, id long, size long").repartition(7)
    options = {"max_bytes": max_bytes, "max_count": max_count}
    want = sorted(map(tuple, pack_batches(events, ["lane"], ["id"], "size", **options).collect()), key=str)
    got = sorted(map(tuple, pack_long_lanes(events, ["lane"], ["id"], "size", block_rows=block_rows, **options).collect()), key=str)
    assert got == want


def test_no_events_no_batches(spark):
    events = spark.createDataFrame([], "lane string, id long, size long")
    assert pack_long_lanes(events, ["lane"], ["id"], "size", max_bytes=1, max_count=1).isEmpty()


@pytest.mark.parametrize("missing", [True, False])
def test_alert_stream_equals_alert_windows(spark, missing):
    """Late, missing and repeated samples, silent keys; a last sample far ahead makes all earlier bins due."""
    rng, hours = random.Random(7), 120
    samples = {(k, h): rng.random() < 0.45 for k in ("a", "b", None) for h in range(hours) if rng.random() < 0.75 and not (k == "b" and h > 40)}
    for k in ("a", "b", None):
        samples[(k, 0)] = True

    def at(h):
        return DAY0 + dt.timedelta(hours=h, minutes=rng.randrange(60))

    arrivals = sorted((h + rng.choice([0, 0, 3, 9]), str(k), k, h, v) for (k, h), v in samples.items())
    batches = [[(k, at(h), v) for a, _, k, h, v in arrivals if low <= a < low + 20] for low in range(0, hours + 20, 20)]
    batches[2] += batches[1][:5]
    batches += [[("x", DAY0 + dt.timedelta(hours=hours + 11), False)], [("a", DAY0 + dt.timedelta(hours=3), True)]]
    stream = SJ.alert_stream(
        feed(spark, "k string, t timestamp, violation boolean", batches), ["k"], "t", step_s=3600, window=4, violating=2, dealerting=3, missing=missing, late=dt.timedelta(hours=10)
    )
    got, state = run(stream, f"alerts_{missing}")

    grid = [(k, DAY0 + dt.timedelta(hours=h), samples.get((k, h), missing)) for k in ("a", "b", None) for h in range(hours + 1)]
    want = []
    for r in alert_windows(spark.createDataFrame(grid, "k string, bin timestamp, violation boolean"), ["k"], 4, 2, 3).collect():
        want.append((r["k"], "raised", r["start_at"], None, None, None))
        if not r["is_open"]:
            want.append((r["k"], "closed", r["start_at"], r["end_at"], r["samples"], r["violations"]))
    assert got == sorted(want, key=str) and len(want) > 12
    assert state[0]["numRowsTotal"] == (4 if missing else 1 + sum(1 for k in ("a", "b", None) if any(samples.get((k, h)) for h in range(hours - 3, hours))))
