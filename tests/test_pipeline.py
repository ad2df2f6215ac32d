"""Fan-out counts, state over several runs, streams with late rows and replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkgauge.functions import sections as S
from sparkgauge.operators.fanout import fan_out
from sparkgauge.operators import state as ST
from sparkgauge.plans.collectors import custom, queries, tables, warehouses
from sparkgauge.plans.collectors.spec import RowSpec, instrument
from sparkgauge.session import fresh_path, shared_dir
from sparkgauge.sources import readers as R
from sparkgauge.streaming import jobs as SJ

NOW = dt.datetime(2024, 1, 31)


NO_SPANS = {"spans": 0, "span_events": 0, "errors": 0}


def kinds(out):
    return {r["kind"]: r["n"] for r in out.counts().collect()}


def test_data_volume_counts(spark):
    """Two tables, one without a schema change: 7 metrics and 3 events, no logs."""
    rows = spark.createDataFrame(
        [("D", "S", "A", "BASE TABLE", 5, 10, NOW, NOW, None), ("D", "S", "B", "BASE TABLE", 5, 10, NOW, None, None), ("D", "S", "V", "VIEW", 1, 1, NOW, NOW, None), ("D", "S", "X", "BASE TABLE", 1, 1, NOW, NOW, NOW)],
        "table_catalog string, table_schema string, table_name string, table_type string, row_count bigint, bytes bigint, last_altered timestamp, last_ddl timestamp, deleted timestamp",
    )
    out = tables.data_volume(rows, NOW, ["D.%"]).withColumn("id", F.col("dimensions")["db.collection.name"])
    assert kinds(fan_out(out, "id", report_logs=False)) == {"entries": 2, "log_lines": 0, "metrics": 7, "events": 3} | NO_SPANS
    assert kinds(fan_out(out, "id", report_metrics=False, report_timestamp_events=False)) == {"entries": 2, "log_lines": 2, "metrics": 0, "events": 0} | NO_SPANS


def test_event_usage_counts(spark):
    from sparkgauge.plans.collectors.events import event_usage

    rows = spark.createDataFrame([(NOW, NOW, 1.5, 10), (NOW, NOW, 0.5, 20)], "start_time timestamp, end_time timestamp, credits_used double, bytes_ingested bigint")
    out = event_usage(rows, NOW + dt.timedelta(hours=1), None).withColumn("id", F.monotonically_increasing_id())
    assert kinds(fan_out(out, "id")) == {"entries": 2, "log_lines": 2, "metrics": 4, "events": 0} | NO_SPANS


def test_failed_rows_become_events(spark):
    spec = RowSpec(message="'m'", dimensions={"db.user": "u"}, attributes={"error.code": "e"}, timestamp="ts")
    rows = instrument(spark.createDataFrame([("a", None, NOW), ("b", "X1", NOW)], "u string, e string, ts timestamp"), spec, ["u"])
    out = fan_out(rows, "u", event_column="error.code")
    assert kinds(out) == {"entries": 2, "log_lines": 1, "metrics": 0, "events": 1} | NO_SPANS
    assert out.events.first()["u"] == "b"
    assert kinds(fan_out(rows, "u", event_column="error.code", event_value="x2")) == {"entries": 2, "log_lines": 2, "metrics": 0, "events": 0} | NO_SPANS


def test_events_before_the_mark_are_not_repeated(spark):
    rows = spark.range(1).select(
        "id", F.lit("m").alias("message"), F.lit(0).cast("bigint").alias("start_time"), F.create_map().cast(S.TEXT_MAP).alias("dimensions"),
        F.create_map().cast(S.TEXT_MAP).alias("attributes"), F.create_map().cast(S.NUMBER_MAP).alias("metrics"),
        F.create_map(F.lit("old"), F.lit(5).cast("bigint"), F.lit("new"), F.lit(10).cast("bigint")).alias("event_timestamps"),
    )
    out = fan_out(rows, "id", report_logs=False, mark_ns=10)
    assert [r["trigger"] for r in out.timestamp_events.collect()] == ["new"]
    assert kinds(fan_out(rows, "id", report_logs=False, mark_ns=11)) == {"entries": 0, "log_lines": 0, "metrics": 0, "events": 0} | NO_SPANS


def test_absent_source_columns_are_absent_members(spark):
    rows = spark.createDataFrame([("W", 1)], "warehouse_name string, credits_used bigint").withColumn("start_time", F.lit(NOW)).withColumn("end_time", F.lit(NOW))
    out = instrument(rows, warehouses.WAREHOUSE_METERING).first()
    assert out["dimensions"] == {"platform.warehouse.name": "W"} and out["attributes"] == {} and out["metrics"] == {"platform.credits.used": 1.0}


def test_active_query_times(spark):
    cols = "query_id string, session_id int, execution_status string, start_time timestamp, end_time timestamp, total_elapsed_time bigint, execution_time bigint, rows_written_to_result bigint"
    running = spark.createDataFrame([("r", 1, "RUNNING", NOW - dt.timedelta(seconds=5), None, 7, 7, 1), ("f", 1, "RUNNING", NOW + dt.timedelta(seconds=5), None, 7, 7, 1), ("q", 1, "QUEUED", NOW, None, 7, 7, 1)], cols)
    finished = spark.createDataFrame([("d", 1, "SUCCESS", NOW, NOW, 7, -1, 1), ("o", 1, "SUCCESS", NOW, NOW - dt.timedelta(hours=3), 7, 7, 1)], cols)
    extra = {n: F.lit(None).cast("string") for n in ("database_name",)}
    out = queries.active_queries(running.withColumns(extra), finished.withColumns(extra), NOW, mark=NOW, fast_mode=False)
    got = {r["query_id"]: r["metrics"] for r in out.collect()}
    p = "platform."
    assert got == {
        "r": {p + "time.running": 5000.0}, "f": {p + "time.running": 0.0}, "q": {p + "rows.written_to_result": 1.0}, "d": {p + "time.total_elapsed": 7.0, p + "rows.written_to_result": 1.0},
    }
    fast = queries.active_queries(running.withColumns(extra), finished.withColumns(extra), NOW, mark=NOW, statuses=["RUNNING"])
    assert sorted(r["query_id"] for r in fast.collect()) == ["f", "r"]


# --- state ---------------------------------------------------------------------------------


def test_cache_over_two_runs_and_a_replay(spark):
    def history(*rows):
        return spark.createDataFrame(rows, "query_id string, start_time timestamp")

    at = lambda h: NOW + dt.timedelta(hours=h)
    empty = spark.createDataFrame([], ST.CACHE_SCHEMA)
    log = history(("new", at(-1)), ("stale", at(-3)))
    path = fresh_path(spark, "cache")
    ST.append_version(ST.update_processed(empty, log, log, NOW), path, 1)
    first = ST.read_version(spark, path, 1)
    assert [r["query_id"] for r in first.collect()] == ["new"]
    ST.append_version(ST.update_processed(first, log, log, NOW), path, 2)
    assert ST.read_version(spark, path, 2).collect() == first.collect()
    later = ST.update_processed(first, history(("late", at(3)), ("new", at(-1))), history(("late", at(3)), ("new", at(-1))), at(4))
    assert [r["query_id"] for r in later.collect()] == ["late"]


def test_snapshot_reports_changes_and_daily_full(spark):
    seen = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    now = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (1, "b")], "id int, v string")
    assert sorted(ST.snapshot_diff(now, seen, NOW, NOW).collect()) == [(1, "b"), (3, "c")]
    assert ST.snapshot_diff(now, seen, NOW - dt.timedelta(days=1), NOW).count() == 4


def test_mark_is_epoch_without_runs(spark):
    log = spark.createDataFrame([("a", NOW, 1), ("a", NOW, 2)], "source string, last_timestamp timestamp, last_id bigint")
    assert ST.high_water_mark(log, "a") == NOW
    assert ST.high_water_mark(log, "b") == dt.datetime(1970, 1, 1)
    assert [tuple(r) for r in ST.high_water_marks(log).collect()] == [("a", NOW, 2)]


def test_email_map_is_kept_or_emptied(spark):
    known = spark.createDataFrame([("a@x", "old")], "email string, email_hash string")
    snap = spark.createDataFrame([("a@x",), ("b@x",), (None,)], "email string")
    assert sorted(r["email"] for r in ST.email_hash_map(known, snap, True).collect()) == ["a@x", "b@x"]
    assert ST.email_hash_map(known, snap, False).count() == 0


def test_source_string():
    assert ST.parse_source("pipes:a, b") == ("pipes", ["a", "b"])
    assert ST.parse_source("pipes") == ("pipes", [])


# --- sources -------------------------------------------------------------------------------


def test_objects_structured_and_flat(spark):
    objects = [{"TIMESTAMP": 5, "_MESSAGE": "hi", "DIMENSIONS": {"a": "b"}, "METRICS": '{"m": 1}', "EVENT_TIMESTAMPS": {"t": 9}}, {"_message": "low", "DIMENSIONS": None}]
    rows = R.instrumented_from_json(R.read_source(spark, objects)).withColumn("id", F.monotonically_increasing_id())
    assert kinds(custom.structured_source(rows, "id", custom.Switches())) == {"entries": 2, "log_lines": 2, "metrics": 1, "events": 1} | NO_SPANS
    flat = R.flat_from_json(R.read_source(spark, {"_message": "m", "x": 1, "none": None})).first()
    assert (flat["message"], flat["flat"]) == ("m", {"x": "1"})
    quiet = custom.Switches(auto_mode=False, logs=False)
    assert custom.flat_source(rows.withColumn("flat", F.col("dimensions")), "id", quiet, now=F.lit(NOW), run_id="r") == {}


def test_config_values(spark):
    config = spark.createDataFrame([("a.n", "5", "int"), ("a.s", "x", "str"), ("a.l", '["p"]', "list"), ("a.b", "TRUE", "bool")], "path string, value string, type string")
    assert [R.config_value(config, p, "d") for p in ("a.n", "a.s", "a.l", "a.b", "a.z")] == [5, "x", ["p"], True, "d"]
    assert R.config_subtree(config, "a").count() == 4


# --- streams -------------------------------------------------------------------------------

SCHEMA = "id int, ts timestamp"


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def event_files(spark):
    """Three files, read one per batch: a late row and a repeat, then a row too late.

    Rows count as too late by the watermark of the batch before, hence the third file.
    """
    folder = fresh_path(spark, "in")
    hour = dt.timedelta(hours=1)
    write(spark, folder, "a", [(1, NOW), (2, NOW + 5 * hour)])
    write(spark, folder, "b", [(3, NOW + 4 * hour), (2, NOW + 5 * hour)])
    write(spark, folder, "c", [(4, NOW - 9 * hour), (5, NOW + 20 * hour)])
    return folder


def stream(spark, folder):
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").option("recursiveFileLookup", "true").parquet(folder)
    )


def test_late_rows_are_dropped_beyond_the_watermark(spark, event_files):
    out = SJ.materialise(SJ.windowed_counts(stream(spark, event_files), "ts", "1 hour", "2 hours"), "w")
    got = {r["window_start"]: r["n"] for r in out.collect()}
    hour = dt.timedelta(hours=1)
    assert got == {NOW: 1, NOW + 4 * hour: 1, NOW + 5 * hour: 2}


def test_ids_pass_once(spark, event_files):
    out = SJ.materialise(SJ.processed_once(stream(spark, event_files), "id", "ts", "4 hours").select("id"), "p")
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3, 5]


def test_stream_restart_writes_nothing_twice(spark, event_files):
    path = fresh_path(spark, "diff")
    for _ in range(2):
        SJ.run_available(SJ.snapshot_diff_stream(stream(spark, event_files), ["id"]), path, path + "-checkpoint")
    assert sorted(r["id"] for r in spark.read.parquet(path).select("id").collect()) == [1, 2, 3, 4, 5]


def test_shared_folder_comes_from_the_session(spark):
    assert fresh_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_runs_read_ties_once_and_repeat_nothing(spark, tmp_path):
    from sparkgauge.plans import runs

    rows = spark.sql(
        "SELECT id, CASE WHEN id < 3 THEN NULL ELSE timestamp_seconds(id DIV 5) END AS at, id * 1000 AS start_time, 'm' AS message,"
        " map('d', 'x') AS dimensions, map('a', 'y') AS attributes, map('n', 1D) AS metrics, map('e', id) AS event_timestamps FROM range(20)"
    )
    path = str(tmp_path / "out")
    context = runs.Context("c", lambda since: rows, "id", "at", batch=7)
    assert runs.run_until_done(spark, path, context, "r", NOW) == 3
    logs = runs.output(spark, path, context, "logs").select("id").collect()
    assert sorted(r[0] for r in logs) == list(range(20))
    assert runs.run_once(spark, path, context, "more", NOW).is_empty
    # What a run wrote before it died is neither read nor kept.
    late = spark.range(20, 22).crossJoin(rows.filter("id = 19").drop("id", "at")).selectExpr("id", "timestamp_seconds(9) AS at", "* EXCEPT (id)")
    grown = runs.Context("c", lambda since: rows.unionByName(late), "id", "at", batch=7)
    runs.start(spark, path, grown, "dies", NOW)
    assert runs.output(spark, path, grown, "logs").count() == 20
    runs.run_once(spark, path, grown, "lives", NOW)
    assert sorted(r[0] for r in runs.output(spark, path, grown, "logs").select("id").collect()) == list(range(22))
    assert runs.status_log(spark, path, grown).agg(F.sum("entries")).first()[0] == 22


def test_spans_without_trace_or_valid_times_are_errors(spark):
    from sparkgauge.operators.fanout import SpanColumns

    rows = spark.createDataFrame(
        [(1, 10, 20, "s1", "t", None), (2, 10, 5, "s2", "t", "s1"), (3, 10, 20, "s3", None, "s1"), (4, 10, None, "s4", "t", "s1"), (5, 10, 20, None, "t", None), (6, None, 20, "s6", "t", "s1"), (7, 10, 10, "s7", "t", "s1")],
        "id int, start_time bigint, end_time bigint, span_id string, trace_id string, parent_span_id string",
    ).selectExpr("*", "'m' AS message", "map('d', 'x') AS dimensions", "map('a', 'y') AS attributes", "map('n', 1D) AS metrics", "map('in', 10L, 'out', 21L) AS event_timestamps")
    out = fan_out(rows, "id", report_logs=False, report_timestamp_events=False, spans=SpanColumns())
    assert kinds(out) == {"entries": 7, "log_lines": 0, "metrics": 7, "events": 0, "spans": 2, "span_events": 2, "errors": 4}
    assert {(r.id, r.kind) for r in out.spans.collect()} == {(1, "SERVER"), (7, "INTERNAL")}
    assert {(r.id, r.event) for r in out.span_events.collect()} == {(1, "in"), (7, "in")}
