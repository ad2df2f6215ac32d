"""Inventory 2.10: incremental state and streaming."""

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from sparkgauge.catalog import timeseries as TS
from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import FRAMES
from sparkgauge.catalog.sourcing import FAN_SQL, fanned, instrumented_events
from sparkgauge.operators import fanout as FO
from sparkgauge.operators import state as ST
from sparkgauge.operators.keyed import KeyedState
from sparkgauge.plans import runs as RN
from sparkgauge.session import fresh_path
from sparkgauge.streaming import jobs as SJ

c = F.col
QUERY_AS_OF = dt.datetime(2001, 8, 2)
EVENT_AS_OF = dt.datetime(2024, 1, 31)

# The cache at the start of a run: every third query, processed when it ended.
FRAMES["cache_start"] = """
SELECT query_id, start_time, end_time AS processed_time FROM query_log WHERE query_no % 3 = 0
"""


@query(
    "i1_high_water_mark",
    """SELECT source, epoch_us(m.t) AS last_us, m.i AS last_id FROM (SELECT source, max({'t': last_timestamp, 'i': last_id}) AS m FROM status_log GROUP BY source)
       UNION ALL SELECT 'never', 0, NULL""",
)
def _(t):
    marks = ST.high_water_marks(t.status_log).select("source", F.unix_micros("last_timestamp").alias("last_us"), "last_id")
    never = ST.high_water_mark(t.status_log, "never")
    epoch = t.spark.range(1).select(
        F.lit("never").alias("source"), F.unix_micros(F.lit(never).cast("timestamp")).alias("last_us"), F.lit(None).cast("bigint").alias("last_id")
    )
    return marks.unionByName(epoch)


@query(
    "i1_advance_mark",
    """SELECT 'event_log' AS source, epoch_us(max(ts)) AS last_us, arg_max(event_id, {'a': ts, 'b': event_id}) AS last_id, count(*) AS entries FROM event_log WHERE record_type = 'LOG'""",
)
def _(t):
    out = ST.mark_of(t.event_log.filter("record_type = 'LOG'"), "event_log", c("ts"), c("event_id"), EVENT_AS_OF)
    return out.select("source", F.unix_micros("last_timestamp").alias("last_us"), "last_id", "entries")


CACHE_SQL = """
WITH new AS (SELECT query_id, start_time FROM query_log WHERE start_time > TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 8760 HOUR AND execution_status = 'SUCCESS'
  AND query_id NOT IN (SELECT query_id FROM cache_start)),
nxt AS (SELECT query_id, epoch_us(processed_time) AS processed_us FROM cache_start WHERE start_time >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 17520 HOUR
  UNION ALL SELECT query_id, epoch_us(TIMESTAMP '2001-08-02 00:00:00') FROM new)
"""


def next_cache(t):
    ids = t.query_log.filter("execution_status = 'SUCCESS'")
    return ST.update_processed(t.cache_start, t.query_log, ids, QUERY_AS_OF, fresh_hours=8760, keep_hours=17520)


@query("i2_processed_cache", CACHE_SQL + "SELECT * FROM nxt")
def _(t):
    return next_cache(t).select("query_id", F.unix_micros("processed_time").alias("processed_us"))


@query("i2_processed_cache_versions", CACHE_SQL + "SELECT * FROM nxt")
def _(t):
    """Two runs over a state table: the second finds nothing new."""
    path = fresh_path(t.spark, "processed")
    ST.append_version(next_cache(t), path, 1)
    first = ST.read_version(t.spark, path, 1)
    ids = t.query_log.filter("execution_status = 'SUCCESS'")
    ST.append_version(ST.update_processed(first, t.query_log, ids, QUERY_AS_OF, fresh_hours=8760, keep_hours=17520), path, 2)
    return ST.read_version(t.spark, path, 2).select("query_id", F.unix_micros("processed_time").alias("processed_us"))


@query("i3_snapshot_diff", "SELECT user_id, login_name, default_role FROM user_snapshot EXCEPT SELECT user_id, login_name, default_role FROM user_seen")
def _(t):
    snapshot = t.user_snapshot.select("user_id", "login_name", "default_role")
    return ST.snapshot_diff(snapshot, t.user_seen, dt.datetime(2024, 1, 31, 3), EVENT_AS_OF)


@query("i3_first_run_of_day", "SELECT DISTINCT user_id, login_name, default_role FROM user_snapshot")
def _(t):
    snapshot = t.user_snapshot.select("user_id", "login_name", "default_role")
    return ST.snapshot_diff(snapshot, t.user_seen, dt.datetime(2024, 1, 30, 3), EVENT_AS_OF)


@query(
    "i3_email_hash_map",
    """SELECT email, sha256(email) AS email_hash FROM user_snapshot WHERE email IS NOT NULL AND user_id % 2 = 1
       UNION ALL SELECT email, 'kept' FROM user_snapshot WHERE email IS NOT NULL AND user_id % 2 = 0""",
)
def _(t):
    known = t.user_snapshot.filter("email IS NOT NULL AND user_id % 2 = 0").select("email", F.lit("kept").alias("email_hash"))
    return ST.email_hash_map(known, t.user_snapshot, retain=True)


@query("i4_retention", "SELECT event_id FROM event_log WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 200 HOUR")
def _(t):
    return ST.retention(t.event_log, EVENT_AS_OF, 200).select("event_id")


@query("i4_retention_by_day", "SELECT event_id FROM event_log WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 200 HOUR")
def _(t):
    """Events kept by day: expiry removes the folders of whole days, a read leaves out the rest of the border day."""
    rows = t.event_log.select("event_id", "ts", F.to_date("ts").alias("day"))
    state = KeyedState(t.spark, fresh_path(t.spark, "events"), rows.schema, ["event_id"], day="day", buckets=2)
    state.merge(rows)
    state.expire((EVENT_AS_OF - dt.timedelta(hours=200)).date())
    return ST.retention(state.read(), EVENT_AS_OF, 200).select("event_id")


@query(
    "i5_late_window",
    """SELECT query_id FROM query_log WHERE end_time >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 700000 MINUTE AND query_id NOT IN (SELECT query_id FROM processed_ids WHERE processed_time IS NOT NULL)""",
)
def _(t):
    return ST.late_window(t.query_log, t.processed_ids, QUERY_AS_OF, minutes=700_000).select("query_id")


@query(
    "i6_mode_switch",
    """SELECT 'fast' AS mode, query_id FROM query_log WHERE execution_status = 'RUNNING' UNION ALL SELECT 'full', query_id FROM query_log WHERE execution_status = 'RUNNING'
       UNION ALL SELECT 'full', query_id FROM query_log WHERE execution_status <> 'RUNNING' AND end_time >= TIMESTAMP '2001-05-31 23:59:00'""",
)
def _(t):
    running, finished = t.query_log.filter("execution_status = 'RUNNING'"), t.query_log.filter("execution_status <> 'RUNNING'")
    mark = dt.datetime(2001, 6, 1)
    modes = [
        ST.mode_switch(running, finished, fast, QUERY_AS_OF, mark, hours=87600).select(F.lit(name).alias("mode"), "query_id")
        for name, fast in (("fast", True), ("full", False))
    ]
    return modes[0].unionByName(modes[1])


@query(
    "i7_fan_out",
    FAN_SQL
    + """SELECT 'entries' AS kind, count(*) AS n FROM f UNION ALL SELECT 'log_lines', count(*) FROM f WHERE NOT as_event UNION ALL SELECT 'metrics', sum(n_metrics)::BIGINT FROM f
       UNION ALL SELECT 'events', (count(*) FILTER (WHERE as_event) + sum(n_times))::BIGINT FROM f UNION ALL SELECT 'spans', count(*) FILTER (WHERE is_span) FROM f
       UNION ALL SELECT 'span_events', sum(n_span_events)::BIGINT FROM f UNION ALL SELECT 'errors', count(*) FILTER (WHERE is_error) FROM f""",
)
def _(t):
    return fanned(t).counts()


@query(
    "i7_fan_out_metrics",
    """SELECT event_id, 'amount' AS metric, amount::DOUBLE AS value, epoch_us(ts) * 1000 AS ts_ns FROM event_log WHERE k % 5 <> 0
       UNION ALL SELECT event_id, 'k', k::DOUBLE, epoch_us(ts) * 1000 FROM event_log""",
)
def _(t):
    return fanned(t).metrics.select("event_id", "metric", "value", "ts_ns")


@query(
    "i7_fan_out_logs",
    """SELECT event_id, 'New entry from ' || coalesce(database_name, '-') AS content, 'INFO' AS level FROM event_log WHERE record_type <> 'EVENT'""",
)
def _(t):
    return fanned(t).logs.select("event_id", "content", "level")


@query(
    "i7_fan_out_spans",
    """SELECT event_id, trace_id, span_id, parent_span_id, CASE WHEN parent_span_id IS NULL THEN 'SERVER' ELSE 'INTERNAL' END AS kind, 'New entry from ' || coalesce(database_name, '-') AS name,
       epoch_us(ts) * 1000 AS start_ns, epoch_us(ts) * 1000 + k % 50 * 1000000000 AS end_ns, 'OK' AS status_code FROM event_log WHERE record_type = 'SPAN' AND k % 7 > 1""",
)
def _(t):
    return fanned(t).spans.drop("attributes")


@query(
    "i7_fan_out_span_events",
    """WITH s AS (SELECT * FROM event_log WHERE record_type = 'SPAN' AND k % 7 > 1)
       SELECT event_id, span_id, 'started' AS event, epoch_us(ts) * 1000 AS event_ns FROM s WHERE k % 3 = 0 AND k % 50 = 0
       UNION ALL SELECT event_id, span_id, 'seen', epoch_us(ts) * 1000 FROM s WHERE k % 4 = 0""",
)
def _(t):
    return fanned(t).span_events.select("event_id", "span_id", "event", "event_ns")


# --- runs ----------------------------------------------------------------------------------

RUN_OPTIONS = {"event_column": "error.code", "mark_ns": 1705276800000000000, "spans": FO.SpanColumns()}


def event_context(rows, ts, batch=None):
    """The event rows as a context of a run; ``collect`` filters on the time column."""
    return RN.Context("event_log", lambda since: rows if since is None else rows.filter(c(ts) >= F.lit(since)), "event_id", ts, batch=batch)


@query(
    "i1_runs_by_batches",
    """SELECT event_id, 1::BIGINT AS records, (k % 5 <> 0)::BIGINT + 1 AS metrics FROM event_log""",
)
def _(t):
    """Runs of a quarter of the rows until nothing is left; days as times, so that every border has ties."""
    rows = instrumented_events(t).withColumn("day", F.date_trunc("day", F.timestamp_micros("us")))
    context = event_context(rows, "day", batch=rows.count() // 4 + 1)
    path = fresh_path(t.spark, "runs")
    RN.run_until_done(t.spark, path, context, "r", EVENT_AS_OF, **RUN_OPTIONS)
    kinds = [RN.output(t.spark, path, context, kind).select("event_id", F.lit(kind).alias("kind")) for kind in ("logs", "events", "metrics")]
    every = reduce(lambda a, b: a.unionByName(b), kinds)
    is_metric = c("kind") == "metrics"
    return every.groupBy("event_id").agg(F.count_if(~is_metric).alias("records"), F.count_if(is_metric).alias("metrics"))


@query(
    "i1_runs_replayed",
    FAN_SQL
    + """, g AS (SELECT *, (ts >= TIMESTAMP '2024-01-16 00:00:00')::INT AS run FROM f)
       SELECT run, 'logs' AS kind, count(*) FILTER (WHERE NOT as_event) AS n FROM g GROUP BY run UNION ALL SELECT run, 'events', count(*) FILTER (WHERE as_event) FROM g GROUP BY run
       UNION ALL SELECT run, 'metrics', sum(n_metrics)::BIGINT FROM g GROUP BY run UNION ALL SELECT run, 'timestamp_events', sum(n_times)::BIGINT FROM g GROUP BY run
       UNION ALL SELECT run, 'spans', count(*) FILTER (WHERE is_span) FROM g GROUP BY run UNION ALL SELECT run, 'span_events', sum(n_span_events)::BIGINT FROM g GROUP BY run""",
)
def _(t):
    """Two runs over a growing table; each dies once before its state is written and is asked for once more after it."""
    rows = instrumented_events(t).withColumn("ts", F.timestamp_micros("us"))
    path = fresh_path(t.spark, "runs")
    for seen in (rows.filter("ts < TIMESTAMP '2024-01-16 00:00:00'"), rows):
        context = event_context(seen, "ts")
        RN.start(t.spark, path, context, "dies", EVENT_AS_OF, **RUN_OPTIONS)
        RN.run_once(t.spark, path, context, "lives", EVENT_AS_OF, **RUN_OPTIONS)
        RN.run_once(t.spark, path, context, "again", EVENT_AS_OF, **RUN_OPTIONS)
    counts = [
        RN.output(t.spark, path, context, kind).groupBy(c("run").cast("int").alias("run")).agg(F.count("*").alias("n")).select("run", F.lit(kind).alias("kind"), "n")
        for kind in FO.KINDS
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query(
    "i8_event_condition",
    """SELECT event_id, error_code IS NOT NULL AS has_error, coalesce(contains(lower(error_message), 'pass'), false) AS bad_password FROM login_log""",
)
def _(t):
    from sparkgauge.operators.fanout import event_condition

    return t.login_log.select(
        "event_id", event_condition(c("error_code")).alias("has_error"), event_condition(c("error_message"), "PASS").alias("bad_password")
    )


def feed_records(rows):
    """Instrumented rows of the event feed."""
    from sparkgauge.functions import sections as S

    return rows.select(
        "event_id", "ts", "arrival", (F.unix_micros("ts") * 1000).alias("start_time"), F.concat(F.lit("event "), c("event_type")).alias("message"),
        S.text_section({"type": c("event_type")}).alias("dimensions"),
        S.text_section({"error.code": F.when(c("event_type") == "error", c("props"))}).alias("attributes"),
        S.number_section({"value": c("value")}).alias("metrics"), S.time_section({"seen": c("ts")}).alias("event_timestamps"),
    )


FEED_BORDERS = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)]


@query(
    "i5_runs_with_late_rows",
    """SELECT event_id, epoch_us(ts) AS us, 1::BIGINT AS records, 1::BIGINT AS metrics, 1::BIGINT AS times FROM events WHERE NOT (event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-11 00:00:00')""",
)
def _(t):
    """Runs over the feed as it arrives: late rows within two hours are taken once, repeated ones never again.

    A run dies before its state is written, and the last one is asked for once more after it.
    """
    rows, path = feed_records(t.event_feed), fresh_path(t.spark, "runs")
    options = {"event_column": "error.code"}
    for border in [*FEED_BORDERS, None]:
        seen = rows if border is None else rows.filter(c("arrival") < F.lit(border))

        def collect(since, seen=seen):
            return seen if since is None else seen.filter(c("ts") >= F.lit(since))

        context = RN.Context("events", collect, "event_id", "ts", reread=dt.timedelta(hours=2))
        if border == FEED_BORDERS[1]:
            RN.start(t.spark, path, context, "dies", EVENT_AS_OF, **options)
        RN.run_once(t.spark, path, context, "lives", EVENT_AS_OF, **options)
    RN.run_once(t.spark, path, context, "again", EVENT_AS_OF, **options)
    kinds = [RN.output(t.spark, path, context, kind).select("event_id", F.lit(kind).alias("kind")) for kind in ("logs", "events", "metrics", "timestamp_events")]
    every = reduce(lambda a, b: a.unionByName(b), kinds)
    counted = every.groupBy("event_id").agg(
        F.count_if(c("kind").isin("logs", "events")).alias("records"), F.count_if(c("kind") == "metrics").alias("metrics"), F.count_if(c("kind") == "timestamp_events").alias("times")
    )
    return counted.join(t.events.select("event_id", "ts"), "event_id").select("event_id", F.unix_micros("ts").alias("us"), "records", "metrics", "times")


@query(
    "i5_runs_with_late_rows_by_batches",
    """SELECT event_id, 1::BIGINT AS records FROM events WHERE NOT (event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-11 00:00:00')""",
)
def _(t):
    """The same in runs of a bounded number of rows, until nothing is left of what has arrived."""
    rows, path = feed_records(t.event_feed), fresh_path(t.spark, "runs")
    batch = rows.count() // 3 + 1
    for border in [dt.datetime(2024, 1, 16), None]:
        seen = rows if border is None else rows.filter(c("arrival") < F.lit(border))

        def collect(since, seen=seen):
            return seen if since is None else seen.filter(c("ts") >= F.lit(since))

        context = RN.Context("events", collect, "event_id", "ts", batch=batch, reread=dt.timedelta(hours=2))
        RN.run_until_done(t.spark, path, context, "r", EVENT_AS_OF)
    return RN.output(t.spark, path, context, "logs").groupBy("event_id").agg(F.count("*").alias("records"))


# --- streaming twins -----------------------------------------------------------------------


# Rows as they arrive: some an hour late, some again half an hour later, some 18 days late, which
# is past every watermark by then.
FRAMES["event_feed"] = """
SELECT event_id, ts, event_type, value, props,
       CASE WHEN event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-11 00:00:00' THEN ts + INTERVAL '18' DAY
            WHEN event_id % 7 = 3 THEN ts + INTERVAL '1' HOUR ELSE ts END AS arrival
FROM events
UNION ALL
SELECT event_id, ts, event_type, value, props, ts + INTERVAL '30' MINUTE AS arrival
FROM events WHERE event_id % 10 = 1
"""
IN_TIME = "NOT (event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-11 00:00:00')"
SLICE_FILES = 4


def as_stream(spark, rows, order, borders):
    """Rows written in slices between the borders of a column, one after the other, and read back a slice per batch."""
    path = fresh_path(spark, "feed")
    for low, high in zip([None, *borders], [*borders, None]):
        part = rows
        if low is not None:
            part = part.filter(c(order) >= F.lit(low))
        if high is not None:
            part = part.filter(c(order) < F.lit(high))
        part.repartition(SLICE_FILES).write.mode("append").parquet(path)
    return SJ.read_stream(spark, path, "*.parquet", rows.schema, SLICE_FILES)


def event_stream(t):
    """The event table as a file stream."""
    return SJ.read_stream(t.spark, t.sf_dir, "events.parquet", t.events.schema)


def feed_stream(t):
    """The event feed in six batches by arrival."""
    return as_stream(t.spark, t.event_feed, "arrival", [dt.datetime(2024, 1, d) for d in (6, 11, 16, 21, 26)])


@query(
    "i9_stream_windows",
    """WITH m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR AS mark FROM events),
       w AS (SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL)
       SELECT epoch_us(hour) // 1000000 AS start_s, event_type, n FROM w, m WHERE hour + INTERVAL 1 HOUR <= mark""",
)
def _(t):
    counts = SJ.windowed_counts(event_stream(t), "ts", "1 hour", "2 hours", ["event_type"])
    out = SJ.materialise(counts, "windows")
    return out.select(F.unix_seconds("window_start").alias("start_s"), "event_type", "n")


@query("i2_stream_processed_once", f"SELECT event_id FROM events WHERE {IN_TIME}")
def _(t):
    return SJ.materialise(SJ.processed_once(feed_stream(t).select("event_id", "ts"), "event_id", "ts").select("event_id"), "processed")


@query("i5_stream_late_tolerant", f"SELECT event_id, event_type FROM events WHERE {IN_TIME}")
def _(t):
    rows = feed_stream(t).select("event_id", "event_type", "ts")
    return SJ.materialise(SJ.late_tolerant(rows, "event_id", "ts").select("event_id", "event_type"), "late")


@query(
    "i3_stream_snapshot_diff",
    "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
)
def _(t):
    """Three batches of customers, in each of which most rows were seen before."""
    last = t.customer.agg(F.max("c_custkey")).first()[0]
    stream = as_stream(t.spark, t.customer, "c_custkey", [last // 3, 2 * last // 3])
    return SJ.materialise(SJ.snapshot_diff_stream(stream, ["c_nationkey", "c_mktsegment"]), "snapshots")


@query(
    "i3_stream_daily_report",
    """WITH e AS (SELECT DISTINCT user_id, event_type, ts, date_trunc('day', ts)::DATE AS day FROM events),
       r AS (SELECT *, max(day) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS before,
         max(day) OVER (PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS alike FROM e)
       SELECT user_id, event_type, epoch_us(ts) AS us, CASE WHEN before IS NULL OR day > before THEN 'full' ELSE 'changed' END AS report
       FROM r WHERE before IS NULL OR day > before OR alike IS NULL OR alike < day - 3""",
)
def _(t):
    """Sightings of users in six batches, their kind of event as what may change; versions are kept for 3 days."""
    borders = [dt.datetime(2024, 1, d, 9) for d in (6, 11, 16, 21, 26)]
    stream = as_stream(t.spark, t.events.select("user_id", "event_type", "ts"), "ts", borders)
    out = SJ.materialise(SJ.daily_diff_stream(stream, ["user_id"], ["event_type"], "ts", keep_days=3), "reports")
    return out.select("user_id", "event_type", F.unix_micros("ts").alias("us"), "report")


@query(
    "j20_stream_still_open",
    """WITH d AS (SELECT query_id, start_time, end_time FROM query_log WHERE execution_status = 'SUCCESS'),
       m AS (SELECT least((SELECT max(start_time) FROM query_log), (SELECT max(end_time) FROM d)) - INTERVAL 2 HOUR AS mark)
       SELECT query_id FROM query_log, m WHERE start_time + INTERVAL 20 SECOND < mark
         AND query_id NOT IN (SELECT query_id FROM d WHERE end_time <= start_time + INTERVAL 20 SECOND)""",
)
def _(t):
    """Statements that had no finish 20 seconds after their start, from two feeds; every third finish arrives late."""
    borders = [dt.datetime(1993, 1, 1), dt.datetime(1995, 1, 1), dt.datetime(1997, 1, 1)]
    started = as_stream(t.spark, t.query_log.select("query_id", "start_time"), "start_time", borders)
    done = t.query_log.filter("execution_status = 'SUCCESS'")
    arrival = c("end_time") + F.when(c("query_no") % 3 == 0, F.expr("INTERVAL 50 MINUTES")).otherwise(F.expr("INTERVAL 0 MINUTES"))
    finished = as_stream(t.spark, done.select("query_id", "end_time", arrival.alias("arrival")), "arrival", borders)
    return SJ.materialise(SJ.still_open_stream(started, finished, "query_id", "start_time", "end_time", within="20 seconds").select("query_id"), "open")


SILENT_SQL = (
    TS.ADAPTIVE_SQL.replace("marked AS", "every_bin AS")
    + """, given AS (SELECT metric, account, min(bin_s) AS first_s FROM every_bin WHERE v IS NOT NULL GROUP BY ALL),
    mark AS (SELECT max(bin_s) - 86400 AS mark_s FROM every_bin WHERE v IS NOT NULL),
    marked AS (SELECT e.* FROM every_bin AS e JOIN given AS g ON g.metric = e.metric AND g.account IS NOT DISTINCT FROM e.account CROSS JOIN mark
      WHERE e.bin_s >= g.first_s AND e.bin_s <= mark_s)"""
    + TS.alerts_sql("metric, account", 3, 2, 3)
)


@query(
    "t11_stream_alerts",
    SILENT_SQL
    + """SELECT metric, account, 'raised' AS kind, start_s, NULL::BIGINT AS end_s, NULL::BIGINT AS samples, NULL::BIGINT AS violations FROM alerts
       UNION ALL SELECT metric, account, 'closed', start_s, end_s, samples, violations FROM alerts WHERE NOT is_open""",
)
def _(t):
    """Six-hour bins in six batches against learned thresholds; some are half a day late, some repeated, missing ones violate."""
    bins = TS.adaptive(t).filter(c("v").isNotNull())
    place = F.unix_seconds("bin") / 21600
    lag = F.when(place % 5 == 2, F.expr("INTERVAL 12 HOURS")).when(place % 7 == 3, F.expr("INTERVAL 18 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    feed = bins.select("metric", "account", "bin", "violation", (c("bin") + lag).alias("arrival"))
    again = feed.filter(place % 4 == 1).withColumn("arrival", c("bin") + F.expr("INTERVAL 6 HOURS"))
    stream = as_stream(t.spark, feed.unionByName(again), "arrival", [dt.datetime(2024, 1, d) for d in (6, 11, 16, 21, 26)])
    alerts = SJ.alert_stream(stream, ["metric", "account"], "bin", step_s=21600, window=3, violating=2, dealerting=3, missing=True, late=dt.timedelta(days=1))
    out = SJ.materialise(alerts, "alerts")
    return out.select("metric", "account", "kind", F.unix_seconds("start_at").alias("start_s"), F.unix_seconds("end_at").alias("end_s"), "samples", "violations")


@query(
    "i7_stream_fan_out",
    """SELECT 'logs' AS kind, count(*) FILTER (WHERE event_type <> 'error') AS n FROM event_feed UNION ALL SELECT 'events', count(*) FILTER (WHERE event_type = 'error') FROM event_feed
       UNION ALL SELECT 'metrics', count(*) FROM event_feed UNION ALL SELECT 'timestamp_events', count(*) FROM event_feed""",
)
def _(t):
    from sparkgauge.functions import sections as S

    rows = feed_stream(t).select(
        "event_id", (F.unix_micros("ts") * 1000).alias("start_time"), F.concat(F.lit("event "), c("event_type")).alias("message"),
        S.text_section({"type": c("event_type")}).alias("dimensions"),
        S.text_section({"error.code": F.when(c("event_type") == "error", c("props"))}).alias("attributes"),
        S.number_section({"value": c("value")}).alias("metrics"), S.time_section({"seen": c("ts")}).alias("event_timestamps"),
    )
    path = fresh_path(t.spark, "fanned")
    SJ.fan_out_stream(rows, "event_id", path, path + "-checkpoint", event_column="error.code").awaitTermination()
    kinds = ["logs", "events", "metrics", "timestamp_events"]
    counts = [t.spark.read.parquet(f"{path}/{k}").agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k in kinds]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
