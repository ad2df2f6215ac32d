"""Inventory 2.1: sources, sinks and batches."""

import datetime as dt

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import EVENT_NOW, FRAMES
from sparkgauge.functions import sections as S
from sparkgauge.operators import fanout as FO
from sparkgauge.operators.keyed import KeyedState
from sparkgauge.session import fresh_path
from sparkgauge.sources import feeds as FD
from sparkgauge.sources import readers as R
from sparkgauge.sources import sinks as K
from sparkgauge.streaming.jobs import run_available

c = F.col
EVENT_BORDERS = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)]

FRAMES["json_inventory"] = """
SELECT event_id, '[{"name":"b_' || CAST(k AS STRING) || '","created":' || CAST(1704067200000 + event_id * 1000 AS STRING)
  || '},{"name":"c_' || CAST(user_id AS STRING) || '","created":' || CAST(1704067200000 + k * 60000 AS STRING) || '}]' AS items
FROM event_rows
"""

FRAMES["metric_dictionary"] = """
SELECT 'value.' || lower(p_type) AS metric, 'Value of ' || p_type AS display_name, CASE WHEN p_type = 'SMALL' THEN NULL ELSE 'ms' END AS unit
FROM part WHERE p_type <> 'ECONOMY' GROUP BY p_type
"""

FRAMES["field_renames"] = """
SELECT 'old.' || event_type AS old_name, 'new.' || event_type AS new_name FROM events WHERE event_type <> 'view' GROUP BY event_type
"""


def event_now():
    return F.lit(EVENT_NOW).cast("timestamp")


def instrumented_events(t):
    """Telemetry rows over the event table, used by sinks and fan-out."""
    return t.event_log.select(
        "event_id",
        F.unix_micros("ts").alias("us"),
        (F.unix_micros("ts") * 1000).alias("start_time"),
        F.concat(F.lit("New entry from "), F.coalesce("database_name", F.lit("-"))).alias("message"),
        S.text_section({"db.namespace": c("database_name"), "scope": c("scope_name")}).alias("dimensions"),
        S.text_section({"status.code": F.when(c("record_type") == "EVENT", F.lit("ERROR")), "error.code": F.when(c("record_type") == "EVENT", c("severity")), "tag": F.when(c("k") % 2 == 0, F.lit(" ")).otherwise(c("severity"))}).alias("attributes"),
        S.number_section({"amount": F.when(c("k") % 5 != 0, c("amount")), "k": c("k")}).alias("metrics"),
        S.time_section({"started": F.when(c("k") % 3 == 0, c("start_ts")), "seen": F.when(c("k") % 4 == 0, c("ts"))}).alias("event_timestamps"),
        F.when(c("record_type") == "SPAN", c("span_id")).alias("span_id"),
        "trace_id",
        "parent_span_id",
        # Some spans are still open, and some end before they start.
        (F.unix_micros("ts") * 1000 + F.when(c("k") % 7 == 1, -1).when(c("k") % 7 != 0, c("k") % 50 * 1_000_000_000)).alias("end_time"),
    )


@query("s1_read_source", "SELECT event_type, count(*) AS n, max(user_id) AS top_user FROM events GROUP BY event_type")
def _(t):
    return R.read_source(t.spark, f"SELECT event_type, count(*) AS n, max(user_id) AS top_user FROM parquet.`{t.sf_dir}/events.parquet` GROUP BY event_type")


@query(
    "s1_objects_as_source",
    "SELECT event_id, epoch_us(ts) * 1000 AS start_time, 'event ' || event_type AS message, event_type AS dim_type, (k * 1.0)::DOUBLE AS k FROM event_rows",
)
def _(t):
    objects = t.event_rows.select(
        F.to_json(
            F.struct(
                (F.unix_micros("ts") * 1000).alias("TIMESTAMP"),
                F.concat(F.lit("event "), c("event_type")).alias("_MESSAGE"),
                F.create_map(F.lit("type"), c("event_type"), F.lit("id"), c("event_id").cast("string")).alias("DIMENSIONS"),
                F.to_json(F.create_map(F.lit("k"), c("k"))).alias("METRICS"),
            )
        ).alias("value")
    )
    rows = R.instrumented_from_json(objects)
    return rows.select(
        c("dimensions")["id"].cast("bigint").alias("event_id"), "start_time", "message", c("dimensions")["type"].alias("dim_type"), c("metrics")["k"].alias("k")
    )


@query(
    "s2_read_ndjson",
    """SELECT event_id, epoch_us(ts) * 1000 AS timestamp_ns, event_type AS name, account, CASE WHEN k % 2 = 0 THEN amount::DOUBLE END AS amount FROM event_rows""",
)
def _(t):
    path = fresh_path(t.spark, "ndjson")
    t.event_rows.select(
        (F.unix_micros("ts") * 1000).alias("TIMESTAMP"),
        c("event_type").alias("NAME"),
        F.to_json(F.create_map(F.lit("account"), c("account"), F.lit("id"), c("event_id").cast("string"))).alias("DIMENSIONS"),
        F.to_json(F.struct(F.when(c("k") % 2 == 0, c("amount")).alias("amount"))).alias("METRICS"),
    ).write.json(path)
    rows = R.read_ndjson(t.spark, path)
    return rows.select(
        c("dimensions")["id"].cast("bigint").alias("event_id"), "timestamp_ns", "name", c("dimensions")["account"].alias("account"),
        F.try_element_at("metrics", F.lit("amount")).alias("amount"),
    )


@query(
    "s3_explode_json_inventory",
    """SELECT event_id, 'b_' || k::VARCHAR AS name, (1704067200000 + event_id * 1000) * 1000 AS created_us FROM event_rows
       UNION ALL SELECT event_id, 'c_' || user_id::VARCHAR, (1704067200000 + k * 60000) * 1000 FROM event_rows""",
)
def _(t):
    out = R.explode_json_inventory(t.json_inventory, "items", "array<struct<name:string,created:bigint>>", ["created"])
    return out.select("event_id", "name", F.unix_micros("created").alias("created_us"))


@query(
    "s4_config_value",
    """SELECT substr(path, length('plugins.economy') + 2) AS key, CASE WHEN type = 'int' THEN TRY_CAST(value AS BIGINT) END AS number_value,
       CASE WHEN type = 'int' THEN CASE WHEN TRY_CAST(value AS BIGINT) IS NULL THEN value END ELSE value END AS text_value, 17::BIGINT AS fallback
       FROM config_rows WHERE starts_with(path, 'plugins.economy.')""",
)
def _(t):
    fallback = R.config_value(t.config_rows, "plugins.economy.missing", 17)
    return R.config_subtree(t.config_rows, "plugins.economy").withColumn("fallback", F.lit(fallback).cast("bigint"))


@query(
    "s5_upsert_by_key",
    """SELECT path, value FROM config_rows WHERE path NOT IN (SELECT 'plugins.' || lower(p_type) || '.limit_' || (p_size + 5)::VARCHAR FROM part)
       UNION ALL SELECT DISTINCT 'plugins.' || lower(p_type) || '.limit_' || (p_size + 5)::VARCHAR, 'new' FROM part""",
)
def _(t):
    path = F.concat(F.lit("plugins."), F.lower("p_type"), F.lit(".limit_"), (c("p_size") + 5).cast("string"))
    new = t.part.select(path.alias("path")).distinct().withColumn("value", F.lit("new"))
    return R.upsert_by_key(t.config_rows.select("path", "value"), new, ["path"])


@query(
    "s5_upsert_by_merges",
    """WITH n AS (SELECT DISTINCT 'plugins.' || lower(p_type) || '.limit_' || (p_size + 5)::VARCHAR AS path,
         CASE WHEN p_size <= 10 OR p_size > 40 THEN 'third' WHEN p_size <= 20 THEN 'second' ELSE 'first' END AS value FROM part WHERE p_size <= 30 OR p_size > 40)
       SELECT path, value FROM config_rows WHERE path NOT IN (SELECT path FROM n) UNION ALL SELECT path, value FROM n""",
)
def _(t):
    """Three merges into a stored state, of which each rewrites the buckets it touches."""
    start = t.config_rows.select("path", "value")
    state = KeyedState(t.spark, fresh_path(t.spark, "configuration"), start.schema, ["path"])
    state.merge(start)
    path = F.concat(F.lit("plugins."), F.lower("p_type"), F.lit(".limit_"), (c("p_size") + 5).cast("string"))
    for value, rows in (("first", "p_size <= 30"), ("second", "p_size <= 20"), ("third", "p_size <= 10 OR p_size > 40")):
        state.merge(t.part.filter(rows).select(path.alias("path")).distinct().withColumn("value", F.lit(value)))
    return state.read()


@query(
    "s1_ordered_rows",
    "SELECT source, event_id, epoch_us(ts) AS us, event_type FROM events, (VALUES ('batch'), ('stream')) AS s(source)",
)
def _(t):
    """Events of a folder by a batch query, and by a stream that stops and starts again after more of them are there."""
    FD.register(t.spark)
    folder, out = fresh_path(t.spark, "ordered"), fresh_path(t.spark, "streamed")
    options = {"folder": folder, "time": "ts", "id": "event_id"}
    rows = t.events.select("event_id", "ts", "event_type", "props")
    schema = rows.select("event_id", "ts", "event_type").schema
    for low, high in zip([None, *EVENT_BORDERS], [*EVENT_BORDERS, None]):
        part = rows if low is None else rows.filter(c("ts") >= F.lit(low))
        (part if high is None else part.filter(c("ts") < F.lit(high))).write.mode("append").parquet(folder)
        stream = t.spark.readStream.format("ordered_rows").schema(schema).options(**options).load()
        run_available(stream, out, out + "-checkpoint")
    batch = t.spark.read.format("ordered_rows").schema(schema).options(**options).load()
    streamed = t.spark.read.schema(schema).parquet(out)
    both = batch.withColumn("source", F.lit("batch")).unionByName(streamed.withColumn("source", F.lit("stream")))
    return both.select("source", "event_id", F.unix_micros("ts").alias("us"), "event_type")


@query(
    "s6_rename_fields",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'old.' ELSE 'new.' END || event_type AS key, k::VARCHAR AS value FROM event_rows""",
)
def _(t):
    members = t.event_rows.select("event_id", F.concat(F.lit("old."), c("event_type")).alias("key"), c("k").cast("string").alias("value"))
    return R.rename_members(members, R.renames(t.field_renames, "old_name", "new_name"), ["event_id"])


@query(
    "s6_rename_csv",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'old.' ELSE 'new.' END || event_type AS key FROM event_rows""",
)
def _(t):
    path = fresh_path(t.spark, "renames")
    t.field_renames.coalesce(1).write.csv(path, sep=";", header=True)
    members = t.event_rows.select("event_id", F.concat(F.lit("old."), c("event_type")).alias("key"), c("k").cast("string").alias("value"))
    return R.rename_members(members, R.read_renames(t.spark, path), ["event_id"]).select("event_id", "key")


LINE_TIME = "CASE WHEN ts >= TIMESTAMP '2024-01-30 23:05:00' THEN ' ' || (epoch_us(ts) // 1000)::VARCHAR ELSE '' END"


@query(
    "s7_metric_lines",
    f"""WITH d AS (SELECT *, 'run.plugin="event_log"' || CASE WHEN database_name IS NOT NULL THEN ',db.namespace="' || database_name || '"' ELSE '' END
          || CASE WHEN scope_name IS NOT NULL THEN ',scope="' || scope_name || '"' ELSE '' END AS dims, {LINE_TIME} AS tail FROM event_log)
       SELECT event_id, 'amount' AS metric, 'amount,' || dims || ' ' || amount::VARCHAR || tail AS line FROM d WHERE k % 5 <> 0
       UNION ALL SELECT event_id, 'k', 'k,' || dims || ' ' || k::VARCHAR || tail FROM d""",
)
def _(t):
    return K.metric_lines(instrumented_events(t), ["event_id"], context={"run.plugin": "event_log"}, now=event_now())


@query(
    "s7_written_lines",
    f"""WITH d AS (SELECT *, 'run.plugin="event_log"' || CASE WHEN database_name IS NOT NULL THEN ',db.namespace="' || database_name || '"' ELSE '' END
          || CASE WHEN scope_name IS NOT NULL THEN ',scope="' || scope_name || '"' ELSE '' END AS dims, {LINE_TIME} AS tail FROM event_log),
       w AS (SELECT 'amount,' || dims || ' ' || amount::VARCHAR || tail AS line FROM d WHERE k % 5 <> 0 UNION ALL SELECT 'k,' || dims || ' ' || k::VARCHAR || tail FROM d)
       SELECT line, (SELECT count(*) FROM w) AS counted FROM w""",
)
def _(t):
    """Lines written by the sink and read back, next to the count its commit left; the run is written a second time."""
    FD.register(t.spark)
    lines = K.metric_lines(instrumented_events(t), ["event_id"], context={"run.plugin": "event_log"}, now=event_now()).select("line")
    folder = fresh_path(t.spark, "lines")
    for _ in range(2):
        lines.write.format("metric_lines").option("run", "r1").mode("overwrite").save(folder)
    return FD.read_lines(t.spark, folder, "r1").select("line", F.lit(sum(FD.written(folder, "r1").values())).cast("bigint").alias("counted"))


@query(
    "s7_composite_metric_lines",
    """SELECT user_id, 'amount' AS metric, 'amount,user="u\\"' || user_id::VARCHAR || '" ' || CASE WHEN count(*) % 2 = 0 THEN 'gauge,min=' || min(amount)::VARCHAR || ',max=' || max(amount)::VARCHAR || ',sum=' || sum(amount)::VARCHAR || ',count=' || count(*)::VARCHAR
       ELSE sum(amount)::VARCHAR END AS line FROM event_rows GROUP BY user_id""",
)
def _(t):
    per_user = t.event_rows.groupBy("user_id").agg(F.min("amount").alias("lo"), F.max("amount").alias("hi"), F.sum("amount").alias("s"), F.count("*").alias("n"))
    full = S.number_section({"min": c("lo"), "max": c("hi"), "sum": c("s"), "gauge": c("n")})
    value = F.when(c("n") % 2 == 0, full).otherwise(S.number_section({"sum": c("s")}))
    rows = per_user.select(
        "user_id", F.lit(None).cast("bigint").alias("start_time"),
        S.text_section({"user": F.concat(F.lit('u"'), c("user_id").cast("string"))}).alias("dimensions"),
        F.create_map(F.lit("amount"), value).alias("metrics"),
    )
    return K.metric_lines(rows, ["user_id"], context={}, now=event_now())


@query(
    "s8_metric_metadata_lines",
    """WITH m AS (SELECT DISTINCT 'value.' || lower(p_type) AS metric, CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'LARGE' THEN 'Lost' END AS local_name,
         CASE WHEN p_type = 'ECONOMY' THEN 'bytes' END AS local_unit FROM part UNION ALL SELECT DISTINCT 'other.metric_' || lower(p_type), NULL, NULL FROM part)
       SELECT m.metric, CASE WHEN d.metric IS NOT NULL THEN '#' || m.metric || ' gauge meta.displayName="' || d.display_name || '"' || coalesce(',meta.unit="' || d.unit || '"', '')
         WHEN local_unit IS NOT NULL THEN '#' || m.metric || ' gauge meta.displayName="Economy",meta.unit="bytes"' ELSE '' END AS line
       FROM m LEFT JOIN metric_dictionary AS d ON m.metric = d.metric""",
)
def _(t):
    kinds = t.part.select("p_type").distinct()
    own = kinds.select(
        F.concat(F.lit("value."), F.lower("p_type")).alias("metric"),
        F.when(c("p_type") == "LARGE", F.lit("Lost")).alias("local_name"),
        F.when(c("p_type") == "ECONOMY", F.lit("bytes")).alias("local_unit"),
    )
    none = F.lit(None).cast("string")
    other = kinds.select(F.concat(F.lit("other.metric_"), F.lower("p_type")).alias("metric"), none.alias("local_name"), none.alias("local_unit"))
    return K.metric_metadata_lines(own.unionByName(other), t.metric_dictionary)


@query(
    "s9_log_records",
    """SELECT event_id, 'New entry from ' || coalesce(database_name, '-') AS content, CASE WHEN record_type = 'EVENT' THEN 'ERROR' ELSE 'INFO' END AS level,
       CASE WHEN ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1435 MINUTE THEN epoch_us(ts) // 1000 END AS timestamp_ms, epoch_us(ts) * 1000 AS observed_ns,
       (3 + (database_name IS NOT NULL)::INT + (scope_name IS NOT NULL)::INT + 2 * (record_type = 'EVENT')::INT + (k % 2 = 1)::INT + (k % 5 <> 0)::INT + (k % 3 = 0)::INT + (k % 4 = 0)::INT)::BIGINT AS n_attributes,
       CASE WHEN k % 2 = 1 THEN severity END AS tag FROM event_log""",
)
def _(t):
    rows = instrumented_events(t)
    flat = S.merge_maps(
        F.create_map(F.lit("timestamp"), c("start_time").cast("string"), F.lit("own"), F.lit("1")),
        S.unpack_sections(c("dimensions"), c("attributes"), c("metrics"), c("event_timestamps")),
    )
    level = S.status_level(F.try_element_at("attributes", F.lit("status.code")))
    out = K.log_records(rows, "event_id", content=c("message"), level=level, flat=flat, context={"run.id": "r1"}, now=event_now())
    return out.select(
        "event_id", "content", "level", "timestamp_ms", "observed_ns", F.size("attributes").cast("bigint").alias("n_attributes"),
        F.try_element_at("attributes", F.lit("tag")).alias("tag"),
    )


def events_of(t):
    rows = instrumented_events(t)
    flat = S.unpack_sections(c("dimensions"), c("attributes"), c("metrics"))
    return K.generic_events(
        rows, "event_id", event_type="CUSTOM_INFO", title="Given title", message=F.when(c("start_time") % 2 == 0, c("message")).otherwise(F.lit("")),
        flat=flat, start=c("start_time"), end=c("start_time") + 60_000_000_000, timestamp=c("start_time"), now=event_now(),
        context={"run.id": "r1"}, properties=F.create_map(F.lit("tag"), F.lit("given"), F.lit("extra"), F.repeat(F.lit("x"), 5000)), timeout=400,
    )


@query(
    "s10_generic_events",
    """SELECT event_id, 'CUSTOM_INFO' AS event_type, 'New entry from ' || coalesce(database_name, '-') AS title,
       CASE WHEN ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1435 MINUTE THEN epoch_us(ts) // 1000 END AS start_ms,
       CASE WHEN ts + INTERVAL 1 MINUTE >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1435 MINUTE THEN epoch_us(ts + INTERVAL 1 MINUTE) // 1000 END AS end_ms,
       360::BIGINT AS timeout, true AS timeout_lowered, CASE WHEN k % 2 = 0 THEN ' ' ELSE severity END AS tag, 5000::BIGINT AS extra_chars FROM event_log""",
)
def _(t):
    return events_of(t).select(
        "event_id", "event_type", "title", "start_ms", "end_ms", "timeout", "timeout_lowered", c("properties")["tag"].alias("tag"),
        F.length(c("properties")["extra"]).cast("bigint").alias("extra_chars"),
    )


@query("s11_truncated_events", "SELECT event_id, 4096::BIGINT AS extra_chars, 'extra' AS cut_names, 5000::BIGINT AS full_chars, 'r1' AS run_id FROM event_log")
def _(t):
    out = K.truncated_events(events_of(t))
    return out.select(
        "event_id", F.length(c("properties")["extra"]).cast("bigint").alias("extra_chars"),
        F.array_join(F.map_keys("cut_properties"), ",").alias("cut_names"), c("cut_properties")["extra"].alias("full_chars"), c("properties")["run.id"].alias("run_id"),
    )


@query(
    "s12_cloud_events",
    """SELECT '1.0' AS specversion, sha256(event_id::VARCHAR || '|' || (epoch_us(ts) * 1000)::VARCHAR) AS id, 'host-1' AS source,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z' AS time, 'run.task' AS type, event_id::VARCHAR AS event_id, '0.1' AS version FROM event_log""",
)
def _(t):
    rows = instrumented_events(t)
    out = K.cloud_events(
        rows, ["event_id", "start_time"], source="host-1", event_type="run.task", time=F.timestamp_micros("us"),
        flat=F.create_map(F.lit("event_id"), c("event_id").cast("string"), F.lit("app.version"), F.lit("lost")), extra={"app.version": "0.1"},
    )
    return out.select("specversion", "id", "source", "time", "type", c("data")["event_id"].alias("event_id"), c("data")["app.version"].alias("version"))


@query(
    "s13_pack_batches",
    """WITH RECURSIVE e AS (SELECT event_type AS lane_type, epoch_us(date_trunc('hour', ts)) // 1000000 AS lane_s, event_id, amount AS size,
         row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) AS n FROM event_rows),
       p AS (SELECT lane_type, lane_s, event_id, size, n, 0 AS batch_no, size AS used, 1 AS held FROM e WHERE n = 1
         UNION ALL SELECT e.lane_type, e.lane_s, e.event_id, e.size, e.n, p.batch_no + (p.used + e.size > 9000 OR p.held >= 3)::INT,
           CASE WHEN p.used + e.size > 9000 OR p.held >= 3 THEN e.size ELSE p.used + e.size END, CASE WHEN p.used + e.size > 9000 OR p.held >= 3 THEN 1 ELSE p.held + 1 END
         FROM p JOIN e ON e.lane_type = p.lane_type AND e.lane_s = p.lane_s AND e.n = p.n + 1)
       SELECT lane_type, lane_s, event_id, size, batch_no::BIGINT AS batch_no FROM p""",
)
def _(t):
    rows = t.event_rows.select(
        c("event_type").alias("lane_type"), F.unix_seconds(F.date_trunc("hour", "ts")).alias("lane_s"), "event_id", c("amount").alias("size")
    )
    return K.pack_batches(rows, ["lane_type", "lane_s"], ["event_id"], "size", max_bytes=9000, max_count=3)


@query(
    "s13_pack_one_lane",
    """WITH RECURSIVE e AS (SELECT event_id, amount AS size, row_number() OVER (ORDER BY event_id) AS n FROM event_rows),
       p AS (SELECT event_id, size, n, 0 AS batch_no, size AS used, 1 AS held FROM e WHERE n = 1
         UNION ALL SELECT e.event_id, e.size, e.n, p.batch_no + (p.used + e.size > 20000 OR p.held >= 7)::INT,
           CASE WHEN p.used + e.size > 20000 OR p.held >= 7 THEN e.size ELSE p.used + e.size END, CASE WHEN p.used + e.size > 20000 OR p.held >= 7 THEN 1 ELSE p.held + 1 END
         FROM p JOIN e ON e.n = p.n + 1)
       SELECT event_id, size, batch_no::BIGINT AS batch_no FROM p""",
)
def _(t):
    """All events in one lane, spread over blocks of 500."""
    rows = t.event_rows.select(F.lit("all").alias("lane"), "event_id", c("amount").alias("size"))
    return K.pack_long_lanes(rows, ["lane"], ["event_id"], "size", max_bytes=20_000, max_count=7, block_rows=500).drop("lane")


@query(
    "s13_batch_payloads",
    """SELECT lane_s, batch_no, '[' || string_agg('{"id":' || event_id::VARCHAR || '}', ',' ORDER BY event_id) || ']' AS payload
       FROM (SELECT event_id, epoch_us(date_trunc('day', ts)) // 1000000 AS lane_s, (row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY event_id) - 1) // 25 AS batch_no FROM event_rows) GROUP BY ALL""",
)
def _(t):
    rows = t.event_rows.select(
        F.unix_seconds(F.date_trunc("day", "ts")).alias("lane_s"), "event_id", F.to_json(F.struct(c("event_id").alias("id"))).alias("payload")
    )
    sized = rows.withColumn("size", F.octet_length("payload").cast("bigint"))
    packed = K.pack_batches(sized, ["lane_s"], ["event_id"], "size", max_bytes=K.EVENT_BYTES, max_count=25)
    return K.batch_payloads(packed.join(rows, ["lane_s", "event_id"]), ["lane_s"], ["event_id"], "payload")


FAN_SQL = """
WITH f AS (SELECT event_id, record_type = 'EVENT' AS as_event, (k % 5 <> 0)::INT + 1 AS n_metrics,
  (k % 3 = 0 AND start_ts >= TIMESTAMP '2024-01-15 00:00:00')::INT + (k % 4 = 0 AND ts >= TIMESTAMP '2024-01-15 00:00:00')::INT AS n_times,
  record_type = 'SPAN' AND k % 7 > 1 AS is_span, record_type = 'SPAN' AND k % 7 < 2 AS is_error,
  CASE WHEN record_type = 'SPAN' AND k % 7 > 1 THEN (k % 3 = 0 AND k % 50 = 0)::INT + (k % 4 = 0)::INT ELSE 0 END AS n_span_events, ts FROM event_log)
"""


def fanned(t, **options):
    return FO.fan_out(instrumented_events(t), "event_id", event_column="error.code", mark_ns=1705276800000000000, spans=FO.SpanColumns(), **options)


@query(
    "s14_run_report",
    FAN_SQL
    + """SELECT 'event_log' AS context, 'r1' AS run_id, '{"entries":' || count(*) || ',"log_lines":' || count(*) FILTER (WHERE NOT as_event) || ',"metrics":' || sum(n_metrics)
       || ',"events":' || (count(*) FILTER (WHERE as_event) + sum(n_times)) || ',"spans":' || count(*) FILTER (WHERE is_span) || ',"span_events":' || sum(n_span_events)
       || ',"errors":' || count(*) FILTER (WHERE is_error) || '}' AS entries_count FROM f""",
)
def _(t):
    return K.run_report(fanned(t).counts(), "event_log", "r1")


@query(
    "s15_run_status_events",
    """SELECT exec_id, plugin AS task_name, status, epoch_us(ts) // 1000 AS timestamp_ms, 'Run ' || exec_id || ' of ' || plugin || ' ' || lower(status) AS message FROM run_status""",
)
def _(t):
    return K.run_status_events(t.run_status, c("status"), c("plugin"), c("exec_id"), c("ts"))
