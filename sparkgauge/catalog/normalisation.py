"""Inventory 2.2: projection and row normalisation."""

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import EVENT_NOW, FRAMES
from sparkgauge.functions import nested as NE
from sparkgauge.functions import sections as S
from sparkgauge.functions import text as X

c = F.col


def event_now():
    return F.lit(EVENT_NOW).cast("timestamp")

# The time of an event, spelled in a different unit per row.
FRAMES["raw_times"] = """
SELECT event_id,
       CASE event_id % 7
         WHEN 0 THEN CAST(1704067200000 + event_id * 259200 AS STRING)
         WHEN 1 THEN CAST(1704067200000 + event_id * 259200 AS STRING) || '123'
         WHEN 2 THEN CAST(1704067200000 + event_id * 259200 AS STRING) || '123456'
         WHEN 3 THEN CAST(1704067200000 + event_id * 259200 AS STRING) || '123456789'
         WHEN 4 THEN CAST(1704067200000 + event_id * 259200 AS STRING) || '123456789012'
         WHEN 5 THEN '-1000000'
         ELSE CAST(1704067200000 + event_id * 259200 AS STRING) || '999000' END AS raw
FROM events
"""

# The same events, their time as whole nanoseconds, ISO text, or nothing usable.
FRAMES["raw_texts"] = """
SELECT event_id,
       CASE event_id % 4
         WHEN 0 THEN CAST(1704067200000000000 + event_id * 1000000007 AS STRING)
         WHEN 1 THEN '2024-01-' || lpad(CAST(1 + event_id % 28 AS STRING), 2, '0') || 'T10:' || lpad(CAST(event_id % 60 AS STRING), 2, '0') || ':30.250Z'
         WHEN 2 THEN '2024-01-' || lpad(CAST(1 + event_id % 28 AS STRING), 2, '0') || 'T10:11:12'
         ELSE NULL END AS raw
FROM events
"""

FRAMES["span_times"] = """
SELECT event_id, 1704067200000000000 + (event_id % 200 - 100) * 60000000000 AS start_ns,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE 1704067200000000000 + (event_id % 170 - 90) * 60000000000 END AS ts_ns,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1704067200000000000 + (event_id % 200 - 100 + event_id % 11) * 60000000000 END AS end_ns
FROM events
"""


@query(
    "n1_epoch_nanos",
    "SELECT event_id, epoch_us(query_start_time) * 1000 AS start_ns, coalesce(epoch_us(query_start_time) * 1000, -1) AS start_or_sentinel FROM task_history",
)
def _(t):
    return t.task_history.select(
        "event_id",
        S.epoch_nanos(c("query_start_time")).alias("start_ns"),
        S.epoch_nanos(c("query_start_time"), -1).alias("start_or_sentinel"),
    )


def query_sections():
    return {
        "dimensions": S.text_section(
            {"db.namespace": c("database_name"), "db.user": c("user_name"), "platform.role.name": c("role_name")}
        ),
        "attributes": S.text_section({"platform.query.id": c("query_id"), "platform.query.parent_id": c("parent_query_id"), "platform.error.code": c("error_code")}),
        "metrics": S.number_section({"platform.time.execution": c("execution_time"), "platform.data.scanned_from_cache": c("cache_pct")}),
        "event_timestamps": S.time_section({"platform.query.start_time": c("start_time")}),
    }


SECTION_ROWS = """
SELECT query_id, section, key, value FROM (
  SELECT query_id, 'dimensions' AS section, 'db.namespace' AS key, database_name AS value FROM query_log
  UNION ALL SELECT query_id, 'dimensions', 'db.user', user_name FROM query_log
  UNION ALL SELECT query_id, 'dimensions', 'platform.role.name', role_name FROM query_log
  UNION ALL SELECT query_id, 'attributes', 'platform.query.id', query_id FROM query_log
  UNION ALL SELECT query_id, 'attributes', 'platform.query.parent_id', parent_query_id FROM query_log
  UNION ALL SELECT query_id, 'attributes', 'platform.error.code', error_code::VARCHAR FROM query_log
  UNION ALL SELECT query_id, 'metrics', 'platform.time.execution', execution_time::VARCHAR FROM query_log
  UNION ALL SELECT query_id, 'metrics', 'platform.data.scanned_from_cache', cache_pct::VARCHAR FROM query_log
  UNION ALL SELECT query_id, 'event_timestamps', 'platform.query.start_time', (epoch_us(start_time) * 1000)::VARCHAR FROM query_log
) WHERE value IS NOT NULL"""


@query("n2_build_sections", SECTION_ROWS)
def _(t):
    built = t.query_log.select("query_id", *[v.alias(k) for k, v in query_sections().items()])
    sections = F.map_from_arrays(
        F.array(*[F.lit(s) for s in S.SECTIONS]),
        F.array(
            c("dimensions"),
            c("attributes"),
            F.transform_values("metrics", lambda _, v: S.number_text(v)),
            c("event_timestamps").cast(S.TEXT_MAP),
        ),
    )
    return built.select("query_id", F.explode(sections).alias("section", "_m")).select("query_id", "section", F.explode("_m").alias("key", "value"))


@query(
    "n3_build_object_keep_null",
    """SELECT query_id, '{"query.id":"' || query_id || '","parent":' || coalesce('"' || parent_query_id || '"', 'null')
       || ',"error":' || coalesce(error_code::VARCHAR, 'null') || '}' AS object FROM query_log""",
)
def _(t):
    return t.query_log.select(
        "query_id",
        S.object_keep_null({"query.id": c("query_id"), "parent": c("parent_query_id"), "error": c("error_code")}).alias("object"),
    )


def clashing_sections():
    return {
        "dimensions": S.text_section({"name": c("database_name"), "user": c("user_name"), "blank": F.lit("  ")}),
        "attributes": S.text_section({"name": c("query_id"), "tag": c("query_tag"), "blank": F.lit("x")}),
        "metrics": S.number_section({"tag": c("query_no"), "time": c("execution_time")}),
        "event_timestamps": S.time_section({"time": c("start_time"), "started": c("start_time")}),
    }


FLAT_SQL = """
SELECT query_id, key, value FROM (
  SELECT query_id, 'name' AS key, coalesce(database_name, query_id) AS value FROM query_log
  UNION ALL SELECT query_id, 'user', user_name FROM query_log
  UNION ALL SELECT query_id, 'blank', '  ' FROM query_log
  UNION ALL SELECT query_id, 'tag', query_tag FROM query_log
  UNION ALL SELECT query_id, 'time', execution_time::VARCHAR FROM query_log
  UNION ALL SELECT query_id, 'started', (epoch_us(start_time) * 1000)::VARCHAR FROM query_log
)"""


@query("n4_unpack_sections", FLAT_SQL)
def _(t):
    flat = S.unpack_sections(*clashing_sections().values())
    return t.query_log.select("query_id", F.explode(flat).alias("key", "value"))


@query("n5_drop_blanks", FLAT_SQL + " WHERE trim(value) <> ''")
def _(t):
    flat = S.drop_blanks(S.unpack_sections(*clashing_sections().values()))
    return t.query_log.select("query_id", F.explode(flat).alias("key", "value"))


@query(
    "n6_clean_nested",
    """SELECT event_id, '{"k":' || k::VARCHAR || CASE WHEN k % 2 = 0 THEN ',"user":{"id":' || user_id::VARCHAR || '}' ELSE '' END
       || ',"list":[1],"text":{"deep":' || k::VARCHAR || '}}' AS cleaned,
       '{"k":' || k::VARCHAR || ',"list":[1],"text":{"deep":' || k::VARCHAR || '}}' AS reported
       FROM event_rows""",
)
def _(t):
    def text(user_key):
        return F.concat(
            F.lit('{"k":'), c("k"), F.lit(f',"{user_key}":'),
            F.when(c("k") % 2 == 0, F.concat(F.lit('{"id":'), c("user_id"), F.lit(',"none":null}'))).otherwise(F.lit('{"none":null}')),
            F.lit(',"list":[1,null],"empty":{},"text":"{\\"deep\\":'), c("k"), F.lit(',\\"gone\\":null}"}'),
        )

    return t.event_rows.select(
        "event_id", NE.clean_nested(text("user")).alias("cleaned"), NE.clean_nested_reported(text("_user")).alias("reported")
    )


@query(
    "n7_normalize_mixed_lists",
    """SELECT event_id, CASE k % 4
         WHEN 0 THEN '{"l":[' || k::VARCHAR || '.0,2.5]}' WHEN 1 THEN '{"l":["' || k::VARCHAR || '","x"]}'
         WHEN 2 THEN '{"l":[' || k::VARCHAR || ',null,true]}' ELSE '{"l":[' || k::VARCHAR || ',1]}' END AS normalized
       FROM event_rows""",
)
def _(t):
    k = c("k").cast("string")
    text = (
        F.when(c("k") % 4 == 0, F.concat(F.lit('{"l":['), k, F.lit(',"2.5"]}')))
        .when(c("k") % 4 == 1, F.concat(F.lit('{"l":['), k, F.lit(',null,"x"]}')))
        .when(c("k") % 4 == 2, F.concat(F.lit('{"l":["'), k, F.lit('",null,true]}')))
        .otherwise(F.concat(F.lit('{"l":['), k, F.lit(",1]}")))
    )
    return t.event_rows.select("event_id", NE.normalize_mixed_lists(text).alias("normalized"))


@query(
    "n8_pack_json_values",
    """SELECT event_id, key, value FROM (
         SELECT event_id, 'entities' AS key, CASE at_risk_entities WHEN '[]' THEN NULL
           ELSE to_json(json_extract_string(at_risk_entities, '$[*]'))::VARCHAR END AS value FROM scanner_findings
         UNION ALL SELECT event_id, 'name', scanner_name FROM scanner_findings
         UNION ALL SELECT event_id, 'object', '{"a":' || at_risk_count::VARCHAR || '}' FROM scanner_findings) WHERE value IS NOT NULL""",
)
def _(t):
    flat = S.text_section(
        {
            "entities": c("at_risk_entities"),
            "name": c("scanner_name"),
            "object": F.concat(F.lit('{"a":'), c("at_risk_count"), F.lit("}")),
            "none": F.lit("{}"),
        }
    )
    return t.scanner_findings.select("event_id", F.explode(S.pack_json_values(flat)).alias("key", "value"))


@query(
    "n9_escape_value",
    r"""SELECT doc_id, replace(replace(text, '\', '\\'), '"', '\"') AS escaped,
        replace(replace(source, '\', '\\'), '"', '\"') || ',' || replace(replace(lang || '"q\', '\', '\\'), '"', '\"') AS escaped_list FROM documents""",
)
def _(t):
    return t.documents.select(
        "doc_id",
        X.escape_value(c("text")).alias("escaped"),
        X.escape_list(F.array(c("source"), F.concat(c("lang"), F.lit('"q\\')))).alias("escaped_list"),
    )


@query("n10_clean_key", r"SELECT page_id, lower(regexp_replace(regexp_replace(url || ' End  Key', '[^a-zA-Z0-9_\s]', '', 'g'), '\s+', '_', 'g')) AS key FROM pages")
def _(t):
    return t.pages.select("page_id", X.clean_key(F.concat(c("url"), F.lit(" End  Key"))).alias("key"))


@query(
    "n11_parse_timestamp_any",
    """SELECT event_id, coalesce(TRY_CAST(raw AS BIGINT), epoch_us(TRY_CAST(replace(raw, 'Z', '') AS TIMESTAMP)) * 1000) AS nanos,
       coalesce(TRY_CAST(raw AS BIGINT), epoch_us(TRY_CAST(replace(raw, 'Z', '') AS TIMESTAMP)) * 1000, 7) AS nanos_or_default FROM raw_texts""",
)
def _(t):
    return t.raw_texts.select(
        "event_id",
        S.nanos_from_any(c("raw")).alias("nanos"),
        S.nanos_from_any(c("raw"), F.lit(7).cast("bigint")).alias("nanos_or_default"),
    )


UNIT_SQL = """
WITH n AS (SELECT event_id, CASE WHEN v < 0 THEN NULL WHEN v > 4100000000000000000000 THEN v // 1000000 WHEN v > 4100000000000000000 THEN v // 1000
  WHEN v > 4100000000000000 THEN v WHEN v > 4100000000000 THEN v * 1000 ELSE v * 1000000 END AS ns
  FROM (SELECT event_id, raw::HUGEINT AS v FROM raw_times)),
ok AS (SELECT event_id, CASE WHEN ns <= 4100000000000000000 THEN ns END AS ns FROM n),
r AS (SELECT event_id, ns, epoch_us(TIMESTAMP '2024-01-31 00:00:00') * 1000::HUGEINT AS now FROM ok)
"""


@query(
    "n12_normalize_timestamp_unit",
    UNIT_SQL
    + """SELECT event_id, (CASE WHEN ns BETWEEN now - 1435 * 60000000000::HUGEINT AND now + 10 * 60000000000::HUGEINT THEN ns // 1000000 END)::BIGINT AS recent_ms,
       (CASE WHEN ns BETWEEN now - 20000 * 60000000000::HUGEINT AND now + 10 * 60000000000::HUGEINT THEN ns END)::BIGINT AS wide_ns, ns::BIGINT AS any_ns FROM r""",
)
def _(t):
    raw = c("raw").cast("decimal(38,0)")
    return t.raw_times.select(
        "event_id",
        S.normalize_timestamp_unit(raw, event_now()).alias("recent_ms"),
        S.normalize_timestamp_unit(raw, event_now(), past_minutes=20000, unit="ns").alias("wide_ns"),
        S.normalize_timestamp_unit(raw, event_now(), unit="ns", check_range=False).alias("any_ns"),
    )


@query(
    "n13_telemetry_times",
    UNIT_SQL
    + """SELECT event_id, (CASE WHEN ns BETWEEN now - 1435 * 60000000000::HUGEINT AND now + 10 * 60000000000::HUGEINT THEN ns // 1000000 END)::BIGINT AS timestamp_ms,
       CASE WHEN event_id % 2 = 0 THEN 1704067200000000000 + event_id ELSE ns::BIGINT END AS observed_ns FROM r""",
)
def _(t):
    observed = F.when(c("event_id") % 2 == 0, F.lit(1704067200000000000) + c("event_id"))
    ms, ns = S.telemetry_times(c("raw").cast("decimal(38,0)"), observed.cast("decimal(38,0)"), event_now())
    return t.raw_times.select("event_id", ms.alias("timestamp_ms"), ns.alias("observed_ns"))


@query(
    "n14_clamp_timestamps",
    """WITH p AS (SELECT event_id, start_ns AS s, ts_ns AS t, end_ns AS e, coalesce(end_ns - start_ns, 0) AS span,
         1704067200000000000 - 3540000000000 AS lo, 1704067200000000000 + 540000000000 AS hi FROM span_times),
       a AS (SELECT *, CASE WHEN s > hi THEN hi - span ELSE s END AS s1 FROM p),
       b AS (SELECT *, CASE WHEN s1 < lo THEN lo ELSE s1 END AS s2 FROM a),
       d AS (SELECT *, CASE WHEN (s > hi OR s < lo) AND e IS NOT NULL THEN s2 + span ELSE e END AS e2, CASE WHEN t > hi THEN hi - span ELSE t END AS t1 FROM b),
       f AS (SELECT *, CASE WHEN t1 < lo THEN lo ELSE t1 END AS t2 FROM d),
       g AS (SELECT *, CASE WHEN (t > hi OR t < lo) AND e2 IS NOT NULL THEN t2 + span ELSE e2 END AS e3 FROM f)
       SELECT event_id, s2 AS start_ns, t2 AS ts_ns, CASE WHEN e3 > hi THEN least(hi, s2 + span) ELSE e3 END AS end_ns FROM g""",
)
def _(t):
    start, ts, end = S.clamp_timestamps(c("start_ns"), c("ts_ns"), c("end_ns"), F.lit(1704067200000000000))
    return t.span_times.select("event_id", start.alias("start_ns"), ts.alias("ts_ns"), end.alias("end_ns"))


@query("n15_format_utc", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z' AS utc FROM event_rows")
def _(t):
    return t.event_rows.select("event_id", S.format_utc(c("ts")).alias("utc"))


@query(
    "n16_add_context",
    """SELECT query_id, key, value FROM (
       SELECT query_id, 'db.system' AS key, 'warehouse' AS value FROM query_log UNION ALL SELECT query_id, 'run.plugin', 'query_history' FROM query_log
       UNION ALL SELECT query_id, 'run.context', 'query_history' FROM query_log UNION ALL SELECT query_id, 'run.id', 'r1' FROM query_log
       UNION ALL SELECT query_id, 'db.user', user_name FROM query_log)""",
)
def _(t):
    context = S.run_context("query_history", "query_history", "r1", {"db.system": "warehouse"})
    flat = S.text_section({"db.user": c("user_name"), "run.id": c("query_id")})
    return t.query_log.select("query_id", F.explode(S.add_context(flat, context)).alias("key", "value"))


@query(
    "n17_status_code",
    """SELECT event_id, CASE WHEN completion_status = 'SUCCEEDED' THEN 'OK' WHEN length(coalesce(completion_status, '')) > 0 THEN 'ERROR' ELSE 'UNSET' END AS status_code
       FROM scanner_findings""",
)
def _(t):
    return t.scanner_findings.select("event_id", S.status_code(c("completion_status"), ok=("SUCCEEDED",)).alias("status_code"))


@query(
    "n18_log_level",
    """SELECT event_id, CASE severity WHEN 'CRITICAL' THEN 'CRITICAL' WHEN 'HIGH' THEN 'ERROR' WHEN 'MEDIUM' THEN 'WARNING' ELSE 'INFO' END AS level,
       CASE WHEN coalesce(completion_status, 'OK') = 'OK' THEN 'INFO' ELSE 'ERROR' END AS by_status FROM scanner_findings""",
)
def _(t):
    return t.scanner_findings.select(
        "event_id", S.severity_level(c("severity")).alias("level"), S.status_level(c("completion_status")).alias("by_status")
    )


SANITIZERS = {
    "tenant_id_prefix": X.DENY_PATTERNS["tenant_id_prefix"],
    "mail": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "user@example.com"),
    "phone": (r"\+?\d{1,3}[ -]\d{3}[ -]\d{3,4}[ -]?\d{0,4}", "000-000"),
}


@query(
    "n19_sanitize_text",
    r"""WITH a AS (SELECT doc_id, text AS t0, regexp_replace(text, '\w{3}\d{4}(\w|\d)', 'test-tenant', 'g') AS t1 FROM documents),
       b AS (SELECT *, regexp_replace(t1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', 'user@example.com', 'g') AS t2 FROM a),
       d AS (SELECT *, regexp_replace(t2, '\+?\d{1,3}[ -]\d{3}[ -]\d{3,4}[ -]?\d{0,4}', '000-000', 'g') AS t3 FROM b)
       SELECT doc_id, md5(t3) AS clean_md5, (len(regexp_extract_all(t0, '\w{3}\d{4}(\w|\d)')) + len(regexp_extract_all(t1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'))
         + len(regexp_extract_all(t2, '\+?\d{1,3}[ -]\d{3}[ -]\d{3,4}[ -]?\d{0,4}')))::BIGINT AS hits FROM d""",
)
def _(t):
    clean, hits = X.sanitize_text(c("text"), SANITIZERS)
    return t.documents.select("doc_id", F.md5(clean).alias("clean_md5"), hits.alias("hits"))


@query("n19_sanitize_deny_list")
def _(t):
    clean, hits = X.sanitize_text(c("text"))
    return t.documents.groupBy("lang").agg(F.sum(hits).alias("hits"), F.count_if(clean != c("text")).alias("changed_rows"))


@query(
    "n20_hash_pii",
    """SELECT user_id, sha256(email) AS email, sha1(login_name) AS user_hash FROM user_snapshot""",
)
def _(t):
    return t.user_snapshot.select("user_id", X.hash_email(c("email")).alias("email"), X.hash_user(c("login_name")).alias("user_hash"))


@query("n20_mask_ip", "SELECT event_id, substr(client_ip, 1, 3) AS client_ip FROM login_log")
def _(t):
    return t.login_log.select("event_id", X.mask_ip(c("client_ip")).alias("client_ip"))


@query(
    "n21_extract_target_table",
    r"""WITH x AS (SELECT pipe_id, nullif(regexp_extract(definition, 'INTO\s+(\S+)', 1, 'i'), '') AS target FROM pipes)
        SELECT pipe_id, target, split_part(target, '.', -1) AS bare FROM x""",
)
def _(t):
    target, bare = X.extract_target_table(c("definition"))
    return t.pipes.select("pipe_id", target.alias("target"), bare.alias("bare"))


@query(
    "n22_compress_columns",
    """SELECT event_no, 'ADD' AS op, 'C' || regexp_extract(properties, '"C([0-9])"', 1) || ',E' AS names FROM ddl_events
       UNION ALL SELECT event_no, 'DROP', 'D' || regexp_extract(properties, '"D([0-9])"', 1) FROM ddl_events""",
)
def _(t):
    ops = t.ddl_events.select("event_no", F.explode(X.compress_columns(c("properties"))).alias("op", "_names"))
    return ops.select("event_no", "op", F.array_join("_names", ",").alias("names"))


@query(
    "n23_unquote_content",
    r"""SELECT event_id, CASE WHEN value_text LIKE '"%' THEN regexp_replace(value_text, '^"(.+[^"])"?$', '\1') ELSE regexp_replace(value_text, '^(.+[^"])"?$', '\1') END AS content,
        json_valid(value_text) AS is_json FROM event_log""",
)
def _(t):
    return t.event_log.select(
        "event_id", X.unquote_content(c("value_text")).alias("content"), X.json_or_null(c("value_text")).isNotNull().alias("is_json")
    )


@query(
    "n24_flatten_log_attributes",
    """SELECT event_id, key, value FROM (
       SELECT event_id, 'severity_text' AS key, severity AS value FROM event_log
       UNION ALL SELECT event_id, 'snow.user.id', user_id::VARCHAR FROM event_log
       UNION ALL SELECT event_id, 'event.scope.name', scope_name FROM event_log
       UNION ALL SELECT event_id, 'record_type', record_type FROM event_log
       UNION ALL SELECT event_id, 'trace_id', trace_id FROM event_log) WHERE value IS NOT NULL""",
)
def _(t):
    record = S.text_section({"severity_text": c("severity"), "record_type": F.lit("lost")})
    resource = S.text_section({"snow.user.id": c("user_id"), "severity_text": F.lit("lost")})
    scope = S.text_section({"name": c("scope_name")})
    own = {"RECORD_TYPE": c("record_type"), "TRACE_ID": c("trace_id"), "_CONTENT": c("value_text")}
    flat = X.flatten_log_attributes([record, resource], scope, own)
    return t.event_log.select("event_id", F.explode(flat).alias("key", "value"))


@query("n25_normalize_tag", "SELECT query_id, regexp_replace(query_tag, '[0-9]+', '#', 'g') AS tag FROM query_log")
def _(t):
    return t.query_log.select("query_id", X.normalize_tag(c("query_tag"), "[0-9]+").alias("tag"))


@query("n26_parse_prefix", "SELECT DISTINCT nullif(regexp_extract(warehouse_name, '^(.*?)_.+$', 1), '') AS env FROM query_log")
def _(t):
    return t.query_log.select(X.parse_prefix(c("warehouse_name")).alias("env")).distinct()


@query(
    "n27_parse_call_arguments",
    """SELECT query_id, unnest(regexp_extract_all(query_text, '''([^'']*)''', 1)) AS plugin_name FROM query_log WHERE query_text LIKE 'call SELF_DB.APP.RUN%'""",
)
def _(t):
    names = X.parse_call_arguments(c("query_text"), r"call SELF(?:_\w+)?_DB\.APP\.RUN\(ARRAY_CONSTRUCT\(")
    return t.query_log.select("query_id", F.explode(names).alias("plugin_name"))


@query(
    "n28_coerce_array",
    """SELECT event_id, unnest(CASE event_id % 3 WHEN 0 THEN ['a', k::VARCHAR] ELSE [event_type] END) AS item FROM event_rows WHERE event_id % 3 < 2""",
)
def _(t):
    value = F.when(c("event_id") % 3 == 0, F.concat(F.lit('["a","'), c("k"), F.lit('"]'))).when(c("event_id") % 3 == 1, c("event_type"))
    return t.event_rows.select("event_id", F.explode(X.coerce_array(value)).alias("item"))


# Age buckets of the last schema change, in days.
AGE_BUCKETS = {"< 1 week": 7, "1 week – 1 month": 30, "1 – 3 months": 90, "3 – 6 months": 180}


@query(
    "n29_bucketize",
    """SELECT point_id, CASE WHEN minutes_since_ddl / 1440.0 < 7 THEN '< 1 week' WHEN minutes_since_ddl / 1440.0 < 30 THEN '1 week – 1 month'
       WHEN minutes_since_ddl / 1440.0 < 90 THEN '1 – 3 months' WHEN minutes_since_ddl / 1440.0 < 180 THEN '3 – 6 months' ELSE '> 6 months' END AS bucket FROM table_metrics""",
)
def _(t):
    return t.table_metrics.select("point_id", S.bucketize(c("minutes_since_ddl") / 1440.0, AGE_BUCKETS, "> 6 months").alias("bucket"))


@query(
    "n30_message_template",
    """SELECT query_id, 'Slow in ' || warehouse_name || ' / ' || coalesce(database_name, 'undefined') || '.' AS fixed,
       'Slow in ' || warehouse_name || ' / ' || coalesce(database_name, '{dims:db}') || '.' AS filled FROM query_log""",
)
def _(t):
    template = "Slow in {dims:warehouse} / {dims:db}."
    dims = {"warehouse": c("warehouse_name"), "db": c("database_name")}
    return t.query_log.select(
        "query_id",
        X.message_template(template, dims).alias("fixed"),
        X.fill_template(F.lit(template), S.text_section(dims)).alias("filled"),
    )
