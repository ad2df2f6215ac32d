"""Inventory 2.11: collectors over source tables bound to the given data.

Each result shows an instrumented row as text: its times, its message, and each section
as ``key=value`` pairs. The SQL side restates filters and joins by hand and takes
the member list from the same specification.
"""

import datetime as dt

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import FRAMES
from sparkgauge.catalog.incremental import EVENT_AS_OF, QUERY_AS_OF
from sparkgauge.catalog.shaping import ACCESS_SQL, access_arrays
from sparkgauge.functions import sections as S
from sparkgauge.plans.collectors import custom as CU
from sparkgauge.plans.collectors import events as CE
from sparkgauge.plans.collectors import queries as CQ
from sparkgauge.plans.collectors import security as CS
from sparkgauge.plans.collectors import tables as CT
from sparkgauge.plans.collectors import warehouses as CW
from sparkgauge.plans.collectors.spec import RowSpec
from sparkgauge.sources.readers import flat_from_json, instrumented_from_json

c = F.col
COLUMNS: dict[str, list[str]] = {}


def source(name: str, base: str, columns: dict[str, str]) -> None:
    """A source table with the column names of the observed platform."""
    COLUMNS[name] = list(columns)
    FRAMES[name] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {base}"


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# --- how both sides show a row -------------------------------------------------------------

PARTS = ("dimensions", "attributes", "metrics", "event_timestamps")


def shown(rows, *ids: str):
    """Times, texts and sections of instrumented rows as plain columns."""

    def text(section: str):
        entries = F.map_entries(section)
        value = {"metrics": lambda e: S.number_text(e["value"]), "event_timestamps": lambda e: e["value"].cast("string")}
        shown_value = value.get(section, lambda e: e["value"])
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), shown_value(e))), ";").alias(section)

    columns = [x for x in ("timestamp_ns", "start_time", "end_time", "name", "message", "status_code") if x in rows.columns]
    return rows.select(*ids, *columns, *[text(s) for s in PARTS if s in rows.columns])


def spec_sql(spec: RowSpec, rows: str, columns: list[str], ids: tuple[str, ...] = (), json: tuple[str, ...] = ()) -> str:
    """SELECT that shows the rows of a relation the same way."""
    spec = spec.known(columns)

    def ns(e: str | None, missing: str | None = None) -> str:
        if e is None:
            return "NULL::BIGINT"
        return f"epoch_us({e}) * 1000" if missing is None else f"coalesce(epoch_us({e}) * 1000, {missing})"

    def value(e: str) -> str:
        if e.startswith("ns_or_-1:"):
            return ns(e[9:], "-1")
        if e.startswith("ns:"):
            return ns(e[3:])
        return f"to_json({e})" if e in json else e

    def pairs(members: dict[str, str], show) -> str:
        items = [f"'{k}=' || {show(e)}" for k, e in members.items()]
        return f"concat_ws(';', {', '.join(items)})" if items else "''"

    def number(e: str) -> str:
        return f"(CASE WHEN ({e}) = floor({e}) THEN ({e})::BIGINT::VARCHAR ELSE ({e})::DOUBLE::VARCHAR END)"

    missing = "-1" if spec.sentinel else None
    out = [
        *ids,
        f"{ns(spec.timestamp, missing if spec.timestamp else None)} AS timestamp_ns",
        f"{ns(spec.start) if spec.start else ns(spec.timestamp, missing if spec.timestamp else None)} AS start_time",
        f"{ns(spec.end)} AS end_time",
        f"{spec.name or 'NULL::VARCHAR'} AS name",
        f"{spec.message} AS message",
        f"{spec.status or 'NULL::VARCHAR'} AS status_code",
        f"{pairs(spec.dimensions, lambda e: f'({value(e)})::VARCHAR')} AS dimensions",
        f"{pairs(spec.attributes, lambda e: f'({value(e)})::VARCHAR')} AS attributes",
        f"{pairs(spec.metrics, number)} AS metrics",
        f"{pairs(spec.event_times, lambda e: f'({ns(e)})::VARCHAR')} AS event_timestamps",
    ]
    return f"SELECT {', '.join(out)} FROM {rows}"


RUN_AT = "TIMESTAMP '2024-01-31 00:00:00' AS run_at"


# --- queries -------------------------------------------------------------------------------

source(
    "src_history",
    "query_log",
    same(
        "query_id", "query_no", "parent_query_id", "session_id", "user_name", "role_name", "database_name", "schema_name", "warehouse_name", "warehouse_size",
        "query_type", "query_text", "query_hash", "query_tag", "execution_status", "error_code", "start_time", "end_time", "execution_time", "compilation_time",
        "queued_overload_time", "queued_provisioning_time", "queued_repair_time", "transaction_blocked_time", "total_elapsed_time", "bytes_scanned",
        "partitions_scanned", "partitions_total",
    )
    | {
        "bytes_spilled_to_local_storage": "bytes_spilled_local",
        "bytes_spilled_to_remote_storage": "bytes_spilled_remote",
        "percentage_scanned_from_cache": "cache_pct",
        "rows_written_to_result": "rows_produced",
        "credits_used_cloud_services": "cloud_credits",
    },
)
source(
    "src_sessions",
    "sessions",
    same("session_id", "created_on", "authentication_method", "login_event_id", "closed_reason") | {"client_application_id": "client_application"},
)

HISTORY_SQL = (
    ACCESS_SQL.rstrip()
    + """,
sp AS (SELECT query_id, min({'ts': ts, 'span_id': span_id, 'trace_id': trace_id}) AS f FROM event_log WHERE record_type = 'SPAN' GROUP BY query_id),
fresh AS (SELECT * FROM src_history WHERE end_time >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 2000000 MINUTE AND query_text IS NOT NULL
  AND query_id NOT IN (SELECT query_id FROM processed_ids WHERE processed_time IS NOT NULL)
  AND NOT coalesce(query_text = '' AND user_name = 'SYSTEM' AND role_name IS NULL AND database_name IS NULL AND schema_name IS NULL, false)),
hist AS (SELECT q.* EXCLUDE (database_name), coalesce(split_part(split_part(tb.v, ',', 1), '.', 1), q.database_name) AS database_name, split_part(tb.v, ',', 1) AS table_name,
  CASE WHEN f.query_id IS NOT NULL THEN coalesce(string_split(tb.v, ','), []) END AS query_tables, CASE WHEN f.query_id IS NOT NULL THEN coalesce(string_split(vw.v, ','), []) END AS query_views,
  CASE WHEN f.query_id IS NOT NULL THEN coalesce(string_split(dbs.v, ','), []) END AS query_dbs,
  s.created_on, s.authentication_method, s.login_event_id, s.closed_reason, s.client_application_id, sp.f.span_id AS span_id, sp.f.trace_id AS trace_id, 'false' AS with_operator_stats
  FROM fresh AS q LEFT JOIN f ON q.query_id = f.query_id LEFT JOIN tb ON q.query_id = tb.query_id AND f.query_id IS NOT NULL LEFT JOIN vw ON q.query_id = vw.query_id LEFT JOIN dbs ON q.query_id = dbs.query_id
  LEFT JOIN src_sessions AS s ON s.session_id = q.session_id AND s.created_on >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 240 HOUR AND q.parent_query_id IS NULL
  LEFT JOIN sp ON sp.query_id = q.query_id),
flagged AS (SELECT *, query_id IN (SELECT parent_query_id FROM hist WHERE parent_query_id IS NOT NULL) AS is_parent, parent_query_id IS NULL OR parent_query_id NOT IN (SELECT query_id FROM hist) AS is_root FROM hist)
"""
)
HISTORY_COLUMNS = COLUMNS["src_history"] + COLUMNS["src_sessions"] + ["table_name", "query_tables", "query_views", "query_dbs", "with_operator_stats"]
HISTORY_IDS = ("query_id", "span_id", "trace_id", "is_parent", "is_root")


def history(t):
    records = t.event_log.drop("query_id")
    return CQ.new_history(
        t.src_history, t.processed_ids, access_arrays(t), t.src_sessions, records, QUERY_AS_OF, minutes=2_000_000, session_hours=240
    )


@query(
    "c1_query_history",
    HISTORY_SQL + spec_sql(CQ.QUERY_HISTORY, "flagged", HISTORY_COLUMNS, HISTORY_IDS, ("query_tables", "query_views", "query_dbs")),
)
def _(t):
    return shown(CQ.query_history(history(t)), *HISTORY_IDS)


@query(
    "c1_recent_queries",
    """WITH st AS (SELECT query_id, count(*) AS n FROM operator_rows WHERE query_id IN (SELECT query_id FROM (SELECT query_id FROM query_log
         WHERE query_type IN ('SELECT', 'INSERT', 'UPDATE') AND user_name NOT IN ('SYSTEM') AND (bytes_spilled_local > 0 OR bytes_spilled_remote > 0 OR queued_overload_time > 0 OR queued_provisioning_time > 0
           OR partitions_scanned * 10 > partitions_total * 9 OR transaction_blocked_time > 0 OR queued_repair_time > 0 OR execution_time > 100000))) GROUP BY query_id)
       SELECT q.query_id, st.n AS n_operators, st.n IS NOT NULL AS with_operator_stats, CASE WHEN q.query_no % 3 = 0 THEN 'eligible' END AS estimate FROM query_log AS q LEFT JOIN st ON q.query_id = st.query_id""",
)
def _(t):
    rows = t.query_log.select("query_id", S.text_section({"platform.query.with_operator_stats": F.lit("false")}).alias("attributes"))
    analysed = CQ.to_analyse(t.query_log, slow_ms=100_000)
    operators = t.operator_rows.withColumn("share", c("share_points") / 1024)
    stats = CQ.span_events(operators, analysed)
    estimates = t.query_log.filter("query_no % 3 = 0").select(
        "query_id", S.text_section({"platform.query.accel_est.status": F.lit("eligible")}).alias("attributes")
    )
    out = CQ.recent_queries(rows, stats, estimates)
    return out.select(
        "query_id",
        F.when(c("query_operator_stats").isNotNull(), F.size("query_operator_stats")).cast("bigint").alias("n_operators"),
        (c("attributes")["platform.query.with_operator_stats"] == "true").alias("with_operator_stats"),
        F.try_element_at("attributes", F.lit("platform.query.accel_est.status")).alias("estimate"),
    )


@query(
    "c1_acceleration_candidates",
    """SELECT query_uuid AS query_id, execution_time FROM query_log WHERE execution_time > 100000 AND bytes_spilled_local = 0 AND bytes_spilled_remote = 0 AND partitions_scanned * 10 < partitions_total * 9
       AND regexp_full_match(query_uuid, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')""",
)
def _(t):
    rows = t.query_log.withColumn("query_id", c("query_uuid"))
    return CQ.to_estimate(rows, slow_ms=100_000).select("query_id", "execution_time")


ACTIVE_SQL = """
WITH r AS (SELECT * REPLACE (TIMESTAMP '2001-08-02 00:00:00' AS end_time, CASE WHEN execution_status <> 'RUNNING' THEN rows_written_to_result END AS rows_written_to_result),
    CASE WHEN execution_status = 'RUNNING' THEN greatest(epoch_us(TIMESTAMP '2001-08-02 00:00:00') // 1000 - epoch_us(start_time) // 1000, 0) END AS running_time FROM src_history WHERE execution_status = 'RUNNING'),
  f AS (SELECT *, NULL AS running_time FROM src_history WHERE execution_status <> 'RUNNING' AND end_time >= TIMESTAMP '2001-05-31 23:59:00'),
  a AS (SELECT * REPLACE (CASE WHEN execution_status NOT IN ('RUNNING', 'QUEUED') THEN total_elapsed_time END AS total_elapsed_time,
    CASE WHEN execution_status NOT IN ('RUNNING', 'QUEUED') THEN execution_time END AS execution_time) FROM (SELECT * FROM r UNION ALL SELECT * FROM f) WHERE execution_status IN ('RUNNING', 'FAIL'))
"""


@query("c2_active_queries", ACTIVE_SQL + spec_sql(CQ.ACTIVE_QUERIES, "a", COLUMNS["src_history"] + ["running_time"], ("query_id",)))
def _(t):
    running = t.src_history.filter("execution_status = 'RUNNING'")
    finished = t.src_history.filter("execution_status <> 'RUNNING'")
    out = CQ.active_queries(
        running, finished, QUERY_AS_OF, mark=dt.datetime(2001, 6, 1), fast_mode=False, statuses=["RUNNING", "FAIL"], hours=87600
    )
    return shown(out, "query_id")


# --- event log -----------------------------------------------------------------------------


def event_table(t):
    """The event table with its open parts as maps."""
    e = t.event_log
    return e.select(
        "event_id",
        c("ts").alias("timestamp"),
        c("start_ts").alias("start_timestamp"),
        c("ts").alias("observed_timestamp"),
        "record_type",
        F.when(c("record_type") == "METRIC", c("amount").cast("string")).otherwise(c("value_text")).alias("value"),
        S.text_section(
            {
                "severity_text": c("severity"),
                "metric.name": c("metric_name"),
                "metric.unit": F.lit("ms"),
                "status.code": c("span_status"),
                "parent_span_id": c("parent_span_id"),
                "kind": F.lit("SPAN_KIND_INTERNAL"),
            }
        ).alias("record"),
        F.when(c("k") % 3 != 0, S.text_section({"part": c("metric_type")})).alias("record_attributes"),
        S.text_section(
            {
                "snow.database.name": c("database_name"),
                "application": c("application"),
                "snow.query.id": c("query_id"),
                "snow.executable.name": F.concat(F.lit("proc_"), (c("user_id") % 5).cast("string")),
            }
        ).alias("resource_attributes"),
        S.text_section({"name": c("scope_name")}).alias("scope"),
        S.text_section({"trace_id": c("trace_id"), "span_id": c("span_id")}).alias("trace"),
    )


SCOPE_SQL = r"""coalesce(database_name, '') LIKE ANY_SCOPE AND (coalesce(database_name, '') NOT LIKE 'SELF%\_DB' ESCAPE '\' OR coalesce(database_name, '') = 'SELF_DB' OR CROSS_TENANT)
  AND (application IS NULL OR application NOT IN ('openflow')) AND ts > TIMESTAMP '2024-01-03 00:00:00'"""


def scope_sql(pattern: str = "%", cross: str = "true") -> str:
    return SCOPE_SQL.replace("ANY_SCOPE", f"'{pattern}'").replace("CROSS_TENANT", cross)


MARK = dt.datetime(2024, 1, 3)


@query(
    "c3_event_log",
    r"""WITH kept AS (SELECT * FROM event_log WHERE """
    + scope_sql()
    + r""" AND NOT regexp_full_match(scope_name, 'SELF(_\S*)?_OTLP') AND value_text NOT LIKE 'Sent log%Sent log%' AND record_type NOT IN ('METRIC', 'SPAN')
        AND (coalesce(database_name, '') NOT LIKE 'SELF%\_DB' ESCAPE '\' OR severity NOT IN ('DEBUG', 'INFO')))
      SELECT event_id, epoch_us(ts) * 1000 AS timestamp_ns, severity AS level,
        CASE WHEN value_text LIKE '"%' THEN regexp_replace(value_text, '^"(.+[^"])"?$', '\1') ELSE regexp_replace(value_text, '^(.+[^"])"?$', '\1') END AS content,
        CASE WHEN value_text LIKE '{%' THEN k::VARCHAR END AS a, scope_name AS scope, record_type, application FROM kept""",
)
def _(t):
    out = CE.event_log(event_table(t), EVENT_AS_OF, MARK, hours=10_000)

    def member(key):
        return F.try_element_at("attributes", F.lit(key))

    return out.select(
        "event_id", "timestamp_ns", "level", "content", member("a").alias("a"), member("platform.event.scope.name").alias("scope"),
        member("record_type").alias("record_type"), member("application").alias("application"),
    )


METRIC_KEPT_SQL = f"WITH kept AS (SELECT * FROM event_log WHERE record_type = 'METRIC' AND {scope_sql()})"


@query(
    "c4_event_log_metrics",
    METRIC_KEPT_SQL
    + """ SELECT epoch_us(ts) * 1000 AS timestamp_ns, epoch_us(ts) * 1000 AS start_time, metric_name || '=' || amount::VARCHAR AS metrics, '' AS attributes, '' AS event_timestamps,
       concat_ws(';', CASE WHEN application IS NOT NULL THEN 'application=' || application END, CASE WHEN database_name IS NOT NULL THEN 'db.namespace=' || database_name END,
         CASE WHEN application IS NOT NULL AND k % 3 <> 0 THEN application || '.part=' || metric_type END, CASE WHEN application IS NULL AND k % 3 <> 0 THEN 'part=' || metric_type END, 'platform.query.id=' || query_id, CASE WHEN database_name IS NOT NULL THEN 'snow.database.name=' || database_name END,
         'snow.executable.name=proc_' || (user_id % 5)::VARCHAR, 'snow.query.id=' || query_id) AS dimensions FROM kept""",
)
def _(t):
    return shown(CE.event_log_metrics(event_table(t), EVENT_AS_OF, MARK, hours=10_000))


@query(
    "c4_metric_definitions",
    "SELECT DISTINCT metric_name AS metric, 'Platform metric: ' || metric_name AS local_name, 'ms' AS local_unit FROM event_log WHERE record_type = 'METRIC'",
)
def _(t):
    return CE.metric_definitions(event_table(t))


@query(
    "c5_event_log_spans",
    f"""WITH kept AS (SELECT * FROM event_log WHERE record_type = 'SPAN' AND {scope_sql('S%', 'false')})
       SELECT event_id, query_id, 'proc_' || (user_id % 5)::VARCHAR AS name, epoch_us(start_ts) * 1000 AS start_time, epoch_us(ts) * 1000 AS end_time,
       CASE span_status WHEN 'STATUS_CODE_ERROR' THEN 'ERROR' WHEN 'STATUS_CODE_UNSET' THEN 'UNSET' ELSE 'OK' END AS status_code, span_id, trace_id, parent_span_id, parent_span_id IS NULL AS is_root,
       database_name AS namespace FROM kept""",
)
def _(t):
    out = CE.event_log_spans(event_table(t), EVENT_AS_OF, MARK, hours=10_000, databases=["S%"], cross_tenant=False)
    return out.select(
        "event_id", "query_id", "name", "start_time", "end_time", "status_code", "span_id", "trace_id", "parent_span_id", "is_root",
        F.try_element_at("dimensions", F.lit("db.namespace")).alias("namespace"),
    )


# --- tables --------------------------------------------------------------------------------

source(
    "src_tables",
    "inventory",
    {"table_catalog": "database_name", "table_schema": "schema_name", "deleted": "deleted_on"}
    | same("table_name", "table_type", "row_count", "bytes", "last_altered", "last_ddl"),
)
VOLUME_SQL = rf"""
WITH v AS (SELECT *, table_catalog || '.' || table_schema || '.' || table_name AS full_name, {RUN_AT}, epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 60000000 - epoch_us(last_altered) // 60000000 AS minutes_since_update,
  epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 60000000 - epoch_us(last_ddl) // 60000000 AS minutes_since_ddl FROM src_tables WHERE deleted IS NULL AND table_type <> 'VIEW'),
k AS (SELECT * FROM v WHERE full_name LIKE 'Brand\_1%' ESCAPE '\' AND full_name NOT LIKE '%bolt%')
"""


@query(
    "c6_data_volume",
    VOLUME_SQL + spec_sql(CT.DATA_VOLUME, "k", COLUMNS["src_tables"] + ["full_name", "run_at", "minutes_since_update", "minutes_since_ddl"]),
)
def _(t):
    return shown(CT.data_volume(t.src_tables, EVENT_AS_OF, ["Brand\\_1%"], ["%bolt%"]))


source(
    "src_changes",
    "ddl_events",
    same("query_id", "user_name", "object_domain", "object_name", "properties") | {"query_start_time": "ts", "operation_type": "operation"},
)
SCHEMA_SQL = """
WITH k AS (SELECT * FROM src_changes WHERE object_domain IN ('Table', 'Schema', 'Database') AND query_start_time > TIMESTAMP '1999-01-01 00:00:00' AND object_name LIKE 'DB_1%'),
l AS (SELECT query_id, object_name, object_domain, string_agg(column_name, ', ' ORDER BY column_name) AS cols FROM ddl_columns WHERE query_id IN (SELECT query_id FROM k) GROUP BY ALL),
j AS (SELECT k.* EXCLUDE (properties), '{"' || l.object_name || '":{"objectDomain":"' || l.object_domain || '","objectColumns":"' || l.cols || '"}}' AS object_modified,
  '{"columns":{"ADD":["C' || regexp_extract(properties, '"C([0-9])"', 1) || '","E"],"DROP":["D' || regexp_extract(properties, '"D([0-9])"', 1) || '"]}}' AS properties
  FROM k LEFT JOIN l ON k.query_id = l.query_id)
"""


@query("c7_data_schemas", SCHEMA_SQL + spec_sql(CT.DATA_SCHEMAS, "j", COLUMNS["src_changes"] + ["object_modified"], ("query_id",)))
def _(t):
    return shown(CT.data_schemas(t.src_changes, t.ddl_columns, QUERY_AS_OF, dt.datetime(1999, 1, 1), ["DB_1%"], hours=876_000), "query_id")


source(
    "src_dynamic",
    "dynamic_tables",
    {
        "name": "table_name", "qualified_name": "full_name", "target_lag_type": "lag_type", "target_lag_sec": "target_lag", "mean_lag_sec": "mean_lag",
        "maximum_lag_sec": "max_lag", "time_above_target_lag_sec": "time_above", "latest_data_timestamp": "ts", "query_text": "'select 1'", "valid_from": "ts",
        "valid_to": "CASE WHEN row_no % 4 = 0 THEN ts ELSE NULL END",
    }
    | same("schema_name", "database_name", "scheduling_state", "suspended_on", "row_no"),
)
DYNAMIC_KEPT = rf"WITH k AS (SELECT *, {RUN_AT} FROM src_dynamic WHERE (qualified_name LIKE '%.ECONOMY.%' OR qualified_name LIKE '%.SMALL.%') AND qualified_name NOT LIKE '%DT\_1%' ESCAPE '\')"
DYNAMIC_IN, DYNAMIC_OUT = ["%.ECONOMY.%", "%.SMALL.%"], ["%DT\\_1%"]


@query("c8_dynamic_tables", DYNAMIC_KEPT + spec_sql(CT.DYNAMIC_TABLES, "k", COLUMNS["src_dynamic"] + ["run_at"]))
def _(t):
    return shown(CT.dynamic_tables(t.src_dynamic, EVENT_AS_OF, DYNAMIC_IN, DYNAMIC_OUT))


source(
    "src_refreshes",
    "dynamic_refreshes",
    {
        "name": "table_name", "qualified_name": "full_name", "refresh_start_time": "refresh_start", "refresh_end_time": "refresh_end", "num_inserted_rows": "inserted_rows",
        "num_deleted_rows": "deleted_rows", "num_copied_rows": "copied_rows", "num_added_partitions": "added_partitions",
    }
    | same("row_no", "schema_name", "database_name", "data_timestamp", "state", "state_code", "refresh_action", "refresh_trigger"),
)


@query(
    "c9_dynamic_table_refresh_history",
    r"WITH k AS (SELECT * FROM src_refreshes WHERE data_timestamp > TIMESTAMP '1998-01-01 00:00:00' AND qualified_name LIKE '%.ECONOMY.%' AND qualified_name NOT LIKE '%DT\_1%' ESCAPE '\')"
    + spec_sql(CT.DYNAMIC_TABLE_REFRESH, "k", COLUMNS["src_refreshes"]),
)
def _(t):
    return shown(CT.dynamic_table_refresh_history(t.src_refreshes, QUERY_AS_OF, dt.datetime(1998, 1, 1), DYNAMIC_IN, DYNAMIC_OUT, hours=876_000))


@query(
    "c10_dynamic_table_graph_history",
    DYNAMIC_KEPT.replace("WHERE", "WHERE (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-01 06:00:00') AND")
    + spec_sql(CT.DYNAMIC_TABLE_GRAPH, "k", COLUMNS["src_dynamic"] + ["run_at"]),
)
def _(t):
    return shown(CT.dynamic_table_graph_history(t.src_dynamic, EVENT_AS_OF, dt.datetime(2024, 1, 1, 6), DYNAMIC_IN, DYNAMIC_OUT))


# --- usage, logins, sessions ---------------------------------------------------------------

source("src_event_usage", "event_rows", {"start_time": "ts", "end_time": "ts + INTERVAL '1' HOUR", "credits_used": "k", "bytes_ingested": "amount", "event_id": "event_id"})


@query(
    "c11_event_usage",
    spec_sql(CE.EVENT_USAGE, "src_event_usage WHERE end_time > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 500 HOUR", COLUMNS["src_event_usage"]),
)
def _(t):
    return shown(CE.event_usage(t.src_event_usage, EVENT_AS_OF, None, hours=500))


source(
    "src_logins",
    "login_log",
    {
        "event_timestamp": "ts", "event_type": "event_name", "reported_client_type": "client_type", "first_authentication_factor": "first_factor",
        "second_authentication_factor": "second_factor",
    }
    | same("event_id", "user_name", "client_ip", "is_success", "error_code", "error_message"),
)


@query(
    "c12_login_history",
    "WITH k AS (SELECT * FROM src_logins WHERE event_timestamp > TIMESTAMP '2024-01-02 12:00:00')"
    + spec_sql(CE.LOGIN_HISTORY, "k", COLUMNS["src_logins"], ("event_id",)),
)
def _(t):
    return shown(CE.login_history(t.src_logins, EVENT_AS_OF, dt.datetime(2024, 1, 2, 12), hours=10_000), "event_id")


@query(
    "c13_sessions",
    "WITH k AS (SELECT *, 'U' || session_id::VARCHAR AS user_name FROM src_sessions WHERE created_on > TIMESTAMP '2001-07-20 00:00:00')"
    + spec_sql(CE.SESSIONS, "k", COLUMNS["src_sessions"] + ["user_name"], ("session_id",)),
)
def _(t):
    rows = t.src_sessions.withColumn("user_name", F.concat(F.lit("U"), c("session_id").cast("string")))
    return shown(CE.sessions(rows, QUERY_AS_OF, dt.datetime(2001, 7, 20), hours=10_000), "session_id")


# --- monitors and warehouses ---------------------------------------------------------------

MONITOR_SQL = f"""
WITH m AS (SELECT m.*, w.name AS warehouse FROM monitors AS m FULL JOIN warehouses AS w ON w.resource_monitor = m.name OR ((w.resource_monitor IS NULL OR w.resource_monitor = 'null') AND m.level = 'ACCOUNT')),
g AS (SELECT name, level, frequency, credit_quota, used_credits, remaining_credits, start_time, end_time, created_on, coalesce(list(warehouse ORDER BY warehouse) FILTER (WHERE warehouse IS NOT NULL), []) AS whs FROM m GROUP BY ALL),
k AS (SELECT *, {RUN_AT}, coalesce(level = 'ACCOUNT', false) AS is_account_level, coalesce(level = 'ACCOUNT', false) OR len(whs) > 0 AS is_active,
  CASE WHEN coalesce(level = 'ACCOUNT', false) OR len(whs) > 0 THEN whs END AS active_warehouses, len(whs) AS n_warehouses, CASE WHEN credit_quota > 0 THEN 100.0::DOUBLE * used_credits / credit_quota ELSE 0 END AS used_pct FROM g)
"""
MONITOR_COLUMNS = ["name", "level", "frequency", "credit_quota", "used_credits", "remaining_credits", "start_time", "end_time", "created_on", "run_at", "is_active", "active_warehouses", "n_warehouses", "used_pct"]


@query("c14_resource_monitors", MONITOR_SQL + spec_sql(CW.RESOURCE_MONITORS, "k", MONITOR_COLUMNS, ("is_account_level", "is_active"), ("active_warehouses",)))
def _(t):
    return shown(CW.resource_monitors(t.monitors, t.warehouses, EVENT_AS_OF), "is_account_level", "is_active")


@query("c14_monitor_warnings", "SELECT 'There is no account-level resource monitor' AS content, 'ERROR' AS level FROM (SELECT 1) WHERE NOT EXISTS (SELECT 1 FROM monitors WHERE level = 'ACCOUNT')")
def _(t):
    return CW.monitor_warnings(t.monitors)


source(
    "src_warehouses",
    "warehouses",
    {"min_cluster_count": "min_clusters", "max_cluster_count": "max_clusters"}
    | same("name", "resource_monitor", "state", "size", "scaling_policy", "started_clusters", "running", "queued", "auto_resume", "created_on"),
)
WAREHOUSE_SQL = f"""
WITH k AS (SELECT w.*, (w.resource_monitor IS NULL OR w.resource_monitor = 'null') AS is_unmonitored, {RUN_AT}, m.name AS monitor_name, m.level AS monitor_level, m.frequency AS monitor_frequency,
  m.credit_quota AS monitor_credit_quota, m.used_credits AS monitor_used_credits, m.remaining_credits AS monitor_remaining_credits FROM src_warehouses AS w
  LEFT JOIN monitors AS m ON w.resource_monitor = m.name OR ((w.resource_monitor IS NULL OR w.resource_monitor = 'null') AND m.level = 'ACCOUNT'))
"""
WAREHOUSE_COLUMNS = COLUMNS["src_warehouses"] + ["is_unmonitored", "run_at", "monitor_name", "monitor_level", "monitor_frequency", "monitor_credit_quota", "monitor_used_credits", "monitor_remaining_credits"]


@query("c15_warehouses", WAREHOUSE_SQL + spec_sql(CW.WAREHOUSES, "k", WAREHOUSE_COLUMNS, ("is_unmonitored",)))
def _(t):
    return shown(CW.warehouses(t.src_warehouses, t.monitors, EVENT_AS_OF), "is_unmonitored")


@query("c15_warehouse_warnings", "SELECT 'Warehouse ' || name || ' does not have a resource monitor' AS content, 'WARNING' AS level FROM warehouses WHERE resource_monitor IS NULL OR resource_monitor = 'null'")
def _(t):
    return CW.warehouse_warnings(CW.warehouses(t.src_warehouses, t.monitors, EVENT_AS_OF))


source("src_warehouse_events", "warehouse_events", {"timestamp": "ts"} | same("event_id", "warehouse_name", "event_name", "event_state", "cluster_number", "event_reason", "user_name", "warehouse_id"))
SINCE_TEN_DAYS = "TIMESTAMP '2024-01-21 00:00:00'"


@query("c16_warehouse_usage", spec_sql(CW.WAREHOUSE_EVENTS, f"src_warehouse_events WHERE timestamp > {SINCE_TEN_DAYS}", COLUMNS["src_warehouse_events"]))
def _(t):
    return shown(CW.warehouse_usage(t.src_warehouse_events, EVENT_AS_OF, None, hours=240))


source(
    "src_warehouse_load",
    "warehouse_load",
    {"avg_queued_load": "avg_queued", "avg_queued_provisioning": "avg_provisioning"} | same("start_time", "end_time", "warehouse_name", "warehouse_id", "avg_running", "avg_blocked"),
)


@query("c17_warehouse_usage_load", spec_sql(CW.WAREHOUSE_LOAD, "src_warehouse_load WHERE start_time > TIMESTAMP '1999-06-01 00:00:00'", COLUMNS["src_warehouse_load"]))
def _(t):
    return shown(CW.warehouse_usage_load(t.src_warehouse_load, QUERY_AS_OF, dt.datetime(1999, 6, 1), hours=876_000))


source(
    "src_metering",
    "warehouse_metering",
    {"credits_used_compute": "credits_compute", "credits_used_cloud_services": "credits_cloud"} | same("start_time", "end_time", "warehouse_name", "warehouse_id", "credits_used"),
)


@query("c18_warehouse_usage_metering", spec_sql(CW.WAREHOUSE_METERING, "src_metering WHERE start_time > TIMESTAMP '1997-06-01 00:00:00'", COLUMNS["src_metering"]))
def _(t):
    return shown(CW.warehouse_usage_metering(t.src_metering, QUERY_AS_OF, dt.datetime(1997, 6, 1), hours=876_000))


@query(
    "c19_budgets",
    """WITH r AS (SELECT budget_name, list(DISTINCT {'name': resource_name, 'domain': resource_domain}) AS linked FROM budget_resources GROUP BY budget_name),
       k AS (SELECT b.*, list_sort(r.linked) AS linked_resources, l.credit_limit FROM budgets AS b LEFT JOIN r ON b.name = r.budget_name LEFT JOIN budget_limits AS l ON b.name = l.budget_name)"""
    + spec_sql(CW.BUDGETS, "k", ["name", "database_name", "schema_name", "owner", "owner_role_type", "created_on", "linked_resources", "credit_limit"], (), ("linked_resources",)),
)
def _(t):
    return shown(CW.budgets(t.budgets, t.budget_resources, t.budget_limits))


source("src_spend", "budget_spend", {"measurement_date": "measured_on"} | same("spend_id", "budget_name", "service_type", "credits_spent"))


@query(
    "c20_spendings",
    "WITH k AS (SELECT s.*, b.database_name, b.schema_name FROM src_spend AS s JOIN budgets AS b ON s.budget_name = b.name WHERE measurement_date::DATE >= DATE '1996-03-01')"
    + spec_sql(CW.SPENDINGS, "k", COLUMNS["src_spend"] + ["database_name", "schema_name"]),
)
def _(t):
    return shown(CW.spendings(t.src_spend, t.budgets, QUERY_AS_OF, dt.datetime(1996, 3, 1, 10), hours=876_000))


# --- shares --------------------------------------------------------------------------------

SHARE_ROWS = f"""sh AS (SELECT name AS share_name, * EXCLUDE (name), {RUN_AT}, TRY_CAST(secure_objects_only AS BOOLEAN) AS is_secure FROM shares)"""
SHARE_COLUMNS = ["share_name", "kind", "database_name", "owner_account", "given_to", "owner", "comment", "is_secure", "created_on", "run_at"]
source("src_share_grants", "share_grants", {"name": "grant_name", "grantee_name": "grantee"} | same("share_name", "privilege", "granted_on", "granted_to", "granted_by", "created_on"))


@query(
    "c21_outbound_shares",
    f"WITH {SHARE_ROWS}, k AS (SELECT sh.*, g.name AS grant_name, g.privilege, g.granted_on, g.granted_to, g.grantee_name, g.granted_by, g.created_on AS grant_created_on FROM sh LEFT JOIN src_share_grants AS g ON sh.share_name = g.share_name WHERE kind = 'OUTBOUND')"
    + spec_sql(CW.OUTBOUND_SHARES, "k", SHARE_COLUMNS + ["grant_name", "privilege", "granted_on", "granted_to", "grantee_name", "granted_by", "grant_created_on"]),
)
def _(t):
    return shown(CW.outbound_shares(t.shares, t.src_share_grants, EVENT_AS_OF))


source("src_share_tables", "share_tables", same("share_name", "table_schema", "table_name", "share_status", "row_count", "bytes", "error_message"))


@query(
    "c22_inbound_shares",
    f"""WITH {SHARE_ROWS}, inc AS (SELECT *, coalesce(NOT (database_name || '.%.%' LIKE 'DB_2%') AND database_name || '.%.%' LIKE 'DB_1%' AND share_name LIKE 'SH\\_%5' ESCAPE '\\', false) AS out FROM sh WHERE kind = 'INBOUND'),
       k AS (SELECT inc.*, t.table_schema, t.table_name, t.share_status, t.row_count, t.bytes, t.error_message, CASE WHEN out THEN false ELSE CASE WHEN t.share_name IS NOT NULL THEN coalesce(t.share_status <> 'UNAVAILABLE', true) END END AS is_reported
         FROM inc LEFT JOIN src_share_tables AS t ON inc.share_name = t.share_name AND NOT out)"""
    + spec_sql(CW.INBOUND_SHARES, "k", SHARE_COLUMNS + COLUMNS["src_share_tables"] + ["is_reported"]),
)
def _(t):
    out = CW.inbound_shares(t.shares, t.src_share_tables, EVENT_AS_OF, include=["DB_2%"], exclude=["DB_1%"], exclude_from_monitoring=["SH\\_%5"])
    return shown(out)


@query("c23_shares", f"WITH {SHARE_ROWS}" + spec_sql(CW.SHARE_EVENTS, "sh", SHARE_COLUMNS))
def _(t):
    return shown(CW.share_events(t.shares, EVENT_AS_OF))


# --- pipes and tasks -----------------------------------------------------------------------

PIPE_SQL = rf"""
WITH k AS (SELECT *, {RUN_AT}, CASE WHEN status_json IS NULL THEN 'UNKNOWN' ELSE json_extract_string(status_json, '$.executionState') END AS execution_state,
  coalesce(TRY_CAST(json_extract_string(status_json, '$.pendingFileCount') AS BIGINT), 0) AS pending_files, json_extract_string(status_json, '$.oldestFileTimestamp') AS oldest_file_timestamp,
  (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(TRY_CAST(replace(json_extract_string(status_json, '$.oldestFileTimestamp'), 'Z', '') AS TIMESTAMP))) // 1000 AS oldest_file_latency_ms,
  split_part(nullif(regexp_extract(definition, 'INTO\s+(\S+)', 1, 'i'), ''), '.', -1) AS target_table FROM pipes WHERE full_name NOT LIKE '%7')
"""


@query(
    "c24_pipes",
    PIPE_SQL
    + spec_sql(CT.PIPES, "k", ["pipe_name", "full_name", "database_name", "schema_name", "definition", "owner", "created_on", "run_at", "execution_state", "pending_files", "oldest_file_timestamp", "oldest_file_latency_ms", "target_table"]),
)
def _(t):
    return shown(CT.pipes(t.pipes, EVENT_AS_OF, ["%"], ["%7"]))


source(
    "src_copies",
    "copy_history",
    {
        "pipe_name": "pipe_or_null", "pipe_catalog_name": "database_name", "pipe_schema_name": "schema_name", "table_catalog_name": "database_name", "table_schema_name": "schema_name",
        "last_load_time": "loaded_at", "pipe_received_time": "received_at",
    }
    | same("load_id", "table_name", "file_name", "status", "row_count", "row_parsed", "error_count", "file_size"),
)


@query(
    "c25_pipe_copy_history",
    "WITH k AS (SELECT *, (epoch_us(last_load_time) - epoch_us(pipe_received_time)) // 1000 AS latency_ms FROM src_copies WHERE pipe_name IS NOT NULL AND last_load_time >= TIMESTAMP '1997-01-01 00:00:00')"
    + spec_sql(CT.COPY_HISTORY, "k", COLUMNS["src_copies"] + ["latency_ms"]),
)
def _(t):
    return shown(CT.copy_history(t.src_copies, QUERY_AS_OF, dt.datetime(1997, 1, 1), hours=876_000))


@query(
    "c26_pipe_usage_history",
    """WITH k AS (SELECT u.* EXCLUDE (files_inserted), files_inserted::BIGINT AS files_inserted, p.full_name AS resolved_full_name, split_part(coalesce(p.full_name, ''), '.', 1) AS resolved_database,
       split_part(coalesce(p.full_name, ''), '.', 2) AS resolved_schema, coalesce(p.pipe_name, u.pipe_name) AS resolved_name FROM pipe_usage AS u LEFT JOIN pipes AS p ON u.pipe_id = p.pipe_id WHERE end_time >= TIMESTAMP '1996-01-01 00:00:00')"""
    + spec_sql(CT.PIPE_USAGE, "k", ["pipe_name", "start_time", "end_time", "credits_used", "bytes_billed", "files_inserted", "resolved_full_name", "resolved_database", "resolved_schema", "resolved_name"]),
)
def _(t):
    return shown(CT.pipe_usage_history(t.pipe_usage, t.pipes, QUERY_AS_OF, dt.datetime(1996, 1, 1), hours=876_000))


@query("c27_serverless_tasks", spec_sql(CT.SERVERLESS_TASKS, "serverless_tasks WHERE end_time > TIMESTAMP '1996-01-01 00:00:00'", ["row_no", "task_name", "schema_name", "database_name", "start_time", "end_time", "credits_used"]))
def _(t):
    return shown(CT.serverless_tasks(t.serverless_tasks, QUERY_AS_OF, dt.datetime(1996, 1, 1), hours=876_000))


source("src_task_history", "task_history", {"name": "task_name", "attempt_number": "attempt"} | same("event_id", "database_name", "schema_name", "state", "query_start_time", "scheduled_time", "completed_time", "error_code"))


@query(
    "c28_task_history",
    spec_sql(CT.TASK_HISTORY, "src_task_history WHERE greatest(query_start_time, scheduled_time, completed_time) > TIMESTAMP '2024-01-08 00:00:00'", COLUMNS["src_task_history"]),
)
def _(t):
    return shown(CT.task_history(t.src_task_history, dt.datetime(2024, 1, 8)))


source(
    "src_task_versions",
    "task_versions",
    {"name": "task_name", "graph_version_created_on": "created_on", "last_committed_on": "committed_on", "last_suspended_on": "suspended_on"}
    | same("row_no", "schema_name", "database_name", "definition", "graph_version"),
)


@query(
    "c29_task_versions",
    spec_sql(CT.TASK_VERSIONS, "src_task_versions WHERE greatest(graph_version_created_on, last_committed_on, last_suspended_on) > TIMESTAMP '2024-01-02 05:00:00'", COLUMNS["src_task_versions"]),
)
def _(t):
    return shown(CT.task_versions(t.src_task_versions, EVENT_AS_OF, dt.datetime(2024, 1, 2, 5)))


# --- security ------------------------------------------------------------------------------

source(
    "src_findings",
    "scanner_findings",
    {
        "scanner_short_description": "'checks ' || scanner_id", "scanner_package_id": "package_id", "scanner_package_name": "'Package ' || package_id", "total_at_risk_count": "at_risk_count",
        "start_timestamp": "started_at", "end_timestamp": "ended_at", "created_on": "ended_at",
    }
    | same("event_id", "scanner_id", "scanner_name", "severity", "completion_status", "scanner_type", "at_risk_entities"),
)
LATEST_SQL = """lat AS (SELECT f.* FROM src_findings AS f JOIN (SELECT scanner_id, max(start_timestamp) AS m FROM src_findings GROUP BY scanner_id) AS x ON f.scanner_id = x.scanner_id AND f.start_timestamp = x.m)"""
FINDING_COLUMNS = COLUMNS["src_findings"] + ["entity_id", "entity_name"]


@query(
    "c30_trust_center",
    f"""WITH {LATEST_SQL}, u AS (SELECT *, unnest(CASE WHEN at_risk_entities = '[]' THEN [NULL::STRUCT(entity_id VARCHAR, entity_name VARCHAR)] ELSE from_json(at_risk_entities, '[{{"entity_id":"VARCHAR","entity_name":"VARCHAR"}}]') END) AS e FROM lat),
       k AS (SELECT *, e.entity_id AS entity_id, e.entity_name AS entity_name FROM u)"""
    + spec_sql(CS.FINDINGS, "k", FINDING_COLUMNS, ("event_id", "CASE severity WHEN 'CRITICAL' THEN 'CRITICAL' WHEN 'HIGH' THEN 'ERROR' WHEN 'MEDIUM' THEN 'WARNING' ELSE 'INFO' END AS level")),
)
def _(t):
    return shown(CS.trust_center(t.src_findings, log_details=True), "event_id", "level")


@query("c30_trust_center_plain", f"WITH {LATEST_SQL}" + spec_sql(CS.FINDINGS, "lat", COLUMNS["src_findings"], ("event_id",)))
def _(t):
    return shown(CS.trust_center(t.src_findings), "event_id")


@query("c31_trust_center_metrics", f"WITH {LATEST_SQL}, k AS (SELECT *, {RUN_AT} FROM lat)" + spec_sql(CS.FINDING_METRICS, "k", COLUMNS["src_findings"] + ["run_at"], ("event_id",)))
def _(t):
    return shown(CS.trust_center_metrics(t.src_findings, EVENT_AS_OF), "event_id")


source(
    "src_users",
    "user_snapshot",
    {"disabled": "is_disabled", "locked": "is_locked", "has_rsa_public_key": "has_rsa", "type": "user_type"}
    | same("user_id", "login_name", "email", "default_role", "has_password", "has_mfa", "has_pat", "owner", "created_on", "deleted_on"),
)
USER_SQL = f"""
WITH ch AS (SELECT user_id, login_name, default_role FROM src_users WHERE deleted_on IS NULL OR deleted_on > TIMESTAMP '2024-01-15 00:00:00' EXCEPT SELECT user_id, login_name, default_role FROM user_seen),
lg AS (SELECT user_name, max(ts) AS last_success_login FROM login_log WHERE event_name = 'LOGIN' AND is_success = 'YES' GROUP BY user_name),
k AS (SELECT u.*, sha256(email) AS reported_email, {RUN_AT}, lg.last_success_login FROM src_users AS u LEFT JOIN lg ON lg.user_name = u.login_name
  WHERE (deleted_on IS NULL OR deleted_on > TIMESTAMP '2024-01-15 00:00:00') AND user_id IN (SELECT user_id FROM ch))
"""


@query("c32_users", USER_SQL + spec_sql(CS.USERS, "k", COLUMNS["src_users"] + ["reported_email", "run_at", "last_success_login"], ("user_id",)))
def _(t):
    return shown(CS.users(t.src_users, t.user_seen, t.login_log, EVENT_AS_OF, dt.datetime(2024, 1, 15)), "user_id")


NOW_NS = "1706659200000000000"


def grant_rows_sql(ctes: str, rows: str, attributes: str, times: str, message: str = "NULL::VARCHAR") -> str:
    return f"""{ctes} SELECT {NOW_NS} AS timestamp_ns, {NOW_NS} AS start_time, {message} AS message, concat_ws(';', 'db.user=' || user_name) AS dimensions, {attributes} AS attributes, '' AS metrics, {times} AS event_timestamps FROM {rows}"""


@query(
    "c33_users_direct_roles",
    grant_rows_sql(
        "WITH g AS (SELECT user_name, list(role ORDER BY role) AS r, list(granted_by ORDER BY granted_by) AS b, max(created_on) AS m FROM user_grants WHERE deleted_on IS NULL GROUP BY user_name)",
        "g", "'platform.user.roles.direct=' || to_json(r) || ';platform.user.roles.granted_by=' || to_json(b)", "'platform.user.roles.last_altered=' || (epoch_us(m) * 1000)::VARCHAR",
    ),
)
def _(t):
    return shown(CS.users_direct_roles(t.user_grants, EVENT_AS_OF, dt.datetime(2024, 1, 20)))


@query(
    "c34_users_removed_direct_roles",
    grant_rows_sql(
        "WITH g AS (SELECT user_name, date_trunc('hour', deleted_on) AS h, string_agg(role, '' ORDER BY role) AS r FROM user_grants WHERE deleted_on > TIMESTAMP '2024-01-10 00:00:00' GROUP BY ALL)",
        "g", "'platform.user.roles.direct.removed=' || r", "'platform.user.roles.direct.removed_on=' || (epoch_us(h) * 1000)::VARCHAR", "'User direct roles removed since 2024-01-10 00:00:00'",
    ),
)
def _(t):
    return shown(CS.users_removed_direct_roles(t.user_grants, EVENT_AS_OF, dt.datetime(2024, 1, 10)))


from sparkgauge.catalog.joining import CLOSURE_SQL, PRIVILEGE_SQL  # noqa: E402


@query(
    "c35_users_all_roles",
    grant_rows_sql(
        CLOSURE_SQL
        + ", g AS (SELECT u.user_name, coalesce(string_agg(DISTINCT c.child, ',' ORDER BY c.child), '') AS r, list(DISTINCT granted_by ORDER BY granted_by) AS b, max(created_on) AS m FROM user_grants AS u LEFT JOIN closed AS c ON c.parent = u.role WHERE deleted_on IS NULL GROUP BY u.user_name)",
        "g", "'platform.user.roles.all=' || r || ';platform.user.roles.granted_by=' || to_json(b)", "'platform.user.roles.last_altered=' || (epoch_us(m) * 1000)::VARCHAR",
    ),
)
def _(t):
    return shown(CS.users_all_roles(t.user_grants, t.role_edges.filter("granted_on = 'ROLE'"), t.roles, EVENT_AS_OF))


@query(
    "c36_users_all_privileges",
    grant_rows_sql(
        PRIVILEGE_SQL
        + """, g AS (SELECT u.user_name, c.privilege, c.granted_on, coalesce(string_agg(DISTINCT c.child, ',' ORDER BY c.child), '') AS r, list(DISTINCT granted_by ORDER BY granted_by) AS b, max(created_on) AS m
          FROM user_grants AS u LEFT JOIN closed AS c ON c.parent = u.role WHERE deleted_on IS NULL GROUP BY ALL)""",
        "g", "concat_ws(';', 'platform.user.privilege=' || privilege || ':' || granted_on, 'platform.user.privilege.grants_on=' || r, 'platform.user.privilege.granted_by=' || to_json(b))",
        "'platform.user.privilege.last_altered=' || (epoch_us(m) * 1000)::VARCHAR",
    ),
)
def _(t):
    return shown(CS.users_all_privileges(t.user_grants, t.role_edges, t.roles, EVENT_AS_OF))


# --- custom sources ------------------------------------------------------------------------


def structured_objects(t):
    value = F.to_json(
        F.struct(
            (F.unix_micros("ts") * 1000).alias("TIMESTAMP"),
            F.concat(F.lit("event "), c("event_type")).alias("_MESSAGE"),
            F.create_map(F.lit("id"), c("event_id").cast("string")).alias("DIMENSIONS"),
            F.create_map(F.lit("k"), c("k")).alias("METRICS"),
            F.when(c("k") % 2 == 0, F.create_map(F.lit("seen"), F.unix_micros("ts") * 1000)).alias("EVENT_TIMESTAMPS"),
        )
    )
    rows = instrumented_from_json(t.event_rows.select(value.alias("value")))
    return rows.withColumn("event_id", c("dimensions")["id"])


@query(
    "c37_custom_source_structured",
    """SELECT 'entries' AS kind, count(*) AS n FROM event_rows UNION ALL SELECT 'log_lines', count(*) FROM event_rows UNION ALL SELECT 'metrics', count(*) FROM event_rows
       UNION ALL SELECT 'events', count(*) FROM event_rows WHERE k % 2 = 0
       UNION ALL SELECT kind, 0 FROM (VALUES ('spans'), ('span_events'), ('errors')) AS v(kind)""",
)
def _(t):
    return CU.structured_source(structured_objects(t), "event_id", CU.Switches()).counts()


def flat_objects(t):
    value = F.to_json(
        F.struct(
            (F.unix_micros("ts") * 1000).alias("timestamp"), F.when(c("k") % 2 == 0, F.concat(F.lit("event "), c("event_type"))).alias("_message"),
            c("event_id").alias("id"), c("account").alias("account"), F.when(c("event_type") == "error", F.lit("ERROR")).alias("status.code"),
        )
    )
    rows = flat_from_json(t.event_rows.select(value.alias("value")))
    return rows.withColumn("event_id", c("flat")["id"])


FLAT = CU.Switches(auto_mode=False, events=True, cloud_events=True, context="orders")


@query(
    "c37_custom_source_flat",
    """SELECT 'entries' AS kind, count(*) AS n FROM event_rows UNION ALL SELECT 'logs', count(*) FROM event_rows UNION ALL SELECT 'events', count(*) FROM event_rows
       UNION ALL SELECT 'cloud_events', count(*) FROM event_rows""",
)
def _(t):
    rows = flat_objects(t)
    outputs = CU.flat_source(rows, "event_id", FLAT, now=F.lit(EVENT_AS_OF).cast("timestamp"), run_id="r1")
    return CU.source_counts(outputs, rows)


@query(
    "c37_custom_source_flat_logs",
    """SELECT event_id::VARCHAR AS event_id, CASE WHEN k % 2 = 0 THEN 'event ' || event_type ELSE 'Log entry sent with orders' END AS content, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       account, 'orders' AS context FROM event_rows""",
)
def _(t):
    logs = CU.flat_source(flat_objects(t), "event_id", FLAT, now=F.lit(EVENT_AS_OF).cast("timestamp"), run_id="r1")["logs"]
    return logs.select("event_id", "content", "level", c("attributes")["account"].alias("account"), c("attributes")["run.context"].alias("context"))
