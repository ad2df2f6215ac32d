"""Inventory 2.5 to 2.8: expand and nest, aggregations, windows, set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.functions import sections as S
from sparkgauge.operators import aggregates as A
from sparkgauge.operators import expand as E
from sparkgauge.operators import sets as U
from sparkgauge.operators import windows as W
from sparkgauge.operators.keyed import KeyedState
from sparkgauge.session import fresh_path

c = F.col


# --- expand --------------------------------------------------------------------------------


def operators_by_query(t):
    """Operators of a statement as an array: a statement has a handful of them."""
    item = F.struct("operator_id", "step_id", "operator_type", "input_rows", "output_rows", "exception_type", "operator_key")
    return t.operator_rows.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("operators"))


@query("e1_flatten_inner", "SELECT query_id, operator_id, operator_type FROM operator_rows WHERE operator_id > 1")
def _(t):
    arrays = operators_by_query(t).select("query_id", F.filter("operators", lambda o: o["operator_id"] > 1).alias("operators"))
    return E.flatten_inner(arrays, "operators", "o").select("query_id", "o.operator_id", "o.operator_type")


@query(
    "e2_flatten_outer_if",
    """SELECT event_id, u.entity_id AS entity_id, u.entity_name AS entity_name FROM (SELECT event_id, unnest(CASE WHEN severity = 'HIGH' OR at_risk_entities = '[]' THEN
         [NULL::STRUCT(entity_id VARCHAR, entity_name VARCHAR)] ELSE from_json(at_risk_entities, '[{"entity_id":"VARCHAR","entity_name":"VARCHAR"}]') END) AS u FROM scanner_findings WHERE severity IS NOT NULL)""",
)
def _(t):
    rows = t.scanner_findings.filter("severity IS NOT NULL").select(
        "event_id", "severity", F.from_json("at_risk_entities", "array<struct<entity_id:string,entity_name:string>>").alias("entities")
    )
    return E.flatten_outer_if(rows, "entities", "e", c("severity") != "HIGH").select("event_id", "e.entity_id", "e.entity_name")


def access_arrays(t):
    """Objects of a statement as two arrays of (name, domain)."""
    base = F.struct(c("base_name").alias("name"), c("base_domain").alias("domain"))
    direct = F.struct(c("direct_name").alias("name"), c("direct_domain").alias("domain"))
    return t.object_access.groupBy("query_id").agg(
        F.collect_list(base).alias("base_objects"),
        F.collect_list(F.when(c("direct_name").isNotNull(), direct)).alias("direct_objects"),
    )


ACCESS_SQL = """
WITH f AS (SELECT query_id FROM object_access GROUP BY query_id HAVING count(direct_name) > 0),
a AS (SELECT o.* FROM object_access AS o JOIN f ON o.query_id = f.query_id),
tb AS (SELECT query_id, string_agg(DISTINCT base_name, ',' ORDER BY base_name) AS v FROM a WHERE base_domain = 'Table' GROUP BY query_id),
vw AS (SELECT query_id, string_agg(DISTINCT n, ',' ORDER BY n) AS v FROM (SELECT query_id, base_name AS n FROM a WHERE base_domain = 'View'
   UNION ALL SELECT query_id, direct_name FROM a WHERE direct_domain = 'View' AND direct_name IS NOT NULL) GROUP BY query_id),
dbs AS (SELECT query_id, string_agg(DISTINCT n, ',' ORDER BY n) AS v FROM (SELECT query_id, split_part(base_name, '.', 1) AS n FROM a
   UNION ALL SELECT query_id, split_part(direct_name, '.', 1) FROM a WHERE direct_name IS NOT NULL) GROUP BY query_id)
"""


@query(
    "e3_flatten_pair_distinct",
    ACCESS_SQL
    + """SELECT f.query_id, coalesce(tb.v, '') AS query_tables, coalesce(vw.v, '') AS query_views, coalesce(dbs.v, '') AS query_dbs
       FROM f LEFT JOIN tb ON f.query_id = tb.query_id LEFT JOIN vw ON f.query_id = vw.query_id LEFT JOIN dbs ON f.query_id = dbs.query_id""",
)
def _(t):
    out = E.flatten_pair_distinct(access_arrays(t))
    return out.select("query_id", *[F.array_join(n, ",").alias(n) for n in ("query_tables", "query_views", "query_dbs")])


@query(
    "e4_flatten_map",
    """SELECT event_id, CASE WHEN application IS NULL THEN '' ELSE application || '.' END || key AS key, value FROM (
         SELECT event_id, application, 'severity' AS key, severity AS value FROM event_log WHERE k % 7 <> 0
         UNION ALL SELECT event_id, application, 'metric', metric_name FROM event_log WHERE k % 7 <> 0)
       UNION ALL SELECT event_id, NULL, NULL FROM event_log WHERE k % 7 = 0""",
)
def _(t):
    members = F.when(c("k") % 7 != 0, S.text_section({"severity": c("severity"), "metric": c("metric_name")}))
    rows = t.event_log.select("event_id", "application", members.alias("members"))
    return E.flatten_map(rows, "members", "application").select("event_id", "key", "value")


@query(
    "e5_zip_arrays",
    """WITH s AS (SELECT account, warehouse_name, ts, row_number() OVER (PARTITION BY account, warehouse_name ORDER BY ts, event_id) AS n FROM warehouse_events WHERE event_name IN ('RESUME_WAREHOUSE', 'SUSPEND_WAREHOUSE')),
       f AS (SELECT account, warehouse_name, ts, row_number() OVER (PARTITION BY account, warehouse_name ORDER BY ts, event_id) AS n FROM warehouse_events WHERE event_name = 'WAREHOUSE_CONSISTENT')
       SELECT s.account, s.warehouse_name, s.n AS position, epoch_us(s.ts) AS start_us, epoch_us(f.ts) - epoch_us(s.ts) AS delay_us
       FROM s LEFT JOIN f ON s.account = f.account AND s.warehouse_name = f.warehouse_name AND s.n = f.n""",
)
def _(t):
    start = F.when(c("event_name").isin("RESUME_WAREHOUSE", "SUSPEND_WAREHOUSE"), c("ts"))
    finish = F.when(c("event_name") == "WAREHOUSE_CONSISTENT", c("ts"))
    paired = E.zip_in_order(
        t.warehouse_events, ["account", "warehouse_name"], start, finish, ["ts", "event_id"], F.date_trunc("day", "ts")
    )
    return paired.select(
        "account", "warehouse_name", "position", F.unix_micros("start_at").alias("start_us"),
        (F.unix_micros("finish_at") - F.unix_micros("start_at")).alias("delay_us"),
    )


@query(
    "e6_nested_any",
    """SELECT query_id, bool_or(operator_type = 'Join' AND output_rows > input_rows) AS is_cartesian,
       coalesce(string_agg(exception_type, ',' ORDER BY operator_key) FILTER (WHERE exception_type IS NOT NULL), '') AS exceptions FROM operator_rows GROUP BY query_id""",
)
def _(t):
    rows = operators_by_query(t)
    cartesian = E.any_element(c("operators"), lambda o: (o["operator_type"] == "Join") & (o["output_rows"] > o["input_rows"]))
    return rows.select("query_id", cartesian.alias("is_cartesian"), F.array_join(E.collect_field(c("operators"), "exception_type"), ",").alias("exceptions"))


@query("e7_split_to_rows", "SELECT doc_id, unnest(string_split(text, '.')) AS part FROM documents")
def _(t):
    return E.split_to_rows(t.documents.select("doc_id", "text"), "text", "part", ".")


# --- aggregate -----------------------------------------------------------------------------


@query(
    "a1_group_all_arrays",
    """SELECT query_id, coalesce(string_agg(DISTINCT base_name, ',' ORDER BY base_name), '') AS tables, coalesce(string_agg(DISTINCT direct_name, ',' ORDER BY direct_name), '') AS objects
       FROM object_access GROUP BY query_id""",
)
def _(t):
    out = A.group_all_arrays(t.object_access, ["query_id"], {"tables": c("base_name"), "objects": c("direct_name")})
    return out.select("query_id", F.array_join("tables", ",").alias("tables"), F.array_join("objects", ",").alias("objects"))


@query("a2_listagg_distinct", "SELECT user_name, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM user_grants GROUP BY user_name")
def _(t):
    return A.listagg_distinct(t.user_grants, ["user_name"], "role", "roles")


@query(
    "a2_listagg_all",
    """SELECT query_id, object_name, object_domain, string_agg(column_name, ', ' ORDER BY column_name) AS columns FROM ddl_columns GROUP BY ALL""",
)
def _(t):
    return A.listagg_distinct(t.ddl_columns, ["query_id", "object_name", "object_domain"], "column_name", "columns", ", ", distinct=False)


@query(
    "a3_direct_roles",
    """SELECT user_name, string_agg(role, ',' ORDER BY role) AS roles, string_agg(granted_by, ',' ORDER BY granted_by) AS granted_by, epoch_us(max(created_on)) AS last_altered_us
       FROM user_grants WHERE deleted_on IS NULL AND created_on > TIMESTAMP '2024-01-08 00:00:00' GROUP BY user_name""",
)
def _(t):
    import datetime as dt

    out = A.direct_roles(t.user_grants, dt.datetime(2024, 1, 8), first_of_day=False)
    return out.select(
        "user_name", F.array_join("roles", ",").alias("roles"), F.array_join("granted_by", ",").alias("granted_by"),
        F.unix_micros("last_altered").alias("last_altered_us"),
    )


@query(
    "a4_object_agg",
    """SELECT user_id, metric_name AS key, amount AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, metric_name ORDER BY ts DESC, event_id DESC) AS n
       FROM event_log WHERE record_type = 'METRIC') WHERE n = 1""",
)
def _(t):
    rows = t.event_log.filter("record_type = 'METRIC'")
    out = A.object_agg(rows, ["user_id"], "metric_name", "amount", ["ts", "event_id"], "metrics")
    return out.select("user_id", F.explode("metrics").alias("key", "value"))


@query(
    "a5_summarize",
    """SELECT query_type, query_no % 3 AS shard, count(*) AS n, sum(execution_time)::BIGINT AS total_ms, min(execution_time) AS fastest, max(execution_time) AS slowest,
       round(avg(execution_time), 4) AS mean_ms FROM query_log GROUP BY ALL""",
)
def _(t):
    return A.summarize(
        t.query_log,
        {"query_type": c("query_type"), "shard": c("query_no") % 3},
        n=F.count("*"),
        total_ms=F.sum("execution_time"),
        fastest=F.min("execution_time"),
        slowest=F.max("execution_time"),
        mean_ms=F.round(F.avg("execution_time"), 4),
    )


@query(
    "a6_take_first_last",
    """SELECT DISTINCT warehouse_name, first_value(query_id) OVER w AS first_id, last_value(role_name) OVER w AS last_role FROM query_log
       WINDOW w AS (PARTITION BY warehouse_name ORDER BY start_time, query_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def _(t):
    return A.summarize(
        t.query_log,
        ["warehouse_name"],
        first_id=A.take_first(c("query_id"), "start_time", "query_id"),
        last_role=A.take_last(c("role_name"), "start_time", "query_id"),
    )


@query("a7_count_distinct", "SELECT count(DISTINCT user_name) AS users, count(DISTINCT query_hash) AS statements FROM query_log")
def _(t):
    return t.query_log.agg(F.count_distinct("user_name").alias("users"), F.count_distinct("query_hash").alias("statements"))


@query("a7_count_distinct_grouped", "SELECT warehouse_name, count(DISTINCT user_name) AS users FROM query_log GROUP BY warehouse_name")
def _(t):
    return t.query_log.groupBy("warehouse_name").agg(F.count_distinct("user_name").alias("users"))


@query("a8_count_if", "SELECT user_name, count(*) FILTER (WHERE execution_status = 'FAIL') AS failed FROM query_log GROUP BY user_name")
def _(t):
    return t.query_log.groupBy("user_name").agg(F.count_if(c("execution_status") == "FAIL").alias("failed"))


@query("a9_collect_distinct", "SELECT DISTINCT role_name AS value FROM query_log WHERE role_name IS NOT NULL UNION ALL SELECT '*'")
def _(t):
    return A.collect_distinct(t.query_log, "role_name", with_all=True)


@query(
    "a10_percentile",
    """SELECT pipe_name, time_bucket(INTERVAL '30 days', loaded_at, TIMESTAMP '1970-01-01')::DATE::VARCHAR AS bin, round(quantile_cont(latency_ms, 0.95), 4) AS p95 FROM copy_history GROUP BY ALL""",
)
def _(t):
    day = (F.floor(F.unix_seconds("loaded_at") / (30 * 86400)) * 30).cast("int")
    rows = t.copy_history.withColumn("bin", F.date_from_unix_date(day).cast("string"))
    return A.exact_percentile(rows, ["pipe_name", "bin"], "latency_ms", 0.95, "p95").withColumn("p95", F.round("p95", 4))


@query("a10_percentile_global", "SELECT warehouse_name, round(quantile_cont(bytes_scanned, 0.95), 3) AS p95 FROM query_log GROUP BY warehouse_name")
def _(t):
    return A.exact_percentile(t.query_log, ["warehouse_name"], "bytes_scanned", 0.95, "p95").withColumn("p95", F.round("p95", 3))


@query(
    "a11_two_level",
    """SELECT plugin, count(*) AS runs, sum(n)::BIGINT AS records FROM (SELECT account, exec_id, plugin, count(*) AS n FROM run_status GROUP BY ALL HAVING count(*) > 1) GROUP BY plugin""",
)
def _(t):
    runs = t.run_status.groupBy("account", "exec_id", "plugin").agg(F.count("*").alias("n")).filter("n > 1")
    return runs.groupBy("plugin").agg(F.count("*").alias("runs"), F.sum("n").alias("records"))


@query(
    "a12_ratio",
    "SELECT name, CASE WHEN credit_quota > 0 THEN round(100.0 * used_credits / credit_quota, 6) ELSE 0 END AS used_pct FROM monitors",
)
def _(t):
    return t.monitors.select("name", F.round(A.ratio(100.0 * c("used_credits"), c("credit_quota")), 6).alias("used_pct"))


@query(
    "a13_dedup",
    "SELECT user_name, query_id, execution_time FROM (SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY start_time, query_id) AS n FROM query_log) WHERE n = 1",
)
def _(t):
    rows = t.query_log.select("user_name", "start_time", "query_id", "execution_time")
    return A.dedup(rows, ["user_name"], ["start_time", "query_id"]).select("user_name", "query_id", "execution_time")


# --- windows and limits --------------------------------------------------------------------


@query("w1_top_n_slowest", "SELECT query_id, execution_time FROM query_log ORDER BY execution_time DESC, query_id LIMIT 49")
def _(t):
    return W.top_n_slowest(t.query_log, "execution_time", 50, "query_id").select("query_id", "execution_time")


@query(
    "w2_operator_timeline",
    """WITH s AS (SELECT o.query_id, o.operator_key, 10000 * step_id + operator_id AS n, share_points * 0.0009765625 * q.execution_time AS ms, q.start_time FROM operator_rows AS o JOIN query_log AS q ON o.query_id = q.query_id),
       r AS (SELECT *, sum(ms) OVER (PARTITION BY query_id ORDER BY n DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS elapsed FROM s)
       SELECT query_id, operator_key, n AS operator_number, floor((epoch_ms(start_time) + elapsed - ms) / 1000)::BIGINT AS event_start_s FROM r""",
)
def _(t):
    operators = t.operator_rows.withColumn("share", c("share_points") * F.lit(0.0009765625))
    return W.operator_timeline(operators, t.query_log).select("query_id", "operator_key", "operator_number", "event_start_s")


@query("w3_batch_limit_oldest", "SELECT event_id FROM event_log ORDER BY ts, event_id LIMIT 1000")
def _(t):
    return W.batch_limit_oldest(t.event_log, "ts", "event_id", 1000).select("event_id")


@query("w3_batches_until_done", "SELECT event_id, ts FROM event_log")
def _(t):
    """Batches by (time, id), each after the last row of the one before, until nothing is left."""
    rows, after, parts = t.event_log.select("event_id", "ts"), None, []
    size = max(1, rows.count() // 4)
    while True:
        part = W.batch_limit_oldest(rows, "ts", "event_id", size, after)
        last = part.agg(F.max(F.struct("ts", "event_id")).alias("last")).first()["last"]
        if last is None:
            break
        parts.append(part)
        after = tuple(last)
    return reduce(DataFrame.unionByName, parts) if parts else rows


@query("w4_nulls_first_sort", "SELECT event_id, epoch_us(query_start_time) AS start_us FROM task_history ORDER BY query_start_time ASC NULLS FIRST, event_id")
def _(t):
    return W.nulls_first_sort(t.task_history, "query_start_time", "event_id").select("event_id", F.unix_micros("query_start_time").alias("start_us"))


@query(
    "w5_top_k_groups",
    "SELECT user_name, sum(execution_time)::BIGINT AS total_ms FROM query_log GROUP BY user_name ORDER BY total_ms DESC, user_name LIMIT 20",
)
def _(t):
    groups = A.summarize(t.query_log, ["user_name"], total_ms=F.sum("execution_time"))
    return W.top_k_groups(groups, "total_ms", 20, "user_name")


@query(
    "w6_top_k_series",
    """WITH s AS (SELECT warehouse_name, date_trunc('month', start_time)::DATE::VARCHAR AS month, sum(bytes_scanned)::BIGINT AS bytes FROM query_log GROUP BY ALL),
       b AS (SELECT warehouse_name FROM s GROUP BY warehouse_name ORDER BY sum(bytes) DESC, warehouse_name LIMIT 5)
       SELECT s.warehouse_name, s.month, s.bytes FROM s JOIN b ON s.warehouse_name = b.warehouse_name""",
)
def _(t):
    month = F.date_trunc("month", "start_time").cast("date").cast("string")
    points = A.summarize(t.query_log, {"warehouse_name": c("warehouse_name"), "month": month}, bytes=F.sum("bytes_scanned"))
    return W.top_k_series(points, ["warehouse_name"], c("bytes"), 5)


@query(
    "w7_run_gap",
    """WITH g AS (SELECT last_id, run_at, epoch_us(date_trunc('second', run_at)) // 1000000 - epoch_us(date_trunc('second', lag(run_at) OVER (ORDER BY run_at, last_id))) // 1000000 AS gap_s FROM status_log WHERE source = 'tasks')
       SELECT last_id, gap_s FROM g ORDER BY run_at DESC, last_id DESC LIMIT 50""",
)
def _(t):
    return W.run_gap(t.status_log, "tasks", 50).select("last_id", "gap_s")


@query(
    "w7_previous_run",
    """SELECT source, last_id, epoch_us(lag(run_at) OVER (PARTITION BY source ORDER BY run_at, last_id)) AS previous_us FROM status_log""",
)
def _(t):
    out = W.previous_in_order(t.status_log, ["source"], "run_at", ["run_at", "last_id"], F.date_trunc("day", "run_at"))
    return out.select("source", "last_id", F.unix_micros("previous").alias("previous_us"))


# --- sets ----------------------------------------------------------------------------------


@query(
    "u1_union_all",
    "SELECT query_id, 'running' AS side FROM query_log WHERE execution_status = 'RUNNING' UNION ALL SELECT query_id, 'finished' FROM query_log WHERE execution_status <> 'RUNNING'",
)
def _(t):
    running = t.query_log.filter("execution_status = 'RUNNING'").select("query_id", F.lit("running").alias("side"))
    finished = t.query_log.filter("execution_status <> 'RUNNING'").select(F.lit("finished").alias("side"), "query_id")
    return U.union_all(running, finished)


@query("u2_union_distinct", "SELECT parent AS name FROM role_edges UNION SELECT child FROM role_edges")
def _(t):
    return U.union_distinct(t.role_edges.select(c("parent").alias("name")), t.role_edges.select(c("child").alias("name")))


@query(
    "u3_snapshot_except",
    "SELECT user_id, login_name, default_role FROM user_snapshot EXCEPT SELECT user_id, login_name, default_role FROM user_seen",
)
def _(t):
    return U.snapshot_except(t.user_snapshot.select("user_id", "login_name", "default_role"), t.user_seen)


@query(
    "u3_snapshots_in_turn",
    """SELECT 1 AS snapshot, * FROM (SELECT DISTINCT user_id, login_name, default_role FROM user_seen)
       UNION ALL SELECT 2, * FROM (SELECT user_id, login_name, default_role FROM user_snapshot EXCEPT SELECT user_id, login_name, default_role FROM user_seen)""",
)
def _(t):
    """What each of three snapshots adds to a stored state; the last one repeats the second."""
    users = t.user_snapshot.select("user_id", "login_name", "default_role")
    state = KeyedState(t.spark, fresh_path(t.spark, "users"), users.schema, users.columns)
    added = [state.add(s).withColumn("snapshot", F.lit(n)) for n, s in enumerate((t.user_seen, users, users), 1)]
    return added[0].unionByName(added[1]).unionByName(added[2])


@query(
    "u4_append",
    "SELECT event_id, user_name, NULL AS database_name FROM login_log UNION ALL SELECT event_id, NULL, database_name FROM event_log",
)
def _(t):
    return U.append(t.login_log.select("event_id", "user_name"), t.event_log.select("event_id", "database_name"))
