"""Inventory 2.12: reports over costs, queries, data, security and operations."""

import datetime as dt

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import FRAMES
from sparkgauge.catalog.shaping import operators_by_query
from sparkgauge.catalog.timeseries import at, grid_sql
from sparkgauge.operators.series import DAY
from sparkgauge.plans.reports import costs as RC
from sparkgauge.plans.reports import data as RD
from sparkgauge.plans.reports import operations as RO
from sparkgauge.plans.reports import queries as RQ

c = F.col
MONTH = 30 * DAY
NOW = dt.datetime(2024, 1, 31)

FRAMES["query_rows"] = """
SELECT query_id, query_no, user_name, role_name, account, warehouse_name, warehouse_size, database_name, query_type, query_text, query_hash, query_tag, execution_status, error_code,
       start_time, end_time, execution_time, compilation_time, queued_overload_time, queued_provisioning_time, total_elapsed_time, bytes_scanned, bytes_spilled_local, bytes_spilled_remote,
       partitions_scanned, partitions_total, cache_pct, acceleration_bytes, external_calls, outbound_bytes, inbound_bytes, transfer_region, transfer_cloud, cloud_credits,
       CASE WHEN query_no % 19 = 0 THEN NULL ELSE 'T_' || CAST(query_no % 60 AS STRING) END AS table_name,
       CASE WHEN query_no % 3 = 0 THEN '["T_' || CAST(query_no % 60 AS STRING) || '","T_' || CAST(query_no % 7 AS STRING) || '"]' ELSE NULL END AS tables,
       CASE query_no % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Web 1.0' WHEN 2 THEN 'JDBC 3.2' ELSE 'Python 2.9' END AS client_application,
       CASE query_no % 5 WHEN 0 THEN NULL WHEN 1 THEN 'PASSWORD' ELSE 'OAUTH' END AS authentication
FROM query_log
"""

FRAMES["spend_rows"] = "SELECT spend_id, budget_name, service_type, measured_on AS ts, credits_spent, account FROM budget_spend"

FRAMES["estimates"] = """
SELECT query_id, CASE query_no % 3 WHEN 0 THEN 'eligible' WHEN 1 THEN 'ineligible' ELSE 'invalid' END AS status, query_no % 8 AS scale_factor FROM query_log WHERE query_no % 2 = 0
"""

FRAMES["finding_log"] = """
SELECT event_id, ended_at AS ts, coalesce(severity, 'NONE') AS severity, scanner_id, scanner_type, account,
       CASE WHEN severity = 'LOW' THEN 'Warning' ELSE 'Vulnerability management' END AS category, scanner_name AS message
FROM scanner_findings
"""


# --- R1 to R5: budgets ---------------------------------------------------------------------


@query(
    "r1_budget_vs_limit",
    """WITH s AS (SELECT budget_name, account, sum(credits_spent)::BIGINT AS spent FROM spend_rows WHERE account IN ('acc-0', 'acc-2') GROUP BY ALL),
       l AS (SELECT budget_name, account, max(credit_limit) AS credit_limit FROM budget_log GROUP BY ALL)
       SELECT s.budget_name, s.account, spent, credit_limit, round(CASE WHEN credit_limit > 0 THEN 100.0::DOUBLE * (spent::DOUBLE / credit_limit) ELSE 0 END, 6) AS used_pct FROM s JOIN l ON s.budget_name = l.budget_name AND s.account = l.account""",
)
def _(t):
    return RC.budget_vs_limit(t.spend_rows, t.budget_log, accounts=["acc-0", "acc-2"]).withColumn("used_pct", F.round("used_pct", 6))


@query(
    "r2_spend_trend",
    "WITH " + grid_sql("spend_rows", "ts", ["budget_name", "account"], MONTH, {"spent": "avg(credits_spent)"}) + "SELECT budget_name, account, bin_s, round(spent, 4) AS spent FROM series",
)
def _(t):
    return RC.spend_trend(t.spend_rows, MONTH).select("budget_name", "account", at(), F.round("spent", 4).alias("spent"))


@query("r2_spend_by_service", "SELECT service_type, sum(credits_spent)::BIGINT AS spent FROM spend_rows WHERE budget_name = 'B_3' GROUP BY service_type")
def _(t):
    return RC.spend_by_service(t.spend_rows, budget_name="B_3")


def latest_sql(rows: str, keys: str, order: str, columns: list[str], extra: str = "") -> str:
    """First row per key by window, the other way to say max_by."""
    return f"SELECT {keys}, {extra}{', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM {rows}) WHERE n = 1"


@query(
    "r3_budget_details",
    "WITH " + "l AS (" + latest_sql("budget_log", "budget_name, account", "ts DESC, log_id DESC", ["owner", "resource"]) + "), m AS (SELECT budget_name, account, max(credit_limit) AS credit_limit FROM budget_log GROUP BY ALL) "
    + "SELECT l.*, m.credit_limit FROM l JOIN m ON l.budget_name = m.budget_name AND l.account = m.account",
)
def _(t):
    return RC.budget_details(t.budget_log)


@query(
    "r3_warehouse_sizing",
    latest_sql("warehouse_log", "warehouse_name, account", "ts DESC, event_id DESC", ["size", "scaling_policy", "min_clusters", "max_clusters", "state", "auto_resume", "resource_monitor"]),
)
def _(t):
    return RC.warehouse_sizing(t.warehouse_log)


@query(
    "r4_cluster_use",
    "WITH " + grid_sql("warehouse_log", "ts", ["warehouse_name", "account"], DAY, {"started": "avg(started_clusters)", "max_clusters": "avg(max_clusters)"})
    + "SELECT warehouse_name, account, bin_s, round(started, 4) AS started, round(max_clusters, 4) AS max_clusters FROM series",
)
def _(t):
    return RC.cluster_use(t.warehouse_log).select("warehouse_name", "account", at(), F.round("started", 4).alias("started"), F.round("max_clusters", 4).alias("max_clusters"))


@query(
    "r4_quota_use",
    "WITH " + grid_sql("monitor_log", "ts", ["monitor_name", "account"], DAY, {"quota_used": "avg(quota_used)", "quota_total": "avg(quota)"})
    + "SELECT monitor_name, account, bin_s, round(quota_used, 4) AS quota_used, round(quota_total, 4) AS quota_total FROM series",
)
def _(t):
    return RC.quota_use(t.monitor_log).select("monitor_name", "account", at(), F.round("quota_used", 4).alias("quota_used"), F.round("quota_total", 4).alias("quota_total"))


@query(
    "r4_running_vs_queued",
    "WITH " + grid_sql("warehouse_load", "start_time", ["warehouse_name", "account"], 7 * DAY, {"running": "avg(avg_running)", "queued": "avg(avg_queued)"})
    + "SELECT warehouse_name, account, bin_s, round(running, 4) AS running, round(queued, 4) AS queued FROM series",
)
def _(t):
    return RC.running_vs_queued(t.warehouse_load, 7 * DAY).select("warehouse_name", "account", at(), F.round("running", 4).alias("running"), F.round("queued", 4).alias("queued"))


@query(
    "r4_blocked_over_time",
    "WITH " + grid_sql("warehouse_load", "start_time", ["warehouse_name", "account"], 7 * DAY, {"blocked": "avg(avg_blocked)"}, where="warehouse_name IN ('WH_3', 'WH_4')")
    + "SELECT warehouse_name, account, bin_s, round(blocked, 4) AS blocked FROM series",
)
def _(t):
    out = RC.blocked_over_time(t.warehouse_load, 7 * DAY, warehouse_name=["WH_3", "WH_4"])
    return out.select("warehouse_name", "account", at(), F.round("blocked", 4).alias("blocked"))


@query("r5_average_running", "SELECT warehouse_name, round(avg(avg_running), 4) AS avg_running FROM warehouse_load GROUP BY warehouse_name")
def _(t):
    return RC.average_running(t.warehouse_load).withColumn("avg_running", F.round("avg_running", 4))


# --- R6 to R15: costs ----------------------------------------------------------------------


@query(
    "r6_monitor_credits",
    "WITH "
    + grid_sql(
        "monitor_log", "ts", ["monitor_name", "account", "service_name"], DAY,
        {"used": "max(quota_used)", "quota": "max(quota)", "used_pct": "max(100.0::DOUBLE * quota_used / quota)"}, where="(starts_with(monitor_name, 'P1_') OR starts_with(monitor_name, 'P2_'))",
    )
    + "SELECT monitor_name, coalesce(account, service_name) AS owner, bin_s, max(used) AS used, max(quota) AS quota, round(max(used_pct), 4) AS used_pct FROM series GROUP BY ALL",
)
def _(t):
    out = RC.monitor_credits(t.monitor_log, prefix=["P1", "P2"])
    return out.select("monitor_name", "owner", at(), "used", "quota", F.round("used_pct", 4).alias("used_pct"))


@query(
    "r6_monitor_daily_trend",
    "WITH " + grid_sql("monitor_log", "ts", ["monitor_name", "account"], DAY, {"credits_used": "max(quota_used)", "credits_quota": "max(quota)"}, where="account = 'acc-1'") + "SELECT * FROM series",
)
def _(t):
    return RC.monitor_daily_trend(t.monitor_log, accounts="acc-1").select("monitor_name", "account", at(), "credits_used", "credits_quota")


@query(
    "r7_unmonitored",
    """WITH l AS (SELECT account, warehouse_name, ts, loglevel FROM (SELECT *, row_number() OVER (PARTITION BY account, warehouse_name ORDER BY ts DESC, event_id DESC) AS n FROM warehouse_log) WHERE n = 1)
       SELECT account, warehouse_name, epoch_us(ts) AS last_seen_us, loglevel, 'Warehouse ' || warehouse_name || ' does not have Resource Monitor assigned' AS explanation FROM l WHERE loglevel = 'WARN'""",
)
def _(t):
    return RC.unmonitored(t.warehouse_log).select("account", "warehouse_name", F.unix_micros("last_seen").alias("last_seen_us"), "loglevel", "explanation")


MONITORED = "mw AS (SELECT DISTINCT account, warehouse_name, monitor_name FROM monitor_log WHERE warehouse_event IS NOT NULL AND monitor_name IS NOT NULL AND warehouse_name IS NOT NULL)"


def warehouse_time_sql(measure: str) -> str:
    return (
        "WITH " + MONITORED + ", " + grid_sql("query_rows", "start_time", ["warehouse_name", "account"], MONTH, {"total": f"sum({measure})::BIGINT"}, where="starts_with(warehouse_name, 'P1_')")
        + """SELECT s.warehouse_name, s.account, s.bin_s, sum(s.total)::BIGINT AS total FROM series AS s LEFT JOIN mw ON s.account = mw.account AND s.warehouse_name = mw.warehouse_name
             WHERE mw.monitor_name IS NULL OR mw.monitor_name IN ('P1_RM_1', 'P1_RM_5') GROUP BY ALL"""
    )


def warehouse_time(t, measure):
    out = RC.warehouse_time(t.query_rows, t.monitor_log, measure, MONTH, monitors=["P1_RM_1", "P1_RM_5"], prefix=["P1"])
    return out.select("warehouse_name", "account", at(), "total")


@query("r8_overload_time", warehouse_time_sql("queued_overload_time"))
def _(t):
    return warehouse_time(t, "queued_overload_time")


@query("r8_provisioning_time", warehouse_time_sql("queued_provisioning_time"))
def _(t):
    return warehouse_time(t, "queued_provisioning_time")


@query(
    "r8_execution_time",
    "WITH " + grid_sql("query_rows", "start_time", ["account"], MONTH, {"total": "sum(execution_time)::BIGINT"}, where="starts_with(warehouse_name, 'P2_')") + "SELECT * FROM series",
)
def _(t):
    return RC.account_time(t.query_rows, "execution_time", MONTH, prefix=["P2"]).select("account", at(), "total")


SLOW = f"""WITH {MONITORED}, slow AS (SELECT q.*, mw.monitor_name FROM query_rows AS q LEFT JOIN mw ON q.account = mw.account AND q.warehouse_name = mw.warehouse_name WHERE floor(total_elapsed_time / 60000) > 1)"""


@query("r9_slow_queries_by_user", SLOW + ", " + grid_sql("slow", "start_time", ["user_name"], 3 * MONTH, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return RC.slow_queries_by_user(t.query_rows, t.monitor_log, 1, 3 * MONTH).select("user_name", at(), "n")


@query(
    "r10_slowest_queries",
    SLOW
    + """SELECT query_id, user_name, account, warehouse_name, coalesce(monitor_name, '-') AS monitor_name, total_elapsed_time AS duration_ms, query_text AS query_sql
         FROM slow ORDER BY total_elapsed_time DESC, query_id, monitor_name NULLS FIRST LIMIT 100""",
)
def _(t):
    return RC.slowest_queries(t.query_rows, t.monitor_log, 1)


LATEST_ACTIVE = """la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY seen_at DESC, run_no DESC) AS n FROM active_log WHERE floor(running_time / 60000) > MINUTES) WHERE n = 1),
opn AS (SELECT * FROM la WHERE query_id NOT IN (SELECT query_id FROM query_rows WHERE execution_status = 'SUCCESS'))"""


@query(
    "r11_long_running",
    "WITH " + LATEST_ACTIVE.replace("MINUTES", "30")
    + " SELECT query_id, user_name, account, warehouse_name, epoch_us(seen_at) AS seen_us, running_time AS duration_ms, query_text FROM opn",
)
def _(t):
    out = RC.long_running(t.active_log, t.query_rows.filter("execution_status = 'SUCCESS'"), 30)
    return out.withColumn("seen_us", F.unix_micros("seen_at")).drop("seen_at")


@query(
    "r12_exhausting_queries",
    "WITH " + LATEST_ACTIVE.replace("MINUTES", "5")
    + """, lf AS (SELECT account, warehouse_name, monitor_name, quota_remaining % 2 AS remaining FROM (SELECT *, row_number() OVER (PARTITION BY account, warehouse_name, monitor_name ORDER BY ts DESC, event_id DESC) AS n
          FROM monitor_log WHERE monitor_name <> 'ACCOUNT_GLOBAL_MONITOR') WHERE n = 1),
        er AS (SELECT query_hash, floor(max(total_elapsed_time) / 1000) AS elapsed_s FROM query_rows WHERE execution_status = 'SUCCESS' AND total_elapsed_time > 1000 GROUP BY query_hash),
        pr AS (SELECT o.query_id, o.account, o.warehouse_name, lf.monitor_name, lf.remaining, o.running_time, er.elapsed_s, CASE warehouse_size WHEN 'X-Small' THEN 1 WHEN 'Small' THEN 2 WHEN 'Medium' THEN 4 WHEN 'Large' THEN 8 END AS cost
          FROM opn AS o JOIN lf ON o.account = lf.account AND o.warehouse_name = lf.warehouse_name LEFT JOIN er ON o.query_hash = er.query_hash)
        SELECT query_id, account, warehouse_name, monitor_name, round(cost * running_time / 3600000.0, 4) AS current_cost, round(cost * elapsed_s / 3600.0, 4) AS estimated_cost,
          round(cost * elapsed_s / 3600.0 - cost * running_time / 3600000.0, 4) AS expected_cost FROM pr WHERE cost * elapsed_s / 3600.0 - cost * running_time / 3600000.0 > remaining - 2""",
)
def _(t):
    left = t.monitor_log.withColumn("quota_remaining", c("quota_remaining") % 2 - 2)
    out = RC.exhausting_queries(t.active_log, t.query_rows.filter("execution_status = 'SUCCESS'"), left, long_ms=1000)
    return out.select("query_id", "account", "warehouse_name", "monitor_name", *[F.round(n, 4).alias(n) for n in ("current_cost", "estimated_cost", "expected_cost")])


@query(
    "r13_warehouse_event_delay",
    """WITH e AS (SELECT * FROM warehouse_events WHERE contains(event_name, 'WAREHOUSE')),
       s AS (SELECT account, warehouse_name, ts, CASE event_name WHEN 'RESUME_WAREHOUSE' THEN 'RESUME' ELSE 'SUSPEND' END AS action, row_number() OVER (PARTITION BY account, warehouse_name ORDER BY ts, event_id) AS n FROM e WHERE event_name <> 'WAREHOUSE_CONSISTENT'),
       f AS (SELECT account, warehouse_name, ts, row_number() OVER (PARTITION BY account, warehouse_name ORDER BY ts, event_id) AS n FROM e WHERE event_name = 'WAREHOUSE_CONSISTENT'),
       p AS (SELECT s.*, epoch_us(f.ts) - epoch_us(s.ts) AS delay FROM s LEFT JOIN f ON s.account = f.account AND s.warehouse_name = f.warehouse_name AND s.n = f.n),"""
    + grid_sql("p", "ts", ["action", "warehouse_name", "account"], DAY, {"delay_us": "sum(delay)::BIGINT"})
    + "SELECT * FROM series",
)
def _(t):
    return RC.warehouse_event_delay(t.warehouse_events).select("action", "warehouse_name", "account", at(), "delay_us")


@query(
    "r14_near_exhaustion",
    "SELECT monitor_name, frequency, account, round(max(100.0::DOUBLE * quota_used / quota), 4) AS used_pct, min(quota_remaining) AS remaining, max(quota) AS quota FROM monitor_log GROUP BY ALL",
)
def _(t):
    return RC.near_exhaustion(t.monitor_log).withColumn("used_pct", F.round("used_pct", 4))


@query(
    "r14_monitor_states",
    "SELECT monitor_name, is_active, account, count(*) AS n, (CASE WHEN is_active = 'true' THEN 1 ELSE 0 END)::BIGINT AS state_code FROM monitor_log WHERE is_active IS NOT NULL GROUP BY ALL",
)
def _(t):
    return RC.monitor_states(t.monitor_log)


@query(
    "r14_monitor_frequencies",
    "SELECT monitor_name, frequency, is_active, account, max(quota) AS quota, max(quota_used) AS used, min(quota_remaining) AS remaining FROM monitor_log GROUP BY ALL",
)
def _(t):
    return RC.monitor_frequencies(t.monitor_log)


@query(
    "r15_quota_forecast",
    """WITH d AS (SELECT monitor_name, coalesce(account, service_name) AS owner, epoch_us(date_trunc('day', ts)) // 86400000000 - epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 86400000000 AS x, max(100.0::DOUBLE * quota_used / quota) AS y
         FROM monitor_log WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY ALL),
       line AS (SELECT monitor_name, owner, count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy FROM d GROUP BY ALL),
       days AS (SELECT *, unnest(range(1, 15)) AS day, n >= 3 AND sxx > 0 AS ok FROM line)
       SELECT monitor_name, owner, day, CASE WHEN ok THEN 'VALID' ELSE 'NO_DATA' END AS quality, round(CASE WHEN ok THEN my + sxy / sxx * (day - 1 - mx) END, 4) AS point FROM days""",
)
def _(t):
    return RC.quota_forecast(t.monitor_log, NOW).select("monitor_name", "owner", "day", "quality", F.round("point", 4).alias("point"))


# --- R16 to R19: data volume ---------------------------------------------------------------


def volume_total_sql(measure: str) -> str:
    return f"""WITH b AS (SELECT account, date_trunc('day', ts) AS d, sum({measure}) AS total FROM table_metrics GROUP BY ALL), m AS (SELECT account, max(total) AS latest FROM b GROUP BY account)
               SELECT sum(latest)::BIGINT AS {measure} FROM m"""


@query("r16_total_bytes", volume_total_sql("bytes"))
def _(t):
    return RD.volume_total(t.table_metrics, "bytes")


@query("r16_total_rows", volume_total_sql("row_count"))
def _(t):
    return RD.volume_total(t.table_metrics, "row_count")


@query(
    "r17_storage_growth",
    "WITH " + grid_sql("table_metrics", "ts", ["database_name", "account"], 7 * DAY, {"total": "sum(bytes)::BIGINT"}, where="(database_name IS NULL OR database_name = 'DB_1')") + "SELECT * FROM series",
)
def _(t):
    return RD.volume_growth(t.table_metrics, "bytes", 7 * DAY, database_name="DB_1").select("database_name", "account", at(), "total")


@query("r17_row_trend", "WITH " + grid_sql("table_metrics", "ts", ["database_name", "account"], 7 * DAY, {"total": "sum(row_count)::BIGINT"}) + "SELECT * FROM series")
def _(t):
    return RD.volume_growth(t.table_metrics, "row_count", 7 * DAY).select("database_name", "account", at(), "total")


@query(
    "r18_largest_tables",
    "SELECT table_name, database_name, account, max(bytes) AS size FROM table_metrics GROUP BY ALL ORDER BY size DESC, table_name, database_name NULLS FIRST, account LIMIT 20",
)
def _(t):
    return RD.largest_tables(t.table_metrics)


@query("r18_table_types", "SELECT table_type, count(DISTINCT table_name) AS n FROM table_metrics WHERE bytes IS NOT NULL GROUP BY table_type")
def _(t):
    return RD.table_types(t.table_metrics)


@query(
    "r18_stale_tables",
    """SELECT table_name, database_name, account, table_type, round(max(minutes_since_update) / 1440.0, 6) AS days_since_update FROM table_metrics GROUP BY ALL
       ORDER BY max(minutes_since_update) DESC, table_name, database_name NULLS FIRST, account, table_type NULLS FIRST LIMIT 50""",
)
def _(t):
    return RD.stale_tables(t.table_metrics).withColumn("days_since_update", F.round("days_since_update", 6))


@query(
    "r18_ddl_age",
    """WITH m AS (SELECT table_name, database_name, account, max(minutes_since_ddl) / 1440.0 AS days FROM table_metrics GROUP BY ALL)
       SELECT CASE WHEN days < 7 THEN '< 1 week' WHEN days < 30 THEN '1 week – 1 month' WHEN days < 90 THEN '1 – 3 months' WHEN days < 180 THEN '3 – 6 months' ELSE '> 6 months' END AS bucket, count(*) AS n FROM m GROUP BY ALL""",
)
def _(t):
    return RD.ddl_age(t.table_metrics)


@query("r19_ddl_over_time", "WITH " + grid_sql("ddl_events", "ts", ["operation"], 7 * DAY, {"n": "count(*)"}, where="operation IS NOT NULL") + "SELECT * FROM series")
def _(t):
    return RD.ddl_over_time(t.ddl_events, 7 * DAY).select("operation", at(), "n")


@query("r19_ddl_object_types", "SELECT object_domain, count(*) AS n FROM ddl_events GROUP BY object_domain")
def _(t):
    return RD.ddl_object_types(t.ddl_events)


@query("r19_recent_ddl", "SELECT event_no, account, object_name, operation, object_domain, user_name FROM ddl_events WHERE operation IS NOT NULL")
def _(t):
    return RD.recent_ddl(t.ddl_events).drop("ts", "properties")


# --- R20 to R26: deep dive -----------------------------------------------------------------


def first_text_sql(keys: str) -> str:
    return f"(SELECT {keys}, query_text FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY start_time, query_id) AS n FROM query_rows) WHERE n = 1)"


SCAN_KEYS = "query_hash, database_name, warehouse_name, query_type"


@query(
    "r20_top_by_scan",
    f"""WITH a AS (SELECT {SCAN_KEYS}, sum(bytes_scanned)::BIGINT AS total_scanned, count(*) AS executions, round(avg(total_elapsed_time), 4) AS mean_elapsed FROM query_rows GROUP BY ALL
        ORDER BY total_scanned DESC, query_hash, database_name NULLS FIRST, warehouse_name, query_type LIMIT 20)
        SELECT a.*, f.query_text FROM a JOIN {first_text_sql(SCAN_KEYS)} AS f ON a.query_hash = f.query_hash AND a.database_name IS NOT DISTINCT FROM f.database_name AND a.warehouse_name = f.warehouse_name AND a.query_type = f.query_type""",
)
def _(t):
    return RQ.top_by_scan(t.query_rows).withColumn("mean_elapsed", F.round("mean_elapsed", 4))


@query(
    "r20_top_by_spill",
    """SELECT query_hash, database_name, warehouse_name, sum(bytes_spilled_local + bytes_spilled_remote)::BIGINT AS total_spill, sum(bytes_spilled_local)::BIGINT AS local_spill, sum(bytes_spilled_remote)::BIGINT AS remote_spill,
       count(*) AS executions FROM query_rows GROUP BY ALL ORDER BY total_spill DESC, query_hash, database_name NULLS FIRST, warehouse_name LIMIT 20""",
)
def _(t):
    return RQ.top_by_spill(t.query_rows).drop("query_text")


def top_series_sql(keys: list[str], aggregates: dict[str, str], weight: str, k: int, where: str, step: int = MONTH) -> str:
    """Series of the k keys with the largest weight, over the range of all keys."""
    grid = grid_sql("query_rows", "start_time", keys, step, aggregates, where=where)
    order = ", ".join(f"{x} NULLS FIRST" for x in keys)
    key = ", ".join(keys)
    return f"WITH {grid}, best AS (SELECT {key} FROM points GROUP BY {key} ORDER BY sum({weight}) DESC, {order} LIMIT {k}) SELECT s.* FROM series AS s JOIN best USING ({key})"


@query("r21_scanned_by_database", "WITH " + grid_sql("query_rows", "start_time", ["database_name"], MONTH, {"scanned": "sum(bytes_scanned)::BIGINT"}) + "SELECT * FROM series")
def _(t):
    return RQ.scanned_by_database(t.query_rows, step_s=MONTH).select("database_name", at(), "scanned")


@query(
    "r21_scan_ratio_by_table",
    "SELECT table_name, bin_s, round(avg_ratio, 5) AS avg_ratio FROM ("
    + top_series_sql(["table_name"], {"avg_ratio": "avg(partitions_scanned::DOUBLE / partitions_total)"}, "avg_ratio", 5, "table_name IS NOT NULL AND partitions_total > 0") + ")",
)
def _(t):
    return RQ.scan_ratio_by_table(t.query_rows, 5, step_s=MONTH).select("table_name", at(), F.round("avg_ratio", 5).alias("avg_ratio"))


@query(
    "r21_spill_by_table",
    top_series_sql(["table_name"], {"local_spill": "sum(bytes_spilled_local)::BIGINT", "remote_spill": "sum(bytes_spilled_remote)::BIGINT"}, "local_spill + 100 * remote_spill", 5, "table_name IS NOT NULL"),
)
def _(t):
    return RQ.spill_by_table(t.query_rows, 5, step_s=MONTH).select("table_name", at(), "local_spill", "remote_spill")


@query(
    "r21_cache_hits_by_table",
    "SELECT table_name, bin_s, round(cache, 4) AS cache_pct FROM (" + top_series_sql(["table_name"], {"cache": "avg(cache_pct)"}, "cache", 5, "table_name IS NOT NULL AND cache_pct IS NOT NULL") + ")",
)
def _(t):
    return RQ.cache_hits_by_table(t.query_rows, 5, step_s=MONTH).select("table_name", at(), F.round("cache_pct", 4).alias("cache_pct"))


@query("r21_acceleration_by_warehouse", top_series_sql(["warehouse_name"], {"accel_bytes": "sum(acceleration_bytes)::BIGINT"}, "accel_bytes", 5, "acceleration_bytes > 0"))
def _(t):
    return RQ.acceleration_by_warehouse(t.query_rows, 5, step_s=MONTH).select("warehouse_name", at(), "accel_bytes")


@query("r21_external_calls_by_warehouse", top_series_sql(["warehouse_name"], {"invocations": "sum(external_calls)::BIGINT"}, "invocations", 5, "external_calls > 0"))
def _(t):
    return RQ.external_calls_by_warehouse(t.query_rows, 5, step_s=MONTH).select("warehouse_name", at(), "invocations")


@query(
    "r22_acceleration_eligible",
    """SELECT q.query_id, user_name, warehouse_name, database_name, query_type, e.status, e.scale_factor, total_elapsed_time FROM query_rows AS q JOIN estimates AS e ON q.query_id = e.query_id WHERE e.status = 'eligible'
       ORDER BY total_elapsed_time DESC, q.query_id LIMIT 20""",
)
def _(t):
    return RQ.acceleration_eligible(t.query_rows, t.estimates)


@query(
    "r22_external_volumes",
    """SELECT warehouse_name, database_name, sum(outbound_bytes)::BIGINT AS bytes_sent, sum(inbound_bytes)::BIGINT AS bytes_received, sum(external_calls)::BIGINT AS invocations FROM query_rows WHERE external_calls > 0 GROUP BY ALL
       ORDER BY invocations DESC, warehouse_name, database_name NULLS FIRST LIMIT 20""",
)
def _(t):
    return RQ.external_volumes(t.query_rows)


@query(
    "r23_roots_with_children",
    """WITH ch AS (SELECT parent_id, count(*) AS children FROM span_rows WHERE parent_id IS NOT NULL GROUP BY parent_id)
       SELECT s.span_id, s.elapsed, ch.children FROM span_rows AS s JOIN ch ON s.span_id = ch.parent_id ORDER BY s.elapsed DESC, s.span_id LIMIT 20""",
)
def _(t):
    spans = t.span_rows.withColumnRenamed("own_trace", "trace_id")
    return RQ.roots_with_children(spans).select("span_id", "elapsed", "children")


def statement_spans(t):
    """Statements with their plan operators as span events."""
    events = operators_by_query(t).withColumnRenamed("operators", "events")
    rows = t.query_rows.select("query_id", "start_time", "account", "user_name", "query_type", c("total_elapsed_time").alias("elapsed"))
    return rows.join(events, "query_id")


@query(
    "r24_operator_stats",
    """WITH o AS (SELECT query_id, count(*) AS n FROM operator_rows GROUP BY query_id HAVING count(exception_type) = 0)
       SELECT q.query_id, total_elapsed_time AS elapsed, o.n AS n_operators FROM query_rows AS q JOIN o ON q.query_id = o.query_id ORDER BY elapsed DESC, q.query_id LIMIT 20""",
)
def _(t):
    return RQ.operator_stats(statement_spans(t)).select("query_id", "elapsed", F.size("events").cast("bigint").alias("n_operators"))


@query(
    "r24_span_exceptions",
    """WITH o AS (SELECT query_id, string_agg(exception_type, ',' ORDER BY operator_id, step_id, operator_type, input_rows, output_rows) AS exceptions FROM operator_rows WHERE exception_type IS NOT NULL GROUP BY query_id)
       SELECT q.query_id, q.user_name, o.exceptions FROM query_rows AS q JOIN o ON q.query_id = o.query_id""",
)
def _(t):
    return RQ.span_exceptions(statement_spans(t)).select("query_id", "user_name", F.array_join("exception_types", ",").alias("exceptions"))


@query("r25_by_client_application", "SELECT client_application, count(*) AS n FROM query_rows WHERE client_application IS NOT NULL GROUP BY ALL")
def _(t):
    return RQ.count_by(t.query_rows, "client_application")


@query("r25_by_authentication", "SELECT authentication, count(*) AS n FROM query_rows WHERE authentication IS NOT NULL AND query_type = 'SELECT' GROUP BY ALL")
def _(t):
    return RQ.count_by(t.query_rows, "authentication", query_type="SELECT")


@query(
    "r26_cloud_credits_by_user",
    "SELECT user_name, role_name, sum(cloud_credits)::BIGINT AS credits FROM query_rows GROUP BY ALL ORDER BY credits DESC, user_name, role_name NULLS FIRST LIMIT 10",
)
def _(t):
    return RQ.cloud_credits(t.query_rows, ["user_name", "role_name"], 10)


@query("r26_cloud_credits_by_warehouse", "SELECT warehouse_name, sum(cloud_credits)::BIGINT AS credits FROM query_rows GROUP BY ALL")
def _(t):
    return RQ.cloud_credits(t.query_rows, ["warehouse_name"])


@query("r26_outbound_transfer", "SELECT transfer_region, transfer_cloud, sum(outbound_bytes)::BIGINT AS total_bytes FROM query_rows WHERE outbound_bytes > 0 GROUP BY ALL")
def _(t):
    return RQ.transfer(t.query_rows, "outbound_bytes")


@query("r26_inbound_transfer", "SELECT transfer_region, transfer_cloud, sum(inbound_bytes)::BIGINT AS total_bytes FROM query_rows WHERE inbound_bytes > 0 GROUP BY ALL")
def _(t):
    return RQ.transfer(t.query_rows, "inbound_bytes")


# --- R27 to R32: performance ---------------------------------------------------------------


def time_by_sql(rows: str, keys: list[str], where: str = "true") -> str:
    return "WITH " + grid_sql(rows, "start_time", keys, MONTH, {"total_ms": "sum(execution_time)::BIGINT"}, where=" AND ".join([f"{k} IS NOT NULL" for k in keys] + [where])) + "SELECT * FROM series"


@query("r27_time_by_account", time_by_sql("query_rows", ["account"]))
def _(t):
    return RQ.time_by(t.query_rows, ["account"], MONTH).select("account", at(), "total_ms")


@query("r27_time_by_database", time_by_sql("query_rows", ["database_name"]))
def _(t):
    return RQ.time_by(t.query_rows, ["database_name"], MONTH).select("database_name", at(), "total_ms")


TABLE_ROWS = """(SELECT * EXCLUDE (table_name), unnest(CASE WHEN tables IS NOT NULL THEN json_extract_string(tables, '$[*]') ELSE [table_name] END) AS table_name FROM query_rows)"""


@query("r27_time_by_table", time_by_sql(TABLE_ROWS, ["table_name"]))
def _(t):
    return RQ.time_by(RQ.tables_of(t.query_rows), ["table_name"], MONTH).select("table_name", at(), "total_ms")


@query("r27_time_by_user", time_by_sql("query_rows", ["user_name"], "account = 'acc-1'"))
def _(t):
    return RQ.time_by(t.query_rows, ["user_name"], MONTH, accounts="acc-1").select("user_name", at(), "total_ms")


def top_time_sql(rows: str, key: str) -> str:
    return f"SELECT {key}, sum(execution_time)::BIGINT AS total_ms FROM {rows} WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY total_ms DESC, {key} LIMIT 20"


@query("r28_top_tables", top_time_sql(TABLE_ROWS, "table_name"))
def _(t):
    return RQ.top_by_time(RQ.tables_of(t.query_rows), "table_name")


@query("r28_top_users", top_time_sql("query_rows", "user_name"))
def _(t):
    return RQ.top_by_time(t.query_rows, "user_name")


@query("r28_top_databases", top_time_sql("query_rows", "database_name"))
def _(t):
    return RQ.top_by_time(t.query_rows, "database_name")


@query(
    "r29_time_per_row",
    f"""WITH s AS (SELECT table_name, epoch_us(date_trunc('day', start_time)) // 1000000 AS bin_s, avg(execution_time) AS mean_ms FROM {TABLE_ROWS} WHERE table_name IS NOT NULL GROUP BY ALL),
        l AS (SELECT table_name, epoch_us(date_trunc('day', ts)) // 1000000 AS bin_s, max(row_count) AS top_rows FROM table_metrics GROUP BY ALL),
        ok AS (SELECT table_name FROM l GROUP BY table_name HAVING min(top_rows) > 0)
        SELECT s.table_name, s.bin_s, round(mean_ms / top_rows, 4) AS ms_per_row FROM s JOIN ok ON s.table_name = ok.table_name LEFT JOIN l ON s.table_name = l.table_name AND s.bin_s = l.bin_s""",
)
def _(t):
    return RQ.time_per_row(t.query_rows, t.table_metrics).select("table_name", at(), F.round("ms_per_row", 4).alias("ms_per_row"))


@query(
    "r30_phases_over_time",
    "WITH " + grid_sql("query_rows", "start_time", [], 7 * DAY, {"compilation": "avg(compilation_time)", "execution": "avg(execution_time)", "queued_overload": "avg(queued_overload_time)", "queued_provisioning": "avg(queued_provisioning_time)"})
    + "SELECT bin_s, round(compilation, 4) AS compilation, round(execution, 4) AS execution, round(queued_overload, 4) AS queued_overload, round(queued_provisioning, 4) AS queued_provisioning FROM series",
)
def _(t):
    return RQ.phases_over_time(t.query_rows, 7 * DAY).select(at(), *[F.round(n, 4).alias(n) for n in RQ.PHASES])


@query(
    "r30_phases_by_warehouse",
    """SELECT warehouse_name, sum(compilation_time)::BIGINT AS compilation, sum(execution_time)::BIGINT AS execution, sum(queued_overload_time)::BIGINT AS queued_overload, sum(queued_provisioning_time)::BIGINT AS queued_provisioning
       FROM query_rows GROUP BY ALL ORDER BY execution DESC, warehouse_name LIMIT 20""",
)
def _(t):
    return RQ.phases_by_warehouse(t.query_rows)


TAG_ROWS = "tg AS (SELECT * EXCLUDE (query_tag), regexp_replace(query_tag, '[0-9]+', '#', 'g') AS query_tag FROM query_rows WHERE query_tag <> '')"


@query(
    "r31_time_by_tag",
    "WITH " + TAG_ROWS + ", " + grid_sql("tg", "start_time", ["query_tag"], MONTH, {"mean_ms": "avg(execution_time)"})
    + ", best AS (SELECT query_tag FROM points GROUP BY query_tag ORDER BY sum(mean_ms) DESC, query_tag LIMIT 3) SELECT query_tag, bin_s, round(mean_ms, 4) AS mean_ms FROM series JOIN best USING (query_tag)",
)
def _(t):
    return RQ.time_by_tag(t.query_rows, "[0-9]+", 3, MONTH).select("query_tag", at(), F.round("mean_ms", 4).alias("mean_ms"))


@query("r31_top_tags", "WITH " + TAG_ROWS + " SELECT query_tag, sum(total_elapsed_time)::BIGINT AS total FROM tg GROUP BY ALL ORDER BY total DESC, query_tag LIMIT 3")
def _(t):
    return RQ.top_tags(t.query_rows, "[0-9]+", 3)


@query(
    "r32_active_summary",
    "SELECT warehouse_name, account, count(*) AS n, min(total_elapsed_time) AS fastest, max(total_elapsed_time) AS slowest, round(avg(total_elapsed_time), 4) AS mean FROM active_log GROUP BY ALL",
)
def _(t):
    return RQ.active_summary(t.active_log).withColumn("mean", F.round("mean", 4))


@query(
    "r32_active_long_running",
    """SELECT query_id, run_no, epoch_us(seen_at) // 1000 - total_elapsed_time AS started_ms, total_elapsed_time AS duration_ms, user_name, warehouse_name, execution_status, query_text AS query, account
       FROM active_log WHERE total_elapsed_time > 60000 * 2 ORDER BY total_elapsed_time DESC, query_id, run_no LIMIT 20""",
)
def _(t):
    return RQ.active_long_running(t.active_log, 2)


# --- R33: quality --------------------------------------------------------------------------

CARTESIAN = "ct AS (SELECT q.* FROM query_rows AS q WHERE query_id IN (SELECT query_id FROM operator_rows WHERE operator_type = 'Join' AND input_rows < output_rows))"


@query("r33_cartesian_log", f"WITH {CARTESIAN} SELECT query_id, user_name, account, query_type, total_elapsed_time AS elapsed FROM ct")
def _(t):
    return RQ.cartesian_log(statement_spans(t)).select("query_id", "user_name", "account", "query_type", "elapsed")


@query("r33_cartesian_over_time", f"WITH {CARTESIAN}, ck AS (SELECT upper(account) AS key, start_time FROM ct), " + grid_sql("ck", "start_time", ["key"], DAY, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return RQ.cartesian_over_time(statement_spans(t), F.upper("account")).select("key", at(), "n")


@query("r33_cartesian_over_time_by_operation", f"WITH {CARTESIAN}, ck AS (SELECT upper(query_type) AS key, start_time FROM ct), " + grid_sql("ck", "start_time", ["key"], 7 * DAY, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return RQ.cartesian_over_time(statement_spans(t), F.upper("query_type"), 7 * DAY).select("key", at(), "n")


@query("r33_cartesian_over_time_by_user", f"WITH {CARTESIAN}, ck AS (SELECT user_name AS key, start_time FROM ct), " + grid_sql("ck", "start_time", ["key"], MONTH, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return RQ.cartesian_over_time(statement_spans(t), c("user_name"), MONTH).select("key", at(), "n")


@query("r33_cartesian_by_environment", f"WITH {CARTESIAN} SELECT upper(account) AS key, count(*) AS n FROM ct GROUP BY ALL")
def _(t):
    return RQ.cartesian_by(statement_spans(t), F.upper("account"))


@query("r33_cartesian_by_operation", f"WITH {CARTESIAN} SELECT upper(query_type) AS key, count(*) AS n FROM ct GROUP BY ALL")
def _(t):
    return RQ.cartesian_by(statement_spans(t), F.upper("query_type"))


@query("r33_cartesian_by_user", f"WITH {CARTESIAN} SELECT user_name AS key, count(*) AS n FROM ct GROUP BY ALL ORDER BY n DESC, key LIMIT 10")
def _(t):
    return RQ.cartesian_by(statement_spans(t), c("user_name"), 10)


# --- R34, R35: self-monitoring -------------------------------------------------------------

RUNS = "rn AS (SELECT account, exec_id, plugin, min(ts) AS started, epoch_us(max(ts)) - epoch_us(min(ts)) AS us, count(*) AS records FROM run_status GROUP BY ALL)"


@query(
    "r34_run_duration",
    f"WITH {RUNS}, " + grid_sql("rn", "started", ["plugin"], DAY, {"duration_us": "sum(us)::BIGINT"}, where="records > 1 AND plugin <> 'deployment'") + "SELECT * FROM series",
)
def _(t):
    return RO.run_duration(t.run_status).select("plugin", at(), "duration_us")


@query("r34_run_failures", "WITH " + grid_sql("run_status", "ts", ["plugin", "status"], DAY, {"n": "count(*)"}, where="status = 'FAILED'") + "SELECT * FROM series")
def _(t):
    return RO.run_failures(t.run_status).select("plugin", "status", at(), "n")


@query("r34_run_counts", f"WITH {RUNS} SELECT plugin, count(*) AS runs FROM rn WHERE records > 1 GROUP BY plugin")
def _(t):
    return RO.run_counts(t.run_status)


@query("r34_run_total_time", f"WITH {RUNS} SELECT plugin, sum(us)::BIGINT AS total_us FROM rn GROUP BY plugin")
def _(t):
    return RO.run_total_time(t.run_status)


def kinds_of(t):
    return {
        "bizevents": t.run_status,
        "events": t.login_log,
        "logs": t.event_log.filter("record_type = 'LOG'"),
        "spans": t.event_log.filter("record_type = 'SPAN'"),
    }


KINDS = """kd AS (SELECT account, 'bizevents' AS kind, ts FROM run_status UNION ALL SELECT account, 'events', ts FROM login_log UNION ALL SELECT account, 'logs', ts FROM event_log WHERE record_type = 'LOG'
  UNION ALL SELECT account, 'spans', ts FROM event_log WHERE record_type = 'SPAN')"""


@query("r35_volume_by_kind", f"WITH {KINDS}, " + grid_sql("kd", "ts", ["account", "kind"], DAY, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return RO.volume_by_kind(kinds_of(t), ["account"]).select("account", "kind", at(), "n")


@query("r35_records_by_collector", "SELECT plugin, count(*) AS n FROM run_status GROUP BY plugin")
def _(t):
    return RO.records_by(t.run_status, ["plugin"])


@query("r35_accounts", "SELECT account, host_name, count(*) AS n FROM run_status GROUP BY ALL")
def _(t):
    return RO.records_by(t.run_status, ["account", "host_name"])


@query("r35_last_runs", "SELECT event_id, plugin, account FROM run_status")
def _(t):
    return RO.last_runs(t.run_status).drop("ts")


@query(
    "r35_failed_calls",
    """SELECT query_id, database_name, execution_status, error_code, unnest(regexp_extract_all(query_text, '''([^'']*)''', 1)) AS plugin_name FROM query_rows WHERE query_text LIKE 'call SELF_DB.APP.RUN%' AND execution_status <> 'SUCCESS'""",
)
def _(t):
    return RO.failed_calls(t.query_rows, r"call SELF(?:_\w+)?_DB\.APP\.RUN\(ARRAY_CONSTRUCT\(").drop("start_time")


# --- R36, R37: shares ----------------------------------------------------------------------


@query(
    "r36_share_counts",
    "SELECT 'OUTBOUND' AS kind, count(DISTINCT share_name) AS n FROM share_log WHERE kind = 'OUTBOUND' UNION ALL SELECT 'INBOUND', count(DISTINCT share_name) FROM share_log WHERE kind = 'INBOUND'",
)
def _(t):
    parts = [RD.share_count(t.share_log, k).select(F.lit(k).alias("kind"), "n") for k in ("OUTBOUND", "INBOUND")]
    return parts[0].unionByName(parts[1])


def first_columns(rows: str, keys: str, columns: list[str], where: str = "true") -> str:
    return f"(SELECT {keys}, {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts, event_id) AS n FROM {rows} WHERE {where}) WHERE n = 1)"


@query(
    "r36_share_inventory",
    f"""SELECT f.*, l.last_us FROM {first_columns('share_log', 'share_name, kind', ['owner', 'is_secure', 'database_name', 'account'], 'share_name IS NOT NULL')} AS f
        JOIN (SELECT share_name, kind, epoch_us(max(ts)) AS last_us FROM share_log GROUP BY ALL) AS l ON f.share_name = l.share_name AND f.kind = l.kind""",
)
def _(t):
    return RD.share_inventory(t.share_log).withColumn("last_us", F.unix_micros("last_seen")).drop("last_seen")


@query(
    "r36_unavailable_shares",
    f"""SELECT f.share_name, f.account, f.error_message AS error, f.database_name, l.last_us FROM {first_columns('share_log', 'share_name, account', ['error_message', 'database_name'], "context = 'inbound_shares' AND share_status = 'UNAVAILABLE'")} AS f
        JOIN (SELECT share_name, account, epoch_us(max(ts)) AS last_us FROM share_log WHERE context = 'inbound_shares' AND share_status = 'UNAVAILABLE' GROUP BY ALL) AS l ON f.share_name IS NOT DISTINCT FROM l.share_name AND f.account = l.account""",
)
def _(t):
    return RD.unavailable_shares(t.share_log).withColumn("last_us", F.unix_micros("last_seen")).drop("last_seen")


@query("r36_share_availability", "SELECT share_name, coalesce(share_status, 'AVAILABLE') AS share_status, count(DISTINCT table_name) AS n FROM share_log WHERE context = 'inbound_shares' GROUP BY ALL")
def _(t):
    return RD.share_availability(t.share_log)


@query("r37_shared_tables", "SELECT share_name, table_name, max(row_count) AS row_count, max(bytes) AS size_bytes FROM share_log WHERE context = 'inbound_shares' AND row_count IS NOT NULL GROUP BY ALL")
def _(t):
    return RD.shared_tables(t.share_log)


@query(
    "r37_vanished_shares",
    """SELECT account, share_name, database_name, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM share_log WHERE context = 'inbound_shares' GROUP BY account, share_name, database_name
       HAVING max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR""",
)
def _(t):
    out = RD.vanished_shares(t.share_log, NOW, hours=48)
    return out.select("account", "share_name", "database_name", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"))


@query(
    "r37_secure_compliance",
    "SELECT CASE WHEN is_secure = 'true' THEN 'Compliant (Secure Only)' ELSE 'Non-Compliant (Insecure Objects)' END AS compliance, n FROM (SELECT is_secure, count(DISTINCT share_name) AS n FROM share_log WHERE kind = 'OUTBOUND' GROUP BY is_secure)",
)
def _(t):
    return RD.secure_compliance(t.share_log)


@query(
    "r37_share_grants",
    f"""SELECT * FROM {first_columns('share_log', 'share_name, grantee, privilege, grant_name', ['granted_on', 'granted_by', 'database_name'], "context = 'outbound_shares' AND privilege IS NOT NULL")}""",
)
def _(t):
    return RD.share_grants(t.share_log)


@query("r37_top_grantees", "SELECT grantee, count(*) AS grants FROM share_log WHERE kind = 'OUTBOUND' AND grantee IS NOT NULL GROUP BY ALL ORDER BY grants DESC, grantee LIMIT 20")
def _(t):
    return RD.top_grantees(t.share_log)


# --- R38 to R42: security ------------------------------------------------------------------


@query(
    "r38_login_problem_users",
    "SELECT sha1(user_name) AS user_hash, count(*) AS n FROM login_log WHERE error_code IS NOT NULL AND user_name LIKE '%.%' GROUP BY ALL ORDER BY n DESC, user_hash LIMIT 10",
)
def _(t):
    return RO.login_problem_users(t.login_log, kinds=["Human user"])


@query(
    "r38_login_problem_addresses",
    "SELECT substr(client_ip, 1, 3) AS client_ip, count(*) AS n FROM login_log WHERE error_code IS NOT NULL AND client_ip <> '0.0.0.0' GROUP BY ALL ORDER BY n DESC, 1 LIMIT 10",
)
def _(t):
    return RO.login_problem_addresses(t.login_log)


@query("r38_login_problem_accounts", "SELECT account, count(*) AS n FROM login_log WHERE error_code IS NOT NULL AND user_name NOT LIKE '%.%' GROUP BY ALL ORDER BY n DESC, account LIMIT 10")
def _(t):
    return RO.login_problem_accounts(t.login_log, kinds=["Service user"])


def bins_sql(rows: str, time: str, keys: list[str], bins: int = 20) -> str:
    """Gap-free counts over the range of the rows cut into bins."""
    key = ", ".join(keys)
    same = " AND ".join(f"k.{x} IS NOT DISTINCT FROM p.{x}" for x in keys)
    return f"""r AS (SELECT greatest(ceil((epoch_us(max({time})) // 1000000 - epoch_us(min({time})) // 1000000) / {bins}.0), 1)::BIGINT AS step FROM {rows}),
       points AS (SELECT {key}, epoch_us({time}) // 1000000 - epoch_us({time}) // 1000000 % step AS bin_s, count(*) AS n FROM {rows}, r GROUP BY ALL),
       bins AS (SELECT unnest(generate_series(lo, hi, step)) AS bin_s FROM (SELECT min(bin_s) AS lo, max(bin_s) AS hi, any_value(step) AS step FROM points, r))
       SELECT {', '.join('k.' + x for x in keys)}, g.bin_s, p.n FROM (SELECT DISTINCT {key} FROM points) AS k CROSS JOIN bins AS g LEFT JOIN points AS p ON p.bin_s = g.bin_s AND {same}"""


@query("r38_login_problems_over_time", "WITH fl AS (SELECT * FROM login_log WHERE error_code IS NOT NULL), " + bins_sql("fl", "ts", ["error_message", "account"]))
def _(t):
    return RO.login_problems_over_time(t.login_log).select("error_message", "account", at(), "n")


@query("r38_login_problem_list", "SELECT event_id, account, sha1(user_name) AS user_hash, error_message FROM login_log WHERE error_code IS NOT NULL")
def _(t):
    return RO.login_problem_list(t.login_log).drop("ts")


ADMIN = "ad AS (SELECT * FROM query_rows WHERE role_name IN ('ACCOUNTADMIN', 'SECURITYADMIN', 'SYSADMIN', 'USERADMIN') AND user_name <> 'SYSTEM')"


@query("r39_admin_over_time", f"WITH {ADMIN}, " + bins_sql("ad", "start_time", ["user_name", "role_name"]))
def _(t):
    return RO.admin_over_time(t.query_rows).select("user_name", "role_name", at(), "n")


@query("r39_admin_top_users", f"WITH {ADMIN} SELECT user_name, count(*) AS n FROM ad GROUP BY ALL ORDER BY n DESC, user_name LIMIT 10")
def _(t):
    return RO.admin_top(t.query_rows, "user_name")


@query("r39_admin_top_roles", f"WITH {ADMIN} SELECT role_name, count(*) AS n FROM ad WHERE query_type = 'SELECT' GROUP BY ALL ORDER BY n DESC, role_name LIMIT 10")
def _(t):
    return RO.admin_top(t.query_rows, "role_name", query_type="SELECT")


@query("r39_admin_top_accounts", f"WITH {ADMIN} SELECT account, count(*) AS n FROM ad GROUP BY ALL ORDER BY n DESC, account LIMIT 10")
def _(t):
    return RO.admin_top(t.query_rows, "account")


@query("r39_admin_latest", f"WITH {ADMIN} SELECT query_id, user_name, role_name, account, query_text, query_type, execution_status FROM ad")
def _(t):
    return RO.admin_latest(t.query_rows).drop("start_time")


def finding_sides(t):
    logs = t.finding_log.filter("event_id % 2 = 0")
    events = t.finding_log.filter("event_id % 2 = 1").select("event_id", "ts", "severity", "scanner_id", "account")
    return logs, events


FINDINGS = """fl AS (SELECT ts, message, category, severity, scanner_type, scanner_id, account FROM finding_log WHERE event_id % 2 = 0
  UNION ALL SELECT ts, NULL, NULL, severity, NULL, scanner_id, account FROM finding_log WHERE event_id % 2 = 1)"""


@query(
    "r40_latest_violations",
    f"WITH {FINDINGS} SELECT message, category, severity, scanner_type, scanner_id, account, strftime(max(ts), '%Y-%m-%d') AS scan_date FROM fl WHERE severity IN ('HIGH', 'CRITICAL') GROUP BY ALL",
)
def _(t):
    return RO.latest_violations(*finding_sides(t), severity=["HIGH", "CRITICAL"])


@query("r40_violating_scanners", f"WITH {FINDINGS}, " + grid_sql("fl", "ts", ["severity", "account"], 6 * 3600, {"scanners": "count(DISTINCT scanner_id)"}) + "SELECT * FROM series")
def _(t):
    return RO.violating_scanners(*finding_sides(t), step_s=6 * 3600).select("severity", "account", at(), "scanners")


@query("r41_users_by_factor", "SELECT first_factor, count(DISTINCT user_name) AS users FROM login_log WHERE first_factor IS NOT NULL GROUP BY ALL")
def _(t):
    return RO.users_by_factor(t.login_log)


@query("r41_password_users", "SELECT count(DISTINCT user_name) AS users FROM login_log WHERE first_factor = 'PASSWORD' AND user_name LIKE '%.%'")
def _(t):
    return RO.password_users(t.login_log, kinds=["Human user"])


@query(
    "r41_password_logins",
    "SELECT account, sha1(user_name) AS user_hash, first_factor, coalesce(second_factor, '-') AS second_factor, epoch_us(max(ts)) AS last_us FROM login_log WHERE first_factor = 'PASSWORD' GROUP BY account, user_name, first_factor, coalesce(second_factor, '-')",
)
def _(t):
    out = RO.password_logins(t.login_log)
    return out.select("account", "user_hash", "first_factor", "second_factor", F.unix_micros("last_attempt").alias("last_us"))


@query("r42_revocations", "SELECT user_name, role, epoch_us(deleted_on) AS deleted_us FROM user_grants WHERE deleted_on IS NOT NULL")
def _(t):
    return RO.revocations(t.user_grants).select("user_name", "role", F.unix_micros("deleted_on").alias("deleted_us"))


@query(
    "r42_account_status",
    "SELECT CASE WHEN is_disabled = 'true' THEN 'Disabled' WHEN is_locked = 'true' THEN 'Locked' ELSE 'Active' END AS status, count(*) AS n FROM user_log WHERE is_disabled IS NOT NULL GROUP BY ALL",
)
def _(t):
    return RO.account_status(t.user_log)


@query("r42_mfa_share", "SELECT CASE WHEN has_mfa THEN 'MFA Enrolled' ELSE 'No MFA' END AS status, count(*) AS n FROM user_log GROUP BY ALL")
def _(t):
    return RO.flag_share(t.user_log, "has_mfa", "MFA Enrolled", "No MFA")


@query("r42_key_share", "SELECT CASE WHEN has_rsa THEN 'RSA Configured' ELSE 'No RSA' END AS status, count(*) AS n FROM user_log GROUP BY ALL")
def _(t):
    return RO.flag_share(t.user_log, "has_rsa", "RSA Configured", "No RSA")


@query("r42_password_only", "SELECT login_name AS user_name, user_type, owner, account FROM user_log WHERE has_password AND NOT has_mfa AND NOT has_rsa AND NOT has_pat")
def _(t):
    return RO.password_only(t.user_log)


# --- R43, R44: pipes -----------------------------------------------------------------------


@query(
    "r43_pipe_health",
    "WITH " + grid_sql("pipe_log", "ts", [], DAY, {"total": "count(*)", "running": "count(*) FILTER (WHERE pipe_status = 'RUNNING')"}, where="pipe_status IS NOT NULL")
    + "SELECT bin_s, round(100.0::DOUBLE * running / total, 6) AS health_pct FROM series",
)
def _(t):
    return RD.pipe_health(t.pipe_log).select(at(), F.round("health_pct", 6).alias("health_pct"))


@query(
    "r43_totals",
    """SELECT 'credits' AS measure, sum(credits_used)::BIGINT AS total FROM pipe_usage UNION ALL SELECT 'files', count(*) FILTER (WHERE status = 'Loaded') FROM copy_history
       UNION ALL SELECT 'bytes', sum(file_size)::BIGINT FROM copy_history""",
)
def _(t):
    files = t.copy_history.withColumn("loaded", F.when(c("status") == "Loaded", 1).otherwise(0).cast("bigint"))
    parts = [
        RD.measure_total(rows, measure).select(F.lit(name).alias("measure"), "total")
        for name, rows, measure in (("credits", t.pipe_usage, "credits_used"), ("files", files, "loaded"), ("bytes", t.copy_history, "file_size"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("r43_latency_p95", "SELECT epoch_us(date_trunc('day', loaded_at)) // 1000000 AS bin_s, round(quantile_cont(latency_ms, 0.95), 4) AS p95_latency FROM copy_history GROUP BY ALL")
def _(t):
    return RD.latency_p95(t.copy_history).select(at(), F.round("p95_latency", 4).alias("p95_latency"))


@query(
    "r43_errors",
    "WITH " + grid_sql("copy_history", "loaded_at", [], DAY, {"e": "sum(error_count)::BIGINT", "p": "sum(pipe_errors)::BIGINT"}) + "SELECT bin_s, e + p AS total_errors FROM series",
)
def _(t):
    return RD.copy_errors(t.copy_history).select(at(), "total_errors")


@query(
    "r44_pipe_states",
    """SELECT pipe_name, account, pipe_status AS status, (CASE pipe_status WHEN 'RUNNING' THEN 1 WHEN 'PAUSED' THEN 2 ELSE 3 END)::BIGINT AS state_code FROM
       (SELECT *, row_number() OVER (PARTITION BY pipe_name, account ORDER BY ts DESC, event_id DESC) AS n FROM pipe_log WHERE pipe_status IS NOT NULL) WHERE n = 1""",
)
def _(t):
    return RD.pipe_states(t.pipe_log)


@query(
    "r44_ingest_latency",
    "WITH " + grid_sql("copy_history", "loaded_at", ["pipe_name", "account"], MONTH, {"latency": "avg(latency_ms)"})
    + "SELECT pipe_name, account, bin_s, round(latency, 4) AS latency, 30000.0::DOUBLE AS threshold_warning, 60000.0::DOUBLE AS threshold_critical FROM series",
)
def _(t):
    out = RD.ingest_latency(t.copy_history, 30_000, 60_000, MONTH)
    return out.select("pipe_name", "account", at(), F.round("latency", 4).alias("latency"), "threshold_warning", "threshold_critical")


@query(
    "r44_stage_backlog",
    "WITH " + grid_sql("pipe_log", "ts", ["pipe_name", "account"], DAY, {"pending": "sum(pending_files)::BIGINT"}, where="pipe_name IN ('PIPE_1', 'PIPE_2', 'PIPE_3')")
    + "SELECT pipe_name, account, bin_s, pending, 10.0::DOUBLE AS threshold_warning, 20.0::DOUBLE AS threshold_critical FROM series",
)
def _(t):
    out = RD.stage_backlog(t.pipe_log, 10, 20, pipe_name=["PIPE_1", "PIPE_2", "PIPE_3"])
    return out.select("pipe_name", "account", at(), "pending", "threshold_warning", "threshold_critical")


@query("r44_ingested_per_hour", "SELECT database_name, pipe_name, epoch_us(date_trunc('hour', loaded_at)) // 1000000 AS bin_s, sum(file_size)::BIGINT AS data FROM copy_history GROUP BY ALL")
def _(t):
    return RD.ingested_per_hour(t.copy_history).select("database_name", "pipe_name", at(), "data")


@query("r44_errors_by_table", "SELECT table_name, (sum(pipe_errors) + sum(error_count))::BIGINT AS total_errors FROM copy_history GROUP BY ALL")
def _(t):
    return RD.errors_by_table(t.copy_history)


@query(
    "r44_top_error_pipes",
    "SELECT pipe_name, table_name, database_name, (sum(pipe_errors) + sum(error_count))::BIGINT AS total_errors FROM copy_history GROUP BY ALL ORDER BY total_errors DESC, pipe_name, table_name, database_name LIMIT 50",
)
def _(t):
    return RD.top_error_pipes(t.copy_history)


@query("r44_credits_over_time", "WITH " + grid_sql("pipe_usage", "end_time", ["pipe_name", "account"], MONTH, {"credits": "sum(credits_used)::BIGINT"}) + "SELECT * FROM series")
def _(t):
    return RD.credits_over_time(t.pipe_usage, ["pipe_name", "account"], "end_time", "credits_used", MONTH).select("pipe_name", "account", at(), "credits")


# --- R45 to R48: tasks and dynamic tables --------------------------------------------------


@query("r45_task_states", "WITH " + grid_sql("task_history", "ts", ["state", "account"], DAY, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return RD.task_states(t.task_history).select("state", "account", at(), "n")


@query("r45_task_failures", "SELECT event_id, account, database_name, schema_name, task_name, attempt, error_code FROM task_history WHERE state = 'FAILED'")
def _(t):
    return RD.task_failures(t.task_history).drop("ts")


@query(
    "r45_task_duration",
    "WITH th AS (SELECT *, (epoch_us(completed_time) - epoch_us(scheduled_time)) / 1000000 AS s FROM task_history WHERE completed_time IS NOT NULL AND scheduled_time IS NOT NULL), "
    + grid_sql("th", "ts", ["task_name", "account"], DAY, {"d": "avg(s)"}) + "SELECT task_name, account, bin_s, round(d, 4) AS avg_duration FROM series",
)
def _(t):
    return RD.task_duration(t.task_history).select("task_name", "account", at(), F.round("avg_duration", 4).alias("avg_duration"))


@query("r45_task_retries", "WITH " + grid_sql("task_history", "ts", ["task_name", "account"], DAY, {"retries": "count(*)"}, where="attempt > 1") + "SELECT * FROM series")
def _(t):
    return RD.task_retries(t.task_history).select("task_name", "account", at(), "retries")


@query("r46_serverless_total", "SELECT coalesce(sum(credits_used), 0)::BIGINT AS total_credits FROM serverless_tasks WHERE database_name IS NULL OR database_name IN ('DB_1', 'DB_2')")
def _(t):
    return RD.serverless_total(t.serverless_tasks, database_name=["DB_1", "DB_2"])


@query(
    "r46_serverless_over_time",
    "WITH " + grid_sql("serverless_tasks", "end_time", ["task_name", "account", "database_name", "schema_name"], MONTH, {"credits": "sum(credits_used)::BIGINT"}, "0") + "SELECT * FROM series",
)
def _(t):
    keys = ["task_name", "account", "database_name", "schema_name"]
    return RD.credits_over_time(t.serverless_tasks, keys, "end_time", "credits_used", MONTH, default=0).select(*keys, at(), "credits")


@query("r46_serverless_by_task", "SELECT task_name, account, database_name, schema_name, sum(credits_used)::BIGINT AS credits FROM serverless_tasks GROUP BY ALL")
def _(t):
    return RD.serverless_by_task(t.serverless_tasks)


@query(
    "r47_scheduling_states",
    """SELECT table_name, account, scheduling_state AS state, (CASE scheduling_state WHEN 'ACTIVE' THEN 1 WHEN 'SUSPENDED' THEN 2 ELSE 3 END)::BIGINT AS state_code FROM
       (SELECT *, row_number() OVER (PARTITION BY table_name, account ORDER BY ts DESC, row_no DESC) AS n FROM dynamic_tables WHERE scheduling_state <> '') WHERE n = 1""",
)
def _(t):
    return RD.scheduling_states(t.dynamic_tables)


@query(
    "r47_lag_over_time",
    "WITH " + grid_sql("dynamic_tables", "ts", ["table_name", "account"], 6 * 3600, {"m": "avg(mean_lag)", "x": "max(max_lag)"}, where="mean_lag IS NOT NULL")
    + "SELECT table_name, account, bin_s, round(m, 4) AS mean_lag, x AS max_lag FROM series",
)
def _(t):
    return RD.lag_over_time(t.dynamic_tables, 6 * 3600).select("table_name", "account", at(), F.round("mean_lag", 4).alias("mean_lag"), "max_lag")


@query("r47_time_above_target", "WITH " + grid_sql("dynamic_tables", "ts", ["table_name", "account"], 6 * 3600, {"above": "max(time_above)"}) + "SELECT * FROM series")
def _(t):
    return RD.time_above_target(t.dynamic_tables, 6 * 3600).select("table_name", "account", at(), "above")


@query("r47_within_target", "SELECT full_name, account, round(avg(within_points / 100), 6) AS ratio FROM dynamic_tables GROUP BY ALL")
def _(t):
    return RD.within_target(t.dynamic_tables).withColumn("ratio", F.round("ratio", 6))


@query(
    "r48_refresh_history",
    "SELECT row_no, account, full_name, state, refresh_action, refresh_trigger, state_code FROM dynamic_refreshes",
)
def _(t):
    return RD.refresh_history(t.dynamic_refreshes).drop("data_timestamp")


@query("r48_refresh_actions", "SELECT refresh_action, count(*) AS n FROM dynamic_refreshes WHERE refresh_action IS NOT NULL GROUP BY ALL")
def _(t):
    return RD.refresh_actions(t.dynamic_refreshes)
