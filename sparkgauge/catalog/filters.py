"""Inventory 2.3: filters and predicates."""

import datetime as dt

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.functions import text as X
from sparkgauge.operators import predicates as P

c = F.col
QUERY_AS_OF = dt.datetime(2001, 8, 2)
EVENT_AS_OF = dt.datetime(2024, 1, 31)


@query(
    "f1_include_exclude",
    r"""SELECT table_id, full_name FROM inventory WHERE EXISTS (SELECT 1 FROM include_patterns AS p WHERE full_name LIKE p.pattern ESCAPE '\')
        AND NOT EXISTS (SELECT 1 FROM exclude_patterns AS p WHERE full_name LIKE p.pattern ESCAPE '\')""",
)
def _(t):
    return P.include_exclude(t.inventory, "full_name", t.include_patterns, t.exclude_patterns).select("table_id", "full_name")


@query(
    "f1_include_exclude_long_lists",
    r"""SELECT table_id FROM inventory WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT replace(database_name, '_', '\_') || '.%\_' || (table_id % 100)::VARCHAR AS pattern FROM inventory WHERE row_count > 20000) AS p WHERE full_name LIKE p.pattern ESCAPE '\')
       AND NOT EXISTS (SELECT 1 FROM (SELECT full_name AS pattern FROM inventory WHERE table_type = 'VIEW') AS p WHERE full_name = p.pattern)""",
)
def _(t):
    def escaped(column):
        return F.replace(column, F.lit("_"), F.lit("\\_"))

    include = t.inventory.filter("row_count > 20000").select(
        F.concat(escaped(c("database_name")), F.lit(".%\\_"), (c("table_id") % 100).cast("string")).alias("pattern")
    )
    exclude = t.inventory.filter("table_type = 'VIEW'").select(escaped(c("full_name")).alias("pattern"))
    return P.include_exclude(t.inventory, "full_name", include, exclude).select("table_id")


@query(
    "f2_since_last_run",
    "SELECT event_id FROM event_log WHERE ts > greatest(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 480 HOUR)",
)
def _(t):
    return P.since_last_run(t.event_log, "ts", EVENT_AS_OF, dt.datetime(2024, 1, 10), hours=480).select("event_id")


@query(
    "f3_any_time_newer",
    "SELECT event_id FROM task_history WHERE greatest(query_start_time, scheduled_time, completed_time) > TIMESTAMP '2024-01-15 00:00:00'",
)
def _(t):
    return P.any_time_newer(
        t.task_history, ["query_start_time", "scheduled_time", "completed_time"], dt.datetime(2024, 1, 15)
    ).select("event_id")


@query(
    "f4_database_scope",
    r"""SELECT event_id, (coalesce(database_name, '') LIKE 'SELF%' OR coalesce(database_name, '') LIKE 'OPS%')
        AND (coalesce(database_name, '') NOT LIKE 'SELF%\_DB' ESCAPE '\' OR coalesce(database_name, '') = 'SELF_DB') AS kept_own,
        coalesce(database_name, '') LIKE 'OPS%' AS kept_ops FROM event_log""",
)
def _(t):
    name = c("database_name")
    return t.event_log.select(
        "event_id",
        P.database_scope(name, ["SELF%", "OPS%"], own="SELF_DB", family="SELF%\\_DB", cross_tenant=False).alias("kept_own"),
        P.database_scope(name, ["OPS%"], own="SELF_DB", family="SELF%\\_DB").alias("kept_ops"),
    )


NOISE_SQL = r"""NOT regexp_full_match(scope_name, 'SELF(_\S*)?_OTLP') AND value_text NOT LIKE 'Sent log%Sent log%'
  AND record_type NOT IN ('METRIC', 'SPAN') AND (coalesce(database_name, '') NOT LIKE 'SELF%\_DB' ESCAPE '\' OR severity NOT IN ('DEBUG', 'INFO'))
  AND (application IS NULL OR application NOT IN ('openflow'))"""


def quiet_log(rows):
    return rows.filter(
        P.event_log_noise(
            scope=c("scope_name"), value=c("value_text"), record_type=c("record_type"), database=c("database_name"),
            severity=c("severity"), application=c("application"), own_scope=r"SELF(_\S*)?_OTLP", family="SELF%\\_DB",
        )
    )


@query("f5_event_log_noise", f"SELECT event_id FROM event_log WHERE {NOISE_SQL}")
def _(t):
    return quiet_log(t.event_log).select("event_id")


@query(
    "f6_system_noise",
    """SELECT query_id FROM query_log WHERE NOT coalesce(query_text = '' AND user_name = 'SYSTEM' AND role_name IS NULL AND database_name IS NULL AND schema_name IS NULL, false)
       AND NOT coalesce(query_text = '' AND database_name IS NULL, false)""",
)
def _(t):
    noise = P.system_noise(c("query_text"), c("user_name"), c("role_name"), c("database_name"), c("schema_name"))
    bare = P.system_noise(c("query_text"), F.lit("SYSTEM"), F.lit(None), c("database_name"), F.lit(None))
    return t.query_log.filter(~noise & ~bare).select("query_id")


@query("f7_status_allow_list", "SELECT query_id FROM query_log WHERE execution_status IN ('RUNNING', 'FAIL')")
def _(t):
    return t.query_log.filter(P.status_allow_list(c("execution_status"), ["RUNNING", "FAIL"])).filter(
        P.status_allow_list(c("execution_status"), [])
    ).select("query_id")


@query(
    "f8_affected_queries",
    """SELECT query_id FROM query_log WHERE query_type IN ('SELECT', 'INSERT', 'UPDATE') AND user_name NOT IN ('SYSTEM') AND
       (bytes_spilled_local > 0 OR bytes_spilled_remote > 0 OR queued_overload_time > 0 OR queued_provisioning_time > 0
        OR partitions_scanned * 10 > partitions_total * 9 OR transaction_blocked_time > 0 OR queued_repair_time > 0 OR execution_time > 150000)""",
)
def _(t):
    return P.affected_queries(t.query_log, slow_ms=150_000).select("query_id")


@query(
    "f9_acceleration_candidates",
    """SELECT query_uuid FROM query_log WHERE execution_time > 100000 AND bytes_spilled_local = 0 AND bytes_spilled_remote = 0
       AND partitions_scanned * 10 < partitions_total * 9 AND regexp_full_match(query_uuid, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')""",
)
def _(t):
    return P.acceleration_candidates(t.query_log, "query_uuid", slow_ms=100_000).select("query_uuid")


@query(
    "f10_optional_selector",
    """SELECT query_id FROM query_log WHERE (database_name IS NULL OR database_name IN ('DB_1', 'DB_2')) AND role_name IN ('ANALYST')""",
)
def _(t):
    return t.query_log.filter(
        P.optional_selector(c("database_name"), ["DB_1", "DB_2"])
        & P.optional_selector(c("user_name"), "*")
        & P.optional_selector(c("role_name"), "ANALYST", null_passes=False)
    ).select("query_id")


@query("f11_filter_out", "SELECT query_id FROM query_log WHERE NOT coalesce(role_name = 'ANALYST', false)")
def _(t):
    return P.filter_out(t.query_log, c("role_name") == "ANALYST").select("query_id")


@query("f12_user_kind", "SELECT event_id, CASE WHEN user_name LIKE '%.%' THEN 'Human user' ELSE 'Service user' END AS kind FROM login_log")
def _(t):
    return t.login_log.select("event_id", X.user_kind(c("user_name")).alias("kind"))


@query(
    "f13_recent_timestamp_events",
    """SELECT table_id, trigger, event_ns FROM (
         SELECT table_id, 'table.update' AS trigger, epoch_us(last_altered) * 1000 AS event_ns FROM inventory
         UNION ALL SELECT table_id, 'table.ddl', epoch_us(last_ddl) * 1000 FROM inventory) WHERE event_ns >= 1706400000000000000""",
)
def _(t):
    from sparkgauge.functions.sections import time_section

    rows = t.inventory.withColumn("times", time_section({"table.update": c("last_altered"), "table.ddl": c("last_ddl")}))
    return P.recent_timestamp_events(rows, "times", 1706400000000000000, "table_id")


@query("f14_soft_delete", "SELECT table_id, full_name FROM inventory WHERE deleted_on IS NULL OR deleted_on > TIMESTAMP '2024-01-25 00:00:00'")
def _(t):
    return P.not_deleted(t.inventory, "deleted_on", dt.datetime(2024, 1, 25)).select("table_id", "full_name")


@query("f15_prefix_any", r"SELECT query_id FROM query_log WHERE starts_with(warehouse_name, 'P1_') OR starts_with(warehouse_name, 'P3_')")
def _(t):
    return t.query_log.filter(P.prefix_any(c("warehouse_name"), ["P1", "P3"])).select("query_id")
