"""Query history and active queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.sections import merge_maps, text_section
from sparkgauge.operators.expand import flatten_pair_distinct
from sparkgauge.operators.joins import enrich_optional, not_processed, parent_flags, session_for_root, trace_for_query
from sparkgauge.operators.predicates import acceleration_candidates, affected_queries, status_allow_list, system_noise
from sparkgauge.operators.state import mode_switch
from sparkgauge.operators.windows import operator_timeline, top_n_slowest
from sparkgauge.plans.collectors.spec import RowSpec, at, instrument

# Members of a query-history row and the columns they come from.
QUERY_HISTORY = RowSpec(
    timestamp="start_time",
    start="start_time",
    end="end_time",
    name="lower(query_type) || ' ' || coalesce(database_name, '')",
    message="'New SQL Query at ' || coalesce(database_name, '')",
    status="CASE WHEN execution_status = 'SUCCESS' THEN 'OK' WHEN length(coalesce(execution_status, '')) > 0 THEN 'ERROR' ELSE 'UNSET' END",
    dimensions={
        "db.namespace": "database_name",
        "db.collection.name": "table_name",
        "db.operation.name": "query_type",
        "db.platform.dbs": "query_dbs",
        "db.user": "user_name",
        "platform.role.name": "role_name",
        "platform.warehouse.name": "warehouse_name",
        "platform.query.execution_status": "execution_status",
    },
    attributes={
        "db.query.text": "query_text",
        "db.platform.tables": "query_tables",
        "db.platform.views": "query_views",
        "session.id": "session_id",
        "event.id": "login_event_id",
        "authentication.type": "authentication_method",
        "client.application.id": "client_application_id",
        "client.application.version": "client_application_version",
        "client.environment": "client_environment",
        "client.build_id": "client_build_id",
        "client.version": "client_version",
        "platform.cluster_number": "cluster_number",
        "platform.query.id": "query_id",
        "platform.query.parent_id": "parent_query_id",
        "platform.query.tag": "query_tag",
        "platform.query.hash": "query_hash",
        "platform.query.hash_version": "query_hash_version",
        "platform.query.parametrized_hash": "query_parameterized_hash",
        "platform.query.parametrized_hash_version": "query_parameterized_hash_version",
        "platform.error.code": "error_code",
        "platform.error.message": "error_message",
        "platform.session.start": "created_on",
        "platform.session.closed_reason": "closed_reason",
        "platform.query.retry_cause": "query_retry_cause",
        "platform.secondary_role_stats": "secondary_role_stats",
        "platform.role.type": "role_type",
        "platform.query.transaction_id": "transaction_id",
        "platform.query.is_client_generated": "is_client_generated_statement",
        "platform.release_version": "release_version",
        "platform.query.data_transfer.inbound.region": "inbound_data_transfer_region",
        "platform.query.data_transfer.inbound.cloud": "inbound_data_transfer_cloud",
        "platform.query.data_transfer.outbound.cloud": "outbound_data_transfer_cloud",
        "platform.query.data_transfer.outbound.region": "outbound_data_transfer_region",
        "platform.warehouse.cluster.number": "cluster_number",
        "platform.warehouse.type": "warehouse_type",
        "platform.warehouse.size": "warehouse_size",
        "platform.warehouse.id": "warehouse_id",
        "platform.schema.name": "schema_name",
        "platform.schema.id": "schema_id",
        "platform.database.id": "database_id",
        "platform.query.with_operator_stats": "with_operator_stats",
    },
    metrics={
        "platform.data.scanned_from_cache": "percentage_scanned_from_cache",
        "platform.load.used": "query_load_percent",
        "platform.acceleration.scale_factor.max": "query_acceleration_upper_limit_scale_factor",
        "platform.time.queued.overload": "queued_overload_time",
        "platform.time.queued.provisioning": "queued_provisioning_time",
        "platform.time.repair": "queued_repair_time",
        "platform.time.total_elapsed": "total_elapsed_time",
        "platform.time.execution": "execution_time",
        "platform.time.child_queries_wait": "child_queries_wait_time",
        "platform.time.compilation": "compilation_time",
        "platform.time.transaction_blocked": "transaction_blocked_time",
        "platform.time.list_external_files": "list_external_files_time",
        "platform.time.fault_handling": "fault_handling_time",
        "platform.time.retry": "query_retry_time",
        "platform.credits.cloud_services": "credits_used_cloud_services",
        "platform.data.spilled.local": "bytes_spilled_to_local_storage",
        "platform.data.spilled.remote": "bytes_spilled_to_remote_storage",
        "platform.data.sent_over_the_network": "bytes_sent_over_the_network",
        "platform.data.transferred.inbound": "inbound_data_transfer_bytes",
        "platform.data.transferred.outbound": "outbound_data_transfer_bytes",
        "platform.data.read.from_result": "bytes_read_from_result",
        "platform.data.scanned": "bytes_scanned",
        "platform.data.deleted": "bytes_deleted",
        "platform.data.written": "bytes_written",
        "platform.data.written_to_result": "bytes_written_to_result",
        "platform.partitions.scanned": "partitions_scanned",
        "platform.partitions.total": "partitions_total",
        "platform.acceleration.data.scanned": "query_acceleration_bytes_scanned",
        "platform.acceleration.partitions.scanned": "query_acceleration_partitions_scanned",
        "platform.external_functions.invocations": "external_function_total_invocations",
        "platform.external_functions.data.received": "external_function_total_received_bytes",
        "platform.external_functions.rows.received": "external_function_total_received_rows",
        "platform.rows.written_to_result": "rows_written_to_result",
        "platform.external_functions.data.sent": "external_function_total_sent_bytes",
        "platform.external_functions.rows.sent": "external_function_total_sent_rows",
        "platform.rows.inserted": "rows_inserted",
        "platform.rows.updated": "rows_updated",
        "platform.rows.deleted": "rows_deleted",
        "platform.rows.unloaded": "rows_unloaded",
    },
)

# Members of an active-query row and the columns they come from.
ACTIVE_QUERIES = RowSpec(
    timestamp="end_time",
    start="start_time",
    end="end_time",
    name="'SQL query ' || execution_status || ' at ' || coalesce(database_name, '')",
    message="'SQL query ' || execution_status || ' at ' || coalesce(database_name, '')",
    dimensions={
        "db.namespace": "database_name",
        "platform.warehouse.name": "warehouse_name",
        "db.user": "user_name",
        "platform.role.name": "role_name",
        "platform.query.execution_status": "execution_status",
    },
    attributes={
        "db.query.text": "query_text",
        "db.operation.name": "query_type",
        "session.id": "session_id",
        "platform.query.id": "query_id",
        "platform.query.tag": "query_tag",
        "platform.query.hash": "query_hash",
        "platform.query.hash_version": "query_hash_version",
        "platform.query.parametrized_hash": "query_parameterized_hash",
        "platform.query.parametrized_hash_version": "query_parameterized_hash_version",
        "platform.error.code": "error_code",
        "platform.error.message": "error_message",
        "platform.warehouse.type": "warehouse_type",
        "platform.schema.name": "schema_name",
    },
    metrics={
        "platform.time.running": "running_time",
        "platform.time.execution": "execution_time",
        "platform.time.compilation": "compilation_time",
        "platform.time.total_elapsed": "total_elapsed_time",
        "platform.data.written_to_result": "bytes_written_to_result",
        "platform.rows.written_to_result": "rows_written_to_result",
    },
)

# Statuses of a statement that is still going on.
OPEN_STATUSES = ("RUNNING", "QUEUED", "RESUMING_WAREHOUSE")


def new_history(
    history: DataFrame, cache: DataFrame, access: DataFrame, sessions: DataFrame, records: DataFrame, as_of: dt.datetime, *, minutes: float = 120, session_hours: float = 24
) -> DataFrame:
    """Finished statements of the re-read window not yet processed, with flags, objects, trace and session.

    ``access`` holds (query_id, parent_query_id, base_objects, direct_objects), ``records`` the
    event log with ``resource_attributes`` as JSON text.
    """
    recent = history.filter(
        (F.col("end_time") >= F.lit(as_of - dt.timedelta(minutes=minutes))) & F.col("query_text").isNotNull()
    )
    fresh = not_processed(recent, cache).filter(
        ~system_noise(*[F.col(c) for c in ("query_text", "user_name", "role_name", "database_name", "schema_name")])
    )
    flagged = parent_flags(fresh, "query_id", "parent_query_id")
    with_objects = flagged.join(flatten_pair_distinct(access), "query_id", "left")
    first_table = F.get("query_tables", F.lit(0))
    named = with_objects.withColumns(
        {
            "table_name": first_table,
            "database_name": F.when(first_table.isNotNull(), F.split_part(first_table, F.lit("."), F.lit(1))).otherwise(
                F.col("database_name")
            ),
        }
    )
    traced = trace_for_query(named, records, "resource_attributes", "snow.query.id")
    return session_for_root(traced, sessions, as_of, session_hours)


def query_history(rows: DataFrame) -> DataFrame:
    """Instrumented rows of the new history with parent and root flags."""
    keep = ["query_id", "parent_query_id", "session_id", "span_id", "trace_id", "is_parent", "is_root"]
    return instrument(rows.withColumn("with_operator_stats", F.lit(False)), QUERY_HISTORY, keep)


def to_analyse(rows: DataFrame, *, slow_ms: int = 10_000, limit: int | None = None) -> DataFrame:
    """Affected statements whose operators are looked at; with a limit the slowest, one fewer than it."""
    return top_n_slowest(affected_queries(rows, slow_ms), "execution_time", limit, "query_id")


def to_estimate(rows: DataFrame, *, slow_ms: int = 10_000, limit: int | None = None) -> DataFrame:
    """Candidates for acceleration; with a limit the slowest, one fewer than it."""
    return top_n_slowest(acceleration_candidates(rows, "query_id", slow_ms), "execution_time", limit, "query_id")


def span_events(operators: DataFrame, queries: DataFrame) -> DataFrame:
    """Operators of the analysed statements as one array of events per statement.

    ``operators`` holds (query_id, step_id, operator_id, parent_operators, operator_type, stats,
    attributes, share); a plan has a bounded number of operators.
    """
    timed = operator_timeline(operators, queries)
    event = F.struct(
        (F.col("event_start_s") * 1_000_000_000).alias("timestamp"),
        F.col("step_id").alias("step_id"),
        F.col("operator_id").alias("operator_id"),
        *[F.col(c) for c in ("parent_operators", "operator_type", "stats", "operator_attributes") if c in timed.columns],
    )
    return timed.groupBy("query_id").agg(F.array_sort(F.collect_list(event)).alias("query_operator_stats"))


def recent_queries(instrumented: DataFrame, stats: DataFrame, estimates: DataFrame) -> DataFrame:
    """Instrumented rows with operator stats and acceleration estimates attached."""
    out = enrich_optional(instrumented, stats, estimates)
    has_stats = F.when(F.col("query_operator_stats").isNotNull(), text_section({"platform.query.with_operator_stats": F.lit("true")}))
    return out.withColumn("attributes", merge_maps(has_stats, F.col("attributes")))


def active_queries(
    running: DataFrame,
    finished: DataFrame,
    as_of: dt.datetime,
    *,
    mark: dt.datetime,
    fast_mode: bool = True,
    statuses: Sequence[str] = (),
    hours: float = 1,
) -> DataFrame:
    """Running and recently finished statements; times of open ones are left out, the running time grows."""
    is_open = F.col("execution_status").isin(*OPEN_STATUSES)

    def closed_time(name: str):
        return F.when(~is_open & (F.coalesce(F.col(name), F.lit(-1)) >= 0), F.col(name))

    going = F.col("execution_status") == "RUNNING"
    running_ms = F.greatest(F.unix_millis(at(as_of)) - F.unix_millis("start_time"), F.lit(0).cast("bigint"))
    own = running.withColumns({"running_time": F.when(going, F.coalesce(running_ms, F.lit(0))), "end_time": at(as_of)})
    written = [n for n in ("bytes_written_to_result", "rows_written_to_result") if n in running.columns]
    own = own.withColumns({n: F.when(~going, F.col(n)) for n in written}) if written else own
    done = finished.withColumn("running_time", F.lit(None).cast("bigint"))
    rows = mode_switch(own, done, fast_mode, as_of, mark, hours)
    rows = rows.withColumns({n: closed_time(n) for n in ("total_elapsed_time", "execution_time")})
    return instrument(rows.filter(status_allow_list(F.col("execution_status"), statuses)), ACTIVE_QUERIES, ["query_id", "session_id"])
