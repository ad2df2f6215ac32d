"""Data volume, schema changes, dynamic tables, pipes and tasks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.text import compress_columns, extract_target_table
from sparkgauge.operators.aggregates import listagg_distinct
from sparkgauge.operators.joins import resolve_id_to_name
from sparkgauge.operators.predicates import EPOCH, any_time_newer, bound, like_lists, not_deleted, since_last_run
from sparkgauge.plans.collectors.spec import RowSpec, at, instrument

# Members of the rows of each context and the columns they come from.
DATA_VOLUME = RowSpec(
    timestamp="run_at",
    start="run_at",
    message="'Events at ' || full_name || ' for table ' || full_name",
    dimensions={
        "db.namespace": "table_catalog",
        "platform.schema.name": "table_schema",
        "db.collection.name": "table_name",
        "platform.table.full_name": "full_name",
        "platform.table.type": "table_type",
    },
    event_times={"platform.table.update": "last_altered", "platform.table.ddl": "last_ddl"},
    metrics={
        "platform.table.time_since.last_update": "minutes_since_update",
        "platform.table.time_since.last_ddl": "minutes_since_ddl",
        "platform.data.rows": "row_count",
        "platform.data.size": "bytes",
    },
)
DATA_SCHEMAS = RowSpec(
    timestamp="query_start_time",
    message="'Objects accessed by query ' || query_id || ' run by ' || user_name",
    dimensions={},
    attributes={
        "platform.query.id": "query_id",
        "db.user": "user_name",
        "platform.query.parent_id": "parent_query_id",
        "platform.query.root_id": "root_query_id",
        "platform.object.ddl.modified": "object_modified",
        "platform.object.type": "object_domain",
        "platform.object.id": "object_id",
        "platform.object.name": "object_name",
        "platform.object.ddl.operation": "operation_type",
        "platform.object.ddl.properties": "properties",
    },
)
_DYNAMIC_DIMENSIONS = {
    "db.collection.name": "name",
    "platform.schema.name": "schema_name",
    "db.namespace": "database_name",
    "platform.table.full_name": "qualified_name",
}
DYNAMIC_TABLES = RowSpec(
    timestamp="run_at",
    name="qualified_name",
    message="'Dynamic table (' || coalesce(qualified_name, '') || ') details at ' || coalesce(database_name, '')",
    dimensions=_DYNAMIC_DIMENSIONS,
    attributes={
        "platform.table.dynamic.lag.target.type": "target_lag_type",
        "platform.table.dynamic.latest.data_timestamp": "latest_data_timestamp",
        "platform.table.dynamic.latest.state": "last_completed_refresh_state",
        "platform.table.dynamic.latest.code": "last_completed_refresh_state_code",
        "platform.table.dynamic.latest.message": "last_completed_refresh_state_message",
        "platform.query.id": "executing_refresh_query_id",
        "platform.table.dynamic.scheduling.state": "nullif(scheduling_state, '')",
        "platform.table.dynamic.scheduling.reason.code": "scheduling_reason_code",
        "platform.table.dynamic.scheduling.reason.message": "scheduling_reason_message",
    },
    metrics={
        "platform.table.dynamic.lag.mean": "mean_lag_sec",
        "platform.table.dynamic.lag.max": "maximum_lag_sec",
        "platform.table.dynamic.lag.target.value": "target_lag_sec",
        "platform.table.dynamic.lag.target.time_above": "time_above_target_lag_sec",
        "platform.table.dynamic.lag.target.within_ratio": "time_within_target_lag_ratio",
    },
    event_times={
        "platform.table.dynamic.scheduling.suspended_on": "suspended_on",
        "platform.table.dynamic.scheduling.resumed_on": "resumed_on",
    },
)
DYNAMIC_TABLE_REFRESH = RowSpec(
    timestamp="data_timestamp",
    start="refresh_start_time",
    end="refresh_end_time",
    name="qualified_name",
    message="'Dynamic table (' || coalesce(qualified_name, '') || ') refresh history at ' || coalesce(database_name, '')",
    dimensions=_DYNAMIC_DIMENSIONS,
    attributes={
        "platform.table.dynamic.refresh.data_timestamp": "data_timestamp",
        "platform.table.dynamic.refresh.state": "state",
        "platform.table.dynamic.refresh.code": "state_code",
        "platform.table.dynamic.refresh.message": "state_message",
        "platform.query.id": "query_id",
        "platform.table.dynamic.graph.valid_from": "graph_history_valid_from",
        "platform.table.dynamic.refresh.start": "refresh_start_time",
        "platform.table.dynamic.refresh.end": "refresh_end_time",
        "platform.table.dynamic.refresh.completion_target": "completion_target",
        "platform.table.dynamic.latest.dependency.name": "last_dependency_name",
        "platform.table.dynamic.latest.dependency.data_timestamp": "last_dependency_timestamp",
        "platform.table.dynamic.refresh.action": "refresh_action",
        "platform.table.dynamic.refresh.trigger": "refresh_trigger",
    },
    metrics={
        "platform.table.dynamic.lag.target.value": "target_lag_sec",
        "platform.rows.inserted": "num_inserted_rows",
        "platform.rows.deleted": "num_deleted_rows",
        "platform.rows.copied": "num_copied_rows",
        "platform.partitions.added": "num_added_partitions",
        "platform.partitions.removed": "num_removed_partitions",
    },
)
DYNAMIC_TABLE_GRAPH = RowSpec(
    timestamp="run_at",
    name="qualified_name",
    message="'Dynamic table (' || coalesce(qualified_name, '') || ') graph history at ' || coalesce(database_name, '')",
    dimensions=_DYNAMIC_DIMENSIONS,
    attributes={
        "db.query.text": "query_text",
        "platform.table.dynamic.graph.inputs": "inputs",
        "platform.table.dynamic.graph.valid_to": "valid_to",
        "platform.table.dynamic.lag.target.type": "target_lag_type",
        "platform.table.dynamic.scheduling.state": "scheduling_state",
        "platform.table.dynamic.scheduling.reason.code": "scheduling_reason_code",
        "platform.table.dynamic.scheduling.reason.message": "scheduling_reason_message",
        "platform.table.dynamic.graph.alter_trigger": "alter_trigger",
    },
    metrics={"platform.table.dynamic.lag.target.value": "target_lag_sec"},
    event_times={
        "platform.table.dynamic.scheduling.suspended_on": "suspended_on",
        "platform.table.dynamic.scheduling.resumed_on": "resumed_on",
        "platform.table.dynamic.graph.valid_from": "valid_from",
    },
)
PIPES = RowSpec(
    timestamp="run_at",
    name="full_name",
    message="'Pipe (' || full_name || ') status: ' || coalesce(execution_state, 'N/A')",
    dimensions={
        "platform.pipe.name": "pipe_name",
        "platform.pipe.full_name": "full_name",
        "platform.pipe.catalog": "database_name",
        "platform.pipe.schema": "schema_name",
        "db.namespace": "database_name",
        "platform.schema.name": "schema_name",
        "db.collection.name": "target_table",
        "platform.pipe.owner": "owner",
        "platform.pipe.status": "execution_state",
    },
    attributes={
        "platform.pipe.definition": "definition",
        "platform.pipe.invalid_reason": "invalid_reason",
        "platform.pipe.notification_channel": "notification_channel",
        "platform.pipe.created_on": "created_on",
        "platform.pipe.execution_state": "execution_state",
        "platform.pipe.last_ingested_timestamp": "last_ingested_timestamp",
        "platform.pipe.last_received_message_timestamp": "last_received_message_timestamp",
        "platform.pipe.oldest_file_timestamp": "oldest_file_timestamp",
    },
    metrics={"platform.pipe.files.pending": "pending_files", "platform.pipe.latency.oldest_file": "oldest_file_latency_ms"},
    event_times={"platform.pipe.created_on": "created_on"},
)
COPY_HISTORY = RowSpec(
    timestamp="last_load_time",
    name="pipe_name",
    message="'Pipe load: ' || file_name || ' -> ' || table_name || ' (' || status || ')'",
    dimensions={
        "platform.pipe.name": "pipe_name",
        "platform.pipe.catalog": "pipe_catalog_name",
        "platform.pipe.schema": "pipe_schema_name",
        "db.namespace": "table_catalog_name",
        "platform.schema.name": "table_schema_name",
        "db.collection.name": "table_name",
    },
    attributes={
        "platform.copy.file_name": "file_name",
        "platform.copy.stage_location": "stage_location",
        "platform.copy.status": "status",
        "platform.copy.first_error.message": "first_error_message",
        "platform.copy.first_error.line_number": "first_error_line_number",
        "platform.copy.first_error.column_name": "first_error_column_name",
        "platform.copy.first_error.character_position": "first_error_character_pos",
        "platform.copy.errors.limit": "error_limit",
        "platform.copy.pipe.received_time": "pipe_received_time",
        "platform.copy.first_commit_time": "first_commit_time",
    },
    metrics={
        "platform.pipe.files.ingested": "CASE WHEN status = 'Loaded' THEN 1 ELSE 0 END",
        "platform.pipe.rows.loaded": "row_count",
        "platform.pipe.rows.parsed": "row_parsed",
        "platform.pipe.errors": "CASE WHEN status IN ('Load failed', 'Partially loaded') THEN 1 ELSE 0 END",
        "platform.pipe.ingest.latency": "latency_ms",
        "platform.copy.errors": "error_count",
        "platform.copy.file_size": "file_size",
        "platform.copy.bytes_billed": "bytes_billed",
    },
)
PIPE_USAGE = RowSpec(
    timestamp="end_time",
    name="resolved_name",
    message="'Pipe usage: ' || resolved_name || ' (' || credits_used || ' credits)'",
    dimensions={
        "platform.pipe.name": "resolved_name",
        "platform.pipe.full_name": "resolved_full_name",
        "platform.pipe.id": "pipe_name",
        "platform.pipe.catalog": "resolved_database",
        "platform.pipe.schema": "resolved_schema",
    },
    attributes={"platform.pipe.usage.start_time": "start_time"},
    metrics={
        "platform.pipe.data.ingested": "bytes_billed",
        "platform.pipe.cost.credits_used": "credits_used",
        "platform.pipe.files.inserted": "files_inserted",
        "platform.pipe.cost.bytes_billed": "bytes_billed",
    },
)
SERVERLESS_TASKS = RowSpec(
    timestamp="end_time",
    message="'New Serverless Tasks entry for ' || database_name",
    dimensions={"platform.task.name": "task_name", "platform.schema.name": "schema_name", "db.namespace": "database_name"},
    attributes={
        "platform.task.start_time": "ns:start_time",
        "platform.task.end_time": "ns:end_time",
        "platform.task.id": "task_id",
        "platform.schema.id": "schema_id",
        "platform.database.id": "database_id",
        "platform.task.instance_id": "instance_id",
    },
    metrics={"platform.credits.used": "credits_used"},
)
TASK_HISTORY = RowSpec(
    timestamp="query_start_time",
    sentinel=True,
    message="'New Tasks History entry for ' || database_name",
    dimensions={"db.namespace": "database_name", "platform.task.name": "name", "platform.schema.name": "schema_name"},
    attributes={
        "platform.task.graph.root_id": "root_task_id",
        "platform.task.graph.version": "graph_version",
        "platform.task.condition": "condition_text",
        "platform.query.id": "query_id",
        "platform.query.hash": "query_hash",
        "platform.query.hash_version": "query_hash_version",
        "platform.query.parametrized_hash": "query_parameterized_hash",
        "platform.query.parametrized_hash_version": "query_parameterized_hash_version",
        "platform.task.run.state": "state",
        "platform.task.run.return_value": "return_value",
        "platform.task.run.id": "run_id",
        "platform.task.run.group_id": "graph_run_group_id",
        "platform.task.run.scheduled_from": "scheduled_from",
        "platform.task.run.attempt": "attempt_number",
        "platform.task.config": "config",
        "platform.error.code": "error_code",
        "platform.error.message": "error_message",
        "platform.task.run.scheduled_time": "ns_or_-1:scheduled_time",
        "platform.task.run.completed_time": "ns_or_-1:completed_time",
    },
)
TASK_VERSIONS = RowSpec(
    timestamp="graph_version_created_on",
    message="'New Tasks Versions entry for ' || database_name",
    dimensions={
        "db.namespace": "database_name",
        "platform.task.name": "name",
        "platform.schema.name": "schema_name",
        "platform.warehouse.name": "warehouse_name",
    },
    attributes={
        "db.query.text": "definition",
        "platform.task.graph.root_id": "root_task_id",
        "platform.task.graph.version": "graph_version",
        "platform.task.id": "id",
        "platform.database.id": "database_id",
        "platform.schema.id": "schema_id",
        "platform.task.owner": "owner",
        "platform.task.schedule": "schedule",
        "platform.task.predecessors": "predecessors",
        "platform.task.condition": "condition_text",
        "platform.task.config.allow_overlap": "allow_overlapping_execution",
        "platform.task.error_integration": "error_integration",
        "platform.task.last_committed_on": "ns:last_committed_on",
        "platform.task.last_suspended_on": "ns:last_suspended_on",
    },
    event_times={"platform.task.graph.version.created_on": "graph_version_created_on"},
)


def minutes_between(earlier, later):
    """Unit boundaries crossed: both sides cut to the minute first."""
    return F.floor(F.unix_seconds(later) / 60).cast("bigint") - F.floor(F.unix_seconds(earlier) / 60).cast("bigint")


def data_volume(tables: DataFrame, as_of: dt.datetime, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Size, rows and minutes since update and DDL of the tables that exist."""
    full_name = F.concat_ws(".", "table_catalog", "table_schema", "table_name")
    kept = not_deleted(tables, "deleted").filter(F.col("table_type") != "VIEW").withColumn("full_name", full_name)
    kept = kept.filter(like_lists(F.col("full_name"), include, exclude)).withColumns(
        {
            "run_at": at(as_of),
            "minutes_since_update": minutes_between(F.col("last_altered"), at(as_of)),
            "minutes_since_ddl": minutes_between(F.col("last_ddl"), at(as_of)),
        }
    )
    return instrument(kept, DATA_VOLUME)


# Kinds of objects whose changes are reported.
DDL_DOMAINS = ("Table", "Schema", "Database")


def data_schemas(changes: DataFrame, columns: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, include: Sequence[str], exclude: Sequence[str] = (), *, hours: float = 4) -> DataFrame:
    """Schema changes with the changed columns of each object and compact properties.

    ``changes`` holds (query_id, query_start_time, user_name, object_domain, object_name, …),
    ``columns`` (query_id, object_name, object_domain, column_name).
    """
    recent = since_last_run(changes.filter(F.col("object_domain").isin(*DDL_DOMAINS)), "query_start_time", as_of, mark, hours=hours)
    recent = recent.filter(like_lists(F.col("object_name"), include, exclude))
    listed = listagg_distinct(
        columns.join(recent.select("query_id"), "query_id", "left_semi"),
        ["query_id", "object_name", "object_domain"], "column_name", "columns", ", ", distinct=False,
    )
    changed = listed.select(
        "query_id",
        F.to_json(
            F.create_map("object_name", F.struct(F.col("object_domain").alias("objectDomain"), F.col("columns").alias("objectColumns")))
        ).alias("object_modified"),
    )
    joined = recent.join(changed, "query_id", "left")
    if "properties" in joined.columns:
        packed = F.to_json(F.struct(compress_columns(F.col("properties")).alias("columns")))
        joined = joined.withColumn("properties", F.when(F.get_json_object("properties", "$.columns").isNotNull(), packed).otherwise(F.col("properties")))
    return instrument(joined, DATA_SCHEMAS, ["query_id"])


def dynamic_tables(tables: DataFrame, as_of: dt.datetime, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    kept = tables.filter(like_lists(F.col("qualified_name"), include, exclude))
    return instrument(kept.withColumn("run_at", at(as_of)), DYNAMIC_TABLES)


def dynamic_table_refresh_history(
    refreshes: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, include: Sequence[str], exclude: Sequence[str] = (), *, hours: float = 2
) -> DataFrame:
    kept = since_last_run(refreshes, "data_timestamp", as_of, mark, hours=hours)
    return instrument(kept.filter(like_lists(F.col("qualified_name"), include, exclude)), DYNAMIC_TABLE_REFRESH)


def dynamic_table_graph_history(graphs: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Graph versions still open or closed since the mark."""
    open_or_new = F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(mark or EPOCH))
    kept = graphs.filter(open_or_new).filter(like_lists(F.col("qualified_name"), include, exclude))
    return instrument(kept.withColumn("run_at", at(as_of)), DYNAMIC_TABLE_GRAPH)


def pipes(rows: DataFrame, as_of: dt.datetime, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """State of load pipes from their status JSON; a pipe without a status is UNKNOWN."""

    def status(name: str):
        return F.get_json_object("status_json", f"$.{name}")

    kept = rows.filter(like_lists(F.col("full_name"), include, exclude))
    oldest = status("oldestFileTimestamp")
    kept = kept.withColumns(
        {
            "run_at": at(as_of),
            "execution_state": F.when(F.col("status_json").isNull(), F.lit("UNKNOWN")).otherwise(status("executionState")),
            "pending_files": F.coalesce(status("pendingFileCount").try_cast("bigint"), F.lit(0)),
            "oldest_file_timestamp": oldest,
            "last_ingested_timestamp": status("lastIngestedTimestamp"),
            "last_received_message_timestamp": status("lastReceivedMessageTimestamp"),
            "oldest_file_latency_ms": F.unix_millis(at(as_of)) - F.unix_millis(F.try_to_timestamp(oldest)),
            "target_table": extract_target_table(F.col("definition"))[1],
        }
    )
    return instrument(kept, PIPES)


def copy_history(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 4) -> DataFrame:
    """Loaded files of pipes with the time from receipt to load."""
    since = F.lit(bound(as_of, mark, hours=hours))
    kept = rows.filter(F.col("pipe_name").isNotNull() & (F.col("last_load_time") >= since))
    latency = F.unix_millis("last_load_time") - F.unix_millis("pipe_received_time")
    return instrument(kept.withColumn("latency_ms", latency), COPY_HISTORY)


def pipe_usage_history(usage: DataFrame, entities: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 6) -> DataFrame:
    """Credits and bytes per pipe; ``entities`` holds (pipe_id, full_name)."""
    kept = usage.filter(F.col("end_time") >= F.lit(bound(as_of, mark, hours=hours)))
    named = resolve_id_to_name(kept, entities, "pipe_id", "full_name", "pipe_name")
    return instrument(named.withColumn("files_inserted", F.col("files_inserted").try_cast("bigint")), PIPE_USAGE)


def serverless_tasks(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 4) -> DataFrame:
    return instrument(since_last_run(rows, "end_time", as_of, mark, hours=hours), SERVERLESS_TASKS)


def task_history(rows: DataFrame, mark: dt.datetime) -> DataFrame:
    """Task runs with any time after the mark; a run not started yet has time -1."""
    return instrument(any_time_newer(rows, ["query_start_time", "scheduled_time", "completed_time"], mark), TASK_HISTORY)


def task_versions(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 720) -> DataFrame:
    times = ["graph_version_created_on", "last_committed_on", "last_suspended_on"]
    return instrument(any_time_newer(rows, times, bound(as_of, mark, hours=hours)), TASK_VERSIONS)
