"""Resource monitors, warehouses, warehouse usage, budgets and shares."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.operators.aggregates import ratio
from sparkgauge.operators.joins import header_detail, monitor_to_warehouses, warehouse_to_monitor
from sparkgauge.operators.predicates import bound, like_lists, since_last_run
from sparkgauge.plans.collectors.spec import RowSpec, at, instrument

# Members of the rows of each context and the columns they come from.
RESOURCE_MONITORS = RowSpec(
    timestamp="run_at",
    start="run_at",
    message="'Resource Monitor details for ' || name",
    dimensions={"platform.resource_monitor.name": "name"},
    attributes={
        "platform.resource_monitor.level": "level",
        "platform.resource_monitor.frequency": "frequency",
        "platform.resource_monitor.is_active": "is_active",
        "platform.warehouses.names": "active_warehouses",
    },
    event_times={
        "platform.resource_monitor.start_time": "start_time",
        "platform.resource_monitor.end_time": "end_time",
        "platform.resource_monitor.created_on": "created_on",
    },
    metrics={
        "platform.credits.quota.used_pct": "used_pct",
        "platform.credits.quota": "credit_quota",
        "platform.credits.quota.used": "used_credits",
        "platform.credits.quota.remaining": "remaining_credits",
        "platform.resource_monitor.warehouses": "n_warehouses",
    },
)
WAREHOUSES = RowSpec(
    timestamp="run_at",
    start="run_at",
    message="'Warehouse details for ' || name",
    dimensions={"platform.warehouse.name": "name", "platform.resource_monitor.name": "monitor_name"},
    attributes={
        "platform.warehouse.execution_state": "state",
        "platform.warehouse.type": "type",
        "platform.warehouse.size": "size",
        "platform.warehouse.owner": "owner",
        "platform.warehouse.is_default": "is_default",
        "platform.warehouse.is_current": "is_current",
        "platform.warehouse.is_auto_suspend": "auto_suspend",
        "platform.warehouse.is_auto_resume": "auto_resume",
        "platform.warehouse.is_unmonitored": "is_unmonitored",
        "platform.warehouse.has_query_acceleration_enabled": "enable_query_acceleration",
        "platform.warehouse.scaling_policy": "scaling_policy",
        "platform.warehouse.owner.role_type": "owner_role_type",
        "platform.resource_monitor.level": "monitor_level",
        "platform.resource_monitor.frequency": "monitor_frequency",
        "platform.budget.name": "budget",
        "platform.credits.quota": "monitor_credit_quota",
        "platform.credits.quota.used": "monitor_used_credits",
        "platform.credits.quota.remaining": "monitor_remaining_credits",
    },
    event_times={
        "platform.warehouse.created_on": "created_on",
        "platform.warehouse.resumed_on": "resumed_on",
        "platform.warehouse.updated_on": "updated_on",
    },
    metrics={
        "platform.compute.available": "available",
        "platform.compute.provisioning": "provisioning",
        "platform.compute.quiescing": "quiescing",
        "platform.compute.other": "other",
        "platform.warehouse.clusters.min": "min_cluster_count",
        "platform.warehouse.clusters.max": "max_cluster_count",
        "platform.acceleration.scale_factor.max": "query_acceleration_max_scale_factor",
        "platform.warehouse.clusters.started": "started_clusters",
        "platform.queries.running": "running",
        "platform.queries.queued": "queued",
    },
)
WAREHOUSE_EVENTS = RowSpec(
    timestamp="timestamp",
    message="'New Warehouse Event History entry at ' || warehouse_name",
    dimensions={
        "platform.warehouse.name": "warehouse_name",
        "platform.warehouse.event.name": "event_name",
        "platform.warehouse.event.state": "event_state",
    },
    attributes={
        "db.user": "user_name",
        "platform.warehouse.id": "warehouse_id",
        "platform.warehouse.cluster.number": "cluster_number",
        "platform.warehouse.event.reason": "event_reason",
        "platform.role.name": "role_name",
        "platform.query.id": "query_id",
        "platform.warehouse.size": "size",
        "platform.warehouse.clusters.count": "cluster_count",
    },
)
WAREHOUSE_LOAD = RowSpec(
    timestamp="start_time",
    start="start_time",
    end="end_time",
    message="'New Warehouse Load History entry at ' || warehouse_name",
    dimensions={"platform.warehouse.name": "warehouse_name"},
    attributes={"platform.warehouse.id": "warehouse_id"},
    metrics={
        "platform.load.running": "avg_running",
        "platform.load.queued.overloaded": "avg_queued_load",
        "platform.load.queued.provisioning": "avg_queued_provisioning",
        "platform.load.blocked": "avg_blocked",
    },
)
WAREHOUSE_METERING = RowSpec(
    timestamp="start_time",
    start="start_time",
    end="end_time",
    message="'New Warehouse Metering History entry at ' || warehouse_name",
    dimensions={"platform.warehouse.name": "warehouse_name"},
    attributes={"platform.warehouse.id": "warehouse_id"},
    metrics={
        "platform.credits.used": "credits_used",
        "platform.credits.compute": "credits_used_compute",
        "platform.credits.cloud_services": "credits_used_cloud_services",
    },
)
BUDGETS = RowSpec(
    timestamp="created_on",
    message="'Budget details for ' || name",
    dimensions={
        "platform.budget.name": "name",
        "platform.budget.full_name": "database_name || '.' || schema_name || '.' || name",
        "db.namespace": "database_name",
        "platform.schema.name": "schema_name",
    },
    attributes={
        "platform.budget.owner": "owner",
        "platform.budget.owner.role_type": "owner_role_type",
        "platform.budget.resource": "linked_resources",
    },
    metrics={"platform.credits.limit": "credit_limit"},
    event_times={"platform.budget.created_on": "created_on"},
)
SPENDINGS = RowSpec(
    timestamp="measurement_date",
    message="'Budget spending for ' || budget_name",
    dimensions={
        "platform.service.type": "service_type",
        "platform.budget.name": "budget_name",
        "platform.budget.full_name": "database_name || '.' || schema_name || '.' || budget_name",
        "platform.schema.name": "schema_name",
        "db.namespace": "database_name",
    },
    metrics={"platform.credits.spent": "credits_spent"},
)
_SHARE_ATTRIBUTES = {
    "platform.share.kind": "kind",
    "platform.share.shared_from": "owner_account",
    "platform.share.shared_to": "given_to",
    "platform.share.owner": "owner",
    "platform.share.is_secure_objects_only": "is_secure",
    "platform.share.listing_global_name": "listing_global_name",
}
OUTBOUND_SHARES = RowSpec(
    timestamp="run_at",
    message="CASE WHEN length(coalesce(comment, '')) > 0 THEN comment ELSE 'Outbound share details for ' || share_name END",
    dimensions={"platform.grant.name": "grant_name", "platform.share.name": "share_name", "db.namespace": "database_name"},
    attributes={
        "platform.grant.privilege": "privilege",
        "platform.grant.on": "granted_on",
        "platform.grant.to": "granted_to",
        "platform.grant.grantee": "grantee_name",
        "platform.grant.option": "grant_option",
        "platform.grant.by": "granted_by",
        **_SHARE_ATTRIBUTES,
    },
    event_times={"platform.grant.created_on": "grant_created_on"},
)
INBOUND_SHARES = RowSpec(
    timestamp="run_at",
    message="""CASE WHEN share_status = 'UNAVAILABLE' THEN 'Inbound share "' || share_name || '" is no longer available - access may have been revoked by the publisher'
             WHEN length(coalesce(comment, '')) > 0 THEN comment ELSE 'Inbound share details for ' || share_name END""",
    dimensions={
        "platform.share.name": "share_name",
        "db.namespace": "database_name",
        "platform.schema.name": "table_schema",
        "db.collection.name": "table_name",
    },
    attributes={
        "platform.table.owner": "table_owner",
        "platform.table.type": "table_type",
        "platform.table.clustering_key": "clustering_key",
        "platform.data.rows": "row_count",
        "platform.data.size": "bytes",
        "platform.table.retention_time": "retention_time",
        "platform.table.last_ddl_by": "last_ddl_by",
        "platform.table.is_auto_clustering_on": "auto_clustering_on",
        "platform.table.comment": "table_comment",
        "platform.table.is_transient": "is_transient",
        "platform.table.is_temporary": "is_temporary",
        "platform.table.is_iceberg": "is_iceberg",
        "platform.table.is_dynamic": "is_dynamic",
        "platform.table.is_hybrid": "is_hybrid",
        "platform.share.status": "share_status",
        "platform.share.has_details_reported": "is_reported",
        **_SHARE_ATTRIBUTES,
        "platform.error.message": "error_message",
    },
    event_times={
        "platform.table.created_on": "table_created",
        "platform.table.update": "last_altered",
        "platform.table.ddl": "last_ddl",
    },
)
SHARE_EVENTS = RowSpec(
    timestamp="run_at",
    message="CASE WHEN length(coalesce(comment, '')) > 0 THEN comment ELSE 'Share details for ' || share_name END",
    dimensions={"platform.share.name": "share_name", "db.namespace": "database_name"},
    attributes=_SHARE_ATTRIBUTES,
    event_times={"platform.share.created_on": "created_on"},
)


def resource_monitors(monitors: DataFrame, warehouses: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Quota use per monitor, the warehouses it watches, and whether it is active."""
    account = F.coalesce(F.col("level") == "ACCOUNT", F.lit(False))
    active = account | (F.size("warehouses") > 0)
    rows = monitor_to_warehouses(monitors, warehouses).withColumns(
        {
            "run_at": at(as_of),
            "is_account_level": account,
            "is_active": active,
            "active_warehouses": F.when(active, F.col("warehouses")),
            "n_warehouses": F.size("warehouses"),
            "used_pct": ratio(100.0 * F.col("used_credits"), F.col("credit_quota")),
        }
    )
    return instrument(rows, RESOURCE_MONITORS, ["is_account_level", "is_active"])


def monitor_warnings(monitors: DataFrame) -> DataFrame:
    """One ERROR record when no account-level monitor exists, else nothing."""
    found = monitors.agg(F.coalesce(F.max(F.col("level") == "ACCOUNT"), F.lit(False)).alias("has_account"))
    return found.filter(~F.col("has_account")).select(
        F.lit("There is no account-level resource monitor").alias("content"), F.lit("ERROR").alias("level")
    )


def warehouses(rows: DataFrame, monitors: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Warehouse state with its monitor."""
    columns = ["level", "frequency", "credit_quota", "used_credits", "remaining_credits"]
    joined = warehouse_to_monitor(rows, monitors, [c for c in columns if c in monitors.columns])
    return instrument(joined.withColumn("run_at", at(as_of)), WAREHOUSES, ["is_unmonitored"])


def warehouse_warnings(instrumented: DataFrame) -> DataFrame:
    """A WARNING record per warehouse without its own monitor."""
    name = F.try_element_at("dimensions", F.lit("platform.warehouse.name"))
    return instrumented.filter("is_unmonitored").select(
        F.concat(F.lit("Warehouse "), name, F.lit(" does not have a resource monitor")).alias("content"), F.lit("WARNING").alias("level")
    )


def warehouse_usage(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24) -> DataFrame:
    return instrument(since_last_run(rows, "timestamp", as_of, mark, hours=hours), WAREHOUSE_EVENTS)


def warehouse_usage_load(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24) -> DataFrame:
    return instrument(since_last_run(rows, "start_time", as_of, mark, hours=hours), WAREHOUSE_LOAD)


def warehouse_usage_metering(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24) -> DataFrame:
    return instrument(since_last_run(rows, "start_time", as_of, mark, hours=hours), WAREHOUSE_METERING)


def budgets(rows: DataFrame, resources: DataFrame, limits: DataFrame) -> DataFrame:
    """Budget with its linked resources and its limit.

    ``resources`` holds (budget_name, resource_name, resource_domain) and becomes one sorted
    list per budget before the join.
    """
    item = F.struct(F.col("resource_name").alias("name"), F.col("resource_domain").alias("domain"))
    linked = resources.groupBy("budget_name").agg(F.array_sort(F.collect_set(item)).alias("linked_resources"))
    joined = header_detail(rows, [(linked, "budget_name"), (limits, "budget_name")], "name")
    return instrument(joined, BUDGETS)


def spendings(spend: DataFrame, budget_rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24) -> DataFrame:
    """Daily spend per service of known budgets since the day of the mark."""
    since = bound(as_of, mark, hours=hours).date()
    recent = spend.filter(F.to_date("measurement_date") >= F.lit(since))
    names = budget_rows.select(F.col("name").alias("budget_name"), "database_name", "schema_name")
    return instrument(recent.join(names, "budget_name"), SPENDINGS)


def _shares(shares: DataFrame, as_of: dt.datetime) -> DataFrame:
    return shares.withColumnRenamed("name", "share_name").withColumns(
        {"run_at": at(as_of), "is_secure": F.col("secure_objects_only").try_cast("boolean")}
    )


def outbound_shares(shares: DataFrame, grants: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Grants per outgoing share; a share without grants stays."""
    out = _shares(shares, as_of).filter("kind = 'OUTBOUND'")
    named = grants.withColumnsRenamed({"name": "grant_name", "created_on": "grant_created_on"})
    return instrument(out.join(named, "share_name", "left"), OUTBOUND_SHARES)


def inbound_shares(
    shares: DataFrame,
    tables: DataFrame,
    as_of: dt.datetime,
    *,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    exclude_from_monitoring: Sequence[str] = (),
) -> DataFrame:
    """Tables per incoming share; excluded shares appear once, marked as not reported.

    ``tables`` holds (share_name, table_schema, table_name, share_status, …).
    """
    incoming = _shares(shares, as_of).filter("kind = 'INBOUND'")
    scope = F.concat(F.col("database_name"), F.lit(".%.%"))
    left_out = ~like_lists(scope, include) & like_lists(scope, exclude) & like_lists(F.col("share_name"), exclude_from_monitoring)
    marked = incoming.withColumn("_out", F.coalesce(left_out, F.lit(False)))
    listed = tables.withColumn("is_reported", F.coalesce(F.col("share_status") != "UNAVAILABLE", F.lit(True)))
    joined = marked.filter("NOT _out").drop("_out").join(listed, "share_name", "left")
    silent = marked.filter("_out").drop("_out").withColumn("is_reported", F.lit(False))
    return instrument(joined.unionByName(silent, allowMissingColumns=True), INBOUND_SHARES)


def share_events(shares: DataFrame, as_of: dt.datetime) -> DataFrame:
    return instrument(_shares(shares, as_of), SHARE_EVENTS)
