"""Joins of telemetry rows.

No join hint is given where sizes are unknown: adaptive execution broadcasts a side
that turns out small and splits skewed partitions of the other. Joins on OR conditions
are rewritten to one equi key, so none of them plans as a nested loop.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.sections import merge_maps


def left_join_sparse(rows: DataFrame, other: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a key that many rows do not have.

    Rows without a key match nothing; a second key part spreads them over all partitions
    instead of sending every null to the same one.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(F.lit(0))
    zero = F.when(F.col(key).isNotNull(), F.lit(0)).cast("bigint")
    return rows.withColumn("_spread", spread).join(other.withColumn("_spread", zero), [key, "_spread"], "left").drop("_spread")


# --- queries -------------------------------------------------------------------------------


def new_queries(history: DataFrame, ids: DataFrame) -> DataFrame:
    """History rows of the ids to report, matched on id and start."""
    return history.join(ids.select("query_id", "start_time").distinct(), ["query_id", "start_time"])


def not_processed(rows: DataFrame, cache: DataFrame, key: str = "query_id", done: str = "processed_time") -> DataFrame:
    """Rows whose id has no finished entry in the cache of processed ids."""
    finished = cache.filter(F.col(done).isNotNull() & F.col(key).isNotNull()).select(key)
    return rows.join(finished, key, "left_anti")


def session_for_root(
    rows: DataFrame, sessions: DataFrame, as_of: dt.datetime, hours: float = 24, key: str = "query_id"
) -> DataFrame:
    """Attach sessions of the last hours to rows without a parent; other rows keep nulls.

    Only the ids of parentless rows travel by session; the wide rows are joined by their own
    id, the partitioning they already have.
    """
    recent = sessions.filter(F.col("created_on") >= F.lit(as_of - dt.timedelta(hours=hours)))
    roots = rows.filter(F.col("parent_query_id").isNull()).select(key, "session_id").distinct()
    return rows.join(roots.join(recent, "session_id").drop("session_id"), key, "left")


def trace_for_query(rows: DataFrame, records: DataFrame, attributes: str, key: str) -> DataFrame:
    """Attach trace and span id of the first span record that names the query in its attributes."""
    keyed = records.filter(F.col("record_type") == "SPAN").select(
        F.get_json_object(attributes, f"$['{key}']").alias("query_id"),
        F.struct("ts", "span_id", "trace_id").alias("_at"),
    )
    first = keyed.filter(F.col("query_id").isNotNull()).groupBy("query_id").agg(F.min("_at").alias("_at"))
    return rows.join(
        first.select("query_id", F.col("_at.span_id").alias("span_id"), F.col("_at.trace_id").alias("trace_id")),
        "query_id",
        "left",
    )


def parent_flags(rows: DataFrame, row_id: str, parent: str) -> DataFrame:
    """is_parent: some row names this id as its parent. is_root: the parent is null or not among the rows.

    Orphans are found on (id, parent) pairs alone, so the wide rows shuffle by id only.
    """
    links = rows.select(row_id, parent).filter(F.col(parent).isNotNull())
    parents = links.select(F.col(parent).alias(row_id)).distinct().withColumn("is_parent", F.lit(True))
    ids = rows.select(F.col(row_id).alias(parent)).distinct()
    orphans = links.join(ids, parent, "left_anti").select(row_id).distinct().withColumn("_orphan", F.lit(True))
    flagged = rows.join(parents, row_id, "left").join(orphans, row_id, "left")
    return flagged.select(
        *[F.col(c) for c in rows.columns],
        F.coalesce("is_parent", F.lit(False)).alias("is_parent"),
        (F.col(parent).isNull() | F.coalesce("_orphan", F.lit(False))).alias("is_root"),
    )


def enrich_optional(rows: DataFrame, stats: DataFrame, estimates: DataFrame, key: str = "query_id") -> DataFrame:
    """Attach operator stats; merge estimate attributes under the row's own."""
    joined = rows.join(stats, key, "left").join(
        estimates.select(key, F.col("attributes").alias("_estimate")), key, "left"
    )
    return joined.withColumn("attributes", merge_maps(F.col("attributes"), F.col("_estimate"))).drop("_estimate")


def not_finished(running: DataFrame, finished: DataFrame, key: str) -> DataFrame:
    """Running items without a finished record."""
    return running.join(finished.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


# --- monitors ------------------------------------------------------------------------------


def is_unmonitored(monitor: Column) -> Column:
    return monitor.isNull() | (monitor == "null")


def _with_account_flag(monitors: DataFrame, name: str, level: str) -> tuple[DataFrame, DataFrame]:
    """Monitors under two kinds of key: their own name, and the account level as a second entry."""
    own = monitors.withColumn("_kind", F.lit("own")).withColumn("_key", F.col(name))
    account = monitors.filter(F.col(level) == "ACCOUNT").withColumn("_kind", F.lit("account")).withColumn("_key", F.lit(""))
    return own, account


def monitor_warehouse_pairs(
    monitors: DataFrame, warehouses: DataFrame, *, monitor: str = "resource_monitor", name: str = "name", level: str = "level"
) -> DataFrame:
    """Monitors full-joined to the warehouses they watch: one row (monitor, warehouse) per pair.

    A warehouse without a monitor belongs to the account-level monitors. A monitor that watches
    none has a null warehouse, a warehouse of an unknown monitor a null monitor. Many warehouses
    without a monitor are many rows of one key on the left side, which a skewed join splits.
    """
    kind = F.when(is_unmonitored(F.col(monitor)), F.lit("account")).otherwise(F.lit("own"))
    watched = warehouses.select(
        kind.alias("_kind"),
        F.when(is_unmonitored(F.col(monitor)), F.lit("")).otherwise(F.col(monitor)).alias("_key"),
        F.col(name).alias("warehouse"),
    )
    own, account = _with_account_flag(monitors, name, level)
    keyed = own.unionByName(account).select("_kind", "_key", F.col(name).alias("monitor"))
    pairs = watched.join(keyed, ["_kind", "_key"], "left").select("monitor", "warehouse")
    idle = monitors.select(F.col(name).alias("monitor")).join(pairs.select("monitor"), "monitor", "left_anti")
    return pairs.unionByName(idle, allowMissingColumns=True)


def monitor_to_warehouses(
    monitors: DataFrame, warehouses: DataFrame, *, monitor: str = "resource_monitor", name: str = "name", level: str = "level"
) -> DataFrame:
    """Monitors with the sorted names of their warehouses, and one row without a monitor for all lost ones.

    A list holds a monitor's warehouses; where they may be very many, use the pairs.
    """
    pairs = monitor_warehouse_pairs(monitors, warehouses, monitor=monitor, name=name, level=level)
    names = F.array_sort(F.collect_list("warehouse")).alias("warehouses")
    lists = pairs.filter(F.col("warehouse").isNotNull()).groupBy(F.col("monitor").alias(name)).agg(names)
    with_names = monitors.join(lists, name, "left").withColumn(
        "warehouses", F.coalesce("warehouses", F.array().cast("array<string>"))
    )
    return with_names.unionByName(lists.filter(F.col(name).isNull()), allowMissingColumns=True)


def warehouse_to_monitor(
    warehouses: DataFrame, monitors: DataFrame, columns: Sequence[str], *, monitor: str = "resource_monitor", name: str = "name", level: str = "level"
) -> DataFrame:
    """Attach columns of the own monitor, or of the account-level one when unassigned (equi key)."""
    own, account = _with_account_flag(monitors, name, level)
    taken = own.unionByName(account).select(
        "_kind", "_key", F.col(name).alias("monitor_name"), *[F.col(c).alias(f"monitor_{c}") for c in columns]
    )
    free = is_unmonitored(F.col(monitor))
    keyed = warehouses.withColumn("is_unmonitored", free).withColumns(
        {
            "_kind": F.when(free, F.lit("account")).otherwise(F.lit("own")),
            "_key": F.when(free, F.lit("")).otherwise(F.col(monitor)),
        }
    )
    return keyed.join(taken, ["_kind", "_key"], "left").drop("_kind", "_key")


def resolve_id_to_name(usage: DataFrame, entities: DataFrame, key: str, full_name: str, fallback: str) -> DataFrame:
    """Name parts of an entity by id; the bare name falls back to the id when the entity is gone."""
    joined = usage.join(entities.select(key, F.col(full_name).alias("resolved_full_name")), key, "left")
    full = F.coalesce("resolved_full_name", F.lit(""))
    return joined.withColumns(
        {
            "resolved_database": F.split_part(full, F.lit("."), F.lit(1)),
            "resolved_schema": F.split_part(full, F.lit("."), F.lit(2)),
            "resolved_name": F.coalesce(F.nullif(F.split_part(full, F.lit("."), F.lit(-1)), F.lit("")), F.col(fallback)),
        }
    )


# --- latest rows ---------------------------------------------------------------------------


def latest_per_key(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """All rows of the latest time of each key, ties kept.

    The latest time comes from a partial aggregation and is joined back, so a key with a
    large share of the rows is never sorted in one task.
    """
    latest = rows.groupBy(key).agg(F.max(ts).alias(ts))
    return rows.join(latest, [key, ts], "left_semi")


def last_success_per_user(users: DataFrame, logins: DataFrame, user: str = "login_name") -> DataFrame:
    """Latest successful login of each user, null when there is none."""
    last = (
        logins.filter((F.col("event_name") == "LOGIN") & (F.col("is_success") == "YES"))
        .groupBy(F.col("user_name").alias(user))
        .agg(F.max("ts").alias("last_success_login"))
    )
    return users.join(last, user, "left")


# --- details, scalars, pipe-style joins ----------------------------------------------------


def header_detail(header: DataFrame, details: Sequence[tuple[DataFrame, str]], key: str, how: str = "left") -> DataFrame:
    """Join detail frames to a header on its key; each detail names its own key column."""
    for detail, detail_key in details:
        header = header.join(detail.withColumnRenamed(detail_key, key), key, how)
    return header


def broadcast_scalar(rows: DataFrame, settings: Mapping[str, object]) -> DataFrame:
    """Settings as literal columns: no join is needed for one row of configuration."""
    return rows.withColumns({name: F.lit(value) for name, value in settings.items()})


def pipe_join(rows: DataFrame, sub: DataFrame, on: Mapping[str, str], fields: Sequence[str], kind: str = "inner") -> DataFrame:
    """Join a sub-query and take only the named fields of it; ``on`` maps left to right columns."""
    right = sub.select(*[F.col(r).alias(f"_r_{r}") for r in on.values()], *fields)
    condition = [rows[left] == right[f"_r_{r}"] for left, r in on.items()]
    how = {"inner": "inner", "leftOuter": "left"}[kind]
    return rows.join(right, condition, how).drop(*[f"_r_{r}" for r in on.values()])


def pipe_join_nested(rows: DataFrame, sub: DataFrame, on: Mapping[str, str], fields: Sequence[str]) -> DataFrame:
    """All matches of a sub-query, one row each, nulls when there is none.

    Collecting the matches to an array and expanding it again is a left join, so it is
    written as one: no array of unbounded size is built.
    """
    return pipe_join(rows, sub, on, fields, "leftOuter")


def inline_lookup(rows: DataFrame, table: Mapping[str, object], source: str, field: str) -> DataFrame:
    """Value of a small constant table by key, null when missing; the first entry of a key counts."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return rows.withColumn(field, F.try_element_at(F.create_map(*pairs), F.col(source)))


def lookup(rows: DataFrame, table: DataFrame, source: str, target: str, fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First matching row of a table by key, in the given order of the table."""
    taken = [f for f in fields]
    first = table.groupBy(F.col(target).alias("_k")).agg(
        F.min(F.struct(*order, *[f for f in taken if f not in order])).alias("_row")
    )
    first = first.select("_k", *[F.col(f"_row.{f}").alias(f) for f in taken])
    return rows.join(first, rows[source] == first["_k"], "left").drop("_k")
