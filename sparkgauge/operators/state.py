"""Incremental state: high-water marks, the cache of processed ids, snapshots, retention.

State lives in ordinary parquet tables that only grow by whole runs; each operator here
is a pure frame function, and a run appends its new state after its output is written.
A replay is harmless because the ids of the output decide what is new.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkgauge.operators.predicates import EPOCH, bound


# --- high-water marks ----------------------------------------------------------------------


def high_water_marks(status_log: DataFrame, *more: Column) -> DataFrame:
    """Last processed (time, id) per source: ties at the last time are told apart by the id; ``more`` aggregates of the same pass."""
    last = status_log.groupBy("source").agg(F.max(F.struct("last_timestamp", "last_id")).alias("_m"), *more)
    return last.select("source", F.col("_m.last_timestamp").alias("last_timestamp"), F.col("_m.last_id").alias("last_id"), *last.columns[2:])


def high_water_mark(status_log: DataFrame, source: str) -> dt.datetime:
    """Last processed time of one source, the epoch when it never ran. One value reaches the driver."""
    found = status_log.filter(F.col("source") == source).agg(F.max("last_timestamp")).first()[0]
    return found or EPOCH


def mark_of(rows: DataFrame, source: str, ts: Column, row_id: Column, run_at: dt.datetime, *more: Column) -> DataFrame:
    """The status-log row of a run: greatest (time, id) of the rows it read and how many there were; ``more`` aggregates of the same pass."""
    top = rows.agg(F.max(F.struct(ts.alias("t"), row_id.alias("i"))).alias("_m"), F.count("*").alias("entries"), *more)
    return top.select(
        F.lit(source).alias("source"),
        F.lit(run_at).cast("timestamp").alias("run_at"),
        F.col("_m.t").alias("last_timestamp"),
        F.col("_m.i").alias("last_id"),
        *top.columns[1:],
    )


# --- processed ids -------------------------------------------------------------------------

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("processed_time", T.TimestampType()),
    ]
)


def update_processed(
    cache: DataFrame,
    history: DataFrame,
    ids: DataFrame,
    as_of: dt.datetime,
    *,
    fresh_hours: float = 2,
    keep_hours: float = 4,
) -> DataFrame:
    """The next cache: ids processed now, if new and started recently, and entries not yet expired."""
    started = history.filter(F.col("start_time") > F.lit(as_of - dt.timedelta(hours=fresh_hours)))
    new = (
        started.join(ids.select("query_id"), "query_id", "left_semi")
        .join(cache.select("query_id").filter(F.col("query_id").isNotNull()), "query_id", "left_anti")
        .select("query_id", "start_time", F.lit(as_of).cast("timestamp").alias("processed_time"))
    )
    kept = cache.select("query_id", "start_time", "processed_time")
    return kept.unionByName(new).filter(F.col("start_time") >= F.lit(as_of - dt.timedelta(hours=keep_hours)))


def late_window(rows: DataFrame, cache: DataFrame, as_of: dt.datetime, minutes: float = 120) -> DataFrame:
    """Re-read rows that ended in the last minutes and are not in the cache: late rows are caught once."""
    recent = rows.filter(F.col("end_time") >= F.lit(as_of - dt.timedelta(minutes=minutes)))
    done = cache.filter(F.col("processed_time").isNotNull() & F.col("query_id").isNotNull()).select("query_id")
    return recent.join(done, "query_id", "left_anti")


# --- snapshots -----------------------------------------------------------------------------


def snapshot_diff(snapshot: DataFrame, seen: DataFrame, mark: dt.datetime, as_of: dt.datetime) -> DataFrame:
    """Rows new or changed since earlier snapshots; everything on the first run of a day."""
    if mark.date() == as_of.date() - dt.timedelta(days=1):
        return snapshot.distinct()
    return snapshot.subtract(seen.select(*snapshot.columns))


def email_hash_map(known: DataFrame, snapshot: DataFrame, retain: bool) -> DataFrame:
    """Map of e-mail to hash: kept and extended, or emptied."""
    if not retain:
        return known.limit(0)
    fresh = snapshot.filter(F.col("email").isNotNull()).select("email", F.sha2("email", 256).alias("email_hash")).distinct()
    return known.unionByName(fresh.join(known.select("email"), "email", "left_anti"))


def retention(events: DataFrame, as_of: dt.datetime, hours: float, ts: str = "ts") -> DataFrame:
    """Rows not older than the given hours; a rewrite by date partition drops whole old partitions."""
    return events.filter(F.col(ts) >= F.lit(as_of - dt.timedelta(hours=hours)))


# --- modes ---------------------------------------------------------------------------------


def mode_switch(running: DataFrame, finished: DataFrame, fast_mode: bool, as_of: dt.datetime, mark: dt.datetime, hours: float = 1) -> DataFrame:
    """Running rows only in fast mode; otherwise also rows finished since the mark less a minute."""
    if fast_mode:
        return running
    since = bound(as_of, mark - dt.timedelta(minutes=1), hours=hours)
    return running.unionByName(finished.filter(F.col("end_time") >= F.lit(since)))


def parse_source(source: str) -> tuple[str, list[str]]:
    """``plugin:ctx1,ctx2`` -> plugin and the contexts to run (none given = all)."""
    plugin, _, contexts = source.partition(":")
    return plugin, [c.strip() for c in contexts.split(",") if c.strip()]


# --- state tables --------------------------------------------------------------------------


def append_version(state: DataFrame, path: str, version: int) -> None:
    """Write a complete state as one more version of its table."""
    state.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(path)


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """State of one version; only its partition is read."""
    return spark.read.parquet(path).filter(F.col("version") == version).drop("version")
