"""Ordering, ranking and limits.

A window over a hot key would sort that key in one task. Where a key is not bounded by
nature, ranks and lags are computed in two steps: within time bins, and over the small
table of bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkgauge.session import cut_lineage

# A range with no more rows than this is sorted; a larger one is counted in this many parts.
SORTED_ROWS, PARTS = 10_000, 1_024


def top_n_slowest(rows: DataFrame, metric: str, n: int | None, key: str) -> DataFrame:
    """The rows ranked below n by a metric, largest first: n - 1 rows, all without n. Ties go by key."""
    if n is None:
        return rows
    return rows.orderBy(F.col(metric).desc_nulls_last(), F.col(key)).limit(max(n - 1, 0))


def batch_limit_oldest(rows: DataFrame, ts: str, key: str, n: int | None, after: tuple | None = None) -> DataFrame:
    """The next n rows by (ts, key), all without n; after is the pair of the last row read before.

    The pair decides, so rows that share the last row's time are read by the next batch. Rows
    without a time come first. The last pair of the batch is looked up beforehand, so the batch
    is a plain filter and no task ever holds n rows.
    """
    if after is not None:
        time, last = after
        newer = (F.col(ts) > F.lit(time)) | ((F.col(ts) == F.lit(time)) & (F.col(key) > F.lit(last)))
        if time is None:
            newer = F.col(ts).isNotNull() | (F.col(key) > F.lit(last))
        rows = rows.filter(newer)
    if n is None:
        return rows
    last = nth_pair(rows, ts, key, n)
    if last is None:
        return rows
    time, row_id = last
    if time is None:
        return rows.filter(F.col(ts).isNull() & (F.col(key) <= F.lit(row_id)))
    return rows.filter(F.col(ts).isNull() | (F.col(ts) < F.lit(time)) | ((F.col(ts) == F.lit(time)) & (F.col(key) <= F.lit(row_id))))


def nth_pair(rows: DataFrame, ts: str, key: str, n: int) -> tuple | None:
    """The n-th (ts, key) of the rows, rows without a time first; None if there are not more than n rows.

    The time range is counted in equal parts, then the part that holds the n-th row, until few
    rows or a single time are left. Ties of one time are ranked over range partitions.
    """
    pairs = cut_lineage(rows.select(F.col(ts).alias("t"), F.col(key).alias("k")))
    total, timeless, low, high = pairs.agg(F.count("*"), F.count_if(F.col("t").isNull()), F.min(F.unix_micros("t")), F.max(F.unix_micros("t"))).first()
    if total <= n:
        return None
    if n <= timeless:
        return _nth_in(pairs.filter("t IS NULL"), timeless, n)
    held, n = total - timeless, n - timeless
    us = F.unix_micros("t")

    def inside() -> DataFrame:
        return pairs.filter(F.col("t").between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high))))

    while held > SORTED_ROWS and low < high:
        width = -(-(high - low + 1) // PARTS)
        counts = inside().groupBy(F.expr(f"(unix_micros(t) - {low}L) DIV {width}L").alias("part")).agg(F.count("*").alias("n"), F.min(us).alias("low"), F.max(us).alias("high"))
        for part in sorted(counts.collect()):
            if n <= part["n"]:
                held, low, high = part["n"], part["low"], part["high"]
                break
            n -= part["n"]
    return _nth_in(inside(), held, n)


def _nth_in(pairs: DataFrame, held: int, n: int) -> tuple:
    """The n-th of so many pairs (t, k): by a bounded sort, or by rank over range partitions if there are many."""
    if held <= SORTED_ROWS:
        return tuple(pairs.orderBy("t", "k").offset(n - 1).limit(1).first())
    placed = pairs.repartitionByRange("t", "k").sortWithinPartitions("t", "k").withColumn("at", F.monotonically_increasing_id())
    placed = cut_lineage(placed)
    part = F.shiftrightunsigned("at", 33)
    for run in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()):
        if n <= run["n"]:
            return tuple(placed.filter(F.col("at") == run["first"] + n - 1).select("t", "k").first())
        n -= run["n"]
    raise AssertionError("fewer rows than were counted")


def newest(rows: DataFrame, ts: str, key: str, k: int | None = None) -> DataFrame:
    """The k newest rows, ties by key; all rows, in no order, without k."""
    return rows if k is None else rows.orderBy(F.col(ts).desc(), F.col(key).desc()).limit(k)


def nulls_first_sort(rows: DataFrame, ts: str, key: str) -> DataFrame:
    return rows.orderBy(F.col(ts).asc_nulls_first(), F.col(key))


def top_k_groups(groups: DataFrame, metric: str, k: int, *keys: str) -> DataFrame:
    """Largest k groups of an aggregated frame; ties go by key."""
    return groups.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


def top_k_series(points: DataFrame, keys: Sequence[str], weight: Column, k: int) -> DataFrame:
    """All points of the k series with the largest total weight."""
    totals = points.groupBy(*keys).agg(F.sum(weight).alias("_total"))
    best = top_k_groups(totals, "_total", k, *keys).select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = [points[c].eqNullSafe(best[f"_{c}"]) for c in keys]
    return points.join(best, same, "left_semi")


def operator_timeline(operators: DataFrame, queries: DataFrame) -> DataFrame:
    """Start of every plan operator from its share of the execution time.

    Operators run from the highest number down; the share is a fraction, the execution
    time is in ms and becomes seconds. The window holds the operators of one statement.
    """
    timed = operators.join(queries.select("query_id", "start_time", "execution_time"), "query_id").withColumns(
        {
            "operator_number": F.lit(10_000) * F.col("step_id") + F.col("operator_id"),
            "step_ms": F.col("share") * F.col("execution_time"),
        }
    )
    w = (
        Window.partitionBy("query_id")
        .orderBy(F.col("operator_number").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    elapsed = F.sum("step_ms").over(w)
    return timed.withColumn(
        "event_start_s", F.floor((F.unix_millis("start_time") + elapsed - F.col("step_ms")) / 1000).cast("bigint")
    )


def _bin_offsets(rows: DataFrame, keys: Sequence[str], bin_name: str) -> DataFrame:
    """Rows of the key in all earlier bins; one row per (key, bin) enters the window."""
    sizes = rows.groupBy(*keys, bin_name).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(bin_name).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*keys, bin_name, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def ranked_in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str], bin_of: Column) -> DataFrame:
    """Number the rows of each key from 1 in the given order.

    ``bin_of`` must not decrease along the order. Rows are numbered within (key, bin) and
    shifted by the sizes of the earlier bins.
    """
    binned = rows.withColumn("_bin", bin_of)
    w = Window.partitionBy(*keys, "_bin").orderBy(*order)
    numbered = binned.withColumn("_in_bin", F.row_number().over(w))
    offsets = _bin_offsets(binned, keys, "_bin")
    return (
        numbered.join(offsets, [*keys, "_bin"])
        .withColumn("position", (F.col("_in_bin") + F.col("_before")).cast("bigint"))
        .drop("_bin", "_in_bin", "_before")
    )


def previous_in_order(rows: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], bin_of: Column) -> DataFrame:
    """Time of the previous row of the key: the lag within a bin, else the last time of an earlier bin."""
    binned = rows.withColumn("_bin", bin_of)
    lasts = binned.groupBy(*keys, "_bin").agg(F.max(ts).alias("_last"))
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    lasts = lasts.select(*keys, "_bin", F.lag("_last").over(by_bin).alias("_carried"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(*order)
    return (
        binned.withColumn("_lag", F.lag(ts).over(inside))
        .join(lasts, [*keys, "_bin"])
        .withColumn("previous", F.coalesce("_lag", "_carried"))
        .drop("_bin", "_lag", "_carried")
    )


def run_gap(status_log: DataFrame, source: str, n: int, run_at: str = "run_at", key: str = "last_id") -> DataFrame:
    """Newest n runs of a source with the seconds since the run before.

    The gap of n rows needs n + 1 runs only, so those are taken first.
    """
    newest = status_log.filter(F.col("source") == source).orderBy(F.col(run_at).desc(), F.col(key).desc()).limit(n + 1)
    gap = F.date_trunc("second", F.col(run_at)).cast("bigint") - F.lag(F.date_trunc("second", F.col(run_at)).cast("bigint")).over(
        Window.partitionBy("source").orderBy(run_at, key)
    )
    return newest.withColumn("gap_s", gap).orderBy(F.col(run_at).desc(), F.col(key).desc()).limit(n)
