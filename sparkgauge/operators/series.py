"""Time series in long form: one row per series key and bin, missing bins with nulls.

Records are reduced to one row per (key, bin) before anything is ordered, so a window
over a key holds at most as many rows as the range has bins, however hot the key is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkgauge.operators.aggregates import null_safe_attach
from sparkgauge.session import cut_lineage

DAY, HOUR = 86_400, 3_600


def bin_start(ts: Column, step_s: int) -> Column:
    """Start of the fixed bin, aligned to the epoch."""
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(step_s)))


def time_range(rows: DataFrame, time: str) -> tuple[dt.datetime, dt.datetime] | None:
    """First and last time of the rows; None when there are none. One row reaches the driver."""
    lo, hi = rows.agg(F.min(time).cast("timestamp"), F.max(time).cast("timestamp")).first()
    return None if lo is None else (lo, hi)


def step_for_bins(rows: DataFrame, time: str, bins: int) -> int:
    """Bin width in whole seconds that cuts the range of the rows into at most ``bins`` bins plus one."""
    span = rows.agg(F.max(F.unix_seconds(time)) - F.min(F.unix_seconds(time))).first()[0]
    return max(-(-(span or 0) // bins), 1)


def bin_summarize(rows: DataFrame, time: str, by: Sequence[str], step_s: int, **aggregates: Column) -> DataFrame:
    """Aggregates by key and tumbling bin; only bins that have rows."""
    return (
        rows.groupBy(*by, F.window(time, f"{step_s} seconds").alias("_w"))
        .agg(*[c.alias(n) for n, c in aggregates.items()])
        .select(*by, F.col("_w.start").alias("bin"), *aggregates)
    )


def fill_bins(
    points: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    step_s: int,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    default: float | None = None,
) -> DataFrame:
    """Add the missing bins of every series from the one that holds start to the one that holds end.

    Without them, these are the first and the last bin of all series.
    Each point emits itself and the gap up to the next point of its series; no join is needed.
    """
    if start is None or end is None:
        found = time_range(points, "bin")
        if found is None:
            return points.select(*by, "bin", *values)
        start, end = start or found[0], end or found[1]
    first, last = (bin_start(F.lit(t).cast("timestamp"), step_s) for t in (start, end))
    step = F.make_dt_interval(secs=F.lit(step_s))
    w = Window.partitionBy(*by).orderBy("bin")
    spread = points.withColumns(
        {
            "_from": F.when(F.lag("bin").over(w).isNull(), F.least(first, F.col("bin"))).otherwise(F.col("bin")),
            "_to": F.coalesce(F.lead("bin").over(w) - step, F.greatest(last, F.col("bin"))),
        }
    )
    filled = spread.select(*by, F.col("bin").alias("_own"), *values, F.explode(F.sequence("_from", "_to", step)).alias("bin"))
    own = F.col("bin") == F.col("_own")
    shown = [F.when(own, F.col(v)).alias(v) for v in values]
    if default is not None:
        shown = [F.coalesce(c, F.lit(default)).alias(v) for c, v in zip(shown, values)]
    return filled.select(*by, "bin", *shown)


def make_timeseries(
    rows: DataFrame,
    time: str,
    by: Sequence[str] = (),
    *,
    step_s: int | None = None,
    bins: int | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    default: float | None = None,
    **aggregates: Column,
) -> DataFrame:
    """Gap-free series of aggregates per key, at an interval or cut into a number of bins.

    With a start or an end only rows of [start, end) count, and the last bin is the one that
    holds the last moment before the end. With both, nothing runs before the result; a missing
    one is taken from the points, and a number of bins needs the range of the rows first.
    """
    if start is not None:
        rows = rows.filter(F.col(time) >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col(time) < F.lit(end))
    if step_s is None:
        step_s = step_for_bins(rows, time, bins)
    points = bin_summarize(rows, time, by, step_s, **aggregates)
    if start is None or end is None:
        # The range comes from the points, so the rows are read once.
        points = cut_lineage(points)
    keys = list(by) or ["_all"]
    if not by:
        points = points.withColumn("_all", F.lit(1))
    last = None if end is None else end - dt.timedelta(microseconds=1)
    filled = fill_bins(points, keys, list(aggregates), step_s, start, last, default)
    return filled.select(*by, "bin", *aggregates)


def metric_timeseries(
    points: DataFrame,
    by: Sequence[str],
    metrics: Mapping[str, tuple[str, str]],
    *,
    step_s: int,
    where: Column | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    default: float | None = None,
    union: bool = False,
) -> DataFrame:
    """Series from the metric store (metric, ts, value, dimensions).

    ``metrics`` maps an output name to (aggregate, metric). With several metrics a key must
    have all of them, unless ``union`` is on. One pass serves all metrics.
    """
    kept = points.filter(F.col("metric").isin(*{m for _, m in metrics.values()}))
    if where is not None:
        kept = kept.filter(where)
    if start is not None:
        kept = kept.filter(F.col("ts") >= F.lit(start))
    if end is not None:
        kept = kept.filter(F.col("ts") < F.lit(end))
    make = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
    aggregates = {n: make[a](F.when(F.col("metric") == m, F.col("value"))) for n, (a, m) in metrics.items()}
    if not union and len(metrics) > 1:
        seen = [F.count(F.when(F.col("metric") == m, 1)).alias(f"_n{i}") for i, (_, m) in enumerate(metrics.values())]
        complete = kept.groupBy(*by).agg(*seen)
        for i in range(len(metrics)):
            complete = complete.filter(F.col(f"_n{i}") > 0)
        kept = null_safe_attach(kept, complete.select(*by), by, "left_semi") if by else kept
    return make_timeseries(kept, "ts", by, step_s=step_s, start=start, end=end, default=default, **aggregates)


# --- arithmetic ----------------------------------------------------------------------------


def series_divide(a: Column, b: Column) -> Column:
    """Element-wise quotient; null where the divisor is zero or either is missing."""
    return F.try_divide(a, b)


def as_arrays(series: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Long form to one row per series with arrays in bin order (length = number of bins)."""
    row = F.array_sort(F.collect_list(F.struct("bin", *values)))
    packed = series.groupBy(*by).agg(row.alias("_rows"))
    return packed.select(
        *by,
        F.col("_rows").getField("bin").alias("bins"),
        *[F.col("_rows").getField(v).alias(v) for v in values],
    )


def zip_math(a: Column, b: Column, op: str) -> Column:
    """Element-wise arithmetic of two aligned arrays; division by zero gives null."""
    ops = {
        "+": lambda x, y: x + y,
        "-": lambda x, y: x - y,
        "*": lambda x, y: x * y,
        "/": lambda x, y: F.try_divide(x, y),
    }
    return F.zip_with(a, b, ops[op])


def array_sum(values: Column) -> Column:
    """Sum without nulls; 0 for none."""
    return F.aggregate(F.array_compact(values), F.lit(0.0), lambda acc, x: acc + x)


def array_avg(values: Column) -> Column:
    """Mean without nulls; null for none."""
    return F.try_divide(array_sum(values), F.size(F.array_compact(values)))


def array_last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def series_stats(series: DataFrame, array: str) -> DataFrame:
    """Sum, mean, extremes, last value and number of non-null values of an array column."""
    values = F.col(array)
    return series.withColumns(
        {
            "series_sum": array_sum(values),
            "series_avg": array_avg(values),
            "series_max": F.array_max(values),
            "series_min": F.array_min(values),
            "series_last": array_last(values),
            "series_count": F.size(F.array_compact(values)).cast("bigint"),
        }
    )


def collapse_series(series: DataFrame, by: Mapping[str, Column], **aggregates: Column) -> DataFrame:
    """Element-wise aggregation of series to coarser keys."""
    return series.groupBy(*[c.alias(n) for n, c in by.items()], "bin").agg(*[c.alias(n) for n, c in aggregates.items()])


def series_lookup(series: DataFrame, other: DataFrame, key: str, value: str, divisor: str, name: str) -> DataFrame:
    """Join two series by key and bin and divide; only keys whose divisor is positive throughout."""
    positive = other.groupBy(key).agg(F.min(divisor).alias("_min")).filter(F.col("_min") > 0).select(key)
    usable = other.select(key, "bin", divisor).join(positive, key, "left_semi")
    joined = series.join(usable, [key, "bin"], "left").join(positive, key, "left_semi")
    return joined.select(key, "bin", F.try_divide(F.col(value), F.col(divisor)).alias(name))
