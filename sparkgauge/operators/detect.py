"""Forecasts, baselines and alert windows over daily or hourly series.

Input is the gap-free long form of ``series``: a window over a key is bounded by the
number of bins in the range.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkgauge.functions.text import fill_template
from sparkgauge.operators.aggregates import null_safe_attach

# Normal quantile of a two-sided 90 % band; least number of points for a line.
QUANTILE_90, MIN_POINTS = 1.645, 3


def forecast_quota(
    series: DataFrame,
    by: Sequence[str],
    value: str,
    *,
    now: dt.datetime,
    horizon: int = 14,
    history_days: int = 30,
    quantile: float = QUANTILE_90,
) -> DataFrame:
    """Point, lower and upper forecast per key and future day from a least-squares line.

    upper = point + quantile * s * sqrt(1 + 1/n + (x - mean)^2 / Sxx), lower floored at 0.
    Keys with too few points have quality NO_DATA and no forecast values.
    """
    x = (F.unix_seconds("bin") / F.lit(86_400)).cast("double")
    y = F.col(value).cast("double")
    today = F.unix_seconds(F.lit(now).cast("timestamp")) / F.lit(86_400)
    recent = series.filter((F.col("bin") >= F.lit(now - dt.timedelta(days=history_days))) & (F.col("bin") < F.lit(now)))
    seen = recent.withColumns({"_x": x - today, "_y": y}).filter(F.col("_y").isNotNull())
    line = seen.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg("_x").alias("mean_x"),
        F.regr_sxx("_y", "_x").alias("sxx"),
        F.regr_syy("_y", "_x").alias("syy"),
        F.regr_sxy("_y", "_x").alias("sxy"),
        F.avg("_y").alias("mean_y"),
    )
    usable = (F.col("n") >= MIN_POINTS) & (F.col("sxx") > 0)
    slope = F.try_divide("sxy", "sxx")
    error = F.sqrt(F.greatest(F.col("syy") - slope * F.col("sxy"), F.lit(0.0)) / (F.col("n") - 2))
    days = line.withColumns(
        {
            "quality": F.when(usable, F.lit("VALID")).otherwise(F.lit("NO_DATA")),
            "slope": F.when(usable, slope),
            "residual_std": F.when(usable, error),
            "day": F.explode(F.sequence(F.lit(1), F.lit(horizon))),
        }
    )
    at = F.col("day").cast("double") - 1
    point = F.col("mean_y") + F.col("slope") * (at - F.col("mean_x"))
    band = F.lit(quantile) * F.col("residual_std") * F.sqrt(
        1 + F.lit(1.0) / F.col("n") + (at - F.col("mean_x")) * (at - F.col("mean_x")) / F.nullif("sxx", F.lit(0.0))
    )
    return days.select(
        *by,
        F.col("day").cast("bigint").alias("day"),
        "quality",
        point.alias("point"),
        F.when(point.isNotNull(), F.greatest(point - band, F.lit(0.0))).alias("lower"),
        (point + band).alias("upper"),
    )


def exhaustion_alerts(forecast: DataFrame, by: Sequence[str], threshold: float = 100.0) -> DataFrame:
    """Keys whose upper bound exceeds the threshold, with the peaks and the first day above it."""
    peaks = forecast.filter(F.col("quality") != "NO_DATA").groupBy(*by).agg(
        F.max("upper").alias("max_upper"),
        F.max("point").alias("max_point"),
        F.min(F.when(F.col("upper") > threshold, F.col("day"))).alias("day_of_crossing"),
    )
    return peaks.filter(F.col("max_upper") > threshold)


def seasonal_anomaly(
    series: DataFrame, by: Sequence[str], value: str, tolerance: float = 4.0, side: str = "ABOVE"
) -> DataFrame:
    """Mark points off the baseline: median per (key, weekday), spread = p75 - p25."""
    season = F.weekday("bin")
    base = series.withColumn("season", season)
    stats = base.groupBy(*by, "season").agg(
        F.percentile(value, 0.5).alias("baseline"),
        (F.percentile(value, 0.75) - F.percentile(value, 0.25)).alias("spread"),
    )
    joined = null_safe_attach(base, stats, [*by, "season"])
    return _with_violation(joined, value, F.col("baseline"), F.lit(tolerance) * F.col("spread"), side).drop("season")


def _with_violation(rows: DataFrame, value: str, center: Column, distance: Column, side: str) -> DataFrame:
    high, low = center + distance, center - distance
    above, below = F.col(value) > high, F.col(value) < low
    broken = {"ABOVE": above, "BELOW": below, "OUTSIDE": above | below}[side]
    return rows.withColumns({"threshold": low if side == "BELOW" else high, "violation": F.coalesce(broken, F.lit(False))})


def adaptive_anomaly(
    series: DataFrame,
    by: Sequence[str],
    value: str,
    *,
    train_from: dt.datetime,
    train_to: dt.datetime,
    fluctuations: float = 1.0,
    missing: bool = False,
) -> DataFrame:
    """Mark points above a learned threshold: p99 of the training span + n times its p75 - p25.

    With ``missing`` on, a bin without a value counts as a violation.
    """
    train = series.filter((F.col("bin") >= F.lit(train_from)) & (F.col("bin") < F.lit(train_to)))
    learned = train.groupBy(*by).agg(
        (
            F.percentile(value, 0.99)
            + F.lit(fluctuations) * (F.percentile(value, 0.75) - F.percentile(value, 0.25))
        ).alias("threshold")
    )
    joined = null_safe_attach(series, learned, by)
    above = F.coalesce(F.col(value) > F.col("threshold"), F.lit(False))
    return joined.withColumn("violation", above | (F.col(value).isNull() & F.lit(missing)))


def alert_windows(points: DataFrame, by: Sequence[str], window: int, violating: int, dealerting: int) -> DataFrame:
    """Alert intervals per key: raised at ``violating`` of the last ``window`` samples, cleared
    after ``dealerting`` clean samples in a row. ``end_at`` is the last sample of the alert;
    an alert still on at the last sample of its series is open.
    """
    w = Window.partitionBy(*by).orderBy("bin")
    hit = F.col("violation").cast("int")
    rated = points.withColumns(
        {
            "_hits": F.sum(hit).over(w.rowsBetween(1 - window, 0)),
            "_recent": F.sum(hit).over(w.rowsBetween(1 - dealerting, 0)),
            "_n": F.row_number().over(w),
            "_last": F.max("bin").over(Window.partitionBy(*by)),
        }
    )
    rated = rated.withColumn(
        "_signal",
        F.when(F.col("_hits") >= violating, F.lit(1)).when((F.col("_recent") == 0) & (F.col("_n") >= dealerting), F.lit(0)),
    )
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    state = rated.withColumn("_on", F.coalesce(F.last("_signal", ignorenulls=True).over(upto), F.lit(0)))
    change = state.withColumn("_change", (F.col("_on") != F.coalesce(F.lag("_on").over(w), F.lit(0))).cast("int"))
    islands = change.withColumn("_island", F.sum("_change").over(upto)).filter(F.col("_on") == 1)
    return (
        islands.groupBy(*by, "_island")
        .agg(
            F.min("bin").alias("start_at"),
            F.max("bin").alias("end_at"),
            F.count("*").alias("samples"),
            F.sum(hit).cast("bigint").alias("violations"),
            (F.max("bin") == F.max("_last")).alias("is_open"),
        )
        .drop("_island")
    )


def alert_events(
    alerts: DataFrame,
    dimensions: Mapping[str, Column],
    *,
    title: str,
    description: str,
    source: str,
    source_metric: str,
    event_type: str = "CUSTOM_INFO",
    timeout: int = 360,
) -> DataFrame:
    """One event row per alert: title and description from templates, times, dimensions.

    Dimension names that start with ``_`` are internal and not reported.
    """
    pairs = [x for k, c in dimensions.items() for x in (F.lit(k), c.cast("string"))]
    dims = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return alerts.select(
        F.lit(event_type).alias("event_type"),
        fill_template(F.lit(title), dims).alias("title"),
        fill_template(F.lit(description), dims).alias("description"),
        F.lit(timeout).cast("bigint").alias("timeout"),
        F.unix_millis("start_at").alias("event_start"),
        F.unix_millis("end_at").alias("event_end"),
        F.lit(source).alias("source"),
        F.lit(source_metric).alias("source_metric"),
        F.map_filter(dims, lambda k, _: ~k.startswith("_")).alias("properties"),
    )
