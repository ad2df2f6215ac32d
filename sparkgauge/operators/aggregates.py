"""Group aggregates of telemetry rows.

Arrays per group are built from values made distinct first, so a hot group is reduced
on the map side before its array is put together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkgauge.session import cut_lineage


def group_all_arrays(rows: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Sorted distinct arrays per group, nulls skipped."""
    return rows.groupBy(*keys).agg(*[F.array_sort(F.collect_set(c)).alias(n) for n, c in columns.items()])


def listagg_distinct(rows: DataFrame, keys: Sequence[str], value: str, name: str, separator: str = ",", distinct: bool = True) -> DataFrame:
    """Values of a group joined to text, in order; null when the group has none.

    With ``distinct`` off, repeats are kept: they are counted first and repeated in the text.
    """
    kept = rows.filter(F.col(value).isNotNull())
    if distinct:
        parts = F.collect_set(value)
    else:
        kept = kept.groupBy(*keys, value).agg(F.count("*").cast("int").alias("_n"))
        parts = F.flatten(F.collect_list(F.array_repeat(F.col(value), F.col("_n"))))
    joined = kept.groupBy(*keys).agg(F.array_join(F.array_sort(parts), separator).alias(name))
    return null_safe_attach(rows.select(*keys).distinct(), joined, keys)


def null_safe_attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null, null meeting null."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]
    return left.join(other, condition, how).drop(*[f"_r_{k}" for k in keys])


def direct_roles(grants: DataFrame, mark, first_of_day: bool) -> DataFrame:
    """Direct roles and grantors per user and the last change; only newer grants unless it is the first run of a day."""
    alive = grants.filter(F.col("deleted_on").isNull())
    if not first_of_day:
        alive = alive.filter(F.col("created_on") > F.lit(mark))
    return alive.groupBy("user_name").agg(
        F.array_sort(F.collect_list("role")).alias("roles"),
        F.array_sort(F.collect_list("granted_by")).alias("granted_by"),
        F.max("created_on").alias("last_altered"),
    )


def object_agg(rows: DataFrame, keys: Sequence[str], name: str, value: str, order: Sequence[str], into: str) -> DataFrame:
    """Rows of a group as a map name -> value; the last value in the given order wins."""
    last = rows.filter(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.max_by(value, F.struct(*order)).alias("_value"))
    kept = last.filter(F.col("_value").isNotNull())
    return kept.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "_value")))).alias(into)
    )


def summarize(rows: DataFrame, by: Mapping[str, Column] | Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates by keys; keys may be computed."""
    keys = [c.alias(n) for n, c in by.items()] if isinstance(by, Mapping) else [F.col(c) for c in by]
    return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def take_first(value: Column, *order: str) -> Column:
    """Value of the first row in the given order; null values count."""
    return F.min_by(F.struct(value.alias("v")), F.struct(*order))["v"]


def take_last(value: Column, *order: str) -> Column:
    """Value of the last row in the given order; null values count."""
    return F.max_by(F.struct(value.alias("v")), F.struct(*order))["v"]


def collect_distinct(rows: DataFrame, value: str, with_all: bool = False) -> DataFrame:
    """Sorted distinct values of a variable, optionally with ``*`` for all of them."""
    values = rows.select(F.col(value).alias("value")).filter(F.col("value").isNotNull()).distinct()
    if with_all:
        values = values.unionByName(rows.sparkSession.range(1).select(F.lit("*").alias("value")))
    return values.orderBy("value")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 when there is no positive denominator."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def dedup(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order, by aggregation instead of a sort of the group."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_row"))
    return first.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


# The sketch is off by at most one part in SKETCH_ACCURACY of a group.
SKETCH_ACCURACY = 10_000
# Values of a group that are put in order at once; a larger interval is narrowed first.
ORDERED_VALUES = 10_000


def exact_percentile(rows: DataFrame, keys: Sequence[str], value: str, p: float, name: str) -> DataFrame:
    """Exact percentile per group, linear interpolation, without holding a group in one task.

    Every group has an interval that holds the two wanted ranks. While intervals hold too many
    rows, two edges from a mergeable sketch cut them into five zones whose rows are counted:
    below, at and above the edges. The zone of the ranks is the next interval, whichever it is,
    so a sketch that is off costs a round and never a wrong value. An edge has a zone of its own
    because ranks may stand where one value ends and the next begins, however often either is
    there. What is left of a group, a fixed number of values at most, is ordered.
    Nulls are skipped, groups without values vanish.
    """
    kept = cut_lineage(rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v")))
    total = F.count(F.lit(1))
    state = kept.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), total.alias("_held"), (F.lit(p) * (total - 1)).alias("_rank"))
    state = state.withColumn("_below", F.lit(0).cast("bigint"))
    state = cut_lineage(state.select(*keys, "_lo", "_hi", "_held", "_rank", "_below"))
    small, found, accuracy = [], [], SKETCH_ACCURACY
    while True:
        large = state.filter((F.col("_held") > ORDERED_VALUES) & (F.col("_lo") < F.col("_hi")))
        small.append(state.filter((F.col("_held") <= ORDERED_VALUES) | (F.col("_lo") == F.col("_hi"))))
        if large.isEmpty():
            break
        state, ends = _narrowed(kept, keys, large, accuracy)
        found.append(ends)
        accuracy = max(accuracy, min(4 * accuracy, 10 * GRID))
    left = reduce(DataFrame.unionByName, small)
    # An interval of one value needs no order; its rows are left out of the lists.
    one = (F.col("_lo") == F.col("_hi"))
    found.append(left.filter(one).select(*keys, F.col("_lo").alias("_low"), F.col("_lo").alias("_high"), "_rank"))
    inner = _inside(kept, keys, left.filter(~one))
    lists = inner.groupBy(*keys, "_rank", "_below").agg(F.sort_array(F.collect_list("_v")).alias("_l"))
    at = [F.get("_l", (r - F.col("_below")).cast("int")) for r in (F.floor("_rank"), F.ceil("_rank"))]
    found.append(lists.select(*keys, at[0].alias("_low"), at[1].alias("_high"), "_rank"))
    low, high = F.col("_low").cast("double"), F.col("_high").cast("double")
    return reduce(DataFrame.unionByName, found).select(*keys, (low + (high - low) * (F.col("_rank") - F.floor("_rank"))).alias(name))


def _inside(kept: DataFrame, keys: Sequence[str], intervals: DataFrame) -> DataFrame:
    return null_safe_attach(kept, intervals, keys, "inner").filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _narrowed(kept: DataFrame, keys: Sequence[str], state: DataFrame, accuracy: int) -> tuple[DataFrame, DataFrame]:
    """The next intervals, and the values of groups whose two ranks lie in neighbouring zones."""
    inside = cut_lineage(_inside(kept, keys, state))
    # Where the ranks stand within the interval is the same for all rows of a group; the sketch needs
    # fixed shares, so the interval's values are sketched whole and the edges picked from the list.
    shares = [i / GRID for i in range(GRID + 1)]
    sketch = inside.groupBy(*keys, "_rank", "_below", "_held", "_lo", "_hi").agg(F.percentile_approx("_v", shares, accuracy).alias("_q"))
    place = (F.col("_rank") - F.col("_below")) / F.col("_held") * GRID
    first = F.greatest(F.floor(place - 1), F.lit(0)).cast("int")
    last = F.least(F.ceil(place + 1), F.lit(GRID)).cast("int")
    # The sketch works on doubles: an edge may be rounded out of the interval.
    a, b = [F.least(F.greatest(F.get("_q", i), F.col("_lo")), F.col("_hi")) for i in (first, last)]
    edges = sketch.select(*keys, a.alias("_a"), b.alias("_b"))
    zone = F.when(F.col("_v") < F.col("_a"), 0).when(F.col("_v") == F.col("_a"), 1).when(F.col("_v") < F.col("_b"), 2)
    zone = zone.when(F.col("_v") == F.col("_b"), 3).otherwise(4)
    zones = (
        null_safe_attach(inside, edges, keys, "inner")
        .groupBy(*keys, "_rank", "_below", zone.alias("_zone"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    # Five rows per group.
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_zone").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    zones = cut_lineage(zones.withColumn("_below", F.col("_below") + before))
    holds = [(r >= F.col("_below")) & (r < F.col("_below") + F.col("_n")) for r in (F.floor("_rank"), F.ceil("_rank"))]
    following = zones.filter(holds[0] & holds[1]).select(*keys, "_lo", "_hi", F.col("_n").alias("_held"), "_rank", "_below")
    # A rank that is the last of its zone has the zone's largest value, the next one the smallest of the next zone.
    split = zones.filter(holds[0] != holds[1]).groupBy(*keys, "_rank")
    ends = split.agg(F.max(F.when(holds[0], F.col("_hi"))).alias("_low"), F.max(F.when(holds[1], F.col("_lo"))).alias("_high"))
    return following, ends.select(*keys, "_low", "_high", "_rank")


# Shares at which an interval is sketched; the zone of a rank is about two of these steps wide.
GRID = 500
