"""Expanding arrays, maps and text to rows, and predicates over array elements."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.operators.windows import ranked_in_order


def flatten_inner(rows: DataFrame, array: str, element: str) -> DataFrame:
    """One row per element; rows with an empty or null array vanish."""
    return rows.withColumn(element, F.explode(array)).drop(array)


def flatten_outer_if(rows: DataFrame, array: str, element: str, flag: bool | Column) -> DataFrame:
    """One row per element where the flag is on; otherwise one row with a null element."""
    on = F.lit(flag) if isinstance(flag, bool) else flag
    return rows.withColumn(element, F.explode_outer(F.when(on, F.col(array)))).drop(array)


def _distinct_names(items: Column, of: Callable[[Column], Column], where: Callable[[Column], Column]) -> Column:
    named = F.transform(F.filter(items, lambda x: where(x) & of(x).isNotNull()), of)
    return F.array_sort(F.array_distinct(named))


def flatten_pair_distinct(access: DataFrame, base: str = "base_objects", direct: str = "direct_objects") -> DataFrame:
    """Distinct tables, views and databases of a statement from two arrays of (name, domain).

    Crossing the two arrays and taking distinct values back equals working on each array,
    so nothing is multiplied. A statement counts only if both arrays hold something.
    """
    b, d = F.col(base), F.col(direct)
    kept = access.filter((F.size(b) > 0) & (F.size(d) > 0))

    def first_part(x: Column) -> Column:
        return F.split_part(x["name"], F.lit("."), F.lit(1))

    def name(x: Column) -> Column:
        return x["name"]

    def any_domain(x: Column) -> Column:
        return F.lit(True)

    return kept.withColumns(
        {
            "query_tables": _distinct_names(b, name, lambda x: x["domain"] == "Table"),
            "query_views": F.array_sort(
                F.array_union(
                    _distinct_names(b, name, lambda x: x["domain"] == "View"),
                    _distinct_names(d, name, lambda x: x["domain"] == "View"),
                )
            ),
            "query_dbs": F.array_sort(
                F.array_union(_distinct_names(b, first_part, any_domain), _distinct_names(d, first_part, any_domain))
            ),
        }
    ).drop(base, direct)


def prefix_map_keys(rows: DataFrame, members: str, prefix: str) -> DataFrame:
    """Prefix the keys of a map by another column where that is set; a null map becomes empty."""
    p = F.col(prefix)
    renamed = F.transform_keys(F.col(members), lambda k, _: F.when(p.isNull(), k).otherwise(F.concat(p, F.lit("."), k)))
    return rows.withColumn(members, F.coalesce(renamed, F.create_map().cast("map<string,string>")))


def flatten_map(rows: DataFrame, members: str, prefix: str) -> DataFrame:
    """One row per map entry, key prefixed; a row without entries stays with nulls."""
    keyed = prefix_map_keys(rows, members, prefix)
    return keyed.select(*[c for c in keyed.columns if c != members], F.explode_outer(members).alias("key", "value"))


def zip_in_order(rows: DataFrame, keys: Sequence[str], start: Column, finish: Column, order: Sequence[str], bin_of: Column) -> DataFrame:
    """Pair the i-th start with the i-th finish of a key, both in time order.

    ``start`` and ``finish`` are times, null on rows of the other kind. Starts and finishes
    are numbered separately and joined on (key, number), so no key is collected into one
    row; the numbering is split by ``bin_of`` (a time bin). An unpaired start has a null finish.
    """
    starts = ranked_in_order(rows.filter(start.isNotNull()).withColumn("_at", start), keys, order, bin_of)
    ends = ranked_in_order(rows.filter(finish.isNotNull()).withColumn("finish_at", finish), keys, order, bin_of)
    ends = ends.select(*keys, "position", "finish_at")
    return starts.withColumnRenamed("_at", "start_at").join(ends, [*keys, "position"], "left")


def any_element(array: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.exists(array, predicate)


def collect_field(array: Column, field: str) -> Column:
    """Non-null values of one field over the elements."""
    return F.filter(F.transform(array, lambda x: x[field]), lambda v: v.isNotNull())


def split_to_rows(rows: DataFrame, text: str, element: str, separator: str = "|") -> DataFrame:
    """One row per part of delimited text."""
    parts = F.split(F.col(text), f"\\Q{separator}\\E")
    return rows.withColumn(element, F.explode(parts)).drop(text)
