"""Set operations on frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def snapshot_except(snapshot: DataFrame, seen: DataFrame) -> DataFrame:
    """Distinct rows of a snapshot not seen before; null equals null."""
    return snapshot.subtract(seen.select(*snapshot.columns))


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by field name; a field one side lacks is null there."""
    return a.unionByName(b, allowMissingColumns=True)
