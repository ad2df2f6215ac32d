"""Helpers the corpus operators share: stored intermediate tables and size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgauge.session import fresh_path

# A side of a join is broadcast only up to so many rows, counted first; rows are a few short columns.
BROADCAST_ROWS = 200_000

# A stored frame of few rows has at least so many partitions a core.
PARTS_A_CORE = 2

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to a table of its own in the shared folder and read on from there.

    Later steps read files that outlive the executors which made them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if a count shows that it is small; else as it is.

    Without the hint Spark joins by shuffle, where adaptive execution splits hot keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def packed(df: DataFrame, rows: int, rows_a_part: int) -> DataFrame:
    """The frame in no more partitions than its rows need, so few rows do not make a task and a file each.

    rows is a count or an upper bound. Only neighbouring partitions are put together, after all joins.
    """
    return df.coalesce(max(PARTS_A_CORE * df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_a_part)))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; plain ASCII texts take the built-in's fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def free_name(name: str, columns: list[str]) -> str:
    """The name, with as many underscores before it as it takes to clash with no column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
