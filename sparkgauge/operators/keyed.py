"""State of one row per key, kept in folders by hash bucket of the key and, if wanted, by day.

A merge reads and rewrites only the folders its rows fall into, an addition writes files beside
those that are there, and expiry removes whole days without reading them. Keys are unique, so
buckets are even; choose their number so that a bucket of a day is a file of a usual size.

A merge first writes the new content of its folders beside the table and then puts it in their
place. If it dies in between, the next use of the table finishes it. One driver at a time
writes a table, and readers run between its merges.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkgauge.session import cut_lineage

BUCKET = "key_bucket"


@dataclass(frozen=True)
class KeyedState:
    """A table below ``path``; ``keys`` may be null and nulls are equal.

    ``day`` names a date column that belongs to the key: rows of one key on two days are two
    rows. Rows without a day have a folder of their own and never expire.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    day: str | None = None
    buckets: int = 16

    def __post_init__(self) -> None:
        if BUCKET in self.schema.names:
            raise ValueError(f"a state has no column named {BUCKET}")
        if self.day is not None and self.schema[self.day].dataType != T.DateType():
            raise ValueError(f"{self.day} is not a date")

    @property
    def _folders(self) -> list[str]:
        return [BUCKET] if self.day is None else [self.day, BUCKET]

    @property
    def _key(self) -> list[str]:
        return [*self.keys] if self.day is None or self.day in self.keys else [*self.keys, self.day]

    @property
    def _stored(self) -> T.StructType:
        inside = [f for f in self.schema if f.name != self.day]
        return T.StructType([*inside, *([self.schema[self.day]] if self.day else []), T.StructField(BUCKET, T.IntegerType())])

    @property
    def _pending(self) -> str:
        return f"{self.path}-pending"

    def read(self) -> DataFrame:
        """All rows; a filter on the day reads the folders of those days only."""
        return self._table().select(*self.schema.names)

    def merge(self, new: DataFrame) -> None:
        """Replace the rows whose keys are in ``new`` and add the others of it; ``new`` has one row per key."""
        placed = cut_lineage(self._placed(new))
        touched = self._touched(placed)
        if not touched:
            return
        keys = placed.select(*[F.col(k).alias(f"_{k}") for k in [*self._key, BUCKET]])
        kept = self._rows_in(touched)
        kept = kept.join(keys, _same(kept, keys, [*self._key, BUCKET]), "left_anti")
        kept.unionByName(placed).write.mode("overwrite").parquet(self._pending)
        self._finish()

    def add(self, rows: DataFrame) -> DataFrame:
        """Add the rows whose keys are not there yet, one of each key, and return them; nothing is rewritten.

        Of several rows with one key any one is added: they are equal where all columns are keys.
        """
        placed = self._placed(rows).dropDuplicates([*self._key, BUCKET])
        known = self._table().select(*[F.col(k).alias(f"_{k}") for k in [*self._key, BUCKET]])
        fresh = cut_lineage(placed.join(known, _same(placed, known, [*self._key, BUCKET]), "left_anti"))
        self._write(fresh, "append")
        return fresh.select(*self.schema.names)

    def expire(self, before: dt.date) -> int:
        """Remove the folders of days before a day; the number of days removed. Nothing is read or rewritten."""
        if self.day is None:
            raise ValueError("the state has no day")
        self._finish()
        folder, files = self._at(self.path)
        if not files.exists(folder):
            return 0
        prefix = f"{self.day}="
        days = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith(prefix)]
        return sum(files.delete(d, True) for d in days if _is_before(d.getName()[len(prefix) :], before))

    # --- parts -----------------------------------------------------------------------------

    def _placed(self, rows: DataFrame) -> DataFrame:
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self._key]), F.lit(self.buckets)).cast("int")
        return typed.withColumn(BUCKET, bucket).select(*self._stored.names)

    def _touched(self, placed: DataFrame) -> list[Row]:
        """Folders the rows fall into: at most the buckets, times the days of the rows."""
        return placed.select(*self._folders).distinct().collect()

    def _table(self) -> DataFrame:
        self._finish()
        self.spark.createDataFrame([], self._stored).write.mode("ignore").partitionBy(*self._folders).parquet(self.path)
        return self.spark.read.schema(self._stored).parquet(self.path)

    def _rows_in(self, touched: list[Row]) -> DataFrame:
        """Rows of some folders. Days and buckets reach the scan as literals, pairs of them are told apart by a join."""
        table = self._table().filter(F.col(BUCKET).isin(sorted({r[BUCKET] for r in touched})))
        if self.day is None:
            return table
        days = {r[self.day] for r in touched}
        wanted = F.col(self.day).isin(sorted(d for d in days if d is not None))
        table = table.filter(wanted | F.col(self.day).isNull() if None in days else wanted)
        schema = T.StructType([self._stored[c] for c in self._folders])
        pairs = self.spark.createDataFrame(touched, schema).toDF(*[f"_{c}" for c in self._folders])
        return table.join(pairs, _same(table, pairs, self._folders), "left_semi")

    def _finish(self) -> None:
        """Put folders that a merge has completed in place of the old ones; repeating it changes nothing."""
        done, files = self._at(f"{self._pending}/_SUCCESS")
        if not files.exists(done):
            return
        self._write(self.spark.read.schema(self._stored).parquet(self._pending), "overwrite")
        files.delete(done.getParent(), True)

    def _write(self, rows: DataFrame, mode: str) -> None:
        # A file per folder, however many tasks hold the rows; folders without rows here stay as they are.
        out = rows.repartition(*self._folders).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        out.partitionBy(*self._folders).parquet(self.path)

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())


def _same(rows: DataFrame, other: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [rows[c].eqNullSafe(other[f"_{c}"]) for c in columns])


def _is_before(name: str, day: dt.date) -> bool:
    """Whether a folder's value is an earlier day; the folder of rows without a day is none."""
    try:
        return dt.date.fromisoformat(name) < day
    except ValueError:
        return False
