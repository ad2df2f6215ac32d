"""One run of a context: read the mark, collect, fan out, write the outputs, then the state.

The new rows are stored once and every output is written from there, under the number of
the run. The state row is written last, so a run that dies before it leaves its number
free: the next one reads the same mark and overwrites the same folders. A run that is
repeated after its state row finds nothing new.

With a re-read window, a run also takes rows that arrived late: it reads from the mark less
the window and leaves out the ids that committed runs took. Ids taken are kept in a table of
their own, in folders by day of the row's time and hash bucket, of which a run reads only the
days of its window. Each attempt marks its ids with a token that its state row repeats, so the
ids of a run that died count for nothing.

Folders below ``path``: one per kind of record with ``run=N`` below it, ``status`` and
``processed``. One driver at a time runs a context.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkgauge.operators.fanout import KINDS, FanOut, fan_out
from sparkgauge.operators.state import high_water_marks, mark_of
from sparkgauge.operators.windows import batch_limit_oldest
from sparkgauge.session import cut_lineage
from sparkgauge.sources.sinks import run_report


RUN_TS = "_run_ts"  # the time of a row beside what it gave


@dataclass(frozen=True)
class Context:
    """What a run reads and how: ``collect`` gives instrumented rows at or after a time (None = all).

    Rows without a time are read by the first runs only. Row ids are unique; with a re-read
    window a row may be delivered more than once, and equal ids count once.
    """

    name: str
    collect: Callable[[dt.datetime | None], DataFrame]
    row_id: str
    ts: str
    id_type: T.DataType = T.LongType()
    batch: int | None = None  # rows per run, oldest first; all without
    reread: dt.timedelta | None = None  # how late a row may arrive behind the newest one read
    buckets: int = 8  # hash buckets of a day's processed ids


def _status_schema(context: Context) -> T.StructType:
    return T.StructType(
        [
            T.StructField("source", T.StringType()),
            T.StructField("run_no", T.LongType()),
            T.StructField("run_id", T.StringType()),
            T.StructField("run_at", T.TimestampType()),
            T.StructField("last_timestamp", T.TimestampType()),
            T.StructField("last_id", context.id_type),
            T.StructField("entries", T.LongType()),
            T.StructField("entries_count", T.StringType()),
            T.StructField("attempt", T.StringType()),
        ]
    )


def status_log(spark: SparkSession, path: str, context: Context) -> DataFrame:
    """State rows of all runs of a context; an empty table before the first run."""
    schema = _status_schema(context)
    folder = f"{path}/status/{context.name}"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _processed_schema(context: Context) -> T.StructType:
    fields = [("row_id", context.id_type), ("attempt", T.StringType()), ("day", T.DateType()), ("bucket", T.IntegerType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def processed_ids(spark: SparkSession, path: str, context: Context, since: dt.datetime | None) -> DataFrame:
    """Ids taken by committed runs whose row time lies on or after the day of a moment; all without one.

    The day is a literal, so only the folders of those days are listed and read.
    """
    schema = _processed_schema(context)
    folder = f"{path}/processed/{context.name}"
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("day", "bucket").parquet(folder)
    ids = spark.read.schema(schema).parquet(folder)
    if since is not None:
        ids = ids.filter(F.col("day") >= F.lit(since.date()))
    committed = status_log(spark, path, context).select("attempt")
    return ids.join(committed, "attempt", "left_semi").select("row_id", "bucket")


def _bucket(row_id: str, context: Context) -> Column:
    return F.pmod(F.xxhash64(F.col(row_id)), F.lit(context.buckets)).cast("int")


def _not_taken(spark: SparkSession, path: str, context: Context, mark: dt.datetime | None) -> DataFrame:
    """Rows from the mark less the window on that no committed run took, each id once."""
    since = mark - context.reread if mark else None
    rows = context.collect(since)
    if since is not None:
        rows = rows.filter(F.col(context.ts) >= F.lit(since))
    taken = processed_ids(spark, path, context, since).withColumnRenamed("row_id", "_taken").withColumnRenamed("bucket", "_bucket")
    same = (rows[context.row_id] == taken["_taken"]) & (_bucket(context.row_id, context) == taken["_bucket"])
    return rows.join(taken, same, "left_anti").dropDuplicates([context.row_id])


@dataclass
class Run:
    """A run whose outputs are written and whose state is not."""

    context: Context
    path: str
    number: int
    rows: DataFrame
    outputs: FanOut
    run_id: str
    run_at: dt.datetime
    attempt: str
    is_empty: bool

    def commit(self) -> None:
        """Write the ids taken, then the state row: from here on the run's rows are done. An empty run leaves no row."""
        if self.is_empty:
            return
        if self.context.reread is not None:
            ids = self.rows.select(
                F.col(self.context.row_id).cast(self.context.id_type).alias("row_id"),
                F.lit(self.attempt).alias("attempt"),
                F.to_date(self.context.ts).alias("day"),
                _bucket(self.context.row_id, self.context).alias("bucket"),
            )
            # A file per day and bucket, however many tasks hold the rows.
            ids.repartition("day", "bucket").write.mode("append").partitionBy("day", "bucket").parquet(f"{self.path}/processed/{self.context.name}")
        # Mark and counts come from one pass over the rows.
        totals = F.struct(*self.outputs.totals()).alias("totals")
        mark = cut_lineage(mark_of(self.outputs.per_row, self.context.name, F.col(RUN_TS), F.col(self.context.row_id), self.run_at, totals))
        counts = run_report(self.outputs.counts(mark.select("totals.*")), self.context.name, self.run_id).first()["entries_count"]
        schema = _status_schema(self.context)
        given = {"run_no": F.lit(self.number), "run_id": F.lit(self.run_id), "entries_count": F.lit(counts), "attempt": F.lit(self.attempt)}
        typed = mark.withColumns(given).select(*[F.col(f.name).cast(f.dataType) for f in schema])
        typed.write.mode("append").parquet(f"{self.path}/status/{self.context.name}")


def start(spark: SparkSession, path: str, context: Context, run_id: str, run_at: dt.datetime, **options) -> Run:
    """Read rows no run has taken and write every kind of record; ``options`` go to the fan-out.

    Without a re-read window these are the rows after the last (time, id). An empty run writes nothing.
    """
    done = status_log(spark, path, context)
    last = high_water_marks(done, F.max("run_no").alias("run_no")).first()
    number = last["run_no"] + 1 if last else 0
    after = (last["last_timestamp"], last["last_id"]) if last else None
    if context.reread is None:
        new = context.collect(after[0] if after else None)
        rows = batch_limit_oldest(new, context.ts, context.row_id, context.batch, after)
    else:
        new = _not_taken(spark, path, context, after[0] if after else None)
        rows = batch_limit_oldest(new if context.batch is None else cut_lineage(new), context.ts, context.row_id, context.batch)
    rows = cut_lineage(rows)
    outputs = fan_out(rows, context.row_id, keep=[F.col(context.ts).alias(RUN_TS)], **options)
    is_empty = rows.isEmpty()
    if not is_empty:
        for kind in KINDS:
            getattr(outputs, kind).write.mode("overwrite").parquet(f"{path}/{kind}/run={number}")
    return Run(context, path, number, rows, outputs, run_id, run_at, uuid.uuid4().hex, is_empty)


def drop_expired(spark: SparkSession, path: str, context: Context, before: dt.date) -> int:
    """Remove the processed ids of whole days before a day, folder by folder; the number of days removed.

    Nothing is read or rewritten. Only days that no re-read window reaches any more may go.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/processed/{context.name}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    days = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("day=2")]
    old = [d for d in days if d.getName()[len("day=") :] < before.isoformat()]
    return sum(bool(files.delete(d, True)) for d in old)


def run_once(spark: SparkSession, path: str, context: Context, run_id: str, run_at: dt.datetime, **options) -> Run:
    """Start a run and commit it."""
    run = start(spark, path, context, run_id, run_at, **options)
    run.commit()
    return run


def run_until_done(spark: SparkSession, path: str, context: Context, run_id: str, run_at: dt.datetime, **options) -> int:
    """Run by batches until nothing is left; the number of runs that had rows."""
    n = 0
    while not run_once(spark, path, context, f"{run_id}-{n}", run_at, **options).is_empty:
        n += 1
    return n


def output(spark: SparkSession, path: str, context: Context, kind: str) -> DataFrame:
    """Records of a kind of all committed runs, with the number of the run; what a dead run left is not read."""
    last = status_log(spark, path, context).agg(F.max("run_no"))
    # As a subquery, the state is read once by a plan over several kinds.
    return spark.read.parquet(f"{path}/{kind}").filter(F.col("run") <= last.scalar())
