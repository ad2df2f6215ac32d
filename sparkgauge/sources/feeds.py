"""Data sources of Spark's Python interface: rows of a folder in the order of (time, id), and metric lines.

``register(spark)`` makes them known to a session::

    spark.read.format("ordered_rows").schema(...).option("folder", ...).option("time", "ts").option("id", "id")
    spark.readStream.format("ordered_rows")...        # same options, offset is the last (time, id)
    frame.write.format("metric_lines").option("run", "7").mode("append").save(folder)

**ordered_rows.** A partition is a row group of a Parquet file, read by Arrow in the task that holds it.
A batch query reads all rows with a time and an id; a stream reads those after its last (time, id) up to
the last one there is, so a restart goes on where the checkpoint ends and ties of time are split by the
id. Row groups whose statistics lie outside are not read, nor are columns the schema lacks. A row written
later with an older (time, id) than the offset is not seen: use a re-read window (``plans.runs``) for
such feeds. The driver reads the footers of files it has not seen yet and keeps one entry per row group;
of the row groups that hold the latest time it reads the time and the id, one group at a time. So a stream
needs statistics of the time (``configure`` makes Spark write them); a batch query reads files without
them too. Files are never changed once they are there; names that begin with ``_`` or ``.`` are left out.
The time is a timestamp, the id a number or a text.

**metric_lines.** A task writes its lines to one file under the run's folder and reports how many, the
commit writes the counts of the run next to them. Tasks that fail or run twice leave files the counts do
not name; ``read_lines`` reads only named files. ``counts`` gives them as rows of ``run_report``'s shape.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
Mark = tuple[int, object]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a local path or a URI."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def files(path: str, ending: str) -> list[str]:
    fs, root = opened(path)
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(ending) and not f.base_name.startswith(("_", ".")))


def micros(value: dt.datetime) -> int:
    value = value if value.tzinfo else value.replace(tzinfo=dt.UTC)
    return (value - EPOCH) // dt.timedelta(microseconds=1)


@dataclass
class RowGroup(InputPartition):
    path: str
    number: int
    low: int | None  # times in its statistics, if it has any
    high: int | None
    after: Mark | None = None
    upto: Mark | None = None

    def may_hold(self) -> bool:
        return (self.high is None or self.after is None or self.high >= self.after[0]) and (self.low is None or self.upto is None or self.low <= self.upto[0])


class Folder:
    """The row groups of a folder; footers are read once per file."""

    def __init__(self, options: dict, schema: StructType):
        self.folder, self.time, self.id = options["folder"], options["time"], options["id"]
        self.schema = to_arrow_schema(schema)
        self.known: dict[str, list[RowGroup]] = {}

    def row_groups(self) -> list[RowGroup]:
        fs, _ = opened(self.folder)
        for path in files(self.folder, ".parquet"):
            if path not in self.known:
                self.known[path] = list(self._groups(fs, path))
        return [g for groups in self.known.values() for g in groups]

    def _groups(self, fs: pafs.FileSystem, path: str) -> Iterator[RowGroup]:
        meta = pq.read_metadata(path, filesystem=fs)
        column = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == self.time)
        for n in range(meta.num_row_groups):
            group = meta.row_group(n)
            stats = group.column(column).statistics if meta.schema.column(column).physical_type == "INT64" else None
            if group.num_rows and not (stats and stats.null_count == group.num_rows):
                bounded = stats is not None and stats.has_min_max and isinstance(stats.min, dt.datetime)
                yield RowGroup(path, n, micros(stats.min) if bounded else None, micros(stats.max) if bounded else None)

    def table(self, group: RowGroup, columns: Sequence[str]) -> pa.Table:
        """Rows of a row group that lie within its marks; rows without a time or an id are not read."""
        fs, _ = opened(self.folder)
        rows = pq.ParquetFile(fs.open_input_file(group.path)).read_row_group(group.number, list(dict.fromkeys([*columns, self.time, self.id])))
        at, name = pc.cast(pc.cast(rows[self.time], pa.timestamp("us"), safe=False), pa.int64()), rows[self.id]
        keep = pc.and_(pc.is_valid(at), pc.is_valid(name))

        def beyond(mark: Mark) -> pa.ChunkedArray:
            return pc.or_(pc.greater(at, mark[0]), pc.and_(pc.equal(at, mark[0]), pc.greater(name, pa.scalar(mark[1], name.type))))

        if group.after:
            keep = pc.and_(keep, beyond(group.after))
        if group.upto:
            keep = pc.and_(keep, pc.invert(beyond(group.upto)))
        return rows.append_column("_at", at).filter(keep)

    def last(self) -> Mark | None:
        """The last (time, id) there is, looked for where the statistics allow it."""
        best: Mark | None = None
        groups = self.row_groups()
        if bare := next((g.path for g in groups if g.high is None), None):
            raise ValueError(f"the times of {bare} have no statistics; a stream needs them, so write TIMESTAMP_MICROS")
        for g in sorted(groups, key=lambda g: -g.high):
            if best and g.high < best[0]:
                break
            rows = self.table(g, [])
            if rows.num_rows:
                at = pc.max(rows["_at"])
                found = (at.as_py(), pc.max(rows.filter(pc.equal(rows["_at"], at))[self.id]).as_py())
                best = found if best is None else max(best, found)
        return best

    def read(self, group: RowGroup) -> Iterator[pa.RecordBatch]:
        rows = self.table(group, self.schema.names).select(self.schema.names)
        yield from rows.cast(self.schema, safe=False).to_batches()


class RowsReader(DataSourceReader):
    def __init__(self, folder: Folder):
        self.folder = folder

    def partitions(self) -> Sequence[InputPartition]:
        return self.folder.row_groups() or [RowGroup("", -1, None, None)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition) if partition.path else iter(())


def mark_of(offset: dict) -> Mark | None:
    return (offset["time"], offset["id"]) if offset.get("time") is not None else None


class RowsStreamReader(DataSourceStreamReader):
    """Offsets are {"time": microseconds, "id": id}; nulls before the first row."""

    def __init__(self, folder: Folder):
        self.folder = folder
        self.latest: Mark | None = None

    def initialOffset(self) -> dict:
        return {"time": None, "id": None}

    def latestOffset(self) -> dict:
        found = self.folder.last()
        self.latest = max(filter(None, (self.latest, found)), default=None)
        return dict(zip(("time", "id"), self.latest or (None, None)))

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        after, upto = mark_of(start), mark_of(end)
        if upto is None:
            return []
        marked = (RowGroup(g.path, g.number, g.low, g.high, after, upto) for g in self.folder.row_groups())
        return [g for g in marked if g.may_hold()]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: the offset lies in the checkpoint."""


class OrderedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ordered_rows"

    def reader(self, schema: StructType) -> DataSourceReader:
        return RowsReader(Folder(self.options, schema))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RowsStreamReader(Folder(self.options, schema))


# --- metric lines --------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    file: str
    lines: int


class LinesWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        if schema.fieldNames() != ["line"]:
            raise ValueError("metric_lines takes one column, line")
        self.folder, self.run, self.overwrite = options["path"].rstrip("/"), options["run"], overwrite

    def write(self, rows: Iterator) -> Written:
        fs, root = opened(f"{self.folder}/run={self.run}")
        fs.create_dir(root, recursive=True)
        name, n = f"part-{uuid.uuid4().hex}.txt", 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            for row in rows:
                if row[0] is not None:
                    out.write(row[0].encode() + b"\n")
                    n += 1
        return Written(name, n)

    def commit(self, messages: Sequence[Written | None]) -> None:
        """One small file names the files of the run and their counts; written anew it replaces the run."""
        fs, root = opened(f"{self.folder}/run={self.run}")
        fs.create_dir(root, recursive=True)
        names, kept = f"{root}/_written.json", {}
        if not self.overwrite and fs.get_file_info(names).is_file:
            with fs.open_input_stream(names) as old:
                kept = json.loads(old.read())
        kept |= {m.file: m.lines for m in messages if m and m.lines}
        with fs.open_output_stream(names) as out:
            out.write(json.dumps(kept).encode())

    def abort(self, messages: Sequence[Written | None]) -> None:
        """Files without an entry are never read."""


class MetricLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "metric_lines"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return LinesWriter(self.options, schema, overwrite)


def written(folder: str, run: str) -> dict[str, int]:
    """Files of a run and their counts, as its commits left them."""
    fs, path = opened(f"{folder.rstrip('/')}/run={run}/_written.json")
    if not fs.get_file_info(path).is_file:
        return {}
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def read_lines(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """Lines of the committed files of a run."""
    paths = [f"{folder.rstrip('/')}/run={run}/{name}" for name in written(folder, run)]
    return spark.read.text(paths).withColumnRenamed("value", "line") if paths else spark.createDataFrame([], "line string")


def counts(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """(kind, n) of the run's metric lines, from the commits alone."""
    return spark.range(1).select(F.lit("metrics").alias("kind"), F.lit(sum(written(folder, run).values())).cast("bigint").alias("n"))


def register(spark: SparkSession) -> None:
    for source in (OrderedRows, MetricLines):
        spark.dataSource.register(source)
