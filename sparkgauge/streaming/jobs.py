"""Structured Streaming twins of the stateful operators.

Each takes a streaming frame and returns one, or starts a query that writes files. State is
bounded by a watermark, but for ``snapshot_diff_stream``, which keeps every row it has seen;
checkpoints go to the shared folder of the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sparkgauge.operators.fanout import KINDS, fan_out
from sparkgauge.session import fresh_path, settings


def read_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, in bounded micro-batches."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def windowed_counts(stream: DataFrame, ts: str, width: str, watermark: str, by: Sequence[str] = ()) -> DataFrame:
    """Tumbling counts; a window is emitted once the watermark has passed it, later rows are dropped."""
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(F.window(ts, width).alias("_w"), *by)
        .agg(F.count("*").alias("n"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, "n")
    )


def processed_once(stream: DataFrame, key: str, ts: str, keep: str = "4 hours") -> DataFrame:
    """The first row of each id; ids are forgotten once the watermark has passed them."""
    return stream.withWatermark(ts, keep).dropDuplicatesWithinWatermark([key])


def late_tolerant(stream: DataFrame, key: str, ts: str, late: str = "2 hours") -> DataFrame:
    """Rows up to the given lateness, each id once: twin of the re-read window with its cache."""
    return processed_once(stream, key, ts, late)


# Counting the rows of a state store costs a look-up before each write and removal.
NO_ROW_COUNT = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, write parquet, and stop. Nobody watches its progress, so rows of state are not counted."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A query takes its settings when it starts.
    with settings(stream.sparkSession, NO_ROW_COUNT):
        query = writer.start()
    query.awaitTermination()


def for_each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def fan_out_stream(stream: DataFrame, row_id: str, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Fan out every micro-batch to one folder per kind of record.

    A batch writes under its own number and overwrites it, so a replayed batch leaves the
    same files.
    """

    def handle(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        out = fan_out(rows, row_id, **options)
        kinds = KINDS if options.get("spans") else KINDS[:4]
        for kind in kinds:
            getattr(out, kind).write.mode("overwrite").parquet(f"{path}/{kind}/batch={number}")
        rows.unpersist()

    return for_each_batch(stream, handle, checkpoint)


def snapshot_diff_stream(stream: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows not seen in earlier batches.

    The rows seen are keyed state, so a batch looks up its own rows only and reads no earlier
    output. Equal nulls are equal. All rows seen are kept; ``daily_diff_stream`` forgets.
    """
    return stream.select(*columns).dropDuplicates()


DAY_MS = 86_400_000
EPOCH_ORDINAL = dt.date(1970, 1, 1).toordinal()


def daily_diff_stream(
    stream: DataFrame, keys: Sequence[str], columns: Sequence[str], ts: str, *, keep_days: int = 30, late: dt.timedelta = dt.timedelta(hours=2)
) -> DataFrame:
    """Sightings to report: all of a key's first instant of a day (``full``), later ones of the day if new (``changed``).

    A version of the columns is new if the key had none like it in the last ``keep_days`` days before
    the row's day, or earlier on that day. A key not seen for so long leaves the state by a timer of
    event time; when it returns, its day starts with a full report anyway, so nothing is lost by it.
    Repeated sightings of one instant count once. State per key: its versions of these days.
    """
    late_days = -(-late // dt.timedelta(days=1))
    marked = stream.select(*keys, *columns, ts).withColumn("_version", F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))
    out = T.StructType([*marked.schema, T.StructField("report", T.StringType())])

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, versions, days = state.get if state.exists else (None, [], [])
        known = dict(zip(versions, days))
        chunks = [*parts]
        rows = chunks[0] if len(chunks) == 1 else pd.concat(chunks)
        # A key has few rows a batch: for them lists cost far less than operations on frames.
        times = rows[ts].to_numpy("datetime64[us]").tolist()
        reports: dict[int, str] = {}
        for at, instant in groupby(sorted(zip(times, rows["_version"].tolist(), range(len(rows)))), key=lambda r: r[0]):
            day = at.toordinal() - EPOCH_ORDINAL
            full = last is None or day > last
            for version, alike in groupby(instant, key=lambda r: r[1]):
                if full or known.get(version, day - keep_days - 1) < day - keep_days:
                    reports[next(alike)[2]] = "full" if full else "changed"
                known[version] = max(day, known.get(version, day))
            last = day if last is None else max(day, last)
        known = {v: d for v, d in known.items() if d >= last - keep_days - late_days}
        state.update((last, list(known), list(known.values())))
        state.setTimeoutTimestamp((last + keep_days + 1) * DAY_MS)
        if reports:
            found = rows.take(list(reports))
            found["report"] = list(reports.values())
            yield found

    return (
        marked.withWatermark(ts, f"{int(late.total_seconds())} seconds")
        .filter(F.col(ts).isNotNull())
        .groupBy(*keys)
        .applyInPandasWithState(step, out, "last int, versions array<string>, days array<int>", "append", GroupStateTimeout.EventTimeTimeout)
        .select(*[n for n in out.names if not n.startswith("_")])
    )


def still_open_stream(
    started: DataFrame, finished: DataFrame, key: str, start: str, finish: str, *, within: str, late: str = "2 hours"
) -> DataFrame:
    """Items without a finish in the given time after their start, once no such finish can come any more.

    Both sides are forgotten as the watermarks pass them; repeated finishes change nothing.
    """
    ends = finished.select(F.col(key).alias("_key"), F.col(finish).alias("_finish")).withWatermark("_finish", late)
    in_time = (F.col(key) == F.col("_key")) & F.col("_finish").between(F.col(start), F.col(start) + F.expr(f"INTERVAL {within}"))
    return started.withWatermark(start, late).join(ends, in_time, "left_outer").filter(F.col("_finish").isNull()).select(*started.columns)


def alert_stream(
    points: DataFrame, by: Sequence[str], ts: str, *, step_s: int, window: int, violating: int, dealerting: int, missing: bool = False, late: dt.timedelta = dt.timedelta(hours=2)
) -> DataFrame:
    """Alerts over samples (keys, time, ``violation``): a row when one is raised, one when it is closed.

    Twin of ``alert_windows``: raised at ``violating`` of the last ``window`` bins, closed after
    ``dealerting`` clean bins in a row, ``end_at`` being the last bin before that. A bin is judged once
    the watermark has passed its end, by data or by a timer of event time, so late samples are in their
    place and a key that falls silent is judged too: a bin without a sample is a violation if
    ``missing``, else clean. A key's bins begin with its first sample; repeated samples of a bin violate
    if any does. State per key: the last bins, the alert that is on and samples not yet due; without
    ``missing`` a key whose last bins are clean is forgotten until its next sample.
    """
    width, size = step_s * 1_000_000, max(window, dealerting)
    at = F.floor(F.unix_micros(ts) / F.lit(width)).cast("bigint") * F.lit(width)
    marked = points.filter(F.col(ts).isNotNull()).select(*by, "violation", at.alias("_at"), F.timestamp_micros(at + F.lit(width)).alias("_end"))
    keys = [marked.schema[k] for k in by]
    out = T.StructType(keys).add("kind", "string").add("start_at", "timestamp").add("end_at", "timestamp").add("samples", "long").add("violations", "long")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, ring, on, start, samples, violations, *held = state.get if state.exists else (None, [], False, 0, 0, 0, [], [])
        waiting = dict(zip(*held))
        if not state.hasTimedOut:
            for place, bad in pd.concat(list(parts)).groupby("_at")["violation"].any().items():
                if following is None or place >= following:
                    waiting[place] = bool(bad) or waiting.get(place, False)
        watermark = state.getCurrentWatermarkMs()
        changes: list[tuple] = []

        def next_bin() -> int | None:
            if following is not None and (missing or on or any(ring)):
                return following
            return min(waiting, default=None)

        while (place := next_bin()) is not None and place + width <= watermark * 1000:
            hit = waiting.pop(place, missing)
            ring = [*ring, hit][-size:]
            now = sum(ring[-window:]) >= violating or (on and (any(ring[-dealerting:]) or len(ring) < dealerting))
            if now and not on:
                start, samples, violations = place, 0, 0
                changes.append(("raised", place, None, None, None))
            elif on and not now:
                changes.append(("closed", start, following - width, samples, violations))
            if now:
                samples, violations = samples + 1, violations + hit
            on, following = now, place + width
        if place is None:
            state.remove()
        else:
            state.update((following, ring, on, start, samples, violations, list(waiting), list(waiting.values())))
            state.setTimeoutTimestamp(max((place + width) // 1000 - 1, watermark + 1))
        if changes:
            rows = pd.DataFrame([(*key, *c) for c in changes], columns=out.names)
            yield rows.assign(**{c: pd.to_datetime(rows[c], unit="us") for c in ("start_at", "end_at")})

    kept = "following bigint, ring array<boolean>, on boolean, start bigint, samples bigint, violations bigint, bins array<bigint>, bad array<boolean>"
    return (
        marked.withWatermark("_end", f"{int(late.total_seconds())} seconds")
        .groupBy(*by)
        .applyInPandasWithState(step, out, kept, "append", GroupStateTimeout.EventTimeTimeout)
    )


def materialise(stream: DataFrame, name: str) -> DataFrame:
    """Run a streaming frame over the available files and read its output back."""
    spark = stream.sparkSession
    path = fresh_path(spark, name)
    run_available(stream, path, path + "-checkpoint")
    return spark.read.schema(stream.schema).parquet(path)
