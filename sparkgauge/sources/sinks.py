"""Record formats and batches: metric lines, log records, events, run reports.

Records are columns of text, written by Spark (``write.text`` / ``write.json``); sending
them on is not part of this library.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkgauge.functions.sections import (
    TEXT_MAP,
    drop_blanks,
    merge_maps,
    normalize_timestamp_unit,
    number_text,
    telemetry_times,
)
from sparkgauge.functions.text import escape_value
from sparkgauge.session import cut_lineage

# Payload limits per kind (bytes, records).
METRIC_BYTES = 1_000_000
EVENT_BYTES, EVENT_COUNT = 10_240_000, 25_000
CLOUD_EVENT_BYTES, CLOUD_EVENT_COUNT = 5_120_000, 400
# Longest property text and longest timeout (minutes) of an event.
PROPERTY_CHARS, MAX_TIMEOUT = 4096, 360
# Members of a composite metric, in the order they are written.
COMPOSITE_MEMBERS = ("min", "max", "sum", "count")
# Kinds of events.
EVENT_TYPES = (
    "AVAILABILITY_EVENT",
    "CUSTOM_ALERT",
    "CUSTOM_ANNOTATION",
    "CUSTOM_CONFIGURATION",
    "CUSTOM_DEPLOYMENT",
    "CUSTOM_INFO",
    "ERROR_EVENT",
    "MARKED_FOR_TERMINATION",
    "PERFORMANCE_EVENT",
    "RESOURCE_CONTENTION_EVENT",
)


# --- metric lines --------------------------------------------------------------------------


def dimension_text(dimensions: Column) -> Column:
    """``key="value"`` pairs joined by commas, quotes and backslashes escaped."""
    return F.array_join(
        F.transform(
            F.map_entries(dimensions),
            lambda e: F.concat(escape_value(e["key"]), F.lit('="'), escape_value(e["value"]), F.lit('"')),
        ),
        ",",
    )


def composite_text(members: Column) -> Column:
    """A composite value: its only member, or all known ones; ``gauge`` counts as ``count``."""
    counted = F.coalesce(F.try_element_at(members, F.lit("gauge")), F.try_element_at(members, F.lit("count")))

    def part(name: str) -> Column:
        value = counted if name == "count" else F.try_element_at(members, F.lit(name))
        return F.concat(F.lit(f"{name}="), number_text(value))

    full = F.concat(F.lit("gauge,"), F.concat_ws(",", *[part(m) for m in COMPOSITE_MEMBERS]))
    return F.when(F.size(members) == 1, number_text(F.map_values(members)[0])).otherwise(full)


def metric_lines(
    rows: DataFrame, keep: Sequence[str], *, context: Mapping[str, str], now: Column, start: str = "start_time"
) -> DataFrame:
    """One text line per metric: ``name,dim="v",… value time``.

    The time is in ms and left out when it is older than 55 or more than 10 minutes ahead.
    Metrics are a map to numbers, or a map to composite values.
    """
    pairs = [F.lit(x) for pair in context.items() for x in pair]
    base = F.create_map(*pairs) if pairs else F.create_map().cast(TEXT_MAP)
    own = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys("dimensions"), k))
    millis = normalize_timestamp_unit(F.col(start), now, past_minutes=55, future_minutes=10)
    lines = rows.select(
        *keep, dimension_text(F.map_concat(own, F.col("dimensions"))).alias("_dims"), millis.alias("_ms"), F.explode("metrics").alias("metric", "_v")
    )
    composite = dict(lines.dtypes)["_v"].startswith("map")
    value = composite_text(F.col("_v")) if composite else number_text(F.col("_v"))
    time = F.coalesce(F.concat(F.lit(" "), F.col("_ms").cast("string")), F.lit(""))
    return lines.filter(F.col("_v").isNotNull()).select(
        *keep, "metric", F.concat(F.col("metric"), F.lit(","), F.col("_dims"), F.lit(" "), value, time).alias("line")
    )


def metric_metadata_lines(
    metrics: DataFrame, dictionary: DataFrame, meta_prefix: str = "meta."
) -> DataFrame:
    """A comment line per metric with display name and unit.

    ``metrics`` holds distinct (metric, local_name, local_unit), ``dictionary`` (metric,
    display_name, unit). The dictionary wins over the definition a row brings along; a
    metric known to neither has an empty line.
    """
    joined = metrics.join(dictionary.withColumn("_known", F.lit(True)), "metric", "left")
    local = F.col("local_name").isNotNull() | F.col("local_unit").isNotNull()
    default_name = F.initcap(F.replace(F.split_part(F.col("metric"), F.lit("."), F.lit(-1)), F.lit("_"), F.lit(" ")))
    name = F.coalesce(F.when(F.col("_known"), F.col("display_name")).otherwise(F.col("local_name")), default_name)
    unit = F.when(F.col("_known"), F.col("unit")).otherwise(F.col("local_unit"))
    line = F.concat(
        F.lit("#"),
        F.col("metric"),
        F.lit(f' gauge {meta_prefix}displayName="'),
        escape_value(name),
        F.lit('"'),
        F.coalesce(F.concat(F.lit(f',{meta_prefix}unit="'), escape_value(unit), F.lit('"')), F.lit("")),
    )
    return joined.select("metric", F.when(F.col("_known") | local, line).otherwise(F.lit("")).alias("line"))


# --- logs and events -----------------------------------------------------------------------


def log_records(rows: DataFrame, row_id: str, *, content: Column, level: Column, flat: Column, context: Mapping[str, str], now: Column) -> DataFrame:
    """Log records: content, level, merged attributes without blanks, checked times."""
    time, observed = "timestamp", "observed_timestamp"
    given = F.try_element_at(flat, F.lit(time))
    seen = F.try_element_at(flat, F.lit(observed))
    millis, nanos = telemetry_times(given.try_cast("decimal(38,0)"), seen.try_cast("decimal(38,0)"), now)
    pairs = [F.lit(x) for pair in context.items() for x in pair]
    rest = F.map_filter(flat, lambda k, _: ~k.isin(time, observed))
    return rows.select(
        row_id,
        F.coalesce(content, F.lit("-")).alias("content"),
        level.alias("level"),
        millis.alias("timestamp_ms"),
        nanos.alias("observed_ns"),
        drop_blanks(merge_maps(F.create_map(*pairs), rest) if pairs else rest).alias("attributes"),
    )


def generic_events(
    rows: DataFrame,
    row_id: str,
    *,
    event_type: str | Column,
    title: str,
    message: Column,
    flat: Column,
    start: Column,
    end: Column,
    timestamp: Column,
    now: Column,
    context: Mapping[str, str],
    properties: Column | None = None,
    timeout: int | None = None,
    max_timeout: int = MAX_TIMEOUT,
) -> DataFrame:
    """Events: type, title (the row's message, else the given one), checked times, merged properties.

    Context wins over the row, the row over extra properties. A timeout above max_timeout is
    lowered to it and the rows say so in timeout_lowered.
    """
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    pairs = [F.lit(x) for pair in context.items() for x in pair]
    parts = ([F.create_map(*pairs)] if pairs else []) + [flat] + ([properties] if properties is not None else [])
    return rows.select(
        row_id,
        F.coalesce(F.try_element_at(flat, F.lit("event.type")), kind).alias("event_type"),
        F.coalesce(F.nullif(message, F.lit("")), F.lit(title)).alias("title"),
        normalize_timestamp_unit(start, now).alias("start_ms"),
        normalize_timestamp_unit(end, now).alias("end_ms"),
        normalize_timestamp_unit(timestamp, now).alias("timestamp_ms"),
        F.lit(None if timeout is None else min(timeout, max_timeout)).cast("bigint").alias("timeout"),
        F.lit(timeout is not None and timeout > max_timeout).alias("timeout_lowered"),
        merge_maps(*parts).alias("properties"),
    )


def truncated_events(events: DataFrame, properties: str = "properties", max_chars: int = PROPERTY_CHARS) -> DataFrame:
    """The same events with every property cut to max_chars; empty values vanish.

    cut_properties has the full length of each property that was cut, so no cut goes unseen.
    """
    given = F.col(properties)
    long = F.map_filter(given, lambda _, v: F.length(v) > max_chars)
    cut = F.transform_values(given, lambda _, v: F.substring(v, 1, max_chars))
    empty = F.array(F.lit("{}"), F.lit("[]"))
    return events.withColumns(
        {
            properties: F.map_filter(cut, lambda _, v: ~F.array_contains(empty, v)),
            "cut_properties": F.transform_values(long, lambda _, v: F.length(v).cast("bigint")),
        }
    )


def cloud_events(
    rows: DataFrame, id_columns: Sequence[str], *, source: str, event_type: str, time: Column, flat: Column, extra: Mapping[str, str]
) -> DataFrame:
    """CloudEvents 1.0; the id is a digest of the identifying columns, so a replay repeats it."""
    pairs = [F.lit(x) for pair in extra.items() for x in pair]
    data = merge_maps(F.create_map(*pairs), flat) if pairs else flat
    return rows.select(
        F.lit("1.0").alias("specversion"),
        F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in id_columns]), 256).alias("id"),
        F.lit(source).alias("source"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"),
        F.coalesce(F.try_element_at(flat, F.lit("event.type")), F.lit(event_type)).alias("type"),
        data.alias("data"),
    )


# --- batches -------------------------------------------------------------------------------


def pack_batches(
    events: DataFrame, lane: Sequence[str], order: Sequence[str], size: str, *, max_bytes: int, max_count: int
) -> DataFrame:
    """Number greedy batches bounded by bytes and by count, in order within a lane.

    An event larger than the limit is a batch of its own; a null size counts as 0. Lanes are packed independently: choose them
    fine enough (a source and an hour, say) that none holds a large share of the events.
    Only two counters are carried along a partition; no lane is held in memory.
    """
    columns = [*lane, *order, size]
    sized = events.select(*columns).withColumn(size, F.coalesce(F.col(size), F.lit(0).cast(events.schema[size].dataType)))
    sorted_rows = sized.repartition(*lane).sortWithinPartitions(*lane, *order)

    def number(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, batch, used, held = None, 0, 0, 0
        for part in parts:
            batches = []
            for row in part[[*lane, size]].itertuples(index=False, name=None):
                if row[:-1] != here:
                    here, batch, used, held = row[:-1], 0, 0, 0
                elif used + row[-1] > max_bytes or held >= max_count:
                    batch, used, held = batch + 1, 0, 0
                used, held = used + row[-1], held + 1
                batches.append(batch)
            yield part.assign(batch_no=batches)

    schema = sorted_rows.withColumn("batch_no", F.lit(0).cast("bigint")).schema
    return sorted_rows.mapInPandas(number, schema)


BLOCK_ROWS = 50_000


def pack_long_lanes(
    events: DataFrame, lane: Sequence[str], order: Sequence[str], size: str, *, max_bytes: int, max_count: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The batches of ``pack_batches`` where one lane may hold any share of the events.

    A lane is cut into blocks of equal length. A batch that begins in a block ends within ``max_count``
    events, so for each of the first ``max_count`` places a batch may begin at, the block alone says how many
    batches begin in it and where the first one of the next block does. These maps are composed
    over the blocks by doubling; then each block numbers its events. Sizes are whole numbers from 0 on,
    and the order is unique within a lane.
    """
    length = max(max_count, block_rows)
    names = [f"_lane{i}" for i in range(len(lane))]
    sized = events.select(*lane, *order, F.coalesce(F.col(size), F.lit(0).cast(events.schema[size].dataType)).alias(size))
    placed = _places(sized, lane, order).withColumn("_block", F.expr(f"_at DIV {length}L"))
    placed = cut_lineage(placed)
    keyed = placed.select(*[F.col(c).alias(n) for c, n in zip(lane, names)], "_block", "_at", F.col(size).cast("bigint").alias("_size"))
    # The events a batch of the block before may run into go there as well.
    ahead = keyed.filter((F.col("_block") > 0) & (F.col("_at") % length <= max_count)).withColumn("_block", F.col("_block") - 1)
    by = [*names, "_block"]
    map_schema = T.StructType([*[keyed.schema[c] for c in by], *[T.StructField(c, T.LongType()) for c in ("_from", "_to", "_n")]])

    def entries(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_at")
        first = int(part["_block"].iat[0]) * length
        inside = int((part["_at"] < first + length).sum())
        leave, passed = _leaves(_next_starts(part["_size"].to_numpy(), max_bytes, max_count), inside)
        count = min(inside, max_count) if first else 1
        keys = {c: [part[c].iat[0]] * count for c in by}
        return pd.DataFrame({**keys, "_from": np.arange(count), "_to": leave[:count] - inside, "_n": passed[:count]})

    hops = cut_lineage(keyed.unionByName(ahead).groupBy(*by).applyInPandas(entries, map_schema))
    starts = _entries_of_blocks(hops, names)
    joined = placed.join(
        starts.withColumnRenamed("_block", "_its_block"),
        [F.col("_block") == F.col("_its_block"), *[F.col(c).eqNullSafe(F.col(n)) for c, n in zip(lane, names)]],
    ).select(*lane, *order, size, "_block", "_at", "_entry", "_before")
    out = T.StructType([*sized.schema.fields, T.StructField("batch_no", T.LongType())])

    def number(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_at")
        after = _next_starts(part[size].to_numpy().astype("int64"), max_bytes, max_count)
        begins = np.zeros(len(part), dtype="int64")
        at = int(part["_entry"].iat[0])
        while at < len(part):  # once per batch
            begins[at] = 1
            at = int(after[at])
        part["batch_no"] = part["_before"] - 1 + begins.cumsum()
        return part[out.names]

    return joined.groupBy(*lane, "_block").applyInPandas(number, out)


def _places(rows: DataFrame, lane: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with their place (from 0) in their lane: a range sort, and the sizes of earlier parts."""
    run = cut_lineage(rows.repartitionByRange(*lane, *order).sortWithinPartitions(*lane, *order).withColumn("_id", F.monotonically_increasing_id()))
    run = run.withColumn("_part", F.shiftrightunsigned("_id", 33))
    parts = run.groupBy(*lane, "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    w = Window.partitionBy(*lane).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(lane)], F.col("_part").alias("_its"), (F.coalesce(F.sum("_n").over(w), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    same = [F.col("_part") == F.col("_its"), *[F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(lane)]]
    return run.join(offsets, same).select(*rows.columns, (F.col("_id") + F.col("_shift")).alias("_at"))


def _next_starts(sizes: np.ndarray, max_bytes: int, max_count: int) -> np.ndarray:
    """For a batch that begins at each event, where the next one begins."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype="int64")])
    here = np.arange(len(sizes))
    fits = np.searchsorted(total, total[:-1] + max_bytes, side="right") - 1
    return np.minimum(np.maximum(fits, here + 1), here + max_count)


def _leaves(after: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """From each event of a block: the first start past its end, and the batches begun before, by doubling."""
    to = np.minimum(after[:inside], len(after))
    to = np.concatenate([to, np.arange(inside, len(after) + 1)])
    n = np.concatenate([np.ones(inside, dtype="int64"), np.zeros(len(after) + 1 - inside, dtype="int64")])
    while (to[:inside] < inside).any():
        n, to = n + n[to], to[to]
    return to[:inside], n[:inside]


def _entries_of_blocks(hops: DataFrame, lane: Sequence[str]) -> DataFrame:
    """Where the first batch of each block begins and how many began before, from the maps of single blocks.

    Known are the entries of a lane's first blocks; composed maps over as many blocks carry them on,
    so both double in every round.
    """
    def same(a: str, b: str) -> list[Column]:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in lane]

    known = hops.filter("_block = 0").select(*lane, "_block", F.col("_from").alias("_entry"), F.lit(0).cast("bigint").alias("_before"))
    last = hops.agg(F.max("_block")).first()[0] or 0
    step = 1
    while step <= last:
        carried = known.alias("k").join(hops.alias("h"), [*same("k", "h"), F.expr("k._block = h._block AND k._entry = h._from")])
        carried = carried.select(*[F.col(f"k.{c}") for c in lane], (F.col("k._block") + step).alias("_block"), F.col("_to").alias("_entry"), (F.col("_before") + F.col("_n")).alias("_before"))
        known = cut_lineage(known.unionByName(carried))
        if 2 * step <= last:
            two = hops.alias("a").join(hops.alias("b"), [*same("a", "b"), F.expr(f"b._block = a._block + {step} AND b._from = a._to")])
            hops = cut_lineage(two.select(*[F.col(f"a.{c}") for c in lane], "a._block", "a._from", "b._to", (F.col("a._n") + F.col("b._n")).alias("_n")))
        step *= 2
    return known


def batch_payloads(packed: DataFrame, lane: Sequence[str], order: Sequence[str], payload: str) -> DataFrame:
    """One JSON array per batch; the batch limits bound its size."""
    items = F.array_sort(F.collect_list(F.struct(*order, payload)))
    return packed.groupBy(*lane, "batch_no").agg(
        F.concat(F.lit("["), F.array_join(F.transform(items, lambda i: i[payload]), ","), F.lit("]")).alias("payload")
    )


# --- run reports ---------------------------------------------------------------------------


def run_report(counts: DataFrame, context: str, run_id: str) -> DataFrame:
    """Status-log entry of a run: counts per kind as JSON text, from (kind, n) rows."""
    kinds = ("entries", "log_lines", "metrics", "events", "spans", "span_events", "errors")
    values = [F.max(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in kinds]
    return counts.agg(*values).select(
        F.lit(context).alias("context"), F.lit(run_id).alias("run_id"), F.to_json(F.struct(*kinds)).alias("entries_count")
    )


def run_status_events(runs: DataFrame, status: Column, task: Column, exec_id: Column, ts: Column) -> DataFrame:
    """STARTED / FINISHED / FAILED records of runs, keyed by execution id."""
    return runs.select(
        exec_id.alias("exec_id"),
        task.alias("task_name"),
        F.when(status.isin("STARTED", "FINISHED", "FAILED"), status).otherwise(F.lit("FAILED")).alias("status"),
        F.unix_millis(ts).alias("timestamp_ms"),
        F.concat(F.lit("Run "), exec_id, F.lit(" of "), task, F.lit(" "), F.lower(status)).alias("message"),
    )
