"""One instrumented row -> metrics, timestamp events, an event or a log record, and a span.

Every output is a projection of the rows, which the caller stores first if several are
written; nothing passes through the driver but the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.sections import drop_blanks, span_status, status_level, unpack_sections


def event_condition(value: Column, compare: str | None = None) -> Column:
    """The column is present, or contains the given text in any case."""
    text = value.cast("string")
    if compare is None:
        return text.isNotNull() & (F.lower(text) != "nan")
    return F.coalesce(F.contains(F.lower(text), F.lower(F.lit(compare))), F.lit(False))


def metric_records(rows: DataFrame, keep: list[str], start: str = "start_time") -> DataFrame:
    """One row per metric of a row."""
    return rows.select(*keep, F.col(start).alias("ts_ns"), "dimensions", F.explode("metrics").alias("metric", "value"))


def timestamp_events(rows: DataFrame, keep: list[str], mark_ns: int = 0) -> DataFrame:
    """One event per event timestamp at or after the last mark."""
    return rows.select(*keep, "dimensions", F.explode("event_timestamps").alias("trigger", "event_ns")).filter(
        F.col("event_ns") >= mark_ns
    ).withColumn("title", F.concat(F.lit("Table event "), F.col("trigger"), F.lit(".")))


@dataclass(frozen=True)
class SpanColumns:
    """Columns that make a row a span; a row without a span id is none. ``end`` is in epoch ns like the start."""

    span_id: str = "span_id"
    trace_id: str = "trace_id"
    parent_id: str = "parent_span_id"
    end: str = "end_time"
    name: str = "message"


def gave_any() -> Column:
    """Whether a row gave any record."""
    return (F.col("n_metrics") > 0) | (F.col("n_times") > 0) | F.col("is_event") | F.col("is_log") | F.col("is_span")


KINDS = ("metrics", "timestamp_events", "events", "logs", "spans", "span_events")


@dataclass
class FanOut:
    """The outputs of a context, one frame per kind, and which rows gave any of them."""

    metrics: DataFrame
    timestamp_events: DataFrame
    events: DataFrame
    logs: DataFrame
    spans: DataFrame
    span_events: DataFrame
    per_row: DataFrame

    @property
    def entries(self) -> DataFrame:
        """Rows that gave any record."""
        return self.per_row.filter(gave_any())

    def totals(self) -> list[Column]:
        """Aggregates of ``per_row``: how many records of each kind; errors are spans that cannot be written."""
        return [
            F.count_if(gave_any()).alias("entries"),
            F.count_if("is_log").alias("log_lines"),
            F.coalesce(F.sum("n_metrics"), F.lit(0)).alias("metrics"),
            (F.count_if("is_event") + F.coalesce(F.sum("n_times"), F.lit(0))).alias("events"),
            F.count_if("is_span").alias("spans"),
            F.coalesce(F.sum("n_span_events"), F.lit(0)).alias("span_events"),
            F.count_if("is_error").alias("errors"),
        ]

    def counts(self, totals: DataFrame | None = None) -> DataFrame:
        """(kind, n) of all kinds, in one pass over the rows, or from the row of ``totals`` if there is one already."""
        totals = self.per_row.agg(*self.totals()) if totals is None else totals
        return totals.unpivot([], ["entries", "log_lines", "metrics", "events", "spans", "span_events", "errors"], "kind", "n")


def fan_out(
    rows: DataFrame,
    row_id: str,
    *,
    report_logs: bool = True,
    report_metrics: bool = True,
    report_timestamp_events: bool = True,
    report_all_as_events: bool = False,
    event_column: str | None = None,
    event_value: str | None = None,
    level: Column | None = None,
    start: str = "start_time",
    mark_ns: int = 0,
    spans: SpanColumns | None = None,
    keep: Sequence[Column] = (),
) -> FanOut:
    """Split instrumented rows by kind of record.

    A row becomes an event instead of a log when all rows do, or when the named member of
    its flat form is present (and contains the given value). Columns needed: the row id,
    ``start``, message and the four sections.

    With ``spans``, a row with a span id is a span as well, with its event timestamps from the
    start to the end of the span as span events. One without a trace or a valid time range
    cannot be written; it counts as an error. ``keep`` are further columns of ``per_row``.
    """
    flat = rows.withColumn(
        "_flat",
        unpack_sections(F.col("dimensions"), F.col("attributes"), F.col("metrics"), F.col("event_timestamps")),
    )
    as_event = F.lit(report_all_as_events)
    if event_column is not None:
        as_event = as_event | event_condition(F.try_element_at(F.col("_flat"), F.lit(event_column)), event_value)
    zero = F.lit(0)
    recent = F.filter(F.map_values("event_timestamps"), lambda t: t >= mark_ns)
    flat = flat.withColumns({"_event": as_event, "_log": ~as_event & F.lit(report_logs)})
    named = spans or SpanColumns()
    if spans is None:
        marked = flat.withColumns({"_span": F.lit(False), "_lost": F.lit(False), "_within": F.lit(None).cast("map<string,bigint>")})
    else:
        begin, end = F.col(start), F.col(named.end)
        whole = F.coalesce(F.col(named.trace_id).isNotNull() & (end >= begin), F.lit(False))
        is_span = F.col(named.span_id).isNotNull()
        within = F.map_filter("event_timestamps", lambda _, t: t.between(begin, end))
        marked = flat.withColumns({"_span": is_span & whole, "_lost": is_span & ~whole, "_within": F.when(is_span & whole, within)})
    span_rows = marked.filter("_span")
    per_row = marked.select(
        row_id,
        *keep,
        (F.size("metrics") if report_metrics else zero).cast("bigint").alias("n_metrics"),
        (F.size(recent) if report_timestamp_events else zero).cast("bigint").alias("n_times"),
        F.col("_event").alias("is_event"),
        F.col("_log").alias("is_log"),
        F.col("_span").alias("is_span"),
        F.coalesce(F.size("_within"), zero).cast("bigint").alias("n_span_events"),
        F.col("_lost").alias("is_error"),
    )

    def of_span(column: str, kind: str = "string") -> Column:
        return F.col(column).cast(kind) if spans else F.lit(None).cast(kind)

    log_level = level if level is not None else status_level(F.try_element_at(F.col("_flat"), F.lit("status.code")))
    body = drop_blanks(F.col("_flat"))
    return FanOut(
        metrics=metric_records(rows if report_metrics else rows.filter(F.lit(False)), [row_id], start),
        timestamp_events=timestamp_events(rows if report_timestamp_events else rows.filter(F.lit(False)), [row_id], mark_ns),
        events=flat.filter("_event").select(row_id, "message", body.alias("properties")),
        logs=flat.filter("_log").select(row_id, F.col("message").alias("content"), log_level.alias("level"), body.alias("attributes")),
        spans=span_rows.select(
            row_id,
            of_span(named.trace_id).alias("trace_id"),
            of_span(named.span_id).alias("span_id"),
            of_span(named.parent_id).alias("parent_span_id"),
            F.when(of_span(named.parent_id).isNull(), F.lit("SERVER")).otherwise(F.lit("INTERNAL")).alias("kind"),
            of_span(named.name).alias("name"),
            F.col(start).alias("start_ns"),
            of_span(named.end, "bigint").alias("end_ns"),
            span_status(F.try_element_at(F.col("_flat"), F.lit("status.code"))).alias("status_code"),
            body.alias("attributes"),
        ),
        span_events=span_rows.select(
            row_id, of_span(named.trace_id).alias("trace_id"), of_span(named.span_id).alias("span_id"), F.explode("_within").alias("event", "event_ns")
        ),
        per_row=per_row,
    )


