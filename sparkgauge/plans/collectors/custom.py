"""Any table, query or list of objects as telemetry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.sections import drop_blanks, status_level
from sparkgauge.operators.fanout import FanOut, fan_out
from sparkgauge.sources.sinks import cloud_events, generic_events, log_records


@dataclass(frozen=True)
class Switches:
    """Which kinds of records a call asks for; ``events`` defaults to the structured mode."""

    auto_mode: bool = True
    logs: bool = True
    metrics: bool = True
    events: bool | None = None
    cloud_events: bool = False
    context: str = "telemetry_sender"

    @property
    def wants_events(self) -> bool:
        return self.auto_mode if self.events is None else self.events


def structured_source(rows: DataFrame, row_id: str, switches: Switches, mark_ns: int = 0) -> FanOut:
    """Rows with the four sections: metrics, timestamp events and logs by the general fan-out."""
    return fan_out(
        rows,
        row_id,
        report_logs=switches.logs,
        report_metrics=switches.metrics,
        report_timestamp_events=switches.wants_events,
        start="timestamp_ns",
        mark_ns=mark_ns,
    )


def flat_source(rows: DataFrame, row_id: str, switches: Switches, *, now: Column, run_id: str, source: str = "local") -> dict[str, DataFrame]:
    """Flat rows (message, flat text map) as logs, events or CloudEvents, one read for all of them."""
    flat = drop_blanks(F.col("flat"))
    context = {"run.plugin": "telemetry_sender", "run.context": switches.context, "run.id": run_id}
    time = F.try_element_at(F.col("flat"), F.lit("timestamp")).try_cast("decimal(38,0)")
    out: dict[str, DataFrame] = {}
    if switches.logs:
        content = F.coalesce("message", F.lit(f"Log entry sent with {switches.context}"))
        level = status_level(F.try_element_at(F.col("flat"), F.lit("status.code")))
        out["logs"] = log_records(rows, row_id, content=content, level=level, flat=flat, context=context, now=now)
    if switches.wants_events:
        out["events"] = generic_events(
            rows, row_id, event_type="CUSTOM_INFO", title=f"Event sent with {switches.context}", message=F.col("message"),
            flat=flat, start=time, end=F.lit(None), timestamp=time, now=now, context=context,
        )
    if switches.cloud_events:
        out["cloud_events"] = cloud_events(
            rows, [row_id], source=source, event_type="CUSTOM_INFO", time=now, flat=flat, extra=context
        )
    return out


def source_counts(outputs: dict[str, DataFrame], rows: DataFrame) -> DataFrame:
    """Entries and records per kind."""
    out = rows.agg(F.count("*").alias("n")).select(F.lit("entries").alias("kind"), "n")
    for kind, frame in outputs.items():
        out = out.unionByName(frame.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n"))
    return out
