"""Declarative shape of an instrumented row.

A spec says, as SQL expressions over the source columns, where the times, texts and the
members of the four sections come from. ``instrument`` turns it into one projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions import sections as S

# An expression with one of these prefixes is a timestamp to be shown as epoch nanoseconds.
NANOS, NANOS_OR_SENTINEL = "ns:", "ns_or_-1:"


@dataclass(frozen=True)
class RowSpec:
    message: str
    dimensions: Mapping[str, str]
    attributes: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    event_times: Mapping[str, str] = field(default_factory=dict)
    name: str | None = None
    timestamp: str | None = None
    start: str | None = None
    end: str | None = None
    status: str | None = None
    sentinel: bool = False

    def known(self, columns: Sequence[str]) -> "RowSpec":
        """The spec without members whose source column is not delivered: absent means null."""

        def has(expression: str) -> bool:
            bare = re.sub(r"^ns(_or_-1)?:", "", expression)
            return not re.fullmatch(r"[a-z_][a-z0-9_]*", bare) or bare in columns

        def kept(members: Mapping[str, str]) -> dict[str, str]:
            return {k: e for k, e in members.items() if has(e)}

        return RowSpec(
            self.message, kept(self.dimensions), kept(self.attributes), kept(self.metrics), kept(self.event_times),
            *[e if e is None or has(e) else None for e in (self.name, self.timestamp, self.start, self.end, self.status)],
            self.sentinel,
        )


def _value(expression: str) -> Column:
    if expression.startswith(NANOS_OR_SENTINEL):
        return S.epoch_nanos(F.expr(expression[len(NANOS_OR_SENTINEL) :]), -1)
    if expression.startswith(NANOS):
        return S.epoch_nanos(F.expr(expression[len(NANOS) :]))
    return F.expr(expression)


def _text_value(rows: DataFrame, expression: str) -> Column:
    """Arrays and structures become JSON text."""
    value = _value(expression)
    kind = dict(rows.dtypes).get(expression, "")
    return F.to_json(value) if kind.startswith(("array", "struct", "map")) else value


def instrument(rows: DataFrame, spec: RowSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Telemetry rows: times in epoch ns, name, message, status and the four sections."""
    spec = spec.known(rows.columns)

    def nanos(expression: str | None) -> Column:
        if expression is None:
            return F.lit(None).cast("bigint")
        return S.epoch_nanos(F.expr(expression), -1 if spec.sentinel else None)

    def text(expression: str | None) -> Column:
        return F.lit(None).cast("string") if expression is None else F.expr(expression)

    timestamp = nanos(spec.timestamp)
    return rows.select(
        *keep,
        timestamp.alias("timestamp_ns"),
        (nanos(spec.start) if spec.start else timestamp).alias("start_time"),
        nanos(spec.end).alias("end_time"),
        text(spec.name).alias("name"),
        text(spec.message).alias("message"),
        text(spec.status).alias("status_code"),
        S.text_section({k: _text_value(rows, e) for k, e in spec.dimensions.items()}).alias("dimensions"),
        S.text_section({k: _text_value(rows, e) for k, e in spec.attributes.items()}).alias("attributes"),
        S.number_section({k: _value(e) for k, e in spec.metrics.items()}).alias("metrics"),
        S.time_section({k: F.expr(e) for k, e in spec.event_times.items()}).alias("event_timestamps"),
    )


def at(moment) -> Column:
    """The moment of the run as a timestamp column."""
    return F.lit(moment).cast("timestamp")
