"""Column builders for the four sections of a telemetry row.

DIMENSIONS and ATTRIBUTES are ``map<string,string>``, METRICS ``map<string,double>``,
EVENT_TIMESTAMPS ``map<string,bigint>`` (epoch nanoseconds). A member that is null
does not exist. Everything here is a column expression: no shuffle, no Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_MAP = "map<string,string>"
NUMBER_MAP = "map<string,double>"
TIME_MAP = "map<string,bigint>"

# Fixed value: the sections of a row, in the order in which they win when keys collide.
SECTIONS = ("dimensions", "attributes", "metrics", "event_timestamps")


# --- times ---------------------------------------------------------------------------------


def epoch_nanos(ts: Column, missing: int | None = None) -> Column:
    """Epoch nanoseconds of a timestamp; null stays null unless a sentinel is given."""
    nanos = F.unix_micros(ts) * F.lit(1000)
    return nanos if missing is None else F.coalesce(nanos, F.lit(missing).cast("bigint"))


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def nanos_from_any(value: Column, default: Column | None = None) -> Column:
    """Epoch nanoseconds from text that is a whole number (kept) or an ISO-8601 time (naive = UTC)."""
    parsed = F.coalesce(
        value.try_cast("bigint"),
        F.unix_micros(F.try_to_timestamp(value)) * F.lit(1000),
    )
    return parsed if default is None else F.coalesce(parsed, default)


# Year 2100 in ms, us, ns and ps; larger numbers are the next finer unit.
LAST_MS, LAST_US, LAST_NS, LAST_PS = (
    "4100000000000",
    "4100000000000000",
    "4100000000000000000",
    "4100000000000000000000",
)
# Accepted age and lead of a telemetry time, in minutes.
PAST_MINUTES, FUTURE_MINUTES = 24 * 60 - 5, 10


def normalize_timestamp_unit(
    value: Column,
    now: Column,
    *,
    past_minutes: int = PAST_MINUTES,
    future_minutes: int = FUTURE_MINUTES,
    unit: str = "ms",
    check_range: bool = True,
) -> Column:
    """Detect ms, us, ns, ps or fs by size and return ns or ms; null when out of bounds.

    ``value`` is any number up to 38 digits, ``now`` the current time.
    """
    if unit not in ("ms", "ns"):
        raise ValueError(f"unit must be 'ms' or 'ns', not {unit!r}")
    v = value.cast("decimal(38,0)")

    def above(bound: str) -> Column:
        return v > F.lit(bound).cast("decimal(38,0)")

    def whole(numerator: Column, by: int) -> Column:
        return F.floor(numerator / F.lit(by).cast("decimal(38,0)"))

    nanos = (
        F.when(v < 0, None)
        .when(above(LAST_PS), whole(v, 1_000_000))
        .when(above(LAST_NS), whole(v, 1_000))
        .when(above(LAST_US), v)
        .when(above(LAST_MS), v * 1_000)
        .otherwise(v * 1_000_000)
    )
    nanos = F.when(nanos <= F.lit(LAST_NS).cast("decimal(38,0)"), nanos).cast("bigint")
    if check_range:
        at = F.unix_micros(now) * F.lit(1000)
        minute = 60 * 1_000_000_000
        nanos = F.when(
            (nanos >= at - F.lit(past_minutes * minute)) & (nanos <= at + F.lit(future_minutes * minute)), nanos
        )
    return nanos if unit == "ns" else nanos_to_millis(nanos)


def nanos_to_millis(nanos: Column) -> Column:
    """Whole milliseconds, through decimal so that no digit is lost."""
    return F.floor(nanos.cast("decimal(20,0)") / F.lit(1_000_000)).cast("bigint")


def telemetry_times(timestamp: Column, observed: Column | None, now: Column) -> tuple[Column, Column]:
    """(time in ms, range checked; observed time in ns, any age); observed falls back to the time."""
    seen = timestamp if observed is None else F.coalesce(observed, timestamp)
    return (
        normalize_timestamp_unit(timestamp, now, unit="ms"),
        normalize_timestamp_unit(seen, now, unit="ns", check_range=False),
    )


# A span may start at most 59 minutes ago and at most 9 minutes ahead.
CLAMP_PAST_NS, CLAMP_FUTURE_NS = 59 * 60 * 10**9, 9 * 60 * 10**9


def clamp_timestamps(start: Column, timestamp: Column, end: Column, now: Column) -> tuple[Column, Column, Column]:
    """Move start, timestamp and end (epoch ns) into the accepted window, keeping the span length.

    Any of the three may be null; ``now`` is epoch ns.
    """
    low, high = now - F.lit(CLAMP_PAST_NS), now + F.lit(CLAMP_FUTURE_NS)
    span = F.coalesce(end - start, F.lit(0).cast("bigint"))

    def moved(t: Column) -> Column:
        back = F.when(t > high, high - span).otherwise(t)
        return F.when(back < low, low).otherwise(back)

    def dragged(before: Column, t: Column) -> Column:
        """The end follows a moved time."""
        outside = (t > high) | (t < low)
        return F.when(outside & before.isNotNull(), moved(t) + span).otherwise(before)

    new_start, new_timestamp = moved(start), moved(timestamp)
    new_end = dragged(dragged(end, start), timestamp)
    anchor = F.coalesce(new_start, new_timestamp)
    late = F.least(high, F.coalesce(anchor + span, new_end))
    return new_start, new_timestamp, F.when(new_end > high, late).otherwise(new_end)


# --- sections ------------------------------------------------------------------------------


def _members(values: Mapping[str, Column], kind: str) -> list[Column]:
    return [c for key, value in values.items() for c in (F.lit(key), value.cast(kind))]


def _build(values: Mapping[str, Column], kind: str, map_type: str) -> Column:
    if not values:
        return F.create_map().cast(map_type)
    return F.map_filter(F.create_map(*_members(values, kind)), lambda _, v: v.isNotNull())


def text_section(values: Mapping[str, Column]) -> Column:
    """DIMENSIONS or ATTRIBUTES: non-null members as text."""
    return _build(values, "string", TEXT_MAP)


def number_section(values: Mapping[str, Column]) -> Column:
    """METRICS: non-null members as double."""
    return _build(values, "double", NUMBER_MAP)


def time_section(values: Mapping[str, Column]) -> Column:
    """EVENT_TIMESTAMPS: timestamps as epoch ns, null ones left out."""
    return _build({k: epoch_nanos(v) for k, v in values.items()}, "bigint", TIME_MAP)


def object_keep_null(values: Mapping[str, Column]) -> Column:
    """JSON object text that keeps null members."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": "false"})


def merge_maps(*maps: Column) -> Column:
    """One map; where keys collide the earlier map wins. Null maps count as empty.

    The last of several equal keys wins in the session (see ``session.configure``), so the
    maps are put together from the last to the first, in one pass.
    """
    empty = F.create_map().cast(TEXT_MAP)
    return F.map_concat(*[F.coalesce(m, empty) for m in reversed(maps)])


def number_text(value: Column) -> Column:
    """Number as text, whole numbers without a decimal part."""
    whole = value.cast("bigint")
    return F.when(value == whole.cast("double"), whole.cast("string")).otherwise(value.cast("string"))


def unpack_sections(
    dimensions: Column | None = None,
    attributes: Column | None = None,
    metrics: Column | None = None,
    event_timestamps: Column | None = None,
) -> Column:
    """All sections as one flat text map; the earlier section wins."""
    parts = [c for c in (dimensions, attributes) if c is not None]
    if metrics is not None:
        parts.append(F.transform_values(metrics, lambda _, v: number_text(v)))
    if event_timestamps is not None:
        parts.append(event_timestamps.cast(TEXT_MAP))
    return merge_maps(*parts)


def drop_blanks(flat: Column) -> Column:
    """Remove members that are null or only white space."""
    return F.map_filter(flat, lambda _, v: F.regexp_replace(v, r"\s+", "") != "")


def pack_json_values(flat: Column) -> Column:
    """Non-scalar values as JSON text: lists are opened one level, objects in them become text.

    Empty objects and lists vanish, in the map and inside a list.
    """
    empty = F.array(F.lit("{}"), F.lit("[]"))

    def packed(value: Column) -> Column:
        items = F.from_json(value, "array<string>")
        kept = F.filter(items, lambda x: x.isNotNull() & ~F.array_contains(empty, x))
        is_list = F.trim(value).startswith("[") & items.isNotNull()
        return F.when(is_list, F.when(F.size(kept) > 0, F.to_json(kept))).otherwise(value)

    changed = F.transform_values(flat, lambda _, v: packed(v))
    return F.map_filter(changed, lambda _, v: v.isNotNull() & ~F.array_contains(empty, v))


def add_context(flat: Column, context: Mapping[str, str]) -> Column:
    """Add run context and resource attributes; the context wins over the row."""
    pairs = [F.lit(x) for pair in context.items() for x in pair]
    return merge_maps(F.create_map(*pairs), flat)


# Names of the run-context members.
RUN_PLUGIN, RUN_CONTEXT, RUN_ID = "run.plugin", "run.context", "run.id"


def run_context(plugin: str, context: str, run_id: str, resource: Mapping[str, str] | None = None) -> dict[str, str]:
    """Members that every record of a run carries."""
    return {**(resource or {}), RUN_PLUGIN: plugin, RUN_CONTEXT: context, RUN_ID: run_id}


# Fixed value: prefix of field names that belong to the observed platform.
PLATFORM_PREFIX = "platform."


def with_vendor_prefix(section: Column, vendor: str) -> Column:
    """Give platform fields the prefix of a given vendor."""
    return F.transform_keys(
        section,
        lambda k, _: F.when(
            k.startswith(PLATFORM_PREFIX), F.concat(F.lit(f"{vendor}."), F.substr(k, F.lit(len(PLATFORM_PREFIX) + 1)))
        ).otherwise(k),
    )


# --- status and level ----------------------------------------------------------------------


def status_code(status: Column, ok: Iterable[str] = ("SUCCESS",)) -> Column:
    """OK for the given statuses, ERROR for any other text, UNSET for none."""
    return (
        F.when(status.isin(*ok), F.lit("OK"))
        .when(F.length(F.coalesce(status, F.lit(""))) > 0, F.lit("ERROR"))
        .otherwise(F.lit("UNSET"))
    )


def span_status(code: Column) -> Column:
    """Status of a span record: error and unset by name, anything else is OK."""
    return (
        F.when(code == "STATUS_CODE_ERROR", F.lit("ERROR")).when(code == "STATUS_CODE_UNSET", F.lit("UNSET")).otherwise(F.lit("OK"))
    )


# Log level by severity of a finding.
SEVERITY_LEVELS = {"CRITICAL": "CRITICAL", "HIGH": "ERROR", "MEDIUM": "WARNING", "LOW": "INFO"}


def severity_level(severity: Column) -> Column:
    out = F.lit("INFO")
    for name, level in SEVERITY_LEVELS.items():
        out = F.when(severity == name, F.lit(level)).otherwise(out)
    return out


def status_level(status: Column) -> Column:
    """INFO unless a status is present and not OK."""
    return F.when(F.coalesce(status, F.lit("OK")) == "OK", F.lit("INFO")).otherwise(F.lit("ERROR"))


def bucketize(value: Column, bounds: Mapping[str, float], otherwise: str) -> Column:
    """Label of the first bound the value is below, in the given order."""
    out = None
    for label, bound in bounds.items():
        out = F.when(value < bound, label) if out is None else out.when(value < bound, label)
    return out.otherwise(otherwise)


def code_of(value: Column, codes: Mapping[str, int], otherwise: int) -> Column:
    """Whole-number code of a state."""
    out = F.lit(otherwise).cast("bigint")
    for name, code in codes.items():
        out = F.when(value == name, F.lit(code).cast("bigint")).otherwise(out)
    return out
