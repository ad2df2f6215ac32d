"""Event log (records, metrics, spans), event usage, logins and sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions import sections as S
from sparkgauge.functions.text import flatten_log_attributes, json_or_null, unquote_content
from sparkgauge.operators.aggregates import object_agg
from sparkgauge.operators.expand import prefix_map_keys
from sparkgauge.operators.predicates import database_scope, event_log_noise, since_last_run
from sparkgauge.operators.windows import batch_limit_oldest
from sparkgauge.plans.collectors.spec import RowSpec, instrument

# Dimensions taken from resource attributes.
RESOURCE_DIMENSIONS = {
    "db.namespace": "snow.database.name",
    "platform.schema.name": "snow.schema.name",
    "platform.role.name": "snow.session.role.primary.name",
    "platform.warehouse.name": "snow.warehouse.name",
    "platform.query.id": "snow.query.id",
}

# Members of event-usage, login and session rows and the columns they come from.
EVENT_USAGE = RowSpec(
    message="'New Event Usage entry'",
    start="start_time",
    end="end_time",
    timestamp="end_time",
    dimensions={},
    metrics={"platform.credits.used": "credits_used", "platform.data.ingested": "bytes_ingested"},
)
LOGIN_HISTORY = RowSpec(
    timestamp="event_timestamp",
    message="event_type || ': ' || user_name",
    dimensions={"event.name": "event_type", "db.user": "user_name", "client.ip": "client_ip", "client.type": "reported_client_type"},
    attributes={
        "event.id": "event_id",
        "client.version": "reported_client_version",
        "authentication.factor.first": "first_authentication_factor",
        "authentication.factor.second": "second_authentication_factor",
        "status.code": "CASE WHEN is_success = 'YES' THEN 'OK' ELSE 'ERROR' END",
        "error.code": "error_code",
        "status.message": "error_message",
        "event.related_id": "related_event_id",
        "db.platform.connection": "connection",
    },
)
SESSIONS = RowSpec(
    timestamp="created_on",
    message="'New Sessions entry for ' || user_name",
    dimensions={"db.user": "user_name"},
    attributes={
        "platform.session.start": "created_on",
        "session.id": "session_id",
        "authentication.type": "authentication_method",
        "event.id": "login_event_id",
        "client.application.id": "client_application_id",
        "client.application.version": "client_application_version",
        "client.environment": "client_environment",
        "client.build_id": "client_build_id",
        "client.version": "client_version",
        "platform.session.closed_reason": "closed_reason",
    },
)


def _resource(key: str) -> Column:
    return F.try_element_at(F.col("resource_attributes"), F.lit(key))


def _in_scope(events: DataFrame, as_of, mark, hours: float, databases: Sequence[str], own: str, family: str, cross_tenant: bool) -> DataFrame:
    recent = since_last_run(events, "timestamp", as_of, mark, hours=hours)
    quiet = _resource("application").isNull() | ~_resource("application").isin("openflow")
    return recent.filter(
        database_scope(_resource("snow.database.name"), databases, own=own, family=family, cross_tenant=cross_tenant) & quiet
    )


def _resource_dimensions() -> Column:
    return S.text_section({k: _resource(v) for k, v in RESOURCE_DIMENSIONS.items()})


def event_log(
    events: DataFrame,
    as_of: dt.datetime,
    mark: dt.datetime | None,
    *,
    hours: float = 24,
    databases: Sequence[str] = (),
    own: str = "SELF_DB",
    family: str = "SELF%\\_DB",
    own_scope: str = r"SELF(_\S*)?_OTLP",
    cross_tenant: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Log records of the event table, all of them, or the oldest if a limit is given, with one flat attribute map.

    ``events`` holds (event_id, timestamp, start_timestamp, observed_timestamp, record_type, value
    and the maps record, record_attributes, resource_attributes, scope, trace).
    """
    kept = _in_scope(events, as_of, mark, hours, databases, own, family, cross_tenant).filter(
        event_log_noise(
            scope=F.try_element_at(F.col("scope"), F.lit("name")),
            value=F.col("value"),
            record_type=F.col("record_type"),
            database=_resource("snow.database.name"),
            severity=F.try_element_at(F.col("record"), F.lit("severity_text")),
            application=_resource("application"),
            own_scope=own_scope,
            family=family,
        )
    )
    taken = batch_limit_oldest(kept, "timestamp", "event_id", limit)
    own_columns = {
        "TIMESTAMP": S.epoch_nanos(F.col("timestamp")),
        "RECORD_TYPE": F.col("record_type"),
        "OBSERVED_TIMESTAMP": S.epoch_nanos(F.col("observed_timestamp")),
        "START_TIME": S.epoch_nanos(F.col("start_timestamp")),
        "TRACE_ID": F.try_element_at(F.col("trace"), F.lit("trace_id")),
        "SPAN_ID": F.try_element_at(F.col("trace"), F.lit("span_id")),
    }
    value_object = F.when(json_or_null(F.col("value")).isNotNull(), F.from_json("value", S.TEXT_MAP))
    parts = [F.col("record"), F.col("record_attributes"), F.col("resource_attributes"), value_object]
    message = F.concat(F.lit("New Event Log entry from "), _resource("snow.database.name"))
    return taken.select(
        "event_id",
        S.epoch_nanos(F.col("timestamp")).alias("timestamp_ns"),
        F.coalesce(unquote_content(F.col("value")), message, F.lit("event log entry")).alias("content"),
        F.coalesce(F.try_element_at(F.col("record"), F.lit("severity_text")), F.lit("INFO")).alias("level"),
        flatten_log_attributes(parts, F.col("scope"), own_columns, "platform.event.scope.").alias("attributes"),
    )


def event_log_metrics(
    events: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24, databases: Sequence[str] = (), own: str = "SELF_DB", family: str = "SELF%\\_DB", cross_tenant: bool = True, limit: int | None = None
) -> DataFrame:
    """Metric records with the same time and dimensions as one row; the last value of a name wins.

    Dimensions: resource names, then resource attributes, then record attributes, which carry
    the application as prefix; earlier parts win.
    """
    scoped = _in_scope(events.filter("record_type = 'METRIC'"), as_of, mark, hours, databases, own, family, cross_tenant)
    taken = batch_limit_oldest(scoped, "timestamp", "event_id", limit).withColumn("_app", _resource("application"))
    keyed = prefix_map_keys(taken, "record_attributes", "_app").withColumn(
        "dimensions", S.merge_maps(_resource_dimensions(), F.col("resource_attributes"), F.col("record_attributes"))
    )
    # Map keys cannot group: the sorted entries stand for the map.
    flat = keyed.withColumns(
        {
            "_dims": F.to_json(F.map_from_entries(F.array_sort(F.map_entries("dimensions")))),
            "_name": F.try_element_at(F.col("record"), F.lit("metric.name")),
            "_value": F.col("value").try_cast("double"),
        }
    )
    values = object_agg(flat, ["timestamp", "_dims"], "_name", "_value", ["event_id"], "metrics")
    return values.select(
        S.epoch_nanos(F.col("timestamp")).alias("timestamp_ns"),
        S.epoch_nanos(F.col("timestamp")).alias("start_time"),
        F.from_json("_dims", S.TEXT_MAP).alias("dimensions"),
        F.create_map().cast(S.TEXT_MAP).alias("attributes"),
        "metrics",
        F.create_map().cast(S.TIME_MAP).alias("event_timestamps"),
    )


def metric_definitions(events: DataFrame) -> DataFrame:
    """Distinct names and units that metric records bring along."""
    records = events.filter("record_type = 'METRIC'")
    name = F.try_element_at(F.col("record"), F.lit("metric.name"))
    return records.groupBy(name.alias("metric")).agg(
        F.concat(F.lit("Platform metric: "), name).alias("local_name"),
        F.max(F.try_element_at(F.col("record"), F.lit("metric.unit"))).alias("local_unit"),
    )


def event_log_spans(
    events: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24, databases: Sequence[str] = (), own: str = "SELF_DB", family: str = "SELF%\\_DB", cross_tenant: bool = True, limit: int | None = None
) -> DataFrame:
    """Closed span records with ids, kind and status."""
    scoped = _in_scope(events.filter("record_type = 'SPAN'"), as_of, mark, hours, databases, own, family, cross_tenant)
    taken = batch_limit_oldest(scoped, "timestamp", "event_id", limit).filter(F.col("timestamp").isNotNull())

    def record(key: str) -> Column:
        return F.try_element_at(F.col("record"), F.lit(key))

    def trace(key: str) -> Column:
        return F.try_element_at(F.col("trace"), F.lit(key))

    return taken.select(
        "event_id",
        _resource("snow.query.id").alias("query_id"),
        _resource("snow.session.id").alias("session_id"),
        _resource("snow.executable.name").alias("name"),
        S.epoch_nanos(F.col("start_timestamp")).alias("start_time"),
        S.epoch_nanos(F.col("timestamp")).alias("end_time"),
        S.epoch_nanos(F.col("timestamp")).alias("timestamp_ns"),
        S.span_status(record("status.code")).alias("status_code"),
        trace("span_id").alias("span_id"),
        trace("trace_id").alias("trace_id"),
        record("parent_span_id").alias("parent_span_id"),
        record("kind").alias("span_kind"),
        record("parent_span_id").isNull().alias("is_root"),
        S.merge_maps(_resource_dimensions(), F.col("resource_attributes")).alias("dimensions"),
    )


def event_usage(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 6) -> DataFrame:
    return instrument(since_last_run(rows, "end_time", as_of, mark, hours=hours), EVENT_USAGE)


def login_history(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24, limit: int | None = None) -> DataFrame:
    recent = since_last_run(rows, "event_timestamp", as_of, mark, hours=hours)
    return instrument(batch_limit_oldest(recent, "event_timestamp", "event_id", limit), LOGIN_HISTORY, ["event_id"])


def sessions(rows: DataFrame, as_of: dt.datetime, mark: dt.datetime | None, *, hours: float = 24, limit: int | None = None) -> DataFrame:
    recent = since_last_run(rows, "created_on", as_of, mark, hours=hours)
    return instrument(batch_limit_oldest(recent, "created_on", "session_id", limit), SESSIONS, ["session_id"])
