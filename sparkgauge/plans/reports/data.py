"""Data volume, schema changes, pipes, tasks, dynamic tables and shares."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.sections import bucketize, code_of
from sparkgauge.operators.aggregates import exact_percentile, summarize, take_first, take_last
from sparkgauge.operators.predicates import filter_out
from sparkgauge.operators.series import DAY, HOUR, bin_start, bin_summarize, make_timeseries, series_divide
from sparkgauge.operators.windows import newest, top_k_groups
from sparkgauge.plans.reports.costs import chosen

c = F.col


# --- volume --------------------------------------------------------------------------------


def volume_total(points: DataFrame, measure: str, step_s: int = DAY, **variables) -> DataFrame:
    """Sum over accounts of the highest binned total of a measure."""
    series = bin_summarize(chosen(points, **variables), "ts", ["account"], step_s, total=F.sum(measure))
    top = summarize(series, ["account"], latest=F.max("total"))
    return top.agg(F.sum("latest").alias(measure))


def volume_growth(points: DataFrame, measure: str, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(chosen(points, **variables), "ts", ["database_name", "account"], step_s=step_s, total=F.sum(measure))


def largest_tables(points: DataFrame, k: int = 20, **variables) -> DataFrame:
    """The largest value over the bins of a maximum is the maximum itself, so no series is built."""
    keys = ["table_name", "database_name", "account"]
    return top_k_groups(summarize(chosen(points, **variables), keys, size=F.max("bytes")), "size", k, *keys)


def table_types(points: DataFrame, **variables) -> DataFrame:
    rows = chosen(points, **variables).filter(c("bytes").isNotNull())
    return summarize(rows, ["table_type"], n=F.count_distinct("table_name")).orderBy(c("n").desc(), "table_type")


def stale_tables(points: DataFrame, k: int = 50, **variables) -> DataFrame:
    keys = ["table_name", "database_name", "account", "table_type"]
    oldest = summarize(chosen(points, **variables), keys, minutes=F.max("minutes_since_update"))
    return top_k_groups(oldest, "minutes", k, *keys).withColumn("days_since_update", c("minutes") / 1440.0).drop("minutes")


# Age buckets of the last schema change, in days.
AGE_BUCKETS = {"< 1 week": 7, "1 week – 1 month": 30, "1 – 3 months": 90, "3 – 6 months": 180}


def ddl_age(points: DataFrame, **variables) -> DataFrame:
    oldest = summarize(chosen(points, **variables), ["table_name", "database_name", "account"], minutes=F.max("minutes_since_ddl"))
    bucket = bucketize(c("minutes") / 1440.0, AGE_BUCKETS, "> 6 months")
    return summarize(oldest, {"bucket": bucket}, n=F.count("*"))


def ddl_over_time(events: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(events, **variables).filter(c("operation").isNotNull())
    return make_timeseries(rows, "ts", ["operation"], step_s=step_s, n=F.count("*"))


def ddl_object_types(events: DataFrame, **variables) -> DataFrame:
    rows = chosen(events, **variables).filter(c("object_domain").isNotNull())
    return summarize(rows, ["object_domain"], n=F.count("*")).orderBy(c("n").desc(), "object_domain")


def recent_ddl(events: DataFrame, k: int | None = None, **variables) -> DataFrame:
    rows = chosen(events, **variables).filter(c("operation").isNotNull())
    return newest(rows, "ts", "event_no", k).select("event_no", "ts", "account", "object_name", "operation", "object_domain", "user_name", "properties")


# --- shares --------------------------------------------------------------------------------


def share_count(share_log: DataFrame, kind: str, **variables) -> DataFrame:
    rows = chosen(share_log, **variables).filter(c("kind") == kind)
    return rows.agg(F.count_distinct("share_name").alias("n"))


def share_inventory(share_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(share_log, **variables).filter(c("share_name").isNotNull())
    first = {n: take_first(c(n), "ts", "event_id") for n in ("owner", "is_secure", "database_name", "account")}
    return summarize(rows, ["share_name", "kind"], last_seen=F.max("ts"), **first)


def _inbound(share_log: DataFrame, variables) -> DataFrame:
    return chosen(share_log, **variables).filter(c("context") == "inbound_shares")


def unavailable_shares(share_log: DataFrame, **variables) -> DataFrame:
    rows = _inbound(share_log, variables).filter(c("share_status") == "UNAVAILABLE")
    return summarize(
        rows,
        ["share_name", "account"],
        error=take_first(c("error_message"), "ts", "event_id"),
        database_name=take_first(c("database_name"), "ts", "event_id"),
        last_seen=F.max("ts"),
    )


def share_availability(share_log: DataFrame, **variables) -> DataFrame:
    by = {"share_name": c("share_name"), "share_status": F.coalesce("share_status", F.lit("AVAILABLE"))}
    return summarize(_inbound(share_log, variables), by, n=F.count_distinct("table_name"))


def shared_tables(share_log: DataFrame, **variables) -> DataFrame:
    rows = _inbound(share_log, variables).filter(c("row_count").isNotNull())
    return summarize(rows, ["share_name", "table_name"], row_count=F.max("row_count"), size_bytes=F.max("bytes"))


def vanished_shares(share_log: DataFrame, now: dt.datetime, hours: float = 2, **variables) -> DataFrame:
    """Incoming shares without a record in the last hours."""
    recent = c("ts") >= F.lit(now - dt.timedelta(hours=hours))
    seen = summarize(
        _inbound(share_log, variables), ["account", "share_name", "database_name"], first_seen=F.min("ts"), last_seen=F.max("ts"), recent=F.count_if(recent)
    )
    return seen.filter(c("recent") == 0).drop("recent")


def secure_compliance(share_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(share_log, **variables).filter(c("kind") == "OUTBOUND")
    counted = summarize(rows, ["is_secure"], n=F.count_distinct("share_name"))
    text = F.when(c("is_secure") == "true", "Compliant (Secure Only)").otherwise("Non-Compliant (Insecure Objects)")
    return counted.select(text.alias("compliance"), "n")


def share_grants(share_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(share_log, **variables).filter((c("context") == "outbound_shares") & c("privilege").isNotNull())
    first = {n: take_first(c(n), "ts", "event_id") for n in ("granted_on", "granted_by", "database_name")}
    return summarize(rows, ["share_name", "grantee", "privilege", "grant_name"], **first)


def top_grantees(share_log: DataFrame, k: int = 20, **variables) -> DataFrame:
    rows = chosen(share_log, **variables).filter((c("kind") == "OUTBOUND") & c("grantee").isNotNull())
    return top_k_groups(summarize(rows, ["grantee"], grants=F.count("*")), "grants", k, "grantee")


# --- pipes ---------------------------------------------------------------------------------

# Codes of pipe and scheduling states.
PIPE_CODES = {"RUNNING": 1, "PAUSED": 2}
SCHEDULING_CODES = {"ACTIVE": 1, "SUSPENDED": 2}


def pipe_health(pipe_log: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    """Share of RUNNING records per bin in percent; null where there are none."""
    rows = chosen(pipe_log, **variables).filter(c("pipe_status").isNotNull())
    series = make_timeseries(rows, "ts", step_s=step_s, total=F.count("*"), running=F.count_if(c("pipe_status") == "RUNNING"))
    return series.select("bin", series_divide(F.lit(100.0) * c("running"), c("total")).alias("health_pct"))


def measure_total(rows: DataFrame, measure: str, **variables) -> DataFrame:
    """Sum of a measure over the whole range (the sum of its binned sums)."""
    return chosen(rows, **variables).agg(F.sum(measure).alias("total"))


def latency_p95(copies: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    """95th percentile of the load latency per bin, exact and without holding a bin in one task."""
    rows = chosen(copies, **variables).filter(c("latency_ms").isNotNull()).withColumn("bin", bin_start(c("loaded_at"), step_s))
    return exact_percentile(rows, ["bin"], "latency_ms", 0.95, "p95_latency")


def copy_errors(copies: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    series = make_timeseries(chosen(copies, **variables), "loaded_at", step_s=step_s, copy_errors=F.sum("error_count"), pipe_errors=F.sum("pipe_errors"))
    return series.select("bin", (c("copy_errors") + c("pipe_errors")).alias("total_errors"))


def pipe_states(pipe_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(pipe_log, **variables).filter(c("pipe_status").isNotNull())
    latest = summarize(rows, ["pipe_name", "account"], status=take_last(c("pipe_status"), "ts", "event_id"))
    return latest.withColumn("state_code", code_of(c("status"), PIPE_CODES, 3))


def ingest_latency(copies: DataFrame, warning: float, critical: float, step_s: int = DAY, **variables) -> DataFrame:
    series = make_timeseries(chosen(copies, **variables), "loaded_at", ["pipe_name", "account"], step_s=step_s, latency=F.avg("latency_ms"))
    return series.withColumns({"threshold_warning": F.lit(float(warning)), "threshold_critical": F.lit(float(critical))})


def stage_backlog(pipe_log: DataFrame, warning: float, critical: float, step_s: int = DAY, **variables) -> DataFrame:
    series = make_timeseries(chosen(pipe_log, **variables), "ts", ["pipe_name", "account"], step_s=step_s, pending=F.sum("pending_files"))
    return series.withColumns({"threshold_warning": F.lit(float(warning)), "threshold_critical": F.lit(float(critical))})


def ingested_per_hour(copies: DataFrame, **variables) -> DataFrame:
    return bin_summarize(chosen(copies, **variables), "loaded_at", ["database_name", "pipe_name"], HOUR, data=F.sum("file_size"))


def errors_by_table(copies: DataFrame, **variables) -> DataFrame:
    return summarize(chosen(copies, **variables), ["table_name"], total_errors=F.sum("pipe_errors") + F.sum("error_count"))


def top_error_pipes(copies: DataFrame, k: int = 50, **variables) -> DataFrame:
    keys = ["pipe_name", "table_name", "database_name"]
    errors = summarize(chosen(copies, **variables), keys, total_errors=F.sum("pipe_errors") + F.sum("error_count"))
    return top_k_groups(errors, "total_errors", k, *keys)


def credits_over_time(usage: DataFrame, by: Sequence[str], time: str, measure: str, step_s: int = DAY, default=None, **variables) -> DataFrame:
    return make_timeseries(chosen(usage, **variables), time, by, step_s=step_s, default=default, credits=F.sum(measure))


# --- tasks ---------------------------------------------------------------------------------


def task_states(runs: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(runs, **variables).filter(c("state").isNotNull())
    return make_timeseries(rows, "ts", ["state", "account"], step_s=step_s, n=F.count("*"))


def task_failures(runs: DataFrame, k: int | None = None, **variables) -> DataFrame:
    failed = chosen(runs, **variables).filter(c("state") == "FAILED")
    return newest(failed, "ts", "event_id", k).select(
        "event_id", "ts", "account", "database_name", "schema_name", "task_name", "attempt", "error_code"
    )


def task_duration(runs: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(runs, **variables).filter(c("completed_time").isNotNull() & c("scheduled_time").isNotNull())
    seconds = (F.unix_micros("completed_time") - F.unix_micros("scheduled_time")) / 1_000_000
    return make_timeseries(rows.withColumn("_s", seconds), "ts", ["task_name", "account"], step_s=step_s, avg_duration=F.avg("_s"))


def task_retries(runs: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(runs, **variables).filter(c("attempt") > 1)
    return make_timeseries(rows, "ts", ["task_name", "account"], step_s=step_s, retries=F.count("*"))


def serverless_total(usage: DataFrame, **variables) -> DataFrame:
    return chosen(usage, **variables).agg(F.coalesce(F.sum("credits_used"), F.lit(0)).alias("total_credits"))


def serverless_by_task(usage: DataFrame, **variables) -> DataFrame:
    keys = ["task_name", "account", "database_name", "schema_name"]
    return summarize(chosen(usage, **variables), keys, credits=F.sum("credits_used")).orderBy(c("credits").desc(), *keys)


# --- dynamic tables ------------------------------------------------------------------------


def scheduling_states(tables: DataFrame, **variables) -> DataFrame:
    rows = filter_out(chosen(tables, **variables), c("scheduling_state") == "").filter(c("scheduling_state").isNotNull())
    latest = summarize(rows, ["table_name", "account"], state=take_last(c("scheduling_state"), "ts", "row_no"))
    return latest.withColumn("state_code", code_of(c("state"), SCHEDULING_CODES, 3))


def lag_over_time(tables: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(tables, **variables).filter(c("mean_lag").isNotNull())
    return make_timeseries(rows, "ts", ["table_name", "account"], step_s=step_s, mean_lag=F.avg("mean_lag"), max_lag=F.max("max_lag"))


def time_above_target(tables: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(tables, **variables).filter(c("time_above").isNotNull())
    return make_timeseries(rows, "ts", ["table_name", "account"], step_s=step_s, above=F.max("time_above"))


def within_target(tables: DataFrame, **variables) -> DataFrame:
    rows = chosen(tables, **variables).filter(c("within_points").isNotNull())
    return summarize(rows, ["full_name", "account"], ratio=F.avg(c("within_points") / 100)).orderBy("ratio", "full_name", "account")


def refresh_history(refreshes: DataFrame, k: int | None = None, **variables) -> DataFrame:
    rows = chosen(refreshes, **variables).filter(c("state").isNotNull())
    return newest(rows, "data_timestamp", "row_no", k).select(
        "row_no", "data_timestamp", "account", "full_name", "state", "refresh_action", "refresh_trigger", "state_code"
    )


def refresh_actions(refreshes: DataFrame, **variables) -> DataFrame:
    rows = chosen(refreshes, **variables).filter(c("refresh_action").isNotNull())
    return summarize(rows, ["refresh_action"], n=F.count("*")).orderBy(c("n").desc(), "refresh_action")
