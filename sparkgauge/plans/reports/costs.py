"""Budgets and cost reports.

Inputs are flat telemetry frames; variables of a report are parameters. Every report is
one job: filters first, partial aggregation before any shuffle, ordering only of groups.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.sections import code_of
from sparkgauge.operators.aggregates import ratio, summarize, take_last
from sparkgauge.operators.detect import forecast_quota
from sparkgauge.operators.expand import zip_in_order
from sparkgauge.operators.joins import inline_lookup, not_finished, pipe_join, pipe_join_nested
from sparkgauge.operators.predicates import filter_out, optional_selector, prefix_any
from sparkgauge.operators.series import DAY, collapse_series, make_timeseries
from sparkgauge.operators.windows import top_k_groups

c = F.col

# Credits per hour by warehouse size.
SIZE_COST = {"X-Small": 1, "Small": 2, "Medium": 4, "Large": 8, "X-Large": 16, "XX-Large": 32, "XXX-Large": 64}


def chosen(
    rows: DataFrame,
    *,
    accounts: str | Sequence[str] = "*",
    prefix: Sequence[str] = (),
    prefix_of: str | None = None,
    **variables: str | Sequence[str],
) -> DataFrame:
    """Apply report variables: accounts, name prefixes, and any ``column = selection`` (null passes)."""
    rows = rows.filter(optional_selector(c("account"), accounts, null_passes=accounts == "*"))
    if prefix and prefix_of:
        rows = rows.filter(prefix_any(c(prefix_of), prefix))
    for column, selection in variables.items():
        rows = rows.filter(optional_selector(c(column), selection))
    return rows


# --- budgets -------------------------------------------------------------------------------


def budget_vs_limit(spend: DataFrame, limits: DataFrame, **variables) -> DataFrame:
    """Spent, limit and share used per budget and account.

    ``spend`` (budget_name, account, credits_spent), ``limits`` (budget_name, account, credit_limit).
    """
    spent = summarize(chosen(spend, **variables), ["budget_name", "account"], spent=F.sum("credits_spent"))
    top = summarize(limits, ["budget_name", "account"], credit_limit=F.max("credit_limit"))
    joined = pipe_join(spent, top, {"budget_name": "budget_name", "account": "account"}, ["credit_limit"])
    used = F.lit(100.0) * ratio(c("spent").cast("double"), c("credit_limit"))
    return joined.withColumn("used_pct", used)


def spend_trend(spend: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(chosen(spend, **variables), "ts", ["budget_name", "account"], step_s=step_s, spent=F.avg("credits_spent"))


def spend_by_service(spend: DataFrame, **variables) -> DataFrame:
    rows = chosen(spend, **variables).filter(c("service_type").isNotNull())
    return summarize(rows, ["service_type"], spent=F.sum("credits_spent")).orderBy(c("spent").desc(), "service_type")


def budget_details(budget_log: DataFrame, **variables) -> DataFrame:
    """Highest limit, latest owner and resources per budget and account."""
    return summarize(
        chosen(budget_log, **variables),
        ["budget_name", "account"],
        credit_limit=F.max("credit_limit"),
        owner=take_last(c("owner"), "ts", "log_id"),
        resource=take_last(c("resource"), "ts", "log_id"),
    )


def warehouse_sizing(warehouse_log: DataFrame, **variables) -> DataFrame:
    """Latest settings per warehouse and account."""
    shown = ("size", "scaling_policy", "min_clusters", "max_clusters", "state", "auto_resume", "resource_monitor")
    latest = {n: take_last(c(n), "ts", "event_id") for n in shown}
    return summarize(chosen(warehouse_log, **variables), ["warehouse_name", "account"], **latest)


def cluster_use(warehouse_log: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(
        chosen(warehouse_log, **variables), "ts", ["warehouse_name", "account"], step_s=step_s,
        started=F.avg("started_clusters"), max_clusters=F.avg("max_clusters"),
    )


def quota_use(monitor_log: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(
        chosen(monitor_log, **variables), "ts", ["monitor_name", "account"], step_s=step_s,
        quota_used=F.avg("quota_used"), quota_total=F.avg("quota"),
    )


def running_vs_queued(load: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(
        chosen(load, **variables), "start_time", ["warehouse_name", "account"], step_s=step_s,
        running=F.avg("avg_running"), queued=F.avg("avg_queued"),
    )


def blocked_over_time(load: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(chosen(load, **variables), "start_time", ["warehouse_name", "account"], step_s=step_s, blocked=F.avg("avg_blocked"))


def average_running(load: DataFrame, **variables) -> DataFrame:
    rows = chosen(load, **variables).filter(c("avg_running").isNotNull())
    return summarize(rows, ["warehouse_name"], avg_running=F.avg("avg_running")).orderBy(c("avg_running").desc(), "warehouse_name")


# --- monitors ------------------------------------------------------------------------------


def owner() -> Column:
    return F.coalesce("account", "service_name")


def monitor_credits(monitor_log: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    """Used credits, quota and share used per monitor and owner: series by account and service, then collapsed."""
    rows = chosen(monitor_log, prefix_of="monitor_name", **variables)
    series = make_timeseries(
        rows, "ts", ["monitor_name", "account", "service_name"], step_s=step_s,
        used=F.max("quota_used"), quota=F.max("quota"), used_pct=F.max(F.lit(100.0) * c("quota_used") / c("quota")),
    )
    by = {"monitor_name": c("monitor_name"), "owner": owner()}
    return collapse_series(series, by, used=F.max("used"), quota=F.max("quota"), used_pct=F.max("used_pct"))


def monitor_daily_trend(monitor_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(monitor_log, prefix_of="monitor_name", **variables)
    return make_timeseries(
        rows, "ts", ["monitor_name", "account"], step_s=DAY, credits_used=F.max("quota_used"), credits_quota=F.max("quota")
    )


def unmonitored(warehouse_log: DataFrame, **variables) -> DataFrame:
    """Warehouses and accounts whose latest record is not INFO, with an explanation."""
    latest = summarize(
        chosen(warehouse_log, **variables), ["account", "warehouse_name"], last_seen=F.max("ts"), loglevel=take_last(c("loglevel"), "ts", "event_id")
    )
    loud = filter_out(latest, c("loglevel") == "INFO")
    text = F.when(
        c("loglevel") == "WARN", F.concat(F.lit("Warehouse "), c("warehouse_name"), F.lit(" does not have Resource Monitor assigned"))
    ).otherwise(F.concat(F.lit("Account "), c("account"), F.lit(" does not have global resource monitor defined")))
    return loud.withColumn("explanation", text)


def monitored_warehouses(monitor_log: DataFrame) -> DataFrame:
    """Distinct (account, warehouse, monitor) of the records that carry a warehouse event."""
    rows = monitor_log.filter(c("warehouse_event").isNotNull() & c("monitor_name").isNotNull() & c("warehouse_name").isNotNull())
    return rows.select("account", "warehouse_name", "monitor_name").distinct()


def with_monitor(rows: DataFrame, monitor_log: DataFrame) -> DataFrame:
    """Attach the monitors of the row's warehouse in its account; rows without one stay."""
    on = {"account": "account", "warehouse_name": "warehouse_name"}
    return pipe_join_nested(rows, monitored_warehouses(monitor_log), on, ["monitor_name"])


def warehouse_time(
    queries: DataFrame, monitor_log: DataFrame, measure: str, step_s: int = DAY, monitors: str | Sequence[str] = "*", **variables
) -> DataFrame:
    """Total of a time measure per warehouse and account, for warehouses of the chosen monitors.

    Rows are reduced to one per (key, bin) before the monitors are attached.
    """
    rows = chosen(queries, prefix_of="warehouse_name", **variables)
    series = make_timeseries(rows, "start_time", ["warehouse_name", "account"], step_s=step_s, total=F.sum(measure))
    seen = with_monitor(series, monitor_log).filter(optional_selector(c("monitor_name"), monitors))
    return collapse_series(seen, {"warehouse_name": c("warehouse_name"), "account": c("account")}, total=F.sum("total"))


def account_time(queries: DataFrame, measure: str, step_s: int = DAY, **variables) -> DataFrame:
    """Total of a time measure per account."""
    rows = chosen(queries, prefix_of="warehouse_name", **variables)
    return make_timeseries(rows, "start_time", ["account"], step_s=step_s, total=F.sum(measure))


def _slow(queries: DataFrame, slow_minutes: float, measure: str) -> DataFrame:
    minutes = F.floor(c(measure) / 60_000)
    return queries.filter(minutes > slow_minutes)


def slow_queries_by_user(queries: DataFrame, monitor_log: DataFrame, slow_minutes: float, step_s: int = DAY, monitors: str | Sequence[str] = "*", **variables) -> DataFrame:
    rows = _slow(chosen(queries, prefix_of="warehouse_name", **variables), slow_minutes, "total_elapsed_time")
    seen = with_monitor(rows, monitor_log).filter(optional_selector(c("monitor_name"), monitors))
    return make_timeseries(seen, "start_time", ["user_name"], step_s=step_s, n=F.count("*"))


def slowest_queries(queries: DataFrame, monitor_log: DataFrame, slow_minutes: float, k: int = 100, monitors: str | Sequence[str] = "*", **variables) -> DataFrame:
    """The k slowest statements with their monitor; ties go by id and monitor."""
    rows = _slow(chosen(queries, prefix_of="warehouse_name", **variables), slow_minutes, "total_elapsed_time")
    seen = with_monitor(rows, monitor_log).filter(optional_selector(c("monitor_name"), monitors))
    top = top_k_groups(seen, "total_elapsed_time", k, "query_id", "monitor_name")
    return top.select(
        "query_id", "user_name", "account", "warehouse_name", F.coalesce("monitor_name", F.lit("-")).alias("monitor_name"),
        c("total_elapsed_time").alias("duration_ms"), c("query_text").alias("query_sql"),
    )


def latest_sighting(active: DataFrame) -> DataFrame:
    """Latest record of each open statement."""
    keep = [x for x in active.columns if x != "query_id"]
    last = active.groupBy("query_id").agg(F.max(F.struct("seen_at", "run_no", *[k for k in keep if k not in ("seen_at", "run_no")])).alias("_r"))
    return last.select("query_id", *[c(f"_r.{k}").alias(k) for k in keep])


def long_running(active: DataFrame, finished: DataFrame, slow_minutes: float, **variables) -> DataFrame:
    """Open statements over the threshold without a finished record, at their latest sighting."""
    slow = _slow(chosen(active, prefix_of="warehouse_name", **variables), slow_minutes, "running_time")
    return not_finished(latest_sighting(slow), finished, "query_id").select(
        "query_id", "user_name", "account", "warehouse_name", "seen_at", c("running_time").alias("duration_ms"), "query_text"
    )


def exhausting_queries(
    active: DataFrame,
    finished: DataFrame,
    monitor_log: DataFrame,
    *,
    slow_minutes: float = 5,
    long_ms: int = 30 * 60 * 1000,
    global_monitor: str = "ACCOUNT_GLOBAL_MONITOR",
    cost: Mapping[str, int] = SIZE_COST,
    **variables,
) -> DataFrame:
    """Running statements whose remaining expected cost exceeds the credits left on their monitor.

    Cost per hour comes from the warehouse size; the estimate takes the longest earlier run of
    the same statement.
    """
    open_rows = not_finished(latest_sighting(_slow(active, slow_minutes, "running_time")), finished, "query_id")
    left = summarize(
        monitor_log.filter((c("monitor_name") != global_monitor) & c("warehouse_name").isNotNull()),
        ["account", "warehouse_name", "monitor_name"],
        remaining=take_last(c("quota_remaining"), "ts", "event_id"),
    )
    on = {"account": "account", "warehouse_name": "warehouse_name"}
    with_quota = chosen(pipe_join(open_rows, left, on, ["monitor_name", "remaining"]), prefix_of="warehouse_name", **variables)
    earlier = summarize(finished.filter(c("total_elapsed_time") > long_ms), ["query_hash"], elapsed_s=F.floor(F.max("total_elapsed_time") / 1000))
    priced = inline_lookup(pipe_join(with_quota, earlier, {"query_hash": "query_hash"}, ["elapsed_s"], "leftOuter"), cost, "warehouse_size", "size_cost")
    current = c("size_cost") * c("running_time") / 3_600_000
    estimated = c("size_cost") * c("elapsed_s") / 3_600
    out = priced.withColumns({"current_cost": current, "estimated_cost": estimated, "expected_cost": estimated - current})
    return out.filter(c("expected_cost") > c("remaining"))


def warehouse_event_delay(events: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    """Delay from a resume or suspend to the state reached, per action, warehouse and account over time."""
    rows = chosen(events, prefix_of="warehouse_name", **variables).filter(F.contains(c("event_name"), F.lit("WAREHOUSE")))
    action = F.when(c("event_name") == "RESUME_WAREHOUSE", "RESUME").when(c("event_name") == "SUSPEND_WAREHOUSE", "SUSPEND")
    done = c("event_name") == "WAREHOUSE_CONSISTENT"
    paired = zip_in_order(
        rows.withColumn("action", action), ["account", "warehouse_name"], F.when(~done, c("ts")), F.when(done, c("ts")), ["ts", "event_id"], F.date_trunc("day", "ts")
    )
    delay = F.unix_micros("finish_at") - F.unix_micros("start_at")
    return make_timeseries(paired.withColumn("_delay", delay), "start_at", ["action", "warehouse_name", "account"], step_s=step_s, delay_us=F.sum("_delay"))


def near_exhaustion(monitor_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(monitor_log, prefix_of="monitor_name", **variables)
    return summarize(
        rows, ["monitor_name", "frequency", "account"], used_pct=F.max(F.lit(100.0) * c("quota_used") / c("quota")), remaining=F.min("quota_remaining"), quota=F.max("quota")
    ).orderBy(c("used_pct").desc(), "monitor_name", "frequency", "account")


def monitor_states(monitor_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(monitor_log, prefix_of="monitor_name", **variables).filter(c("is_active").isNotNull())
    counted = summarize(rows, ["monitor_name", "is_active", "account"], n=F.count("*"))
    return counted.withColumn("state_code", code_of(c("is_active"), {"true": 1}, 0))


def monitor_frequencies(monitor_log: DataFrame, **variables) -> DataFrame:
    rows = chosen(monitor_log, prefix_of="monitor_name", **variables).filter(c("frequency").isNotNull())
    return summarize(
        rows, ["monitor_name", "frequency", "is_active", "account"], quota=F.max("quota"), used=F.max("quota_used"), remaining=F.min("quota_remaining")
    )


def quota_forecast(monitor_log: DataFrame, now: dt.datetime, horizon: int = 14, **variables) -> DataFrame:
    """Forecast of the daily share used, per monitor and owner."""
    rows = chosen(monitor_log, prefix_of="monitor_name", **variables).withColumn("owner", owner())
    series = make_timeseries(rows, "ts", ["monitor_name", "owner"], step_s=DAY, used_pct=F.max(F.lit(100.0) * c("quota_used") / c("quota")))
    return forecast_quota(series, ["monitor_name", "owner"], "used_pct", now=now, horizon=horizon, history_days=15)
