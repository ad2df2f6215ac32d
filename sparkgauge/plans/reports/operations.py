"""Security and self-monitoring reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.text import hash_user, mask_ip, of_user_kinds, parse_call_arguments
from sparkgauge.operators.aggregates import summarize
from sparkgauge.operators.predicates import filter_out
from sparkgauge.operators.series import DAY, make_timeseries
from sparkgauge.operators.sets import append
from sparkgauge.operators.windows import newest, top_k_groups
from sparkgauge.plans.reports.costs import chosen

c = F.col

# Kinds of users, and roles with administrative rights.
USER_KINDS = ("Human user", "Service user")
ADMIN_ROLES = ("ACCOUNTADMIN", "SECURITYADMIN", "SYSADMIN", "USERADMIN")


# --- logins --------------------------------------------------------------------------------


def failed_logins(logins: DataFrame, kinds: Sequence[str] = USER_KINDS, **variables) -> DataFrame:
    return chosen(logins, **variables).filter(c("error_code").isNotNull() & of_user_kinds(c("user_name"), kinds))


def login_problem_users(logins: DataFrame, k: int = 10, **options) -> DataFrame:
    out = summarize(failed_logins(logins, **options), ["user_name"], n=F.count("*")).withColumn("user_hash", hash_user(c("user_name")))
    return top_k_groups(out, "n", k, "user_hash").select("user_hash", "n")


def login_problem_addresses(logins: DataFrame, k: int = 10, **options) -> DataFrame:
    rows = filter_out(failed_logins(logins, **options), c("client_ip") == "0.0.0.0")
    return top_k_groups(summarize(rows, {"client_ip": mask_ip(c("client_ip"))}, n=F.count("*")), "n", k, "client_ip")


def login_problem_accounts(logins: DataFrame, k: int = 10, **options) -> DataFrame:
    return top_k_groups(summarize(failed_logins(logins, **options), ["account"], n=F.count("*")), "n", k, "account")


def login_problems_over_time(logins: DataFrame, bins: int = 20, **options) -> DataFrame:
    return make_timeseries(failed_logins(logins, **options), "ts", ["error_message", "account"], bins=bins, n=F.count("*"))


def login_problem_list(logins: DataFrame, **options) -> DataFrame:
    return failed_logins(logins, **options).select("event_id", "ts", "account", hash_user(c("user_name")).alias("user_hash"), "error_message")


def users_by_factor(logins: DataFrame, kinds: Sequence[str] = USER_KINDS, **variables) -> DataFrame:
    rows = chosen(logins, **variables).filter(of_user_kinds(c("user_name"), kinds) & c("first_factor").isNotNull())
    return summarize(rows, ["first_factor"], users=F.count_distinct("user_name"))


def _password_logins(logins: DataFrame, kinds: Sequence[str], variables) -> DataFrame:
    return chosen(logins, **variables).filter(of_user_kinds(c("user_name"), kinds) & (c("first_factor") == "PASSWORD"))


def password_users(logins: DataFrame, kinds: Sequence[str] = USER_KINDS, **variables) -> DataFrame:
    return _password_logins(logins, kinds, variables).agg(F.count_distinct("user_name").alias("users"))


def password_logins(logins: DataFrame, kinds: Sequence[str] = USER_KINDS, **variables) -> DataFrame:
    """Latest password login per account, user and factors."""
    by = {"account": c("account"), "user_name": c("user_name"), "first_factor": c("first_factor"), "second_factor": F.coalesce("second_factor", F.lit("-"))}
    latest = summarize(_password_logins(logins, kinds, variables), by, last_attempt=F.max("ts"))
    return latest.withColumn("user_hash", hash_user(c("user_name"))).drop("user_name")


# --- admin activity ------------------------------------------------------------------------


def admin_activity(
    queries: DataFrame, roles: Sequence[str] = ADMIN_ROLES, exclude_system: bool = True, excluded_users: Sequence[str] = (), **variables
) -> DataFrame:
    """Statements run with an administrative role, without system and listed users."""
    rows = chosen(queries, **variables).filter(c("role_name").isin(*roles))
    skip = F.lit(False)
    if exclude_system:
        skip = skip | (c("user_name") == "SYSTEM")
    if excluded_users:
        skip = skip | c("user_name").isin(*excluded_users)
    return filter_out(rows, skip)


def admin_over_time(queries: DataFrame, bins: int = 20, **options) -> DataFrame:
    return make_timeseries(admin_activity(queries, **options), "start_time", ["user_name", "role_name"], bins=bins, n=F.count("*"))


def admin_top(queries: DataFrame, key: str, k: int = 10, **options) -> DataFrame:
    """Most active users, roles or accounts."""
    return top_k_groups(summarize(admin_activity(queries, **options), [key], n=F.count("*")), "n", k, key)


def admin_latest(queries: DataFrame, k: int | None = None, **options) -> DataFrame:
    rows = admin_activity(queries, **options).filter(c("query_text").isNotNull())
    return newest(rows, "start_time", "query_id", k).select(
        "query_id", "user_name", "role_name", "account", "query_text", "start_time", "query_type", "execution_status"
    )


# --- findings ------------------------------------------------------------------------------


def latest_violations(logs: DataFrame, events: DataFrame, **variables) -> DataFrame:
    """Latest scan per problem over log and event records; fields one side lacks are null."""
    keys = ["message", "category", "severity", "scanner_type", "scanner_id", "account"]
    both = append(chosen(logs, **variables), chosen(events, **variables))
    latest = summarize(both, keys, last_scan=F.max("ts"))
    return latest.withColumn("scan_date", F.date_format("last_scan", "yyyy-MM-dd")).drop("last_scan")


def violating_scanners(logs: DataFrame, events: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    both = append(chosen(logs, **variables), chosen(events, **variables))
    return make_timeseries(both, "ts", ["severity", "account"], step_s=step_s, scanners=F.count_distinct("scanner_id"))


# --- users ---------------------------------------------------------------------------------


def revocations(grants: DataFrame) -> DataFrame:
    gone = grants.filter(c("deleted_on").isNotNull())
    return gone.select("user_name", "role", "deleted_on").orderBy(c("deleted_on").desc(), "user_name", "role")


def account_status(users: DataFrame, **variables) -> DataFrame:
    rows = chosen(users, **variables).filter(c("is_disabled").isNotNull())
    status = F.when(c("is_disabled").try_cast("boolean"), "Disabled").when(c("is_locked").try_cast("boolean"), "Locked").otherwise("Active")
    return summarize(rows, {"status": status}, n=F.count("*"))


def flag_share(users: DataFrame, flag: str, yes: str, no: str, **variables) -> DataFrame:
    """Users with and without a property (second factor, key pair)."""
    rows = chosen(users, **variables).filter(c(flag).isNotNull())
    return summarize(rows, {"status": F.when(c(flag), yes).otherwise(no)}, n=F.count("*"))


def password_only(users: DataFrame, **variables) -> DataFrame:
    rows = chosen(users, **variables).filter(c("has_password") & ~c("has_mfa") & ~c("has_rsa") & ~c("has_pat"))
    return rows.select(c("login_name").alias("user_name"), "user_type", "owner", "account").orderBy("user_name")


# --- self-monitoring -----------------------------------------------------------------------


def runs(status: DataFrame, **variables) -> DataFrame:
    """One row per run with its first and last status record."""
    rows = chosen(status, **variables)
    return summarize(rows, ["account", "exec_id", "plugin"], started=F.min("ts"), ended=F.max("ts"), records=F.count("*"))


def run_duration(status: DataFrame, step_s: int = DAY, skip: Sequence[str] = ("deployment",), **variables) -> DataFrame:
    """Total run time per collector over time, runs with more than one record only."""
    done = filter_out(runs(status, **variables).filter(c("records") > 1), c("plugin").isin(*skip))
    us = F.unix_micros("ended") - F.unix_micros("started")
    return make_timeseries(done.withColumn("_us", us), "started", ["plugin"], step_s=step_s, duration_us=F.sum("_us"))


def run_failures(status: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(status, **variables).filter(c("status") == "FAILED")
    return make_timeseries(rows, "ts", ["plugin", "status"], step_s=step_s, n=F.count("*"))


def run_counts(status: DataFrame, **variables) -> DataFrame:
    return summarize(runs(status, **variables).filter(c("records") > 1), ["plugin"], runs=F.count("*"))


def run_total_time(status: DataFrame, **variables) -> DataFrame:
    us = F.unix_micros("ended") - F.unix_micros("started")
    return summarize(runs(status, **variables), ["plugin"], total_us=F.sum(us))


def volume_by_kind(frames: dict[str, DataFrame], by: Sequence[str], step_s: int = DAY) -> DataFrame:
    """Records per kind and key over time; all kinds are counted in one pass and share one range."""
    both: DataFrame | None = None
    for kind, frame in frames.items():
        part = frame.select(F.lit(kind).alias("kind"), "ts", *by)
        both = part if both is None else both.unionByName(part)
    return make_timeseries(both, "ts", [*by, "kind"], step_s=step_s, n=F.count("*"))


def records_by(rows: DataFrame, by: Sequence[str], **variables) -> DataFrame:
    return summarize(chosen(rows, **variables), by, n=F.count("*"))


def last_runs(status: DataFrame, k: int | None = None, **variables) -> DataFrame:
    return newest(chosen(status, **variables), "ts", "event_id", k).select("event_id", "ts", "plugin", "account")


def failed_calls(queries: DataFrame, call: str, **variables) -> DataFrame:
    """Failed statements that call the collectors, one row per collector named in the call."""
    names: Column = parse_call_arguments(c("query_text"), call)
    rows = chosen(queries, **variables).filter(c("execution_status") != "SUCCESS")
    return rows.select("query_id", "start_time", "database_name", "execution_status", "error_code", F.explode(names).alias("plugin_name"))
