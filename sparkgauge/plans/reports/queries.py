"""Query deep dive, performance and quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.functions.text import coerce_array, normalize_tag
from sparkgauge.operators.aggregates import summarize, take_first
from sparkgauge.operators.expand import any_element, collect_field
from sparkgauge.operators.joins import pipe_join
from sparkgauge.operators.series import DAY, bin_summarize, fill_bins, make_timeseries, series_lookup
from sparkgauge.operators.windows import newest, top_k_groups, top_k_series
from sparkgauge.plans.reports.costs import chosen
from sparkgauge.session import cut_lineage

c = F.col


# --- deep dive -----------------------------------------------------------------------------


def top_by_scan(queries: DataFrame, k: int = 20, **variables) -> DataFrame:
    keys = ["query_hash", "database_name", "warehouse_name", "query_type"]
    rows = chosen(queries, **variables).filter(c("query_hash").isNotNull())
    out = summarize(
        rows, keys, total_scanned=F.sum("bytes_scanned"), executions=F.count("*"), mean_elapsed=F.avg("total_elapsed_time"),
        query_text=take_first(c("query_text"), "start_time", "query_id"),
    )
    return top_k_groups(out, "total_scanned", k, *keys)


def top_by_spill(queries: DataFrame, k: int = 20, **variables) -> DataFrame:
    keys = ["query_hash", "database_name", "warehouse_name"]
    rows = chosen(queries, **variables).filter(c("query_hash").isNotNull())
    out = summarize(
        rows, keys, total_spill=F.sum(c("bytes_spilled_local") + c("bytes_spilled_remote")), local_spill=F.sum("bytes_spilled_local"),
        remote_spill=F.sum("bytes_spilled_remote"), executions=F.count("*"), query_text=take_first(c("query_text"), "start_time", "query_id"),
    )
    return top_k_groups(out, "total_spill", k, *keys)


def over_time(
    queries: DataFrame, by: Sequence[str], where: Column | None = None, *, weight: Column | None = None, k: int | None = None, step_s: int = DAY, time: str = "start_time", aggregates: dict[str, Column], **variables
) -> DataFrame:
    """Series of aggregates per key; only the k series of the largest total weight when asked.

    The k best series are found on the binned rows and only those are filled with empty bins.
    """
    rows = chosen(queries, **variables)
    rows = rows if where is None else rows.filter(where)
    if k is None:
        return make_timeseries(rows, time, by, step_s=step_s, **aggregates)
    points = cut_lineage(bin_summarize(rows, time, by, step_s, **aggregates))
    span = points.agg(F.min("bin"), F.max("bin")).first()
    return fill_bins(top_k_series(points, by, weight, k), by, list(aggregates), step_s, span[0], span[1])


def scanned_by_database(queries: DataFrame, **options) -> DataFrame:
    return over_time(queries, ["database_name"], c("bytes_scanned").isNotNull(), aggregates={"scanned": F.sum("bytes_scanned")}, **options)


def scan_ratio_by_table(queries: DataFrame, k: int = 20, **options) -> DataFrame:
    ratio = c("partitions_scanned") / c("partitions_total")
    return over_time(
        queries, ["table_name"], c("table_name").isNotNull() & (c("partitions_total") > 0), weight=c("avg_ratio"), k=k,
        aggregates={"avg_ratio": F.avg(F.when(c("partitions_total") > 0, ratio))}, **options,
    )


def spill_by_table(queries: DataFrame, k: int = 20, **options) -> DataFrame:
    weight = c("local_spill") + 100 * c("remote_spill")
    return over_time(
        queries, ["table_name"], c("table_name").isNotNull(), weight=weight, k=k,
        aggregates={"local_spill": F.sum("bytes_spilled_local"), "remote_spill": F.sum("bytes_spilled_remote")}, **options,
    )


def cache_hits_by_table(queries: DataFrame, k: int = 20, **options) -> DataFrame:
    return over_time(
        queries, ["table_name"], c("table_name").isNotNull() & c("cache_pct").isNotNull(), weight=c("cache_pct"), k=k, aggregates={"cache_pct": F.avg("cache_pct")}, **options
    )


def acceleration_by_warehouse(queries: DataFrame, k: int = 20, **options) -> DataFrame:
    return over_time(
        queries, ["warehouse_name"], c("acceleration_bytes") > 0, weight=c("accel_bytes"), k=k, aggregates={"accel_bytes": F.sum("acceleration_bytes")}, **options
    )


def external_calls_by_warehouse(queries: DataFrame, k: int = 20, **options) -> DataFrame:
    return over_time(
        queries, ["warehouse_name"], c("external_calls") > 0, weight=c("invocations"), k=k, aggregates={"invocations": F.sum("external_calls")}, **options
    )


def acceleration_eligible(queries: DataFrame, estimates: DataFrame, k: int = 20, **variables) -> DataFrame:
    """Slowest statements whose estimate says they are eligible; ``estimates`` (query_id, status, scale_factor)."""
    eligible = estimates.filter(c("status") == "eligible")
    joined = pipe_join(chosen(queries, **variables), eligible, {"query_id": "query_id"}, ["status", "scale_factor"])
    return top_k_groups(joined, "total_elapsed_time", k, "query_id").select(
        "query_id", "user_name", "warehouse_name", "database_name", "query_type", "status", "scale_factor", "total_elapsed_time"
    )


def external_volumes(queries: DataFrame, k: int = 20, **variables) -> DataFrame:
    keys = ["warehouse_name", "database_name"]
    rows = chosen(queries, **variables).filter(c("external_calls") > 0)
    out = summarize(rows, keys, bytes_sent=F.sum("outbound_bytes"), bytes_received=F.sum("inbound_bytes"), invocations=F.sum("external_calls"))
    return top_k_groups(out, "invocations", k, *keys)


def roots_with_children(spans: DataFrame, k: int = 20) -> DataFrame:
    """Statements with the number of their direct children, slowest first."""
    children = summarize(spans.filter(c("parent_id").isNotNull()), ["parent_id"], children=F.count("*"))
    joined = pipe_join(spans.filter(c("trace_id").isNotNull()), children, {"span_id": "parent_id"}, ["children"])
    return top_k_groups(joined, "elapsed", k, "span_id")


def operator_stats(spans: DataFrame, k: int = 20) -> DataFrame:
    """Slowest statements with plan operators and no exception among them; ``spans`` holds an array ``events``."""
    clean = spans.filter((F.size("events") > 0) & ~any_element(c("events"), lambda e: e["exception_type"].isNotNull()))
    return top_k_groups(clean, "elapsed", k, "query_id")


def span_exceptions(spans: DataFrame) -> DataFrame:
    hit = spans.filter(any_element(c("events"), lambda e: e["exception_type"].isNotNull()))
    return hit.withColumn("exception_types", collect_field(c("events"), "exception_type"))


def count_by(queries: DataFrame, key: str, **variables) -> DataFrame:
    """Statements by a column, most first (client application, authentication type)."""
    rows = chosen(queries, **variables).filter(c(key).isNotNull())
    return summarize(rows, [key], n=F.count("*")).orderBy(c("n").desc(), key)


def cloud_credits(queries: DataFrame, by: Sequence[str], k: int | None = None, **variables) -> DataFrame:
    rows = chosen(queries, **variables).filter(c("cloud_credits").isNotNull())
    out = summarize(rows, by, credits=F.sum("cloud_credits"))
    return top_k_groups(out, "credits", k, *by) if k else out.orderBy(c("credits").desc(), *by)


def transfer(queries: DataFrame, measure: str, **variables) -> DataFrame:
    rows = chosen(queries, **variables).filter(c(measure) > 0)
    return summarize(rows, ["transfer_region", "transfer_cloud"], total_bytes=F.sum(measure)).orderBy(c("total_bytes").desc())


# --- performance ---------------------------------------------------------------------------


def tables_of(queries: DataFrame) -> DataFrame:
    """One row per table of a statement: the list of tables, or the single table name."""
    listed = F.coalesce(coerce_array(c("tables")), F.array("table_name"))
    return queries.withColumn("table_name", F.explode(listed))


def top_by_time(queries: DataFrame, key: str, k: int = 20, **variables) -> DataFrame:
    """Largest total execution time by a key; the ranking is taken on the sums."""
    rows = chosen(queries, **variables).filter(c(key).isNotNull() & c("execution_time").isNotNull())
    return top_k_groups(summarize(rows, [key], total_ms=F.sum("execution_time")), "total_ms", k, key)


def time_by(queries: DataFrame, by: Sequence[str], step_s: int = DAY, **variables) -> DataFrame:
    rows = chosen(queries, **variables)
    for key in by:
        rows = rows.filter(c(key).isNotNull())
    return make_timeseries(rows, "start_time", by, step_s=step_s, total_ms=F.sum("execution_time"))


def time_per_row(queries: DataFrame, points: DataFrame, **variables) -> DataFrame:
    """Daily mean execution time divided by the rows of the table, for tables never empty.

    ``points`` holds (table_name, ts, row_count).
    """
    series = bin_summarize(tables_of(chosen(queries, **variables)), "start_time", ["table_name"], DAY, mean_ms=F.avg("execution_time"))
    rows = bin_summarize(points, "ts", ["table_name"], DAY, top_rows=F.max("row_count"))
    return series_lookup(series, rows, "table_name", "mean_ms", "top_rows", "ms_per_row")


# Phases of a statement and the columns that hold their time.
PHASES = {
    "compilation": "compilation_time",
    "execution": "execution_time",
    "queued_overload": "queued_overload_time",
    "queued_provisioning": "queued_provisioning_time",
}


def phases_over_time(queries: DataFrame, step_s: int = DAY, **variables) -> DataFrame:
    return make_timeseries(chosen(queries, **variables), "start_time", step_s=step_s, **{n: F.avg(m) for n, m in PHASES.items()})


def phases_by_warehouse(queries: DataFrame, k: int = 20, **variables) -> DataFrame:
    rows = chosen(queries, **variables).filter(c("warehouse_name").isNotNull())
    out = summarize(rows, ["warehouse_name"], **{n: F.sum(m) for n, m in PHASES.items()})
    return top_k_groups(out, "execution", k, "warehouse_name")


def _tagged(queries: DataFrame, pattern: str, variables) -> DataFrame:
    rows = chosen(queries, **variables).filter(c("query_tag").isNotNull() & (c("query_tag") != ""))
    return rows.withColumn("query_tag", normalize_tag(c("query_tag"), pattern))


def time_by_tag(queries: DataFrame, pattern: str, k: int = 20, step_s: int = DAY, **variables) -> DataFrame:
    return over_time(
        _tagged(queries, pattern, variables), ["query_tag"], weight=c("mean_ms"), k=k, step_s=step_s, aggregates={"mean_ms": F.avg("execution_time")}
    )


def top_tags(queries: DataFrame, pattern: str, k: int = 20, **variables) -> DataFrame:
    out = summarize(_tagged(queries, pattern, variables), ["query_tag"], total=F.sum("total_elapsed_time"))
    return top_k_groups(out, "total", k, "query_tag")


def active_summary(active: DataFrame, **variables) -> DataFrame:
    rows = chosen(active, **variables).filter(c("warehouse_name").isNotNull())
    t = "total_elapsed_time"
    out = summarize(rows, ["warehouse_name", "account"], n=F.count("*"), fastest=F.min(t), slowest=F.max(t), mean=F.avg(t))
    return out.orderBy(c("n").desc(), "warehouse_name", "account")


def active_long_running(active: DataFrame, slow_minutes: int, k: int = 20, **variables) -> DataFrame:
    rows = chosen(active, **variables).filter(c("total_elapsed_time") > 60_000 * slow_minutes)
    top = top_k_groups(rows, "total_elapsed_time", k, "query_id", "run_no")
    started = F.unix_millis("seen_at") - c("total_elapsed_time")
    return top.select(
        "query_id", "run_no", started.alias("started_ms"), c("total_elapsed_time").alias("duration_ms"), "user_name", "warehouse_name",
        "execution_status", c("query_text").alias("query"), "account",
    )


# --- quality -------------------------------------------------------------------------------


def cartesian(spans: DataFrame) -> DataFrame:
    """Statements with a Join operator that puts out more rows than it takes in."""
    return spans.filter(any_element(c("events"), lambda e: (e["operator_type"] == "Join") & (e["input_rows"] < e["output_rows"])))


def cartesian_over_time(spans: DataFrame, by: Column, step_s: int = DAY) -> DataFrame:
    return make_timeseries(cartesian(spans).withColumn("key", by), "start_time", ["key"], step_s=step_s, n=F.count("*"))


def cartesian_by(spans: DataFrame, by: Column, k: int | None = None) -> DataFrame:
    out = summarize(cartesian(spans), {"key": by}, n=F.count("*"))
    return top_k_groups(out, "n", k, "key") if k else out


def cartesian_log(spans: DataFrame, k: int | None = None) -> DataFrame:
    return newest(cartesian(spans), "start_time", "query_id", k)
