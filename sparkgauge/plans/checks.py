"""Data-quality checks: each returns its violations, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.operators.aggregates import summarize
from sparkgauge.operators.predicates import filter_out
from sparkgauge.operators.series import DAY, HOUR, make_timeseries

c = F.col


def kind_coverage(history: DataFrame, active: DataFrame, spans: DataFrame, key: str = "query_id") -> DataFrame:
    """Counts of an id in history logs, active logs and spans; missing where kinds disagree.

    ``spans`` holds ``n_events`` (stored) and ``events_added``. Ids never seen active and
    those whose flag is unknown are left out.
    """
    counts = (
        summarize(history, [key], history_n=F.count("*"))
        .unionByName(summarize(active, [key], active_n=F.count("*")), allowMissingColumns=True)
        .unionByName(
            summarize(spans, [key], span_n=F.count("*"), span_events=F.max("n_events"), events_added=F.max("events_added")), allowMissingColumns=True
        )
    )
    names = ("history_n", "active_n", "span_n", "span_events", "events_added")
    side = counts.groupBy(key).agg(*[F.max(n).alias(n) for n in names])
    h, s = c("history_n"), c("span_n")
    one_sided = s.isNull() != h.isNull()
    unequal = (h != s + c("span_events")) & (h != s + c("events_added"))
    flagged = filter_out(side, c("active_n").isNull()).withColumn("missing", one_sided | unequal)
    return flagged.filter(c("missing").isNotNull())


def log_span_match(logs: DataFrame, spans: DataFrame, key: str = "query_id") -> DataFrame:
    """Ids whose number of logs is not one plus the number of span events."""
    both = summarize(logs, [key], logs=F.count("*")).unionByName(
        summarize(spans, [key], expected=F.sum(F.coalesce("n_events", F.lit(0)) + 1)), allowMissingColumns=True
    )
    side = both.groupBy(key).agg(F.sum("logs").alias("logs"), F.sum("expected").alias("expected"))
    return side.filter((c("expected") == 0) | (c("expected") != c("logs")))


def span_event_completeness(spans: DataFrame) -> DataFrame:
    """Spans where stored and dropped events do not add up to those added."""
    return spans.filter(c("n_events") + F.coalesce("dropped_events", F.lit(0)) != c("events_added"))


def missing_parent_link(spans: DataFrame, row_id: str = "query_id", parent: str = "parent_query_id", run: str = "run_id") -> DataFrame:
    """Rows whose parent is in the same run although they carry no parent span id."""
    parents = spans.select(F.col(row_id).alias(parent), F.col(run).alias("_run")).distinct()
    orphans = spans.filter(c("parent_span_id").isNull() & c(parent).isNotNull())
    return orphans.join(parents, (orphans[parent] == parents[parent]) & (orphans[run] == parents["_run"]), "left_semi")


def clock_shift(status: DataFrame, logs: DataFrame, tolerance_s: int = 600, run: str = "run_id") -> DataFrame:
    """Start records further than the tolerance from the first log of their run."""
    first = summarize(logs.filter(c(run).isNotNull()), [run], first_log=F.min("ts"))
    started = status.filter(c("status") == "STARTED")
    joined = started.join(first, run)
    shift = F.abs(F.unix_micros("ts") - F.unix_micros("first_log"))
    return joined.withColumn("shift_us", shift).filter(c("shift_us") >= tolerance_s * 1_000_000)


def unpaired_runs(status: DataFrame) -> DataFrame:
    """Runs without exactly two status records, with counts and last time per status."""
    return summarize(
        status,
        ["account", "exec_id", "plugin"],
        records=F.count("*"),
        started=F.count_if(c("status") == "STARTED"),
        ended=F.count_if(c("status") != "STARTED"),
        last_seen=F.max("ts"),
    ).filter(c("records") != 2)


def status_counts(status: DataFrame) -> DataFrame:
    return summarize(status.filter(c("status").isin("STARTED", "FINISHED")), ["plugin", "status"], n=F.count("*"), last_seen=F.max("ts"))


def repeated_sightings(active: DataFrame, key: str = "query_id") -> DataFrame:
    """Ids seen more than once among active statements."""
    return summarize(active.filter(c(key).isNotNull()), [key], n=F.count("*"), first_seen=F.min("seen_at")).filter(c("n") > 1)


def sighting_extremes(active: DataFrame, step_s: int = HOUR, key: str = "query_id") -> DataFrame:
    """Most and fewest sightings of an id over time of first sight."""
    counted = summarize(active.filter(c(key).isNotNull()), [key], n=F.count("*"), first_seen=F.min("seen_at"))
    return make_timeseries(counted, "first_seen", step_s=step_s, most=F.max("n"), fewest=F.min("n"))


def statuses_over_time(active: DataFrame, step_s: int = DAY) -> DataFrame:
    return make_timeseries(active, "seen_at", ["execution_status"], step_s=step_s, n=F.count("*"))


def volume_over_kinds(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Element-wise sum of the series of all kinds of records."""
    return series.groupBy(*by, "bin").agg(F.sum("n").alias("n"))


def unexpected_values(rows: DataFrame, array: str, expected: Sequence[str]) -> DataFrame:
    """Distinct members of an array column that are not expected."""
    return rows.select(F.explode(array).alias("value")).filter(~c("value").isin(*expected)).distinct()


def members_over_time(rows: DataFrame, array: str, by: Sequence[str], step_s: int = DAY) -> DataFrame:
    """Members of an array column over time (ingest warnings)."""
    opened = rows.select("ts", *by, F.explode(array).alias("value"))
    return make_timeseries(opened, "ts", ["value", *by], step_s=step_s, n=F.count("*"))


def rows_where(rows: DataFrame, predicate: Column, by: Sequence[str]) -> DataFrame:
    """Counts of rows that should not exist (null databases of shares, output of a disabled collector)."""
    return summarize(rows.filter(predicate), by, n=F.count("*")).orderBy(c("n").desc(), *by)
