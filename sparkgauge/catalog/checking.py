"""Inventory 2.13: data-quality checks. Rows are violations."""

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import FRAMES
from sparkgauge.catalog.reporting import KINDS, kinds_of
from sparkgauge.catalog.timeseries import at, grid_sql
from sparkgauge.operators.series import DAY
from sparkgauge.plans import checks as Q
from sparkgauge.plans.reports import operations as RO

c = F.col
MONTH = 30 * DAY

FRAMES["query_spans"] = """
SELECT query_id, parent_query_id, 'run-' || CAST(query_no % 50 AS STRING) AS run_id, start_time AS ts,
       CASE WHEN query_no % 3 = 0 THEN NULL ELSE 'sp-' || CAST(query_no - 1 AS STRING) END AS parent_span_id,
       query_no % 4 AS n_events, query_no % 4 + CASE WHEN query_no % 7 = 0 THEN 1 ELSE 0 END AS events_added,
       CASE WHEN query_no % 14 = 0 THEN 1 ELSE NULL END AS dropped_events
FROM query_log WHERE query_no % 9 <> 5
"""

# One log per statement and one per span event, with a few missing.
FRAMES["query_logs"] = """
SELECT query_id, query_no, start_time AS ts FROM query_log WHERE query_no % 11 <> 3
UNION ALL
SELECT query_id, query_no, start_time AS ts FROM query_log WHERE query_no % 4 >= 1
UNION ALL
SELECT query_id, query_no, start_time AS ts FROM query_log WHERE query_no % 4 >= 2
UNION ALL
SELECT query_id, query_no, start_time AS ts FROM query_log WHERE query_no % 4 = 3 AND query_no % 5 <> 0
"""


@query(
    "q1_kind_coverage",
    """WITH k AS (SELECT query_id, count(*) AS history_n, NULL::BIGINT AS active_n, NULL::BIGINT AS span_n, NULL::BIGINT AS span_events, NULL::BIGINT AS events_added FROM query_logs GROUP BY ALL
         UNION ALL SELECT query_id, NULL, count(*), NULL, NULL, NULL FROM active_log GROUP BY query_id UNION ALL SELECT query_id, NULL, NULL, count(*), max(n_events), max(events_added) FROM query_spans GROUP BY query_id),
       m AS (SELECT query_id, max(history_n) AS history_n, max(active_n) AS active_n, max(span_n) AS span_n, max(span_events) AS span_events, max(events_added) AS events_added FROM k GROUP BY query_id),
       f AS (SELECT *, ((span_n IS NULL) <> (history_n IS NULL)) OR (history_n <> span_n + span_events AND history_n <> span_n + events_added) AS missing FROM m WHERE active_n IS NOT NULL)
       SELECT * FROM f WHERE missing IS NOT NULL""",
)
def _(t):
    return Q.kind_coverage(t.query_logs, t.active_log, t.query_spans)


@query(
    "q2_log_span_match",
    """WITH b AS (SELECT query_id, count(*) AS logs, NULL::BIGINT AS expected FROM query_logs GROUP BY query_id UNION ALL SELECT query_id, NULL, sum(n_events + 1)::BIGINT FROM query_spans GROUP BY query_id),
       m AS (SELECT query_id, sum(logs)::BIGINT AS logs, sum(expected)::BIGINT AS expected FROM b GROUP BY query_id)
       SELECT * FROM m WHERE expected = 0 OR expected <> logs""",
)
def _(t):
    return Q.log_span_match(t.query_logs, t.query_spans)


@query("q3_span_event_completeness", "SELECT query_id, n_events, events_added, dropped_events FROM query_spans WHERE n_events + coalesce(dropped_events, 0) <> events_added")
def _(t):
    return Q.span_event_completeness(t.query_spans).select("query_id", "n_events", "events_added", "dropped_events")


@query(
    "q4_missing_parent_link",
    """WITH sp AS (SELECT span_id AS query_id, parent_id AS parent_query_id, run_id, CASE WHEN turn % 2 = 0 THEN NULL ELSE parent_id END AS parent_span_id FROM span_rows)
       SELECT a.query_id, a.parent_query_id FROM sp AS a WHERE a.parent_span_id IS NULL AND a.parent_query_id IS NOT NULL AND EXISTS (SELECT 1 FROM sp AS b WHERE b.query_id = a.parent_query_id AND b.run_id = a.run_id)""",
)
def _(t):
    spans = t.span_rows.select(
        c("span_id").alias("query_id"), c("parent_id").alias("parent_query_id"), "run_id", F.when(c("turn") % 2 != 0, c("parent_id")).alias("parent_span_id")
    )
    return Q.missing_parent_link(spans).select("query_id", "parent_query_id")


@query(
    "q5_clock_shift",
    """WITH f AS (SELECT run_id, min(ts) AS first_log FROM event_log GROUP BY run_id)
       SELECT s.event_id, s.run_id, abs(epoch_us(s.ts) - epoch_us(f.first_log)) AS shift_us FROM run_status AS s JOIN f ON s.run_id = f.run_id WHERE s.status = 'STARTED' AND abs(epoch_us(s.ts) - epoch_us(f.first_log)) >= 600000000""",
)
def _(t):
    return Q.clock_shift(t.run_status, t.event_log).select("event_id", "run_id", "shift_us")


@query(
    "q6_unpaired_runs",
    """SELECT account, exec_id, plugin, count(*) AS records, count(*) FILTER (WHERE status = 'STARTED') AS started, count(*) FILTER (WHERE status <> 'STARTED') AS ended, epoch_us(max(ts)) AS last_us
       FROM run_status GROUP BY account, exec_id, plugin HAVING count(*) <> 2""",
)
def _(t):
    return Q.unpaired_runs(t.run_status).withColumn("last_us", F.unix_micros("last_seen")).drop("last_seen")


@query("q6_status_counts", "SELECT plugin, status, count(*) AS n, epoch_us(max(ts)) AS last_us FROM run_status WHERE status IN ('STARTED', 'FINISHED') GROUP BY ALL")
def _(t):
    return Q.status_counts(t.run_status).withColumn("last_us", F.unix_micros("last_seen")).drop("last_seen")


@query("q7_repeated_sightings", "SELECT query_id, count(*) AS n, epoch_us(min(seen_at)) AS first_us FROM active_log GROUP BY query_id HAVING count(*) > 1")
def _(t):
    return Q.repeated_sightings(t.active_log).withColumn("first_us", F.unix_micros("first_seen")).drop("first_seen")


@query(
    "q7_sighting_extremes",
    "WITH ct AS (SELECT query_id, count(*) AS k, min(seen_at) AS first_seen FROM active_log GROUP BY query_id), " + grid_sql("ct", "first_seen", [], DAY, {"most": "max(k)", "fewest": "min(k)"}) + "SELECT * FROM series",
)
def _(t):
    return Q.sighting_extremes(t.active_log, DAY).select(at(), "most", "fewest")


@query("q7_statuses_over_time", "WITH " + grid_sql("active_log", "seen_at", ["execution_status"], 7 * DAY, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return Q.statuses_over_time(t.active_log, 7 * DAY).select("execution_status", at(), "n")


@query(
    "q8_volume_by_kind",
    f"WITH {KINDS}, " + grid_sql("kd", "ts", ["account", "kind"], DAY, {"n": "count(*)"}) + "SELECT account, bin_s, sum(n)::BIGINT AS n FROM series GROUP BY ALL",
)
def _(t):
    return Q.volume_over_kinds(RO.volume_by_kind(kinds_of(t), ["account"]), ["account"]).select("account", at(), "n")


def warnings(t):
    """Records with the list of warnings of their intake."""
    listed = F.split(F.regexp_replace("value_text", r'["{}:]', ""), " ")
    return t.event_log.select("event_id", "ts", "account", listed.alias("warnings"))


WARNINGS = """wn AS (SELECT event_id, ts, account, unnest(string_split(regexp_replace(value_text, '["{}:]', '', 'g'), ' ')) AS value FROM event_log)"""


@query("q9_unexpected_values", f"WITH {WARNINGS} SELECT DISTINCT value FROM wn WHERE value NOT IN ('Sent', 'log', 'A', 'B', 'plain', 'text', 'free', 'a')")
def _(t):
    return Q.unexpected_values(warnings(t), "warnings", ["Sent", "log", "A", "B", "plain", "text", "free", "a"])


@query("q9_warnings_over_time", f"WITH {WARNINGS}, " + grid_sql("wn", "ts", ["value", "account"], 7 * DAY, {"n": "count(*)"}) + "SELECT * FROM series")
def _(t):
    return Q.members_over_time(warnings(t), "warnings", ["account"], 7 * DAY).select("value", "account", at(), "n")


@query("q9_null_databases", "SELECT share_name, kind, count(*) AS n FROM share_log WHERE context = 'inbound_shares' AND database_name IS NULL GROUP BY ALL")
def _(t):
    return Q.rows_where(t.share_log, (c("context") == "inbound_shares") & c("database_name").isNull(), ["share_name", "kind"])


@query("q9_disabled_collector", "SELECT plugin, account, count(*) AS n FROM run_status WHERE plugin IN ('tasks') GROUP BY ALL")
def _(t):
    return Q.rows_where(t.run_status, c("plugin").isin("tasks"), ["plugin", "account"])
