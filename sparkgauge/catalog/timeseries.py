"""Inventory 2.9: time series, forecasts, anomaly detection."""

import datetime as dt

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.catalog.frames import FRAMES
from sparkgauge.operators import detect as D
from sparkgauge.operators import series as T

c = F.col

# Vectors as series: one array per row.
FRAMES["series_arrays"] = "SELECT vec_id, embedding AS points, label FROM embeddings"


def at(name="bin"):
    return F.unix_seconds(name).alias("bin_s")


def grid_sql(rows: str, time: str, keys: list[str], step: int, aggregates: dict[str, str], default: str | None = None, where: str = "true", bounds: str = "lo, hi") -> str:
    """CTE ``series``: gap-free bins per key by a key x bin grid and a left join."""
    key_list = ", ".join(keys)
    group = f"{key_list}, " if keys else ""
    same = " AND ".join([f"k.{x} IS NOT DISTINCT FROM p.{x}" for x in keys] + ["p.bin_s = g.bin_s"])
    shown = ", ".join(f"coalesce(p.{n}, {default}) AS {n}" if default else f"p.{n}" for n in aggregates)
    aggs = ", ".join(f"{e} AS {n}" for n, e in aggregates.items())
    own_keys = "".join(f"k.{x}, " for x in keys)
    return f"""
    points AS (SELECT {group}epoch_us({time}) // 1000000 - epoch_us({time}) // 1000000 % {step} AS bin_s, {aggs} FROM {rows} WHERE {time} IS NOT NULL AND {where} GROUP BY ALL),
    bins AS (SELECT unnest(generate_series({bounds}, {step})) AS bin_s FROM (SELECT min(bin_s) AS lo, max(bin_s) AS hi FROM points)),
    series_keys AS (SELECT DISTINCT {key_list or '1 AS one'} FROM points),
    series AS (SELECT {own_keys}g.bin_s, {shown} FROM series_keys AS k CROSS JOIN bins AS g LEFT JOIN points AS p ON {same})
    """


@query(
    "t1_make_timeseries",
    "WITH "
    + grid_sql("event_log", "ts", ["severity", "database_name"], 86400, {"n": "count(*)", "total": "sum(amount)::BIGINT"})
    + "SELECT * FROM series",
)
def _(t):
    out = T.make_timeseries(t.event_log, "ts", ["severity", "database_name"], step_s=T.DAY, n=F.count("*"), total=F.sum("amount"))
    return out.select("severity", "database_name", at(), "n", "total")


@query(
    "t1_make_timeseries_bins",
    """WITH r AS (SELECT ceil((epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000) / 20.0)::BIGINT AS step FROM login_log),
       points AS (SELECT error_message, epoch_us(ts) // 1000000 - epoch_us(ts) // 1000000 % step AS bin_s, count(*) AS n FROM login_log, r GROUP BY ALL),
       bins AS (SELECT unnest(generate_series(min(bin_s), max(bin_s), any_value(step))) AS bin_s FROM points, r)
       SELECT k.error_message, g.bin_s, p.n FROM (SELECT DISTINCT error_message FROM points) AS k CROSS JOIN bins AS g
       LEFT JOIN points AS p ON p.bin_s = g.bin_s AND p.error_message IS NOT DISTINCT FROM k.error_message""",
)
def _(t):
    out = T.make_timeseries(t.login_log, "ts", ["error_message"], bins=20, n=F.count("*"))
    return out.select("error_message", at(), "n")


@query(
    "t2_metric_timeseries",
    "WITH "
    + grid_sql(
        "metric_points", "ts", ["warehouse_name"], 43200, {"clicks": "sum(value)::BIGINT"}, "0",
        "metric = 'value.click' AND account = 'acc-1' AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'",
        bounds="epoch_us(TIMESTAMP '2024-01-05 00:00:00') // 1000000, (epoch_us(TIMESTAMP '2024-01-20 00:00:00') - 1) // 1000000 // 43200 * 43200",
    )
    + "SELECT * FROM series",
)
def _(t):
    out = T.metric_timeseries(
        t.metric_points, ["warehouse_name"], {"clicks": ("sum", "value.click")}, step_s=43200, where=c("account") == "acc-1",
        start=dt.datetime(2024, 1, 5), end=dt.datetime(2024, 1, 20), default=0,
    )
    return out.select("warehouse_name", at(), "clicks")


@query(
    "t2_metric_timeseries_union",
    "WITH "
    + grid_sql(
        "metric_points", "ts", ["warehouse_name", "account"], 86400,
        {"clicks": "sum(CASE WHEN metric = 'value.click' THEN value END)::BIGINT", "views": "max(CASE WHEN metric = 'value.view' THEN value END)"},
        None, "metric IN ('value.click', 'value.view')",
    )
    + "SELECT * FROM series",
)
def _(t):
    metrics = {"clicks": ("sum", "value.click"), "views": ("max", "value.view")}
    out = T.metric_timeseries(t.metric_points, ["warehouse_name", "account"], metrics, step_s=T.DAY, union=True)
    return out.select("warehouse_name", "account", at(), "clicks", "views")


@query(
    "t2_metric_timeseries_both",
    "WITH complete AS (SELECT account, user_id % 50 AS part FROM metric_points GROUP BY ALL HAVING count(*) FILTER (WHERE metric = 'value.click') > 0 AND count(*) FILTER (WHERE metric = 'value.error') > 0), "
    + "kept AS (SELECT m.*, m.user_id % 50 AS part FROM metric_points AS m JOIN complete AS k ON m.account IS NOT DISTINCT FROM k.account AND m.user_id % 50 = k.part), "
    + grid_sql(
        "kept", "ts", ["account", "part"], 864000,
        {"clicks": "sum(CASE WHEN metric = 'value.click' THEN value END)::BIGINT", "errors": "sum(CASE WHEN metric = 'value.error' THEN value END)::BIGINT"},
        None, "metric IN ('value.click', 'value.error')",
    )
    + "SELECT * FROM series",
)
def _(t):
    points = t.metric_points.withColumn("part", c("user_id") % 50)
    metrics = {"clicks": ("sum", "value.click"), "errors": ("sum", "value.error")}
    out = T.metric_timeseries(points, ["account", "part"], metrics, step_s=864000)
    return out.select("account", "part", at(), "clicks", "errors")


@query(
    "t3_bin_summarize",
    """SELECT database_name, pipe_name, epoch_us(time_bucket(INTERVAL '1 hour', loaded_at)) // 1000000 AS bin_s, sum(file_size)::BIGINT AS data FROM copy_history GROUP BY ALL""",
)
def _(t):
    out = T.bin_summarize(t.copy_history, "loaded_at", ["database_name", "pipe_name"], T.HOUR, data=F.sum("file_size"))
    return out.select("database_name", "pipe_name", at(), "data")


@query(
    "t4_series_math",
    "WITH "
    + grid_sql("query_log", "start_time", ["warehouse_name"], 2592000, {"scanned": "max(partitions_scanned)", "total": "max(partitions_total)"})
    + "SELECT warehouse_name, bin_s, round(CASE WHEN total <> 0 THEN scanned / total END, 6) AS scan_ratio, scanned - total AS excess FROM series",
)
def _(t):
    out = T.make_timeseries(
        t.query_log, "start_time", ["warehouse_name"], step_s=30 * T.DAY, scanned=F.max("partitions_scanned"), total=F.max("partitions_total")
    )
    return out.select(
        "warehouse_name", at(), F.round(T.series_divide(c("scanned"), c("total")), 6).alias("scan_ratio"), (c("scanned") - c("total")).alias("excess")
    )


@query(
    "t4_series_math_arrays",
    """WITH p AS (SELECT unnest(range(1, 65)) AS i)
       SELECT vec_id, round(sum(points[i]::DOUBLE - points[65 - i]::DOUBLE * 2), 3) AS diff_sum, round(max(points[i]::DOUBLE / nullif(floor(points[i]::DOUBLE * 4), 0)), 3) AS top FROM series_arrays, p WHERE i <= len(points) AND len(points) = 64 GROUP BY vec_id""",
)
def _(t):
    points = c("points").cast("array<double>")
    rows = t.series_arrays.filter(F.size("points") == 64)
    doubled = F.transform(F.reverse(points), lambda x: x * 2)
    quotient = T.zip_math(points, F.transform(points, lambda x: F.floor(x * 4).cast("double")), "/")
    return rows.select(
        "vec_id",
        F.round(T.array_sum(T.zip_math(points, doubled, "-")), 3).alias("diff_sum"),
        F.round(F.array_max(quotient), 3).alias("top"),
    )


@query(
    "t5_series_stats",
    """SELECT vec_id, round(list_sum(points::DOUBLE[]), 4) AS series_sum, round(list_avg(points::DOUBLE[]), 5) AS series_avg, round(list_max(points)::DOUBLE, 6) AS series_max,
       round(list_min(points)::DOUBLE, 6) AS series_min, round(points[-1]::DOUBLE, 6) AS series_last, len(points)::BIGINT AS series_count FROM series_arrays""",
)
def _(t):
    out = T.series_stats(t.series_arrays.withColumn("points", c("points").cast("array<double>")), "points")
    digits = {"series_sum": 4, "series_avg": 5, "series_max": 6, "series_min": 6, "series_last": 6}
    return out.select("vec_id", *[F.round(n, d).alias(n) for n, d in digits.items()], "series_count")


@query(
    "t5_series_stats_gaps",
    "WITH "
    + grid_sql("warehouse_load", "start_time", ["warehouse_name", "account"], 86400, {"running": "sum(avg_running)::BIGINT"})
    + """SELECT warehouse_name, account, coalesce(sum(running), 0)::DOUBLE AS series_sum, max(running) AS series_max, min(running) AS series_min,
         arg_max_null(running, bin_s) AS series_last, count(running) AS series_count, round(avg(running), 4) AS series_avg FROM series GROUP BY ALL""",
)
def _(t):
    series = T.make_timeseries(t.warehouse_load, "start_time", ["warehouse_name", "account"], step_s=T.DAY, running=F.sum("avg_running"))
    out = T.series_stats(T.as_arrays(series, ["warehouse_name", "account"], ["running"]), "running")
    return out.select(
        "warehouse_name", "account", "series_sum", "series_max", "series_min", "series_last", "series_count", F.round("series_avg", 4).alias("series_avg")
    )


@query(
    "t6_collapse_series",
    "WITH "
    + grid_sql("monitor_log", "ts", ["monitor_name", "account", "service_name"], 86400, {"used": "max(quota_used)"})
    + "SELECT monitor_name, coalesce(account, service_name) AS owner, bin_s, max(used) AS used FROM series GROUP BY ALL",
)
def _(t):
    series = T.make_timeseries(t.monitor_log, "ts", ["monitor_name", "account", "service_name"], step_s=T.DAY, used=F.max("quota_used"))
    by = {"monitor_name": c("monitor_name"), "owner": F.coalesce("account", "service_name")}
    return T.collapse_series(series, by, used=F.max("used")).select("monitor_name", "owner", at(), "used")


@query(
    "t7_series_lookup",
    """WITH s AS (SELECT table_name, epoch_us(date_trunc('day', ts)) // 1000000 AS bin_s, avg(bytes) AS mean_bytes FROM table_metrics GROUP BY ALL),
       l AS (SELECT table_name, epoch_us(date_trunc('day', ts)) // 1000000 AS bin_s, max(row_count) AS top_rows FROM table_metrics GROUP BY ALL),
       ok AS (SELECT table_name FROM l GROUP BY table_name HAVING min(top_rows) > 0)
       SELECT s.table_name, s.bin_s, round(s.mean_bytes / l.top_rows, 7) AS per_row FROM s JOIN ok ON s.table_name = ok.table_name JOIN l ON l.table_name = s.table_name AND l.bin_s = s.bin_s""",
)
def _(t):
    series = T.bin_summarize(t.table_metrics, "ts", ["table_name"], T.DAY, mean_bytes=F.avg("bytes"))
    rows = T.bin_summarize(t.table_metrics, "ts", ["table_name"], T.DAY, top_rows=F.max("row_count"))
    out = T.series_lookup(series, rows, "table_name", "mean_bytes", "top_rows", "per_row")
    return out.select("table_name", at(), F.round("per_row", 7).alias("per_row"))


# --- detection -----------------------------------------------------------------------------

NOW = dt.datetime(2024, 1, 31)

FORECAST_SQL = """
WITH d AS (SELECT monitor_name, account, epoch_us(date_trunc('day', ts)) // 86400000000 - epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 86400000000 AS x, max(quota_used) * 0.1 AS y
  FROM monitor_log WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY ALL),
line AS (SELECT monitor_name, account, count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy FROM d GROUP BY ALL),
fit AS (SELECT *, n >= 3 AND sxx > 0 AS ok, sxy / nullif(sxx, 0) AS slope FROM line),
dev AS (SELECT *, CASE WHEN ok THEN sqrt(greatest(syy - slope * sxy, 0) / (n - 2)) END AS s FROM fit),
days AS (SELECT *, unnest(range(1, 15)) AS day FROM dev),
points AS (SELECT *, CASE WHEN ok THEN my + slope * (day - 1 - mx) END AS point, CASE WHEN ok THEN 1.645 * s * sqrt(1 + 1.0 / n + (day - 1 - mx) * (day - 1 - mx) / sxx) END AS band FROM days),
forecast AS (SELECT monitor_name, account, day, CASE WHEN ok THEN 'VALID' ELSE 'NO_DATA' END AS quality, point, CASE WHEN ok THEN greatest(point - band, 0) END AS lower, point + band AS upper FROM points)
"""


def daily_quota(t):
    return T.make_timeseries(t.monitor_log, "ts", ["monitor_name", "account"], step_s=T.DAY, used_pct=F.max("quota_used") * F.lit(0.1))


@query(
    "t8_forecast_quota",
    FORECAST_SQL + "SELECT monitor_name, account, day, quality, round(point, 4) AS point, round(lower, 4) AS lower, round(upper, 4) AS upper FROM forecast",
)
def _(t):
    out = D.forecast_quota(daily_quota(t), ["monitor_name", "account"], "used_pct", now=NOW)
    return out.select("monitor_name", "account", "day", "quality", *[F.round(n, 4).alias(n) for n in ("point", "lower", "upper")])


@query(
    "t8_exhaustion_alerts",
    FORECAST_SQL
    + """SELECT monitor_name, account, round(max(upper), 4) AS max_upper, round(max(point), 4) AS max_point, min(day) FILTER (WHERE upper > 100) AS day_of_crossing
       FROM forecast WHERE quality <> 'NO_DATA' GROUP BY ALL HAVING max(upper) > 100""",
)
def _(t):
    keys = ["monitor_name", "account"]
    out = D.exhaustion_alerts(D.forecast_quota(daily_quota(t), keys, "used_pct", now=NOW), keys)
    return out.select(*keys, F.round("max_upper", 4).alias("max_upper"), F.round("max_point", 4).alias("max_point"), "day_of_crossing")


SEASONAL_SQL = (
    "WITH "
    + grid_sql("table_metrics", "ts", ["table_name"], 86400, {"v": "max(bytes)"})
    + """, stats AS (SELECT table_name, bin_s // 86400 % 7 AS season, quantile_cont(v, 0.5) AS baseline, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS spread FROM series GROUP BY ALL),
    marked AS (SELECT s.table_name, s.bin_s, s.v, st.baseline + 0.5 * st.spread AS threshold, coalesce(s.v > st.baseline + 0.5 * st.spread, false) AS violation
      FROM series AS s LEFT JOIN stats AS st ON s.table_name = st.table_name AND s.bin_s // 86400 % 7 = st.season)
    """
)


def seasonal(t):
    series = T.make_timeseries(t.table_metrics, "ts", ["table_name"], step_s=T.DAY, v=F.max("bytes"))
    return D.seasonal_anomaly(series, ["table_name"], "v", tolerance=0.5)


@query("t9_seasonal_anomaly", SEASONAL_SQL + "SELECT table_name, bin_s, v, round(threshold, 3) AS threshold, violation FROM marked")
def _(t):
    return seasonal(t).select("table_name", at(), "v", F.round("threshold", 3).alias("threshold"), "violation")


ADAPTIVE_SQL = (
    "WITH "
    + grid_sql("metric_points", "ts", ["metric", "account"], 21600, {"v": "avg(value)"})
    + """, learned AS (SELECT metric, account, quantile_cont(v, 0.99) + 0.25 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS threshold FROM series
      WHERE bin_s >= epoch_us(TIMESTAMP '2024-01-16 00:00:00') // 1000000 AND bin_s < epoch_us(TIMESTAMP '2024-01-29 00:00:00') // 1000000 GROUP BY ALL),
    marked AS (SELECT s.metric, s.account, s.bin_s, s.v, l.threshold, coalesce(s.v > l.threshold, false) OR s.v IS NULL AS violation FROM series AS s
      LEFT JOIN learned AS l ON s.metric = l.metric AND s.account IS NOT DISTINCT FROM l.account)
    """
)


def adaptive(t):
    series = T.make_timeseries(t.metric_points, "ts", ["metric", "account"], step_s=21600, v=F.avg("value"))
    return D.adaptive_anomaly(
        series, ["metric", "account"], "v", train_from=dt.datetime(2024, 1, 16), train_to=dt.datetime(2024, 1, 29), fluctuations=0.25, missing=True
    )


@query("t10_adaptive_anomaly", ADAPTIVE_SQL + "SELECT metric, account, bin_s, round(v, 4) AS v, round(threshold, 3) AS threshold, violation FROM marked")
def _(t):
    return adaptive(t).select("metric", "account", at(), F.round("v", 4).alias("v"), F.round("threshold", 3).alias("threshold"), "violation")


def alerts_sql(keys: str, window: int, violating: int, dealerting: int) -> str:
    """CTE ``alerts`` over ``marked``, by windows and gaps-and-islands."""
    upto = f"(PARTITION BY {keys} ORDER BY bin_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f""",
  rated AS (SELECT *, sum(violation::INT) OVER (w ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS hits, sum(violation::INT) OVER (w ROWS BETWEEN {dealerting - 1} PRECEDING AND CURRENT ROW) AS recent,
    row_number() OVER w AS n, max(bin_s) OVER (PARTITION BY {keys}) AS last_s FROM marked WINDOW w AS (PARTITION BY {keys} ORDER BY bin_s)),
  signals AS (SELECT *, CASE WHEN hits >= {violating} THEN 1 WHEN recent = 0 AND n >= {dealerting} THEN 0 END AS signal FROM rated),
  state AS (SELECT *, coalesce(last_value(signal IGNORE NULLS) OVER {upto}, 0) AS is_on FROM signals),
  changes AS (SELECT *, (is_on <> coalesce(lag(is_on) OVER (PARTITION BY {keys} ORDER BY bin_s), 0))::INT AS changed FROM state),
  islands AS (SELECT *, sum(changed) OVER {upto} AS island FROM changes),
  alerts AS (SELECT {keys}, min(bin_s) AS start_s, max(bin_s) AS end_s, count(*) AS samples, sum(violation::INT)::BIGINT AS violations, max(bin_s) = max(last_s) AS is_open
    FROM islands WHERE is_on = 1 GROUP BY {keys}, island)
"""


def shown_alerts(alerts, *keys):
    return alerts.select(
        *keys, F.unix_seconds("start_at").alias("start_s"), F.unix_seconds("end_at").alias("end_s"), "samples", "violations", "is_open"
    )


@query("t11_alert_windows", ADAPTIVE_SQL + alerts_sql("metric, account", 3, 2, 3) + "SELECT * FROM alerts")
def _(t):
    return shown_alerts(D.alert_windows(adaptive(t), ["metric", "account"], window=3, violating=2, dealerting=3), "metric", "account")


@query("t11_alert_windows_seasonal", SEASONAL_SQL + alerts_sql("table_name", 5, 2, 5) + "SELECT * FROM alerts")
def _(t):
    return shown_alerts(D.alert_windows(seasonal(t), ["table_name"], window=5, violating=2, dealerting=5), "table_name")


@query(
    "t12_alert_events",
    ADAPTIVE_SQL
    + alerts_sql("metric, account", 3, 2, 3)
    + """SELECT 'CUSTOM_INFO' AS event_type, 'Abnormal change of ' || metric AS title, metric || ' in ' || coalesce(account, '{dims:deployment.environment}') || ' deviates from its baseline.' AS description,
       360::BIGINT AS timeout, start_s * 1000 AS event_start, end_s * 1000 AS event_end, 'data_volume_anomaly' AS source, 'data.rows' AS source_metric, metric, account, (CASE WHEN account IS NULL THEN 1 ELSE 2 END)::BIGINT AS n_properties FROM alerts""",
)
def _(t):
    alerts = D.alert_windows(adaptive(t), ["metric", "account"], window=3, violating=2, dealerting=3)
    events = D.alert_events(
        alerts,
        {"metric": c("metric"), "deployment.environment": c("account"), "_internal": F.lit("x")},
        title="Abnormal change of {dims:metric}",
        description="{dims:metric} in {dims:deployment.environment} deviates from its baseline.",
        source="data_volume_anomaly",
        source_metric="data.rows",
    )
    return events.withColumns(
        {
            "metric": F.try_element_at("properties", F.lit("metric")),
            "account": F.try_element_at("properties", F.lit("deployment.environment")),
            "n_properties": F.size("properties").cast("bigint"),
        }
    ).drop("properties")
