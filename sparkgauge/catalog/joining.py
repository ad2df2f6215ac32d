"""Inventory 2.4: joins, closures and trees."""

import datetime as dt

from pyspark.sql import functions as F

from sparkgauge.catalog.base import query
from sparkgauge.functions.sections import text_section
from sparkgauge.operators import graph as G
from sparkgauge.operators import joins as J

c = F.col
SESSION_AS_OF = dt.datetime(2001, 8, 2)


@query(
    "j1_new_queries",
    """SELECT q.query_id, q.user_name, q.execution_time FROM query_log AS q JOIN (SELECT DISTINCT query_id, start_time FROM processed_ids) AS p
       ON q.query_id = p.query_id AND q.start_time = p.start_time""",
)
def _(t):
    return J.new_queries(t.query_log, t.processed_ids).select("query_id", "user_name", "execution_time")


@query("j2_not_processed", "SELECT query_id, execution_time FROM query_log WHERE query_id NOT IN (SELECT query_id FROM processed_ids WHERE processed_time IS NOT NULL)")
def _(t):
    return J.not_processed(t.query_log, t.processed_ids).select("query_id", "execution_time")


@query(
    "j3_session_for_root",
    """SELECT q.query_id, s.authentication_method, s.client_application FROM query_log AS q LEFT JOIN sessions AS s
       ON s.session_id = q.session_id AND s.created_on >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 240 HOUR AND q.parent_query_id IS NULL""",
)
def _(t):
    sessions = t.sessions.drop("user_name")
    return J.session_for_root(t.query_log, sessions, SESSION_AS_OF, hours=240).select(
        "query_id", "authentication_method", "client_application"
    )


@query(
    "j4_trace_for_query",
    """WITH s AS (SELECT query_id, min({'ts': ts, 'span_id': span_id, 'trace_id': trace_id}) AS f FROM event_log WHERE record_type = 'SPAN' GROUP BY query_id)
       SELECT q.query_id, s.f.span_id AS span_id, s.f.trace_id AS trace_id FROM query_log AS q LEFT JOIN s ON q.query_id = s.query_id""",
)
def _(t):
    records = t.event_log.drop("query_id")
    return J.trace_for_query(t.query_log, records, "resource_attributes", "snow.query.id").select("query_id", "span_id", "trace_id")


@query(
    "j5_parent_flags",
    """SELECT span_id, span_id IN (SELECT parent_id FROM span_rows WHERE parent_id IS NOT NULL) AS is_parent,
       parent_id IS NULL OR parent_id NOT IN (SELECT span_id FROM span_rows) AS is_root FROM span_rows""",
)
def _(t):
    return J.parent_flags(t.span_rows, "span_id", "parent_id").select("span_id", "is_parent", "is_root")


@query(
    "j6_enrich_optional",
    """WITH st AS (SELECT query_id, count(*) AS n_operators FROM operator_rows WHERE operator_type = 'Join' GROUP BY query_id)
       SELECT q.query_id, st.n_operators, q.query_tag AS tag, CASE WHEN q.query_no % 3 = 0 THEN 'eligible' END AS estimate
       FROM query_log AS q LEFT JOIN st ON q.query_id = st.query_id""",
)
def _(t):
    rows = t.query_log.select("query_id", text_section({"tag": c("query_tag")}).alias("attributes"))
    stats = t.operator_rows.filter("operator_type = 'Join'").groupBy("query_id").agg(F.count("*").alias("n_operators"))
    estimates = t.query_log.filter("query_no % 3 = 0").select(
        "query_id", text_section({"estimate": F.lit("eligible"), "tag": F.lit("lost")}).alias("attributes")
    )
    return J.enrich_optional(rows, stats, estimates).select(
        "query_id", "n_operators", c("attributes")["tag"].alias("tag"), F.try_element_at("attributes", F.lit("estimate")).alias("estimate")
    )


MONITORED_SQL = """
WITH m AS (SELECT m.name AS monitor, w.name AS warehouse FROM monitors AS m FULL JOIN warehouses AS w
  ON w.resource_monitor = m.name OR ((w.resource_monitor IS NULL OR w.resource_monitor = 'null') AND m.level = 'ACCOUNT'))
"""


@query(
    "j7_monitor_to_warehouses",
    MONITORED_SQL
    + """SELECT monitor AS name, coalesce(string_agg(warehouse, ',' ORDER BY warehouse), '') AS warehouses, count(warehouse) AS n FROM m GROUP BY monitor""",
)
def _(t):
    return J.monitor_to_warehouses(t.monitors, t.warehouses).select(
        "name", F.array_join("warehouses", ",").alias("warehouses"), F.size("warehouses").cast("bigint").alias("n")
    )


@query("j7_monitor_warehouse_pairs", MONITORED_SQL + "SELECT monitor, warehouse FROM m")
def _(t):
    return J.monitor_warehouse_pairs(t.monitors, t.warehouses)


@query(
    "j8_warehouse_to_monitor",
    """SELECT w.name, (w.resource_monitor IS NULL OR w.resource_monitor = 'null') AS is_unmonitored, m.name AS monitor_name, m.level AS monitor_level, m.credit_quota AS monitor_credit_quota
       FROM warehouses AS w LEFT JOIN monitors AS m ON w.resource_monitor = m.name OR ((w.resource_monitor IS NULL OR w.resource_monitor = 'null') AND m.level = 'ACCOUNT')""",
)
def _(t):
    return J.warehouse_to_monitor(t.warehouses, t.monitors, ["level", "credit_quota"]).select(
        "name", "is_unmonitored", "monitor_name", "monitor_level", "monitor_credit_quota"
    )


@query(
    "j9_resolve_id_to_name",
    """SELECT u.usage_id, p.full_name AS resolved_full_name, split_part(coalesce(p.full_name, ''), '.', 1) AS resolved_database, split_part(coalesce(p.full_name, ''), '.', 2) AS resolved_schema,
       coalesce(p.pipe_name, u.pipe_name) AS resolved_name FROM pipe_usage AS u LEFT JOIN pipes AS p ON u.pipe_id = p.pipe_id""",
)
def _(t):
    return J.resolve_id_to_name(t.pipe_usage, t.pipes, "pipe_id", "full_name", "pipe_name").select(
        "usage_id", "resolved_full_name", "resolved_database", "resolved_schema", "resolved_name"
    )


@query(
    "j10_latest_per_key",
    "SELECT event_id, scanner_id, severity FROM (SELECT *, rank() OVER (PARTITION BY scanner_id ORDER BY started_at DESC) AS r FROM scanner_findings) WHERE r = 1",
)
def _(t):
    return J.latest_per_key(t.scanner_findings, "scanner_id", "started_at").select("event_id", "scanner_id", "severity")


@query(
    "j11_last_success_per_user",
    """SELECT user_id, (SELECT epoch_us(max(ts)) FROM login_log AS l WHERE l.event_name = 'LOGIN' AND l.is_success = 'YES' AND (l.user_name = 'ann.' || u.user_id::VARCHAR OR l.user_name = 'SVC_' || u.user_id::VARCHAR)) AS last_us
       FROM user_snapshot AS u""",
)
def _(t):
    name = F.concat(F.when(c("user_id") % 3 == 0, F.lit("ann.")).otherwise(F.lit("SVC_")), c("user_id").cast("string"))
    users = t.user_snapshot.select("user_id", name.alias("login_name"))
    return J.last_success_per_user(users, t.login_log).select("user_id", F.unix_micros("last_success_login").alias("last_us"))


@query(
    "j12_header_detail",
    """SELECT b.name, r.resource_name, l.credit_limit FROM budgets AS b LEFT JOIN budget_resources AS r ON b.name = r.budget_name LEFT JOIN budget_limits AS l ON b.name = l.budget_name""",
)
def _(t):
    return J.header_detail(t.budgets, [(t.budget_resources, "budget_name"), (t.budget_limits, "budget_name")], "name").select(
        "name", "resource_name", "credit_limit"
    )


@query("j13_broadcast_scalar", "SELECT user_id, CASE WHEN true THEN sha256(email) ELSE email END AS email FROM user_snapshot")
def _(t):
    rows = J.broadcast_scalar(t.user_snapshot, {"is_hashed": True})
    return rows.select("user_id", F.when(c("is_hashed"), F.sha2("email", 256)).otherwise(c("email")).alias("email"))


@query(
    "j14_pipe_join",
    """SELECT s.spend_id, l.credit_limit FROM budget_spend AS s JOIN budget_limits AS l ON s.budget_name = l.budget_name""",
)
def _(t):
    return J.pipe_join(t.budget_spend, t.budget_limits, {"budget_name": "budget_name"}, ["credit_limit"]).select("spend_id", "credit_limit")


@query(
    "j14_pipe_join_outer",
    """SELECT s.spend_id, l.credit_limit FROM budget_spend AS s LEFT JOIN budget_limits AS l ON s.budget_name = l.budget_name""",
)
def _(t):
    return J.pipe_join(t.budget_spend, t.budget_limits, {"budget_name": "budget_name"}, ["credit_limit"], "leftOuter").select("spend_id", "credit_limit")


@query(
    "j15_pipe_join_nested",
    """WITH m AS (SELECT DISTINCT account, warehouse_name, monitor_name FROM monitor_log WHERE warehouse_event IS NOT NULL)
       SELECT p.event_id, m.monitor_name FROM metric_points AS p LEFT JOIN m ON p.account = m.account AND p.warehouse_name = m.warehouse_name""",
)
def _(t):
    monitors = t.monitor_log.filter("warehouse_event IS NOT NULL").select("account", "warehouse_name", "monitor_name").distinct()
    on = {"account": "account", "warehouse_name": "warehouse_name"}
    return J.pipe_join_nested(t.metric_points, monitors, on, ["monitor_name"]).select("event_id", "monitor_name")


# Credits per hour by warehouse size.
SIZE_COST = {"X-Small": 1, "Small": 2, "Medium": 4, "Large": 8, "X-Large": 16, "XX-Large": 32, "XXX-Large": 64}


@query(
    "j16_inline_lookup",
    """SELECT query_id, (CASE warehouse_size WHEN 'X-Small' THEN 1 WHEN 'Small' THEN 2 WHEN 'Medium' THEN 4 WHEN 'Large' THEN 8 END)::BIGINT AS cost FROM query_log""",
)
def _(t):
    return J.inline_lookup(t.query_log, SIZE_COST, "warehouse_size", "cost").select("query_id", c("cost").cast("bigint").alias("cost"))


@query(
    "j16_lookup_first_match",
    """WITH f AS (SELECT * FROM (SELECT budget_name, resource_name, resource_domain, row_number() OVER (PARTITION BY budget_name ORDER BY resource_name) AS n FROM budget_resources) WHERE n = 1)
       SELECT b.name, f.resource_name, f.resource_domain FROM budgets AS b LEFT JOIN f ON b.name = f.budget_name""",
)
def _(t):
    return J.lookup(t.budgets, t.budget_resources, "name", "budget_name", ["resource_name", "resource_domain"], ["resource_name"]).select(
        "name", "resource_name", "resource_domain"
    )


CLOSURE_SQL = """
WITH RECURSIVE d AS (SELECT DISTINCT parent, child FROM role_edges WHERE granted_on = 'ROLE'),
r AS (SELECT parent, child, 1 AS depth FROM d UNION SELECT r.parent, d.child, r.depth + 1 FROM r JOIN d ON d.parent = r.child),
closed AS (SELECT parent, child, min(depth) AS depth FROM r GROUP BY parent, child UNION SELECT name, name, 0 FROM roles)
"""


@query("j17_role_closure", CLOSURE_SQL + "SELECT parent, child, depth::BIGINT AS depth FROM closed")
def _(t):
    return G.role_closure(t.role_edges.filter("granted_on = 'ROLE'"), t.roles)


PRIVILEGE_SQL = """
WITH RECURSIVE d AS (SELECT DISTINCT parent, privilege, granted_on, child FROM role_edges),
r AS (SELECT parent, privilege, granted_on, child, 1 AS depth FROM d
      UNION SELECT r.parent, d.privilege, d.granted_on, d.child, r.depth + 1 FROM r JOIN d ON d.parent = r.child WHERE r.granted_on = 'ROLE'),
closed AS (SELECT parent, privilege, granted_on, child, min(depth) AS depth FROM r GROUP BY ALL UNION SELECT name, 'USAGE', 'ROLE', name, 0 FROM roles)
"""


@query("j18_privilege_closure", PRIVILEGE_SQL + "SELECT parent, privilege, granted_on, child, depth::BIGINT AS depth FROM closed")
def _(t):
    return G.privilege_closure(t.role_edges, t.roles)


@query(
    "j19_span_tree",
    """WITH RECURSIVE x AS (SELECT span_id, parent_id, span_id AS root_id, own_trace AS trace_id, 0 AS level FROM span_rows
         WHERE parent_id IS NULL OR parent_id NOT IN (SELECT span_id FROM span_rows)
       UNION ALL SELECT s.span_id, s.parent_id, x.root_id, x.trace_id, x.level + 1 FROM span_rows AS s JOIN x ON s.parent_id = x.span_id)
       SELECT span_id, parent_id, root_id, trace_id, level::BIGINT AS level, CASE WHEN level = 0 THEN 'SERVER' ELSE 'INTERNAL' END AS kind, false AS cyclic FROM x
       UNION ALL SELECT span_id, parent_id, span_id, own_trace, 0, 'SERVER', true FROM span_rows WHERE span_id NOT IN (SELECT span_id FROM x)""",
)
def _(t):
    return G.span_tree(t.span_rows, "span_id", "parent_id", "own_trace")


@query(
    "j20_not_finished",
    """SELECT query_id, run_no FROM active_log WHERE query_id NOT IN (SELECT query_id FROM query_log WHERE execution_status = 'SUCCESS')""",
)
def _(t):
    return J.not_finished(t.active_log, t.query_log.filter("execution_status = 'SUCCESS'"), "query_id").select("query_id", "run_no")
