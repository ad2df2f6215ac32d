"""Telemetry-shaped input frames, derived from the given tables.

Each text is plain SQL that Spark and DuckDB both accept; a frame may read the
given tables and earlier frames. Amounts become whole numbers row by row, so
that sums do not depend on the order of addition. The frames are inputs only:
the operators under test live in the library.
"""

# Moments the registered queries take as "now": just after the last order and the last event.
QUERY_NOW = "2001-08-02 00:00:00"
EVENT_NOW = "2024-01-31 00:00:00"

FRAMES: dict[str, str] = {}

# --- queries -------------------------------------------------------------------------------

FRAMES["order_lines"] = """
SELECT l_orderkey,
       CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM lineitem GROUP BY l_orderkey
"""

FRAMES["query_log"] = """
SELECT 'Q' || CAST(o_orderkey AS STRING) AS query_id,
       substr(md5(CAST(o_orderkey AS STRING)), 1, 8) || '-' || substr(md5(CAST(o_orderkey AS STRING)), 9, 4)
         || '-' || substr(md5(CAST(o_orderkey AS STRING)), 13, 4) || '-' || substr(md5(CAST(o_orderkey AS STRING)), 17, 4)
         || CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE '-' || substr(md5(CAST(o_orderkey AS STRING)), 21, 12) END AS query_uuid,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'Q' || CAST(o_orderkey - 1 AS STRING) END AS parent_query_id,
       o_orderkey AS query_no,
       o_custkey AS session_id,
       CASE WHEN o_custkey % 50 = 7 THEN 'SYSTEM'
            WHEN o_custkey % 3 = 0 THEN 'ann.' || CAST(o_custkey AS STRING)
            ELSE 'SVC_' || CAST(o_custkey AS STRING) END AS user_name,
       CASE o_custkey % 5 WHEN 0 THEN 'ACCOUNTADMIN' WHEN 1 THEN 'SECURITYADMIN' WHEN 2 THEN 'ANALYST'
            WHEN 3 THEN 'LOADER' ELSE NULL END AS role_name,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'DB_' || CAST(o_orderkey % 7 AS STRING) END AS database_name,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'S_' || CAST(o_orderkey % 3 AS STRING) END AS schema_name,
       'P' || CAST(o_custkey % 4 AS STRING) || '_WH_' || CAST(o_custkey % 25 AS STRING) AS warehouse_name,
       CASE o_custkey % 4 WHEN 0 THEN 'X-Small' WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' ELSE '4X-Large' END AS warehouse_size,
       'acc-' || CAST(o_custkey % 3 AS STRING) AS account,
       CASE o_orderkey % 6 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'INSERT' WHEN 2 THEN 'UPDATE' WHEN 3 THEN 'SELECT'
            WHEN 4 THEN 'MERGE' ELSE 'CALL' END AS query_type,
       CASE WHEN o_orderkey % 29 = 0 THEN ''
            WHEN o_orderkey % 6 = 5 THEN 'call SELF_DB.APP.RUN(ARRAY_CONSTRUCT(''users'', ''tasks'', ''p' || CAST(o_orderkey % 5 AS STRING) || '''))'
            ELSE 'select * from t_' || CAST(o_custkey % 40 AS STRING) || ' where k = ' || CAST(o_orderkey % 17 AS STRING) END AS query_text,
       md5(CAST(o_custkey % 40 AS STRING) || '/' || CAST(o_orderkey % 17 AS STRING)) AS query_hash,
       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'job-' || CAST(o_orderkey % 100 AS STRING) || ' ' || o_orderpriority END AS query_tag,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'RUNNING' ELSE 'FAIL' END AS execution_status,
       CASE WHEN o_orderstatus = 'P' THEN 1000 + o_orderkey % 9 ELSE NULL END AS error_code,
       o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS start_time,
       o_orderdate + (o_orderkey % 86400 + coalesce(qty, 0)) * INTERVAL '1' SECOND AS end_time,
       coalesce(qty, 0) * 1000 AS execution_time,
       (o_orderkey % 13) * 10 AS compilation_time,
       CASE WHEN o_orderkey % 5 = 0 THEN coalesce(n_lines, 0) * 100 ELSE 0 END AS queued_overload_time,
       CASE WHEN o_orderkey % 7 = 0 THEN coalesce(n_lines, 0) * 50 ELSE 0 END AS queued_provisioning_time,
       CASE WHEN o_orderkey % 101 = 0 THEN 5 ELSE 0 END AS queued_repair_time,
       CASE WHEN o_orderkey % 97 = 0 THEN 30 ELSE 0 END AS transaction_blocked_time,
       coalesce(qty, 0) * 1000 + (o_orderkey % 13) * 10 AS total_elapsed_time,
       coalesce(cents, 0) AS bytes_scanned,
       CASE WHEN o_orderkey % 8 = 0 THEN coalesce(cents, 0) % 1000003 ELSE 0 END AS bytes_spilled_local,
       CASE WHEN o_orderkey % 24 = 0 THEN coalesce(cents, 0) % 10007 ELSE 0 END AS bytes_spilled_remote,
       coalesce(n_lines, 0) * (o_orderkey % 21) AS partitions_scanned,
       coalesce(n_lines, 0) * 20 AS partitions_total,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey % 101 END AS cache_pct,
       CASE WHEN o_orderkey % 6 = 0 THEN coalesce(cents, 0) % 5003 ELSE 0 END AS acceleration_bytes,
       CASE WHEN o_orderkey % 15 = 0 THEN o_custkey % 6 ELSE 0 END AS external_calls,
       CASE WHEN o_orderkey % 10 = 1 THEN coalesce(cents, 0) % 7919 ELSE 0 END AS outbound_bytes,
       CASE WHEN o_orderkey % 10 = 2 THEN coalesce(cents, 0) % 7907 ELSE 0 END AS inbound_bytes,
       CASE o_custkey % 3 WHEN 0 THEN 'eu-1' WHEN 1 THEN 'us-2' ELSE NULL END AS transfer_region,
       CASE o_custkey % 2 WHEN 0 THEN 'cloud-a' ELSE 'cloud-b' END AS transfer_cloud,
       coalesce(n_lines, 0) AS rows_produced,
       CAST(round(o_totalprice * 100) AS BIGINT) % 1000 AS cloud_credits
FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey
"""

FRAMES["processed_ids"] = """
SELECT query_id, start_time, CASE WHEN query_no % 5 = 0 THEN NULL ELSE end_time END AS processed_time
FROM query_log WHERE query_no % 3 = 0
"""

FRAMES["sessions"] = """
SELECT c_custkey AS session_id,
       TIMESTAMP '2001-08-01 00:00:00' - (c_custkey % 400) * INTERVAL '1' HOUR AS created_on,
       CASE WHEN c_custkey % 50 = 7 THEN 'SYSTEM' WHEN c_custkey % 3 = 0 THEN 'ann.' || CAST(c_custkey AS STRING)
            ELSE 'SVC_' || CAST(c_custkey AS STRING) END AS user_name,
       CASE c_custkey % 4 WHEN 0 THEN 'PASSWORD' WHEN 1 THEN 'RSA' WHEN 2 THEN 'OAUTH' ELSE NULL END AS authentication_method,
       CASE c_custkey % 5 WHEN 0 THEN 'Web 1.0' WHEN 1 THEN 'JDBC 3.2' WHEN 2 THEN 'Python 2.9' ELSE NULL END AS client_application,
       CAST(round(c_acctbal * 100) AS BIGINT) AS login_event_id,
       CASE WHEN c_custkey % 6 = 0 THEN 'TIMEOUT' ELSE NULL END AS closed_reason
FROM customer
"""

FRAMES["object_access"] = """
SELECT 'Q' || CAST(l_orderkey AS STRING) AS query_id,
       CAST(l_linenumber AS BIGINT) AS position,
       'DB_' || CAST(l_partkey % 6 AS STRING) || '.S.T_' || CAST(l_partkey % 60 AS STRING) AS base_name,
       CASE WHEN l_partkey % 4 = 0 THEN 'View' ELSE 'Table' END AS base_domain,
       CASE WHEN l_orderkey % 10 = 0 THEN NULL
            ELSE 'DB_' || CAST(l_suppkey % 6 AS STRING) || '.S.V_' || CAST(l_suppkey % 30 AS STRING) END AS direct_name,
       CASE WHEN l_suppkey % 3 = 0 THEN 'Table' ELSE 'View' END AS direct_domain
FROM lineitem
"""

FRAMES["operator_rows"] = """
SELECT 'Q' || CAST(l_orderkey AS STRING) AS query_id,
       l_orderkey AS query_no,
       CAST(1 + l_linenumber % 2 AS BIGINT) AS step_id,
       CAST(l_linenumber AS BIGINT) AS operator_id,
       l_partkey * 1000000 + l_suppkey * 100 + CAST(l_linenumber AS BIGINT) AS operator_key,
       CASE WHEN l_linenumber % 3 = 0 THEN 'Join' WHEN l_linenumber % 3 = 1 THEN 'TableScan' ELSE 'Filter' END AS operator_type,
       CAST(l_quantity AS BIGINT) AS share_points,
       l_partkey % 500 AS input_rows,
       l_suppkey * 3 % 500 AS output_rows,
       CASE WHEN l_partkey % 53 = 0 THEN 'TimeoutError' ELSE NULL END AS exception_type
FROM lineitem
"""

FRAMES["active_sightings"] = """
SELECT query_id, account, warehouse_name, warehouse_size, user_name, database_name, query_text, query_hash, query_no,
       execution_status, start_time,
       CAST(query_no % 12 AS BIGINT) AS run_no,
       end_time AS seen_at,
       execution_time * 20 AS running_time,
       total_elapsed_time, execution_time, compilation_time
FROM query_log
"""

# Every third query is seen again, later and longer, by the next run.
FRAMES["active_log"] = """
SELECT query_id, account, warehouse_name, warehouse_size, user_name, database_name, query_text, query_hash,
       execution_status, run_no, seen_at, running_time, total_elapsed_time, execution_time, compilation_time, query_no
FROM active_sightings
UNION ALL
SELECT query_id, account, warehouse_name, warehouse_size, user_name, database_name, query_text, query_hash,
       CASE WHEN query_no % 2 = 0 THEN 'QUEUED' ELSE execution_status END AS execution_status,
       run_no + 1 AS run_no, seen_at + INTERVAL '30' MINUTE AS seen_at, running_time + 1800000 AS running_time,
       total_elapsed_time + 1800000 AS total_elapsed_time, execution_time, compilation_time, query_no
FROM active_sightings WHERE query_no % 3 = 0
"""

# --- events, logins, runs ------------------------------------------------------------------

FRAMES["event_rows"] = """
SELECT event_id, ts, user_id, event_type,
       CAST(round(value * 100) AS BIGINT) AS amount,
       CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k,
       props,
       'acc-' || CAST(user_id % 3 AS STRING) AS account
FROM events
"""

FRAMES["event_log"] = """
SELECT event_id, ts,
       ts - (k % 50) * INTERVAL '1' SECOND AS start_ts,
       CASE event_type WHEN 'purchase' THEN 'METRIC' WHEN 'signup' THEN 'SPAN' WHEN 'error' THEN 'EVENT' ELSE 'LOG' END AS record_type,
       CASE WHEN k % 10 = 0 THEN 'SELF_OTLP' WHEN k % 10 = 1 THEN 'SELF_T1_OTLP' WHEN k % 10 = 2 THEN NULL ELSE 'app.main' END AS scope_name,
       CASE k % 6 WHEN 0 THEN 'SELF_DB' WHEN 1 THEN 'SELF_T1_DB' WHEN 2 THEN 'SALES' WHEN 3 THEN 'OPS' WHEN 4 THEN 'OPS_STAGE' ELSE NULL END AS database_name,
       CASE k % 4 WHEN 0 THEN 'DEBUG' WHEN 1 THEN 'INFO' WHEN 2 THEN 'WARN' ELSE 'ERROR' END AS severity,
       CASE WHEN k % 9 = 0 THEN 'openflow' WHEN k % 9 = 1 THEN 'loader' ELSE NULL END AS application,
       CASE k % 5 WHEN 0 THEN '"plain text ' || CAST(k AS STRING) || '"'
                  WHEN 1 THEN '{"a": ' || CAST(k AS STRING) || '}'
                  WHEN 2 THEN 'Sent log A Sent log B'
                  WHEN 3 THEN 'free text'
                  ELSE '"' || CAST(k AS STRING) || '"' END AS value_text,
       'metric.' || CAST(k % 4 AS STRING) AS metric_name,
       CASE WHEN k % 2 = 0 THEN 'gauge' ELSE 'sum' END AS metric_type,
       amount, user_id, k,
       'Q' || CAST(event_id - event_id % 2 AS STRING) AS query_id,
       md5(CAST(event_id AS STRING)) AS trace_id,
       substr(md5('s' || CAST(event_id AS STRING)), 1, 16) AS span_id,
       CASE WHEN k % 3 = 0 THEN NULL ELSE substr(md5('s' || CAST(event_id - 1 AS STRING)), 1, 16) END AS parent_span_id,
       CASE k % 3 WHEN 0 THEN 'STATUS_CODE_ERROR' WHEN 1 THEN 'STATUS_CODE_UNSET' ELSE 'STATUS_CODE_OK' END AS span_status,
       '{"snow.query.id":"Q' || CAST(event_id - event_id % 2 AS STRING) || '","snow.user.id":"' || CAST(user_id AS STRING) || '"}' AS resource_attributes,
       'run-' || CAST(user_id % 40 AS STRING) AS run_id,
       'acc-' || CAST(user_id % 3 AS STRING) AS account
FROM event_rows
"""

FRAMES["login_log"] = """
SELECT event_id, ts,
       CASE WHEN user_id % 3 = 0 THEN 'ann.' || CAST(user_id AS STRING) ELSE 'SVC_' || CAST(user_id AS STRING) END AS user_name,
       CASE WHEN event_type = 'error' THEN 'LOGIN_FAILED' ELSE 'LOGIN' END AS event_name,
       CASE WHEN event_type = 'error' THEN 'NO' ELSE 'YES' END AS is_success,
       CASE WHEN event_type = 'error' THEN 'E' || CAST(k % 4 AS STRING) ELSE NULL END AS error_code,
       CASE WHEN event_type = 'error' THEN CASE k % 4 WHEN 0 THEN 'BAD_PASSWORD' WHEN 1 THEN 'LOCKED' WHEN 2 THEN 'EXPIRED' ELSE 'IP_DENIED' END ELSE NULL END AS error_message,
       CASE WHEN k % 20 = 0 THEN '0.0.0.0' ELSE CAST(10 + k % 90 AS STRING) || '.' || CAST(user_id % 250 AS STRING) || '.0.1' END AS client_ip,
       CASE k % 4 WHEN 0 THEN 'WEB' WHEN 1 THEN 'JDBC' WHEN 2 THEN 'PYTHON' ELSE NULL END AS client_type,
       CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'RSA_KEYPAIR' WHEN 2 THEN 'OAUTH' ELSE 'PASSWORD' END AS first_factor,
       CASE WHEN k % 7 = 0 THEN 'MFA' ELSE NULL END AS second_factor,
       account, k
FROM event_rows
"""

FRAMES["run_status"] = """
SELECT event_id, ts, 'acc-' || CAST(CAST(floor(event_id / 2) AS BIGINT) % 3 AS STRING) AS account,
       CASE CAST(floor(event_id / 2) AS BIGINT) % 5 WHEN 0 THEN 'query_history' WHEN 1 THEN 'users' WHEN 2 THEN 'tasks' WHEN 3 THEN 'event_log' ELSE 'deployment' END AS plugin,
       'exec-' || CASE WHEN k = 50 THEN 'lost-' || CAST(event_id AS STRING) ELSE CAST(CAST(floor(event_id / 2) AS BIGINT) AS STRING) END AS exec_id,
       'run-' || CAST(user_id % 40 AS STRING) AS run_id,
       CASE WHEN event_id % 2 = 0 THEN 'STARTED' WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
       'host-' || CAST(user_id % 4 AS STRING) AS host_name
FROM event_rows
"""

FRAMES["status_log"] = """
SELECT CASE user_id % 5 WHEN 0 THEN 'query_history' WHEN 1 THEN 'users' WHEN 2 THEN 'tasks' WHEN 3 THEN 'event_log' ELSE 'shares' END AS source,
       ts AS run_at, ts - (k % 90) * INTERVAL '1' MINUTE AS last_timestamp, event_id AS last_id, amount AS entries
FROM event_rows
"""

FRAMES["metric_points"] = """
SELECT 'value.' || event_type AS metric, 'P' || CAST(user_id % 4 AS STRING) || '_WH_' || CAST(user_id % 25 AS STRING) AS warehouse_name,
       CASE WHEN k % 4 = 0 THEN NULL ELSE account END AS account, 'svc-' || CAST(user_id % 2 AS STRING) AS service_name,
       ts, amount AS value, user_id, event_id
FROM event_rows
"""

FRAMES["config_rows"] = """
SELECT 'plugins.' || lower(p_type) || '.limit_' || CAST(p_size AS STRING) AS path,
       CASE WHEN p_size % 3 = 0 THEN 'x' || CAST(max(p_partkey) AS STRING) ELSE CAST(max(p_partkey) AS STRING) END AS value,
       CASE WHEN p_size % 2 = 0 THEN 'int' ELSE 'str' END AS type
FROM part GROUP BY p_type, p_size
"""

# --- access control ------------------------------------------------------------------------

# region -> nation -> customer segment roles; suppliers' nations add a second way down.
FRAMES["role_edges"] = """
SELECT 'R_' || r_name AS parent, 'N_' || n_name AS child, 'USAGE' AS privilege, 'ROLE' AS granted_on
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'N_' || n_name AS parent, 'C_' || c_mktsegment || '_' || CAST(c_custkey % 20 AS STRING) AS child, 'USAGE' AS privilege, 'ROLE' AS granted_on
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'C_' || c_mktsegment || '_' || CAST(c_custkey % 20 AS STRING) AS parent, 'L_' || CAST(c_custkey % 8 AS STRING) AS child, 'USAGE' AS privilege, 'ROLE' AS granted_on
FROM customer WHERE c_custkey % 20 > 9
UNION ALL
SELECT 'N_' || n_name AS parent, 'L_' || CAST(s_suppkey % 8 AS STRING) AS child, 'USAGE' AS privilege, 'ROLE' AS granted_on
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT 'N_' || n_name AS parent, 'TBL_' || CAST(s_suppkey % 15 AS STRING) AS child,
       CASE WHEN s_suppkey % 2 = 0 THEN 'SELECT' ELSE 'INSERT' END AS privilege, 'TABLE' AS granted_on
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

FRAMES["roles"] = """
SELECT parent AS name FROM role_edges
UNION
SELECT child AS name FROM role_edges WHERE granted_on = 'ROLE'
"""

FRAMES["user_grants"] = """
SELECT c_name AS user_name,
       CASE WHEN c_custkey % 5 = 0 THEN 'R_' || r_name ELSE 'N_' || n_name END AS role,
       'ADMIN_' || CAST(c_custkey % 3 AS STRING) AS granted_by,
       TIMESTAMP '2024-01-01 00:00:00' + (c_custkey % 700) * INTERVAL '1' HOUR AS created_on,
       CASE WHEN c_custkey % 6 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + (c_custkey % 900) * INTERVAL '1' HOUR ELSE NULL END AS deleted_on
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT c_name AS user_name, 'C_' || c_mktsegment || '_' || CAST(c_custkey % 20 AS STRING) AS role,
       'ADMIN_' || CAST(c_custkey % 2 AS STRING) AS granted_by,
       TIMESTAMP '2024-01-05 00:00:00' + (c_custkey % 400) * INTERVAL '1' HOUR AS created_on, NULL AS deleted_on
FROM customer WHERE c_custkey % 4 = 1
"""

FRAMES["user_snapshot"] = """
SELECT c_custkey AS user_id, c_name AS login_name,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.test' END AS email,
       CASE WHEN c_custkey % 10 = 3 THEN 'X' || c_mktsegment ELSE c_mktsegment END AS default_role,
       c_nationkey % 2 = 0 AS has_password, c_custkey % 3 = 0 AS has_mfa, c_custkey % 7 = 0 AS has_rsa, c_custkey % 11 = 0 AS has_pat,
       CASE WHEN c_custkey % 13 = 0 THEN 'true' WHEN c_custkey % 13 = 1 THEN NULL ELSE 'false' END AS is_disabled,
       CASE WHEN c_custkey % 19 = 0 THEN 'true' ELSE 'false' END AS is_locked,
       CASE c_custkey % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'SERVICE' ELSE NULL END AS user_type,
       'OWNER_' || CAST(c_custkey % 4 AS STRING) AS owner,
       TIMESTAMP '2024-01-01 00:00:00' - (c_custkey % 1000) * INTERVAL '1' DAY AS created_on,
       CASE WHEN c_custkey % 21 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + (c_custkey % 1000) * INTERVAL '1' HOUR ELSE NULL END AS deleted_on,
       'acc-' || CAST(c_custkey % 3 AS STRING) AS account
FROM customer
"""

# What earlier runs have reported: some users are missing, some have an older role.
FRAMES["user_seen"] = """
SELECT c_custkey AS user_id, c_name AS login_name, c_mktsegment AS default_role
FROM customer WHERE c_custkey % 4 <> 2
UNION ALL
SELECT c_custkey AS user_id, c_name AS login_name, 'OLD_' || c_mktsegment AS default_role
FROM customer WHERE c_custkey % 5 = 0
"""

FRAMES["scanner_findings"] = """
SELECT doc_id AS event_id, source AS scanner_id, 'Scan ' || source AS scanner_name,
       CASE WHEN toxic = 1 THEN 'CRITICAL' WHEN quality = 0 THEN 'HIGH' WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'FAILED' ELSE 'SUCCEEDED' END AS completion_status,
       CASE doc_id % 2 WHEN 0 THEN 'Vulnerability' ELSE 'Detection' END AS scanner_type,
       'pkg-' || lang AS package_id,
       TIMESTAMP '2024-01-01 00:00:00' + CAST(floor(doc_id / 60) AS BIGINT) * INTERVAL '1' HOUR AS started_at,
       TIMESTAMP '2024-01-01 00:10:00' + CAST(floor(doc_id / 60) AS BIGINT) * INTERVAL '1' HOUR AS ended_at,
       n_chars % 4 AS at_risk_count,
       CASE n_chars % 4 WHEN 0 THEN '[]'
            WHEN 1 THEN '[{"entity_id":"' || CAST(doc_id AS STRING) || '","entity_name":"a"}]'
            WHEN 2 THEN '[{"entity_id":"' || CAST(doc_id AS STRING) || '","entity_name":"a"},{"entity_id":"7","entity_name":"b"}]'
            ELSE '[{"entity_id":"1","entity_name":"a"},{"entity_id":"2","entity_name":"b"},{"entity_id":"3","entity_name":null}]' END AS at_risk_entities,
       'acc-' || CAST(doc_id % 3 AS STRING) AS account
FROM (SELECT d.doc_id, d.source, d.lang, d.n_chars, l.quality, l.toxic FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id) AS f
"""

# --- warehouses, monitors, budgets ---------------------------------------------------------

FRAMES["warehouses"] = """
SELECT 'P' || CAST(s_suppkey % 4 AS STRING) || '_WH_' || CAST(s_suppkey AS STRING) AS name,
       CASE WHEN s_acctbal < 0 THEN 'null' WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 14 = 0 THEN 'GONE' ELSE 'RM_' || CAST(s_nationkey AS STRING) END AS resource_monitor,
       CASE s_suppkey % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUSPENDED' ELSE 'RESUMING' END AS state,
       CASE s_suppkey % 4 WHEN 0 THEN 'X-Small' WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' ELSE 'Large' END AS size,
       CASE WHEN s_suppkey % 2 = 0 THEN 'STANDARD' ELSE 'ECONOMY' END AS scaling_policy,
       CAST(1 AS BIGINT) AS min_clusters, 1 + s_suppkey % 5 AS max_clusters, s_suppkey % 3 AS started_clusters,
       s_suppkey % 6 AS running, s_suppkey % 7 AS queued, CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END AS auto_resume,
       TIMESTAMP '2024-01-01 00:00:00' - s_suppkey * INTERVAL '1' HOUR AS created_on,
       'acc-' || CAST(s_suppkey % 3 AS STRING) AS account
FROM supplier
"""

FRAMES["monitors"] = """
SELECT CASE WHEN n_nationkey = 3 THEN 'ACCOUNT_MONITOR' ELSE 'RM_' || CAST(n_nationkey AS STRING) END AS name,
       CASE WHEN n_nationkey = 3 THEN 'ACCOUNT' ELSE 'WAREHOUSE' END AS level,
       CASE n_nationkey % 3 WHEN 0 THEN 'MONTHLY' WHEN 1 THEN 'DAILY' ELSE 'WEEKLY' END AS frequency,
       CAST(CASE WHEN n_nationkey % 8 = 0 THEN 0 ELSE 100 + n_nationkey * 10 END AS BIGINT) AS credit_quota,
       CAST(n_nationkey * 7 AS BIGINT) AS used_credits,
       CAST(100 + n_nationkey * 3 AS BIGINT) AS remaining_credits,
       TIMESTAMP '2024-01-01 00:00:00' - n_nationkey * INTERVAL '1' DAY AS start_time,
       CASE WHEN n_nationkey % 4 = 0 THEN TIMESTAMP '2024-12-01 00:00:00' ELSE NULL END AS end_time,
       TIMESTAMP '2023-01-01 00:00:00' AS created_on
FROM nation
"""

FRAMES["warehouse_log"] = """
SELECT e.event_id, e.ts, w.account, w.name AS warehouse_name, w.size, w.scaling_policy, w.min_clusters, w.max_clusters,
       e.k % (w.max_clusters + 1) AS started_clusters, w.state, w.auto_resume,
       w.resource_monitor, CASE WHEN e.event_type IN ('error', 'view') THEN 'WARN' ELSE 'INFO' END AS loglevel
FROM event_rows AS e JOIN warehouses AS w ON w.name = 'P' || CAST(e.user_id % 10 % 4 AS STRING) || '_WH_' || CAST(e.user_id % 10 AS STRING)
"""

FRAMES["monitor_log"] = """
SELECT event_id, ts, CASE WHEN k % 5 = 0 THEN NULL ELSE account END AS account, 'svc-' || CAST(user_id % 2 AS STRING) AS service_name,
       'P' || CAST(user_id % 4 AS STRING) || '_RM_' || CAST(user_id % 12 AS STRING) AS monitor_name,
       'P' || CAST(user_id % 4 AS STRING) || '_WH_' || CAST(user_id % 25 AS STRING) AS warehouse_name,
       CASE user_id % 4 WHEN 0 THEN 'X-Small' WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' ELSE 'Large' END AS warehouse_size,
       CASE user_id % 3 WHEN 0 THEN 'MONTHLY' WHEN 1 THEN 'DAILY' ELSE 'WEEKLY' END AS frequency,
       CASE WHEN k % 6 = 0 THEN NULL WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS is_active,
       1000 + user_id AS quota, amount % 1000 AS quota_used, 1000 + user_id - amount % 1000 AS quota_remaining,
       CASE WHEN k % 4 = 0 THEN NULL ELSE 'resumed' END AS warehouse_event
FROM event_rows
"""

FRAMES["warehouse_events"] = """
SELECT event_id, ts, account,
       'P' || CAST(user_id % 4 AS STRING) || '_WH_' || CAST(user_id % 25 AS STRING) AS warehouse_name,
       CASE event_type WHEN 'click' THEN 'RESUME_WAREHOUSE' WHEN 'view' THEN 'SUSPEND_WAREHOUSE' WHEN 'error' THEN 'RESIZE_CLUSTER' ELSE 'WAREHOUSE_CONSISTENT' END AS event_name,
       CASE WHEN k % 2 = 0 THEN 'STARTED' ELSE 'COMPLETED' END AS event_state,
       k % 4 AS cluster_number, CASE WHEN k % 3 = 0 THEN NULL ELSE 'AUTO' END AS event_reason,
       'U' || CAST(user_id AS STRING) AS user_name, user_id % 25 AS warehouse_id
FROM event_rows
"""

FRAMES["warehouse_load"] = """
SELECT l_orderkey * 10 + CAST(l_linenumber AS BIGINT) AS load_id, l_shipdate AS start_time, l_shipdate + INTERVAL '5' MINUTE AS end_time,
       'WH_' || CAST(l_suppkey % 25 AS STRING) AS warehouse_name, l_suppkey % 25 AS warehouse_id,
       CAST(l_quantity AS BIGINT) AS avg_running, CAST(round(l_discount * 100) AS BIGINT) AS avg_queued,
       CAST(round(l_tax * 100) AS BIGINT) AS avg_blocked, l_partkey % 3 AS avg_provisioning,
       'acc-' || CAST(l_suppkey % 3 AS STRING) AS account
FROM lineitem
"""

FRAMES["warehouse_metering"] = """
SELECT o_orderkey AS meter_id, o_orderdate AS start_time, o_orderdate + INTERVAL '1' HOUR AS end_time,
       'WH_' || CAST(o_custkey % 25 AS STRING) AS warehouse_name, o_custkey % 25 AS warehouse_id,
       CAST(round(o_totalprice * 100) AS BIGINT) AS credits_used, CAST(round(o_totalprice * 100) AS BIGINT) - o_orderkey % 100 AS credits_compute,
       o_orderkey % 100 AS credits_cloud
FROM orders
"""

FRAMES["budgets"] = """
SELECT 'B_' || CAST(n_nationkey AS STRING) AS name, 'DB_' || CAST(n_regionkey AS STRING) AS database_name, 'FIN' AS schema_name,
       'OWNER_' || CAST(n_nationkey % 3 AS STRING) AS owner, 'ROLE' AS owner_role_type,
       TIMESTAMP '2024-01-01 00:00:00' + n_nationkey * INTERVAL '1' DAY AS created_on
FROM nation
"""

FRAMES["budget_resources"] = """
SELECT 'B_' || CAST(c_nationkey AS STRING) AS budget_name, c_name AS resource_name, c_mktsegment AS resource_domain
FROM customer WHERE c_nationkey % 6 <> 5
"""

FRAMES["budget_limits"] = """
SELECT 'B_' || CAST(n_nationkey AS STRING) AS budget_name, CAST(CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE 1000000 * (n_nationkey + 1) END AS BIGINT) AS credit_limit
FROM nation WHERE n_nationkey % 5 <> 4
"""

FRAMES["budget_spend"] = """
SELECT o_orderkey AS spend_id, 'B_' || CAST(o_custkey % 27 AS STRING) AS budget_name, o_orderpriority AS service_type,
       o_orderdate AS measured_on, CAST(round(o_totalprice * 100) AS BIGINT) AS credits_spent,
       'acc-' || CAST(o_custkey % 3 AS STRING) AS account
FROM orders
"""

FRAMES["budget_log"] = """
SELECT c_custkey AS log_id, 'B_' || CAST(c_nationkey AS STRING) AS budget_name, 'acc-' || CAST(c_custkey % 3 AS STRING) AS account,
       CAST(1000000 AS BIGINT) * (c_nationkey % 7) AS credit_limit, 'OWNER_' || CAST(c_custkey % 5 AS STRING) AS owner, c_mktsegment AS resource,
       TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS ts
FROM customer
"""

# --- tables, schemas, dynamic tables, pipes, tasks, shares ---------------------------------

FRAMES["inventory"] = """
SELECT p_partkey AS table_id, replace(p_brand, '#', '_') AS database_name, p_type AS schema_name,
       replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) AS table_name,
       replace(p_brand, '#', '_') || '.' || p_type || '.' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) AS full_name,
       CASE p_size % 4 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'TRANSIENT' ELSE 'BASE TABLE' END AS table_type,
       CAST(p_size AS BIGINT) * 1000 AS row_count, CAST(round(p_retailprice * 100) AS BIGINT) AS bytes,
       TIMESTAMP '2024-01-30 00:00:00' - (p_partkey % 5000) * INTERVAL '1' MINUTE AS last_altered,
       TIMESTAMP '2024-01-30 00:00:30' - (p_partkey % 300) * INTERVAL '1' DAY AS last_ddl,
       CASE WHEN p_partkey % 12 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' + (p_partkey % 400) * INTERVAL '1' HOUR ELSE NULL END AS deleted_on
FROM part
"""

FRAMES["include_patterns"] = """
SELECT 'Brand_' || CAST(r_regionkey + 1 AS STRING) || '%.' || CASE WHEN r_regionkey % 2 = 0 THEN 'ECONOMY' ELSE 'STANDARD' END || '.%' AS pattern FROM region
UNION ALL
SELECT '%.SMALL.%' AS pattern FROM region WHERE r_regionkey = 0
"""

FRAMES["exclude_patterns"] = """
SELECT '%gear\\_%' AS pattern FROM region WHERE r_regionkey = 0
UNION ALL
SELECT '%bolt%' AS pattern FROM region WHERE r_regionkey = 1
"""

FRAMES["table_metrics"] = """
SELECT l_orderkey * 10 + CAST(l_linenumber AS BIGINT) AS point_id, l_shipdate AS ts,
       'T_' || CAST(l_partkey % 60 AS STRING) AS table_name,
       CASE WHEN l_partkey % 60 = 59 THEN NULL ELSE 'DB_' || CAST(l_partkey % 6 AS STRING) END AS database_name,
       CASE l_partkey % 3 WHEN 0 THEN 'BASE TABLE' WHEN 1 THEN 'TRANSIENT' ELSE NULL END AS table_type,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS bytes,
       CASE WHEN l_partkey % 60 = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 10 END AS row_count,
       l_partkey % 60 * 6000 + l_orderkey % 1000 AS minutes_since_ddl, l_orderkey % 90000 AS minutes_since_update,
       'acc-' || CAST(l_partkey % 3 AS STRING) AS account
FROM lineitem
"""

FRAMES["ddl_events"] = """
SELECT o_orderkey AS event_no, 'Q' || CAST(o_orderkey AS STRING) AS query_id, o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS ts,
       'ann.' || CAST(o_custkey AS STRING) AS user_name, 'acc-' || CAST(o_custkey % 3 AS STRING) AS account,
       CASE o_orderkey % 4 WHEN 0 THEN 'Table' WHEN 1 THEN 'Schema' WHEN 2 THEN 'Database' ELSE 'Stage' END AS object_domain,
       'DB_' || CAST(o_custkey % 7 AS STRING) || '.S.T_' || CAST(o_custkey % 60 AS STRING) AS object_name,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'CREATE' WHEN o_orderstatus = 'O' THEN 'ALTER' ELSE 'DROP' END AS operation,
       '{"columns":{"C' || CAST(o_custkey % 5 AS STRING) || '":{"subOperationType":"ADD"},"D' || CAST(o_orderkey % 3 AS STRING) || '":{"subOperationType":"DROP"},"E":{"subOperationType":"ADD"}}}' AS properties
FROM orders
"""

FRAMES["ddl_columns"] = """
SELECT 'Q' || CAST(l_orderkey AS STRING) AS query_id, 'DB_' || CAST(l_suppkey % 5 AS STRING) || '.S.T' AS object_name, 'Table' AS object_domain,
       'col_' || CAST(l_partkey % 30 AS STRING) AS column_name
FROM lineitem
"""

FRAMES["dynamic_tables"] = """
SELECT p_partkey AS row_no, replace(p_brand, '#', '_') AS database_name, p_type AS schema_name, 'DT_' || CAST(p_partkey % 40 AS STRING) AS table_name,
       replace(p_brand, '#', '_') || '.' || p_type || '.DT_' || CAST(p_partkey % 40 AS STRING) AS full_name,
       TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '7' MINUTE AS ts,
       CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'SUSPENDED' WHEN 2 THEN 'FAILED' ELSE 'ACTIVE' END AS scheduling_state,
       CASE WHEN p_partkey % 5 = 1 THEN TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '5' MINUTE ELSE NULL END AS suspended_on,
       'USER_DEFINED' AS lag_type, CAST(60 + p_size AS BIGINT) AS target_lag,
       CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size * 3 AS BIGINT) END AS mean_lag, CAST(p_size * 4 AS BIGINT) AS max_lag,
       CAST(p_size % 30 AS BIGINT) AS time_above, p_partkey % 100 AS within_points,
       'acc-' || CAST(p_partkey % 3 AS STRING) AS account
FROM part
"""

FRAMES["dynamic_refreshes"] = """
SELECT l_orderkey * 10 + CAST(l_linenumber AS BIGINT) AS row_no, 'Brand_' || CAST(l_partkey % 25 AS STRING) AS database_name, 'S' AS schema_name,
       'DT_' || CAST(l_partkey % 40 AS STRING) AS table_name,
       'Brand_' || CAST(l_partkey % 25 AS STRING) || '.ECONOMY.DT_' || CAST(l_partkey % 40 AS STRING) AS full_name,
       l_shipdate AS data_timestamp, l_shipdate + CAST(l_quantity AS BIGINT) * INTERVAL '1' SECOND AS refresh_start,
       l_shipdate + CAST(l_quantity * 2 AS BIGINT) * INTERVAL '1' SECOND AS refresh_end,
       CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'SUCCEEDED' ELSE 'SKIPPED' END AS state,
       CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'INCREMENTAL' ELSE 'FULL' END AS refresh_action,
       'SCHEDULED' AS refresh_trigger, CASE WHEN l_returnflag = 'R' THEN 'E' || CAST(l_suppkey % 5 AS STRING) ELSE NULL END AS state_code,
       CAST(l_quantity AS BIGINT) AS inserted_rows, l_suppkey AS deleted_rows, CAST(NULL AS BIGINT) AS copied_rows, l_partkey % 9 AS added_partitions,
       'acc-' || CAST(l_suppkey % 3 AS STRING) AS account
FROM lineitem
"""

FRAMES["pipes"] = """
SELECT s_suppkey AS pipe_id, 'DB_' || CAST(s_nationkey % 5 AS STRING) AS database_name, 'RAW' AS schema_name, 'PIPE_' || CAST(s_suppkey AS STRING) AS pipe_name,
       'DB_' || CAST(s_nationkey % 5 AS STRING) || '.RAW.PIPE_' || CAST(s_suppkey AS STRING) AS full_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'COPY INTO DB.RAW.T_' || CAST(s_suppkey AS STRING) || ' FROM @stage'
            WHEN 1 THEN 'copy  into t_' || CAST(s_suppkey AS STRING) || ' from @s' WHEN 2 THEN 'bad definition' ELSE NULL END AS definition,
       'OWNER_' || CAST(s_suppkey % 3 AS STRING) AS owner,
       TIMESTAMP '2023-06-01 00:00:00' + s_suppkey * INTERVAL '1' HOUR AS created_on,
       CASE WHEN s_suppkey % 10 = 9 THEN NULL
            ELSE '{"executionState":"' || CASE s_suppkey % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'PAUSED' ELSE 'STALLED' END || '"'
              || CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE ',"pendingFileCount":' || CAST(s_suppkey % 13 AS STRING) END
              || CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE ',"oldestFileTimestamp":"2024-01-30T0' || CAST(s_suppkey % 10 AS STRING) || ':00:00.000Z"' END || '}' END AS status_json
FROM supplier
"""

FRAMES["copy_history"] = """
SELECT l_orderkey * 10 + CAST(l_linenumber AS BIGINT) AS load_id, 'PIPE_' || CAST(l_suppkey AS STRING) AS pipe_name,
       CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE 'PIPE_' || CAST(l_suppkey AS STRING) END AS pipe_or_null,
       'DB_' || CAST(l_suppkey % 5 AS STRING) AS database_name, 'RAW' AS schema_name, 'T_' || CAST(l_partkey % 60 AS STRING) AS table_name,
       'f_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS file_name,
       CASE l_returnflag WHEN 'R' THEN 'Load failed' WHEN 'A' THEN 'Partially loaded' ELSE 'Loaded' END AS status,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS received_at,
       l_shipdate + CAST(l_quantity AS BIGINT) * INTERVAL '1' SECOND AS loaded_at,
       l_partkey AS row_count, l_partkey + 1 AS row_parsed, CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_suppkey % 4 END AS error_count,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS file_size, CAST(l_quantity AS BIGINT) * 1000 AS latency_ms,
       CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS pipe_errors,
       'acc-' || CAST(l_suppkey % 3 AS STRING) AS account
FROM lineitem
"""

FRAMES["pipe_usage"] = """
SELECT o_orderkey AS usage_id, o_custkey % 120 AS pipe_id, 'ID-' || CAST(o_custkey % 120 AS STRING) AS pipe_name, o_orderdate AS start_time,
       o_orderdate + INTERVAL '1' HOUR AS end_time, o_orderkey % 50 AS credits_used, CAST(round(o_totalprice * 100) AS BIGINT) AS bytes_billed,
       CAST(o_orderkey % 9 AS STRING) AS files_inserted, 'acc-' || CAST(o_custkey % 3 AS STRING) AS account
FROM orders
"""

FRAMES["pipe_log"] = """
SELECT event_id, ts, account, 'PIPE_' || CAST(user_id % 30 AS STRING) AS pipe_name,
       CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'PAUSED' WHEN 'error' THEN NULL ELSE 'STALLED' END AS pipe_status,
       k AS pending_files
FROM event_rows
"""

FRAMES["serverless_tasks"] = """
SELECT o_orderkey AS row_no, 'TASK_' || CAST(o_custkey % 30 AS STRING) AS task_name, 'S' AS schema_name,
       CASE WHEN o_custkey % 30 = 29 THEN NULL ELSE 'DB_' || CAST(o_custkey % 5 AS STRING) END AS database_name,
       o_orderdate AS start_time, o_orderdate + INTERVAL '20' MINUTE AS end_time, CAST(round(o_totalprice * 100) AS BIGINT) AS credits_used,
       'acc-' || CAST(o_custkey % 3 AS STRING) AS account
FROM orders
"""

FRAMES["task_history"] = """
SELECT event_id, 'DB_' || CAST(user_id % 5 AS STRING) AS database_name, 'S' AS schema_name, 'TASK_' || CAST(user_id % 30 AS STRING) AS task_name, account,
       CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SCHEDULED' WHEN 'view' THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS state,
       CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS query_start_time, ts - (k % 60) * INTERVAL '1' SECOND AS scheduled_time,
       CASE WHEN event_type = 'signup' THEN NULL ELSE ts + k * INTERVAL '1' SECOND END AS completed_time,
       1 + k % 3 AS attempt, CASE WHEN event_type = 'error' THEN 'E' || CAST(k % 7 AS STRING) ELSE NULL END AS error_code, ts
FROM event_rows
"""

FRAMES["task_versions"] = """
SELECT p_partkey AS row_no, 'TASK_' || CAST(p_partkey % 30 AS STRING) AS task_name, 'S' AS schema_name, replace(p_brand, '#', '_') AS database_name,
       'select ' || CAST(p_size AS STRING) AS definition, CAST(p_size AS BIGINT) AS graph_version,
       TIMESTAMP '2024-01-01 00:00:00' + p_partkey * INTERVAL '3' MINUTE AS created_on,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE TIMESTAMP '2024-01-02 00:00:00' + p_partkey * INTERVAL '2' MINUTE END AS committed_on,
       CASE WHEN p_partkey % 4 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE NULL END AS suspended_on
FROM part
"""

FRAMES["shares"] = """
SELECT 'SH_' || CAST(s_suppkey AS STRING) AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'OUTBOUND' ELSE 'INBOUND' END AS kind,
       'DB_' || CAST(s_nationkey AS STRING) AS database_name, 'ORG.ACC' || CAST(s_suppkey % 4 AS STRING) AS owner_account, 'TO_' || CAST(s_suppkey % 3 AS STRING) AS given_to,
       'OWNER_' || CAST(s_suppkey % 3 AS STRING) AS owner, CASE WHEN s_suppkey % 4 = 0 THEN 'note ' || CAST(s_suppkey AS STRING) WHEN s_suppkey % 4 = 1 THEN '' ELSE NULL END AS comment,
       CASE s_suppkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'unknown' END AS secure_objects_only,
       TIMESTAMP '2023-01-01 00:00:00' + s_suppkey * INTERVAL '1' DAY AS created_on, 'acc-' || CAST(s_suppkey % 3 AS STRING) AS account
FROM supplier
"""

FRAMES["share_grants"] = """
SELECT c_custkey AS grant_no, 'SH_' || CAST(c_custkey % 120 AS STRING) AS share_name, 'G_' || c_mktsegment AS grant_name,
       CASE c_custkey % 3 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'USAGE' ELSE NULL END AS privilege, 'TABLE' AS granted_on, 'SHARE' AS granted_to,
       'ACC_' || CAST(c_nationkey AS STRING) AS grantee, 'ADMIN_' || CAST(c_custkey % 2 AS STRING) AS granted_by,
       TIMESTAMP '2023-05-01 00:00:00' + c_custkey * INTERVAL '1' HOUR AS created_on
FROM customer
"""

FRAMES["share_tables"] = """
SELECT p_partkey AS table_no, 'SH_' || CAST(p_partkey % 150 AS STRING) AS share_name, 'DB_X' || CAST(p_partkey % 9 AS STRING) AS database_name,
       p_type AS table_schema, 'T_' || CAST(p_partkey AS STRING) AS table_name,
       CASE WHEN p_partkey % 25 = 0 THEN 'UNAVAILABLE' ELSE NULL END AS share_status, CAST(p_size AS BIGINT) AS row_count, CAST(round(p_retailprice * 100) AS BIGINT) AS bytes,
       CASE WHEN p_partkey % 25 = 0 THEN 'access revoked' ELSE NULL END AS error_message
FROM part
"""

FRAMES["share_log"] = """
SELECT event_id, ts, CASE WHEN event_type IN ('click', 'view') THEN 'outbound_shares' ELSE 'inbound_shares' END AS context,
       CASE WHEN event_type IN ('click', 'view') THEN 'OUTBOUND' ELSE 'INBOUND' END AS kind,
       CASE WHEN k = 77 THEN NULL ELSE 'SH_' || CAST(user_id % 35 AS STRING) END AS share_name, account,
       CASE WHEN k % 8 = 0 THEN NULL ELSE 'DB_' || CAST(user_id % 6 AS STRING) END AS database_name,
       'T_' || CAST(k % 12 AS STRING) AS table_name, 'OWNER_' || CAST(k % 3 AS STRING) AS owner,
       CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE NULL END AS is_secure,
       CASE WHEN k % 17 = 0 THEN 'UNAVAILABLE' ELSE NULL END AS share_status, CASE WHEN k % 17 = 0 THEN 'gone ' || CAST(k AS STRING) ELSE NULL END AS error_message,
       CASE WHEN k % 5 = 0 THEN NULL ELSE amount END AS row_count, amount * 8 AS bytes,
       CASE k % 4 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'USAGE' ELSE NULL END AS privilege, 'G_' || CAST(k % 6 AS STRING) AS grant_name,
       CASE WHEN k % 6 = 0 THEN NULL ELSE 'ACC_' || CAST(user_id % 9 AS STRING) END AS grantee, 'TABLE' AS granted_on, 'ADMIN_' || CAST(k % 2 AS STRING) AS granted_by
FROM event_rows
"""

# --- spans, texts, vectors -----------------------------------------------------------------

FRAMES["span_rows"] = """
SELECT 'C' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS span_id,
       CASE WHEN turn = 0 THEN NULL WHEN turn % 3 = 0 THEN 'C' || CAST(conv_id AS STRING) || '-' || CAST(turn - 2 AS STRING)
            ELSE 'C' || CAST(conv_id AS STRING) || '-' || CAST(turn - 1 AS STRING) END AS parent_id,
       md5('t' || CAST(conv_id AS STRING)) AS own_trace, conv_id, turn, role AS name, CAST(length(text) AS BIGINT) AS elapsed,
       CASE WHEN conv_id % 9 = 4 AND turn = 2 THEN 'run-x' ELSE 'run-' || CAST(conv_id % 5 AS STRING) END AS run_id
FROM conversations
"""

FRAMES["user_log"] = """
SELECT user_id, login_name, account, user_type, owner, has_password, has_mfa, has_rsa, has_pat, is_disabled, is_locked
FROM user_snapshot
"""
