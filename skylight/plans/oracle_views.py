"""The derived tables as SQL, for the DuckDB oracle.

These texts are an independent statement of ``skylight.sources.fixtures``
(window functions here, aggregates + joins and blocked scans there).  An
oracle query names the views it reads; ``with_views`` inlines them as CTEs
so the text runs on the pre-registered base tables alone.
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "logs": """
SELECT event_id, ts, CAST(ts AS DATE) AS log_date,
  CASE event_type WHEN 'error' THEN 'ERROR upstream call failed ' WHEN 'signup' THEN 'WARNING slow signup '
    WHEN 'view' THEN 'debug page rendered ' WHEN 'purchase' THEN 'order placed 100% ok ' ELSE 'click_handled ' END || props AS log,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN ' WARN ' WHEN 'view' THEN '' END AS log_level,
  'ns-' || CAST(user_id % 3 AS STRING) AS namespace, 'proj-' || CAST(user_id % 5 AS STRING) AS project_uid,
  'env-' || CAST(user_id % 2 AS STRING) AS environment_uid, 'comp-' || CAST(user_id % 10 AS STRING) AS component_uid,
  'run-' || CAST(user_id % 7 AS STRING) || '-step-' || CAST(event_id % 4 AS STRING) AS pod_name,
  'workflows-ns-' || CAST(user_id % 3 AS STRING) AS pod_namespace,
  CASE event_id % 20 WHEN 0 THEN 'init' WHEN 1 THEN 'wait' ELSE 'main' END AS container_name,
  'run-' || CAST(user_id % 7 AS STRING) AS workflow_run, 'step-' || CAST(event_id % 4 AS STRING) AS step_name
FROM events""",
    "spans": """
SELECT event_id, ts AS start_ts, CAST(ts AS DATE) AS span_date,
  'trace-' || CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS trace_id,
  'span-' || CAST(event_id AS STRING) AS span_id,
  CASE WHEN event_id > min(event_id) OVER w THEN 'span-' || CAST(min(event_id) OVER w AS STRING)
       WHEN event_id % 10 = 0 THEN 'span-lost' WHEN event_id % 10 = 1 THEN NULL ELSE '' END AS parent_span_id,
  event_type AS name, CASE WHEN event_type IN ('click', 'view') THEN 'SERVER' ELSE 'CLIENT' END AS kind,
  CASE event_type WHEN 'error' THEN 'Error' WHEN 'purchase' THEN 'OK' END AS status_code,
  CAST(round(value * 1000) AS BIGINT) * 1000 AS duration_ns,
  'ns-' || CAST(user_id % 3 AS STRING) AS namespace, 'proj-' || CAST(user_id % 5 AS STRING) AS project_uid,
  'env-' || CAST(user_id % 2 AS STRING) AS environment_uid, 'comp-' || CAST(user_id % 10 AS STRING) AS component_uid, props,
  epoch_us(ts) * 1000 AS start_ns,
  epoch_us(ts) * 1000 + CAST(round(value * 1000) AS BIGINT) * 1000 AS end_ns,
  'pod-' || CAST(user_id AS STRING) AS pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS pod_namespace
FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE))""",
    "pods": """
SELECT DISTINCT 'pod-' || CAST(user_id AS STRING) AS pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS pod_namespace,
  'ns-' || CAST(user_id % 3 AS STRING) AS namespace, 'proj-' || CAST(user_id % 5 AS STRING) AS project_uid,
  'env-' || CAST(user_id % 2 AS STRING) AS environment_uid, 'comp-' || CAST(user_id % 10 AS STRING) AS component_uid
FROM events""",
    "cpu_samples": """
SELECT 'pod-' || CAST(user_id AS STRING) AS pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS pod_namespace,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'main' ELSE 'side' END AS container, ts,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id, CAST(ts AS DATE), CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'main' ELSE 'side' END ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(100 AS DOUBLE) AS value
FROM events""",
    "gauge_samples": """
SELECT 'pod-' || CAST(user_id AS STRING) AS pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS pod_namespace,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'main' ELSE 'side' END AS container, ts,
  round(value * 1000000) AS memory_bytes, CAST(1 + user_id % 4 AS DOUBLE) AS cpu_limit, CAST(500000000 AS DOUBLE) AS memory_limit,
  CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS phase_running,
  CAST(1 + user_id % 4 AS DOUBLE) / CAST(2 AS DOUBLE) AS cpu_request, CAST(250000000 AS DOUBLE) AS memory_request
FROM events""",
    "http_samples": """
SELECT 'pod-' || CAST(user_id AS STRING) AS destination_pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS destination_namespace,
  CASE WHEN event_id % 3 = 0 THEN 'server' ELSE 'client' END AS reporter, status, ts, CAST(row_number() OVER (PARTITION BY user_id, status, CASE WHEN event_id % 3 = 0 THEN 'server' ELSE 'client' END ORDER BY event_id) AS DOUBLE) AS value
FROM (SELECT *, CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '404' WHEN 'purchase' THEN '201' WHEN 'click' THEN '302' ELSE '200' END AS status FROM events) e""",
    "http_buckets": """
SELECT 'pod-' || CAST(user_id AS STRING) AS destination_pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS destination_namespace,
  CASE WHEN event_id % 3 = 0 THEN 'server' ELSE 'client' END AS reporter, ts, b.le,
  CAST(sum(CASE WHEN value <= b.le THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, CASE WHEN event_id % 3 = 0 THEN 'server' ELSE 'client' END, b.le ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
FROM events CROSS JOIN (SELECT CAST(le AS DOUBLE) AS le FROM (VALUES ('10'), ('50'), ('100'), ('500'), ('Infinity')) AS v(le)) b""",
    "http_duration_sum": """
SELECT 'pod-' || CAST(user_id AS STRING) AS destination_pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS destination_namespace,
  CASE WHEN event_id % 3 = 0 THEN 'server' ELSE 'client' END AS reporter, ts,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id, CASE WHEN event_id % 3 = 0 THEN 'server' ELSE 'client' END ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(100000 AS DOUBLE) AS value
FROM events""",
    "rules": """
SELECT rule_name, namespace, component_uid, project_uid, environment_uid, phrase, op, threshold,
  CAST(window_min AS BIGINT) AS window_min, CAST(interval_min AS BIGINT) AS interval_min, enabled FROM (VALUES
  ('r-errors', 'ns-0', 'comp-0', 'proj-0', 'env-0', 'ERROR', 'gt', CAST(0 AS DOUBLE), 1440, 360, true),
  ('r-quiet',  'ns-0', 'comp-0', 'proj-0', 'env-0', 'order', 'lte', CAST(0 AS DOUBLE), 720, 360, true),
  ('r-off',    'ns-1', 'comp-1', 'proj-1', 'env-1', 'WARNING', 'gte', CAST(1 AS DOUBLE), 360, 60, false))
  AS t(rule_name, namespace, component_uid, project_uid, environment_uid, phrase, op, threshold, window_min, interval_min, enabled)""",
    "webhooks": """
SELECT event_id, ts AS received_at, CASE event_id % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'sql' ELSE 'metrics' END AS shape,
  CASE event_id % 3
   WHEN 0 THEN '{"ruleName":"r-errors","ruleNamespace":"ns-0","alertValue":' || CAST(event_id AS STRING) || ',"alertTimestamp":"2024-01-02T03:04:05Z"}'
   WHEN 1 THEN '{"alertName":"r-quiet","alertCount":"' || CAST(event_id AS STRING) || '","alertTriggerTimeMicroSeconds":"1704164645000000"}'
   ELSE '{"alerts":[{"status":"' || CASE WHEN event_id % 2 = 0 THEN ' Firing' ELSE 'resolved' END || '","startsAt":"2024-01-02T03:04:05Z","annotations":{"rule_name":"r-cpu","rule_namespace":"ns-1","alert_value":"91.50"}}]}'
  END AS body
FROM events""",
}

_ORDER = list(VIEW_SQL)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every derived view it mentions.

    A query that starts with its own ``WITH`` gets the views prepended to
    that same WITH list.
    """
    body = sql.strip()
    # strip the query's own CTE names from the lookup so they are not confused with views
    used = [v for v in _ORDER if re.search(rf"\b{v}\b", body)]
    if not used:
        return body
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in used)
    if re.match(r"(?is)^with\s+recursive\s", body):
        return "WITH RECURSIVE " + ctes + ",\n" + body[len("WITH RECURSIVE"):].lstrip()
    if re.match(r"(?is)^with\s", body):
        return "WITH " + ctes + ",\n" + body[4:].lstrip()
    return "WITH " + ctes + "\n" + body
