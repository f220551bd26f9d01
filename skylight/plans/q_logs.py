"""Registered log queries (L1-L16) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylight.functions.ids import map_text, uuid_like_from, uuid_or_null
from skylight.functions.levels import effective_level, level_from_text
from skylight.functions.scope import Scope
from skylight.operators import logs as L
from skylight.plans import params as P
from skylight.plans.registry import register
from skylight.sources.fixtures import Views

S, E, NS = P.LOG_START, P.LOG_END, P.LOG_NAMESPACE
# Bounds equal to the timestamps of events 1000 and 1500 at sf0.01, to pin exclusivity.
EDGE_S, EDGE_E = "2024-01-03 21:05:34.687555", "2024-01-05 09:20:53.148449"


def _lvl_sql(log: str = "log", variant: str = "search") -> str:
    probes = ["ERROR", "FATAL", "SEVERE", "WARN", "WARNING", "INFO", "DEBUG"]
    if variant == "search":
        probes.append("UNDEFINED")
    arms = " ".join(
        f"WHEN contains(upper({log}), '{p}') THEN '{'WARN' if p == 'WARNING' else p}'" for p in probes)
    return f"CASE {arms} ELSE 'INFO' END"


LVL_SEARCH = _lvl_sql()
LVL_SQL = ("CASE WHEN trim(log_level) IS NOT NULL AND trim(log_level) <> '' THEN trim(log_level) ELSE "
           + _lvl_sql("log", "sql") + " END")
ENTRY = ("event_id, ts, log, namespace, project_uid, environment_uid, component_uid, pod_name, "
         "pod_namespace, container_name")
EXCL = f"ts > TIMESTAMP '{S}' AND ts < TIMESTAMP '{E}'"
HALF = f"ts >= TIMESTAMP '{S}' AND ts < TIMESTAMP '{E}'"


def _logs(spark, sf_dir):
    return Views(spark, sf_dir).logs()


@register("logs_component_search", oracle=f"""
SELECT {ENTRY}, {LVL_SEARCH} AS level FROM logs
WHERE namespace = '{NS}' AND project_uid = 'proj-1' AND environment_uid = 'env-1' AND {EXCL}
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_component_search(spark, sf_dir):
    return L.search_logs(_logs(spark, sf_dir), Scope(NS, project="proj-1", environment="env-1"), S, E)


@register("logs_time_range_exclusive", oracle=f"""
SELECT count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM logs
WHERE ts > TIMESTAMP '{EDGE_S}' AND ts < TIMESTAMP '{EDGE_E}'""")
def logs_time_range_exclusive(spark, sf_dir):
    f = _logs(spark, sf_dir).filter(L.time_range_exclusive(EDGE_S, EDGE_E))
    return f.agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
                 F.max("event_id").alias("last_id"))


@register("logs_scope_filter", oracle=f"""
SELECT event_id, component_uid FROM logs
WHERE namespace = '{NS}' AND component_uid IN ('comp-1', 'comp-4') AND environment_uid = 'env-1' AND {HALF}""")
def logs_scope_filter(spark, sf_dir):
    scope = Scope(NS, component=["comp-1", "comp-4"], environment="env-1")
    return _logs(spark, sf_dir).filter(scope.predicate() & L.time_range_half_open(S, E)).select(
        "event_id", "component_uid")


@register("logs_phrase_literal", oracle=f"""
SELECT {ENTRY}, {LVL_SEARCH} AS level FROM logs
WHERE namespace = '{NS}' AND {EXCL} AND contains(log, '100%')
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_phrase_literal(spark, sf_dir):
    return L.search_logs(_logs(spark, sf_dir), Scope(NS), S, E, phrase="100%")


@register("logs_phrase_like", oracle=f"""
SELECT {ENTRY}, {LVL_SQL} AS level FROM logs
WHERE namespace = '{NS}' AND {HALF} AND log LIKE '%d_r%'
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_phrase_like(spark, sf_dir):
    # '_' is a wildcard here: matches "order", "rendered" ... not only a literal "d_r"
    return L.search_logs(_logs(spark, sf_dir), Scope(NS), S, E, phrase="d_r", store="sql")


@register("logs_level_text_any", oracle=f"""
SELECT {ENTRY}, {LVL_SEARCH} AS level FROM logs
WHERE namespace = '{NS}' AND {EXCL} AND (contains(upper(log), 'WARN') OR contains(upper(log), 'DEBUG'))
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_level_text_any(spark, sf_dir):
    return L.search_logs(_logs(spark, sf_dir), Scope(NS), S, E, levels=["warn", "DEBUG"])


@register("logs_level_column_any", oracle=f"""
SELECT {ENTRY}, {LVL_SQL} AS level FROM logs
WHERE namespace = '{NS}' AND {HALF} AND log_level IN ('ERROR', 'WARN')
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_level_column_any(spark, sf_dir):
    return L.search_logs(_logs(spark, sf_dir), Scope(NS), S, E, levels=["ERROR", "WARN"], store="sql")


@register("log_level_extract", oracle=f"""
SELECT event_id, {LVL_SEARCH} AS level_search, {LVL_SQL} AS level_sql FROM logs""")
def log_level_extract(spark, sf_dir):
    return _logs(spark, sf_dir).select(
        "event_id", level_from_text("log", "search").alias("level_search"),
        effective_level("log", "log_level").alias("level_sql"))


@register("log_level_histogram", oracle=f"""
SELECT {LVL_SQL} AS level, count(*) AS n FROM logs GROUP BY 1""")
def log_level_histogram(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    return lg.groupBy(effective_level("log", "log_level").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@register("log_entry_projection", oracle=f"""
SELECT event_id, ts, log, {LVL_SEARCH} AS level, component_uid, environment_uid, project_uid, namespace,
  pod_namespace, pod_name, container_name FROM logs""")
def log_entry_projection(spark, sf_dir):
    docs = L.to_log_documents(_logs(spark, sf_dir))
    return L.project_entries(docs)


_MD5U = ("(substr(md5(CAST(event_id AS STRING)), 1, 8) || '-' || substr(md5(CAST(event_id AS STRING)), 9, 4) || '-' || "
         "substr(md5(CAST(event_id AS STRING)), 13, 4) || '-' || substr(md5(CAST(event_id AS STRING)), 17, 4) || '-' || "
         "substr(md5(CAST(event_id AS STRING)), 21, 12))")


@register("uuid_or_null", oracle=f"""
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE {_MD5U} END AS component_uuid FROM logs""")
def uuid_or_null_q(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    u = uuid_like_from(F.col("event_id"))
    m4 = F.col("event_id") % F.lit(4).cast("bigint")
    cand = (F.when(m4 == 0, u).when(m4 == 1, F.upper(F.regexp_replace(u, "-", "")))
            .when(m4 == 2, F.concat(F.lit("{"), u, F.lit("}"))).otherwise(F.col("component_uid")))
    return lg.select("event_id", uuid_or_null(cand).alias("component_uuid"))


@register("logs_workflow_prefix", oracle=f"""
SELECT event_id, ts, log, pod_name, container_name, {LVL_SEARCH} AS level FROM logs
WHERE starts_with(pod_name, 'run-3') AND contains(step_name, 'step-1') AND {EXCL}
  AND pod_namespace = 'workflows-ns-0' AND container_name NOT IN ('init', 'wait')
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_workflow_prefix(spark, sf_dir):
    return L.workflow_logs_by_prefix(_logs(spark, sf_dir), "run-3", "ns-0", S, E, step="step-1")


@register("logs_workflow_label", oracle=f"""
SELECT event_id, ts, log, pod_name, container_name, {LVL_SQL} AS level FROM logs
WHERE workflow_run = 'run-3' AND pod_namespace = 'workflows-ns-0' AND {HALF} AND log LIKE '%order%'
ORDER BY ts DESC, event_id LIMIT 100""")
def logs_workflow_label(spark, sf_dir):
    return L.workflow_logs_by_label(_logs(spark, sf_dir), "run-3", "ns-0", S, E, phrase="order")


@register("workflow_log_metadata", oracle="""
SELECT ts, log, array_to_string(list_sort(list_filter(['container_name=' || container_name, 'log_level=' || log_level,
  'pod_name=' || pod_name, 'step_name=' || step_name], lambda x: x IS NOT NULL)), ';') AS metadata
FROM logs WHERE workflow_run = 'run-3'""")
def workflow_log_metadata(spark, sf_dir):
    lg = _logs(spark, sf_dir).filter(F.col("workflow_run") == "run-3")
    m = L.workflow_metadata(lg.select("ts", "log", "pod_name", "container_name", "step_name", "log_level"))
    return m.withColumn("metadata", map_text("metadata"))


@register("logs_component_total", oracle=f"""
SELECT count(*) AS total FROM logs WHERE namespace = '{NS}' AND environment_uid = 'env-1' AND {HALF}
  AND log LIKE '%ok%'""")
def logs_component_total(spark, sf_dir):
    cond = L.component_filter(Scope(NS, environment="env-1"), S, E, phrase="ok", store="sql")
    return L.count_logs(_logs(spark, sf_dir), cond)


@register("logs_workflow_total", oracle=f"""
SELECT count(*) AS total FROM logs WHERE workflow_run = 'run-3' AND pod_namespace = 'workflows-ns-0' AND {HALF}""")
def logs_workflow_total(spark, sf_dir):
    return L.count_logs(_logs(spark, sf_dir), L.workflow_label_filter("run-3", "ns-0", S, E))


@register("logs_oldest_first", oracle=f"""
SELECT {ENTRY}, {LVL_SEARCH} AS level FROM logs WHERE namespace = '{NS}' AND {EXCL}
ORDER BY ts ASC, event_id LIMIT 100""")
def logs_oldest_first(spark, sf_dir):
    # limit 0 means "unset": the default page of 100 applies
    return L.search_logs(_logs(spark, sf_dir), Scope(NS), S, E, limit=0, order="asc")


@register("logs_pruned_days", oracle=f"""
SELECT log_date, count(*) AS n FROM logs WHERE namespace = '{NS}' AND {EXCL} GROUP BY log_date""")
def logs_pruned_days(spark, sf_dir):
    cond = L.component_filter(Scope(NS), S, E, prune_days=True)
    return _logs(spark, sf_dir).filter(cond).groupBy("log_date").agg(F.count(F.lit(1)).alias("n"))
