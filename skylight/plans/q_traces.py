"""Registered trace queries (T1-T14) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylight.functions.ids import map_text
from skylight.functions.scope import Scope
from skylight.operators import traces as T
from skylight.plans import params as P
from skylight.plans.registry import register
from skylight.sources.fixtures import Views

S, E, NS = P.TRACE_START, P.TRACE_END, P.TRACE_NAMESPACE
TRACE_ID = "trace-7-2024-01-15"
SPAN_ID = "span-4760"
_E_NS = "epoch_us(TIMESTAMP '%s') * 1000" % E
_IN_TIME = f"start_ts >= TIMESTAMP '{S}' AND end_ns <= {_E_NS}"
_STATUS = "CASE WHEN lower(status_code) IN ('ok', 'error') THEN lower(status_code) ELSE 'unset' END"


@register("trace_list", oracle=f"""
WITH s AS (SELECT * FROM spans WHERE namespace = '{NS}' AND {_IN_TIME}),
r AS (SELECT trace_id, span_id, name, kind,
        row_number() OVER (PARTITION BY trace_id ORDER BY CASE WHEN parent_span_id = '' THEN 0 ELSE 1 END,
                           start_ns, span_id) AS rn FROM s),
g AS (SELECT trace_id, count(*) AS span_count, min(start_ns) AS start_ns, max(end_ns) AS end_ns,
        coalesce(bool_or(lower(status_code) = 'error'), false) AS has_errors FROM s GROUP BY trace_id)
SELECT g.trace_id, r.name AS trace_name, g.span_count, r.span_id AS root_span_id, r.name AS root_span_name,
  r.kind AS root_span_kind, g.start_ns, g.end_ns, g.end_ns - g.start_ns AS duration_ns, g.has_errors
FROM g JOIN r ON r.trace_id = g.trace_id AND r.rn = 1
ORDER BY g.start_ns DESC, g.trace_id LIMIT 20""")
def trace_list(spark, sf_dir):
    return T.list_traces(Views(spark, sf_dir).spans(), Scope(NS), S, E, limit=20, order="desc")


@register("trace_root_span", oracle="""
SELECT trace_id, span_id AS root_span_id, name AS root_span_name, kind AS root_span_kind FROM (
  SELECT trace_id, span_id, name, kind, row_number() OVER (PARTITION BY trace_id
    ORDER BY CASE WHEN parent_span_id = '' THEN 0 ELSE 1 END, start_ns, span_id) AS rn FROM spans) t
WHERE rn = 1""")
def trace_root_span(spark, sf_dir):
    r = T.rollup_traces(Views(spark, sf_dir).spans())
    return r.select("trace_id", "root_span_id", "root_span_name", "root_span_kind")


@register("trace_list_span_page", oracle=f"""
WITH page AS (SELECT *, row_number() OVER (ORDER BY start_ns DESC, span_id) AS rn FROM spans
  WHERE namespace = '{NS}' AND start_ts >= TIMESTAMP '{S}' AND start_ts < TIMESTAMP '{E}'
  ORDER BY start_ns DESC, span_id LIMIT 100),
p AS (SELECT * FROM page WHERE trace_id IS NOT NULL AND trim(trace_id) <> ''),
roots AS (SELECT trace_id, span_id, name, kind, row_number() OVER (PARTITION BY trace_id ORDER BY rn DESC) AS k
  FROM p WHERE parent_span_id IS NULL OR parent_span_id = '')
SELECT g.trace_id, g.first_seen, g.span_count, roots.span_id AS root_span_id, roots.name AS root_span_name,
  roots.kind AS root_span_kind, g.start_ns, g.end_ns, g.end_ns - g.start_ns AS duration_ns, g.has_errors
FROM (SELECT trace_id, min(rn) AS first_seen, count(*) AS span_count, min(start_ns) AS start_ns, max(end_ns) AS end_ns,
        coalesce(bool_or(lower(status_code) = 'error'), false) AS has_errors FROM p GROUP BY trace_id) g
LEFT JOIN roots ON roots.trace_id = g.trace_id AND roots.k = 1""")
def trace_list_span_page(spark, sf_dir):
    return T.list_traces_span_page(Views(spark, sf_dir).spans(), Scope(NS), S, E, limit=100)


@register("trace_error_rollup", oracle="""
SELECT trace_id, CAST(sum(CASE WHEN lower(status_code) = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_spans,
  coalesce(bool_or(lower(status_code) = 'error'), false) AS has_errors
FROM spans GROUP BY trace_id""")
def trace_error_rollup(spark, sf_dir):
    s = Views(spark, sf_dir).spans()
    return s.groupBy("trace_id").agg(
        F.sum(T.is_error().cast("bigint")).alias("error_spans"),
        F.max(T.is_error()).alias("has_errors"))


@register("trace_total_capped", oracle=f"""
SELECT least(count(DISTINCT trace_id), 10000) AS total FROM spans WHERE namespace = '{NS}' AND {_IN_TIME}""")
def trace_total_capped(spark, sf_dir):
    # exact mode so the oracle can check it; exact=False gives the HLL++ form
    return T.trace_total(Views(spark, sf_dir).spans(), Scope(NS), S, E, exact=True)


@register("trace_total_exact", oracle=f"""
SELECT count(DISTINCT trace_id) AS total FROM spans
WHERE namespace = '{NS}' AND start_ts >= TIMESTAMP '{S}' AND start_ts < TIMESTAMP '{E}'""")
def trace_total_exact(spark, sf_dir):
    return T.trace_total_exact(Views(spark, sf_dir).spans(), Scope(NS), S, E)


_SPAN_COLS = f"""span_id, trace_id, parent_span_id, name, kind, start_ns, end_ns,
  coalesce(end_ns - start_ns, 0) AS duration_ns, {_STATUS} AS status"""


@register("trace_spans", oracle=f"""
SELECT {_SPAN_COLS} FROM spans WHERE trace_id = '{TRACE_ID}' AND namespace = '{NS}' AND {_IN_TIME}
ORDER BY start_ns, span_id LIMIT 20""")
def trace_spans(spark, sf_dir):
    return T.trace_spans(Views(spark, sf_dir).spans(), TRACE_ID, Scope(NS), S, E, limit=20)


@register("trace_spans_page", oracle=f"""
SELECT {_SPAN_COLS} FROM spans WHERE trace_id = '{TRACE_ID}' AND start_ts >= TIMESTAMP '{S}' AND start_ts < TIMESTAMP '{E}'
ORDER BY start_ns, span_id LIMIT 100""")
def trace_spans_page(spark, sf_dir):
    return T.trace_spans_page(Views(spark, sf_dir).spans(), TRACE_ID, S, E, limit=100)


@register("trace_span_total", oracle=f"""
SELECT count(*) AS span_count FROM spans WHERE trace_id = '{TRACE_ID}'""")
def trace_span_total(spark, sf_dir):
    return T.span_total(Views(spark, sf_dir).spans(), TRACE_ID)


@register("trace_span_total_scoped", oracle=f"""
SELECT 'inside' AS scope, count(*) AS span_count FROM spans
WHERE trace_id = '{TRACE_ID}' AND namespace = 'ns-1' AND {_IN_TIME}
UNION ALL
SELECT 'outside', count(*) FROM spans WHERE trace_id = '{TRACE_ID}' AND namespace = 'ns-2' AND {_IN_TIME}""")
def trace_span_total_scoped(spark, sf_dir):
    spans = Views(spark, sf_dir).spans()
    inside, outside = (T.span_total(spans, TRACE_ID, Scope(ns), S, E).withColumn("scope", F.lit(name))
                       for name, ns in (("inside", "ns-1"), ("outside", "ns-2")))
    return inside.unionByName(outside).select("scope", "span_count")


@register("span_detail", oracle=f"""
SELECT trace_id, span_id, parent_span_id, name, kind, start_ns, end_ns,
  coalesce(end_ns - start_ns, 0) AS duration_ns, {_STATUS} AS status
FROM spans WHERE trace_id = '{TRACE_ID}' AND span_id = '{SPAN_ID}' LIMIT 1""")
def span_detail(spark, sf_dir):
    return T.span_detail(Views(spark, sf_dir).spans(), TRACE_ID, SPAN_ID)


_ATTRS = ["namespace", "project_uid", "environment_uid", "component_uid", "props", "service_name",
          "resource_host"]


@register("span_attributes_unpivot", oracle="""
WITH a AS (SELECT span_id, namespace, project_uid, environment_uid, component_uid, props,
    'svc-' || component_uid AS service_name, 'host-' || namespace AS resource_host FROM spans)
SELECT span_id, attr_key, attr_value, starts_with(attr_key, 'service') OR starts_with(attr_key, 'resource') AS is_resource
FROM (UNPIVOT a ON namespace, project_uid, environment_uid, component_uid, props, service_name, resource_host
      INTO NAME attr_key VALUE attr_value) u
WHERE attr_value IS NOT NULL""")
def span_attributes_unpivot(spark, sf_dir):
    s = Views(spark, sf_dir).spans().withColumn(
        "service_name", F.concat(F.lit("svc-"), F.col("component_uid"))).withColumn(
        "resource_host", F.concat(F.lit("host-"), F.col("namespace")))
    return T.unpivot_attributes(s, ["span_id"], _ATTRS)


@register("span_status", oracle=f"SELECT span_id, {_STATUS} AS status FROM spans")
def span_status(spark, sf_dir):
    s = Views(spark, sf_dir).spans()
    return s.select("span_id", T.normalize_status().alias("status"))


@register("span_duration", oracle="""
SELECT span_id, coalesce(end_ns - start_ns, 0) AS duration_ns FROM spans""")
def span_duration(spark, sf_dir):
    s = Views(spark, sf_dir).spans()
    return s.select("span_id", T.span_duration().alias("duration_ns"))


_ATTR_TEXT = ("array_to_string(list_sort(list_filter(['component_uid=' || component_uid, 'environment_uid=' || environment_uid, "
              "'namespace=' || namespace, 'project_uid=' || project_uid, 'props=' || props, "
              "'resource_host=host-' || namespace, 'service_name=svc-' || component_uid], lambda x: x IS NOT NULL)), ';')")


@register("trace_spans_with_attrs", oracle=f"""
SELECT {_SPAN_COLS}, {_ATTR_TEXT} AS attributes FROM spans
WHERE trace_id = '{TRACE_ID}' AND namespace = '{NS}' AND {_IN_TIME}
ORDER BY start_ns, span_id LIMIT 20""")
def trace_spans_with_attrs(spark, sf_dir):
    s = Views(spark, sf_dir).spans().withColumn(
        "service_name", F.concat(F.lit("svc-"), F.col("component_uid"))).withColumn(
        "resource_host", F.concat(F.lit("host-"), F.col("namespace")))
    out = T.trace_spans(s, TRACE_ID, Scope(NS), S, E, limit=20, with_attributes=True)
    return out.withColumn("attributes", map_text("attributes"))


@register("trace_scope_filter", oracle=f"""
SELECT span_id, trace_id, component_uid FROM spans
WHERE namespace = '{NS}' AND component_uid IN ('comp-1', 'comp-4') AND project_uid = 'proj-1' AND {_IN_TIME}""")
def trace_scope_filter(spark, sf_dir):
    scope = Scope(NS, project="proj-1", component=["comp-1", "comp-4"])
    return T.scoped_spans(Views(spark, sf_dir).spans(), scope, S, E).select(
        "span_id", "trace_id", "component_uid")
