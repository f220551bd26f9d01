"""Registered source, sink and ingestion queries.

Sink queries write to a fresh folder under ``spark.checkpoint.dir`` and
return the read-back DataFrame, so the check covers the round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skylight.functions.labels import COMPONENT_UID, ENVIRONMENT_UID, NAMESPACE, PROJECT_UID, label_key, log_label_key
from skylight.operators import alerts as A
from skylight.operators import ingest as I
from skylight.plans.q_alerts import WEBHOOKS_SQL
from skylight.plans.registry import register
from skylight.sources import containers as C
from skylight.sources import fixtures as FX
from skylight.sources import sinks as K
from skylight.sources.fixtures import Views

LOG_COLS = "event_id, ts, log, namespace, component_uid, environment_uid, project_uid"


_CONTAINER_FILES: dict = {}


def _container_files(spark, sf_dir) -> str:
    """The container log files of ``sf_dir``, written once per session (the
    fixture); the queries then list, read and decode them on every run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _CONTAINER_FILES.get(key)
    if path is None:
        path = _write_container_files(spark, sf_dir)
        _CONTAINER_FILES[key] = path
    return path


def _write_container_files(spark, sf_dir) -> str:
    """Container log files from ``events``: CRI text for even users (long
    lines split into a ``P`` fragment and a closing ``F`` line), docker JSON
    for odd users; one file per pod."""
    ev = Views(spark, sf_dir).events
    base = ev.select(
        F.concat(F.lit("pod-"), F.col("user_id").cast("string"), F.lit("_k8s-"),
                 (F.col("user_id") % 4).cast("string"), F.lit("_main-0a1b2c3d.log")).alias("logfile"),
        (F.col("user_id") % 2 == 0).alias("cri"), "ts", FX.log_message().alias("msg"))
    t = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000Z"))
    frag = F.when(F.col("cri") & (F.length("msg") > 8), F.array(
        F.struct(F.lit(0).alias("o"), F.concat(t, F.lit(" stdout P "), F.substring("msg", 1, 8)).alias("value")),
        F.struct(F.lit(1).alias("o"), F.concat(t, F.lit(" stdout F "), F.expr("substring(msg, 9)")).alias("value"))
    )).when(F.col("cri"), F.array(F.struct(F.lit(1).alias("o"), F.concat(t, F.lit(" stdout F "), F.col("msg"))
                                           .alias("value"))
    )).otherwise(F.array(F.struct(F.lit(1).alias("o"), F.to_json(F.struct(
        F.concat(F.col("msg"), F.lit("\n")).alias("log"), F.lit("stdout").alias("stream"), t.alias("time")))
        .alias("value"))))
    lines = base.select("logfile", "ts", F.explode(frag).alias("l")).select("logfile", "ts", "l.o", "l.value")
    path = K.scratch_path(spark, "container-logs")
    # by number: small rows in many files must not be coalesced into few tasks
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    K.write_text_files(lines.repartition(n, "logfile").sortWithinPartitions("logfile", "ts", "o").select("logfile", "value"),
                       path, "logfile")
    return path


def _decoded(spark, sf_dir):
    path = _container_files(spark, sf_dir)
    raw = C.read_container_logs(spark, path, glob="*.{log,txt}")
    return C.decode_container_lines(raw)


@register("container_logs_decoded", oracle="""
SELECT 'pod-' || CAST(user_id AS STRING) AS pod, 'k8s-' || CAST(user_id % 4 AS STRING) AS pod_namespace,
  'main' AS container_name, 'stdout' AS stream, ts,
  CASE event_type WHEN 'error' THEN 'ERROR upstream call failed ' WHEN 'signup' THEN 'WARNING slow signup '
    WHEN 'view' THEN 'debug page rendered ' WHEN 'purchase' THEN 'order placed 100% ok ' ELSE 'click_handled ' END || props AS log,
  true AS complete
FROM events""")
def container_logs_decoded(spark, sf_dir):
    d = C.file_metadata(_decoded(spark, sf_dir))
    return d.select("pod", "pod_namespace", "container_name", "stream", "ts", "log", "complete")


@register("logs_enriched", oracle="""
SELECT e.ts, p.pod, p.pod_namespace, p.namespace, p.project_uid, p.environment_uid, p.component_uid
FROM events e JOIN pods p ON p.pod = 'pod-' || CAST(e.user_id AS STRING)""")
def logs_enriched(spark, sf_dir):
    d = _decoded(spark, sf_dir)
    e = I.enrich_logs(d, Views(spark, sf_dir).pods())
    return e.select("ts", "pod", "pod_namespace", "namespace", "project_uid", "environment_uid", "component_uid")


@register("sink_roundtrip_by_day", oracle="""
SELECT log_date, count(*) AS n, count(DISTINCT component_uid) AS components FROM logs
WHERE log_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY log_date""")
def sink_roundtrip_by_day(spark, sf_dir):
    path = K.scratch_path(spark, "logs-by-day")
    K.write_logs(Views(spark, sf_dir).logs(), path)
    back = K.scan_logs(spark, path, "2024-01-10 00:00:00", "2024-01-20 23:59:59")
    return back.groupBy("log_date").agg(F.count(F.lit(1)).alias("n"),
                                        F.count_distinct("component_uid").alias("components"))


@register("dedupe_by_doc_id", oracle=f"SELECT {LOG_COLS} FROM logs")
def dedupe_by_doc_id(spark, sf_dir):
    lg = Views(spark, sf_dir).logs().select("event_id", "ts", "log", "namespace", "component_uid",
                                            "environment_uid", "project_uid")
    retried = lg.unionByName(lg)  # a whole retried batch
    return K.dedupe_by_doc_id(K.with_doc_id(retried)).drop("doc_id")


@register("json_sink_roundtrip", oracle=f"SELECT {LOG_COLS}, log_date FROM logs")
def json_sink_roundtrip(spark, sf_dir):
    lg = Views(spark, sf_dir).logs().select("event_id", "ts", "log", "namespace", "component_uid",
                                            "environment_uid", "project_uid", "log_date")
    path = K.scratch_path(spark, "logs-json")
    K.write_logs(lg, path, fmt="json")
    schema = ("event_id bigint, ts timestamp_ntz, log string, namespace string, component_uid string, "
              "environment_uid string, project_uid string, log_date date")
    return K.scan_logs(spark, path, fmt="json", schema=schema).select(*lg.columns)


@register("span_sink_roundtrip", oracle="""
SELECT span_date, count(*) AS spans, count(DISTINCT trace_id) AS traces, CAST(sum(duration_ns) AS BIGINT) AS total_ns
FROM spans GROUP BY span_date""")
def span_sink_roundtrip(spark, sf_dir):
    path = K.scratch_path(spark, "spans-by-day")
    K.write_spans(Views(spark, sf_dir).spans(), path)
    back = K.scan_logs(spark, path, day_col="span_date")
    return back.groupBy("span_date").agg(F.count(F.lit(1)).alias("spans"),
                                         F.count_distinct("trace_id").alias("traces"),
                                         F.sum("duration_ns").alias("total_ns"))


@register("metrics_union_clusters", oracle="""
SELECT 'cluster-a' AS cluster, pod, pod_namespace, ts, value, CAST(NULL AS DOUBLE) AS memory_bytes FROM cpu_samples
UNION ALL
SELECT 'cluster-b', pod, pod_namespace, ts, CAST(NULL AS DOUBLE), memory_bytes FROM gauge_samples""")
def metrics_union_clusters(spark, sf_dir):
    v = Views(spark, sf_dir)
    u = K.union_clusters({"cluster-a": v.cpu_samples(),
                          "cluster-b": v.gauge_samples().select("pod", "pod_namespace", "ts", "memory_bytes")})
    return u.select("cluster", "pod", "pod_namespace", "ts", "value", "memory_bytes")


@register("alert_sink_append", oracle=f"WITH {WEBHOOKS_SQL} SELECT * FROM hooks")
def alert_sink_append(spark, sf_dir):
    ok, _ = A.normalize_webhooks(Views(spark, sf_dir).webhooks())
    path = K.scratch_path(spark, "alerts")
    K.append_alerts(ok.filter(F.col("shape") == "search"), path)
    K.append_alerts(ok.filter(F.col("shape") != "search"), path)
    return spark.read.parquet(path)


@register("retention_keep", oracle="""
SELECT log_date, count(*) AS n FROM logs WHERE log_date >= DATE '2024-01-17' GROUP BY log_date""")
def retention_keep(spark, sf_dir):
    path = K.scratch_path(spark, "logs-retention")
    K.write_logs(Views(spark, sf_dir).logs().select("event_id", "ts", "log"), path)
    K.apply_retention(spark, path, "2024-01-31 00:00:00", days=14)
    back = spark.read.parquet(path)
    return back.filter(K.retention_filter("2024-01-31 00:00:00", 14)).groupBy("log_date").agg(
        F.count(F.lit(1)).alias("n"))


def _span_resources(spark, sf_dir):
    s = Views(spark, sf_dir).spans()
    return s.select("span_id", "pod", "pod_namespace", "component_uid", "environment_uid",
                    F.create_map(F.lit("service.name"), F.col("name"), F.lit("span.kind"), F.col("kind"))
                    .alias("resource"))


@register("spans_enriched", oracle="""
WITH s AS (SELECT sp.span_id, sp.name, sp.kind, sp.pod, sp.pod_namespace, p.component_uid, p.project_uid,
             p.environment_uid, p.namespace FROM spans sp LEFT JOIN pods p ON sp.pod = p.pod AND sp.pod_namespace = p.pod_namespace)
SELECT span_id, k AS key, v AS value FROM (
  SELECT span_id, 'service.name' AS k, name AS v FROM s UNION ALL SELECT span_id, 'span.kind', kind FROM s
  UNION ALL SELECT span_id, 'component_uid', component_uid FROM s UNION ALL SELECT span_id, 'project_uid', project_uid FROM s
  UNION ALL SELECT span_id, 'environment_uid', environment_uid FROM s UNION ALL SELECT span_id, 'namespace', namespace FROM s
  UNION ALL SELECT span_id, 'k8s.pod.name', pod FROM s UNION ALL SELECT span_id, 'k8s.pod.uid', md5(pod) FROM s
  UNION ALL SELECT span_id, 'k8s.deployment.name', 'deploy-' || pod FROM s
  UNION ALL SELECT span_id, 'k8s.namespace.name', pod_namespace FROM s
  UNION ALL SELECT span_id, 'k8s.node.name', 'node-' || pod_namespace FROM s) u WHERE v IS NOT NULL""")
def spans_enriched(spark, sf_dir):
    s = _span_resources(spark, sf_dir).drop("component_uid", "environment_uid").select(
        "*", F.md5("pod").alias("pod_uid"), F.concat(F.lit("deploy-"), F.col("pod")).alias("deployment"),
        F.concat(F.lit("node-"), F.col("pod_namespace")).alias("node"))
    e = I.enrich_spans(s, Views(spark, sf_dir).pods())
    return e.select("span_id", F.explode("resource").alias("key", "value"))


_UPSERT = {"component-uid": "component_uid", "environment-uid": "environment_uid", "project-uid": "project_uid"}


@register("resource_upsert", oracle="""
WITH s AS (SELECT span_id, name, component_uid,
             CASE WHEN event_id % 3 = 0 THEN NULL ELSE environment_uid END AS environment_uid, project_uid FROM spans)
SELECT span_id, k AS key, v AS value FROM (
  SELECT span_id, 'service.name' AS k, name AS v FROM s
  UNION ALL SELECT span_id, 'component_uid', component_uid FROM s UNION ALL SELECT span_id, 'environment_uid', environment_uid FROM s
  UNION ALL SELECT span_id, 'project_uid', project_uid FROM s
  UNION ALL SELECT span_id, 'component-uid', component_uid FROM s UNION ALL SELECT span_id, 'environment-uid', environment_uid FROM s
  UNION ALL SELECT span_id, 'project-uid', project_uid FROM s) u WHERE v IS NOT NULL""")
def resource_upsert(spark, sf_dir):
    s = Views(spark, sf_dir).spans()
    env = F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("environment_uid"))
    res = F.map_filter(F.create_map(F.lit("service.name"), F.col("name"), F.lit("component_uid"), F.col("component_uid"),
                                    F.lit("environment_uid"), env, F.lit("project_uid"), F.col("project_uid")),
                       lambda k, v: v.isNotNull())
    u = I.upsert_resource(s.select("span_id", res.alias("resource")), _UPSERT)
    return u.select("span_id", F.explode("resource").alias("key", "value"))


def _labels(spark, sf_dir):
    lg = Views(spark, sf_dir).logs()
    return lg.select("event_id", F.create_map(
        F.lit(label_key(COMPONENT_UID)), F.col("component_uid"),
        F.lit("app.kubernetes.io/name"), F.col("pod_name"),
        F.lit("version-id"), F.col("step_name")).alias("labels"))


@register("label_keys_normalized", oracle=f"""
WITH l AS (SELECT event_id, component_uid, pod_name, step_name FROM logs),
kv AS (SELECT event_id, '{label_key(COMPONENT_UID)}' AS k, component_uid AS v FROM l
       UNION ALL SELECT event_id, 'app.kubernetes.io/name', pod_name FROM l UNION ALL SELECT event_id, 'version-id', step_name FROM l)
SELECT event_id, 'logs' AS mode, replace(k, '.', '_') AS key, v AS value FROM kv
UNION ALL
SELECT event_id, 'metrics', 'label_' || replace(replace(replace(k, '-', '_'), '.', '_'), '/', '_'), v FROM kv""")
def label_keys_normalized(spark, sf_dir):
    lb = _labels(spark, sf_dir)
    out = None
    for mode in ("logs", "metrics"):
        n = I.normalize_label_keys(lb, mode).select("event_id", F.lit(mode).alias("mode"),
                                                    F.explode("labels").alias("key", "value"))
        out = n if out is None else out.unionByName(n)
    return out


@register("log_reshape", oracle=f"""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "@timestamp", log, pod_namespace AS k8s_namespace_name,
  pod_name AS k8s_pod_name, container_name AS k8s_container_name,
  array_to_string(list_sort(['{log_label_key(COMPONENT_UID)}=' || component_uid, '{log_label_key(ENVIRONMENT_UID)}=' || environment_uid,
    '{log_label_key(NAMESPACE)}=' || namespace, '{log_label_key(PROJECT_UID)}=' || project_uid]), ';') AS resource_attributes
FROM logs""")
def log_reshape(spark, sf_dir):
    from skylight.functions.ids import map_text
    from skylight.operators.logs import to_log_documents
    docs = to_log_documents(Views(spark, sf_dir).logs())
    r = I.reshape_log(docs)
    return r.select("event_id", "`@timestamp`", "log", "k8s_namespace_name", "k8s_pod_name", "k8s_container_name",
                    map_text("resource.attributes").alias("resource_attributes"))


@register("service_name_set", oracle="SELECT event_id, component_uid AS service_name FROM logs")
def service_name_set(spark, sf_dir):
    lg = Views(spark, sf_dir).logs()
    r = lg.select("event_id", F.create_map(F.lit("component"), F.col("component_uid")).alias("resource"))
    return I.set_service_name(r, "component").select("event_id", F.col("resource")["service.name"].alias("service_name"))


@register("route_by_environment", oracle="""
SELECT event_id, environment_uid AS route FROM logs WHERE environment_uid IN ('env-1')""")
def route_by_environment(spark, sf_dir):
    lg = Views(spark, sf_dir).logs()
    return I.route_by_environment(lg, "environment_uid", ["env-1"]).select("event_id", "route")


@register("metric_allowlist", oracle=f"""
WITH g AS (SELECT g.pod, g.ts, g.cpu_limit, g.memory_bytes, g.phase_running, p.component_uid, p.project_uid,
             p.environment_uid, p.namespace FROM gauge_samples g JOIN pods p ON g.pod = p.pod AND g.pod_namespace = p.pod_namespace),
m AS (SELECT pod, ts, 'kube_pod_container_resource_limits' AS metric, * EXCLUDE (pod, ts) FROM g
      UNION ALL SELECT pod, ts, 'container_memory_working_set_bytes', * EXCLUDE (pod, ts) FROM g
      UNION ALL SELECT pod, ts, 'kube_pod_status_phase', * EXCLUDE (pod, ts) FROM g)
SELECT pod, ts, metric, k AS key, v AS value FROM (
  SELECT pod, ts, metric, '{label_key(COMPONENT_UID)}' AS k, component_uid AS v FROM m
  UNION ALL SELECT pod, ts, metric, '{label_key(PROJECT_UID)}', project_uid FROM m
  UNION ALL SELECT pod, ts, metric, '{label_key(ENVIRONMENT_UID)}', environment_uid FROM m
  UNION ALL SELECT pod, ts, metric, '{label_key(NAMESPACE)}', namespace FROM m) u
WHERE metric IN ('kube_pod_container_resource_limits', 'kube_pod_status_phase')""")
def metric_allowlist(spark, sf_dir):
    v = Views(spark, sf_dir)
    g = v.gauge_samples().join(v.pods(), ["pod", "pod_namespace"])
    labels = F.create_map(
        F.lit(label_key(COMPONENT_UID)), F.col("component_uid"), F.lit(label_key(PROJECT_UID)),
        F.col("project_uid"), F.lit(label_key(ENVIRONMENT_UID)), F.col("environment_uid"),
        F.lit(label_key(NAMESPACE)), F.col("namespace"), F.lit("app"), F.lit("web"),
        F.lit("pod-template-hash"), F.lit("5d8f7c"))
    metric = F.explode(F.array(*[F.lit(m) for m in ("kube_pod_container_resource_limits",
                                                    "container_memory_working_set_bytes",
                                                    "kube_pod_status_phase")]))
    long = g.select("pod", "ts", metric.alias("metric"), labels.alias("labels"))
    kept = I.metric_allowlist(long)
    return kept.select("pod", "ts", "metric", F.explode("labels").alias("key", "value"))


TAIL_SQL = """
WITH RECURSIVE t AS (SELECT trace_id, min(epoch_us(start_ts)) AS first_us, count(*) AS n FROM spans GROUP BY trace_id),
c AS (SELECT *, (first_us + 10000000) // 86400000000 AS bucket FROM t),
o AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY first_us, trace_id) AS rn FROM c WHERE n <= 20),
walk AS (SELECT bucket, rn, trace_id, n AS used, true AS kept FROM o WHERE rn = 1
  UNION ALL
  SELECT o.bucket, o.rn, o.trace_id, CASE WHEN w.used + o.n <= 20 THEN w.used + o.n ELSE w.used END,
         w.used + o.n <= 20 FROM walk w JOIN o ON o.bucket = w.bucket AND o.rn = w.rn + 1)
SELECT c.trace_id, make_timestamp(c.first_us + 10000000) AS decision_ts, c.n AS spans
FROM c JOIN walk ON walk.trace_id = c.trace_id WHERE walk.kept"""


@register("tail_sampled_traces", oracle=TAIL_SQL)
def tail_sampled_traces(spark, sf_dir):
    return I.tail_sample(Views(spark, sf_dir).spans(), wait_s=10, limit=20, bucket_s=86400)


@register("searchable_fields", oracle="""
SELECT event_id, ts, log, namespace,
  CAST((log_date IS NOT NULL)::INT + (log_level IS NOT NULL)::INT + (project_uid IS NOT NULL)::INT
   + (environment_uid IS NOT NULL)::INT + (component_uid IS NOT NULL)::INT + (pod_name IS NOT NULL)::INT
   + (pod_namespace IS NOT NULL)::INT + (container_name IS NOT NULL)::INT + (workflow_run IS NOT NULL)::INT
   + (step_name IS NOT NULL)::INT AS INT) AS extras FROM logs""")
def searchable_fields(spark, sf_dir):
    p = I.searchable_projection(Views(spark, sf_dir).logs(), ["event_id", "ts", "log", "namespace"])
    return p.select("event_id", "ts", "log", "namespace", F.size("extras").alias("extras"))
