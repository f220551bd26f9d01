"""Ingestion transforms (I1-I10): projections, map edits and joins with the
pod dimension, applied to tables or streams alike."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylight.functions.labels import COMPONENT_UID, ENVIRONMENT_UID, NAMESPACE, PROJECT_UID, label_key
from skylight.sources.containers import file_metadata


def enrich_logs(lines: DataFrame, pods: DataFrame, file_col: str = "file",
                carry: Sequence[str] = ("namespace", "project_uid", "environment_uid", "component_uid")) -> DataFrame:
    """Pod, namespace and container from the file name, then the pod's
    labels by a left join (broadcast only when the dimension is small)."""
    meta = file_metadata(lines, file_col)
    dim = (pods.select("pod", "pod_namespace", *carry))
    return meta.join(dim, ["pod", "pod_namespace"], "left")


def drop_opted_out(lines: DataFrame, pods: DataFrame, annotation: str, annotations_col: str = "annotations",
                   container_col: str = "container", stream_col: str = "stream") -> DataFrame:
    """Lines of pods that opt out by ``annotation[_stream][-container]``
    are dropped: all of a pod's, or one stream's (``stdout`` or ``stderr``) or
    one container's. The value ``true`` (any case) opts out, any other keeps.
    Lines without a known pod, or of a pod without annotations, stay. The pods
    that opt out are found first, so an anti-join with those few is all that
    lines see."""
    rest = F.substring("__key", len(annotation) + 1, 1 << 20)
    form = r"^(?:_(stdout|stderr))?(?:-(.+))?$"
    part = lambda i: F.nullif(F.regexp_extract(rest, form, i), F.lit(""))
    marked = (pods.select(F.col("pod").alias("__pod"), F.col("pod_namespace").alias("__ns"),
                          F.explode(annotations_col).alias("__key", "__value"))
              .filter((F.lower(F.trim("__value")) == "true") & F.startswith("__key", F.lit(annotation)) & rest.rlike(form))
              .select("__pod", "__ns", part(1).alias("__stream"), part(2).alias("__container")).distinct())
    cond = (lines["pod"] == marked["__pod"]) & (lines["pod_namespace"] == marked["__ns"])
    for own, col in (("__stream", stream_col), ("__container", container_col)):
        cond = cond & (marked[own].isNull() | (marked[own] == lines[col]))
    return lines.join(marked, cond, "left_anti")


def enrich_spans(spans: DataFrame, pods: DataFrame, resource_col: str = "resource",
                 label_cols: Sequence[str] = ("component_uid", "project_uid", "environment_uid", "namespace")) -> DataFrame:
    """Every pod label under its own key plus the five ``k8s.*`` fields
    merged into the span resource map (the new value wins on a clash)."""
    dim = (pods.select("pod", "pod_namespace", *label_cols))
    j = spans.join(dim, ["pod", "pod_namespace"], "left")
    add = F.create_map(
        *[x for c in label_cols for x in (F.lit(c), F.col(c))],
        F.lit("k8s.pod.name"), F.col("pod"),
        F.lit("k8s.pod.uid"), F.col("pod_uid"),
        F.lit("k8s.deployment.name"), F.col("deployment"),
        F.lit("k8s.namespace.name"), F.col("pod_namespace"),
        F.lit("k8s.node.name"), F.col("node"),
    )
    add = F.map_filter(add, lambda k, v: v.isNotNull())
    return j.withColumn(resource_col, F.map_concat(F.col(resource_col), add)).drop(*label_cols)


def upsert_resource(df: DataFrame, pairs: dict[str, str], resource_col: str = "resource") -> DataFrame:
    """Set ``to`` from ``from`` for each pair, only when ``from`` exists."""
    m = F.col(resource_col)
    for to, frm in pairs.items():
        src = m[frm]
        m = F.when(src.isNotNull(), F.map_concat(m, F.create_map(F.lit(to), src))).otherwise(m)
    return df.withColumn(resource_col, m)


def normalize_key(mode: str = "logs"):
    """I4: ``logs``: dots to ``_``; ``metrics``: ``-``, ``.``, ``/`` to ``_``
    with the ``label_`` prefix."""
    if mode == "logs":
        return lambda k: F.translate(k, ".", "_")
    if mode == "metrics":
        return lambda k: F.concat(F.lit("label_"), F.translate(k, "-./", "___"))
    raise ValueError(mode)


def normalize_label_keys(df: DataFrame, mode: str = "logs", labels_col: str = "labels") -> DataFrame:
    f = normalize_key(mode)
    return df.withColumn(labels_col, F.transform_keys(F.col(labels_col), lambda k, v: f(k)))


def reshape_log(df: DataFrame) -> DataFrame:
    """Lift ``kubernetes.*`` to ``k8s_*`` columns, rename the label map to
    ``attributes`` and nest it under ``resource``."""
    k = F.col("kubernetes")
    return df.select(
        *[c for c in df.columns if c != "kubernetes"],
        k["namespace_name"].alias("k8s_namespace_name"),
        k["pod_name"].alias("k8s_pod_name"),
        k["container_name"].alias("k8s_container_name"),
        F.struct(k["labels"].alias("attributes")).alias("resource"),
    )


def set_service_name(df: DataFrame, from_key: str, resource_col: str = "resource") -> DataFrame:
    """``service.name`` := the component label."""
    m = F.col(resource_col)
    return df.withColumn(resource_col, F.when(m[from_key].isNotNull(), F.map_concat(
        m, F.create_map(F.lit("service.name"), m[from_key]))).otherwise(m))


def route_by_environment(df: DataFrame, env_col: str, routes: Sequence[str]) -> DataFrame:
    """Each record goes to the pipeline of its environment; unmatched
    records are dropped.  Writers partition on ``route``."""
    return df.filter(F.col(env_col).isin(list(routes))).withColumn("route", F.col(env_col))


# The pod metrics kept by the metric scraper.
METRIC_ALLOWLIST = (
    "kube_pod_completion_time", "kube_pod_container_resource_limits", "kube_pod_container_resource_requests",
    "kube_pod_info", "kube_pod_init_container_resource_limits", "kube_pod_init_container_resource_requests",
    "kube_pod_labels", "kube_pod_start_time", "kube_pod_status_phase",
)
# The four scope labels (under the configured label domain) are the labels kept on pod metrics.
LABEL_ALLOWLIST = tuple(label_key(n) for n in (COMPONENT_UID, PROJECT_UID, ENVIRONMENT_UID, NAMESPACE))


def metric_allowlist(df: DataFrame, metric_col: str = "metric", labels_col: str = "labels",
                     metrics: Sequence[str] = METRIC_ALLOWLIST, labels: Sequence[str] = LABEL_ALLOWLIST) -> DataFrame:
    """I8: keep listed metrics, and only listed labels on them."""
    keep = F.array(*[F.lit(x) for x in labels])
    return (df.filter(F.col(metric_col).isin(list(metrics)))
            .withColumn(labels_col, F.map_filter(F.col(labels_col), lambda k, v: F.array_contains(keep, k))))


def _bucket_range(df: DataFrame, buckets) -> DataFrame:
    lo, hi = buckets
    if lo is not None:
        df = df.filter(F.col("bucket") >= F.lit(int(lo)).cast("bigint"))
    if hi is not None:
        df = df.filter(F.col("bucket") <= F.lit(int(hi)).cast("bigint"))
    return df


def _trace_candidates(spans: DataFrame, wait_s: float, bucket_s: float, trace_col: str, ts_col: str) -> DataFrame:
    """One row per trace: first span time, span count, decision bucket.
    A partial aggregation, so a trace with many spans is combined map-side."""
    per_trace = spans.groupBy(trace_col).agg(
        F.min(F.unix_micros(F.col(ts_col).cast("timestamp"))).alias("first_us"),
        F.count(F.lit(1)).alias("n"))
    dec = F.col("first_us") + F.lit(int(wait_s * 1_000_000)).cast("bigint")
    b_us = F.lit(int(bucket_s * 1_000_000)).cast("bigint")
    return (per_trace.withColumn("decision_us", dec)
            .withColumn("bucket", ((dec - F.pmod(dec, b_us)) / b_us).cast("bigint")))


def tail_sample(spans: DataFrame, wait_s: float = 10, limit: int = 10, bucket_s: float = 1,
                trace_col: str = "trace_id", ts_col: str = "start_ts",
                buckets: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """Per trace, the decision falls ``wait_s`` after its first span, in
    bucket ``floor((first_seen + wait) / bucket)``; within a bucket traces are
    taken in (first seen, id) order and kept while the kept spans plus their
    own stay within ``limit``.  Returns ``(trace_id, decision_ts, spans)`` of
    kept traces.

    Spans used only grow within a bucket, so once a trace of ``n`` spans does
    not fit, no later trace of ``n`` spans fits either: the kept traces of
    one size are the first of that size, at most ``limit / n`` of them.  Those
    are found by rank per (bucket, size), which Spark limits before the shuffle,
    so a hot bucket never moves whole.  What is left is at most
    ``limit * (1 + ln limit)`` traces a bucket whatever the data, and the rule
    is folded over that array.  Traces larger than ``limit`` can never be kept.
    ``buckets=(lo, hi)`` decides only buckets lo..hi (inclusive; buckets are
    independent, so this is exact for them).
    """
    cand = _bucket_range(_trace_candidates(spans, wait_s, bucket_s, trace_col, ts_col), buckets)
    by_size = Window.partitionBy("bucket", "n").orderBy("first_us", trace_col)
    first = (cand.filter(F.col("n") <= limit).withColumn("rank", F.row_number().over(by_size))
             .filter((F.col("rank") <= limit) & (F.col("rank") * F.col("n") <= limit)).drop("rank"))
    return _fold_buckets(first, limit, trace_col)


def _fold_buckets(cand: DataFrame, limit: int, trace_col: str) -> DataFrame:
    """The greedy rule over each bucket's candidates in one array."""
    per_bucket = cand.groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct("first_us", trace_col, "n", "decision_us"))).alias("ts_"))
    init = F.struct(F.lit(0).cast("bigint").alias("used"),
                    F.array().cast("array<struct<t:string,n:bigint,d:bigint>>").alias("kept"))

    def step(acc, x):
        fits = acc["used"] + x["n"] <= F.lit(limit).cast("bigint")
        item = F.struct(x[trace_col].alias("t"), x["n"].alias("n"), x["decision_us"].alias("d"))
        return F.when(fits, F.struct((acc["used"] + x["n"]).alias("used"),
                                     F.array_append(acc["kept"], item).alias("kept"))).otherwise(acc)

    kept = per_bucket.select(F.explode(F.aggregate("ts_", init, step)["kept"]).alias("k"))
    return kept.select(F.col("k.t").alias(trace_col),
                       F.timestamp_micros("k.d").cast("timestamp_ntz").alias("decision_ts"),
                       F.col("k.n").alias("spans"))


def searchable_projection(df: DataFrame, mapped: Sequence[str], extras_col: str = "extras") -> DataFrame:
    """Only mapped fields stay columns; the rest is kept (not searchable)
    in one string map."""
    rest = [c for c in df.columns if c not in mapped]
    extras = F.map_from_entries(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                                         for c in rest])) if rest else F.create_map().cast("map<string,string>")
    return df.select(*mapped, F.map_filter(extras, lambda k, v: v.isNotNull()).alias(extras_col))


def column_map(cols: Sequence[str]) -> Column:
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])
