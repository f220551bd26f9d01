"""Resource and HTTP series (M10-M17) composed from the metric operators.

Series inputs (column names of the sample tables):

* ``cpu``: ``(pod, pod_namespace, container, ts, value)`` CPU-seconds counter;
* ``gauges``: ``(pod, pod_namespace, container, ts, memory_bytes, cpu_request,
  cpu_limit, memory_request, memory_limit, phase_running)``;
* ``http``: ``(destination_pod, destination_namespace, reporter, status, ts, value)``
  request counter; ``latency_sum`` the duration-sum counter;
* ``buckets``: ``(destination_pod, destination_namespace, reporter, ts, le, value)``;
* ``pods``: the pod-label dimension ``(pod, pod_namespace, namespace, project_uid,
  environment_uid, component_uid)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylight.functions.scope import Scope
from skylight.operators import metrics as M

POD_KEYS = ["pod", "pod_namespace"]
DEST_KEYS = ["destination_pod", "destination_namespace"]
DEST_RENAME = {"pod": "destination_pod", "pod_namespace": "destination_namespace"}
# PromQL status classes for successful and failed requests.
# Gauge columns of a sample row; every other column but the time is a label.
GAUGES = ("memory_bytes", "cpu_request", "cpu_limit", "memory_request", "memory_limit", "phase_running")
SUCCESS_STATUS = "^[123]..?$"
FAILED_STATUS = "^[45]..?$"


def _scoped_sum(series: DataFrame, pods: DataFrame, scope: Scope, on=POD_KEYS, rename=None) -> DataFrame:
    labels = scope.label_columns()
    j = M.join_pod_labels(series, M.pod_labels(pods, scope), on=on, carry=labels, rename=rename)
    return M.sum_by(j, labels)


def _in_scope(samples: DataFrame, pods: DataFrame, scope: Scope, on=POD_KEYS, rename=None) -> DataFrame:
    """The samples of the scope's pods: the others leave before the rate, and
    are neither shuffled nor held."""
    right = M.pod_labels(pods, scope)
    for a, b in (rename or {}).items():
        right = right.withColumnRenamed(a, b)
    return samples.join(right.select(*on), list(on), "left_semi").select(*samples.columns)


def _dest_in_scope(samples: DataFrame, pods: DataFrame, scope: Scope) -> DataFrame:
    return _in_scope(samples, pods, scope, DEST_KEYS, DEST_RENAME)


def cpu_usage(cpu: DataFrame, pods: DataFrame, scope: Scope, grid: M.Grid,
              range_s: float = M.DEFAULT_RATE_RANGE_S) -> DataFrame:
    """M10 usage: rate of the CPU counter x pod labels, summed by scope labels."""
    c = _in_scope(containers(cpu), pods, scope)
    return _scoped_sum(M.rate(c, M.series_keys(c), grid, range_s), pods, scope)


def containers(df: DataFrame) -> DataFrame:
    """``container!=""``: without the pod-level totals."""
    return M.label_match(df, not_equal={"container": ""}) if "container" in df.columns else df


def _client(df: DataFrame) -> DataFrame:
    """``reporter="client"``: each request is reported by both sides."""
    return M.label_match(df, equal={"reporter": "client"})


def _requested(gauges: DataFrame, col: str, pods: DataFrame, scope: Scope, grid: M.Grid,
               lookback_s: float) -> DataFrame:
    """requests/limits: instant value AND pod Running, x pod labels, summed."""
    c = containers(gauges)
    inst = M.instant(c, M.series_keys(c, GAUGES), grid, [col], lookback_s).withColumnRenamed(col, "value")
    phase = M.instant(gauges, POD_KEYS, grid, ["phase_running"], lookback_s)
    running = M.running_semi(inst, phase, POD_KEYS)
    return _scoped_sum(running, pods, scope)


def cpu_requests(gauges, pods, scope, grid, lookback_s=M.DEFAULT_LOOKBACK_S):
    return _requested(gauges, "cpu_request", pods, scope, grid, lookback_s)


def cpu_limits(gauges, pods, scope, grid, lookback_s=M.DEFAULT_LOOKBACK_S):
    return _requested(gauges, "cpu_limit", pods, scope, grid, lookback_s)


def memory_usage(gauges: DataFrame, pods: DataFrame, scope: Scope, grid: M.Grid,
                 lookback_s: float = M.DEFAULT_LOOKBACK_S) -> DataFrame:
    """M11 usage: instant working-set bytes x pod labels, summed (no phase filter)."""
    c = containers(gauges)
    inst = M.instant(c, M.series_keys(c, GAUGES), grid, ["memory_bytes"], lookback_s).withColumnRenamed(
        "memory_bytes", "value")
    return _scoped_sum(inst, pods, scope)


def memory_requests(gauges, pods, scope, grid, lookback_s=M.DEFAULT_LOOKBACK_S):
    return _requested(gauges, "memory_request", pods, scope, grid, lookback_s)


def memory_limits(gauges, pods, scope, grid, lookback_s=M.DEFAULT_LOOKBACK_S):
    return _requested(gauges, "memory_limit", pods, scope, grid, lookback_s)


def _http_rate(http: DataFrame, grid: M.Grid, range_s: float, status_regex: str | None) -> DataFrame:
    f = M.label_match(_client(http), regex={"status": status_regex[1:-1]} if status_regex else None)
    return M.rate(f, M.series_keys(f), grid, range_s)


def http_requests(http, pods, scope, grid, range_s=M.DEFAULT_RATE_RANGE_S, status_regex=None):
    """Request rate (all / success / failed), destination-pod labels, >= 0."""
    r = _http_rate(_dest_in_scope(http, pods, scope), grid, range_s, status_regex)
    return M.nonnegative(_scoped_sum(r, pods, scope, on=DEST_KEYS, rename=DEST_RENAME))


def http_latency_mean(latency_sum: DataFrame, http: DataFrame, pods: DataFrame, scope: Scope,
                      grid: M.Grid, range_s: float = M.DEFAULT_RATE_RANGE_S) -> DataFrame:
    """Sum of duration-sum rates / sum of request rates, >= 0."""
    labels = scope.label_columns()
    num = _scoped_sum(M.rate(_dest_in_scope(_client(latency_sum), pods, scope), M.series_keys(latency_sum), grid, range_s),
                      pods, scope, on=DEST_KEYS, rename=DEST_RENAME).withColumnRenamed("value", "num")
    den = _scoped_sum(_http_rate(_dest_in_scope(http, pods, scope), grid, range_s, None), pods, scope, on=DEST_KEYS,
                      rename=DEST_RENAME).withColumnRenamed("value", "den")
    j = num.join(den, labels + ["ts"], "inner")
    return M.nonnegative(j.select(*labels, "ts", M.ratio(F.col("num"), F.col("den")).alias("value")))


def http_latency_quantile(buckets: DataFrame, pods: DataFrame, scope: Scope, grid: M.Grid, q: float,
                          range_s: float = M.DEFAULT_RATE_RANGE_S) -> DataFrame:
    """Histogram quantile of bucket rates summed by scope labels and le, >= 0."""
    labels = scope.label_columns()
    r = M.rate(_dest_in_scope(_client(buckets), pods, scope), M.series_keys(buckets), grid, range_s)
    j = M.join_pod_labels(r, M.pod_labels(pods, scope), on=DEST_KEYS, carry=labels, rename=DEST_RENAME)
    summed = j.groupBy(*labels, "le", "ts").agg(F.sum("value").alias("value"))
    return M.nonnegative(M.histogram_quantile(summed, q, labels))


def resource_metrics(cpu, gauges, pods, scope, grid, range_s=M.DEFAULT_RATE_RANGE_S,
                     lookback_s=M.DEFAULT_LOOKBACK_S) -> DataFrame:
    """The six resource series in one result.

    One rate pass for CPU usage; one instant pass for all gauges of a
    container (they share sample rows), one for the pod's phase, one join
    with the pod labels and one aggregation with conditional sums: requests
    and limits count only pods Running at that time (M7), usage counts all.
    """
    labels = scope.label_columns()
    usage = cpu_usage(cpu, pods, scope, grid, range_s).select(
        *labels, "ts", F.lit("cpu_usage").alias("series"), "value")
    c = containers(gauges)
    inst = M.instant(c, M.series_keys(c, GAUGES), grid, [g for g in GAUGES if g != "phase_running"], lookback_s)
    phase = M.instant(gauges, POD_KEYS, grid, ["phase_running"], lookback_s)
    j = M.join_pod_labels(inst, M.pod_labels(pods, scope), carry=labels).join(phase, [*POD_KEYS, "ts"], "left")
    run = F.col("phase_running") == 1
    agg = j.groupBy(*labels, "ts").agg(
        F.sum("memory_bytes").alias("memory_usage"),
        *[F.sum(F.when(run, F.col(c))).alias(n) for c, n in (
            ("cpu_request", "cpu_requests"), ("cpu_limit", "cpu_limits"),
            ("memory_request", "memory_requests"), ("memory_limit", "memory_limits"))])
    names = ["cpu_requests", "cpu_limits", "memory_usage", "memory_requests", "memory_limits"]
    long = agg.select(*labels, "ts", F.explode(F.array(*[
        F.struct(F.lit(n).alias("series"), F.col(n).alias("value")) for n in names])).alias("p")).select(
        *labels, "ts", "p.series", "p.value").filter(F.col("value").isNotNull())
    return usage.unionByName(long)


def http_metrics(http, latency_sum, buckets, pods, scope, grid, range_s=M.DEFAULT_RATE_RANGE_S) -> DataFrame:
    """The seven HTTP series in one result.

    Request rates are computed once per (pod, status) series and summed
    with status-class conditions; bucket rates are summed once and the
    three quantiles read the same bucket array.
    """
    labels = scope.label_columns()
    req = M.join_pod_labels(_http_rate(_dest_in_scope(http, pods, scope), grid, range_s, None), M.pod_labels(pods, scope), on=DEST_KEYS,
                            carry=labels, rename=DEST_RENAME)
    st = F.col("status")
    ok = st.rlike(SUCCESS_STATUS)
    bad = st.rlike(FAILED_STATUS)
    req_sum = req.groupBy(*labels, "ts").agg(
        F.sum("value").alias("requests"), F.sum(F.when(ok, F.col("value"))).alias("requests_success"),
        F.sum(F.when(bad, F.col("value"))).alias("requests_failed"))
    num = _scoped_sum(M.rate(_dest_in_scope(_client(latency_sum), pods, scope), M.series_keys(latency_sum), grid, range_s),
                      pods, scope, on=DEST_KEYS, rename=DEST_RENAME).withColumnRenamed("value", "__num")
    with_lat = req_sum.join(num, labels + ["ts"], "left").withColumn(
        "latency_mean", F.when(F.col("__num").isNotNull(), M.ratio(F.col("__num"), F.col("requests"))))
    r = M.rate(_dest_in_scope(_client(buckets), pods, scope), M.series_keys(buckets), grid, range_s)
    jb = M.join_pod_labels(r, M.pod_labels(pods, scope), on=DEST_KEYS, carry=labels, rename=DEST_RENAME)
    summed = jb.groupBy(*labels, "le", "ts").agg(F.sum("value").alias("value"))
    arrays = M.bucket_arrays(summed, labels)
    qs = arrays.select(*labels, "ts", *[M.quantile_of(F.col("m"), q).alias(n) for q, n in (
        (0.5, "latency_p50"), (0.9, "latency_p90"), (0.99, "latency_p99"))])
    a = with_lat.select(*labels, "ts", F.explode(F.array(*[
        F.struct(F.lit(n).alias("series"), F.col(n).alias("value"))
        for n in ("requests", "requests_success", "requests_failed", "latency_mean")])).alias("p"))
    b = qs.select(*labels, "ts", F.explode(F.array(*[
        F.struct(F.lit(n).alias("series"), F.col(n).alias("value"))
        for n in ("latency_p50", "latency_p90", "latency_p99")])).alias("p"))
    long = a.unionByName(b).select(*labels, "ts", "p.series", "p.value")
    return M.nonnegative(long)
