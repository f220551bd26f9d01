"""Registered metric queries (M1-M17) with their DuckDB oracles.

The oracles state the range window as a range join against an explicit
grid (the Spark side explodes samples to grid indices instead), and the
counter-reset lag as one window over the whole series.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skylight.functions.numeric import round6
from skylight.functions.scope import Scope
from skylight.operators import metrics as M
from skylight.operators import resources as R
from skylight.plans import params as P
from skylight.plans.registry import register
from skylight.sources.fixtures import Views

GS, GE, STEP = P.GRID_START, P.GRID_END, P.GRID_STEP_S
RANGE, LOOK = P.RATE_RANGE_S, P.LOOKBACK_S
NS = P.METRIC_NAMESPACE
SCOPE = Scope(NS, environment="env-1")
GRID = M.Grid.of(GS, GE, STEP)

GRID_CTE = (f"grid AS (SELECT epoch_us(g) AS g_us, g AS gts FROM generate_series(TIMESTAMP '{GS}', "
            f"TIMESTAMP '{GE}', INTERVAL ({STEP}) SECOND) AS t(g))")


def rate_sql(src: str, keys: list[str], range_s: int = RANGE, where: str = "TRUE") -> str:
    k = ", ".join(keys)
    r_us = range_s * 1_000_000
    return f"""(SELECT {k}, gts AS ts,
  inc * (sampled + CASE WHEN inc > 0 AND fv >= 0 AND sampled * (fv / inc) < ds1 THEN sampled * (fv / inc) ELSE ds1 END
         + CASE WHEN de0 >= avg_gap * 1.1 THEN avg_gap / 2 ELSE de0 END) / sampled / CAST({range_s} AS DOUBLE) AS value
FROM (SELECT *, CASE WHEN ds0 >= avg_gap * 1.1 THEN avg_gap / 2 ELSE ds0 END AS ds1 FROM (
  SELECT {k}, gts, fv, lv - fv + corr_extra AS inc,
    CAST(last_us - first_us AS DOUBLE) / 1e6 AS sampled,
    CAST(last_us - first_us AS DOUBLE) / 1e6 / CAST(n - 1 AS DOUBLE) AS avg_gap,
    CAST(first_us - (g_us - {r_us}) AS DOUBLE) / 1e6 AS ds0, CAST(g_us - last_us AS DOUBLE) / 1e6 AS de0
  FROM (SELECT {k}, g_us, gts, count(*) AS n, min(t_us) AS first_us, max(t_us) AS last_us,
          arg_min(value, t_us) AS fv, arg_max(value, t_us) AS lv, sum(corr) - arg_min(corr, t_us) AS corr_extra
        FROM (SELECT s.*, CASE WHEN s.value < s.prev THEN s.prev ELSE 0 END AS corr, grid.g_us, grid.gts
              FROM (SELECT {k}, value, epoch_us(ts) AS t_us, lag(value) OVER (PARTITION BY {k} ORDER BY ts) AS prev
                    FROM {src} WHERE {where}) s
              JOIN grid ON s.t_us > grid.g_us - {r_us} AND s.t_us <= grid.g_us) w
        GROUP BY {k}, g_us, gts HAVING count(*) >= 2) a) b) c)"""


def instant_sql(src: str, keys: list[str], cols: list[str], lookback_s: int = LOOK) -> str:
    k = ", ".join(keys)
    l_us = lookback_s * 1_000_000
    picks = ", ".join(f"arg_max({c}, t_us) AS {c}" for c in cols)
    return f"""(SELECT {k}, gts AS ts, {picks}
FROM (SELECT s.*, grid.g_us, grid.gts FROM (SELECT *, epoch_us(ts) AS t_us FROM {src}) s
      JOIN grid ON s.t_us > grid.g_us - {l_us} AND s.t_us <= grid.g_us) w
GROUP BY {k}, g_us, gts)"""


# series of containers: every label is in the key, pod-level totals are left out
CONTAINER = ["pod", "pod_namespace", "container"]
CPU_RATE_SQL = rate_sql("cpu_samples", CONTAINER, where="container <> ''")
GAUGE_SRC = "(SELECT * FROM gauge_samples WHERE container <> '')"


SCOPED_PODS = f"(SELECT * FROM pods WHERE namespace = '{NS}' AND environment_uid = 'env-1')"
DEST_PODS = (f"(SELECT pod AS destination_pod, pod_namespace AS destination_namespace, environment_uid "
             f"FROM pods WHERE namespace = '{NS}' AND environment_uid = 'env-1')")


def _v(spark, sf_dir):
    return Views(spark, sf_dir)


@register("metric_range_grid", oracle=f"""
WITH {GRID_CTE}
SELECT pod, pod_namespace, container, gts AS ts, count(*) AS n FROM (SELECT *, epoch_us(ts) AS t_us FROM cpu_samples) s
JOIN grid ON s.t_us > grid.g_us - {RANGE * 1_000_000} AND s.t_us <= grid.g_us
GROUP BY pod, pod_namespace, container, gts""")
def metric_range_grid(spark, sf_dir):
    x = M.explode_to_grid(_v(spark, sf_dir).cpu_samples(), GRID, RANGE)
    return x.groupBy(*CONTAINER, "g").agg(F.count(F.lit(1)).alias("n")).select(
        *CONTAINER, GRID.ts(F.col("g")).alias("ts"), "n")


@register("metric_rate", oracle=f"""
WITH {GRID_CTE}
SELECT pod, pod_namespace, container, ts, round((value) + 1e-9, 6) AS value FROM {rate_sql('cpu_samples', CONTAINER)} r""")
def metric_rate(spark, sf_dir):
    r = M.rate(_v(spark, sf_dir).cpu_samples(), CONTAINER, GRID, RANGE)
    return r.select(*CONTAINER, "ts", round6("value").alias("value"))


@register("metric_rate_simple", oracle=f"""
WITH {GRID_CTE}
SELECT pod, pod_namespace, container, gts AS ts, round(((lv - fv + corr_extra) / CAST({RANGE} AS DOUBLE)) + 1e-9, 6) AS value FROM (
  SELECT pod, pod_namespace, container, gts, count(*) AS n, arg_min(value, t_us) AS fv, arg_max(value, t_us) AS lv,
    sum(corr) - arg_min(corr, t_us) AS corr_extra
  FROM (SELECT s.*, CASE WHEN value < prev THEN prev ELSE 0 END AS corr, grid.gts FROM
        (SELECT pod, pod_namespace, container, value, epoch_us(ts) AS t_us,
           lag(value) OVER (PARTITION BY pod, pod_namespace, container ORDER BY ts) AS prev FROM cpu_samples) s
        JOIN grid ON s.t_us > grid.g_us - {RANGE * 1_000_000} AND s.t_us <= grid.g_us) w
  GROUP BY pod, pod_namespace, container, gts HAVING count(*) >= 2) a""")
def metric_rate_simple(spark, sf_dir):
    r = M.rate(_v(spark, sf_dir).cpu_samples(), CONTAINER, GRID, RANGE, mode="simple")
    return r.select(*CONTAINER, "ts", round6("value").alias("value"))


@register("metric_instant", oracle=f"""
WITH {GRID_CTE}
SELECT * FROM {instant_sql('gauge_samples', CONTAINER, ['memory_bytes'])} i""")
def metric_instant(spark, sf_dir):
    return M.instant(_v(spark, sf_dir).gauge_samples(), CONTAINER, GRID, ["memory_bytes"], LOOK)


@register("metric_label_match", oracle="""
SELECT destination_pod, status, ts FROM http_samples
WHERE reporter = 'client' AND destination_pod <> '' AND regexp_full_match(status, '[45]..?')""")
def metric_label_match(spark, sf_dir):
    f = M.label_match(_v(spark, sf_dir).http_samples(), equal={"reporter": "client"},
                      not_equal={"destination_pod": ""}, regex={"status": "[45]..?"})
    return f.select("destination_pod", "status", "ts")


@register("metric_pod_join", oracle=f"""
WITH {GRID_CTE}
SELECT r.pod, r.pod_namespace, r.container, r.ts, round((r.value) + 1e-9, 6) AS value, p.component_uid, p.environment_uid
FROM {CPU_RATE_SQL} r JOIN {SCOPED_PODS} p
  ON r.pod = p.pod AND r.pod_namespace = p.pod_namespace""")
def metric_pod_join(spark, sf_dir):
    v = _v(spark, sf_dir)
    r = M.rate(R.containers(v.cpu_samples()), CONTAINER, GRID, RANGE)
    j = M.join_pod_labels(r, M.pod_labels(v.pods(), SCOPE), carry=["component_uid", "environment_uid"])
    return j.select(*CONTAINER, "ts", round6("value").alias("value"), "component_uid",
                    "environment_uid")


@register("metric_running_semi", oracle=f"""
WITH {GRID_CTE},
req AS {instant_sql(GAUGE_SRC, CONTAINER, ['cpu_request'])},
ph AS {instant_sql('gauge_samples', ['pod', 'pod_namespace'], ['phase_running'])}
SELECT pod, pod_namespace, container, ts, cpu_request AS value FROM req
WHERE EXISTS (SELECT 1 FROM ph WHERE ph.pod = req.pod AND ph.pod_namespace = req.pod_namespace
              AND ph.ts = req.ts AND ph.phase_running = 1)""")
def metric_running_semi(spark, sf_dir):
    g = _v(spark, sf_dir).gauge_samples()
    inst = M.instant(R.containers(g), CONTAINER, GRID, ["cpu_request"], LOOK).withColumnRenamed("cpu_request", "value")
    phase = M.instant(g, R.POD_KEYS, GRID, ["phase_running"], LOOK)
    return M.running_semi(inst, phase, R.POD_KEYS)


_HTTP_KEYS = ["destination_pod", "destination_namespace", "reporter", "status"]


@register("http_destination_join", oracle=f"""
WITH {GRID_CTE}
SELECT r.destination_pod, r.destination_namespace, r.status, r.ts, round((r.value) + 1e-9, 6) AS value, p.environment_uid
FROM {rate_sql('http_samples', _HTTP_KEYS, where="reporter = 'client'")} r JOIN {DEST_PODS} p
  ON r.destination_pod = p.destination_pod AND r.destination_namespace = p.destination_namespace""")
def http_destination_join(spark, sf_dir):
    v = _v(spark, sf_dir)
    r = M.rate(M.label_match(v.http_samples(), equal={"reporter": "client"}), _HTTP_KEYS, GRID, RANGE)
    j = M.join_pod_labels(r, M.pod_labels(v.pods(), SCOPE), on=R.DEST_KEYS, carry=["environment_uid"],
                          rename=R.DEST_RENAME)
    return j.select("destination_pod", "destination_namespace", "status", "ts",
                    round6("value").alias("value"), "environment_uid")


@register("metric_sum_by", oracle=f"""
WITH {GRID_CTE}
SELECT p.component_uid, p.project_uid, r.ts, round((sum(r.value)) + 1e-9, 6) AS value
FROM {CPU_RATE_SQL} r
JOIN (SELECT * FROM pods WHERE namespace = '{NS}') p ON r.pod = p.pod AND r.pod_namespace = p.pod_namespace
GROUP BY p.component_uid, p.project_uid, r.ts""")
def metric_sum_by(spark, sf_dir):
    v = _v(spark, sf_dir)
    scope = Scope(NS)
    r = M.rate(R.containers(v.cpu_samples()), CONTAINER, GRID, RANGE)
    j = M.join_pod_labels(r, M.pod_labels(v.pods(), scope), carry=["component_uid", "project_uid"])
    s = M.sum_by(j, ["component_uid", "project_uid"])
    return s.select("component_uid", "project_uid", "ts", round6("value").alias("value"))


def _sum_sql(series_sql: str, on_pod: bool = True) -> str:
    pods = SCOPED_PODS if on_pod else DEST_PODS
    if on_pod:
        cond = "x.pod = p.pod AND x.pod_namespace = p.pod_namespace"
    else:
        cond = "x.destination_pod = p.destination_pod AND x.destination_namespace = p.destination_namespace"
    return (f"SELECT p.environment_uid, x.ts, sum(x.value) AS value FROM {series_sql} x JOIN {pods} p ON {cond} "
            f"GROUP BY p.environment_uid, x.ts")


def _requested_sql(col: str) -> str:
    inst = instant_sql(GAUGE_SRC, CONTAINER, [col])
    phase = instant_sql("gauge_samples", ["pod", "pod_namespace"], ["phase_running"])  # a label of the pod
    return _sum_sql(f"(SELECT i.pod, i.pod_namespace, i.ts, i.{col} AS value FROM {inst} i JOIN {phase} ph "
                    "ON i.pod = ph.pod AND i.pod_namespace = ph.pod_namespace AND i.ts = ph.ts WHERE ph.phase_running = 1)")


def _round(sql: str) -> str:
    return f"SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value FROM ({sql}) z"


def _rounded(df):
    return df.select(*SCOPE.label_columns(), "ts", round6("value").alias("value"))


@register("cpu_usage", oracle=f"WITH {GRID_CTE} " + _round(_sum_sql(CPU_RATE_SQL)))
def cpu_usage(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.cpu_usage(v.cpu_samples(), v.pods(), SCOPE, GRID, RANGE))


@register("cpu_requests", oracle=f"WITH {GRID_CTE} " + _round(_requested_sql("cpu_request")))
def cpu_requests(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.cpu_requests(v.gauge_samples(), v.pods(), SCOPE, GRID, LOOK))


@register("cpu_limits", oracle=f"WITH {GRID_CTE} " + _round(_requested_sql("cpu_limit")))
def cpu_limits(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.cpu_limits(v.gauge_samples(), v.pods(), SCOPE, GRID, LOOK))


@register("memory_usage", oracle=f"WITH {GRID_CTE} " + _round(_sum_sql(
    f"(SELECT pod, pod_namespace, ts, memory_bytes AS value FROM "
    f"{instant_sql(GAUGE_SRC, CONTAINER, ['memory_bytes'])} i)")))
def memory_usage(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.memory_usage(v.gauge_samples(), v.pods(), SCOPE, GRID, LOOK))


@register("memory_requests", oracle=f"WITH {GRID_CTE} " + _round(_requested_sql("memory_request")))
def memory_requests(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.memory_requests(v.gauge_samples(), v.pods(), SCOPE, GRID, LOOK))


@register("memory_limits", oracle=f"WITH {GRID_CTE} " + _round(_requested_sql("memory_limit")))
def memory_limits(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.memory_limits(v.gauge_samples(), v.pods(), SCOPE, GRID, LOOK))


def _http_sql(status_re: str | None) -> str:
    where = "reporter = 'client'" + (f" AND regexp_full_match(status, '{status_re}')" if status_re else "")
    inner = _sum_sql(rate_sql("http_samples", _HTTP_KEYS, where=where), on_pod=False)
    return f"WITH {GRID_CTE} SELECT * FROM ({_round(inner)}) q WHERE value >= 0 AND NOT isnan(value)"


@register("http_requests", oracle=_http_sql(None))
def http_requests(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.http_requests(v.http_samples(), v.pods(), SCOPE, GRID, RANGE))


@register("http_requests_success", oracle=_http_sql("[123]..?"))
def http_requests_success(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.http_requests(v.http_samples(), v.pods(), SCOPE, GRID, RANGE, R.SUCCESS_STATUS))


@register("http_requests_failed", oracle=_http_sql("[45]..?"))
def http_requests_failed(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.http_requests(v.http_samples(), v.pods(), SCOPE, GRID, RANGE, R.FAILED_STATUS))


_LAT_NUM = _sum_sql(rate_sql("http_duration_sum", ["destination_pod", "destination_namespace", "reporter"],
                             where="reporter = 'client'"), on_pod=False)
_LAT_DEN = _sum_sql(rate_sql("http_samples", _HTTP_KEYS, where="reporter = 'client'"), on_pod=False)


@register("http_latency_mean", oracle=f"""
WITH {GRID_CTE}, num AS ({_LAT_NUM}), den AS ({_LAT_DEN}),
q AS (SELECT num.environment_uid, num.ts,
        CASE WHEN den.value = 0 THEN CASE WHEN num.value = 0 THEN NULL WHEN num.value > 0 THEN CAST('Infinity' AS DOUBLE)
             ELSE CAST('-Infinity' AS DOUBLE) END ELSE num.value / den.value END AS value
      FROM num JOIN den ON num.environment_uid = den.environment_uid AND num.ts = den.ts)
SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value FROM q WHERE value >= 0 AND NOT isnan(value)""")
def http_latency_mean(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(R.http_latency_mean(v.http_duration_sum(), v.http_samples(), v.pods(), SCOPE, GRID, RANGE))


def _quantile_sql(q: float) -> str:
    rates = rate_sql("http_buckets", ["destination_pod", "destination_namespace", "reporter", "le"], where="reporter = 'client'")
    return f"""
WITH {GRID_CTE},
bs AS (SELECT p.environment_uid, x.le, x.ts, sum(x.value) AS v FROM {rates} x JOIN {DEST_PODS} p
       ON x.destination_pod = p.destination_pod AND x.destination_namespace = p.destination_namespace
       GROUP BY p.environment_uid, x.le, x.ts),
h AS (SELECT environment_uid, ts, le,
        max(v) OVER (PARTITION BY environment_uid, ts ORDER BY le ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mv,
        row_number() OVER (PARTITION BY environment_uid, ts ORDER BY le) AS pos,
        count(*) OVER (PARTITION BY environment_uid, ts) AS k,
        max(le) OVER (PARTITION BY environment_uid, ts) AS maxle FROM bs),
h2 AS (SELECT *, max(CASE WHEN pos = k THEN mv END) OVER (PARTITION BY environment_uid, ts) AS total,
        lag(le) OVER (PARTITION BY environment_uid, ts ORDER BY le) AS ple,
        lag(mv) OVER (PARTITION BY environment_uid, ts ORDER BY le) AS pmv,
        max(CASE WHEN pos = k - 1 THEN le END) OVER (PARTITION BY environment_uid, ts) AS le_second_last FROM h),
pick AS (SELECT environment_uid, ts, min(pos) AS b FROM h2 WHERE mv >= {q} * total GROUP BY environment_uid, ts),
res AS (SELECT h2.environment_uid, h2.ts,
  CASE WHEN h2.maxle <> CAST('Infinity' AS DOUBLE) THEN NULL WHEN h2.k < 2 THEN NULL WHEN h2.total = 0 THEN NULL
       WHEN pick.b = h2.k THEN h2.le_second_last
       WHEN pick.b = 1 AND h2.le <= 0 THEN h2.le
       WHEN pick.b = 1 THEN h2.le * (({q} * h2.total) / h2.mv)
       ELSE h2.ple + (h2.le - h2.ple) * (({q} * h2.total - h2.pmv) / (h2.mv - h2.pmv)) END AS value
  FROM h2 JOIN pick ON h2.environment_uid = pick.environment_uid AND h2.ts = pick.ts AND h2.pos = pick.b)
SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value FROM res WHERE value >= 0 AND NOT isnan(value)"""


def _quantile(q):
    def run(spark, sf_dir):
        v = _v(spark, sf_dir)
        return _rounded(R.http_latency_quantile(v.http_buckets(), v.pods(), SCOPE, GRID, q, RANGE))
    return run


register("http_latency_p50", oracle=_quantile_sql(0.5))(_quantile(0.5))
register("http_latency_p90", oracle=_quantile_sql(0.9))(_quantile(0.9))
register("http_latency_p99", oracle=_quantile_sql(0.99))(_quantile(0.99))


@register("metric_nonnegative", oracle=f"""
WITH {GRID_CTE}
SELECT pod, pod_namespace, ts, value FROM (
  SELECT pod, pod_namespace, ts, CASE WHEN memory_bytes = 0 THEN NULL ELSE memory_bytes - 100000000 END AS value
  FROM {instant_sql('gauge_samples', ['pod', 'pod_namespace'], ['memory_bytes'])} i) d
WHERE value >= 0 AND NOT isnan(value)""")
def metric_nonnegative(spark, sf_dir):
    # a gauge shifted below zero for most pods, with NaN (NULL) where the source is 0
    i = M.instant(_v(spark, sf_dir).gauge_samples(), R.POD_KEYS, GRID, ["memory_bytes"], LOOK)
    d = i.select("pod", "pod_namespace", "ts", F.when(F.col("memory_bytes") == 0, F.lit(None).cast("double"))
                 .otherwise(F.col("memory_bytes") - F.lit(100000000.0)).alias("value"))
    return M.nonnegative(d)


_RES_SERIES = {
    "cpu_usage": _sum_sql(CPU_RATE_SQL),
    "cpu_requests": _requested_sql("cpu_request"),
    "cpu_limits": _requested_sql("cpu_limit"),
    "memory_usage": _sum_sql(f"(SELECT pod, pod_namespace, ts, memory_bytes AS value FROM "
                             f"{instant_sql(GAUGE_SRC, CONTAINER, ['memory_bytes'])} i)"),
    "memory_requests": _requested_sql("memory_request"),
    "memory_limits": _requested_sql("memory_limit"),
}


@register("resource_metrics", oracle=f"WITH {GRID_CTE} " + " UNION ALL ".join(
    f"SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value, '{k}' AS series FROM ({s}) z{i}"
    for i, (k, s) in enumerate(_RES_SERIES.items())))
def resource_metrics(spark, sf_dir):
    v = _v(spark, sf_dir)
    u = R.resource_metrics(v.cpu_samples(), v.gauge_samples(), v.pods(), SCOPE, GRID, RANGE, LOOK)
    return u.select("environment_uid", "ts", round6("value").alias("value"), "series")


def _strip_with(sql: str) -> str:
    body = sql.strip()
    prefix = f"WITH {GRID_CTE}"
    assert body.startswith(prefix)
    return body[len(prefix):].lstrip().lstrip(",").strip()


def _http_bundle_sql() -> str:
    parts = {
        "requests": _http_sql(None), "requests_success": _http_sql("[123]..?"),
        "requests_failed": _http_sql("[45]..?"),
    }
    ctes, selects = [], []
    for i, (name, sql) in enumerate(parts.items()):
        ctes.append(f"p{i} AS ({_strip_with(sql)})")
        selects.append(f"SELECT environment_uid, ts, value, '{name}' AS series FROM p{i}")
    lat = f"""num AS ({_LAT_NUM}), den AS ({_LAT_DEN}),
lm AS (SELECT num.environment_uid, num.ts, CASE WHEN den.value = 0 THEN CASE WHEN num.value = 0 THEN NULL
         WHEN num.value > 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST('-Infinity' AS DOUBLE) END
         ELSE num.value / den.value END AS value FROM num JOIN den ON num.environment_uid = den.environment_uid AND num.ts = den.ts)"""
    ctes.append(lat)
    selects.append("SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value, 'latency_mean' AS series FROM lm "
                   "WHERE value >= 0 AND NOT isnan(value)")
    for j, (name, q) in enumerate((("latency_p50", 0.5), ("latency_p90", 0.9), ("latency_p99", 0.99))):
        body = _strip_with(_quantile_sql(q))
        # rename the quantile CTEs so the three copies do not clash
        for c in ("bs", "h2", "h", "pick", "res"):
            body = body.replace(f"{c} AS (", f"{c}{j} AS (")
        body = (body.replace(" FROM bs)", f" FROM bs{j})").replace(" FROM bs\n", f" FROM bs{j}\n")
                .replace("FROM h)", f"FROM h{j})").replace("FROM h2 WHERE", f"FROM h2{j} WHERE")
                .replace("FROM h2 JOIN pick", f"FROM h2{j} JOIN pick{j}")
                .replace("h2.", f"h2{j}.").replace("pick.", f"pick{j}.").replace("FROM res", f"FROM res{j}"))
        last_select = body.rindex("SELECT environment_uid, ts, round((value) + 1e-9, 6)")
        ctes.append(body[:last_select].rstrip().rstrip(","))
        selects.append(f"SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value, '{name}' AS series FROM res{j} "
                       "WHERE value >= 0 AND NOT isnan(value)")
    return f"WITH {GRID_CTE}, " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(selects)


@register("http_metrics", oracle=_http_bundle_sql())
def http_metrics(spark, sf_dir):
    v = _v(spark, sf_dir)
    u = R.http_metrics(v.http_samples(), v.http_duration_sum(), v.http_buckets(), v.pods(), SCOPE, GRID, RANGE)
    return u.select("environment_uid", "ts", round6("value").alias("value"), "series")


@register("metric_first_series", oracle=f"""
WITH {GRID_CTE}, s AS ({_sum_sql(CPU_RATE_SQL)})
SELECT environment_uid, ts, round((value) + 1e-9, 6) AS value FROM s
WHERE environment_uid = (SELECT min(environment_uid) FROM s)""")
def metric_first_series(spark, sf_dir):
    v = _v(spark, sf_dir)
    return _rounded(M.first_series(R.cpu_usage(v.cpu_samples(), v.pods(), SCOPE, GRID, RANGE),
                                   SCOPE.label_columns()))


@register("metric_points", oracle=f"""
WITH {GRID_CTE}
SELECT ts, CAST(memory_bytes AS DOUBLE) AS value FROM {instant_sql('gauge_samples', ['pod', 'pod_namespace'], ['memory_bytes'])} i
WHERE pod = 'pod-7'""")
def metric_points(spark, sf_dir):
    i = M.instant(_v(spark, sf_dir).gauge_samples(), R.POD_KEYS, GRID, ["memory_bytes"], LOOK)
    return M.to_points(i.filter(F.col("pod") == "pod-7"), value_col="memory_bytes")
