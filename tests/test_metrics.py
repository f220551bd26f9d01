import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylight.operators import metrics as M

T0 = dt.datetime(2024, 1, 1)


def _samples(spark, pts, key="s"):
    rows = [(key, T0 + dt.timedelta(seconds=t), float(v)) for t, v in pts]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")


def _grid(g0_s, g1_s, step_s):
    return M.Grid.of(T0 + dt.timedelta(seconds=g0_s), T0 + dt.timedelta(seconds=g1_s), step_s)


def test_rate_extrapolated_steady_counter(spark):
    df = _samples(spark, [(0, 0), (60, 60), (120, 120)])
    out = M.rate(df, ["series"], _grid(120, 120, 60), range_s=120).collect()
    # window (0, 120]: two samples, extrapolated to the window start
    assert len(out) == 1 and out[0].value == pytest.approx(1.0)


def test_rate_counts_resets(spark):
    df = _samples(spark, [(10, 100), (40, 5), (70, 35)])
    out = M.rate(df, ["series"], _grid(90, 90, 60), range_s=90, mode="simple").collect()
    assert out[0].value == pytest.approx(35 / 90)


def test_rate_needs_two_samples(spark):
    df = _samples(spark, [(10, 1)])
    assert M.rate(df, ["series"], _grid(60, 60, 60), range_s=120).count() == 0


def test_explode_when_range_shorter_than_step(spark):
    df = _samples(spark, [(10, 1), (200, 2)])
    x = M.explode_to_grid(df, _grid(0, 300, 300), range_s=120).select("value", "g").collect()
    assert [(r.value, r.g) for r in x] == [(2.0, 1)]


def test_instant_takes_latest_in_lookback(spark):
    df = _samples(spark, [(0, 1), (100, 2), (250, 3)])
    out = M.instant(df, ["series"], _grid(200, 400, 200), ["value"], lookback_s=160).orderBy("ts").collect()
    assert [r.value for r in out] == [2.0, 3.0]


def _buckets(spark, rows):
    return spark.createDataFrame([("x", T0, float(le), float(v)) for le, v in rows],
                                 "lbl string, ts timestamp_ntz, le double, value double")


@pytest.mark.parametrize("q,expected", [(0.5, 1.0), (0.9, 1.8)])
def test_histogram_quantile_interpolates(spark, q, expected):
    b = _buckets(spark, [(1, 5), (2, 10), (float("inf"), 10)])
    assert M.histogram_quantile(b, q, ["lbl"]).collect()[0].value == pytest.approx(expected)


def test_histogram_quantile_in_inf_bucket_and_nan_cases(spark):
    b = _buckets(spark, [(1, 5), (float("inf"), 10)])
    assert M.histogram_quantile(b, 0.99, ["lbl"]).collect()[0].value == pytest.approx(1.0)
    no_inf = _buckets(spark, [(1, 5), (2, 10)])
    assert M.histogram_quantile(no_inf, 0.5, ["lbl"]).collect()[0].value is None
    empty = _buckets(spark, [(1, 0), (float("inf"), 0)])
    assert M.nonnegative(M.histogram_quantile(empty, 0.5, ["lbl"])).count() == 0


def test_nonnegative_drops_nan_and_negative(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (float("nan"),), (None,), (0.0,)], "value double")
    assert sorted(r.value for r in M.nonnegative(df).collect()) == [0.0, 1.0]


def test_ratio_promql_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(M.ratio(F.col("a"), F.col("b"))).collect()]
    assert got[0] == float("inf") and got[1] is None and got[2] == 1.5


def test_rate_pre_aggregated_by_step_equals_per_sample(spark):
    import random
    rnd = random.Random(5)
    pts, v = [], 0.0
    for t in range(0, 4 * 3600, 15):
        v = 0.0 if rnd.random() < 0.01 else v + rnd.random() * 3  # occasional counter resets
        pts.append((t, v))
    df = _samples(spark, pts)
    grid = _grid(3600, 4 * 3600, 300)
    for range_s in (900, 700, 120):  # whole steps, a part of a step, windows apart
        a = M.rate(df, ["series"], grid, range_s=range_s, mode="simple", pre_aggregate=False)
        b = M.rate(df, ["series"], grid, range_s=range_s, mode="simple", pre_aggregate=True)
        ra = {r.ts: r.value for r in a.collect()}
        rb = {r.ts: r.value for r in b.collect()}
        plain = {}
        for g in range(3600, 4 * 3600 + 1, 300):
            w = [v for t, v in pts if g - range_s < t <= g]
            if len(w) >= 2:
                plain[g] = sum(y if y < x else y - x for x, y in zip(w, w[1:])) / range_s
        assert ra.keys() == rb.keys() and len(ra) == len(plain) > 0
        assert all(abs(ra[k] - rb[k]) < 1e-9 for k in ra)
        assert all(abs(x - y) < 1e-9 for x, y in zip([ra[k] for k in sorted(ra)], [plain[g] for g in sorted(plain)]))


def test_series_identity_keeps_all_labels(spark):
    """Two containers are two series: limits add up, counters do not mix; the
    pod-level total is left out; a running pod is known by its phase alone."""
    from skylight.functions.scope import Scope
    from skylight.operators import resources as R
    t = "2024-01-01 00:0%d:00"
    pods = spark.createDataFrame([("p", "k", "n", "pr", "e", "c")],
                                 "pod string, pod_namespace string, namespace string, project_uid string, environment_uid string, component_uid string")
    gauges = spark.createDataFrame(
        [("p", "k", c, t % 1, 1.0, lim, 1) for c, lim in (("a", 1.0), ("b", 2.0), ("", 50.0))],
        "pod string, pod_namespace string, container string, t string, memory_bytes double, cpu_limit double, phase_running int"
    ).withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    grid = M.Grid.of("2024-01-01 00:02:00", "2024-01-01 00:02:00", 60)
    scope = Scope("n", environment="e")
    assert [r["value"] for r in R.cpu_limits(gauges, pods, scope, grid).collect()] == [3.0]
    rows = [("p", "k", c, t % m, v) for c, vs in (("a", (0.0, 60.0)), ("b", (1000.0, 1060.0)), ("", (9000.0, 9999.0)))
            for m, v in zip((1, 2), vs)]
    cpu = spark.createDataFrame(rows, "pod string, pod_namespace string, container string, t string, value double").withColumn(
        "ts", F.col("t").cast("timestamp_ntz")).drop("t")
    value = R.cpu_usage(cpu, pods, scope, grid, 120).collect()[0]["value"]
    alone = R.cpu_usage(cpu.filter("container = 'a'"), pods, scope, grid, 120).collect()[0]["value"]
    other = R.cpu_usage(cpu.filter("container = 'b'"), pods, scope, grid, 120).collect()[0]["value"]
    assert abs(value - alone - other) < 1e-9


def test_many_to_one_needs_unique_right_side(spark):
    left = spark.createDataFrame([("p", "k", 1.0)], "pod string, pod_namespace string, value double")
    twice = spark.createDataFrame([("p", "k", "c1"), ("p", "k", "c2")], "pod string, pod_namespace string, component_uid string")
    with pytest.raises(Exception, match="many-to-one"):
        M.join_pod_labels(left, twice, carry=["component_uid"]).collect()


def test_long_range_over_short_step(spark):
    """No limit on range / step."""
    df = spark.createDataFrame([("a", "2024-01-01 00:00:30")], "k string, t string").select("k", F.col("t").cast("timestamp_ntz").alias("ts"))
    grid = M.Grid.of("2024-01-01 00:00:00", "2024-01-01 23:59:00", 60)
    assert M.explode_to_grid(df, grid, 2 * 86400).count() == 1439


def test_rate_is_not_merged_into_few_tasks(spark):
    """The aggregates keep all shuffle partitions, however little is shuffled."""
    rows = [(f"p{i % 40}", dt.datetime(2024, 1, 3) + dt.timedelta(hours=i // 40), float(i)) for i in range(400)]
    samples = spark.createDataFrame(rows, "pod string, ts timestamp_ntz, value double")
    for range_s in (7200, 3600):
        r = M.rate(samples, ["pod"], M.Grid.of("2024-01-03 00:00:00", "2024-01-03 09:00:00", 3600), range_s)
        assert r.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
