import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylight.operators import alerts as A

T0 = dt.datetime(2024, 1, 1)


def test_compare_ops(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    got = df.select(*[A.compare(F.col("v"), op, 5.0).alias(op) for op in A.OPS_SQL]).collect()[0]
    assert (got.gt, got.gte, got.lt, got.lte, got.eq, got.neq) == (False, True, False, True, True, False)
    with pytest.raises(ValueError):
        A.validate_op("neq", "search")


def _rules(spark, rows):
    return spark.createDataFrame(rows, "rule_name string, namespace string, component_uid string, project_uid string, "
                                       "environment_uid string, phrase string, op string, threshold double, "
                                       "window_min bigint, interval_min bigint, enabled boolean")


def test_log_alert_ticks_inclusive_window_and_zero_counts(spark):
    logs = spark.createDataFrame([
        (T0 + dt.timedelta(minutes=10), "boom ERROR", "c", "e", "p"),
        (T0 + dt.timedelta(minutes=20), "boom ERROR", "c", "e", "p"),   # exactly on a tick: counted (inclusive)
        (T0 + dt.timedelta(minutes=25), "fine", "c", "e", "p"),
    ], "ts timestamp_ntz, log string, component_uid string, environment_uid string, project_uid string")
    rules = _rules(spark, [("r", "ns", "c", "p", "e", "ERROR", "gt", 0.0, 10, 10, True),
                           ("off", "ns", "c", "p", "e", "ERROR", "gt", 0.0, 10, 10, False)])
    out = {r.tick: (r.n, r.firing) for r in A.log_alert_ticks(logs, rules, T0, T0 + dt.timedelta(minutes=40)).collect()}
    m = lambda x: T0 + dt.timedelta(minutes=x)
    assert out == {m(0): (0, False), m(10): (1, True), m(20): (2, True), m(30): (1, True), m(40): (0, False)}
    sql = {r.tick: r.n for r in A.log_alert_ticks(logs, rules, T0, T0 + dt.timedelta(minutes=40), store="sql").collect()}
    assert sql[m(20)] == 1 and sql[m(30)] == 1  # [tick - w, tick)


def test_fire_after_islands(spark):
    vals = [30, 30, 30, 5, 30, 30]
    df = spark.createDataFrame([("u", T0 + dt.timedelta(hours=12 * i), float(v)) for i, v in enumerate(vals)],
                               "k string, ts timestamp_ntz, v double")
    out = A.fire_after(df, ["k"], "ts", F.col("v") > 20, 86400).orderBy("ts").collect()
    assert [r.firing for r in out] == [False, False, True, False, False, False]


def test_throttle_fold(spark):
    ticks = [0, 30, 61, 90, 125]
    df = spark.createDataFrame([("r", T0 + dt.timedelta(minutes=t)) for t in ticks], "rule_name string, tick timestamp_ntz")
    out = [r.tick for r in A.throttle(df, "rule_name", "tick", 3600).orderBy("tick").collect()]
    assert out == [T0, T0 + dt.timedelta(minutes=61), T0 + dt.timedelta(minutes=125)]


def test_metrics_webhook_only_firing_any_case(spark):
    body = ('{"alerts":[{"status":" FIRING ","startsAt":"bad","annotations":{"rule_name":"a","rule_namespace":"n","alert_value":"1.5"}},'
            '{"status":"resolved","startsAt":"2024-01-01T00:00:00Z","annotations":{"rule_name":"b","rule_namespace":"n","alert_value":"2"}},'
            '{"status":"firing","startsAt":"2024-01-01T00:00:00Z","annotations":{"rule_name":"c","rule_namespace":"","alert_value":"2"}}]}')
    hooks = spark.createDataFrame([(1, T0, "metrics", body)], "event_id long, received_at timestamp_ntz, shape string, body string")
    ok, bad = A.normalize_webhooks(hooks)
    ok = ok.collect()
    assert [(r.rule_name, r.alert_value, r.alert_ts) for r in ok] == [("a", 1.5, T0)]  # bad time -> receive time
    assert [r.reject_reason for r in bad.collect()] == ["missing rule_namespace annotation"]


def test_search_webhook_missing_name_rejected(spark):
    hooks = spark.createDataFrame([(1, T0, "search", '{"alertValue": 3}')],
                                  "event_id long, received_at timestamp_ntz, shape string, body string")
    ok, bad = A.normalize_webhooks(hooks)
    assert ok.count() == 0 and bad.collect()[0].reject_reason == "missing ruleName"


def test_rule_validation(spark):
    df = spark.createDataFrame([("a", "5m", "1m", "gt", "cpu_usage"), ("b", "90s", "30s", "neq", "disk"),
                                ("c", "1h30m", "2h", "eq", "memory_usage"), ("d", "-5m", "0", "lt", "cpu_usage")],
                               "rule_name string, window string, interval string, op string, metric string")
    got = {r.rule_name: r for r in A.validate_rules(df).collect()}
    assert got["a"].search_ok and got["a"].sql_ok and got["a"].metrics_ok
    assert not got["b"].search_ok and not got["b"].sql_ok and got["b"].metrics_reason == "unsupported metric type"
    assert got["c"].search_ok is False and got["c"].search_reason == "unknown operator" and got["c"].metrics_ok
    assert got["d"].metrics_reason == "window must be positive" and got["d"].sql_ok is False


def test_rule_diff(spark):
    d = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "rule_name string, threshold double")
    e = spark.createDataFrame([("b", 2.0), ("c", 4.0), ("z", 1.0)], "rule_name string, threshold double")
    got = {r.rule_name: r.action for r in A.diff_rules(d, e, spec_cols=["threshold"]).collect()}
    assert got == {"a": "created", "b": "unchanged", "c": "updated", "z": "deleted"}


def throttle_fold(firing, key, ts_col, every_s):
    """A7 over plain Python rows: a tick is sent when the gap has passed."""
    sent, last = set(), {}
    for k, t in sorted((r[key], r[ts_col]) for r in firing.collect()):
        if k not in last or t >= last[k] + dt.timedelta(seconds=every_s):
            sent.add((k, t))
            last[k] = t
    return sent


def test_throttle_scan_equals_fold(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for rule in ("a", "b", "c"):
        t = 0
        for _ in range(300 if rule == "a" else 40):
            t += rnd.choice([1, 1, 2, 5, 7, 30, 61, 90])
            rows.append((rule, T0 + dt.timedelta(minutes=t)))
    rows += [("dense", T0 + dt.timedelta(seconds=20 * i)) for i in range(1500)]  # chains that never merge
    df = spark.createDataFrame(rows, "rule_name string, tick timestamp_ntz")
    want = throttle_fold(df, "rule_name", "tick", 3600)
    reuse = spark.conf.get("spark.sql.exchange.reuse")
    try:
        for gaps in (1, 3, 64):
            for on in ("true", "false"):  # blocks do not depend on a shared exchange
                spark.conf.set("spark.sql.exchange.reuse", on)
                got = A.throttle(df, "rule_name", "tick", 3600, block_gaps=gaps).collect()
                assert len(got) == len(want) > 0 and {(r.rule_name, r.tick) for r in got} == want
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)


def test_cpu_alert_rate_window_has_a_two_minute_minimum(spark):
    from skylight.operators import metrics as M
    cpu = spark.createDataFrame([("p", "ns", T0 + dt.timedelta(seconds=s), float(s)) for s in range(0, 600, 15)],
                                "pod string, pod_namespace string, ts timestamp_ntz, value double")
    gauges = spark.createDataFrame([("p", "ns", T0 + dt.timedelta(seconds=s), 2.0) for s in range(0, 600, 15)],
                                   "pod string, pod_namespace string, ts timestamp_ntz, cpu_limit double")
    pods = spark.createDataFrame([("p", "ns", "c", "pr", "e", "n")],
                                 "pod string, pod_namespace string, component_uid string, project_uid string, "
                                 "environment_uid string, namespace string")
    grid = M.Grid.of(T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=9), 60)
    one_min = A.cpu_percent_alert(cpu, gauges, pods, "c", "pr", "e", grid, 60, "gt", 10.0).orderBy("ts").collect()
    two_min = A.cpu_percent_alert(cpu, gauges, pods, "c", "pr", "e", grid, 120, "gt", 10.0).orderBy("ts").collect()
    assert [r.value for r in one_min] == [r.value for r in two_min]
    # 1 cpu-second per second against a limit of 2 cores: 50 %
    assert all(abs(r.value - 50.0) < 1e-9 and r.firing for r in two_min)
    with pytest.raises(ValueError):
        A.cpu_percent_alert(cpu, gauges, pods, "c", "pr", "e", grid, 60, "neq", 10.0)
