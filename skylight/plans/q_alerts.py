"""Registered alert queries (A1-A12) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylight.functions.numeric import round6
from skylight.operators import alerts as A
from skylight.operators import metrics as M
from skylight.operators.grouping import grouped_notices
from skylight.plans import params as P
from skylight.plans.registry import register
from skylight.sources.fixtures import Views

S, E = P.ALERT_START, P.ALERT_END
GRID = M.Grid.of(P.GRID_START, P.GRID_END, P.GRID_STEP_S)
THROTTLE_S = 24 * 3600
FOR_S = 86400


def _v(spark, sf_dir):
    return Views(spark, sf_dir)


_CMP = ("CASE op WHEN 'gt' THEN x > threshold WHEN 'gte' THEN x >= threshold WHEN 'lt' THEN x < threshold "
        "WHEN 'lte' THEN x <= threshold WHEN 'eq' THEN x = threshold WHEN 'neq' THEN x <> threshold END")


def _ticks_sql(store: str) -> str:
    keys = ["component_uid", "environment_uid", "project_uid"] if store == "search" else [
        "component_uid", "environment_uid"]
    on = " AND ".join(f"l.{k} = t.{k}" for k in keys)
    upper = "<=" if store == "search" else "<"
    cmp = _CMP.replace("x", "CAST(count(l.ts) AS DOUBLE)")
    return f"""r AS (SELECT * FROM rules WHERE enabled),
g AS (SELECT rule_name, unnest(range(0, (epoch_us(TIMESTAMP '{E}') - epoch_us(TIMESTAMP '{S}')) // (interval_min * 60000000) + 1)) AS k FROM r),
t AS (SELECT g.k, r.*, epoch_us(TIMESTAMP '{S}') + g.k * r.interval_min * 60000000 AS tick_us FROM g JOIN r ON g.rule_name = r.rule_name),
a1 AS (SELECT t.rule_name, make_timestamp(t.tick_us) AS tick, count(l.ts) AS n, coalesce({cmp}, false) AS firing
  FROM t LEFT JOIN logs l ON {on} AND contains(l.log, t.phrase)
    AND epoch_us(l.ts) >= t.tick_us - t.window_min * 60000000 AND epoch_us(l.ts) {upper} t.tick_us
  GROUP BY t.rule_name, t.tick_us, t.op, t.threshold)"""


@register("log_alert_ticks", oracle=f"WITH {_ticks_sql('search')} SELECT * FROM a1")
def log_alert_ticks(spark, sf_dir):
    v = _v(spark, sf_dir)
    return A.log_alert_ticks(v.logs(), v.rules(), S, E, store="search")


@register("log_alert_ticks_sql", oracle=f"WITH {_ticks_sql('sql')} SELECT * FROM a1")
def log_alert_ticks_sql(spark, sf_dir):
    v = _v(spark, sf_dir)
    return A.log_alert_ticks(v.logs(), v.rules(), S, E, store="sql")


@register("alert_compare_ops", oracle="""
SELECT component_uid, log_date, n, n > 30 AS gt, n >= 30 AS gte, n < 30 AS lt, n <= 30 AS lte, n = 30 AS eq, n <> 30 AS neq
FROM (SELECT component_uid, log_date, count(*) AS n FROM logs GROUP BY component_uid, log_date) c""")
def alert_compare_ops(spark, sf_dir):
    c = _v(spark, sf_dir).logs().groupBy("component_uid", "log_date").agg(F.count(F.lit(1)).alias("n"))
    x = F.col("n").cast("double")
    return c.select("component_uid", "log_date", "n",
                    *[A.compare(x, op, 30.0).alias(op) for op in A.OPS_SQL])


_CPU_PODS = "(SELECT pod FROM pods WHERE component_uid = 'comp-1' AND project_uid = 'proj-1' AND environment_uid = 'env-1')"


def _pct_sql(num: str, den: str) -> str:
    return f"""SELECT ts, round((value) + 1e-9, 6) AS value, value > 1 AS firing FROM (
  SELECT n.ts, CASE WHEN d.den = 0 THEN CASE WHEN n.num = 0 THEN NULL WHEN n.num > 0 THEN CAST('Infinity' AS DOUBLE)
    ELSE CAST('-Infinity' AS DOUBLE) END ELSE n.num / d.den END * 100 AS value
  FROM ({num}) n JOIN ({den}) d ON n.ts = d.ts) z WHERE value IS NOT NULL AND NOT isnan(value)"""


def _cpu_alert_sql() -> str:
    from skylight.plans.q_metrics import CONTAINER, CPU_RATE_SQL, GAUGE_SRC, GRID_CTE, instant_sql
    num = (f"SELECT x.ts, sum(x.value) AS num FROM {CPU_RATE_SQL} x "
           f"JOIN {_CPU_PODS} p ON x.pod = p.pod GROUP BY x.ts")
    den = (f"SELECT x.ts, sum(x.cpu_limit) AS den FROM {instant_sql(GAUGE_SRC, CONTAINER, ['cpu_limit'])} x "
           f"JOIN {_CPU_PODS} p ON x.pod = p.pod GROUP BY x.ts")
    return f"WITH {GRID_CTE} " + _pct_sql(num, den)


def _mem_alert_sql() -> str:
    from skylight.plans.q_metrics import CONTAINER, GAUGE_SRC, GRID_CTE, instant_sql
    inst = instant_sql(GAUGE_SRC, CONTAINER, ["memory_bytes", "memory_limit"])
    num = f"SELECT x.ts, sum(x.memory_bytes) AS num FROM {inst} x JOIN {_CPU_PODS} p ON x.pod = p.pod GROUP BY x.ts"
    den = f"SELECT x.ts, sum(x.memory_limit) AS den FROM {inst} x JOIN {_CPU_PODS} p ON x.pod = p.pod GROUP BY x.ts"
    return f"WITH {GRID_CTE} " + _pct_sql(num, den)


@register("alert_cpu_percent", oracle=_cpu_alert_sql())
def alert_cpu_percent(spark, sf_dir):
    v = _v(spark, sf_dir)
    # window below the 2-minute minimum is raised to it; here the rule window is 2 days
    out = A.cpu_percent_alert(v.cpu_samples(), v.gauge_samples(), v.pods(), "comp-1", "proj-1", "env-1",
                              GRID, P.RATE_RANGE_S, "gt", 1.0, lookback_s=P.LOOKBACK_S)
    return out.select("ts", round6("value").alias("value"), "firing")


@register("alert_memory_percent", oracle=_mem_alert_sql())
def alert_memory_percent(spark, sf_dir):
    v = _v(spark, sf_dir)
    out = A.memory_percent_alert(v.gauge_samples(), v.pods(), "comp-1", "proj-1", "env-1", GRID, "gt", 1.0,
                                 lookback_s=P.LOOKBACK_S)
    return out.select("ts", round6("value").alias("value"), "firing")


@register("alert_for_duration", oracle="""
WITH e AS (SELECT user_id, event_id, ts, value > 20 AS c FROM events),
m AS (SELECT *, max(CASE WHEN NOT c THEN ts END) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_false FROM e),
s AS (SELECT *, min(CASE WHEN c THEN ts END) OVER (PARTITION BY user_id, last_false) AS island_start FROM m)
SELECT user_id, event_id, ts, island_start FROM s
WHERE c AND epoch_us(ts) - epoch_us(island_start) >= 86400000000""")
def alert_for_duration(spark, sf_dir):
    ev = _v(spark, sf_dir).events.select("user_id", "event_id", "ts", "value")
    f = A.fire_after(ev, ["user_id"], "ts", F.col("value") > 20, FOR_S)
    return f.filter("firing").select("user_id", "event_id", "ts", "island_start")


def _throttle_sql(src: str, key: str, ts: str, every_us: int) -> str:
    return f"""sent AS (SELECT {key}, min({ts}) AS {ts} FROM {src} GROUP BY {key}
  UNION ALL
  SELECT f.{key}, min(f.{ts}) FROM sent JOIN {src} f ON f.{key} = sent.{key}
    AND epoch_us(f.{ts}) >= epoch_us(sent.{ts}) + {every_us} GROUP BY f.{key})"""


@register("alert_throttled", oracle=f"""
WITH RECURSIVE {_ticks_sql('search')}, f AS (SELECT rule_name, tick FROM a1 WHERE firing),
{_throttle_sql('f', 'rule_name', 'tick', THROTTLE_S * 1_000_000)}
SELECT rule_name, tick FROM sent""")
def alert_throttled(spark, sf_dir):
    v = _v(spark, sf_dir)
    ticks = A.log_alert_ticks(v.logs(), v.rules(), S, E, store="search").filter("firing")
    return A.throttle(ticks.select("rule_name", "tick"), "rule_name", "tick", THROTTLE_S)


@register("alert_notifications", oracle=f"""
WITH RECURSIVE {_ticks_sql('search')},
lab AS (SELECT a1.*, CASE WHEN rules.namespace = 'ns-0' THEN 'true' ELSE 'false' END AS managed
        FROM a1 JOIN rules ON a1.rule_name = rules.rule_name WHERE a1.firing),
grp AS (SELECT rule_name, min(tick) AS tick, count(*) AS n FROM lab WHERE managed = 'true'
        GROUP BY rule_name, time_bucket(INTERVAL 5 MINUTE, tick)),
{_throttle_sql('grp', 'rule_name', 'tick', 12 * 3600 * 1_000_000)}
SELECT sent.rule_name, sent.tick, grp.n FROM sent JOIN grp ON sent.rule_name = grp.rule_name AND sent.tick = grp.tick""")
def alert_notifications(spark, sf_dir):
    v = _v(spark, sf_dir)
    ticks = A.log_alert_ticks(v.logs(), v.rules(), S, E, store="search").filter("firing")
    labelled = ticks.join(v.rules().select("rule_name", F.when(F.col("namespace") == "ns-0", "true")
                                           .otherwise("false").alias("managed")), "rule_name")
    return A.notifications(labelled, "rule_name", "tick", "managed", "true", 300, 12 * 3600)


# every user's events above 20 are sightings of that user's alerts, one per type; those of every seventh user are not ours
@register("alert_grouped_notices", oracle="""
WITH RECURSIVE seen AS (SELECT user_id, event_type, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER w AS before FROM events
  WHERE value > 20 AND user_id % 7 <> 0 AND event_type IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
isl AS (SELECT *, sum(CASE WHEN us - before <= 259200000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY us) AS island FROM seen),
iv AS MATERIALIZED (SELECT user_id, event_type, min(us) AS s, max(us) + 259200000000 AS e FROM isl GROUP BY user_id, event_type, island),
walk AS (
  SELECT user_id, min(s) + 30000000 AS f0, min(s) + 30000000 AS f, CAST([] AS VARCHAR[]) AS told, CAST(NULL AS BIGINT) AS last,
    CAST(NULL AS BIGINT) AS sent, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS n_active, CAST(NULL AS BIGINT) AS n_new FROM iv GROUP BY user_id
  UNION ALL
  SELECT user_id, CASE WHEN n = 0 THEN later + 30000000 ELSE f0 END,
    CASE WHEN n = 0 THEN later + 30000000 ELSE f0 + CAST(ceil((least(coalesce(later, ends), ends, CASE WHEN send THEN f ELSE last END + 43200000000) - f0) / 300000000.0) AS BIGINT) * 300000000 END,
    CASE WHEN n = 0 THEN [] WHEN send THEN act ELSE told END, CASE WHEN n = 0 THEN NULL WHEN send THEN f ELSE last END,
    CASE WHEN send THEN f END, CASE WHEN send THEN CASE WHEN n_fresh > 0 THEN 'new' ELSE 'repeat' END END, n, n_fresh
  FROM (SELECT *, n > 0 AND (n_fresh > 0 OR f - last >= 43200000000) AS send FROM (
    SELECT walk.user_id, f0, f, told, last, count(*) FILTER (s <= f AND e > f) AS n, coalesce(list(event_type) FILTER (s <= f AND e > f), []) AS act,
      count(*) FILTER (s <= f AND e > f AND NOT list_contains(told, event_type)) AS n_fresh, min(s) FILTER (s > f) AS later, min(e) FILTER (e > f) AS ends
    FROM walk JOIN iv ON iv.user_id = walk.user_id WHERE f IS NOT NULL GROUP BY walk.user_id, f0, f, told, last) x) y)
SELECT user_id, make_timestamp(sent) AS notified_at, reason, n_active, n_new FROM walk WHERE sent IS NOT NULL""")
def alert_grouped_notices(spark, sf_dir):
    seen = _v(spark, sf_dir).events.filter("value > 20").withColumn("ours", F.when(F.col("user_id") % 7 != 0, "true").otherwise("false"))
    return grouped_notices(seen.filter("ours = 'true'"), "user_id", "event_type", "ts", resolve_s=3 * 86400)


_ALERTS_JSON = ('[{"status":"VARCHAR","startsAt":"VARCHAR","annotations":'
                '{"rule_name":"VARCHAR","rule_namespace":"VARCHAR","alert_value":"VARCHAR"}}]')
WEBHOOKS_SQL = f"""
sh AS (SELECT event_id, shape, json_extract_string(body, '$.ruleName') AS rule_name,
         json_extract_string(body, '$.ruleNamespace') AS rule_namespace,
         TRY_CAST(json_extract_string(body, '$.alertValue') AS DOUBLE) AS alert_value,
         coalesce(try_strptime(json_extract_string(body, '$.alertTimestamp'), '%Y-%m-%dT%H:%M:%SZ'), received_at) AS alert_ts
       FROM webhooks WHERE shape = 'search' AND json_extract_string(body, '$.ruleName') IS NOT NULL),
sq AS (SELECT event_id, shape, json_extract_string(body, '$.alertName') AS rule_name, CAST(NULL AS VARCHAR) AS rule_namespace,
         TRY_CAST(json_extract_string(body, '$.alertCount') AS DOUBLE) AS alert_value,
         make_timestamp(CAST(json_extract_string(body, '$.alertTriggerTimeMicroSeconds') AS BIGINT)) AS alert_ts
       FROM webhooks WHERE shape = 'sql' AND json_extract_string(body, '$.alertName') IS NOT NULL),
mx AS (SELECT event_id, shape, received_at, unnest(from_json(json_extract(body, '$.alerts'), '{_ALERTS_JSON}')) AS a
       FROM webhooks WHERE shape = 'metrics'),
mt AS (SELECT event_id, shape, trim(a.annotations.rule_name) AS rule_name, trim(a.annotations.rule_namespace) AS rule_namespace,
         CAST(TRY_CAST(trim(a.annotations.alert_value) AS FLOAT) AS DOUBLE) AS alert_value,
         coalesce(try_strptime(a.startsAt, '%Y-%m-%dT%H:%M:%SZ'), received_at) AS alert_ts
       FROM mx WHERE lower(trim(a.status)) = 'firing' AND coalesce(trim(a.annotations.rule_name), '') <> ''
         AND coalesce(trim(a.annotations.rule_namespace), '') <> '' AND TRY_CAST(trim(a.annotations.alert_value) AS DOUBLE) IS NOT NULL),
hooks AS (SELECT * FROM sh UNION ALL SELECT * FROM sq UNION ALL SELECT * FROM mt)"""


@register("alert_events_normalized", oracle=f"WITH {WEBHOOKS_SQL} SELECT * FROM hooks")
def alert_events_normalized(spark, sf_dir):
    ok, _bad = A.normalize_webhooks(_v(spark, sf_dir).webhooks())
    return ok


# stated case by case from the payload rules: one outcome for every payload
@register("alert_webhook_rejects", oracle="""
SELECT event_id, CASE event_id % 9 WHEN 3 THEN 'sql' WHEN 4 THEN 'metrics' WHEN 5 THEN 'mail' WHEN 7 THEN 'sql' WHEN 8 THEN 'metrics'
    ELSE 'search' END AS shape,
  CASE event_id % 9 WHEN 1 THEN 'unreadable body' WHEN 2 THEN 'bad alertValue' WHEN 3 THEN 'bad alertCount' WHEN 4 THEN 'no alerts'
    WHEN 5 THEN 'unknown shape' WHEN 6 THEN 'missing ruleName' WHEN 8 THEN 'missing alert_value annotation' ELSE 'accepted' END AS outcome,
  CASE WHEN event_id % 9 = 0 THEN TIMESTAMP '2024-01-02 03:04:05.25' ELSE ts END AS alert_ts
FROM events""")
def alert_webhook_rejects(spark, sf_dir):
    ok, bad = A.normalize_webhooks(_v(spark, sf_dir).odd_webhooks())
    both = ok.withColumn("reject_reason", F.lit("accepted")).unionByName(bad)
    return both.select("event_id", "shape", F.col("reject_reason").alias("outcome"), "alert_ts")


@register("alert_namespace_lookup", oracle=f"""
WITH {WEBHOOKS_SQL}
SELECT h.event_id, h.rule_name, coalesce(h.rule_namespace, r.namespace) AS rule_namespace
FROM hooks h LEFT JOIN rules r ON h.rule_name = r.rule_name
WHERE coalesce(h.rule_namespace, r.namespace) IS NOT NULL""")
def alert_namespace_lookup(spark, sf_dir):
    v = _v(spark, sf_dir)
    ok, _bad = A.normalize_webhooks(v.webhooks())
    return A.namespace_lookup(ok, v.rules()).select("event_id", "rule_name", "rule_namespace")


def desired_rules(ev):
    """Rule specs derived from the users seen in ``events`` (one rule each)."""
    u = ev.select("user_id").distinct()
    return u.select(F.concat(F.lit("rule-"), F.col("user_id").cast("string")).alias("rule_name"),
                    (F.col("user_id") % 7).cast("double").alias("threshold"),
                    F.when(F.col("user_id") % 2 == 0, "gt").otherwise("lt").alias("op"))


def existing_rules(ev):
    u = ev.select("user_id").distinct()
    kept = u.filter(F.col("user_id") % 5 != 0).select(
        F.concat(F.lit("rule-"), F.col("user_id").cast("string")).alias("rule_name"),
        F.when(F.col("user_id") % 4 == 0, F.col("user_id") % 7 + 1).otherwise(F.col("user_id") % 7)
        .cast("double").alias("threshold"),
        F.when(F.col("user_id") % 2 == 0, "gt").otherwise("lt").alias("op"))
    stale = u.filter(F.col("user_id") % 9 == 0).select(
        F.concat(F.lit("rule-x-"), F.col("user_id").cast("string")).alias("rule_name"),
        F.lit(1.0).alias("threshold"), F.lit("gt").alias("op"))
    return kept.unionByName(stale)


@register("rule_sync_diff", oracle="""
WITH u AS (SELECT DISTINCT user_id FROM events),
d AS (SELECT 'rule-' || CAST(user_id AS STRING) AS rule_name, CAST(user_id % 7 AS DOUBLE) AS threshold,
        CASE WHEN user_id % 2 = 0 THEN 'gt' ELSE 'lt' END AS op FROM u),
x AS (SELECT 'rule-' || CAST(user_id AS STRING) AS rule_name,
        CAST(CASE WHEN user_id % 4 = 0 THEN user_id % 7 + 1 ELSE user_id % 7 END AS DOUBLE) AS threshold,
        CASE WHEN user_id % 2 = 0 THEN 'gt' ELSE 'lt' END AS op FROM u WHERE user_id % 5 <> 0
      UNION ALL SELECT 'rule-x-' || CAST(user_id AS STRING), CAST(1 AS DOUBLE), 'gt' FROM u WHERE user_id % 9 = 0)
SELECT coalesce(d.rule_name, x.rule_name) AS rule_name,
  CASE WHEN x.rule_name IS NULL THEN 'created' WHEN d.rule_name IS NULL THEN 'deleted'
       WHEN d.threshold = x.threshold AND d.op = x.op THEN 'unchanged' ELSE 'updated' END AS action
FROM d FULL OUTER JOIN x ON d.rule_name = x.rule_name""")
def rule_sync_diff(spark, sf_dir):
    ev = _v(spark, sf_dir).events
    return A.diff_rules(desired_rules(ev), existing_rules(ev), spec_cols=["threshold", "op"])


# Sample duration / operator / metric spellings the validation cases cycle through.
WINDOWS = ("5m", "2h", "90s", "1h30m", "0m", "-5m", "5x", "1.5h")
INTERVALS = ("1m", "30s", "2h")
OPS = ("gt", "gte", "lt", "lte", "eq", "neq", "bogus")
METRICS = ("cpu_usage", "memory_usage", "disk")


def _pick(col, values):
    e = None
    for i, val in enumerate(values):
        cond = (col % len(values)) == i
        e = F.when(cond, val) if e is None else e.when(cond, val)
    return e


def rule_specs(ev):
    u = ev.select("user_id").distinct()
    c = F.col("user_id")
    return u.select(F.concat(F.lit("rule-"), c.cast("string")).alias("rule_name"),
                    _pick(c, WINDOWS).alias("window"), _pick(c, INTERVALS).alias("interval"),
                    _pick(c, OPS).alias("op"), _pick(c, METRICS).alias("metric"))


def _pick_sql(values):
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE user_id % {len(values)} {arms} END"


_UNIT = ("CASE {u} WHEN 'ns' THEN 0.001 WHEN 'us' THEN 1.0 WHEN 'µs' THEN 1.0 WHEN 'ms' THEN 1000.0 WHEN 's' THEN 1e6 "
         "WHEN 'm' THEN 6e7 WHEN 'h' THEN 3.6e9 END")
_PART = "([0-9]+(?:\\.[0-9]*)?|\\.[0-9]+)(ns|us|µs|ms|s|m|h)"
_FULL = "[+-]?(([0-9]+(\\.[0-9]*)?|\\.[0-9]+)(ns|us|µs|ms|s|m|h))+"


def _dur_sql(col: str) -> str:
    nums = f"regexp_extract_all({col}, '{_PART}', 1)"
    units = f"regexp_extract_all({col}, '{_PART}', 2)"
    total = (f"list_sum(list_transform(range(1, len({nums}) + 1), "
             f"lambda i: CAST({nums}[i] AS DOUBLE) * {_UNIT.format(u=units + '[i]')}))")
    return (f"CASE WHEN {col} = '0' THEN 0.0 WHEN regexp_full_match({col}, '{_FULL}') THEN "
            f"(CASE WHEN starts_with({col}, '-') THEN -1.0 ELSE 1.0 END) * {total} END")


@register("rule_validation", oracle=f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
s AS (SELECT 'rule-' || CAST(user_id AS STRING) AS rule_name, {_pick_sql(WINDOWS)} AS "window",
        {_pick_sql(INTERVALS)} AS "interval", {_pick_sql(OPS)} AS op, {_pick_sql(METRICS)} AS metric FROM u),
d AS (SELECT *, {_dur_sql('"window"')} AS w, {_dur_sql('"interval"')} AS i FROM s),
r AS (SELECT rule_name,
  CASE WHEN NOT (w IS NOT NULL AND w > 0 AND w % 60000000 = 0) THEN 'window must be a positive whole number of minutes or hours'
       WHEN NOT (i IS NOT NULL AND i > 0 AND i % 60000000 = 0) THEN 'interval must be a positive whole number of minutes'
       WHEN op NOT IN ('gt', 'gte', 'lt', 'lte') THEN 'unknown operator' END AS search_reason,
  CASE WHEN NOT regexp_full_match("window", '[+-]?[0-9]+[mh]') THEN 'invalid window'
       WHEN NOT regexp_full_match("interval", '[+-]?[0-9]+[mh]') THEN 'invalid interval'
       WHEN op NOT IN ('gt', 'gte', 'lt', 'lte', 'eq', 'neq') THEN 'unsupported operator' END AS sql_reason,
  CASE WHEN metric NOT IN ('cpu_usage', 'memory_usage') THEN 'unsupported metric type'
       WHEN op NOT IN ('gt', 'gte', 'lt', 'lte', 'eq') THEN 'unsupported operator'
       WHEN w IS NULL THEN 'invalid window duration' WHEN w <= 0 THEN 'window must be positive'
       WHEN i IS NULL THEN 'invalid interval duration' WHEN i <= 0 THEN 'interval must be positive' END AS metrics_reason
  FROM d)
SELECT rule_name, search_reason IS NULL AS search_ok, search_reason, sql_reason IS NULL AS sql_ok, sql_reason,
  metrics_reason IS NULL AS metrics_ok, metrics_reason FROM r""")
def rule_validation(spark, sf_dir):
    return A.validate_rules(rule_specs(_v(spark, sf_dir).events))
