"""Alert operators.

Rules are a small table (configuration: one row per rule).  Evaluation is
a batch job over evaluation ticks: every matching log line is exploded to
the ticks whose window contains it (factor window/interval), counted per
``(rule, tick)`` with partial aggregation, and left-joined from the tick
grid so that zero counts exist.  Order-dependent rules (pending ``for``,
throttle) run per rule: islands by running sums, and a fold over the
rule's sorted firing ticks, whose length is bounded by the evaluation span
divided by the rule interval, never by data volume.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylight.functions.scan import running_total
from skylight.functions.timeutil import epoch_micros, long_lit, micros_col, rfc3339

# Comparison operators each store accepts.
OPS_SEARCH = ("gt", "gte", "lt", "lte")
OPS_SQL = ("gt", "gte", "lt", "lte", "eq", "neq")
OPS_METRICS = ("gt", "gte", "lt", "lte", "eq")
METRIC_TYPES = ("cpu_usage", "memory_usage")
MIN_RATE_WINDOW_S = 120
DEFAULT_THROTTLE_S = 3600
MINUTE_US = 60_000_000


def compare(value: Column, op: Column | str, threshold: Column | float) -> Column:
    """A3: ``value <op> threshold`` with the operator held in a column (or a
    literal); an unknown operator gives NULL (validation flags it)."""
    o = F.lit(op) if isinstance(op, str) else op
    t = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    return (F.when(o == "gt", value > t).when(o == "gte", value >= t).when(o == "lt", value < t)
            .when(o == "lte", value <= t).when(o == "eq", value == t).when(o == "neq", value != t))


def validate_op(op: str, store: str = "search") -> str:
    allowed = {"search": OPS_SEARCH, "sql": OPS_SQL, "metrics": OPS_METRICS}[store]
    if op not in allowed:
        raise ValueError(f"unsupported operator {op!r} for {store} rules")
    return op


def _fdiv(a: Column, b: Column) -> Column:
    """Floor division of two integral columns, exact."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def tick_grid(rules: DataFrame, start, end, interval_col: str = "interval_min", anchor=None) -> DataFrame:
    """Evaluation ticks per rule: ``anchor + k * interval`` within
    [start, end] (the anchor defaults to ``start``)."""
    s, e = epoch_micros(start), epoch_micros(end)
    a = epoch_micros(anchor) if anchor is not None else s
    i_us = F.col(interval_col) * long_lit(MINUTE_US)
    first = -_fdiv(long_lit(a - s), i_us)
    last = _fdiv(long_lit(e - a), i_us)
    ks = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return rules.select("rule_name", F.explode(ks).alias("k"))


def log_alert_ticks(logs: DataFrame, rules: DataFrame, start, end, store: str = "search",
                    max_window_min: int | None = None, day_col: str = "log_date", anchor=None) -> DataFrame:
    """A1 (``store="search"``) / A2 (``store="sql"``): per enabled rule and tick,
    the number of lines matching the rule's ids and phrase in the window,
    and whether the rule's comparison holds.

    Ticks are ``anchor + k * interval`` inside [start, end] (anchor defaults
    to start).  Search form: ids component+environment+project, window
    ``[tick-w, tick]``.  SQL form: ids component+environment, window
    ``[tick-w, tick)``.
    """
    keys = ["component_uid", "environment_uid", "project_uid"] if store == "search" else [
        "component_uid", "environment_uid"]
    s_us, e_us = epoch_micros(start), epoch_micros(end)
    a_us = epoch_micros(anchor) if anchor is not None else s_us
    r = rules.filter(F.col("enabled")).select("rule_name", *keys, "phrase", "op", "threshold", "window_min",
                                              "interval_min")
    # the widest rule window bounds the scan: a literal where it is given,
    # else a scalar subquery that runs with the query, not while it is planned
    widest = (F.lit(max_window_min).cast("bigint") if max_window_min is not None
              else F.coalesce(r.agg(F.max("window_min").cast("bigint").alias("w")).scalar(), F.lit(0).cast("bigint")))
    lo_ts = F.timestamp_micros(long_lit(s_us) - widest * long_lit(MINUTE_US)).cast("timestamp_ntz")
    hi_ts = F.timestamp_micros(long_lit(e_us)).cast("timestamp_ntz")
    bounds = (F.col("ts") >= lo_ts) & (F.col("ts") <= hi_ts)
    if day_col in logs.columns:
        bounds = bounds & (F.col(day_col) >= lo_ts.cast("date")) & (F.col(day_col) <= hi_ts.cast("date"))
    lines = logs.filter(bounds).select("ts", "log", *keys)
    rb = (r.select("rule_name", *[F.col(k).alias("r_" + k) for k in keys], "phrase",
                                     "window_min", "interval_min"))
    cond = None
    for k in keys:
        c = F.col(k) == F.col("r_" + k)
        cond = c if cond is None else cond & c
    cond = cond & F.col("log").contains(F.col("phrase"))
    j = lines.join(rb, cond, "inner")
    t = micros_col("ts") - long_lit(a_us)
    i_us = F.col("interval_min") * long_lit(MINUTE_US)
    w_us = F.col("window_min") * long_lit(MINUTE_US)
    k_first = -_fdiv(long_lit(a_us - s_us), i_us)
    k_last = _fdiv(long_lit(e_us - a_us), i_us)
    if store == "search":      # tick - w <= t <= tick
        lo = -_fdiv(-t, i_us)
    else:                      # tick - w <= t < tick
        lo = _fdiv(t, i_us) + F.lit(1).cast("bigint")
    hi = _fdiv(t + w_us, i_us)
    lo = F.greatest(lo, k_first)
    hi = F.least(hi, k_last)
    ks = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    x = j.select("rule_name", F.explode(ks).alias("k"))
    counts = x.groupBy("rule_name", "k").agg(F.count(F.lit(1)).alias("n"))
    grid = tick_grid(r, start, end, anchor=_from_us(a_us))
    out = grid.join(counts, ["rule_name", "k"], "left").join(
        r.select("rule_name", "op", "threshold", "interval_min"), "rule_name")
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    tick = F.timestamp_micros(long_lit(a_us) + F.col("k") * F.col("interval_min") * long_lit(MINUTE_US)).cast(
        "timestamp_ntz")
    return out.select("rule_name", tick.alias("tick"), n.alias("n"),
                      F.coalesce(compare(n.cast("double"), F.col("op"), F.col("threshold")), F.lit(False))
                      .alias("firing"))


def _from_us(us: int):
    import datetime as _dt
    return _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)


def fire_after(df: DataFrame, keys: Sequence[str], ts_col: str, cond: Column, for_s: float,
               block_us: int = 86_400_000_000) -> DataFrame:
    """A6 pending -> firing: the condition must hold at every evaluation for
    ``for_s`` seconds.  Islands: the running count of false evaluations
    numbers the runs (blocked scan, so a long series is not one task); the
    island start is the first true evaluation of a run."""
    keys = list(keys)
    d = df.withColumn("__cond", F.coalesce(cond, F.lit(False))).withColumn("__tus", micros_col(ts_col))
    d = d.withColumn("__breaks", (~F.col("__cond")).cast("bigint"))
    d = running_total(d, keys, "__tus", "__breaks", "__island", block_width=block_us)
    starts = (d.filter(F.col("__cond")).groupBy(*keys, "__island")
              .agg(F.min("__tus").alias("__island_start")))
    j = d.join(starts, keys + ["__island"], "left")
    fires = F.col("__cond") & (F.col("__tus") - F.col("__island_start") >= long_lit(int(for_s * 1_000_000)))
    return (j.withColumn("island_start", F.timestamp_micros(F.col("__island_start")).cast("timestamp_ntz"))
            .withColumn("firing", F.coalesce(fires, F.lit(False)))
            .drop("__cond", "__tus", "__breaks", "__island", "__island_start"))


def throttle(firing: DataFrame, key: str, ts_col: str, every_s: float = DEFAULT_THROTTLE_S,
             block_gaps: int = 64) -> DataFrame:
    """At most one notification per key per ``every_s``: the first firing
    is sent, later ones only when ``every_s`` has passed since the last sent
    one.

    Runs as an exact parallel scan, so no key is ever one task: firing times
    are cut into blocks of ``block_gaps * every_s``, fixed by the time alone, so
    every branch and every retried task sees the same blocks.  Inside a
    block, the unknown incoming "last sent" only decides which tick is sent
    first, and that is either a tick within ``every_s`` of the block's first
    tick or the first tick after that; all such cases are walked together
    (``mapInPandas``), each sent tick listing the cases that send it.  A chain
    over the blocks of a key (one entry per block) picks each block's case, and
    a tick is sent when its block's case is among its cases.
    """
    import numpy as np
    import pandas as pd

    gap = int(every_s * 1_000_000)
    t = firing.select(F.col(key).alias("__k"), micros_col(ts_col).alias("__t")).filter(F.col("__t").isNotNull())
    t = t.withColumn("__b", _fdiv(F.col("__t"), long_lit(gap * block_gaps)))
    blocked = (t.repartition("__k", "__b").dropDuplicates(["__k", "__b", "__t"])
               .sortWithinPartitions("__k", "__b", "__t"))

    cols = ["__k", "__b", "__t", "mask", "case_starts", "case_lasts"]
    chunk = 65536

    def segment_rows(k, block, ticks):
        """Walk every case's chain of sent ticks at once, in tick order, and
        yield output frames in bounded chunks.  Cases whose chains reach the
        same tick are merged (they coincide from there on), so a tick carries
        the cases that send it, or ``[0]`` when every case does: the output
        stays about one entry per sent tick."""
        import heapq
        m = len(ticks)
        near = int(np.searchsorted(ticks, ticks[0] + gap, side="left"))
        starts = list(range(near)) + ([near] if near < m else [])
        ncases = len(starts)
        heads = {j: [c + 1] for c, j in enumerate(starts)}  # tick index -> cases (1-based) whose chain is there
        heap = list(heads)
        heapq.heapify(heap)
        lasts = [None] * ncases
        rows = []
        while heap:
            i = heapq.heappop(heap)
            cs = heads.pop(i)
            everyone = cs == [0] or len(cs) == ncases
            cs = [0] if everyone else sorted(cs)
            rows.append((k, block, int(ticks[i]), cs, None, None))
            if len(rows) >= chunk:
                yield pd.DataFrame(rows, columns=cols)
                rows = []
            nxt = int(np.searchsorted(ticks, ticks[i] + gap, side="left"))
            if nxt >= m:
                for c in (range(1, ncases + 1) if everyone else cs):
                    lasts[c - 1] = int(ticks[i])
                continue
            if nxt in heads:
                merged = heads[nxt]
                heads[nxt] = [0] if (everyone or merged == [0]) else merged + cs
            else:
                heads[nxt] = cs
                heapq.heappush(heap, nxt)
        rows.append((k, block, None, None, [int(ticks[j]) for j in starts], lasts))
        yield pd.DataFrame(rows, columns=cols)

    def scan(batches):
        """Rows arrive sorted by (key, block, time); a block's ticks are gathered
        as numpy arrays (split at changes without a Python loop per row)."""
        cur, ticks = None, []
        for pdf in batches:
            if pdf.empty:
                continue
            keys, blocks = pdf["__k"].to_numpy(), pdf["__b"].to_numpy(dtype=np.int64)
            ts = pdf["__t"].to_numpy(dtype=np.int64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                found = (keys[lo], int(blocks[lo]))
                if cur is not None and found != cur:
                    yield from segment_rows(*cur, np.concatenate(ticks))
                    ticks = []
                cur = found
                ticks.append(ts[lo:hi])
        if ticks:
            yield from segment_rows(*cur, np.concatenate(ticks))

    kt = t.schema[0].dataType.simpleString()
    schema = (f"__k {kt}, __b bigint, __t bigint, mask array<int>, case_starts array<bigint>, "
              "case_lasts array<bigint>")
    scanned = blocked.mapInPandas(scan, schema)
    segs = scanned.filter(F.col("case_starts").isNotNull()).select("__k", "__b", "case_starts", "case_lasts")
    per_key = segs.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("__b", "case_starts", "case_lasts")))
                                      .alias("segs"))
    g = long_lit(gap)
    init = F.struct(F.lit(None).cast("bigint").alias("last"),
                    F.array().cast("array<struct<block:bigint,case:int>>").alias("out"))

    def chain(acc, x):
        earliest = F.coalesce(acc["last"] + g, F.lit(-(2 ** 62)).cast("bigint"))
        # the first case whose first sent tick is allowed; none -> nothing sent here
        idx = F.array_position(F.transform(x["case_starts"], lambda st: st >= earliest), True).cast("int")
        new_last = F.when(idx > 0, F.element_at(x["case_lasts"], F.greatest(idx, F.lit(1)))).otherwise(acc["last"])
        return F.struct(new_last.alias("last"),
                        F.array_append(acc["out"], F.struct(x["__b"].alias("block"), idx.alias("case")))
                        .alias("out"))

    cases = per_key.select("__k", F.explode(F.aggregate("segs", init, chain)["out"]).alias("c")).select(
        "__k", F.col("c.block").alias("__b"), F.col("c.case").alias("__case"))
    ticks = scanned.filter(F.col("__t").isNotNull()).select("__k", "__b", "__t", "mask")
    sent = ticks.join(cases, ["__k", "__b"], "inner").filter(
        (F.col("__case") > 0) & (F.array_contains("mask", F.lit(0)) | F.array_contains("mask", F.col("__case"))))
    return sent.select(F.col("__k").alias(key),
                       F.timestamp_micros(F.col("__t")).cast("timestamp_ntz").alias(ts_col))


def notifications(alerts: DataFrame, name_col: str, ts_col: str, label_col: str, label_value: str,
                  group_interval_s: float = 300, repeat_s: float = 12 * 3600) -> DataFrame:
    """Only alerts labelled as ours, grouped by name per group interval,
    then re-sent at most once per ``repeat_s`` (resolved alerts never reach
    here: only firing rows are inputs)."""
    ours = alerts.filter(F.col(label_col) == F.lit(label_value))
    grouped = ours.groupBy(name_col, F.window(F.col(ts_col), f"{int(group_interval_s)} seconds").alias("w")).agg(
        F.min(ts_col).alias(ts_col), F.count(F.lit(1)).alias("n"))
    sent = throttle(grouped.select(name_col, ts_col), name_col, ts_col, repeat_s)
    return sent.join(grouped.select(name_col, ts_col, "n"), [name_col, ts_col], "inner")


# --- webhooks (A9, A10) ------------------------------------------------------

_SEARCH_SCHEMA = "ruleName string, ruleNamespace string, alertValue string, alertTimestamp string"
_SQL_SCHEMA = "alertName string, alertCount string, alertTriggerTimeMicroSeconds string"
_METRICS_SCHEMA = ("alerts array<struct<status: string, startsAt: string, "
                   "annotations: struct<rule_name: string, rule_namespace: string, alert_value: string>>>")


def _body(schema: str) -> Column:
    """The parsed body; ``bad`` is set where it is not such an object."""
    return F.from_json("body", schema + ", bad string", {"columnNameOfCorruptRecord": "bad"})


def _unreadable(j: str) -> Column:
    return F.col(j).isNull() | F.col(f"{j}.bad").isNotNull()


def normalize_webhooks(hooks: DataFrame, received_col: str = "received_at") -> tuple[DataFrame, DataFrame]:
    """Three payload shapes -> ``(event_id, shape, rule_name,
    rule_namespace, alert_value, alert_ts)``; rejected payloads go to the
    second frame with a reason.

    search: missing name rejected; unparseable time -> receive time.
    sql: epoch-micros trigger time; the rule name doubles as alert name.
    metrics: ``alerts`` array exploded, only ``firing`` (trimmed, any case);
    name, namespace and value mandatory; unparseable time -> receive time.
    A body that cannot be read, a number that is none, an empty ``alerts``
    and an unknown shape are rejected; alerts that are not firing are skipped.
    Every other payload is in exactly one frame.
    """
    rec = F.col(received_col)
    s = hooks.filter(F.col("shape") == "search").withColumn("j", _body(_SEARCH_SCHEMA))
    s_out = s.select(
        "event_id", "shape", F.col("j.ruleName").alias("rule_name"),
        F.col("j.ruleNamespace").alias("rule_namespace"),
        F.col("j.alertValue").try_cast("double").alias("alert_value"),
        F.coalesce(rfc3339(F.col("j.alertTimestamp")), rec).alias("alert_ts"),
        F.when(_unreadable("j"), F.lit("unreadable body")).when(F.col("j.ruleName").isNull(), F.lit("missing ruleName"))
        .when(F.col("j.alertValue").isNotNull() & F.col("j.alertValue").try_cast("double").isNull(),
              F.lit("bad alertValue")).alias("reject_reason"))

    q = hooks.filter(F.col("shape") == "sql").withColumn("j", _body(_SQL_SCHEMA))
    micros = F.col("j.alertTriggerTimeMicroSeconds").try_cast("bigint")
    q_out = q.select(
        "event_id", "shape", F.col("j.alertName").alias("rule_name"),
        F.lit(None).cast("string").alias("rule_namespace"),
        F.col("j.alertCount").try_cast("double").alias("alert_value"),
        F.when(F.col("j.alertTriggerTimeMicroSeconds").isNull(), rec)
        .otherwise(F.timestamp_micros(micros).cast("timestamp_ntz")).alias("alert_ts"),
        F.when(_unreadable("j"), F.lit("unreadable body")).when(F.col("j.alertName").isNull(), F.lit("missing alertName"))
        .when(F.col("j.alertCount").isNotNull() & F.col("j.alertCount").try_cast("double").isNull(), F.lit("bad alertCount"))
        .when(F.col("j.alertTriggerTimeMicroSeconds").isNotNull() & micros.isNull(),
              F.lit("bad alertTriggerTimeMicroSeconds")).alias("reject_reason"))

    m = hooks.filter(F.col("shape") == "metrics").withColumn("j", _body(_METRICS_SCHEMA))
    m = m.select("event_id", "shape", rec.alias("__rec"), _unreadable("j").alias("__bad"),
                 F.coalesce(F.size("j.alerts"), F.lit(0)).alias("__n"), F.explode_outer("j.alerts").alias("a"))
    firing = F.coalesce(F.lower(F.trim(F.col("a.status"))) == "firing", F.lit(False))
    m = m.filter(F.col("__bad") | (F.col("__n") <= 0) | firing)
    name = F.trim(F.col("a.annotations.rule_name"))
    ns = F.trim(F.col("a.annotations.rule_namespace"))
    val = F.trim(F.col("a.annotations.alert_value"))
    m_out = m.select(
        "event_id", "shape", name.alias("rule_name"), ns.alias("rule_namespace"),
        val.try_cast("float").cast("double").alias("alert_value"),
        F.coalesce(rfc3339(F.col("a.startsAt")), F.col("__rec")).alias("alert_ts"),
        F.when(F.col("__bad"), F.lit("unreadable body")).when(F.col("__n") <= 0, F.lit("no alerts"))
        .when(F.coalesce(name, F.lit("")) == "", F.lit("missing rule_name annotation"))
        .when(F.coalesce(ns, F.lit("")) == "", F.lit("missing rule_namespace annotation"))
        .when(F.coalesce(val, F.lit("")) == "", F.lit("missing alert_value annotation"))
        .when(val.try_cast("double").isNull(), F.lit("invalid alert_value")).alias("reject_reason"))

    known = F.coalesce(F.col("shape").isin("search", "sql", "metrics"), F.lit(False))
    other = hooks.filter(~known).select(
        "event_id", "shape", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("rule_name", "string"), ("rule_namespace", "string"), ("alert_value", "double"))],
        rec.alias("alert_ts"), F.lit("unknown shape").alias("reject_reason"))
    allx = s_out.unionByName(q_out).unionByName(m_out).unionByName(other)
    ok = allx.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = allx.filter(F.col("reject_reason").isNotNull())
    return ok, bad


def namespace_lookup(events: DataFrame, rules: DataFrame) -> DataFrame:
    """A10: an event without namespace takes its rule's namespace; events
    whose rule is unknown are dropped."""
    r = (rules.select(F.col("rule_name"), F.col("namespace").alias("__rule_ns")))
    j = events.join(r, "rule_name", "left")
    out = j.withColumn("rule_namespace", F.coalesce(F.col("rule_namespace"), F.col("__rule_ns")))
    return out.filter(F.col("rule_namespace").isNotNull()).drop("__rule_ns")


# --- rule sync (A11) and validation (A12) --------------------------------------

def spec_hash(cols: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def diff_rules(desired: DataFrame, existing: DataFrame, key: str = "rule_name",
               spec_cols: Sequence[str] = ()) -> DataFrame:
    """Full outer join on the rule name; created / updated / unchanged /
    deleted by comparing a hash of the serialized spec."""
    d = desired.select(key, spec_hash(spec_cols).alias("__d"))
    e = existing.select(key, spec_hash(spec_cols).alias("__e"))
    j = d.join(e, key, "full_outer")
    action = (F.when(F.col("__e").isNull(), F.lit("created")).when(F.col("__d").isNull(), F.lit("deleted"))
              .when(F.col("__d") == F.col("__e"), F.lit("unchanged")).otherwise(F.lit("updated")))
    return j.select(key, action.alias("action"))


_GO_UNIT_US = {"ns": 0.001, "us": 1.0, "µs": 1.0, "ms": 1000.0, "s": 1e6, "m": 6e7, "h": 3.6e9}
GO_DURATION_RE = r"^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(ns|us|µs|ms|s|m|h))+$"
_GO_PART_RE = r"([0-9]+(?:\.[0-9]*)?|\.[0-9]+)(ns|us|µs|ms|s|m|h)"


def go_duration_us(col: str | Column) -> Column:
    """Go ``time.ParseDuration`` in microseconds (NULL when not parseable;
    ``"0"`` is zero)."""
    c = F.col(col) if isinstance(col, str) else col
    nums = F.regexp_extract_all(c, F.lit(_GO_PART_RE), 1)
    units = F.regexp_extract_all(c, F.lit(_GO_PART_RE), 2)
    scale = F.create_map(*[x for k, v in _GO_UNIT_US.items() for x in (F.lit(k), F.lit(v))])
    parts = F.zip_with(nums, units, lambda n, u: n.cast("double") * F.element_at(scale, u))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    sign = F.when(c.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return (F.when(c == "0", F.lit(0.0)).when(c.rlike(GO_DURATION_RE), sign * total))


def validate_rules(rules: DataFrame, window_col: str = "window", interval_col: str = "interval",
                   op_col: str = "op", metric_col: str = "metric") -> DataFrame:
    """Per rule, whether each store accepts it, and the first reason it
    does not.

    search: window a positive whole number of minutes (or hours), interval a
    positive whole number of minutes, operator in gt/gte/lt/lte.
    sql: window and interval ``<int>m`` or ``<int>h``; six operators.
    metrics: window and interval any positive duration, metric cpu/memory, five operators.
    """
    w = go_duration_us(window_col)
    i = go_duration_us(interval_col)
    whole_min = lambda d: d.isNotNull() & (d > 0) & (F.pmod(d, F.lit(6e7)) == 0)
    sql_dur = lambda c: F.coalesce(F.col(c).rlike(r"^[+-]?[0-9]+[mh]$"), F.lit(False))
    op = F.col(op_col)
    search_reason = (F.when(~whole_min(w), F.lit("window must be a positive whole number of minutes or hours"))
                     .when(~whole_min(i), F.lit("interval must be a positive whole number of minutes"))
                     .when(~op.isin(*OPS_SEARCH), F.lit("unknown operator")))
    sql_reason = (F.when(~sql_dur(window_col), F.lit("invalid window"))
                  .when(~sql_dur(interval_col), F.lit("invalid interval"))
                  .when(~op.isin(*OPS_SQL), F.lit("unsupported operator")))
    metrics_reason = (F.when(~F.col(metric_col).isin(*METRIC_TYPES), F.lit("unsupported metric type"))
                      .when(~op.isin(*OPS_METRICS), F.lit("unsupported operator"))
                      .when(w.isNull(), F.lit("invalid window duration"))
                      .when(w <= 0, F.lit("window must be positive"))
                      .when(i.isNull(), F.lit("invalid interval duration"))
                      .when(i <= 0, F.lit("interval must be positive")))
    return rules.select(
        "rule_name",
        search_reason.isNull().alias("search_ok"), search_reason.alias("search_reason"),
        sql_reason.isNull().alias("sql_ok"), sql_reason.alias("sql_reason"),
        metrics_reason.isNull().alias("metrics_ok"), metrics_reason.alias("metrics_reason"),
    )


# --- metric alerts (A4, A5) ----------------------------------------------------

def _component_pods(pods: DataFrame, component: str, project: str, environment: str) -> DataFrame:
    """Alert expressions filter pod labels on the three ids, not the namespace."""
    return pods.filter((F.col("component_uid") == component) & (F.col("project_uid") == project)
                       & (F.col("environment_uid") == environment)).select("pod")


def _per_pod(series: DataFrame, pods: DataFrame) -> DataFrame:
    """Many-to-one on the pod name alone: a name in two namespaces fails."""
    from skylight.operators.metrics import unique_right
    return series.join(unique_right(pods, ["pod"]), "pod", "inner")


def cpu_percent_alert(cpu: DataFrame, gauges: DataFrame, pods: DataFrame, component: str, project: str,
                      environment: str, grid, window_s: float, op: str, threshold: float,
                      lookback_s: float = 300) -> DataFrame:
    """A4: 100 * sum(cpu rate) / sum(cpu limits), joined on pod only; the rate
    window is the rule window but at least 2 minutes."""
    from skylight.operators import metrics as M
    from skylight.operators.resources import GAUGES, containers
    validate_op(op, "metrics")
    p = _component_pods(pods, component, project, environment)
    rate_s = max(window_s, MIN_RATE_WINDOW_S)
    c, g = containers(cpu), containers(gauges)
    num = _per_pod(M.rate(c, M.series_keys(c), grid, rate_s), p)
    num = num.groupBy("ts").agg(F.sum("value").alias("num"))
    lim = _per_pod(M.instant(g, M.series_keys(g, GAUGES), grid, ["cpu_limit"], lookback_s), p)
    den = lim.groupBy("ts").agg(F.sum("cpu_limit").alias("den"))
    return _percent(num, den, op, threshold)


def memory_percent_alert(gauges: DataFrame, pods: DataFrame, component: str, project: str, environment: str,
                         grid, op: str, threshold: float, lookback_s: float = 300) -> DataFrame:
    """A5: 100 * sum(working set) / sum(memory limits), instant values; the
    rule window does not enter the value."""
    from skylight.operators import metrics as M
    from skylight.operators.resources import GAUGES, containers
    validate_op(op, "metrics")
    p = _component_pods(pods, component, project, environment)
    g = containers(gauges)
    inst = _per_pod(M.instant(g, M.series_keys(g, GAUGES), grid, ["memory_bytes", "memory_limit"], lookback_s), p)
    agg = inst.groupBy("ts").agg(F.sum("memory_bytes").alias("num"), F.sum("memory_limit").alias("den"))
    return _percent(agg.select("ts", "num"), agg.select("ts", "den"), op, threshold)


def _percent(num: DataFrame, den: DataFrame, op: str, threshold: float) -> DataFrame:
    from skylight.operators import metrics as M
    j = num.join(den, "ts", "inner")
    v = M.ratio(F.col("num"), F.col("den")) * F.lit(100.0)
    out = j.select("ts", v.alias("value"))
    out = out.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return out.withColumn("firing", F.coalesce(compare(F.col("value"), op, threshold), F.lit(False)))
