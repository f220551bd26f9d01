"""Time-series operators (M1-M19) over long sample tables.

A sample table is ``(series keys..., ts, value)``.  A range query is
evaluated on the grid ``start, start+step, .., end``:

* **M1 range grid** - every sample is exploded to the grid points whose
  window contains it (``g - range < t <= g``); then an equi-``groupBy``
  on ``(series, g)``.  No range join, no cartesian product; the explode
  factor is ``ceil(range/step)``; rates whose windows overlap combine samples
  per bucket first and explode buckets.
* **M2 rate** - counter resets need the previous sample inside the window
  only, so the lag runs per (series, grid point) or (series, bucket), on the
  same partitioning as the aggregate: one shuffle per family, and a huge
  series is never a single task.
* **M3 instant** - latest sample within the lookback at each grid point.
* **M5/M6/M8 label joins** - many-to-one joins with the pod-label dimension;
  the join is left to AQE, which broadcasts the dimension when its measured
  size is under the threshold and keeps a shuffle join otherwise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylight.functions.scope import Scope
from skylight.functions.timeutil import epoch_micros, long_lit, micros_col

DAY_US = 86_400_000_000
DEFAULT_STEP_S = 300
DEFAULT_RATE_RANGE_S = 120
DEFAULT_LOOKBACK_S = 300
EXTRAPOLATION_SLACK = 1.1


@dataclass(frozen=True)
class Grid:
    """Evaluation grid: start, start+step, .., end (inclusive), in micros."""
    start_us: int
    end_us: int
    step_us: int

    @classmethod
    def of(cls, start, end, step_s: float = DEFAULT_STEP_S) -> "Grid":
        if step_s <= 0:
            raise ValueError("step must be positive")
        s, e = epoch_micros(start), epoch_micros(end)
        if e < s:
            raise ValueError("end before start")
        return cls(s, e, int(step_s * 1_000_000))

    @property
    def last_index(self) -> int:
        return (self.end_us - self.start_us) // self.step_us

    def ts(self, idx: Column) -> Column:
        """Grid index -> TIMESTAMP_NTZ of that grid point."""
        us = long_lit(self.start_us) + idx * long_lit(self.step_us)
        return F.timestamp_micros(us).cast("timestamp_ntz")


def _floor_div(a: Column, b: int) -> Column:
    bb = long_lit(b)
    return ((a - F.pmod(a, bb)) / bb).cast("bigint")


def explode_to_grid(df: DataFrame, grid: Grid, range_s: float, ts_col: str = "ts",
                    idx_col: str = "g") -> DataFrame:
    """M1: one row per (sample, grid point) with ``g - range < t <= g``.

    Grid indices from ``ceil((t - start)/step)`` to
    ``ceil((t + range - start)/step) - 1``, clipped to the grid.
    """
    range_us = int(range_s * 1_000_000)
    if range_us <= 0:
        raise ValueError("range must be positive")
    t = micros_col(ts_col)
    off = t - long_lit(grid.start_us)
    lo = F.greatest(-_floor_div(-off, grid.step_us), F.lit(0).cast("bigint"))
    hi = F.least(-_floor_div(-(off + long_lit(range_us)), grid.step_us) - F.lit(1).cast("bigint"),
                 long_lit(grid.last_index))
    # the sample-window filter keeps out rows that feed no grid point (also pushed
    # to the scan as a ts range)
    lo_ts = F.timestamp_micros(long_lit(grid.start_us - range_us)).cast("timestamp_ntz")
    hi_ts = F.timestamp_micros(long_lit(grid.end_us)).cast("timestamp_ntz")
    kept = df.filter((F.col(ts_col) > lo_ts) & (F.col(ts_col) <= hi_ts))
    return (kept.withColumn("__t_us", t)
            .withColumn(idx_col, F.explode(
                F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>")))))


def prev_sample(df: DataFrame, keys: Sequence[str], value_col: str = "value", ts_col: str = "ts",
                out_col: str = "prev_value", block_us: int = DAY_US) -> DataFrame:
    """Previous sample's value in the series (NULL for the first sample).

    Lag inside ``(series, block)`` and, for the first row of a block, the
    last value of the previous non-empty block (a table with one row per
    block), joined back on ``(series, block)``.
    """
    keys = list(keys)
    t = micros_col(ts_col)
    b = df.withColumn("__blk", _floor_div(t, block_us)).withColumn("__tus", t)
    part = keys + ["__blk"]
    w = Window.partitionBy(*part).orderBy("__tus")
    inner = b.withColumn("__lag", F.lag(value_col).over(w))
    last = b.groupBy(*part).agg(F.max_by(value_col, "__tus").alias("__last"))
    wb = Window.partitionBy(*keys).orderBy("__blk")
    carry = last.select(*part, F.lag("__last").over(wb).alias("__carry"))
    out = inner.join(carry, part, "inner")
    return (out.withColumn(out_col, F.coalesce(F.col("__lag"), F.col("__carry")))
            .drop("__blk", "__tus", "__lag", "__carry"))


def _extrapolated(range_s: float) -> Column:
    """Extrapolated rate from the per-window aggregates (PromQL semantics).

    Edge distances come from exact integer micros, then turn into seconds.
    """
    range_us = int(range_s * 1_000_000)
    n = F.col("n").cast("double")
    inc = F.col("increase")
    sampled = (F.col("last_us") - F.col("first_us")).cast("double") / F.lit(1e6)
    avg = sampled / (n - F.lit(1.0))
    thresh = avg * F.lit(EXTRAPOLATION_SLACK)
    d_start = (F.col("first_us") - (F.col("g_us") - long_lit(range_us))).cast("double") / F.lit(1e6)
    d_end = (F.col("g_us") - F.col("last_us")).cast("double") / F.lit(1e6)
    d_start = F.when(d_start >= thresh, avg / F.lit(2.0)).otherwise(d_start)
    to_zero = sampled * F.try_divide(F.col("first_value"), inc)
    d_start = F.when((inc > 0) & (F.col("first_value") >= 0) & (to_zero < d_start), to_zero).otherwise(d_start)
    d_end = F.when(d_end >= thresh, avg / F.lit(2.0)).otherwise(d_end)
    return inc * (sampled + d_start + d_end) / sampled / F.lit(float(range_s))


def _spread(df: DataFrame, part: Sequence[str]) -> DataFrame:
    """Rows of equal ``part`` together, in all of the session's shuffle
    partitions. AQE would merge partitions by the bytes that they shuffle, and
    the aggregates of a merged task hold many times as much."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *part)


def _with_resets(df: DataFrame, part: Sequence[str], order: str, first: str, last: str) -> DataFrame:
    """Add ``__reset``: the last value before this row (in ``part``, by
    ``order``) where this row starts lower, else 0."""
    prev = F.lag(last).over(Window.partitionBy(*part).orderBy(order))
    return df.withColumn("__reset", F.when(F.col(first) < prev, prev).otherwise(F.lit(0.0)))


def _combine_samples(df: DataFrame, part: Sequence[str], value_col: str) -> DataFrame:
    """Count, first and last sample and the increase of each group of samples,
    counter resets inside the group included. The lag and the aggregate
    share one shuffle by ``part``."""
    d = _with_resets(_spread(df, part), part, "__t_us", value_col, value_col)
    return d.groupBy(*part).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("__t_us").alias("first_us"),
        F.max("__t_us").alias("last_us"),
        F.min_by(value_col, "__t_us").alias("first_value"),
        F.max_by(value_col, "__t_us").alias("last_value"),
        F.sum("__reset").alias("resets"))


def _combine_buckets(samples: DataFrame, keys: list[str], grid: Grid, range_us: int, value_col: str,
                     ts_col: str) -> DataFrame:
    """Window aggregates of a range longer than the step. Samples are combined
    per (series, bucket), where bucket ``j`` holds
    ``start + (j-1)*w < t <= start + j*w`` and ``w`` divides step and range, so
    a window is a whole number of buckets; only buckets are exploded to the
    grid points they feed, never samples. Resets between two neighbouring
    buckets are found on the bucket rows of a series, of which there are at most
    as many as the grid has; the window sums then stay on that partitioning."""
    w = math.gcd(grid.step_us, range_us)
    per_step, per_range = grid.step_us // w, range_us // w
    t = micros_col(ts_col)
    bucket = -_floor_div(-(t - long_lit(grid.start_us)), w)
    b = _combine_samples(samples.withColumn("__t_us", t).withColumn("__b", bucket), keys + ["__b"], value_col)
    # grid point g covers the buckets g*per_step - per_range + 1 .. g*per_step
    lo = F.greatest(-_floor_div(-F.col("__b"), per_step), F.lit(0).cast("bigint"))
    hi = F.least(_floor_div(F.col("__b") + long_lit(per_range - 1), per_step), long_lit(grid.last_index))
    gs = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    x = _with_resets(_spread(b, keys), keys, "__b", "first_value", "last_value").withColumn("g", F.explode(gs))
    return x.groupBy(*keys, "g").agg(
        F.sum("n").alias("n"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.min_by("first_value", "__b").alias("first_value"),
        F.max_by("last_value", "__b").alias("last_value"),
        # the first bucket's drop is against a sample before the window
        (F.sum(F.col("resets") + F.col("__reset")) - F.min_by("__reset", "__b")).alias("resets"))


def rate(samples: DataFrame, keys: Sequence[str], grid: Grid, range_s: float = DEFAULT_RATE_RANGE_S,
         mode: str = "extrapolated", value_col: str = "value", ts_col: str = "ts",
         pre_aggregate: bool | None = None) -> DataFrame:
    """M2: per-second increase of a counter over ``range_s`` at each grid point.

    increase = last - first + values before each drop whose both samples lie
    in the window.  ``mode="simple"`` gives increase / range (cross-check).
    Windows with fewer than two samples produce no point.

    A reset counts only where both samples lie in the window, so the previous
    sample is looked up per (series, grid point): one shuffle, and no task
    holds more of a series than one window. Ranges longer than the step are
    first combined per bucket (``pre_aggregate``; unset, where windows
    overlap), so overlapping windows never repeat samples.
    """
    keys = list(keys)
    range_us = int(range_s * 1_000_000)
    lo_ts = F.timestamp_micros(long_lit(grid.start_us - range_us)).cast("timestamp_ntz")
    hi_ts = F.timestamp_micros(long_lit(grid.end_us)).cast("timestamp_ntz")
    # numeric labels are grouped as text (a cast both ways keeps the value):
    # Spark normalises floating keys in aggregates only and would shuffle twice
    types = {k: samples.schema[k].dataType for k in keys}
    as_text = [k for k, t in types.items() if isinstance(t, (T.DoubleType, T.FloatType))]
    window_rows = samples.select(*[F.col(k).cast("string").alias(k) if k in as_text else k for k in keys], ts_col, value_col).filter(
        (F.col(ts_col) > lo_ts) & (F.col(ts_col) <= hi_ts))
    if pre_aggregate is None:
        pre_aggregate = range_us > grid.step_us
    if pre_aggregate:
        agg = _combine_buckets(window_rows, keys, grid, range_us, value_col, ts_col)
    else:
        x = explode_to_grid(window_rows, grid, range_s, ts_col)
        agg = _combine_samples(x, keys + ["g"], value_col)
    agg = agg.filter(F.col("n") >= 2)
    agg = agg.withColumn("increase", F.col("last_value") - F.col("first_value") + F.col("resets"))
    agg = agg.withColumn("g_us", long_lit(grid.start_us) + F.col("g") * long_lit(grid.step_us))
    val = _extrapolated(range_s) if mode == "extrapolated" else F.col("increase") / F.lit(float(range_s))
    return agg.select(*[F.col(k).cast(types[k]).alias(k) if k in as_text else k for k in keys],
                      grid.ts(F.col("g")).alias("ts"), val.alias("value"))


def instant(samples: DataFrame, keys: Sequence[str], grid: Grid, value_cols: Sequence[str] = ("value",),
            lookback_s: float = DEFAULT_LOOKBACK_S, ts_col: str = "ts") -> DataFrame:
    """M3: latest sample within the lookback at each grid point; several
    gauge columns of the same sample row are carried together."""
    keys = list(keys)
    x = explode_to_grid(samples.select(*keys, ts_col, *value_cols), grid, lookback_s, ts_col)
    # one max_by per gauge (fixed-width buffers keep this a hash aggregation);
    # sample times are unique within a series, so all pick the same row
    agg = x.groupBy(*keys, "g").agg(*[F.max_by(c, "__t_us").alias(c) for c in value_cols])
    return agg.select(*keys, grid.ts(F.col("g")).alias("ts"), *value_cols)


def label_match(df: DataFrame, equal: dict | None = None, not_equal: dict | None = None,
                regex: dict | None = None) -> DataFrame:
    """M4: ``label="v"``, ``label!="v"``, ``label=~"re"`` (anchored, like PromQL)."""
    cond = F.lit(True)
    for k, v in (equal or {}).items():
        cond = cond & (F.coalesce(F.col(k), F.lit("")) == F.lit(v))
    for k, v in (not_equal or {}).items():
        cond = cond & (F.coalesce(F.col(k), F.lit("")) != F.lit(v))
    for k, v in (regex or {}).items():
        cond = cond & F.coalesce(F.col(k), F.lit("")).rlike(f"^(?:{v})$")
    return df.filter(cond)


def pod_labels(pods: DataFrame, scope: Scope | None, with_namespace: bool = True) -> DataFrame:
    """``kube_pod_labels{scope}``: the pod dimension filtered by the scope."""
    return pods.filter(scope.predicate(with_namespace)) if scope is not None else pods


def join_pod_labels(series: DataFrame, pods: DataFrame, on: Sequence[str] = ("pod", "pod_namespace"),
                    carry: Sequence[str] = (), rename: dict | None = None) -> DataFrame:
    """M5/M6/M8: many-to-one join with the pod dimension, carrying scope
    labels (``group_left``).  ``rename`` re-keys the dimension's columns
    (``pod`` -> ``destination_pod``) before the join."""
    right = pods
    if rename:
        for a, b in rename.items():
            right = right.withColumnRenamed(a, b)
    cols = list(dict.fromkeys(list(on) + list(carry)))
    return series.join(unique_right(right.select(*cols), on), list(on), "inner")


def unique_right(right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The right side of a many-to-one join: the job fails where a key has
    several rows, instead of counting samples twice."""
    rest = [c for c in right.columns if c not in on]
    g = right.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    key = F.when(F.col("__n") > 1, F.raise_error(F.concat_ws(
        " ", F.lit("many-to-one join: several rows on the right side for"), *[F.col(c).cast("string") for c in on])).cast("string"))
    return g.select(key.otherwise(F.col(on[0])).alias(on[0]), *[c for c in right.columns if c != on[0]])


def series_keys(df: DataFrame, values: Sequence[str] = ("value",), ts_col: str = "ts") -> list[str]:
    """The identity of a series: every label column."""
    return [c for c in df.columns if c not in (*values, ts_col)]


def running_semi(series: DataFrame, phase: DataFrame, on: Sequence[str] = ("pod", "pod_namespace"),
                 phase_col: str = "phase_running") -> DataFrame:
    """M7: keep series points whose pod is Running (== 1) at that grid time."""
    running = phase.filter(F.col(phase_col) == 1).select(*on, "ts")
    return series.join(running, list(on) + ["ts"], "left_semi")


def sum_by(df: DataFrame, labels: Sequence[str], value_col: str = "value", out: str = "value") -> DataFrame:
    """M9: ``sum by (labels)`` at each grid time; no labels = one series."""
    return df.groupBy(*labels, "ts").agg(F.sum(value_col).alias(out))


def nonnegative(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``>= 0`` drops negatives and NaN (NULL stands for NaN here)."""
    v = F.col(value_col)
    return df.filter(v.isNotNull() & ~F.isnan(v) & (v >= 0))


def ratio(num: Column, den: Column) -> Column:
    """PromQL division: x/0 = +Inf, 0/0 = NaN (NULL, removed by M15)."""
    return (F.when(den == 0, F.when(num == 0, F.lit(None).cast("double"))
                   .when(num > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
            .otherwise(num / den))


def bucket_arrays(buckets: DataFrame, labels: Sequence[str], le_col: str = "le",
                  value_col: str = "value") -> DataFrame:
    """Per (labels, ts): the buckets as an array sorted by ``le`` with counts
    lifted to their running maximum (non-monotonic input is repaired).  One
    array holds one entry per bucket bound, never more."""
    labels = list(labels)
    arr = F.array_sort(F.collect_list(F.struct(F.col(le_col).alias("le"), F.col(value_col).alias("v"))))
    g = buckets.groupBy(*labels, "ts").agg(arr.alias("__b"))
    vals = F.transform(F.col("__b"), lambda x: x["v"])
    mono = F.transform(F.col("__b"), lambda x, i: F.struct(
        x["le"].alias("le"), F.array_max(F.slice(vals, 1, i + 1)).alias("v")))
    return g.select(*labels, "ts", mono.alias("m"))


def quantile_of(m: Column, q: float) -> Column:
    """PromQL bucket quantile over a prepared bucket array ``m``: rank =
    q * total; first bucket whose count reaches the rank; linear inside it;
    the ``+Inf`` bucket answers the highest finite bound; missing ``+Inf``,
    fewer than two buckets or no observations give NULL (NaN)."""
    k = F.size(m)
    last = F.element_at(m, -1)
    total = last["v"]
    rank = F.lit(float(q)) * total
    b = F.array_position(F.transform(m, lambda x: x["v"] >= rank), True).cast("int")
    at = lambda i: F.element_at(m, i)
    prev = at(F.greatest(b - 1, F.lit(1)))
    cur = at(F.greatest(b, F.lit(1)))
    start = F.when(b == 1, F.lit(0.0)).otherwise(prev["le"])
    cnt = F.when(b == 1, cur["v"]).otherwise(cur["v"] - prev["v"])
    rk = F.when(b == 1, rank).otherwise(rank - prev["v"])
    interp = start + (cur["le"] - start) * F.try_divide(rk, cnt)
    return (F.when(F.lit(q) < 0, F.lit(float("-inf"))).when(F.lit(q) > 1, F.lit(float("inf")))
            .when(last["le"] != F.lit(float("inf")), F.lit(None).cast("double"))
            .when(k < 2, F.lit(None).cast("double"))
            .when(total == 0, F.lit(None).cast("double"))
            .when(b == k, at(F.greatest(k - 1, F.lit(1)))["le"])
            .when((b == 1) & (cur["le"] <= 0), cur["le"])
            .otherwise(interp))


def histogram_quantile(buckets: DataFrame, q: float, labels: Sequence[str], le_col: str = "le",
                       value_col: str = "value") -> DataFrame:
    """Quantile from cumulative buckets per (labels, ts)."""
    g = bucket_arrays(buckets, labels, le_col, value_col)
    return g.select(*labels, "ts", quantile_of(F.col("m"), q).alias("value"))


def first_series(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Only the first series (smallest label tuple) of a result.  The
    scope labels are also equality filters upstream, so at most one series
    normally exists; this makes the choice deterministic when more do.
    A one-row aggregate picks the series, a semi-join keeps its points."""
    labels = list(labels)
    if not labels:
        return df
    first = df.agg(F.min(F.struct(*labels)).alias("__k")).select(*[F.col("__k")[c].alias(c) for c in labels])
    return df.join(first, labels, "left_semi")


def to_points(df: DataFrame, ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """A series as ordered (timestamp, value) points."""
    return df.select(F.col(ts_col).alias("ts"), F.col(value_col).cast("double").alias("value")).orderBy("ts")


def union_series(parts: dict[str, DataFrame]) -> DataFrame:
    """Several named series in one result (``series`` column)."""
    out = None
    for name, df in parts.items():
        d = df.withColumn("series", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
