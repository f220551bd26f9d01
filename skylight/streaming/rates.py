"""Exact counter rates on a stream (St6): equal to the batch ``rate``.

Series are dealt to shards (``shards.py``). A shard keeps the samples that a
coming grid point's window ``(g - range, g]`` can still hold, whatever order
they arrive in; its timer fires once the watermark passes the next grid point
that one of them feeds. The window's samples are then
sorted, counter resets inside it are added up, the increase is extrapolated to
the window's ends, and samples that no later window holds are dropped. Resets
at the edge of two windows are seen by every window that holds both samples.
A series that goes quiet loses its last sample, and its state, ``range`` later.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from skylight.functions.timeutil import epoch_micros
from skylight.operators.metrics import EXTRAPOLATION_SLACK

from .alert_state import require_rocksdb
from .shards import SHARDS, Shard, key_columns, key_schema, shard_of, to_ms, typed_back


def _upto(series: np.ndarray, us: np.ndarray, at_series: np.ndarray, at_us: np.ndarray) -> np.ndarray:
    """How many of the samples, sorted by (series, us), come up to each place."""
    n = len(us)
    later = np.arange(n + len(at_us)) >= n  # equal samples are before a place
    order = np.lexsort((later, np.concatenate([us, at_us]), np.concatenate([series, at_series])))
    seen = np.cumsum(~later[order])
    out = np.empty(len(at_us), np.int64)
    places = later[order]
    out[order[places] - n] = seen[places]
    return out


def window_rates(series: np.ndarray, us: np.ndarray, value: np.ndarray, first: int, last: int, anchor: int, step: int,
                 range_us: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(series, g, rate) at the grid points ``anchor + i * step`` for ``first <= i
    <= last`` whose window has two samples; samples are sorted by (series, us)."""
    lo = np.maximum(-((anchor - us) // step), first)
    hi = np.minimum(-((anchor - us - range_us) // step) - 1, last)
    size = np.maximum(hi - lo + 1, 0)
    s, i = np.repeat(series, size), np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
    order = np.lexsort((i, s))
    s, i = s[order], i[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1])
    s, g = s[new], anchor + i[new] * step
    to, since = _upto(series, us, s, g), _upto(series, us, s, g - range_us)
    n = to - since
    ok = n >= 2
    s, g, to, since, n = s[ok], g[ok], to[ok], since[ok], n[ok]
    drop = np.zeros(len(us) + 1)
    if len(us):
        drop[1:-1] = np.where((value[1:] < value[:-1]) & (series[1:] == series[:-1]), value[:-1], 0.0)
    resets = np.add.reduceat(drop, np.stack([since + 1, to], 1).ravel())[::2] if len(s) else np.zeros(0)
    start, increase = value[since], value[to - 1] - value[since] + resets
    sampled = (us[to - 1] - us[since]) / 1e6
    if not sampled.all():
        raise ZeroDivisionError("all samples of a window have one time")
    mean = sampled / (n - 1)
    reach = mean * EXTRAPOLATION_SLACK
    before, after = (us[since] - (g - range_us)) / 1e6, (g - us[to - 1]) / 1e6
    before = np.where(before >= reach, mean / 2, before)
    after = np.where(after >= reach, mean / 2, after)
    with np.errstate(all="ignore"):
        before = np.where((increase > 0) & (start >= 0), np.minimum(before, sampled * (start / increase)), before)
        return s, g, increase * (sampled + before + after) / sampled / (range_us / 1e6)


class SeriesRate(StatefulProcessor):
    def __init__(self, columns: list[str], n_keys: int, anchor_us: int, step_us: int, range_us: int):
        self.columns, self.n_keys = columns, n_keys
        self.anchor, self.step, self.range = anchor_us, step_us, range_us
        # names of their own, as a key may have any name
        self.names = [f"k{i}" for i in range(n_keys)]

    def init(self, handle) -> None:
        self.shard = Shard(handle)
        self.done = handle.getValueState("done", "ms bigint")

    def _index(self, us):
        """Number of the first grid point that is not before a time."""
        return -((self.anchor - us) // self.step)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [pdf[[*self.columns[:self.n_keys], "sample_us", "sample_value"]] for pdf in rows if len(pdf)]
        if parts:
            new = pd.concat(parts).set_axis([*self.names, "us", "value"], axis=1)
            self.shard.add(new)
            self.shard.wake(to_ms(self.anchor + int(self._index(new["us"].min())) * self.step))
        yield pd.DataFrame(columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = self.shard.held([*self.names, "us", "value"])
        series = held.groupby(self.names, sort=False, dropna=False).ngroup().to_numpy(np.int64) if self.names else np.zeros(len(held), np.int64)
        us, value = held["us"].to_numpy(np.int64), held["value"].to_numpy(np.float64)
        order = np.lexsort((value, us, series))
        held, series, us, value = held.iloc[order], series[order], us[order], value[order]
        # points up to the last firing are out; none of them can have got a sample since
        first = self._index(self.done.get()[0] * 1000 + 1) if self.done.exists() else np.iinfo(np.int64).min
        last = (passed * 1000 - self.anchor) // self.step
        s, g, rate = window_rates(series, us, value, first, last, self.anchor, self.step, self.range)
        out = held[self.names].iloc[np.searchsorted(series, s)].set_axis(self.columns[:self.n_keys], axis=1).reset_index(drop=True)
        out[self.columns[-2]], out[self.columns[-1]] = g.view("datetime64[us]"), rate
        coming = self.anchor + (last + 1) * self.step
        left = us > coming - self.range
        due = None
        if left.any():
            due = to_ms(max(coming, self.anchor + int(self._index(us[left].min())) * self.step))
            self.done.update((passed,))
        else:
            self.done.clear()
        self.shard.keep(held[left], due)
        yield out

    def close(self) -> None:
        pass


def rate_stream(samples: DataFrame, keys: Sequence[str], anchor, step_s: float, range_s: float, value_col: str = "value",
                ts_col: str = "ts", lateness: str = "10 minutes", shards: int = SHARDS) -> DataFrame:
    """(keys, ts, value) at every grid point ``anchor + k * step`` whose window
    has two samples, once the watermark has passed it."""
    require_rocksdb(samples.sparkSession)
    keys = list(keys)
    d = samples.select(*key_columns(samples, keys), F.col(ts_col).cast("timestamp").alias("sampled_at"), F.col(value_col).cast("double").alias("sample_value"))
    d = (d.filter("sampled_at IS NOT NULL").withWatermark("sampled_at", lateness)
         .withColumn("sample_us", F.unix_micros("sampled_at")).withColumn("shard", shard_of(keys, shards)))
    kinds = "".join(f"{x}, " for x in [key_schema(samples, keys)] if keys)
    got = d.groupBy("shard").transformWithStateInPandas(
        SeriesRate([*keys, "ts", "value"], len(keys), epoch_micros(anchor), int(step_s * 1_000_000), int(range_s * 1_000_000)),
        f"{kinds}ts timestamp, value double", "Append", "eventTime")
    return typed_back(got, samples, keys)
