"""A6 and A7 on streams, with timers: results do not depend on arrival order.

Both rules fold over one key's evaluations in time order. ``OrderedFold`` is a
``transformWithState`` processor that does so on a shuffled stream, for all
keys of a shard at once (``shards.py``):

* the shard's rows are the evaluations that the watermark has not passed yet;
* its timer fires once the watermark passes the least of them; what is then in
  the past is folded in time order;
* a value state holds the fold of each key (start of the current run, last
  sent time);
* ``forget_s`` after the last folded evaluation a key's fold goes, so rules
  that are gone leave no state behind. A run, or a throttle, that would
  go on after such a silence starts anew.

Rows older than the watermark are dropped and counted by Spark
(``numRowsDroppedByWatermark``). The state store must be RocksDB;
``require_rocksdb`` sets it for the session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .shards import SHARDS, Shard, key_columns, key_schema, packed, shard_of, to_ms, typed_back, unpacked

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class OrderedFold(StatefulProcessor):
    """``step(fold, us, cond) -> (fold, row or None)`` over each key's evaluations
    in time order; ``fold`` is a pair of microsecond times or NULLs, as are the
    ``times`` among the row's columns."""

    def __init__(self, step: Callable, columns: list[str], times: list[str], n_keys: int, forget_s: float):
        self.step, self.columns, self.times, self.forget_ms = step, columns, times, int(forget_s * 1000)
        self.n_keys = n_keys
        # names of their own, as a key may have any name
        self.held = [*(f"k{i}" for i in range(n_keys)), "us", "cond"]

    def init(self, handle) -> None:
        self.shard = Shard(handle)
        self.folds = handle.getValueState("folds", "chunk binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [pdf[[*self.columns[:self.n_keys], "evaluated_us", "is_true"]] for pdf in rows if len(pdf)]
        if parts:
            new = pd.concat(parts).set_axis(self.held, axis=1)
            self.shard.add(new)
            self.shard.wake(to_ms(int(new["us"].min())))
        yield pd.DataFrame(columns=self.columns)

    def _load(self) -> dict:
        t = unpacked([bytes(self.folds.get()[0])]) if self.folds.exists() else None
        if t is None:
            return {}
        *keys, a, b, last = (c.to_pylist() for c in t.columns)
        return dict(zip(zip(*keys), zip(a, b, last)))

    def _save(self, folds: dict) -> None:
        if not folds:
            self.folds.clear()
            return
        columns = [*(pa.array(c) for c in zip(*folds)), *(pa.array(c, pa.int64()) for c in zip(*folds.values()))]
        self.folds.update((packed(pa.table(columns, names=[*self.held[:self.n_keys], "a", "b", "last"])),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = self.shard.held(self.held)
        past = to_ms(held["us"]) <= passed
        left = held[~past]
        folds, rows = self._load(), []
        for *k, us, cond in held[past].sort_values(["us", "cond"], kind="stable").itertuples(index=False, name=None):
            k = tuple(k)
            a, b, last = folds.get(k, (None, None, None))
            if last is not None and us - last > self.forget_ms * 1000:
                a = b = None
            state, row = self.step((a, b), us, cond)
            folds[k] = (*state, us)
            if row is not None:
                rows.append((*k, *row))
        folds = {k: f for k, f in folds.items() if to_ms(f[2]) + self.forget_ms > passed}
        self._save(folds)
        due = [to_ms(f[2]) + self.forget_ms for f in folds.values()]
        if len(left):
            due.append(to_ms(int(left["us"].min())))
        self.shard.keep(left, min(due, default=None))
        out = pd.DataFrame(rows, columns=self.columns)
        if rows:
            for c in self.times:
                at = self.columns.index(c)
                out[c] = np.array([_NONE if r[at] is None else r[at] for r in rows], np.int64).view("datetime64[us]")
        yield out

    def close(self) -> None:
        pass


#: NaT as a number.
_NONE = np.iinfo(np.int64).min


def pending_step(for_s: float) -> Callable:
    """Start of the run of true conditions, and whether it fires."""
    hold = int(for_s * 1_000_000)

    def step(state, us, cond):
        start = (us if state[0] is None else state[0]) if cond else None
        return (start, None), (us, start, cond and us - start >= hold)
    return step


def throttle_step(every_s: float) -> Callable:
    """A firing evaluation is sent if none was within ``every_s``."""
    gap = int(every_s * 1_000_000)

    def step(state, us, cond):
        if not cond or (state[0] is not None and us < state[0] + gap):
            return state, None
        return (us, None), (us,)
    return step


def _ordered(evals: DataFrame, keys: list[str], ts_col: str, cond, step: Callable, out: str, lateness: str, forget_s: float,
             shards: int = SHARDS) -> DataFrame:
    require_rocksdb(evals.sparkSession)
    d = evals.select(*key_columns(evals, keys), F.col(ts_col).cast("timestamp").alias("evaluated_at"), F.coalesce(cond, F.lit(False)).alias("is_true"))
    d = d.filter("evaluated_at IS NOT NULL").withWatermark("evaluated_at", lateness)
    d = d.withColumn("evaluated_us", F.unix_micros("evaluated_at")).withColumn("shard", shard_of(keys, shards))
    fields = [x.split() for x in out.split(", ")]
    got = d.groupBy("shard").transformWithStateInPandas(
        OrderedFold(step, [*keys, *[x[0] for x in fields]], [x[0] for x in fields if x[1] == "timestamp"], len(keys), forget_s),
        f"{key_schema(evals, keys)}, {out}", "Append", "eventTime")
    return typed_back(got, evals, keys)


def pending_ordered(evals: DataFrame, keys: list[str], ts_col: str, cond, for_s: float, lateness: str = "10 minutes",
                    forget_s: float = 86400, shards: int = SHARDS) -> DataFrame:
    """A6 on a stream in any order: (keys, ts, island_start, firing)."""
    return _ordered(evals, list(keys), ts_col, cond, pending_step(for_s),
                    f"{ts_col} timestamp, island_start timestamp, firing boolean", lateness, forget_s, shards)


def throttle_ordered(firing: DataFrame, key: str = "rule_name", ts_col: str = "tick", every_s: float = 3600, lateness: str = "10 minutes",
                     forget_s: float = 86400, shards: int = SHARDS) -> DataFrame:
    """A7 on a stream in any order: (key, ts) of the notices that are sent;
    ``forget_s`` is at least ``every_s``."""
    return _ordered(firing, [key], ts_col, F.lit(True), throttle_step(every_s), f"{ts_col} timestamp", lateness, max(forget_s, every_s), shards)
