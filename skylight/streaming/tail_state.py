"""I9 on streams in keyed state: no span store is written or read again.

Two ``transformWithState`` steps:

* ``TraceWait``, by shard of traces (``shards.py``): the least ``limit + 1`` span
  times of each open trace (a larger trace can never be kept, so nothing more is
  needed) and the trace's close, ``max(wait_s, max_trace_s)`` after its first
  span. A closed trace of up to ``limit`` spans goes on as one row, if it is
  among the first ``limit / n`` of its size and bucket in the shard; a mark stays
  for ``forget_s``, so that its later spans do not open it anew.
* ``BucketBudget``, by decision bucket: of each size ``n`` the first
  ``limit / n`` traces (see ``ingest.tail_sample`` why no other can be kept),
  one timer at the bucket's close, at which the rule is folded over them.

Spans are thinned per Arrow batch before the shuffle, so a trace that holds a
third of all spans is not moved whole. State is bounded by the open traces and
buckets, whatever the length of the run.

Times are event times, so the order of arrival does not matter as long as no
span comes later than ``lateness``; such spans are dropped and counted by
Spark. Spans that start after their trace's close do not count. NULL ids and
times are left out, as they can be put in no trace or bucket.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from skylight.streaming.alert_state import require_rocksdb
from skylight.streaming.shards import SHARDS, Shard, packed, shard_of, to_ms, unpacked

_CLOSED = ["trace_id", "first_us", "n", "bucket", "closed_at"]
_KEPT = ["trace_id", "decision_ts", "spans"]


def _least(rows: pd.DataFrame, limit: int) -> pd.DataFrame:
    """The least ``limit + 1`` span times of each trace."""
    rows = rows.sort_values("span_us", kind="stable")
    return rows[rows.groupby("trace_id", sort=False).cumcount() <= limit]


class TraceWait(StatefulProcessor):
    """Rows of closed traces: first span time, spans, decision bucket."""

    def __init__(self, wait_us: int, open_us: int, bucket_us: int, limit: int, forget_us: int):
        self.wait_us, self.open_us, self.bucket_us = wait_us, open_us, bucket_us
        self.limit, self.forget_us = limit, forget_us

    def init(self, handle) -> None:
        self.shard = Shard(handle)
        self.closed = handle.getValueState("closed", "chunk binary")

    def _marks(self) -> pd.DataFrame:
        """Closed traces, and until when (ms) they are known as such."""
        t = unpacked([bytes(self.closed.get()[0])]) if self.closed.exists() else None
        return pd.DataFrame({"trace_id": pd.Series(dtype=object), "until": pd.Series(dtype="int64")}) if t is None else t.to_pandas()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([pdf[["trace_id", "span_us"]] for pdf in rows])
        if self.closed.exists():
            new = new[~new["trace_id"].isin(self._marks()["trace_id"])]
        if len(new):
            self.shard.add(_least(new, self.limit))
            self.shard.wake(to_ms(int(new["span_us"].min()) + self.open_us))
        yield pd.DataFrame(columns=_CLOSED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = _least(self.shard.held(["trace_id", "span_us"]).astype({"span_us": "int64"}), self.limit)
        marks = self._marks()
        marks = marks[marks["until"] > passed]
        first = held.groupby("trace_id", sort=False)["span_us"].transform("min")
        past = to_ms(first + self.open_us) <= passed
        counted = held[past & (held["span_us"] <= first + self.open_us)]
        t = counted.groupby("trace_id", sort=False)["span_us"].agg(first_us="min", n="count").reset_index()
        new = pd.DataFrame({"trace_id": t["trace_id"], "until": to_ms(t["first_us"] + self.open_us + self.forget_us)})
        marks = pd.concat([marks, new[new["until"] > passed]])
        t["bucket"] = (t["first_us"] + self.wait_us) // self.bucket_us
        t = t[t["n"] <= self.limit].sort_values(["first_us", "trace_id"], kind="stable")
        # no bucket can keep more of one size
        t = t[t.groupby(["bucket", "n"]).cumcount() < self.limit // t["n"]]
        # rows for the next step may not be older than the watermark
        t["closed_at"] = pd.Timestamp(passed + 1, unit="ms")
        left = held[~past]
        due = [*([to_ms(int(first[~past].min()) + self.open_us)] if len(left) else []), *([int(marks["until"].min())] if len(marks) else [])]
        if len(marks):
            self.closed.update((packed(pa.Table.from_pandas(marks, preserve_index=False)),))
        else:
            self.closed.clear()
        self.shard.keep(left, min(due, default=None))
        yield t[_CLOSED]

    def close(self) -> None:
        pass


class BucketBudget(StatefulProcessor):
    """Kept traces of closed buckets."""

    def __init__(self, wait_us: int, open_us: int, bucket_us: int, limit: int):
        self.wait_us, self.open_us, self.bucket_us, self.limit = wait_us, open_us, bucket_us, limit

    def init(self, handle) -> None:
        self.handle = handle
        self.traces = handle.getListState("traces", "first_us bigint, trace_id string, n bigint")

    def _candidates(self, traces: list) -> list:
        """The first ``limit / n`` traces of each size, in time order."""
        taken, out = Counter(), []
        for t in sorted(traces):
            if (taken[t[2]] + 1) * t[2] <= self.limit:
                taken[t[2]] += 1
                out.append(t)
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.traces.get()]
        if not held:
            # every trace of the bucket is closed by then
            self.handle.registerTimer(to_ms((int(key[0]) + 1) * self.bucket_us - self.wait_us + self.open_us))
        for pdf in rows:
            held = self._candidates(held + [(int(us), t, int(n)) for us, t, n in zip(pdf["first_us"], pdf["trace_id"], pdf["n"])])
        self.traces.put(held)
        yield pd.DataFrame(columns=_KEPT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows, used = [], 0
        for us, trace, n in sorted(tuple(r) for r in self.traces.get()):
            if used + n <= self.limit:
                used += n
                rows.append((trace, pd.Timestamp(us + self.wait_us, unit="us"), n))
        self.traces.clear()
        yield pd.DataFrame(rows, columns=_KEPT)

    def close(self) -> None:
        pass


def _thinned(limit: int):
    """The least ``limit + 1`` times of a trace in each Arrow batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _least(pdf, limit)
    return run


def tail_sample_stream(spans: DataFrame, wait_s: float = 10, limit: int = 10, bucket_s: float = 1, trace_col: str = "trace_id",
                       ts_col: str = "start_ts", max_trace_s: float = 600, lateness: str = "1 minute", forget_s: float = 3600,
                       shards: int = SHARDS) -> DataFrame:
    """``ingest.tail_sample`` of a stream of spans in any order: (trace_id,
    decision_ts TIMESTAMP, spans) of kept traces, once their bucket is closed.
    Equal to the batch form where no trace lasts longer than ``max_trace_s``."""
    require_rocksdb(spans.sparkSession)
    wait, bucket, forget = (int(s * 1_000_000) for s in (wait_s, bucket_s, forget_s))
    opened = max(wait, int(max_trace_s * 1_000_000))
    s = spans.select(F.col(trace_col).cast("string").alias("trace_id"), F.col(ts_col).cast("timestamp").alias("span_at"))
    s = s.filter("trace_id IS NOT NULL AND span_at IS NOT NULL").withColumn("span_us", F.unix_micros("span_at"))
    s = s.mapInPandas(_thinned(limit), s.schema).withWatermark("span_at", lateness)
    closed = s.withColumn("shard", shard_of(["trace_id"], shards)).groupBy("shard").transformWithStateInPandas(
        TraceWait(wait, opened, bucket, limit, forget), "trace_id string, first_us bigint, n bigint, bucket bigint, closed_at timestamp",
        "Append", "eventTime", eventTimeColumnName="closed_at")
    return closed.groupBy("bucket").transformWithStateInPandas(
        BucketBudget(wait, opened, bucket, limit), "trace_id string, decision_ts timestamp, spans bigint", "Append", "eventTime")
