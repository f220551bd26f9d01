"""A8 with its three timers: when a group of alerts is notified.

An alert is seen firing at points in time and counts as active from the first
until ``resolve_s`` after the last one, as long as no gap is longer than that.
Alerts with one group key share a group:

* it is opened by its first active alert and looked at ``wait_s`` later, then
  every ``interval_s``;
* a look at which no alert is active closes it (resolved alerts are not sent);
  the next alert opens a new one;
* any other look sends a notice if an active alert was not part of the last
  notice, or the last notice is ``repeat_s`` old.

Sightings are combined per (alert, bucket of ``resolve_s``) before anything is
ordered, so a busy alert is at most one row a bucket. A silence of
``interval_s`` or more always holds a look and closes the group whatever came
before; groups are cut there, and the pieces are walked in parallel. A piece
is streamed through its task in time order; memory is bounded by the alerts
that are active in one group at a time. A group that is never silent is one
piece, of one row per time that an alert was active.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylight.functions.timeutil import long_lit, micros_col

_OUT = ["grp", "at_us", "reason", "n_active", "n_new"]


class _Group:
    """One group's timers, walked over its alerts by start. Every alert costs
    a few set operations; looks at which nothing can change are skipped."""

    def __init__(self, name, wait: int, interval: int, repeat: int):
        self.name, self.wait, self.interval, self.repeat = name, wait, interval, repeat
        self.close()

    def close(self) -> None:
        self.ends: list[tuple[int, str]] = []   # heap; an alert that came back is in it twice
        self.active: dict[str, int] = {}        # alert -> its end
        self.notified: set[str] = set()         # alerts of the last notice,
        self.gone: set[str] = set()             # those of them that ended since,
        self.fresh: set[str] = set()            # and active alerts that were not in it
        self.first_look = self.look = self.last = None
        self.quiet_from = 0

    def _look_from(self, us: int) -> int:
        """The first look that is not before a time."""
        return self.first_look + max(0, -(-(us - self.first_look) // self.interval)) * self.interval

    def add(self, alert: str, start: int, end: int) -> Iterator[tuple]:
        """Notices of the looks before ``start``; then the alert is active."""
        yield from self.walk(start)
        if self.look is None:
            self.first_look = self.look = start + self.wait
        else:
            self.look = min(self.look, self._look_from(start))
        heapq.heappush(self.ends, (end, alert))
        self.active[alert] = end
        self.gone.discard(alert)
        if alert not in self.notified:
            self.fresh.add(alert)
        self.quiet_from = max(self.quiet_from, end)

    def walk(self, until: int | None = None) -> Iterator[tuple]:
        """Notices of the looks before ``until``, or of all that are left."""
        while self.look is not None and (until is None or self.look < until):
            now = self.look
            while self.ends and self.ends[0][0] <= now:
                end, alert = heapq.heappop(self.ends)
                if self.active.get(alert) == end:
                    del self.active[alert]
                    self.fresh.discard(alert)
                    if alert in self.notified:
                        self.gone.add(alert)
            if not self.active:
                self.close()
                return
            if self.fresh or now - self.last >= self.repeat:
                yield (self.name, now, "new" if self.fresh else "repeat", len(self.active), len(self.fresh))
                self.notified -= self.gone
                self.notified |= self.fresh
                self.gone, self.fresh, self.last = set(), set(), now
            self.look = self._look_from(max(now + 1, min(self.quiet_from, self.last + self.repeat)))


def active_intervals(alerts: DataFrame, group_col: str, alert_col: str, ts_col: str, resolve_s: float = 300) -> DataFrame:
    """(grp, alert, start_us, end_us): the times in which each alert is active,
    half-open."""
    resolve = long_lit(int(resolve_s * 1_000_000))
    us = micros_col(ts_col)
    seen = alerts.select(F.col(group_col).alias("grp"), F.col(alert_col).alias("alert"), us.alias("us")).dropna()
    # sightings of one bucket are never apart by more than resolve_s
    b = (seen.groupBy("grp", "alert", ((F.col("us") - F.pmod("us", resolve)) / resolve).cast("bigint").alias("b"))
         .agg(F.min("us").alias("lo"), F.max("us").alias("hi")))
    w = Window.partitionBy("grp", "alert").orderBy("b")
    b = b.withColumn("before", F.lag("hi").over(w))
    b = b.withColumn("island", F.sum(F.when(F.col("lo") - F.col("before") <= resolve, 0).otherwise(1)).over(w))
    return b.groupBy("grp", "alert", "island").agg(F.min("lo").alias("start_us"), (F.max("hi") + resolve).alias("end_us")).drop("island")


def grouped_notices(alerts: DataFrame, group_col: str, alert_col: str, ts_col: str, wait_s: float = 30, interval_s: float = 300,
                    repeat_s: float = 12 * 3600, resolve_s: float = 300) -> DataFrame:
    """(group, notified_at, reason ``new`` or ``repeat``, n_active alerts at
    that time, n_new of them not in the notice before).

    ``alerts`` holds firing sightings only, routed already by their labels. Rows with a NULL group, alert or time are left
    out; repeated and shuffled rows change nothing."""
    wait, interval, repeat = (int(s * 1_000_000) for s in (wait_s, interval_s, repeat_s))
    if interval <= 0 or resolve_s <= 0:
        raise ValueError("interval_s and resolve_s are above 0")
    iv = active_intervals(alerts, group_col, alert_col, ts_col, resolve_s)
    by_start = Window.partitionBy("grp").orderBy("start_us", "end_us")
    iv = iv.withColumn("quiet", F.max("end_us").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    # a gap of an interval holds a look, unless the first one is still to come
    cut = F.when(F.col("start_us") - F.col("quiet") < long_lit(max(interval, wait)), 0).otherwise(1)
    iv = iv.withColumn("piece", F.sum(cut).over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    kind = iv.schema["grp"].dataType.simpleString()
    iv = (iv.select("grp", "piece", F.col("alert").cast("string").alias("alert"), "start_us", "end_us")
          .repartition("grp", "piece").sortWithinPartitions("grp", "piece", "start_us", "end_us", "alert"))

    def notices(batches):
        import pandas as pd

        here = group = None
        for pdf in batches:
            rows = []
            for grp, piece, alert, start, end in zip(pdf["grp"], pdf["piece"], pdf["alert"], pdf["start_us"], pdf["end_us"]):
                if (grp, piece) != here:
                    if group is not None:
                        rows += group.walk()
                    here, group = (grp, piece), _Group(grp, wait, interval, repeat)
                rows += group.add(alert, int(start), int(end))
            yield pd.DataFrame(rows, columns=_OUT)
        if group is not None:
            yield pd.DataFrame(list(group.walk()), columns=_OUT)

    out = iv.mapInPandas(notices, f"grp {kind}, at_us bigint, reason string, n_active bigint, n_new bigint")
    return out.select(F.col("grp").alias(group_col), F.timestamp_micros("at_us").cast("timestamp_ntz").alias("notified_at"),
                      "reason", "n_active", "n_new")
