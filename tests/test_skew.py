"""Blocked scans with a hot key (a third of the rows) equal the plain window forms."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from skylight.functions.scan import running_total
from skylight.operators import alerts as A
from skylight.operators import metrics as M

T0 = dt.datetime(2024, 1, 1)


def _skewed(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"
        rows.append((key, i, T0 + dt.timedelta(seconds=37 * i), float(rnd.randint(-5, 20))))
    return spark.createDataFrame(rows, "key string, seq long, ts timestamp_ntz, value double")


def test_running_total_hot_key_equals_window(spark):
    df = _skewed(spark).withColumn("v", F.col("value").cast("bigint"))
    got = running_total(df, ["key"], "seq", "v", "cum", block_width=64)
    w = Window.partitionBy("key").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("cum", F.sum("v").over(w))
    cols = ["key", "seq", "cum"]
    assert got.select(cols).exceptAll(ref.select(cols)).count() == 0
    assert got.count() == ref.count()


def test_prev_sample_hot_key_equals_lag(spark):
    df = _skewed(spark)
    got = M.prev_sample(df.select("key", "ts", "value"), ["key"], block_us=3_600_000_000)
    ref = df.withColumn("prev_value", F.lag("value").over(Window.partitionBy("key").orderBy("ts")))
    cols = ["key", "ts", "prev_value"]
    assert got.select(cols).exceptAll(ref.select(cols)).count() == 0
    assert got.count() == ref.count()


def test_islands_hot_key_equal_sequential_replay(spark):
    df = _skewed(spark)
    got = {(r.key, r.ts): r.firing for r in
           A.fire_after(df, ["key"], "ts", F.col("value") > 0, 600, block_us=3_600_000_000).collect()}
    rows = sorted(df.collect(), key=lambda r: (r.key, r.ts))
    start, prev_key, ok = None, None, 0
    for r in rows:
        if r.key != prev_key:
            start, prev_key = None, r.key
        if r.value > 0:
            start = r.ts if start is None else start
            expected = (r.ts - start).total_seconds() >= 600
        else:
            start, expected = None, False
        ok += got[(r.key, r.ts)] == expected
    assert ok == len(rows)
