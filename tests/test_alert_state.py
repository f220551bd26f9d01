"""Pending and throttle in keyed state: any order, nothing left behind."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skylight.operators import alerts as A
from skylight.sources import sinks as K
from skylight.streaming import alert_state as S
from skylight.streaming import pipelines as SP

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def shuffled(spark):
    """Evaluations of eight rules in many files, mixed within an hour; a last
    row of another rule moves the watermark past all of them."""
    r = random.Random(5)
    evals = [(f"r{k}", T0 + dt.timedelta(minutes=5 * i, microseconds=k), r.random() < 0.7) for k in range(8) for i in range(90)]
    order = sorted(evals, key=lambda e: e[1] + dt.timedelta(minutes=r.uniform(0, 55)))
    path = K.scratch_path(spark, "evals")
    schema = "rule_name string, tick timestamp, ok boolean"
    for i in range(0, len(order), 180):
        spark.createDataFrame(order[i:i + 180], schema).coalesce(1).write.mode("append").parquet(path)
    for d in (10, 20):
        spark.createDataFrame([("end", T0 + dt.timedelta(days=d), False)], schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return spark.createDataFrame(evals, schema), stream


def drive(spark, df):
    out, ckpt = K.scratch_path(spark, "state-out"), K.scratch_path(spark, "state-ckpt")
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    ops = [s for p in q.recentProgress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in ops) == 0
    return spark.read.schema(df.schema).parquet(out).filter("rule_name <> 'end'"), ops[-1]["numRowsTotal"]


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_pending_in_any_order(spark, shuffled):
    batch, stream = shuffled
    got, left = drive(spark, S.pending_ordered(stream, ["rule_name"], "tick", F.col("ok"), 900, lateness="1 hour"))
    want = A.pending_to_firing(batch, ["rule_name"], "tick", F.col("ok"), 900) if hasattr(A, "pending_to_firing") else None
    cols = ["rule_name", "tick", "island_start", "firing"]
    if want is None:
        state, out = {}, []
        for k, t, ok in sorted(tuple(r) for r in batch.collect()):
            state[k] = (state.get(k) or t) if ok else None
            out.append((k, t, state[k], bool(ok and t - state[k] >= dt.timedelta(seconds=900))))
        assert [tuple(r) for r in sorted(map(tuple, got.select(*cols).collect()))] == out
    else:
        assert rows(got, *cols) == rows(want, *cols)
    assert left <= 4  # of the rule that ended the stream


def test_throttle_in_any_order(spark, shuffled):
    batch, stream = shuffled
    got, left = drive(spark, S.throttle_ordered(stream.filter("ok OR rule_name = 'end'"), every_s=3600, lateness="1 hour"))
    want = A.throttle(batch.filter("ok"), "rule_name", "tick", 3600)
    assert rows(got, "rule_name", "tick") == rows(want, "rule_name", "tick")
    assert left <= 4


def test_a_rule_that_is_silent_starts_anew(spark):
    schema = "rule_name string, tick timestamp, ok boolean"
    path = K.scratch_path(spark, "silent")
    for t in (0, 10, 60 * 24 * 3, 60 * 24 * 9):
        spark.createDataFrame([("r", T0 + dt.timedelta(minutes=t), True)], schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got, _ = drive(spark, S.pending_ordered(stream, ["rule_name"], "tick", F.col("ok"), 600, forget_s=86400))
    assert [(r[1], r[2]) for r in rows(got, "tick", "island_start", "firing")] == [
        (T0, False), (T0, True), (T0 + dt.timedelta(days=3), False)]


def test_steps_are_those_of_the_old_stream():
    assert SP.throttled_notifications and S.throttle_step(60)((None, None), 5, False) == ((None, None), None)
