"""Streams whose state is kept by shard of keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylight.sources.sinks import scratch_path
from skylight.streaming import alert_state as S
from skylight.streaming import rates as R
from skylight.streaming.tail_state import tail_sample_stream

T0 = dt.datetime(2024, 1, 1)


def _drive(spark, build, rows, schema):
    path, out, ckpt = (scratch_path(spark, f"shards-{x}") for x in ("src", "out", "ckpt"))
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    df = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"])


@pytest.mark.parametrize("build", [
    lambda d: tail_sample_stream(d, wait_s=10, limit=3, bucket_s=5, trace_col="k", ts_col="ts", shards=2),
    lambda d: R.rate_stream(d.withColumn("value", F.lit(1.0)), ["k"], T0, 60, 60, shards=2),
    lambda d: S.pending_ordered(d, ["k"], "ts", F.lit(True), 60, shards=2),
], ids=["tail", "rate", "pending"])
def test_rows_of_state_do_not_follow_the_keys(spark, build):
    rows = [(f"k{i}", T0 + dt.timedelta(milliseconds=i)) for i in range(300)]
    _, state = _drive(spark, build, [rows], "k string, ts timestamp")
    assert 0 < state <= 2 * 4


def test_keys_come_back_as_they_were(spark):
    keys = [2**62 + 1, -5, None, 2**62 + 3]
    rows = [(k, T0 + dt.timedelta(seconds=s)) for k in keys for s in (0, 90)]
    end = [[(7, T0 + dt.timedelta(days=d))] for d in (10, 20)]
    got, _ = _drive(spark, lambda d: S.pending_ordered(d, ["k"], "ts", F.lit(True), 60, shards=1), [rows, *end], "k long, ts timestamp")
    assert got.schema["k"].dataType.simpleString() == "bigint"
    fired = {r["k"] for r in got.filter("firing").collect()}
    assert fired == set(keys)
