"""Streaming rates, the ledger of late rows, and stored trace sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skylight.functions.scope import Scope
from skylight.operators import metrics as M
from skylight.operators import trace_sketches as TS
from skylight.operators import traces as T
from skylight.sources import sinks as K
from skylight.sources.fixtures import Views
from skylight.streaming import ledger as L
from skylight.streaming import pipelines as SP
from skylight.streaming import rates as R

from conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def files(spark, rows, schema, name, parts):
    path = K.scratch_path(spark, name)
    for p in parts(rows):
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("step_s,range_s", [(300, 300), (300, 700), (600, 240)])
def test_rate_equals_batch_with_resets_at_window_edges(spark, step_s, range_s):
    r = random.Random(step_s + range_s)
    rows = []
    for s in range(5):
        v, us = r.uniform(0, 30), 0
        for i in range(60):
            us += int(r.choice([15, 30, 60, 300, 1500]) * 1e6) + r.randrange(3)
            v = r.uniform(0, 3) if r.random() < 0.15 else v + r.uniform(0, 9)
            rows.append((f"s{s}", T0 + dt.timedelta(microseconds=us), v))
    schema = "series string, ts timestamp, value double"
    mixed = sorted(rows, key=lambda x: x[1] + dt.timedelta(seconds=r.uniform(0, 3000)))
    end = [("end", T0 + dt.timedelta(days=d), 0.0) for d in (30, 60)]
    stream = files(spark, mixed, schema, "rate", lambda x: [x[i:i + 100] for i in range(0, len(x), 100)] + [[e] for e in end])
    out, ckpt = K.scratch_path(spark, "rate-out"), K.scratch_path(spark, "rate-ckpt")
    df = R.rate_stream(stream, ["series"], T0, step_s, range_s, lateness="1 hour")
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(x["series"], x["ts"]): x["value"] for x in spark.read.schema(df.schema).parquet(out).collect()}
    grid = M.Grid.of(T0, T0 + dt.timedelta(days=3), step_s)
    batch = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = {(x["series"], x["ts"]): x["value"] for x in M.rate(batch, ["series"], grid, range_s).collect()}
    assert set(got) == set(want) and len(want) > 25
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4  # of the series that ended the stream


def test_late_rows_are_counted_over_many_batches_and_restarts(spark):
    listed = K.scratch_path(spark, "late-ledger")
    listener, of_runs = L.LateRows(spark, listed), []
    spark.streams.addListener(listener)
    try:
        schema = "k string, event_time timestamp"
        path, ckpt, out = (K.scratch_path(spark, x) for x in ("late-src", "late-ckpt", "late-out"))
        for run in range(2):
            for i in range(4):
                day = 10 * (4 * run + i)
                late = [("late", T0)] * 3 if day else []
                spark.createDataFrame([("k", T0 + dt.timedelta(days=day)), *late], schema).coalesce(1).write.mode("append").parquet(path)
            s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
            q = (SP.rate_limit_stream(s, "k").writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            of_runs.append(SP.late_rows(q))  # one run's reports only
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    total = L.dropped_rows(spark, listed).collect()
    assert len(total) == 1 and total[0]["dropped"] == sum(of_runs) > of_runs[-1] > 0


def test_late_side_output(spark):
    path = K.scratch_path(spark, "late-side")
    seen = []
    run = L.split_late(path, ["k"], "ts", 60, lambda b, e: seen.append((e, b.count())))
    schema = "k string, ts timestamp_ntz"
    at = lambda *s: spark.createDataFrame([(f"k{x % 2}", T0 + dt.timedelta(seconds=x)) for x in s], schema)
    run(at(0, 1000), 0)
    run(at(990, 100, 101, 2000), 1)
    run(at(990, 100, 101, 2000), 1)  # the epoch runs again
    run(at(5), 2)
    assert seen == [(0, 2), (1, 2), (1, 2), (2, 0)]
    got = {r["k"]: (r["late_rows"], r["worst_s"]) for r in L.late_totals(spark, path, schema, ["k"]).collect()}
    assert got == {"k0": (1, 900.0), "k1": (2, 1995.0)}


def test_sketched_total_reads_no_spans_of_whole_days(spark):
    spans = Views(spark, SF_SMALL).spans()
    path = K.scratch_path(spark, "sketches")
    TS.write_trace_sketches(spans, path)
    stored = spark.read.parquet(path)
    scope = Scope("ns-1", component=["comp-1", "comp-4"])
    for a, b in (("2024-01-03 00:00:00", "2024-01-20 00:00:00"), ("2024-01-03 05:00:00", "2024-01-03 09:00:00"), ("2024-01-03 22:00:00", "2024-01-06 01:00:00"),
                 ("2024-01-05 00:00:00", "2024-01-05 00:00:00")):
        exact = T.trace_total_exact(spans, scope, a, b).first()[0]
        assert abs(TS.approximate_trace_total(stored, spans, scope, a, b).first()[0] - exact) <= TS.BOUND * exact + 1
    # whole days: right without any spans
    assert TS.approximate_trace_total(stored, spans.limit(0), scope, "2024-01-03 00:00:00", "2024-01-20 00:00:00").first()[0] > 0
