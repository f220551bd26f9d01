"""Streaming tail sampling in keyed state against the batch rule."""

import datetime as dt
import random

from pyspark.sql import functions as F

from skylight.operators import ingest as I
from skylight.sources.sinks import scratch_path
from skylight.streaming.tail_state import tail_sample_stream

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "trace_id string, start_ts timestamp_ntz"


def _spans(seed=5, traces=150):
    r = random.Random(seed)
    rows = []
    for i in range(traces):
        first = r.uniform(0, 60)
        n = r.choice([1, 1, 2, 3, 5, 9, 30])
        rows += [(f"t{i}", T0 + dt.timedelta(seconds=round(first + (r.uniform(0, 5) if k else 0), 3))) for k in range(n)]
    rows += [("hot", T0 + dt.timedelta(seconds=20, milliseconds=k)) for k in range(2000)]
    return rows


def _run(spark, batches, **opts):
    """The batches as files in turn, then the rows of the sink and the query."""
    path, out, ckpt = (scratch_path(spark, f"tail-{x}") for x in ("src", "out", "ckpt"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        src = spark.readStream.schema(SCHEMA).parquet(path)
        # one run a file: state goes over restarts
        q = (tail_sample_stream(src, **opts).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    got = spark.read.schema("trace_id string, decision_ts timestamp, spans bigint").parquet(out)
    return sorted((r.trace_id, r.decision_ts, r.spans) for r in got.withColumn("decision_ts", F.col("decision_ts").cast("timestamp_ntz")).collect()), q


def test_equals_batch_for_shuffled_spans_and_leaves_no_state(spark):
    rows = _spans()
    shuffled = list(rows)
    random.Random(1).shuffle(shuffled)
    third = len(shuffled) // 3
    far = [("~", T0 + dt.timedelta(days=9))]
    opts = dict(wait_s=10, limit=10, bucket_s=1, max_trace_s=10, forget_s=60)
    got, q = _run(spark, [shuffled[:third], shuffled[third:2 * third], shuffled[2 * third:], far, far], lateness="2 minutes", **opts)
    want = I.tail_sample(spark.createDataFrame(rows, SCHEMA), wait_s=10, limit=10, bucket_s=1).collect()
    assert got == sorted((r.trace_id, r.decision_ts, r.spans) for r in want)
    assert len(got) > 40 and "hot" not in {t for t, _, _ in got}
    # only the row far ahead is still open
    assert sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) < 10


def test_spans_after_the_close_and_nulls_do_not_count(spark):
    def at(s):
        return T0 + dt.timedelta(seconds=s)
    rows = [("a", at(0)), ("a", at(3)), (None, at(1)), ("b", None), ("b", at(1))]
    got, _ = _run(spark, [rows, [("c", at(40)), ("a", at(39))], [("a", at(41)), ("~", at(9000))], [("~", at(9001))]],
                  wait_s=10, limit=3, bucket_s=5, max_trace_s=10, lateness="5 seconds", forget_s=600)
    assert got == [("a", at(10), 2), ("b", at(11), 1), ("c", at(50), 1)]


def test_empty_stream(spark):
    got, _ = _run(spark, [[], []])
    assert got == []
