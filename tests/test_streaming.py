"""Streaming twins equal their batch forms."""

import datetime as dt

from pyspark.sql import functions as F

from skylight.operators import alerts as A
from skylight.sources import sinks as K
from skylight.sources.fixtures import Views
from skylight.streaming import pipelines as SP

from conftest import SF_CHECK


def _as_stream(spark, df, name):
    path = K.scratch_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_sliding_window_stream_equals_batch(spark):
    v = Views(spark, SF_CHECK)
    logs = SP.to_event_time(v.logs())
    stream = _as_stream(spark, logs, "stream-logs-src")
    got = SP.run_to_memory(SP.sliding_log_counts(stream, v.rules(), 6 * 3600, 3600, "100 days"), "slide_counts",
                          mode="complete")
    r = v.rules().filter("enabled")
    j = logs.join(r.select("rule_name", F.col("component_uid").alias("rc"), F.col("environment_uid").alias("re"),
                           F.col("project_uid").alias("rp"), "phrase"),
                  (F.col("component_uid") == F.col("rc")) & (F.col("environment_uid") == F.col("re"))
                  & (F.col("project_uid") == F.col("rp")) & F.col("log").contains(F.col("phrase")))
    batch = j.groupBy("rule_name", F.window("event_time", "6 hours", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("n")).select("rule_name", F.col("w.start").alias("window_start"),
                                              F.col("w.end").alias("window_end"), "n")
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_throttle_stream_equals_fold(spark):
    v = Views(spark, SF_CHECK)
    ticks = A.log_alert_ticks(v.logs(), v.rules(), "2024-01-02", "2024-01-30").filter("firing").select(
        "rule_name", F.col("tick").cast("timestamp").alias("tick"))
    stream = _as_stream(spark, ticks.orderBy("tick").coalesce(1), "stream-ticks")
    got = SP.run_to_memory(SP.throttled_notifications(stream, 86400), "thr_stream")
    batch = A.throttle(ticks, "rule_name", "tick", 86400)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_dedupe_stream(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(f"d{i % 5}", t0 + dt.timedelta(seconds=i)) for i in range(20)],
                               "doc_id string, event_time timestamp")
    got = SP.run_to_memory(SP.dedupe_stream(_as_stream(spark, df, "stream-dups"), watermark="1 day"), "dedup")
    assert got.count() == 5


def test_trace_sessions_stream(spark):
    v = Views(spark, SF_CHECK)
    spans = SP.to_event_time(v.spans(), "start_ts")
    got = SP.run_to_memory(SP.trace_sessions(_as_stream(spark, spans, "stream-spans"), gap="1 day",
                                             watermark="100 days"), "sessions", mode="complete")
    # each fixture trace is one user-day, so sessions never merge two traces
    per_trace = got.groupBy("trace_id").agg(F.sum("span_count").alias("n"))
    batch = v.spans().groupBy("trace_id").agg(F.count(F.lit(1)).alias("n"))
    assert per_trace.exceptAll(batch).count() == 0 and batch.exceptAll(per_trace).count() == 0


def test_pending_stream_equals_islands(spark):
    v = Views(spark, SF_CHECK)
    ev = v.events.select("user_id", "event_id", "ts", "value")
    src = _as_stream(spark, ev.coalesce(1), "stream-pending")
    got = SP.run_to_memory(SP.pending_stream(src, ["user_id"], "ts", F.col("value") > 20, 86400), "pending")
    batch = A.fire_after(ev, ["user_id"], "ts", F.col("value") > 20, 86400)
    g = got.filter("firing").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    b = batch.filter("firing").select("user_id", "ts")
    assert g.count() == b.count() > 0
    assert g.exceptAll(b).count() == 0


def test_alert_ticks_each_batch_equals_batch(spark):
    import time
    v = Views(spark, SF_CHECK)
    logs = v.logs().select("ts", "log", "component_uid", "environment_uid", "project_uid")
    src = K.scratch_path(spark, "stream-alert-src")
    edges = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01"]
    for lo, hi in zip(edges, edges[1:]):
        logs.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))) \
            .coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # distinct file times keep the micro-batches in time order
    store, sink = K.scratch_path(spark, "stream-alert-store"), K.scratch_path(spark, "stream-alert-sink")
    stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (stream.writeStream.foreachBatch(SP.alert_ticks_each_batch(v.rules(), store, sink, "2024-01-02"))
         .option("checkpointLocation", K.scratch_path(spark, "ckpt-alert")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = SP.latest_alert_ticks(spark, sink)
    upto = logs.agg(F.max("ts")).first()[0]
    batch = A.log_alert_ticks(v.logs(), v.rules(), "2024-01-02", upto)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_tail_sample_each_batch_equals_batch(spark):
    import time
    from skylight.operators import ingest as I
    v = Views(spark, SF_CHECK)
    spans = v.spans().select("trace_id", "start_ts")
    src = K.scratch_path(spark, "stream-spans-src")
    edges = ["2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "2024-02-01"]
    for lo, hi in zip(edges, edges[1:]):
        spans.filter((F.col("start_ts") >= F.lit(lo).cast("timestamp_ntz"))
                     & (F.col("start_ts") < F.lit(hi).cast("timestamp_ntz"))).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    store, sink = K.scratch_path(spark, "stream-ts-store"), K.scratch_path(spark, "stream-ts-sink")
    stream = spark.readStream.schema(spans.schema).option("maxFilesPerTrigger", 1).parquet(src)
    fn = SP.tail_sample_each_batch(store, sink, wait_s=86400, limit=20, bucket_s=86400)
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", K.scratch_path(spark, "ckpt-ts"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(sink).drop("epoch")
    # buckets decided by the stream: all but the last (its end never passed)
    last_bucket = got.agg(F.max(F.unix_micros(F.col("decision_ts").cast("timestamp")))).first()[0] // 86400000000
    batch = I.tail_sample(spans, wait_s=86400, limit=20, bucket_s=86400, buckets=(None, last_bucket))
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_late_rows_are_dropped_after_the_window_closed(spark):
    import time
    t0 = dt.datetime(2024, 1, 1, 12)
    src = K.scratch_path(spark, "stream-late")
    schema = "key string, event_time timestamp"
    batches = [[0, 1, 30, 31], [45], [0, 2, 50]]  # minutes after 12:00; the last batch brings late rows
    for mins in batches:
        spark.createDataFrame([("k", t0 + dt.timedelta(minutes=m)) for m in mins], schema) \
            .coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (SP.rate_limit_stream(stream, "key", unit="5 minutes", limit=1, watermark="5 minutes")
         .writeStream.format("memory").queryName("late_rl").outputMode("append")
         .option("checkpointLocation", K.scratch_path(spark, "ckpt-late")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = [(r.window_start, r.requests) for r in spark.table("late_rl").collect()]
    # the 12:00 window was emitted once, before the late rows came, and they did not reopen it
    assert [n for w, n in rows if w == t0] == [2]
    # counted at the state operator, after partial aggregation merged the two late rows
    assert SP.late_rows(q) >= 1


def test_container_log_stream_equals_batch(spark):
    import os

    from skylight.sources import containers as C
    src = K.scratch_path(spark, "stream-container-logs")
    t = "2024-01-01T00:00:00Z"
    files = {
        # equal times: only the line order tells which fragments belong together
        "p1_ns_main-0a.log": [f"{t} stdout P a", f"{t} stdout F b", f"{t} stderr F e", f"{t} stdout P c", f"{t} stdout F d", "no format"],
        "p2_ns_main-0b.log": ['{"log":"whole\\n","stream":"stdout","time":"2024-01-02T00:00:00.5Z"}', '{"message":"no stream"}',
                              "2024-01-02T00:00:01+02:00 stdout P open"],
    }
    os.makedirs(src)
    for name, lines in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    pods = spark.createDataFrame([("p1", "ns", "n", "pr", "e", "c")],
                                 "pod string, pod_namespace string, namespace string, project_uid string, environment_uid string, component_uid string")
    sink, rejects = K.scratch_path(spark, "stream-container-sink"), K.scratch_path(spark, "stream-container-rejects")
    SP.container_log_stream(spark, src, sink, pods, K.scratch_path(spark, "ckpt-container"), max_files_per_trigger=1).awaitTermination()
    SP.rejected_log_stream(spark, src, rejects, K.scratch_path(spark, "ckpt-rejects")).awaitTermination()
    got = spark.read.parquet(sink)
    found = sorted((r.pod, r.stream, r.log, r.component_uid) for r in got.collect())
    assert found == [("p1", "stderr", "e", "c"), ("p1", "stdout", "ab", "c"), ("p1", "stdout", "cd", "c"), ("p2", "stdout", "whole", None)]
    batch = C.read_container_logs(spark, src)
    decoded = C.decode_container_lines(batch).filter("complete")
    same = ["stream", "ts", "log"]
    s = got.select("stream", F.col("ts").cast("timestamp_ntz").alias("ts"), "log")
    assert s.exceptAll(decoded.select(same)).count() == 0 and decoded.select(same).exceptAll(s).count() == 0
    want = sorted(r.value for r in C.rejected_container_lines(batch).collect())
    assert sorted(r.value for r in spark.read.parquet(rejects).collect()) == want == ["no format", '{"message":"no stream"}']


def test_fragments_survive_micro_batches(spark):
    import time
    src = K.scratch_path(spark, "stream-fragments")
    schema = "file string, value string, block_start long"
    t = "2024-01-01T00:00:0%dZ stdout %s %s"
    for i, lines in enumerate([[(1, "F", "x"), (2, "P", "one ")], [(3, "P", "two ")], [(3, "F", "three"), (4, "F", "y")]]):
        spark.createDataFrame([("f", t % x, 100 * i) for x in lines], schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = SP.run_to_memory(SP.decode_stream(stream), "fragments").collect()
    assert sorted((r.log, r.ts.second, r.complete) for r in got) == [("one two three", 3, True), ("x", 1, True), ("y", 4, True)]


def test_open_fragments_time_out():
    import pandas as pd

    class State:
        exists, hasTimedOut, wait, get = False, False, None, None

        def update(self, v):
            self.exists, self.get = True, v

        def remove(self):
            self.exists, self.get = False, None

        def setTimeoutDuration(self, ms):
            self.wait = ms

    fn, state = SP._stitch_fn(60), State()
    t = pd.Timestamp("2024-01-01")
    lines = pd.DataFrame({"ts": [t, t], "flag": ["P", "P"], "msg": ["b", "a"], "block_start": [0, 0], "line_no": [2, 1]})
    assert list(fn(("f", "stdout"), iter([lines[:1], lines[1:]]), state)) == [] and state.get[0] == "ab" and state.wait == 60000
    state.hasTimedOut = True
    out = pd.concat(list(fn(("f", "stdout"), iter([]), state)))
    assert out.values.tolist() == [["f", "stdout", t, "ab", False]] and not state.exists


def test_windowed_increase_stream_equals_batch(spark):
    v = Views(spark, SF_CHECK)
    keys = ["pod", "container"]
    samples = SP.to_event_time(v.cpu_samples().select(*keys, "ts", "value"))
    stream = _as_stream(spark, samples.coalesce(1), "stream-increase")
    got = SP.run_to_memory(SP.windowed_increase_stream(stream, keys, "1 day", "100 days"), "increase", mode="complete")
    want = {}
    for r in samples.collect():
        day = r.event_time.replace(hour=0, minute=0, second=0, microsecond=0)
        want.setdefault((r.pod, r.container, day), []).append((r.event_time, r.value))
    rows = got.collect()
    assert len(rows) == len(want) > 0
    for r in rows:
        pts = sorted(want[(r.pod, r.container, r.window_start)])
        assert r.samples == len(pts) and abs(r.increase - (pts[-1][1] - pts[0][1])) < 1e-9


def test_first_epoch_without_files_is_no_progress(spark):
    import os
    path = K.scratch_path(spark, "progress-empty")
    assert SP._progress(spark, path, 0, "bigint") is None
    os.makedirs(os.path.join(path, "epoch=0"))
    assert SP._progress(spark, path, 1, "bigint") is None
    spark.createDataFrame([(7,)], "upto bigint").write.parquet(f"{path}/epoch=1")
    assert SP._progress(spark, path, 1, "bigint") is None and SP._progress(spark, path, 2, "bigint") == 7
