"""Structured Streaming twins of the batch operators.

* ``container_log_stream`` - S1 -> S2 -> I1 -> S3: new log files are read
  as they appear, CRI fragments are stitched in line order with
  per-(file, stream) state (``applyInPandasWithState``: open fragments survive
  micro-batch ends and time out when their file goes quiet),
  lines are enriched with the pod dimension and appended to the
  day-partitioned store; the checkpoint replaces the shipper's offset DB.
* ``rejected_log_stream`` - lines that S2 cannot decode, whole, in a sink of
  their own.
* ``sliding_log_counts`` - the A1 window as ``withWatermark`` + sliding
  ``window()``.  Buckets are half-open and empty ones are not emitted, so
  rules that fire on low counts use the batch form in ``foreachBatch``.
* ``trace_sessions`` - trace roll-up once a trace has been quiet for the
  completion wait: ``session_window`` per trace id.
* ``throttled_notifications`` - A7 with per-rule state.
* ``pending_stream`` - A6 (``for``) with per-key island state.
* ``alert_ticks_each_batch`` - the A1 batch form inside ``foreachBatch``:
  zero-count ticks and every comparison operator, idempotent per epoch.
* ``tail_sample_each_batch`` - I9 per micro-batch: decision buckets are
  decided once their decision time has passed, idempotent per epoch.
* ``windowed_increase_stream`` - dashboard counters per tumbling step.
* ``dedupe_stream`` - S4 with ``dropDuplicatesWithinWatermark``.
* ``rate_limit_stream`` - G2 fixed windows, append mode.

Every query takes its checkpoint folder from the caller; by default it is a
folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from skylight.functions.timeutil import rfc3339
from skylight.sources.containers import CRI_RE, _docker, file_metadata, read_container_logs, rejected_container_lines
from skylight.sources.sinks import scratch_path


def to_event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (the test parquet holds TIMESTAMP_NTZ);
    the session time zone is UTC, so the instant is unchanged."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


# --- S1 -> S2 -> I1 -> S3 ---------------------------------------------------------

_FRAGMENT_OUT = "file string, stream string, ts timestamp, log string, complete boolean"
_FRAGMENT_STATE = "pending string, last_ts timestamp"
_FRAGMENT_COLS = ["file", "stream", "ts", "log", "complete"]
DEFAULT_FRAGMENT_WAIT_S = 3600


def _stitch_fn(wait_s: float | None):
    """Join ``P`` fragments to their closing ``F`` line, in line order. An
    unfinished message stays in the group state until a later micro-batch
    closes it; after ``wait_s`` without a new line (a rotated or removed file)
    it is emitted as it is, marked incomplete, and the state is freed."""

    def fn(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            pending, last_ts = state.get
            state.remove()
            yield pd.DataFrame([(key[0], key[1], last_ts, pending, False)], columns=_FRAGMENT_COLS)
            return
        # one file's new lines: chunks come unordered, so they are put together first
        lines = pd.concat(list(batches)).sort_values(["block_start", "line_no"], kind="stable")
        open_parts, last_ts = ([state.get[0]], state.get[1]) if state.exists else ([], None)
        rows = []
        for ts, flag, msg in zip(lines["ts"], lines["flag"], lines["msg"]):
            open_parts.append(msg)
            last_ts = None if pd.isna(ts) else ts
            if flag == "F":
                rows.append((key[0], key[1], last_ts, "".join(open_parts), True))
                open_parts, last_ts = [], None
        if open_parts:
            state.update(("".join(open_parts), last_ts))
            if wait_s is not None:
                state.setTimeoutDuration(int(wait_s * 1000))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=_FRAGMENT_COLS)
    return fn


def _number_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number a task's lines in the order they are read (streams have no
    ``monotonically_increasing_id``)."""
    seen = 0
    for b in batches:
        numbers = pa.array(range(seen, seen + b.num_rows), pa.int64())
        seen += b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, numbers], names=[*b.schema.names, "line_no"])


def decode_stream(lines: DataFrame, fragment_wait_s: float | None = None) -> DataFrame:
    """Streaming S2 for CRI and docker JSON lines; other lines are the rows of
    ``rejected_container_lines``, which works on the same stream. A file's
    lines keep their order by split offset and position, whatever their times.
    ``fragment_wait_s`` is for streams that keep running: with it, a query has
    always another batch to look for timeouts, so ``availableNow`` never ends."""
    v = F.col("value")
    j, is_json = _docker(v)
    numbered = lines.select("file", "value", "block_start").mapInArrow(
        _number_lines, "file string, value string, block_start bigint, line_no bigint")
    parsed = numbered.select(
        "file",
        F.when(is_json, j["stream"]).otherwise(F.regexp_extract(v, CRI_RE, 2)).alias("stream"),
        F.when(is_json, F.lit("F")).otherwise(F.regexp_extract(v, CRI_RE, 3)).alias("flag"),
        F.when(is_json, F.regexp_replace(j["log"], "\n$", "")).otherwise(F.regexp_extract(v, CRI_RE, 4)).alias("msg"),
        rfc3339(F.when(is_json, j["time"]).otherwise(F.regexp_extract(v, CRI_RE, 1))).cast("timestamp").alias("ts"),
        "block_start", "line_no",
    ).filter(F.col("stream") != "")
    return parsed.groupBy("file", "stream").applyInPandasWithState(
        _stitch_fn(fragment_wait_s), _FRAGMENT_OUT, _FRAGMENT_STATE, "append",
        GroupStateTimeout.NoTimeout if fragment_wait_s is None else GroupStateTimeout.ProcessingTimeTimeout)


def container_log_stream(spark: SparkSession, source: str, sink: str, pods: DataFrame,
                         checkpoint: str | None = None, glob: str = "*.log", trigger_once: bool = True,
                         max_files_per_trigger: int = 1000, fragment_wait_s: float = DEFAULT_FRAGMENT_WAIT_S):
    """Start S1 -> S2 -> I1 -> S3 and return the StreamingQuery. Open fragments
    time out in streams that keep running (``trigger_once=False``) only."""
    raw = read_container_logs(spark, source, stream=True, glob=glob, max_files_per_trigger=max_files_per_trigger)
    decoded = file_metadata(decode_stream(raw, None if trigger_once else fragment_wait_s))
    dim = (pods.select("pod", "pod_namespace", "namespace", "project_uid",
                                         "environment_uid", "component_uid"))
    enriched = decoded.join(dim, ["pod", "pod_namespace"], "left").withColumn(
        "log_date", F.to_date("ts"))
    w = (enriched.writeStream.format("parquet").option("path", sink).partitionBy("log_date")
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-container-logs"))
         .outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()


def rejected_log_stream(spark: SparkSession, source: str, sink: str, checkpoint: str | None = None,
                        glob: str = "*.log"):
    """Start the stream of undecodable lines (whole, with a reason) into its own
    sink and return the StreamingQuery."""
    raw = read_container_logs(spark, source, stream=True, glob=glob)
    rejects = rejected_container_lines(raw).select("file", "value", "reason")
    return (rejects.writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-container-rejects"))
            .outputMode("append").trigger(availableNow=True).start())


def _progress(spark: SparkSession, path: str, epoch_id: int, upto_type: str):
    """How far earlier epochs got; None before the first. Any failure to read
    an existing file fails the batch, which is then retried."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return None
    # a stated schema: a first epoch that failed while writing leaves a folder without files
    marks = spark.read.schema(f"upto {upto_type}, epoch bigint").parquet(path)
    return marks.filter(F.col("epoch") < epoch_id).agg(F.max("upto")).first()[0]


# --- A1 sliding window ------------------------------------------------------------

def sliding_log_counts(logs: DataFrame, rules: DataFrame, window_s: int, slide_s: int,
                       watermark: str = "10 minutes") -> DataFrame:
    """Per rule and sliding window: matching lines (half-open windows, no
    empty ones).  ``logs`` is a stream with ``event_time`` (TIMESTAMP)."""
    r = (rules.filter("enabled").select(
        "rule_name", F.col("component_uid").alias("r_c"), F.col("environment_uid").alias("r_e"),
        F.col("project_uid").alias("r_p"), "phrase"))
    j = logs.withWatermark("event_time", watermark).join(
        r, (F.col("component_uid") == F.col("r_c")) & (F.col("environment_uid") == F.col("r_e"))
        & (F.col("project_uid") == F.col("r_p")) & F.col("log").contains(F.col("phrase")), "inner")
    g = j.groupBy("rule_name", F.window("event_time", f"{window_s} seconds", f"{slide_s} seconds").alias("w"))
    return g.agg(F.count(F.lit(1)).alias("n")).select(
        "rule_name", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


# --- T1 trace sessions ---------------------------------------------------------

def trace_sessions(spans: DataFrame, gap: str = "10 seconds", watermark: str = "1 minute") -> DataFrame:
    """Trace roll-up emitted once no span arrived for ``gap``: span count,
    bounds and error flag per (trace, session).  ``spans`` needs
    ``event_time`` (TIMESTAMP)."""
    s = spans.withWatermark("event_time", watermark)
    g = s.groupBy("trace_id", F.session_window("event_time", gap).alias("sess"))
    return g.agg(F.count(F.lit(1)).alias("span_count"), F.min("start_ns").alias("start_ns"),
                 F.max("end_ns").alias("end_ns"),
                 F.max((F.lower(F.col("status_code")) == "error").cast("int")).alias("errors")).select(
        "trace_id", F.col("sess.start").alias("session_start"), F.col("sess.end").alias("session_end"),
        "span_count", "start_ns", "end_ns", F.coalesce(F.col("errors") > 0, F.lit(False)).alias("has_errors"))


# --- A7 throttle with state ------------------------------------------------------

_THROTTLE_OUT = "rule_name string, tick timestamp"
_THROTTLE_STATE = "last_sent timestamp"


def _throttle_fn(gap_s: float):
    gap = pd.Timedelta(seconds=gap_s)

    def fn(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        sent = []
        for pdf in batches:
            for t in sorted(pdf["tick"]):
                if last is None or t >= last + gap:
                    sent.append((key[0], t))
                    last = t
        if last is not None:
            state.update((last,))
        if sent:
            yield pd.DataFrame(sent, columns=["rule_name", "tick"])
    return fn


def throttled_notifications(firing: DataFrame, every_s: float = 3600) -> DataFrame:
    """A7 on a stream of firing ticks ``(rule_name, tick TIMESTAMP)``: the
    last sent time per rule is the state; ticks are assumed to arrive in
    time order per rule (late ticks older than the last sent are dropped)."""
    return firing.groupBy("rule_name").applyInPandasWithState(
        _throttle_fn(every_s), _THROTTLE_OUT, _THROTTLE_STATE, "append", GroupStateTimeout.NoTimeout)


# --- A6 pending with state ---------------------------------------------------------

_PENDING_STATE = "island_start timestamp, last_ts timestamp"


def _pending_fn(key_cols, ts_col: str, for_s: float, out_cols):
    hold = pd.Timedelta(seconds=for_s)

    def fn(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        island, last = (state.get if state.exists else (None, None))
        rows = []
        for pdf in batches:
            pdf = pdf.sort_values(ts_col, kind="stable")
            for ts, c in zip(pdf[ts_col], pdf["__cond"]):
                if last is not None and ts <= last:
                    continue  # out of order for this key: already decided
                last = ts
                if c:
                    island = ts if island is None else island
                    rows.append((*key, ts, island, bool(ts - island >= hold)))
                else:
                    island = None
                    rows.append((*key, ts, None, False))
        state.update((island, last))
        if rows:
            yield pd.DataFrame(rows, columns=out_cols)
    return fn


def pending_stream(evals: DataFrame, key_cols, ts_col: str, cond, for_s: float) -> DataFrame:
    """A6 on a stream of evaluations: per key, the start of the current run
    of true conditions is the state; an evaluation fires once the run has
    lasted ``for_s``.  Evaluations must arrive in time order per key."""
    key_cols = list(key_cols)
    out_cols = key_cols + [ts_col, "island_start", "firing"]
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in evals.schema.fields if f.name in key_cols)
    schema = f"{key_schema}, {ts_col} timestamp, island_start timestamp, firing boolean"
    d = evals.select(*key_cols, F.col(ts_col).cast("timestamp").alias(ts_col), F.coalesce(cond, F.lit(False)).alias("__cond"))
    return d.groupBy(*key_cols).applyInPandasWithState(
        _pending_fn(key_cols, ts_col, for_s, out_cols), schema, _PENDING_STATE, "append", GroupStateTimeout.NoTimeout)


# --- A1 batch form per micro-batch -------------------------------------------------

def alert_ticks_each_batch(rules: DataFrame, store: str, sink: str, anchor, lateness_s: float = 0,
                           store_day_col: str = "log_date"):
    """A ``foreachBatch`` function: append the micro-batch of log lines to the
    day-partitioned store, then evaluate every tick that became final since
    the last batch (ticks up to the newest line time minus ``lateness_s``)
    with the batch operator over the whole store, zero counts included.

    Both writes are keyed by the epoch id and overwrite that epoch, so a
    re-run of a failed epoch does not duplicate; ``latest_alert_ticks``
    reads the result.  Progress (the last evaluated time) is a one-row file
    per epoch next to the sink.
    """
    import datetime as _dt

    from skylight.operators.alerts import log_alert_ticks
    from skylight.functions.timeutil import parse_ts

    anchor_dt = parse_ts(anchor)
    progress = sink.rstrip("/") + "_progress"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        hi = batch.agg(F.max("ts")).first()[0]
        if hi is None:
            return
        (batch.withColumn(store_day_col, F.col("ts").cast("date")).write.mode("overwrite")
         .partitionBy(store_day_col).parquet(f"{store}/epoch={epoch_id}"))
        done = _progress(spark, progress, epoch_id, "timestamp_ntz")
        start = (done + _dt.timedelta(microseconds=1)) if done is not None else anchor_dt
        upto = (hi if not isinstance(hi, str) else parse_ts(hi)) - _dt.timedelta(seconds=lateness_s)
        if upto >= start:
            lines = spark.read.parquet(store).drop("epoch")
            ticks = log_alert_ticks(lines, rules, start, upto, anchor=anchor_dt)
            ticks.write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")
            mark = upto
        else:
            mark = done
        if mark is not None:
            spark.createDataFrame([(mark,)], "upto timestamp_ntz").write.mode(
                "overwrite").parquet(f"{progress}/epoch={epoch_id}")
    return run


def latest_alert_ticks(spark: SparkSession, sink: str) -> DataFrame:
    """The newest evaluation of each (rule, tick) written by ``alert_ticks_each_batch``."""
    t = spark.read.parquet(sink)
    latest = t.groupBy("rule_name", "tick").agg(F.max_by(F.struct("n", "firing"), "epoch").alias("v"))
    return latest.select("rule_name", "tick", F.col("v.n").alias("n"), F.col("v.firing").alias("firing"))


# --- I9 per micro-batch ---------------------------------------------------------------

def tail_sample_each_batch(store: str, sink: str, wait_s: float = 10, limit: int = 10, bucket_s: float = 1,
                           trace_col: str = "trace_id", ts_col: str = "start_ts", max_trace_s: float | None = 86400):
    """A ``foreachBatch`` function: append the micro-batch's spans to a span
    store, then decide every decision bucket whose end has passed the newest
    span time (spans of a trace are assumed to arrive within ``wait_s`` of
    its first span, as the collector assumes) and that no earlier epoch
    decided.  Writes are keyed by epoch and overwrite it, so a re-run epoch
    does not duplicate.

    The store is partitioned by span day, and a batch reads only the days from
    its first open bucket less ``wait_s`` and ``max_trace_s``. A trace open for
    longer than ``max_trace_s`` counts as a new one when it goes on (like a
    watermark); None reads the whole store and has no such bound.
    """
    import datetime as _dt

    from skylight.operators.ingest import tail_sample
    progress = sink.rstrip("/") + "_progress"
    b_us = int(bucket_s * 1_000_000)
    epoch_0 = _dt.datetime(1970, 1, 1)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        hi = batch.agg(F.max(ts_col)).first()[0]
        if hi is None:
            return
        (batch.select(trace_col, ts_col, F.col(ts_col).cast("date").alias("span_day"))
         .write.mode("overwrite").partitionBy("span_day").parquet(f"{store}/epoch={epoch_id}"))
        hi_us = (hi - epoch_0) // _dt.timedelta(microseconds=1)
        final = hi_us // b_us - 1          # buckets wholly before the newest span time
        done = _progress(spark, progress, epoch_id, "bigint")
        lo = None if done is None else done + 1
        if lo is None or final >= lo:
            spans = spark.read.parquet(store).filter(F.col("epoch") <= epoch_id)
            if lo is not None and max_trace_s is not None:
                oldest = epoch_0 + _dt.timedelta(microseconds=lo * b_us, seconds=-(wait_s + max_trace_s))
                spans = spans.filter(F.col("span_day") >= F.lit(oldest.date()))
            kept = tail_sample(spans.select(trace_col, ts_col), wait_s, limit, bucket_s, trace_col, ts_col,
                               buckets=(lo, final))
            kept.write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")
            mark = final
        else:
            mark = done
        if mark is not None:
            spark.createDataFrame([(int(mark),)], "upto bigint").write.mode("overwrite").parquet(
                f"{progress}/epoch={epoch_id}")
    return run


# --- dashboards ----------------------------------------------------------------------

def windowed_increase_stream(samples: DataFrame, keys, step: str = "5 minutes", watermark: str = "10 minutes",
                             value_col: str = "value") -> DataFrame:
    """Counter increase per series and tumbling step (last - first sample in
    the window), emitted when the window closes.  Resets and extrapolation
    need neighbouring windows; the batch ``rate`` is the exact form."""
    keys = list(keys)
    g = samples.withWatermark("event_time", watermark).groupBy(*keys, F.window("event_time", step).alias("w"))
    out = g.agg(F.count(F.lit(1)).alias("samples"),
                F.min_by(value_col, "event_time").alias("first_value"),
                F.max_by(value_col, "event_time").alias("last_value"))
    return out.select(*keys, F.col("w.start").alias("window_start"), "samples",
                      (F.col("last_value") - F.col("first_value")).alias("increase"))


def late_rows(query) -> int:
    """Rows dropped by watermarks so far, from the query's progress reports."""
    total = 0
    for p in query.recentProgress or []:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else getattr(p, "stateOperators", []):
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else getattr(op, "numRowsDroppedByWatermark", 0)
            total += int(v or 0)
    return total


# --- S4 / G2 -----------------------------------------------------------------------

def dedupe_stream(df: DataFrame, id_col: str = "doc_id", watermark: str = "1 hour") -> DataFrame:
    """S4 on a stream: retried records within the watermark are dropped."""
    return df.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark([id_col])


def rate_limit_stream(df: DataFrame, key_col: str, unit: str = "1 minute", limit: int = 60,
                      watermark: str = "1 minute") -> DataFrame:
    """G2 on a stream: per key and fixed window, emitted when the window closes."""
    g = df.withWatermark("event_time", watermark).groupBy(key_col, F.window("event_time", unit).alias("w"))
    out = g.agg(F.count(F.lit(1)).alias("requests"))
    return out.select(key_col, F.col("w.start").alias("window_start"), "requests",
                      F.least(F.col("requests"), F.lit(limit).cast("bigint")).alias("allowed"),
                      F.greatest(F.col("requests") - F.lit(limit).cast("bigint"), F.lit(0).cast("bigint"))
                      .alias("rejected"))


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None):
    """Drive a streaming DataFrame to completion into a memory table (tests
    and smoke runs); returns the table as a batch DataFrame."""
    spark = df.sparkSession
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)
