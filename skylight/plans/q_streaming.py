"""Registered streaming queries and the sources and sinks that
streams need: each runs a stream over files derived from the given tables to
its end (``availableNow``) and returns what the sink holds.

The files are mixed in time; a watermark of the tables' whole span keeps every
row, and a last file with one row far ahead closes all windows and timers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylight.functions.scope import Scope
from skylight.operators import alerts as A
from skylight.operators import trace_sketches as TS
from skylight.operators import traces as T
from skylight.plans import params as P
from skylight.plans.q_alerts import FOR_S, THROTTLE_S, _throttle_sql, _ticks_sql
from skylight.plans.q_ingest import LOG_COLS, TAIL_SQL
from skylight.plans.q_metrics import CONTAINER, GRID, GRID_CTE, RANGE, rate_sql
from skylight.plans.registry import register
from skylight.sources import commits as C
from skylight.sources import sinks as K
from skylight.sources.fixtures import Views
from skylight.functions.numeric import round6
from skylight.sources.otlp import decode_otlp, otlp_rejects
from skylight.streaming import alert_state as S
from skylight.streaming import pipelines as SP
from skylight.streaming import rates as R
from skylight.streaming.tail_state import tail_sample_stream

SPAN = "400 days"
_AHEAD = "TIMESTAMP '2030-01-01 00:00:00'"


def _stream(df: DataFrame, name: str, last: DataFrame | None = None, files: int = 6) -> DataFrame:
    """``df`` as a stream of files, two a batch; ``last`` comes in later ones."""
    spark = df.sparkSession
    path = K.scratch_path(spark, name)
    df.repartition(files).write.parquet(path)
    if last is not None:
        for _ in range(2):
            last.select(*df.columns).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def _drained(df: DataFrame, name: str) -> DataFrame:
    """The rows that the stream has put into its sink at its end. A state
    partition costs a Python worker per micro-batch, with rows or without, so
    there are no more of them than cores."""
    spark = df.sparkSession
    out = K.scratch_path(spark, name)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", min(int(parts), max(1, spark.sparkContext.defaultParallelism)))
    try:  # a query keeps the settings of its start
        query = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", K.scratch_path(spark, f"ckpt-{name}"))
                 .trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@register("stream_alert_pending", oracle="""
WITH e AS (SELECT user_id, ts, value > 20 AS c FROM events),
m AS (SELECT *, max(CASE WHEN NOT c THEN ts END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_false FROM e),
s AS (SELECT *, min(CASE WHEN c THEN ts END) OVER (PARTITION BY user_id, last_false) AS island_start FROM m)
SELECT user_id, ts, island_start FROM s WHERE c AND epoch_us(ts) - epoch_us(island_start) >= 86400000000""")
def stream_alert_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Views(spark, sf_dir).events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("value") > 20).alias("c"))
    last = spark.range(1).select(F.lit(-1).cast(ev.schema["user_id"].dataType).alias("user_id"), F.expr(_AHEAD).alias("ts"), F.lit(False).alias("c"))
    stream = _stream(ev, "pending-src", last)
    got = _drained(S.pending_ordered(stream, ["user_id"], "ts", F.col("c"), FOR_S, SPAN, forget_s=366 * 86400), "pending")
    return got.filter("firing AND user_id >= 0").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                                                        F.col("island_start").cast("timestamp_ntz").alias("island_start"))


@register("stream_alert_throttled", oracle=f"""
WITH RECURSIVE {_ticks_sql('search')}, f AS (SELECT rule_name, tick FROM a1 WHERE firing),
{_throttle_sql('f', 'rule_name', 'tick', THROTTLE_S * 1_000_000)}
SELECT rule_name, tick FROM sent""")
def stream_alert_throttled(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = Views(spark, sf_dir)
    ticks = (A.log_alert_ticks(v.logs(), v.rules(), P.ALERT_START, P.ALERT_END, store="search").filter("firing")
             .select("rule_name", F.col("tick").cast("timestamp").alias("tick")))
    last = spark.range(1).select(F.lit("").alias("rule_name"), F.expr(_AHEAD).alias("tick"))
    got = _drained(S.throttle_ordered(_stream(ticks, "throttle-src", last), every_s=THROTTLE_S, lateness=SPAN, forget_s=366 * 86400), "throttle")
    return got.filter("rule_name <> ''").select("rule_name", F.col("tick").cast("timestamp_ntz").alias("tick"))


@register("stream_rate_limits", oracle="""
SELECT event_type, window_start, requests, least(requests, 3) AS allowed, greatest(requests - 3, 0) AS rejected
FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests
      FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)) g""")
def stream_rate_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = SP.to_event_time(Views(spark, sf_dir).events.select("event_type", "ts")).drop("ts")
    last = spark.range(1).select(F.lit("").alias("event_type"), F.expr(_AHEAD).alias("event_time"))
    got = _drained(SP.rate_limit_stream(_stream(ev, "limits-src", last), "event_type", "1 hour", 3, SPAN), "limits")
    return got.filter("event_type <> ''").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_ingest_once", oracle=f"SELECT {LOG_COLS} FROM logs")
def stream_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 on a stream: a second run that has lost its checkpoint, and with
    it its place, adds nothing."""
    lg = K.with_doc_id(Views(spark, sf_dir).logs().select(*LOG_COLS.split(", ")))
    base = K.scratch_path(spark, "ingest-once")
    src = _stream(lg, "ingest-src")
    for _ in range(2):
        (src.writeStream.foreachBatch(C.each_batch_once(base, id_col="doc_id")).trigger(availableNow=True)
         .option("checkpointLocation", K.scratch_path(spark, "ckpt-ingest")).start().awaitTermination())
    return C.read_committed(spark, base, lg.schema).select(*LOG_COLS.split(", "))


@register("sink_retry_once", oracle=f"SELECT {LOG_COLS} FROM logs WHERE log_date >= DATE '2024-01-05'")
def sink_retry_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch written twice, then a larger one that repeats it, compacted and
    read by day."""
    lg = K.with_doc_id(Views(spark, sf_dir).logs().select(*LOG_COLS.split(", ")))
    base = K.scratch_path(spark, "retry-once")
    first = lg.filter("event_id % 3 = 0")
    C.append_once(first, base, id_col="doc_id")
    C.append_once(first, base, id_col="doc_id")
    C.append_once(lg, base, batch="late", id_col="doc_id")
    C.compact(spark, base, lg.schema)
    C.append_once(lg, base, batch="later still", id_col="doc_id")
    days = sorted({d for m in C.manifests(spark, base).values() for d in m["days"] if d >= "2024-01-05"})
    return C.read_committed(spark, base, lg.schema, days=days).select(*LOG_COLS.split(", "))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OTLP/JSON export requests of the fixture's spans: one per pod, day and
    thousand event ids; every 50th span has a trace id that is none."""
    def attr(key: str, kind: str, value):
        kinds = ["stringValue", "intValue", "boolValue"]
        return F.struct(F.lit(key).alias("key"), F.struct(*[(value if k == kind else F.lit(None).cast("string")).alias(k) for k in kinds]).alias("value"))

    s = Views(spark, sf_dir).spans()
    parent = F.when(F.coalesce("parent_span_id", F.lit("")) != "", F.left(F.md5("parent_span_id"), F.lit(16)))
    one = F.struct(
        F.when(F.col("event_id") % 50 == 0, "bad").otherwise(F.md5("trace_id")).alias("traceId"), F.left(F.md5("span_id"), F.lit(16)).alias("spanId"),
        parent.alias("parentSpanId"), "name", F.concat(F.lit("SPAN_KIND_"), F.col("kind")).alias("kind"),
        F.col("start_ns").cast("string").alias("startTimeUnixNano"), F.col("end_ns").cast("string").alias("endTimeUnixNano"),
        F.array(attr("event.id", "intValue", F.col("event_id").cast("string")), attr("user", "boolValue", F.lit("true")),
                attr("env", "stringValue", F.col("environment_uid"))).alias("attributes"),
        F.struct(F.when(F.col("status_code") == "OK", 1).when(F.col("status_code") == "Error", 2).alias("code")).alias("status"))
    resource = F.struct(F.array(attr("k8s.pod.name", "stringValue", F.col("pod")), attr("component", "stringValue", F.col("component_uid"))).alias("attributes"))
    g = (s.select("span_date", (F.col("event_id") / 1000).cast("bigint").alias("block"), "pod", resource.alias("resource"), one.alias("span"))
         .groupBy("span_date", "block", "pod").agg(F.first("resource").alias("resource"), F.collect_list("span").alias("spans")))
    scope = F.struct(F.struct(F.lit("fixture").alias("name")).alias("scope"), F.col("spans"))
    return g.select(F.to_json(F.struct(F.array(F.struct("resource", F.array(scope).alias("scopeSpans"))).alias("resourceSpans"))).alias("payload"))


@register("otlp_spans_decoded", oracle="""
SELECT md5(trace_id) AS trace_id, left(md5(span_id), 16) AS span_id,
  CASE WHEN coalesce(parent_span_id, '') <> '' THEN left(md5(parent_span_id), 16) ELSE '' END AS parent_span_id, name, kind, start_ts, start_ns, end_ns,
  status_code, pod, component_uid, 'fixture' AS scope_name, CAST(event_id AS VARCHAR) AS event_id, 'bool' AS user_type, environment_uid AS env
FROM spans WHERE event_id % 50 <> 0""")
def otlp_spans_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_otlp(_payloads(spark, sf_dir))
    return d.select("trace_id", "span_id", "parent_span_id", "name", "kind", "start_ts", "start_ns", "end_ns", "status_code",
                    F.col("resource_attributes")["k8s.pod.name"].alias("pod"), F.col("resource_attributes")["component"].alias("component_uid"),
                    "scope_name", F.col("attributes")["event.id"].alias("event_id"), F.col("attribute_types")["user"].alias("user_type"),
                    F.col("attributes")["env"].alias("env"))


@register("otlp_spans_rejected", oracle="""
SELECT 'bad trace id' AS reason, left(md5(span_id), 16) AS span_id FROM spans WHERE event_id % 50 = 0""")
def otlp_spans_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return otlp_rejects(_payloads(spark, sf_dir)).select("reason", F.get_json_object("raw", "$.spanId").alias("span_id"))


@register("trace_total_sketched", oracle=f"""
SELECT namespace, count(DISTINCT trace_id) AS exact_total, true AS within_bound FROM spans
WHERE start_ts >= TIMESTAMP '{P.TRACE_START}' + INTERVAL 5 HOUR AND start_ts < TIMESTAMP '{P.TRACE_END}' + INTERVAL 7 HOUR GROUP BY namespace""")
def trace_total_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate total from stored sketches beside the exact one: the
    oracle states that it lies within the documented bound."""
    spans = Views(spark, sf_dir).spans()
    path = K.scratch_path(spark, "trace-sketches")
    TS.write_trace_sketches(spans.filter("event_id % 3 > 0"), path)
    TS.write_trace_sketches(spans.filter("event_id % 2 = 0"), path)  # late spans, some for the second time
    TS.write_trace_sketches(spans.filter("event_id % 6 = 3"), path)
    stored = spark.read.parquet(path)
    start, end = P.TRACE_START.replace("00:00:00", "05:00:00"), P.TRACE_END.replace("00:00:00", "07:00:00")
    out = None
    for ns in ("ns-0", "ns-1", "ns-2"):
        scope = Scope(ns)
        one = (TS.approximate_trace_total(stored, spans, scope, start, end)
               .unionByName(T.trace_total_exact(spans, scope, start, end).withColumnRenamed("total", "exact_total"), allowMissingColumns=True)
               .agg(F.max("total").alias("total"), F.max("exact_total").alias("exact_total")))
        one = one.select(F.lit(ns).alias("namespace"), "exact_total", (F.abs(F.col("total") - F.col("exact_total")) <= F.col("exact_total") * TS.BOUND + 1).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@register("stream_metric_rate", oracle=f"""
WITH {GRID_CTE}
SELECT pod, pod_namespace, container, ts, round((value) + 1e-9, 6) AS value FROM {rate_sql('cpu_samples', CONTAINER)} r""")
def stream_metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """St6: the batch rate's rows from a stream mixed in time."""
    cpu = Views(spark, sf_dir).cpu_samples().select(*CONTAINER, F.col("ts").cast("timestamp").alias("ts"), "value")
    last = spark.range(1).select(*[F.lit("").alias(c) for c in CONTAINER], F.expr(_AHEAD).alias("ts"), F.lit(0.0).alias("value"))
    got = _drained(R.rate_stream(_stream(cpu, "rate-src", last), CONTAINER, P.GRID_START, P.GRID_STEP_S, RANGE, lateness=SPAN), "rate")
    inside = F.col("ts").cast("timestamp_ntz").between(F.lit(P.GRID_START).cast("timestamp_ntz"), F.lit(P.GRID_END).cast("timestamp_ntz"))
    return got.filter(inside).select(*CONTAINER, F.col("ts").cast("timestamp_ntz").alias("ts"), round6("value").alias("value"))


@register("stream_tail_sampled", oracle=TAIL_SQL)
def stream_tail_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I9 in keyed state: the batch rule's traces from a stream mixed in time."""
    spans = Views(spark, sf_dir).spans().select("trace_id", F.col("start_ts").cast("timestamp").alias("start_ts"))
    last = spark.range(1).select(F.lit("").alias("trace_id"), F.expr(_AHEAD).alias("start_ts"))
    got = _drained(tail_sample_stream(_stream(spans, "tail-src", last), wait_s=10, limit=20, bucket_s=86400,
                                      max_trace_s=366 * 86400, lateness=SPAN), "tail")
    return got.filter("trace_id <> ''").withColumn("decision_ts", F.col("decision_ts").cast("timestamp_ntz"))
