"""Odd inputs: timestamps, undecodable lines, webhook payloads, hot days, scoped totals."""

import glob
import os

from pyspark.sql import functions as F

from skylight import api
from skylight.functions.scope import Scope
from skylight.functions.timeutil import rfc3339
from skylight.operators import alerts as A
from skylight.operators import traces as T
from skylight.operators.governance import PII_PATTERNS, pii_mask
from skylight.plans import q_ingest as Q
from skylight.sources import containers as C
from skylight.sources import sinks as K
from skylight.sources.fixtures import Views

SF = "/root/testdata/sf0.001"


def test_rfc3339_forms(spark):
    want = {"2024-01-02T03:04:05Z": "2024-01-02 03:04:05", "2024-01-02T03:04:05.1Z": "2024-01-02 03:04:05.1",
            "2024-01-02T03:04:05.123+02:00": "2024-01-02 01:04:05.123", "2024-01-02T03:04:05.123456-05:30": "2024-01-02 08:34:05.123456",
            "2024-01-02T03:04:05.123456789Z": "2024-01-02 03:04:05.123456", "2024-01-02 03:04:05z": "2024-01-02 03:04:05",
            "2024-01-02T03:04:05": None, "2024": None, "": None, "x": None, "2024-13-02T03:04:05Z": None, None: None}
    df = spark.createDataFrame([(k,) for k in want], "s string").select("s", rfc3339("s").cast("string").alias("t"))
    assert {r["s"]: r["t"] for r in df.collect()} == want


def test_container_lines_kept_or_rejected(spark, tmp_path):
    lines = ["2024-01-02T03:04:05Z stdout F no fraction", "2024-01-02T03:04:05.5+02:00 stderr F offset", '{"a": 1}', "plain text", "",
             '{"log": "json\\n", "stream": "stdout", "time": "2024-01-02T03:04:05.123456789Z"}',
             "2024-01-02T03:04:06Z stdout F " + "x" * 100_000]
    base = tmp_path / "fluent-bit-base"
    base.mkdir()
    for name in ("my-fluentbit-ui_ns_main-0a.log", "fluent-bit-x_ns_main-0b.log"):
        (base / name).write_text("\n".join(lines) + "\n")
    raw = C.read_container_logs(spark, str(base))
    good, bad = C.decode_container_lines(raw), C.rejected_container_lines(raw)
    rows = good.collect()
    assert len(rows) == 4 and all("my-fluentbit-ui" in r["file"] for r in rows)
    assert all(r["ts"] is not None for r in rows) and max(len(r["log"]) for r in rows) == 100_000
    assert sorted(r["reason"] for r in bad.collect()) == ["JSON without log stream", "empty line", "no known line format"]
    assert [r["skipped"] for r in C.overlong_lines(raw, 32 * 1024).collect()] == [1]
    assert C.read_container_logs(spark, str(base), max_line_bytes=32 * 1024).count() == len(lines) - 1


def test_every_payload_in_one_frame(spark):
    rows = [(1, "search", '{"ruleName":"r","alertValue":3,"alertTimestamp":"2024-01-02T03:04:05.25+01:00"}', None),
            (2, "search", "not json", "unreadable body"), (3, "search", '{"ruleName":"r","alertValue":"x"}', "bad alertValue"),
            (4, "sql", '{"alertName":"a","alertCount":"x"}', "bad alertCount"), (5, "sql", '{"alertName":"a","alertCount":"3"}', None),
            (6, "metrics", '{"alerts":[]}', "no alerts"), (7, "metrics", "{", "unreadable body"), (8, "mail", "{}", "unknown shape"),
            (10, None, "{}", "unknown shape"),
            (11, "metrics", "{}", "no alerts"),
            (12, "metrics", '{"alerts":[{"status":" Firing","startsAt":"2024-01-02T03:04:05.123456789Z","annotations":'
                            '{"rule_name":"r","rule_namespace":"n","alert_value":"1.5"}}]}', None)]
    resolved = (9, "metrics", '{"alerts":[{"status":"resolved"}]}')  # skipped
    hooks = spark.createDataFrame([resolved, *(r[:3] for r in rows)], "event_id long, shape string, body string").withColumn(
        "received_at", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    ok, bad = A.normalize_webhooks(hooks)
    good = {r["event_id"]: r for r in ok.collect()}
    assert {r["event_id"]: r["reject_reason"] for r in bad.collect()} == {r[0]: r[3] for r in rows if r[3]}
    assert set(good) == {r[0] for r in rows if not r[3]}
    assert str(good[1]["alert_ts"]) == "2024-01-02 02:04:05.250000"
    assert str(good[12]["alert_ts"]) == "2024-01-02 03:04:05.123456"


def test_hot_day_is_split(spark, tmp_path):
    df = spark.range(0, 400_000, numPartitions=8).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("log"), F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("ts"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        K.write_logs(df, str(tmp_path / "s"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(glob.glob(os.path.join(str(tmp_path), "s", "log_date=2024-01-02", "*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "s")).count() == 400_000


def test_span_total_follows_the_scope(spark):
    spans = Views(spark, SF).spans()
    trace = spans.groupBy("trace_id").count().orderBy(F.desc("count"), "trace_id").first()["trace_id"]
    everything = T.span_total(spans, trace).first()[0]
    req = {"startTime": "2000-01-01T00:00:00Z", "endTime": "2100-01-01T00:00:00Z", "searchScope": {"namespace": "no-such"}}
    found = api.query_trace_spans(spans, trace, req)
    assert everything > 0 and found.rows.count() == 0 and found.total.first()[0] == 0
    assert T.span_total(spans, trace, Scope("no-such"), "2000-01-01", "2100-01-01").first()[0] == 0
    assert T.list_traces_span_page(spans, Scope("ns-1"), "2000-01-01", "2100-01-01", limit=5000, cap=None).agg(
        F.sum("span_count")).first()[0] > 1


def test_masks_run_once(spark):
    df = spark.createDataFrame([("mail a.b@c.org and 123-45-6789, card 1234 5678 1234 5678",), ("clean",), (None,)], "text string")
    out = df.select(pii_mask("text", tuple(PII_PATTERNS)).alias("t"))
    assert [r[0] for r in out.collect()] == ["mail <Email> and <Ssn>, card <CreditCard>", "clean", None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= len(PII_PATTERNS)


def test_one_text_file_per_name(spark, tmp_path):
    """tasks write the files themselves, without checksum files, a
    folder a name or a commit of all files; lines as Spark's writer has them."""
    lines = [("b.log", 0, "b0"), ("a.log", 1, "a1"), ("a.log", 0, "a0"), ("a.log", 2, None), ("c/d.log", 0, "ü"), (None, 0, "x")]
    df = spark.createDataFrame(lines, "name string, o int, value string").repartition(3, "name").sortWithinPartitions("name", "o")
    K.write_text_files(df, f"file://{tmp_path}/out", "name")
    found = {p.name: p.read_bytes().decode() for p in (tmp_path / "out").iterdir()}
    assert found == {"a.log": "a0\na1\n\n", "b.log": "b0\n", "c%2Fd.log": "ü\n", "unnamed.txt": "x\n"}
    K.write_text_files(df.filter("false"), str(tmp_path / "none"), "name")
    assert spark.read.text(str(tmp_path / "none")).count() == 0


def test_container_fixture_is_one_file_a_pod(spark, tmp_path):
    spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts, id % 40 AS user_id, "
              "'error' AS event_type, 1.0D AS value, concat('p', id) AS props FROM range(200)").write.parquet(str(tmp_path / "events.parquet"))
    path = Q._write_container_files(spark, str(tmp_path)).removeprefix("file:")
    assert sorted(os.listdir(path)) == sorted(f"pod-{u}_k8s-{u % 4}_main-0a1b2c3d.log" for u in range(40))
    rows = Q.container_logs_decoded(spark, str(tmp_path)).collect()
    assert sorted((r.pod, r.log) for r in rows) == sorted((f"pod-{i % 40}", f"ERROR upstream call failed p{i}") for i in range(200))
    assert all(r.complete for r in rows)
