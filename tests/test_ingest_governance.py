import datetime as dt

from pyspark.sql import functions as F

from skylight.operators import governance as G
from skylight.operators import ingest as I
from skylight.sources import containers as C
from skylight.sources import sinks as K


def test_cri_fragments_are_stitched(spark):
    lines = spark.createDataFrame([
        ("/x/pod-1_ns_app-0ab.log", 0, "2024-01-01T00:00:00.000000001Z stdout P hel"),
        ("/x/pod-1_ns_app-0ab.log", 1, "2024-01-01T00:00:00.000000002Z stdout P lo "),
        ("/x/pod-1_ns_app-0ab.log", 2, "2024-01-01T00:00:00.000000003Z stdout F world"),
        ("/x/pod-1_ns_app-0ab.log", 3, "2024-01-01T00:00:01.000000000Z stderr F oops"),
        ("/x/pod-1_ns_app-0ab.log", 4, '{"log":"json line\\n","stream":"stdout","time":"2024-01-01T00:00:02.000000000Z"}'),
        ("/x/pod-1_ns_app-0ab.log", 5, "2024-01-01T00:00:03.000000000Z stdout P open"),
    ], "file string, line_no long, value string")
    out = C.file_metadata(C.decode_container_lines(lines)).orderBy("ts").collect()
    assert [(r.stream, r.log, r.complete) for r in out] == [
        ("stdout", "hello world", True), ("stderr", "oops", True), ("stdout", "json line", True),
        ("stdout", "open", False)]
    assert {(r.pod, r.pod_namespace, r.container_name) for r in out} == {("pod-1", "ns", "app")}


def test_label_key_normalisation(spark):
    df = spark.createDataFrame([({"example.dev/component-uid": "c", "a.b": "x"},)], "labels map<string,string>")
    logs = I.normalize_label_keys(df, "logs").collect()[0].labels
    mets = I.normalize_label_keys(df, "metrics").collect()[0].labels
    assert logs == {"example_dev/component-uid": "c", "a_b": "x"}
    assert mets == {"label_example_dev_component_uid": "c", "label_a_b": "x"}


def test_resource_upsert_only_when_source_present(spark):
    df = spark.createDataFrame([({"component_uid": "c1"},), ({"other": "x"},)], "resource map<string,string>")
    out = [r.resource for r in I.upsert_resource(df, {"component-uid": "component_uid"}).collect()]
    assert out == [{"component_uid": "c1", "component-uid": "c1"}, {"other": "x"}]


def test_metric_allowlist(spark):
    from skylight.functions.labels import NAMESPACE, label_key
    ns = label_key(NAMESPACE)
    df = spark.createDataFrame([("kube_pod_labels", {ns: "n", "app": "a"}),
                                ("node_cpu", {ns: "n"})], "metric string, labels map<string,string>")
    out = I.metric_allowlist(df).collect()
    assert [(r.metric, r.labels) for r in out] == [("kube_pod_labels", {ns: "n"})]


def test_tail_sampling_greedy_per_second(spark):
    t0 = dt.datetime(2024, 1, 1)
    spans = [("a", t0)] * 6 + [("b", t0 + dt.timedelta(milliseconds=1))] * 6 + [("c", t0 + dt.timedelta(milliseconds=2))] * 3 \
        + [("d", t0 + dt.timedelta(seconds=5))] * 20
    df = spark.createDataFrame(spans, "trace_id string, start_ts timestamp_ntz")
    kept = sorted(r.trace_id for r in I.tail_sample(df, wait_s=10, limit=10, bucket_s=1).collect())
    # second 10: a (6) kept, b (6) would exceed 10, c (3) fits; d has more spans than the limit
    assert kept == ["a", "c"]


def test_pii_reject_and_mask(spark):
    conv = spark.createDataFrame([
        (1, 0, "user", "my card is 4111 1111 1111 1111"),
        (1, 1, "assistant", "mail me at bob.smith@example.com or 123-45-6789"),
        (1, 2, "system", "a@b.co is fine here"),
        (2, 0, "user", "hello"),
    ], "conv_id long, turn long, role string, text string")
    out = G.guard(conv).orderBy("conv_id", "turn").collect()
    assert [r.rejected for r in out] == [True, False, False, False]
    assert out[1].text == "mail me at <Email> or <Ssn>"
    assert out[2].text == "a@b.co is fine here"
    counts = G.pii_counts(conv, "text").agg(*[F.sum(c) for c in ("creditcard", "ssn", "email", "phonenumber")]).collect()[0]
    assert tuple(counts) == (1, 1, 2, 0)


def test_rate_limit_report(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", t0 + dt.timedelta(seconds=i)) for i in range(5)] + [("j", t0)],
                               "key string, ts timestamp_ntz")
    out = G.rate_limit_report(df, "key", unit="Minute", limit=3).collect()
    assert [(r.key, r.requests, r.allowed, r.rejected) for r in out] == [("k", 5, 3, 2)]


def test_day_partitioned_sink_and_retention(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, t0 + dt.timedelta(days=i)) for i in range(10)], "id long, ts timestamp_ntz")
    path = K.scratch_path(spark, "test-retention")
    K.write_logs(df, path)
    deleted = K.apply_retention(spark, path, "2024-01-10", days=3)
    assert len(deleted) == 6
    back = K.scan_logs(spark, path)
    assert sorted(r.id for r in back.collect()) == [6, 7, 8, 9]
    # a retried batch does not duplicate
    dup = K.dedupe_by_doc_id(K.with_doc_id(df.unionByName(df)))
    assert dup.count() == 10


def test_tail_sampling_scan_equals_fold_on_hot_bucket(spark):
    import random
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        tid = f"t{i:04d}"
        # most traces share one decision second (a hot bucket), some spill into the next
        start = t0 + dt.timedelta(milliseconds=rnd.randint(0, 1500))
        rows += [(tid, start)] * rnd.randint(1, 6)
    df = spark.createDataFrame(rows, "trace_id string, start_ts timestamp_ntz")
    first, size = {}, {}
    for tid, start in rows:
        first[tid] = min(first.get(tid, start), start)
        size[tid] = size.get(tid, 0) + 1
    for limit in (1, 25, 2000):
        used, want = {}, set()
        for tid in sorted(first, key=lambda x: (first[x], x)):
            second = first[tid].replace(microsecond=0)
            if used.get(second, 0) + size[tid] <= limit:
                used[second] = used.get(second, 0) + size[tid]
                want.add((tid, size[tid]))
        got = I.tail_sample(df, wait_s=10, limit=limit, bucket_s=1).collect()
        assert len(got) == len(want) > 0 and {(r.trace_id, r.spans) for r in got} == want


def test_metric_label_names_follow_key_normalisation(spark):
    from skylight.functions.labels import SCOPE_LABELS, label_key, log_label_key, metric_label_name
    df = spark.createDataFrame([({label_key(n): n for n in SCOPE_LABELS},)], "labels map<string,string>")
    mets = I.normalize_label_keys(df, "metrics").collect()[0].labels
    logs = I.normalize_label_keys(df, "logs").collect()[0].labels
    assert set(mets) == {metric_label_name(n) for n in SCOPE_LABELS}
    assert set(logs) == {log_label_key(n) for n in SCOPE_LABELS}
