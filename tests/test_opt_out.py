"""Pods that opt out of log collection by an annotation."""

from skylight.operators.ingest import drop_opted_out


def test_opted_out_pods(spark):
    lines = spark.createDataFrame(
        [(*r[:3], "stderr" if r[3] == 7 else "stdout", r[3]) for r in [("a", "ns", "main", 1), ("a", "ns", "side", 2), ("a", "other", "main", 3), ("b", "ns", "main", 4), ("b", "ns", "side", 5),
         ("c", "ns", "main", 6), ("d", "ns", "main", 7), ("e", "ns", "main", 8), (None, None, None, 9), ("d", "ns", "main", 10)]],
        "pod string, pod_namespace string, container string, stream string, id int")
    pods = spark.createDataFrame(
        [("a", "ns", {"x/exclude": "true"}), ("b", "ns", {"x/exclude-side": "True "}), ("c", "ns", {"x/exclude": "false"}),
         ("d", "ns", {"x/exclude_stderr": "true"}), ("e", "ns", None), ("a", "other", {"x/excluded": "true", "y/exclude": "true"}), ("a", "ns", {"x/exclude-main": "true"})],
        "pod string, pod_namespace string, annotations map<string,string>")
    got = drop_opted_out(lines, pods, "x/exclude")
    assert got.columns == lines.columns
    assert sorted(r["id"] for r in got.collect()) == [3, 4, 6, 8, 9, 10]
    assert drop_opted_out(lines, pods.limit(0), "x/exclude").count() == 10
