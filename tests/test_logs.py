import datetime as dt

from pyspark.sql import functions as F

from skylight.functions.ids import uuid_or_null
from skylight.functions.levels import effective_level, level_from_text
from skylight.functions.scope import Scope
from skylight.operators import logs as L

# (text, search-store level, SQL-store level)
LEVEL_CASES = [
    ("ERROR: something failed", "ERROR", "ERROR"),
    ("fatal crash", "FATAL", "FATAL"),
    ("SEVERE issue", "SEVERE", "SEVERE"),
    ("WARN disk", "WARN", "WARN"),
    ("Warning: low memory", "WARN", "WARN"),
    ("info: started", "INFO", "INFO"),
    ("DEBUG x=1", "DEBUG", "DEBUG"),
    ("UNDEFINED level", "UNDEFINED", "INFO"),
    ("plain text", "INFO", "INFO"),
    ("error and warn", "ERROR", "ERROR"),
]


def test_level_tables(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in LEVEL_CASES], "log string")
    got = df.select(level_from_text("log", "search").alias("a"), level_from_text("log", "sql").alias("b")).collect()
    assert [r.a for r in got] == [c[1] for c in LEVEL_CASES]
    assert [r.b for r in got] == [c[2] for c in LEVEL_CASES]


def test_stored_level_wins_when_not_blank(spark):
    df = spark.createDataFrame([("ERROR x", " warn "), ("ERROR x", "  "), ("debug", None)], "log string, log_level string")
    assert [r[0] for r in df.select(effective_level()).collect()] == ["warn", "ERROR", "DEBUG"]


def _logs(spark):
    rows = [
        (1, dt.datetime(2024, 1, 1, 0, 0, 0), "a 100% done", "ns", "c1"),
        (2, dt.datetime(2024, 1, 1, 0, 0, 1), "a 100x done", "ns", "c1"),
        (3, dt.datetime(2024, 1, 1, 0, 0, 2), "WARN 100 thing", "ns", "c2"),
        (4, dt.datetime(2024, 1, 1, 0, 0, 3), "other", "ns2", "c1"),
    ]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, log string, namespace string, component_uid string")
    return (df.withColumn("log_date", F.col("ts").cast("date")).withColumn("project_uid", F.lit(None).cast("string"))
            .withColumn("environment_uid", F.lit(None).cast("string")).withColumn("pod_name", F.lit("p"))
            .withColumn("pod_namespace", F.lit("k")).withColumn("container_name", F.lit("main")))


def test_time_range_is_exclusive(spark):
    df = _logs(spark)
    ids = [r.event_id for r in df.filter(L.time_range_exclusive("2024-01-01 00:00:00", "2024-01-01 00:00:03")).collect()]
    assert sorted(ids) == [2, 3]


def test_phrase_literal_vs_like(spark):
    df = _logs(spark)
    lit_ids = sorted(r.event_id for r in df.filter(L.phrase_literal("100%")).collect())
    like_ids = sorted(r.event_id for r in df.filter(L.phrase_like("100%")).collect())
    assert lit_ids == [1]
    assert like_ids == [1, 2, 3]  # '%' is a wildcard in the LIKE form


def test_search_orders_newest_first_with_default_limit(spark):
    df = _logs(spark)
    out = L.search_logs(df, Scope("ns"), "2023-12-31", "2024-01-02", limit=0).collect()
    assert [r.event_id for r in out] == [3, 2, 1]
    out = L.search_logs(df, Scope("ns", component="c1"), "2023-12-31", "2024-01-02", order="asc").collect()
    assert [r.event_id for r in out] == [1, 2]


def test_levels_in_text_any_case(spark):
    df = _logs(spark)
    assert [r.event_id for r in df.filter(L.levels_in_text(["warn"])).collect()] == [3]


def test_uuid_or_null(spark):
    u = "123e4567-e89b-12d3-a456-426614174000"
    df = spark.createDataFrame([(u,), (u.upper().replace("-", ""),), ("{" + u + "}",), ("urn:uuid:" + u,), ("comp-1",), ("",)],
                               "v string")
    got = [r[0] for r in df.select(uuid_or_null("v")).collect()]
    assert got == [u, u, u, u, None, None]


def test_workflow_prefix_excludes_sidecars(spark):
    rows = [(1, dt.datetime(2024, 1, 1), "x", "run-1-a", "workflows-ns", "main", "step-1"),
            (2, dt.datetime(2024, 1, 1), "x", "run-1-b", "workflows-ns", "init", "step-1"),
            (3, dt.datetime(2024, 1, 1), "x", "run-2-a", "workflows-ns", "main", "step-1")]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, log string, pod_name string, pod_namespace string, "
                                     "container_name string, step_name string").withColumn("log_date", F.col("ts").cast("date"))
    out = df.filter(L.workflow_prefix_filter("run-1", "ns", "2023-12-31", "2024-01-02")).collect()
    assert [r.event_id for r in out] == [1]
