"""Appends that a retry, a late copy or a killed writer does not double."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylight.sources import commits as C
from skylight.sources import sinks as K

SCHEMA = "id string, ts timestamp_ntz, log string"


def rows(spark, *items):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d, 12), f"log {i}") for i, d in items], SCHEMA)


def ids(spark, base, **kw):
    return sorted(r["id"] for r in C.read_committed(spark, base, SCHEMA, **kw).collect())


@pytest.fixture
def base(spark):
    return K.scratch_path(spark, "commits")


def test_a_repeated_write_is_one_write(spark, base):
    first = rows(spark, ("a", 1), ("b", 1), ("c", 2))
    assert C.append_once(first, base) and not C.append_once(first.repartition(3), base)
    assert ids(spark, base) == ["a", "b", "c"]
    assert C.append_once(rows(spark, ("d", 2)), base) and ids(spark, base) == ["a", "b", "c", "d"]
    assert ids(spark, base, days=["2024-01-02"]) == ["c", "d"]
    assert ids(spark, base, days=["2024-03-01"]) == []


def test_a_killed_write_leaves_nothing_and_its_retry_one_copy(spark, base):
    boom = F.udf(lambda x: 1 / 0 if x == "b" else x)
    bad = rows(spark, ("a", 1), ("b", 2)).repartition(2).withColumn("log", boom("id"))
    with pytest.raises(Exception):
        C.append_once(bad, base, batch="epoch-0")
    # files of a writer that died before its commit
    rows(spark, ("z", 1)).withColumn("log_date", F.col("ts").cast("date")).write.partitionBy("log_date").parquet(f"{base}/data/batch=epoch-0")
    assert ids(spark, base) == []
    assert C.append_once(rows(spark, ("a", 1), ("b", 2)), base, batch="epoch-0")
    assert ids(spark, base) == ["a", "b"]
    rows(spark, ("y", 1)).withColumn("log_date", F.col("ts").cast("date")).write.partitionBy("log_date").parquet(f"{base}/data/batch=lost")
    assert C.sweep(spark, base) == ["batch=lost"] and ids(spark, base) == ["a", "b"]


def test_late_copies_go_by_id_and_day(spark, base):
    C.append_once(rows(spark, ("a", 1), ("b", 1)), base, id_col="id")
    C.append_once(rows(spark, ("b", 1), ("c", 1), ("c", 1), ("a", 2)), base, id_col="id")
    assert ids(spark, base) == ["a", "a", "b", "c"]
    # the anti-join reads the days of the batch only
    plan = C.read_committed(spark, base, SCHEMA, days=["2024-01-02"])
    assert all("log_date=2024-01-02" in f for f in plan.inputFiles())


def test_compaction_keeps_rows(spark, base):
    for i in range(4):
        C.append_once(rows(spark, (f"r{i}", 1 + i % 2)), base)
    before = ids(spark, base)
    assert C.compact(spark, base, SCHEMA) and ids(spark, base) == before and len(C.manifests(spark, base)) == 1
    assert C.compact(spark, base, SCHEMA) is None
    assert not C.append_once(rows(spark, ("r1", 2)), base)  # its manifest still stands


def test_rows_without_a_day_and_empty_batches(spark, base):
    odd = rows(spark, ("a", 1)).unionByName(spark.createDataFrame([("n", None, None)], SCHEMA))
    assert C.append_once(odd, base, id_col="id") and not C.append_once(odd, base, id_col="id")
    assert C.append_once(odd.unionByName(rows(spark, ("b", 1))), base, id_col="id")
    assert ids(spark, base) == ["a", "b", "n"]
    assert C.append_once(odd.limit(0), base, batch="none") and ids(spark, base) == ["a", "b", "n"]
    assert C.read_committed(spark, K.scratch_path(spark, "nothing"), SCHEMA).collect() == []


def test_stream_epochs(spark, base):
    src = K.scratch_path(spark, "commit-src")
    rows(spark, ("a", 1), ("b", 2)).write.parquet(src)
    for ckpt in ("one", "one", "two"):  # a lost checkpoint runs epoch 0 again
        q = (spark.readStream.schema(SCHEMA).parquet(src).writeStream.foreachBatch(C.each_batch_once(base))
             .option("checkpointLocation", f"{base}-{ckpt}").trigger(availableNow=True).start())
        q.awaitTermination()
    assert ids(spark, base) == ["a", "b"]
