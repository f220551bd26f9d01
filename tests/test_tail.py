"""The tailing source: appended, rotated, truncated and restarted files give
every line once."""

import os

import pytest
from pyspark.sql import functions as F

from skylight.sources import sinks as K
from skylight.sources.containers import read_container_logs
from skylight.sources.tail import tail_container_logs


@pytest.fixture
def logs(tmp_path):
    d = tmp_path / "containers" / "node1"
    d.mkdir(parents=True)
    return d


class Tailed:
    """A stream over a folder that is run again and again from one checkpoint."""

    def __init__(self, spark, folder, size=64 << 20):
        self.spark, self.folder, self.size = spark, str(folder), size
        self.sink, self.ckpt = K.scratch_path(spark, "tail-out"), K.scratch_path(spark, "tail-ckpt")

    def run(self):
        q = (tail_container_logs(self.spark, self.folder, partition_bytes=self.size).writeStream.format("parquet").option("path", self.sink)
             .option("checkpointLocation", self.ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        return self.lines()

    def lines(self):
        df = self.spark.read.schema("file string, value string, block_start bigint, line_no bigint").parquet(self.sink)
        return sorted((os.path.basename(r["file"]), r["value"]) for r in df.collect())


def write(path, *lines, mode="a", end="\n"):
    with open(path, mode, newline="") as f:
        f.write("\n".join(lines) + end)


def test_append_rotate_truncate_and_restart(spark, logs):
    a, b = logs / "a_ns_main-01.log", logs / "b_ns_main-02.log"
    t = Tailed(spark, logs.parent, size=16)  # several parts a file
    want = []

    def wrote(path, *lines, name=None, **kw):
        write(path, *lines, **kw)
        want.extend((name or path.name, x) for x in lines)

    wrote(a, "a1", "a2 é", "", "a4 " + "x" * 50)
    wrote(b, "b1")
    assert t.run() == sorted(want)
    assert t.run() == sorted(want)  # nothing new
    wrote(a, "a5", "a6")
    write(b, "b2 unfin", end="")
    assert t.run() == sorted(want)  # the unfinished line waits
    write(b, "ished")
    want.append((b.name, "b2 unfinished"))
    assert t.run() == sorted(want)
    # renamed and begun anew, with a last line before the rotation
    wrote(a, "a7")
    os.rename(a, f"{a}.1")
    wrote(a, "A1", "A2")
    assert t.run() == sorted(want)
    # copied and truncated
    wrote(b, "b3")
    with open(f"{b}.20240101", "w") as f:
        f.write(b.read_text())
    wrote(b, "new b1", mode="w")
    assert t.run() == sorted(want)
    # two rotations between two runs
    wrote(a, "A3")
    os.rename(f"{a}.1", f"{a}.2")
    os.rename(a, f"{a}.1")
    wrote(a, "AA1")
    os.rename(f"{a}.1", f"{a}.3")
    os.rename(a, f"{a}.1")
    wrote(a, "AAA1")
    assert t.run() == sorted(want)
    # a removed file, and one that was never seen live
    os.remove(f"{a}.2")
    wrote(logs / "c_ns_main-03.log.1", "c1", "c2", name="c_ns_main-03.log")
    wrote(logs / "fluent-bit-x.log", "own line")
    want.pop()
    write(logs / "d.log.gz", "packed")
    assert t.run() == sorted(want)


def test_truncated_and_shorter_with_the_same_first_line(spark, logs):
    a = logs / "a.log"
    t = Tailed(spark, logs)
    write(a, "same", "2", "3")
    t.run()
    write(a, "same", mode="w")
    assert t.run() == [("a.log", x) for x in sorted(["same", "2", "3", "same"])]


def test_failed_batch_is_read_again_after_a_rotation(spark, logs):
    a = logs / "a.log"
    write(a, "1", "2")
    sink, ckpt, fail = K.scratch_path(spark, "tail-out"), K.scratch_path(spark, "tail-ckpt"), [True]

    def each(batch, epoch):
        if fail[0]:
            raise ValueError("stopped")
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    def run():
        q = (tail_container_logs(spark, str(logs)).writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    with pytest.raises(Exception, match="stopped"):
        run()
    write(a, "3")
    os.rename(a, f"{a}.1")
    write(a, "4")
    fail[0] = False
    run()  # the failed batch, as it was planned, from the renamed file
    assert sorted(r["value"] for r in spark.read.parquet(sink).collect()) == ["1", "2"]
    run()
    assert sorted(r["value"] for r in spark.read.parquet(sink).collect()) == ["1", "2", "3", "4"]


def test_batch_equals_stream_and_text_source(spark, logs):
    for i in range(5):
        write(logs / f"p{i}_ns_main-0{i}.log", *[f"line {j} of {i} " + "y" * (j * 37 % 200) for j in range(200)])
    write(logs / "win.log", "a\r", "b\r")
    tailed = tail_container_logs(spark, str(logs), stream=False, partition_bytes=1000)
    text = read_container_logs(spark, str(logs)).withColumn("file", F.element_at(F.split("file", "/"), -1))
    got = sorted((os.path.basename(r["file"]), r["value"]) for r in tailed.collect())
    assert got == sorted((r["file"], r["value"]) for r in text.collect())
    assert got == Tailed(spark, logs).run()
    # positions put a file's lines in order
    one = sorted((r["block_start"], r["value"]) for r in tailed.filter(F.col("file").endswith("p1_ns_main-01.log")).collect())
    assert [v for _, v in one] == (logs / "p1_ns_main-01.log").read_text().splitlines()


def test_empty_folder(spark, tmp_path):
    assert tail_container_logs(spark, str(tmp_path / "none"), stream=False).collect() == []
    assert Tailed(spark, tmp_path).run() == []


def test_ingestion_follows_and_stitches_across_rotation(spark, logs):
    from skylight.streaming import pipelines as SP
    pods = spark.createDataFrame([("a", "ns", "n", "p", "e", "c")],
                                 "pod string, pod_namespace string, namespace string, project_uid string, environment_uid string, component_uid string")
    a = logs / "a_ns_main-01ab.log"
    sink, ckpt = K.scratch_path(spark, "ingest"), K.scratch_path(spark, "ingest-ckpt")

    def run():
        SP.container_log_stream(spark, str(logs), sink, pods, checkpoint=ckpt).awaitTermination()
        df = spark.read.parquet(sink)
        return sorted((r["pod"], r["component_uid"], r["log"]) for r in df.collect())

    write(a, "2024-01-01T00:00:00.000000001Z stdout F one", "2024-01-01T00:00:01.000000001Z stdout P tw")
    assert run() == [("a", "c", "one")]
    write(a, "2024-01-01T00:00:02.000000001Z stdout P o o")
    os.rename(a, f"{a}.1")
    write(a, "2024-01-01T00:00:03.000000001Z stdout F f two", "2024-01-01T00:00:04.000000001Z stdout F three")
    assert run() == [("a", "c", "one"), ("a", "c", "three"), ("a", "c", "two of two")]
