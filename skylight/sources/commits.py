"""Appends that a retry does not repeat.

A table is a folder of batches and a folder of manifests::

    <base>/data/batch=<id>/<day>=<date>/part-*.parquet
    <base>/commits/<id>.json         {"days": [...], "rows": n, "replaces": [...]}

A write stages its files under its batch id, overwriting what an earlier
attempt left there, and then publishes one manifest by a rename that fails if
the manifest exists. Readers list manifests and open committed batches only,
those of the asked days: a writer that dies leaves files nobody reads, and a
repeated write finds its manifest and does nothing. The batch id is the
caller's (a micro-batch's epoch) or derived from the rows.

A row that came before in another batch (a late retry) is dropped by an
anti-join on the record id, which reads the batch's own days only. ``compact``
replaces batches by one, so the manifests that a reader lists stay few.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _Fs:
    """The base folder through the cluster's own file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm = spark.sparkContext._jvm
        self.base = base.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write ``name`` at once or not at all; False if it exists."""
        staged = self.path(f"commits/.{uuid.uuid4().hex}")
        out = self.fs.create(staged, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.exists(name) or not self.fs.rename(staged, self.path(name)):
            self.fs.delete(staged, False)
            return False
        return True

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return [st.getPath().getName() for st in self.fs.listStatus(self.path(folder))]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def batch_of(df: DataFrame) -> str:
    """An id that the same rows give again, in any order and partitioning."""
    cols = sorted(df.columns)
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    n, a, b = df.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64(F.lit(s), text).cast("decimal(38,0)")) for s in (1, 2)]).first()
    return f"{n}-{int(a or 0) % (1 << 64):016x}{int(b or 0) % (1 << 64):016x}"


def manifests(spark: SparkSession, base: str) -> dict[str, dict]:
    """Committed batches that no other batch replaces."""
    fs = _Fs(spark, base)
    found = {n.removesuffix(".json"): json.loads(fs.read(f"commits/{n}")) for n in fs.names("commits")
             if n.endswith(".json") and not n.startswith(".")}
    gone = {r for m in found.values() for r in m["replaces"]}
    return {k: m for k, m in found.items() if k not in gone}


def _folders(spark: SparkSession, base: str, days: Iterable[str] | None, batches: Iterable[str] | None = None) -> list[str]:
    """Day folders of committed batches."""
    fs = _Fs(spark, base)
    want = None if days is None else set(days)
    only = None if batches is None else set(batches)
    return [f"{fs.base}/data/batch={k}/{m['day_col']}={d}" for k, m in sorted(manifests(spark, base).items())
            if only is None or k in only for d in m["days"] if want is None or d in want]


def read_committed(spark: SparkSession, base: str, schema, day_col: str = "log_date", days: Iterable[str] | None = None,
                   batches: Iterable[str] | None = None) -> DataFrame:
    """The rows of committed batches, of ``days`` if given; ``schema`` has the
    columns without the day."""
    folders = _folders(spark, base, days, batches)
    fields = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != day_col)
    if not folders:
        return spark.createDataFrame([], f"{fields}, {day_col} date")
    return (spark.read.schema(f"{fields}, {day_col} date, batch string").option("basePath", f"{base.rstrip('/')}/data")
            .parquet(*folders).drop("batch"))


def _commit(fs: _Fs, batch: str, written: DataFrame, day_col: str, replaces: list[str]) -> bool:
    days = written.groupBy(F.col(day_col).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()
    # rows without a day lie in Spark's default folder
    return fs.publish(f"commits/{batch}.json", json.dumps(
        {"day_col": day_col, "days": sorted(r["day"] or "__HIVE_DEFAULT_PARTITION__" for r in days), "rows": sum(r["n"] for r in days), "replaces": replaces}))


def append_once(df: DataFrame, base: str, batch: str | None = None, id_col: str | None = None, ts_col: str = "ts",
                day_col: str = "log_date") -> bool:
    """Append ``df`` unless its batch is committed; True if it was written now.
    With ``id_col``, rows whose id is in a committed batch of the same day are
    left out, and of rows with an equal id and day one stays."""
    spark = df.sparkSession
    fs = _Fs(spark, base)
    d = df if day_col in df.columns else df.withColumn(day_col, F.col(ts_col).cast("date"))
    batch = batch or batch_of(d)
    if fs.exists(f"commits/{batch}.json"):
        return False
    if id_col is not None:
        days = [r[0] or "__HIVE_DEFAULT_PARTITION__" for r in d.select(F.col(day_col).cast("string")).distinct().collect()]
        there = read_committed(spark, base, d.schema, day_col, days).select(F.col(id_col).alias("there_id"), F.col(day_col).alias("there_day"))
        d = d.dropDuplicates([id_col, day_col])
        d = d.join(there, d[id_col].eqNullSafe(there["there_id"]) & d[day_col].eqNullSafe(there["there_day"]), "left_anti")
    folder = f"{fs.base}/data/batch={batch}"
    d.hint("rebalance", F.col(day_col)).write.mode("overwrite").partitionBy(day_col).parquet(folder)
    fs.fs.mkdirs(fs.path("commits"))
    left = spark.read.schema(d.select(*[c for c in d.columns if c != day_col], day_col).schema).parquet(folder)
    return _commit(fs, batch, left, day_col, [])


def compact(spark: SparkSession, base: str, schema, day_col: str = "log_date") -> str | None:
    """Rewrite all committed batches as one and drop the old ones after the new
    manifest stands; the id of the new batch."""
    old = sorted(manifests(spark, base))
    if len(old) < 2:
        return None
    batch = "compacted-" + uuid.uuid5(uuid.NAMESPACE_URL, "/".join(old)).hex
    fs = _Fs(spark, base)
    rows = read_committed(spark, base, schema, day_col, batches=old)
    folder = f"{fs.base}/data/batch={batch}"
    rows.hint("rebalance", F.col(day_col)).write.mode("overwrite").partitionBy(day_col).parquet(folder)
    _commit(fs, batch, spark.read.schema(rows.schema).parquet(folder), day_col, old)
    for name in old:  # readers know the new manifest by now
        fs.delete(f"data/batch={name}")
    return batch


def sweep(spark: SparkSession, base: str) -> list[str]:
    """Delete staged folders without a manifest (no writer may be running)."""
    fs = _Fs(spark, base)
    live = {f"batch={k}" for k in manifests(spark, base)}
    gone = [n for n in fs.names("data") if n not in live]
    for n in gone:
        fs.delete(f"data/{n}")
    return gone


def each_batch_once(base: str, id_col: str | None = None, ts_col: str = "ts", day_col: str = "log_date"):
    """A ``foreachBatch`` function: an epoch that runs again appends nothing."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        append_once(batch, base, f"epoch-{epoch_id}", id_col, ts_col, day_col)
    return run
