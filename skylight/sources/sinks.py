"""Sinks and scans of the day-partitioned stores.

All writes go below a caller-given base path; for registered queries that
is a folder under ``spark.checkpoint.dir`` (the shared folder on a
cluster), never a machine-local temporary folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import Sequence
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylight.functions.ids import record_id
from skylight.session import checkpoint_dir


# JSON keeps full microsecond precision (the writer default stops at millis).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job's output under the shared checkpoint dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/skylight/{name}/{uuid.uuid4().hex}"


def _mounted(path: str) -> str | None:
    """``path`` as the operating system knows it; None on another file system."""
    parts = urlsplit(path)
    return path if not parts.scheme else unquote(parts.path) if parts.scheme == "file" else None


def write_text_files(df: DataFrame, path: str, name_col: str, value_col: str = "value") -> None:
    """One text file per ``name_col``, a line per row. The rows of a name lie
    in one partition, together and in file order (repartition and sort first).

    On a folder that is mounted the tasks write ``<path>/<name>`` themselves:
    without its native library, Hadoop's local file system starts four
    processes a file to set permissions, and the driver then moves all files
    alone. A file gets its name when it is complete, so a repeated task does no
    harm. On other file systems Spark writes a folder ``name_col=<name>``."""
    base = _mounted(path)
    rows = df.select(F.col(name_col).cast("string").alias("name"), F.col(value_col).cast("string").alias("value"))
    if base is None:
        rows.withColumnRenamed("name", name_col).write.partitionBy(name_col).text(path)
        return
    os.makedirs(base, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(base, exist_ok=True)
        name, out, n = None, None, 0
        try:
            for batch in batches:
                for to, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                    to = "unnamed.txt" if to is None else to.replace("/", "%2F")
                    if to != name:
                        if out is not None:
                            out.close()
                            os.replace(out.name, f"{base}/{name}")
                        name, n = to, n + 1
                        out = open(f"{base}/.{uuid.uuid4().hex}", "wb", 1 << 16)  # noqa: SIM115 - spans batches
                    out.write((value or "").encode() + b"\n")
            if out is not None:
                out.close()
                os.replace(out.name, f"{base}/{name}")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["files"])

    rows.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def with_day(df: DataFrame, ts_col: str = "ts", day_col: str = "log_date") -> DataFrame:
    return df.withColumn(day_col, F.col(ts_col).cast("date"))


def write_logs(df: DataFrame, path: str, ts_col: str = "ts", day_col: str = "log_date",
               mode: str = "append", fmt: str = "parquet") -> None:
    """One partition per UTC day.  Rows are rebalanced by day before
    the write: small days share no file with others, and a large day is split
    over tasks by size."""
    d = df if day_col in df.columns else with_day(df, ts_col, day_col)
    w = d.hint("rebalance", F.col(day_col)).write.mode(mode).partitionBy(day_col).format(fmt)
    if fmt == "json":
        w = w.option("timestampNTZFormat", JSON_TS_FORMAT).option("timestampFormat", JSON_TS_FORMAT + "XXX")
    w.save(path)


def write_spans(df: DataFrame, path: str, mode: str = "append") -> None:
    """Daily trace tables."""
    write_logs(df, path, ts_col="start_ts", day_col="span_date", mode=mode)


def with_doc_id(df: DataFrame, cols: Sequence[str] | None = None, id_col: str = "doc_id") -> DataFrame:
    """Content-derived id so a retried write does not duplicate."""
    return df.withColumn(id_col, record_id(*(cols or df.columns)))


def dedupe_by_doc_id(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.dropDuplicates([id_col])


def append_alerts(df: DataFrame, path: str) -> None:
    """Append alert documents; a later read sees them at once."""
    df.write.mode("append").parquet(path)


def scan_logs(spark: SparkSession, base: str, start=None, end=None, day_col: str = "log_date",
              fmt: str = "parquet", schema=None) -> DataFrame:
    """Read the day-partitioned store; the day predicate prunes
    partitions, absent days cost nothing."""
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.option("timestampNTZFormat", JSON_TS_FORMAT).option("timestampFormat", JSON_TS_FORMAT + "XXX")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(base)
    if start is not None and end is not None:
        from skylight.functions.timeutil import ts_lit
        df = df.filter((F.col(day_col) >= ts_lit(start).cast("date")) & (F.col(day_col) <= ts_lit(end).cast("date")))
    return df


def retention_filter(now, days: int = 30, day_col: str = "log_date"):
    """S10 as a predicate: keep partitions not older than ``days``."""
    from skylight.functions.timeutil import ts_lit
    return F.col(day_col) >= F.date_sub(ts_lit(now).cast("date"), days)


def apply_retention(spark: SparkSession, base: str, now, days: int = 30, day_col: str = "log_date") -> list[str]:
    """Delete whole day partitions older than ``days`` (a metadata
    operation on the store: no data is read).  Returns the deleted paths."""
    import datetime as _dt

    from skylight.functions.timeutil import parse_ts
    cutoff = parse_ts(now).date() - _dt.timedelta(days=days)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(conf)
    deleted = []
    if not fs.exists(root):
        return deleted
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(day_col + "="):
            try:
                day = _dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:
                continue
            if day < cutoff:
                fs.delete(st.getPath(), True)
                deleted.append(st.getPath().toString())
    return deleted


def union_clusters(frames: dict[str, DataFrame], cluster_col: str = "cluster") -> DataFrame:
    """Federate series from many clusters into one table."""
    out = None
    for name, df in frames.items():
        d = df.withColumn(cluster_col, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
