"""Container log files: source (S1) and CRI / docker line decoding.

Files follow the kubelet layout ``<pod>_<namespace>_<container>-<id>.log``.
A line is either CRI text ``<rfc3339nano> <stream> <P|F> <message>`` or a
docker JSON object ``{"log": ..., "stream": ..., "time": ...}``.  CRI
splits long messages into ``P`` (partial) fragments closed by an ``F``
line; stitching numbers messages by a per-(file, stream) running count of
``F`` lines (a blocked scan, so no file is ever a single task) and joins
the fragments of each message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylight.functions.scan import running_total
from skylight.functions.timeutil import rfc3339

# Fixed value: the names of the shipper's own files, which it must skip.
SHIPPER_FILES = r"(^|/)fluent-bit-[^/]*\.log$"

CRI_RE = r"^(\S+) (stdout|stderr) ([PF]) (.*)$"
FILE_RE = r"([^/_=]+)_([^/_]+)_([^/]+)-([0-9a-f]+)\.log(/|$)"


def read_container_logs(spark: SparkSession, path: str, stream: bool = False,
                        max_line_bytes: int | None = None, max_files_per_trigger: int = 1000,
                        glob: str = "*.log") -> DataFrame:
    """Every ``*.log`` under ``path`` (recursively), read from the start,
    the shipper's own files skipped (by file name, not folder); one row per
    line with its file name. No line is dropped unless ``max_line_bytes`` asks
    for it; ``overlong_lines`` counts what it would skip. A stream of ``*.log``
    files follows what is appended and rotated (``sources/tail.py``); with
    another ``glob`` files are read once, as they are when first seen."""
    follow = stream and glob == "*.log"
    if follow:
        from .tail import tail_container_logs
        df = tail_container_logs(spark, path)
    elif stream:
        reader = (spark.readStream.format("text").option("pathGlobFilter", glob)
                  .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files_per_trigger))
        df = reader.load(path)
    else:
        df = (spark.read.format("text").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true").load(path))
    if not follow:
        df = df.withColumn("file", F.input_file_name())
    if stream and not follow:  # where a line's split starts in its file; batches number lines below
        df = df.withColumn("block_start", F.col("_metadata.file_block_start"))
    df = df.filter(~F.col("file").rlike(SHIPPER_FILES))
    if max_line_bytes is not None:
        df = df.filter(F.octet_length("value") <= max_line_bytes)
    if not stream:
        # file order of lines: ids grow with the split offset and within a split
        df = df.withColumn("line_no", F.monotonically_increasing_id())
    return df


def overlong_lines(lines: DataFrame, max_line_bytes: int) -> DataFrame:
    """Per file, the lines that a limit of ``max_line_bytes`` skips."""
    return lines.filter(F.octet_length("value") > max_line_bytes).groupBy("file").agg(F.count(F.lit(1)).alias("skipped"))


def _docker(value) -> tuple:
    """A line's docker JSON object, and whether it is one with a stream."""
    j = F.from_json(value, "log string, stream string, time string")
    return j, F.coalesce(value.startswith("{") & j["stream"].isin("stdout", "stderr"), F.lit(False))


def rejected_container_lines(lines: DataFrame) -> DataFrame:
    """Lines that are neither CRI nor docker JSON, whole, with a reason;
    ``decode_container_lines`` takes all others."""
    v = F.col("value")
    _, docker = _docker(v)
    reason = (F.when(v == "", "empty line").when(v.startswith("{"), "JSON without log stream").otherwise("no known line format"))
    return lines.filter(~docker & ~v.rlike(CRI_RE)).withColumn("reason", reason)


def decode_container_lines(lines: DataFrame) -> DataFrame:
    """CRI or docker JSON lines -> ``(file, stream, ts, log)`` with partial
    CRI fragments joined to their closing ``F`` line. Other lines are in
    ``rejected_container_lines``."""
    v = F.col("value")
    j, is_json = _docker(v)
    ts_text = F.when(is_json, j["time"]).otherwise(F.regexp_extract(v, CRI_RE, 1))
    parsed = lines.select(
        "file", "line_no",
        F.when(is_json, j["stream"]).otherwise(F.regexp_extract(v, CRI_RE, 2)).alias("stream"),
        F.when(is_json, F.lit("F")).otherwise(F.regexp_extract(v, CRI_RE, 3)).alias("flag"),
        F.when(is_json, F.regexp_replace(j["log"], "\n$", "")).otherwise(F.regexp_extract(v, CRI_RE, 4)).alias("msg"),
        rfc3339(ts_text).alias("ts_raw"),
    ).filter(F.col("stream") != "")
    # message number = closing F lines before this line, as a blocked running
    # count: even a huge file is never one task
    parsed = parsed.withColumn("__f", (F.col("flag") == "F").cast("bigint"))
    grouped = running_total(parsed, ["file", "stream"], "line_no", "__f", "__f_incl")
    grouped = grouped.withColumn("grp", F.col("__f_incl") - F.col("__f"))
    out = grouped.groupBy("file", "stream", "grp").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "msg"))).alias("parts"),
        F.max_by("ts_raw", "line_no").alias("ts"),
        F.max((F.col("flag") == "F").cast("int")).alias("closed"))
    return out.select("file", "stream", F.col("ts").cast("timestamp_ntz").alias("ts"),
                      F.array_join(F.transform("parts", lambda p: p["msg"]), "").alias("log"),
                      (F.col("closed") == 1).alias("complete"))


def file_metadata(df: DataFrame, file_col: str = "file") -> DataFrame:
    """Pod, namespace and container from the kubelet file name (used by I1)."""
    f = F.col(file_col)
    return (df.withColumn("pod", F.regexp_extract(f, FILE_RE, 1))
            .withColumn("pod_namespace", F.regexp_extract(f, FILE_RE, 2))
            .withColumn("container_name", F.regexp_extract(f, FILE_RE, 3)))
