"""Shared folder, table readers and column-name helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Unset, a temporary folder is made for a local session (tests); on a
    cluster that would be a folder of one machine, so it is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    found = tempfile.mkdtemp(prefix="skylight-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut,
    and a lost executor costs one read instead of a recomputation."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(columns: list[str], base: str) -> str:
    """``base``, or ``base_1``, ... whichever no column has (case-blind)."""
    taken = {c.lower() for c in columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]):
    """Equality of the named columns where NULL equals NULL."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def text_key(text: str, seed: int = 42):
    """64-bit hash of a text column; NULL hashes as the empty text."""
    return F.xxhash64(F.lit(seed), F.coalesce(F.col(text), F.lit("")))
