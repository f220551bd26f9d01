"""Operator 7: contiguous shards of nearly equal bytes.

Rows are ranged by id; each partition's byte and row totals give the prefix
sums at which it starts, and running sums within the partition give every
row's place in the whole. Shard k takes the rows whose middle byte lies in
its equal share [k, k+1) / n of all bytes, so shards are contiguous in id
order and each differs from its target by at most one row at either end.

Only (id, size, checksum) rows move, once; texts stay where they are read.
The table of totals has one row per partition. No partition is a whole shard:
slots come from global row numbers less the shard's first.

Defined cases. NULL text: no bytes, size 1. NULL ids come first. Rows with
equal ids are ordered by checksum and size, and rows equal in all three are
interchangeable. Empty table: no rows. A row larger than a share leaves
shards empty, since rows are not split. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 16


def byte_shards(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row, ``size`` being the
    text's UTF-8 bytes plus 1."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(content) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(content, "UTF-8")).cast("long").alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()), "shards")
    totals = ranged.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row per partition: the only place with a single ordered window
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("pid", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row0"),
                           F.sum("bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("bytes_in"),
                            (F.row_number().over(Window.partitionBy("pid").orderBy(*order)) - 1).alias("row_in"))
              .join(starts, "pid"))
    middle = (F.col("byte0") + F.col("bytes_in")) * 2 + F.col("size")
    shard = F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / (F.col("total") * 2))).cast("int")
    placed = placed.select("doc_id", "size", "text_crc32", shard.alias("shard"),
                           (F.col("row0") + F.col("row_in")).alias("row"))
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "shard",
                                              (F.col("row") - F.col("first")).cast("long").alias("slot"))
