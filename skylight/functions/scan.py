"""Skew-safe running totals (segmented prefix sums).

``sum(v) OVER (PARTITION BY key ORDER BY o)`` puts every row of a key into
one task; a key holding a third of the data would then sort and scan in a
single task.  Here the order column is cut into fixed-width blocks:

1. running sum inside ``(key, block)`` - each window partition holds at
   most ``block_width`` distinct order values;
2. per-block totals (partial aggregation, one row per block);
3. exclusive running sum of block totals per key - one row per block, so
   even a hot key has only ``rows / block_width`` rows there;
4. an equi-join on ``(key, block)`` adds the offset; the big side is
   already hash-partitioned on those columns by step 1, so the join does
   not shuffle it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_WIDTH = 1 << 16


def running_total(df: DataFrame, keys: list[str], order_col: str, value_col: str, out_col: str,
                  block_width: int = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """Add ``out_col`` = inclusive running sum of ``value_col`` per ``keys``
    in ``order_col`` order (``order_col`` integral and unique per key)."""
    return running_totals(df, keys, order_col, {value_col: out_col}, block_width)


def running_totals(df: DataFrame, keys: list[str], order_col: str, columns: dict[str, str],
                   block_width: int = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """``running_total`` of several columns (value to output name) in one pass."""
    blk = "__blk"
    width = F.lit(block_width).cast("bigint")
    b = df.withColumn(blk, F.floor(F.col(order_col) / width).cast("bigint"))
    part = keys + [blk]
    w_in = (Window.partitionBy(*part).orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_off = (Window.partitionBy(*keys).orderBy(blk)
             .rowsBetween(Window.unboundedPreceding, -1))
    numbered = list(enumerate(columns.items()))
    local = b.select("*", *[F.sum(v).over(w_in).alias(f"__local{i}") for i, (v, _) in numbered])
    totals = b.groupBy(*part).agg(*[F.sum(v).alias(f"__tot{i}") for i, (v, _) in numbered])
    offsets = totals.select(*part, *[F.coalesce(F.sum(f"__tot{i}").over(w_off), F.lit(0).cast("bigint")).alias(f"__off{i}")
                                     for i, _ in numbered])
    out = local.join(offsets, part, "inner")
    return out.select(*df.columns, *[(F.col(f"__local{i}") + F.col(f"__off{i}")).alias(o) for i, (_, o) in numbered])
