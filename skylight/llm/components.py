"""Connected components by alternating large-star and small-star.

Edges are rows (u, v). Large-star links every node's larger neighbours to its
least neighbour; small-star links a node's smaller neighbours and itself to
the least of them. Repeated until nothing changes, every node points at the
least node of its component. Both steps are a minimum by key (partially
aggregated) and a join back of one row per key, so a node with a third of all
edges is split like any skewed join. Each round is written to the shared
folder; the driver sees a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step; ``edges`` are distinct (u, v) with u > v."""
    near = edges
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    # exact in either order; a decimal sum cannot overflow
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) of every node that has an edge to another; the
    component is its least node. ``edges`` has long columns u and v, in any
    order, repeats and loops allowed; NULLs are not nodes."""
    e = stored(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        e = stored(_star(_star(e, large=True), large=False), "edges")
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point within {rounds} rounds")
    # at the fixed point every edge points at the component's least node
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
