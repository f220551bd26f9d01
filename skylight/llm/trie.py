"""Operator 13: conversation prefix trie.

Whole-sequence collapse, without walking the trie level by level:

1. Turns are numbered per conversation by a sort by range over all partitions
   (a conversation of any size is spread) and offsets per (conversation,
   partition). Only digests and lengths of the texts move, never the texts.
2. A prefix is known by its depth and the running sum of the digests of its
   (place, role, text) in four lanes of 32 bits; sums are taken in blocks of
   places (``running_totals``), so long conversations are not one window.
3. Identical conversations collapse to one weighted sequence (its smallest
   conv_id, their number) and the list of those that end there.
4. Sequences that are a proper prefix of another go by anti-join on the
   distinct proper prefixes; what is left are the leaves.
5. The prefixes of the weighted sequences are aggregated to nodes. A node's
   bytes before it are the same for all its sequences, so the sum of
   n_convs * bytes over a subtree is that of weight * (bytes from the node to
   the sequence's end). The sum of bytes over the distinct nodes of a subtree
   takes every node from one leaf, the smallest below it: a leaf owns the
   lower end of its path, from one known length on.
6. The conv_ids that end at a node are hashed in one pass over (node, conv_id)
   sorted rows, with constant memory; SHA-256 is serial by nature.

Counts, sums and least ids are partially aggregated, so a node with all
conversations below it is one row per task; joins back to nodes and
conversations have one row per key on one side and split like any skewed
join.

Defined cases. NULL role or text is empty. NULL conv_id: no conversation, left
out. NULL turn first; equal turns by role, then SHA-256 of the text; repeated
rows are turns of their own. Empty and very long texts are whole. Empty table:
no rows, not even a root. Other columns are not read. Digests of 128 bits are
taken for the prefixes they stand for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylight.functions.scan import running_totals

from .common import stored

FAMILY, HEAD = 5, 9
LANES = [f"lane{i}" for i in range(4)]
NODE = ["depth", "k1", "k2"]
#: Places per block of the running sums.
BLOCK = 1 << 12


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): every turn with its place from 1 by (turn, role,
    text digest), and every conv_id with its number of turns."""
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "uid"]
    light = (turns.filter("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
             .select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
             # identical rows are spread as well; which is which changes nothing
             .withColumn("uid", F.monotonically_increasing_id()))
    ordered = stored(light.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("uid", "turn")
                     .withColumn("seq", F.monotonically_increasing_id()), "turns").withColumn("part", F.shiftright("seq", 33))
    run = ordered.groupBy("conv_id", "part").agg(F.min("seq").alias("low"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    run = run.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rows = (ordered.join(run, ["conv_id", "part"])
            .select("conv_id", (F.col("seq") - F.col("low") + F.col("before") + 1).alias("place"), "role", "digest", "bytes"))
    return rows, run.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(rows: DataFrame, convs: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """Conversations that share their starts: the first h turns of the
    family's first conversation, then their own after their first h."""
    base = F.col("conv_id") - F.col("conv_id") % family
    each = convs.select("conv_id", base.alias("base"), F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(head)).alias("h"))
    firsts = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("has"))
    each = each.join(firsts, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("m"))
    heads = rows.filter(F.col("place") < head).withColumnRenamed("conv_id", "base")
    taken = (each.select("conv_id", "base", "h").join(heads, "base").filter("place <= h")
             .select("conv_id", F.col("place").alias("depth"), "role", "digest", "bytes"))
    own = (rows.join(each.select("conv_id", "h", "m"), "conv_id").filter("place > h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("depth"), "role", "digest", "bytes"))
    return taken.unionByName(own)


def _prefixes(rows: DataFrame) -> DataFrame:
    """Every turn with the key of the prefix that it ends, of the prefix
    before it, and the bytes before it."""
    h = F.sha2(F.concat_ws(" ", F.col("depth").cast("string"), F.hex("digest"), "role"), 256)
    rows = rows.withColumn("h", h).select(
        "conv_id", "depth", "bytes", *[F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("long").alias(x) for i, x in enumerate(LANES)])
    done = running_totals(rows, ["conv_id"], "depth", {**{x: f"sum_{x}" for x in LANES}, "bytes": "upto"}, BLOCK)
    low = (1 << 32) - 1

    def key(of):
        a = [of(x).bitwiseAND(F.lit(low)) for x in LANES]
        return [F.shiftleft(a[0], 32).bitwiseOR(a[1]), F.shiftleft(a[2], 32).bitwiseOR(a[3])]

    k1, k2 = key(lambda x: F.col(f"sum_{x}"))
    p1, p2 = key(lambda x: F.col(f"sum_{x}") - F.col(x))
    return done.select("conv_id", F.col("depth").cast("long").alias("depth"), k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"),
                       "bytes", (F.col("upto") - F.col("bytes")).alias("before"))


def _ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []

        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [*[pa.array([x[0][i] for x in found], pa.int64()) for i in range(3)], pa.array([x[1] for x in found], pa.string())],
                names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if node == now:
                    sha.update(b",%d" % conv)
                else:
                    if now is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = node, hashlib.sha256(b"%d" % conv)
            yield batch_of(out)
            out = []
        if now is not None:
            yield batch_of([(now, sha.hexdigest())])

    return (rows.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
            .mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string"))


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, depth from 1, role,
    digest, bytes); ``convs`` names every conversation, turnless ones too."""
    zero = F.lit(0).cast("long")
    prefix = stored(_prefixes(rows), "prefixes")
    last = prefix.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2", "before", "bytes")).alias("x"))
    whole = (convs.select("conv_id").join(last, "conv_id", "left")
             .select("conv_id", *[F.coalesce(f"x.{c}", zero).alias(c) for c in NODE],
                     F.coalesce(F.col("x.before") + F.col("x.bytes"), zero).alias("total")))
    whole = stored(whole, "whole")
    seqs = whole.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("total").alias("total"))
    # the prefixes of one conversation per sequence, the root among them
    named = seqs.select("conv_id", "weight", "total", F.col("depth").alias("length"))
    paths = prefix.join(named, "conv_id")
    roots = named.select("conv_id", *[zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "bytes", "before")], "weight", "total", "length")
    paths = stored(paths.unionByName(roots), "paths")
    proper = paths.filter("depth < length").select(*NODE).distinct()
    leaves = seqs.join(proper, NODE, "left_anti").select("conv_id", F.lit(True).alias("leaf"))
    paths = stored(paths.join(leaves, "conv_id", "left"), "paths")
    rest = F.col("total") - F.col("before")
    nodes = stored(paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"), F.sum(F.col("weight") * rest).alias("all_bytes"),
        F.max("before").alias("before"), F.max("p1").alias("p1"), F.max("p2").alias("p2")), "nodes")
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("before").alias("owned_from"))
    once = (paths.filter("leaf").join(owned, "conv_id").groupBy(*NODE)
            .agg(F.sum(F.col("total") - F.greatest("before", "owned_from")).alias("node_bytes")))
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.filter("depth > 0").select(*above).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = (nodes.join(once, NODE).join(children, NODE, "left").join(_ends(whole.select(*NODE, "conv_id")), NODE, "left")
           .join(parents, ["depth", "p1", "p2"], "left"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
                      (F.col("all_bytes") - F.col("node_bytes")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, family: int | None = None, head: int = HEAD) -> DataFrame:
    """The trie of the conversations of ``turns`` (conv_id, turn, role, text)
    as they are, or rebuilt in families of ``family`` ids."""
    rows, convs = numbered(turns)
    rows, convs = stored(rows, "numbered"), stored(convs, "convs")
    if family is None:
        return prefix_trie(rows.withColumnRenamed("place", "depth"), convs)
    return prefix_trie(rebuilt(rows, convs, family, head), convs)
