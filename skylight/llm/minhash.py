"""Operator 5: near-duplicate groups by MinHash.

A document is the set of its distinct 5-word shingles. Documents whose sets
have a Jaccard similarity of at least ``PERCENT`` / 100 are linked, and a
component of links is a group.

1. ``sketch``: one pass over the texts. A row has the set's size and 128-bit
   digest, the keys of ``BANDS`` bands of ``ROWS`` minima each (one universal
   hash h(x) = a x + b mod 2^64 per minimum), and a signature of one bit per
   minimum, ``BANDS * ROWS`` bits.
2. Equal sets are one node: the least doc_id that has the set.
3. Per band key the least node is the pivot, and every other node of the
   bucket is a candidate of the pivot: a star, not all pairs.
4. Signature verification: pairs whose bits agree too little go (the bound
   lies ``SLACK`` deviations under the threshold, natively by bit_count). The
   rest are verified on the full shingle sets of their texts.
5. Components of the verified links, by large-star and small-star.
6. A bucket that still holds several components may hide a link between
   them. Buckets are gathered by their largest component: its rows in such
   buckets are members, rows of other components there are the query set.
   Queries are compared with members and with each other in blocks of
   ``BLOCK`` rows, by signature, then on full sets; only links leave a block.
   Two rows of the largest component need nothing. So every pair that shares
   a bucket is linked, in one component already, or verified not to link.

A pair at the threshold shares no bucket with probability
(1 - 0.75^ROWS)^BANDS, under 1e-7, and the signature bound loses less than
1e-6. Buckets, links and components stay distributed; each is partially
aggregated or joined to one row per key, so hot ones split. No bucket is
capped.

Defined cases. Under 5 words: the whole word sequence is the one shingle. No
words, empty or NULL text: the empty set, linked with nothing. NULL doc_id:
linked with nothing, its own group, kept. Rows with an equal doc_id are one
node that has all their sets; repeated rows are all returned. Empty table: no
rows. Very long texts are whole; memory follows the text. Other columns are
passed through by ``keep_first`` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .common import stored, unused
from .components import components
from .tokens import gather

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 64, 5
#: Signature bound: this many standard deviations below the threshold.
SLACK = 5.0
#: Rows on either side of a block in which late links are sought.
BLOCK = 1024
_CHUNK = 1 << 15

_rng = np.random.default_rng(5)
_A = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2)
_BITS = BANDS * ROWS
_WORDS = _BITS // 64


def agreement_bound(percent: int = PERCENT, slack: float = SLACK) -> int:
    """Most bits in which a pair at the threshold may differ."""
    p = (1 + percent / 100) / 2
    return int(_BITS * (1 - p) + slack * (_BITS * p * (1 - p)) ** 0.5)


def shingles(s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text: (text number, hash), by text."""
    low = tb.Slice.__new__(tb.Slice)
    low.n, low.offsets, low.lengths, low.buf = s.n, s.offsets, s.lengths, tb.LOWER[s.buf]
    start, end, doc = low.words()
    word = tb.span_hash(low.buf, start, end)
    n_words = low.count(doc)
    n = max(0, len(start) - SHINGLE + 1)
    at = np.flatnonzero(doc[:n] == doc[SHINGLE - 1:]) if n else np.zeros(0, np.int64)
    docs, hashes = [doc[at]], [tb.window_hash(word, SHINGLE)[at]]
    first = np.cumsum(n_words) - n_words
    for k in range(1, SHINGLE):  # shorter texts: the whole sequence
        short = np.flatnonzero(n_words == k)
        if len(short):
            h = np.full(len(short), k, np.uint64)
            for j in range(k):
                h = tb.mix(h ^ word[first[short] + j])
            docs.append(short)
            hashes.append(h)
    d, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def _minima(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Least a x + b of each run of ``h``, for every hash function."""
    out = np.empty((_BITS, len(offsets) - 1), np.uint64)
    out[:] = np.iinfo(np.uint64).max
    i = 0
    while i < len(offsets) - 1:  # runs in chunks that stay in cache
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _CHUNK, side="right")) - 1)
        x, cuts = h[offsets[i]:offsets[j]], offsets[i:j] - offsets[i]
        y = np.empty_like(x)
        for k in range(_BITS):
            np.multiply(x, _A[k], out=y)
            y += _B[k]
            out[k, i:j] = np.minimum.reduceat(y, cuts)
        i = j
    return out


SKETCH = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("n_shingles", T.LongType()), ("d1", T.LongType()), ("d2", T.LongType()),
    ("bands", T.ArrayType(T.LongType())), ("sig", T.ArrayType(T.LongType())))])


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, sig) per row; digest, bands and
    signature of the empty set are NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                doc, h = shingles(s)
                size = s.count(doc)
                has = np.flatnonzero(size)
                offsets = np.concatenate([[0], np.cumsum(size[has])])
                m = _minima(h, offsets)
                band = np.zeros((BANDS, len(has)), np.uint64)
                for r in range(ROWS):
                    band = tb.mix(band ^ m[r::ROWS])
                band += np.arange(BANDS, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
                bit = (tb.mix(m) & np.uint64(1)).reshape(_WORDS, 64, len(has))
                sig = (bit << np.arange(64, dtype=np.uint64)[None, :, None]).sum(1, dtype=np.uint64)
                total = lambda x: np.add.reduceat(x, offsets[:-1]) if len(has) else x
                d1, d2 = total(tb.mix(h)), total(tb.mix(h ^ np.uint64(0x5851F42D4C957F2D)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), _some(d1, has, s.n), _some(d2, has, s.n),
                     _lists(band, has, s.n), _lists(sig, has, s.n)], schema=_ARROW)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SKETCH)


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                    ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])


def _some(values: np.ndarray, has: np.ndarray, n: int) -> pa.Array:
    full, none = np.zeros(n, np.int64), np.ones(n, bool)
    full[has], none[has] = values.view(np.int64), False
    return pa.array(full, pa.int64(), mask=none)


def _lists(values: np.ndarray, has: np.ndarray, n: int) -> pa.Array:
    sizes, none = np.zeros(n, np.int64), np.ones(n, bool)
    sizes[has], none[has] = len(values), False
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.int32(), mask=np.append(none, False))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values.T).reshape(-1).view(np.int64), pa.int64()))


def verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose texts' full shingle sets are similar enough."""
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    both = (pairs.join(texts.withColumnsRenamed({"id": "u", "text": "t1"}), "u")
            .join(texts.withColumnsRenamed({"id": "v", "text": "t2"}), "v").select("u", "v", "t1", "t2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s1 in tb.bounded(batch, "t1"):
                for row, (d1, h1), (d2, h2) in _each(part, s1):
                    n1, n2 = np.bincount(d1, minlength=len(row)), np.bincount(d2, minlength=len(row))
                    key = np.concatenate([tb.keyed(d1, h1), tb.keyed(d2, h2)])
                    order = np.argsort(key)
                    twice = np.flatnonzero(key[order[1:]] == key[order[:-1]])
                    common = np.bincount(np.concatenate([d1, d2])[order[twice]], minlength=len(row))
                    union = n1 + n2 - common
                    ok = (union > 0) & (100 * common >= percent * union)
                    yield pa.RecordBatch.from_arrays(
                        [row.column(c).filter(pa.array(ok)) for c in ("u", "v")], names=["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def _each(part: pa.RecordBatch, s1: tb.Slice):
    """Both sides' shingles for rows whose second texts are bounded too."""
    for row, s2 in tb.bounded(part, "t2"):
        own = s1 if row.num_rows == part.num_rows else tb.Slice(row.column(row.schema.get_field_index("t1")))
        yield row, shingles(own), shingles(s2)


def _differing(a: str, b: str):
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, _WORDS)),
               F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _sets(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the texts of a table: (row, hash), by row."""
    docs, hashes, at = [], [], 0
    for batch in rows.select(["text"]).to_batches():
        for part, s in tb.bounded(batch, "text"):
            d, h = shingles(s)
            docs.append(d + at)
            hashes.append(h)
            at += part.num_rows
    return np.concatenate([np.zeros(0, np.int64), *docs]), np.concatenate([np.zeros(0, np.uint64), *hashes])


def late_links(members: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int, bound: int) -> DataFrame:
    """(u, v): links between rows of different components of the same k in
    (k, node, c, sig), but for pairs of which both are in component k."""
    queries = F.col("c") != F.col("k")
    blocks = members.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("j_n"),
                                      F.ceil(F.count(F.when(queries, 1)) / BLOCK).alias("i_n"))
    dealt = members.join(blocks, "k")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    left = dealt.filter(queries).select("k", own("i_n").alias("i"), every("j_n").alias("j"), "node", "c", "sig")
    right = dealt.select("k", every("i_n").alias("i"), own("j_n").alias("j"), "node", "c", "sig")
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        if a.num_rows and b.num_rows:
            column = lambda t, c: t.column(c).to_numpy()
            sigs = [np.asarray(t.column("sig").combine_chunks().flatten()).view(np.uint64).reshape(-1, _WORDS) for t in (a, b)]
            (da, ha), (db, hb) = _sets(a), _sets(b)
            na, nb = np.bincount(da, minlength=a.num_rows), np.bincount(db, minlength=b.num_rows)
            first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
            ua, ca, vb, cb = column(a, "node"), column(a, "c"), column(b, "node"), column(b, "c")
            for i in range(a.num_rows):
                differ = np.bitwise_count(sigs[0][i] ^ sigs[1]).sum(1, dtype=np.int64)
                near = np.flatnonzero((differ <= bound) & (cb != ca[i]))
                if not len(near):
                    continue
                at = gather(nb[near], first_b[near])
                mine = ha[first_a[i]:first_a[i] + na[i]]  # sorted
                place = np.minimum(np.searchsorted(mine, hb[at]), len(mine) - 1)
                common = np.bincount(np.repeat(np.arange(len(near)), nb[near]), weights=mine[place] == hb[at]).astype(np.int64)
                v = near[100 * common >= percent * (na[i] + nb[near] - common)]
                found.append(np.stack([np.full(len(v), ua[i]), vb[v]], 1))
        pairs = np.concatenate(found)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    key = ["k", "i", "j"]
    # fresh attributes: both sides come from the same rows
    a, b = (x.join(texts, "node").select(*[F.col(c).alias(c) for c in (*key, "node", "c", "sig", "text")]) for x in (left, right))
    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(compare, "u long, v long")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
           slack: float = SLACK) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    if not 75 <= percent <= 100:
        raise ValueError("the bands are made for 75 percent or more")
    rows = stored(sketch(docs, doc_id, text), "sketch")
    bound = agreement_bound(percent, slack)
    sets = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # one node per set; a doc_id with several sets is one node that has them all
    node = sets.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n"))
    nodes = sets.join(node, ["d1", "d2"]).filter("doc_id = node").select("node", "bands", "sig").dropDuplicates(["node", "bands"])
    nodes = stored(nodes, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    pivots = banded.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("top")).filter("pivot < top")
    buckets = stored(banded.join(pivots.select("band", "pivot"), "band"), "buckets")
    sig = nodes.select("node", "sig")

    def close(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sig.withColumnsRenamed({"node": "u", "sig": "s1"}), "u")
                .join(sig.withColumnsRenamed({"node": "v", "sig": "s2"}), "v")
                .filter(_differing("s1", "s2") <= bound).select("u", "v").distinct())

    star = buckets.filter("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    tested = stored(close(star), "pairs")
    links = stored(verified(tested, docs, doc_id, text, percent), "links")
    # a doc_id with several sets links their nodes
    owner = sets.join(node, ["d1", "d2"]).select("doc_id", "node")
    several = owner.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("top")).filter("v < top")
    links = links.unionByName(owner.join(several.select("doc_id", "v"), "doc_id")
                              .select(F.col("node").alias("u"), "v").filter("u <> v"))
    found = components(links)
    # buckets with several components: rows outside the largest against the others
    label = (buckets.join(found.withColumnRenamed("component", "c"), "node", "left")
             .select("band", "node", F.coalesce("c", "node").alias("c")))
    sizes = label.groupBy("band", "c").agg(F.count(F.lit(1)).alias("n"))
    mixed = (sizes.groupBy("band").agg(F.max_by("c", F.struct("n", "c")).alias("most"), F.count(F.lit(1)).alias("k"))
             .filter("k > 1").select("band", "most"))
    members = label.join(mixed, "band").select(F.col("most").alias("k"), "node", "c").distinct()
    members = stored(members.join(sig, "node"), "mixed")
    more = stored(late_links(members, docs, doc_id, text, percent, bound), "links")
    if not more.isEmpty():
        # contract: links between components already found
        of = found.withColumnsRenamed({"component": "c"})
        joined = (more.join(of.withColumnsRenamed({"node": "u", "c": "cu"}), "u", "left")
                  .join(of.withColumnsRenamed({"node": "v", "c": "cv"}), "v", "left")
                  .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
        top = components(joined)
        lone = joined.select(F.col("u").alias("node")).unionByName(joined.select(F.col("v").alias("node"))).distinct()
        every = found.unionByName(lone.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
        found = (every.join(top.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left")
                 .select("node", F.coalesce("c", "component").alias("component")))
    member = (rows.select("doc_id", "n_shingles", "d1", "d2").join(node.select("d1", "d2", "node"), ["d1", "d2"], "left")
              .join(found, "node", "left"))
    own = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "node", "doc_id"))
    return member.select("doc_id", "n_shingles", own.alias("component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    g = groups(docs, doc_id, text, **options)
    return g.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their group; of rows with an
    equal doc_id, all or none."""
    drop = stored(near_duplicates(docs, doc_id, text, **options).filter(~F.col("kept")).select(
        F.col("doc_id").alias(unused(docs.columns, "dropped"))).distinct(), "dropped")
    return docs.join(drop, docs[doc_id] == drop[drop.columns[0]], "left_anti")
