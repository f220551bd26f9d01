"""Operator 12: Jaccard join of word n-gram sets by token-combination prefixes.

A document is the set of its distinct 5-word shingles (tokens). Two sets link
when their Jaccard similarity is at least ``PERCENT`` / 100. Any such pair
shares at least k tokens among the first n - ceil(0.8 n) + k of either set, in
any order that all sets use.

1. ``light``: size and digest of every set; equal sets are one.
2. A filter on extended prefixes in hash order (free of counts): a set with a
   partner holds at least l tokens that another set holds too among its first
   n - ceil(0.8 n) + l, l = n / 20. A token held by one set only names that
   set (least = largest digest), so the count needs no join. Most sets end
   here.
3. The tokens of the others are counted and ordered from rare to frequent.
   The rare tokens (in at most ``RARE`` sets) of a set's plain prefix are
   indexed singly. If the first common token of a pair is frequent, so are all
   later ones: frequent tokens are indexed in combinations of ``COMBINE`` = k
   of one token class. A set of n tokens uses g classes (a power of two near
   n / 5; also the next one, if a partner may be in it) and a prefix extended
   to g (k - 1) + 1 common tokens, so that k of them fall in one class.
4. Verification, never all pairs of a bucket: each set with the least set of
   its buckets, first one candidate per set, then with ``PIVOTS`` sets of each
   bucket where they still lie in another component.
5. Buckets that hold several components may hide a link between them. Such
   buckets are gathered by their largest component; rows of other components
   there are held against all rows there in blocks of ``BLOCK`` rows or
   ``BLOCK_TOKENS`` tokens. A block counts the common tokens of all its pairs
   (products of 0/1 matrices for tokens in many of its rows, pair lists for
   the others), so nothing is guessed, and only a spanning forest of its links
   leaves it.

So a pair that links shares a bucket, and every pair that shares a bucket is
linked, in one component already, or too unlike. Nothing is capped.

Defined cases. Under 5 words: the whole word sequence is the one token. No
words, empty or NULL text: the empty set, linked with nothing. NULL doc_id:
linked with nothing, NULL component. Rows with an equal doc_id are one node
that has all their sets; repeated rows are all returned. Empty table: no rows.
Very long texts are whole; memory follows the text. Other columns are not read.
Sets are known by digests of 64-bit token hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .common import stored
from .components import components
from .tokens import gather

SHINGLE = 5
PERCENT = 80
#: Sets that hold a token which is indexed alone.
RARE = 16
#: Tokens of a combination.
COMBINE = 2
#: Rows, and tokens, on either side of a block in which late links are sought.
BLOCK = 2048
BLOCK_TOKENS = 1 << 21
#: A token that is common to more than 1 / DENSE of a block's pairs is a column
#: of a matrix product.
DENSE = 128
#: Sets of a bucket that every other one is held against.
PIVOTS = 4
#: A smaller set that is not equal to another one has no partner.
LEAST = 4
#: Bits a key in the bitmap of chosen rows, and at most (its size only decides
#: how many rows are shuffled in vain).
MAP_BITS = 16
MOST_BITS = 1 << 28
_CHUNK = 1 << 20


def needed(n, percent: int = PERCENT):
    """Least number of tokens that a set of n shares with a partner."""
    return -(-percent * n // 100)


def shingles(s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of every text of a slice: (text number, hash), by text,
    hashes ascending."""
    low = tb.LOWER[s.buf]
    inside = tb.Slice.__new__(tb.Slice)
    inside.n, inside.offsets, inside.lengths, inside.buf = s.n, s.offsets, s.lengths, low
    start, end, doc = inside.words()
    word = tb.span_hash(low, start, end)
    n_words = inside.count(doc)
    docs, hashes = [], []
    n = max(0, len(word) - SHINGLE + 1)
    at = np.flatnonzero(doc[:n] == doc[SHINGLE - 1:]) if n else np.zeros(0, np.int64)
    docs.append(doc[at])
    hashes.append(tb.window_hash(word, SHINGLE)[at])
    first = np.cumsum(n_words) - n_words
    for k in range(1, SHINGLE):  # texts of fewer words: all of them are one token
        short = np.flatnonzero(n_words == k)
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


def _sets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def _digest(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.add.reduceat(tb.mix(h ^ np.uint64(0x2545F4914F6CDD1D)), offsets[:-1]).view(np.int64) if len(h) else np.zeros(0, np.int64)


def light(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, s) per row; s is the set's digest, NULL if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                doc, h = shingles(s)
                size = s.count(doc)
                has = size > 0
                full = np.zeros(s.n, np.int64)
                full[has] = _digest(h, np.concatenate([[0], np.cumsum(size[has])]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(full, mask=~has)],
                                                 names=["doc_id", "n_shingles", "s"])

    return _sets(docs, doc_id, text).mapInArrow(run, "doc_id long, n_shingles long, s long")


def _spare(n):
    """Common tokens that the filter of step 2 asks for."""
    return n // 20 + 1


def partnered(docs: DataFrame, sets: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """Those of ``sets`` (s, n, doc) that may have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                doc, h = shingles(s)
                size = s.count(doc)
                has = size > 0
                digest = np.zeros(s.n, np.int64)
                first = np.cumsum(size) - size
                digest[has] = _digest(h, np.concatenate([[0], np.cumsum(size[has])]))
                place = np.arange(len(h)) - first[doc]
                n = size[doc]
                at = np.flatnonzero((n >= LEAST) & (place < n - needed(n, percent) + _spare(n)))
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(digest[doc[at]])], names=["token", "s"])

    tokens = _sets(docs.filter(F.col(doc_id).isNotNull()), doc_id, text).mapInArrow(run, "token long, s long")
    alone = (tokens.groupBy("token").agg(F.min("s").alias("s"), F.max("s").alias("top")).filter("s = top")
             .groupBy("s").agg(F.count(F.lit(1)).alias("alone")))
    seen = F.least(F.col("n"), F.expr(f"n - cast(ceil({percent} * n / 100) as long) + n div 20 + 1"))
    return (sets.filter(F.col("n") >= LEAST).join(alone, "s", "left")
            .filter(seen - F.coalesce("alone", F.lit(0)) >= F.expr("n div 20 + 1")).select("s", "n", "doc"))


def among(rows: DataFrame, key: str, some: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is no key of ``some``, by a
    broadcast bitmap of hashes (``MAP_BITS`` bits a key, ``MOST_BITS`` in all):
    rows that a join would drop stay out of its shuffle. None that it keeps is lost."""
    size = min(MOST_BITS, max(1 << 15, MAP_BITS * some.count()))
    at = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(size))
    maps = (some.select(at.alias("__at")).withColumn("__map", F.expr("__at div 32768")).repartition("__map")
            .groupBy("__map").agg(F.expr("bitmap_construct_agg(__at % 32768)").alias("__bits")))
    byte = F.expr("cast(conv(hex(substring(__bits, cast(__at % 32768 div 8 as int) + 1, 1)), 16, 10) as int)")
    return (rows.withColumn("__at", at).withColumn("__map", F.expr("__at div 32768")).join(F.broadcast(maps), "__map")
            .filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(__at % 8 as int))")) != 0).select(*rows.columns))


def token_lists(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(s, n, tokens) of the chosen sets; tokens ascend."""
    want = chosen.select("s", F.col("doc").alias("doc_id"))
    texts = among(_sets(docs, doc_id, text), "doc_id", want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                doc, h = shingles(s)
                size = s.count(doc)
                has = np.flatnonzero(size)
                if not len(has):
                    continue
                offsets = np.concatenate([[0], np.cumsum(size[has])])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(has)), pa.array(_digest(h, offsets)),
                                                  pa.array(size[has], pa.int64()), lists], names=["doc_id", "s", "n", "tokens"])

    # a doc_id may have other sets than the one asked for, and that one several times;
    # the join and the distinct rows share one shuffle, of token lists, not of texts
    lists = among(texts.mapInArrow(run, "doc_id long, s long, n long, tokens array<long>"), "s", want)
    return lists.join(want, ["s", "doc_id"]).dropDuplicates(["s", "doc_id"]).select("s", "n", "tokens")


def _classes(n: int, percent: int) -> list[int]:
    """log2 of the class counts under which a set of n tokens is indexed: its
    own, and the next one if a partner may have it."""
    own = max(0, (n // 5).bit_length() - 1)
    most = max(0, (n * 100 // percent // 5).bit_length() - 1)
    return list(range(own, most + 1))


def index_keys(n: int, count: np.ndarray, token: np.ndarray, percent: int = PERCENT, rare: int = RARE, k: int = COMBINE) -> np.ndarray:
    """Index keys of a set of n tokens, of which ``token`` are in ``count`` sets
    (two or more each); its other tokens are its own and come first."""
    order = np.lexsort((token, count))
    token, count = token[order], count[order]
    plain = n - needed(n, percent) + 1 - (n - len(token))
    keys = [tb.mix(token[:max(0, plain)][count[:max(0, plain)] <= rare])]
    for e in _classes(n, percent):
        reach = plain + (1 << e) * (k - 1)
        often = token[:max(0, reach)][count[:max(0, reach)] > rare]
        cls = tb.mix(often) >> np.uint64(64 - e) if e else np.zeros(len(often), np.uint64)
        by = np.lexsort((often, cls))
        often, cls = often[by], cls[by]
        last, key = np.arange(len(often)), tb.mix(often ^ np.uint64(e + 1))
        for _ in range(k - 1):  # every combination is extended by later tokens of its class
            lasts, longer, step = [], [], 1
            ok = np.arange(len(last))
            while True:
                ok = ok[last[ok] + step < len(often)]
                ok = ok[cls[last[ok] + step] == cls[last[ok]]]
                if not len(ok):
                    break
                lasts.append(last[ok] + step)
                longer.append(tb.mix(key[ok] * np.uint64(0x9FB21C651E98DF25) + often[last[ok] + step]))
                step += 1
            last = np.concatenate([np.zeros(0, np.int64), *lasts])
            key = np.concatenate([np.zeros(0, np.uint64), *longer])
        keys.append(key)
    return np.unique(np.concatenate(keys))


def buckets(nodes: DataFrame, percent: int, rare: int, k: int) -> DataFrame:
    """(key, s, n) rows of the prefix index, keys of one row left out."""
    tokens = nodes.select("s", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    shared = (tokens.join(often, "token").groupBy("s").agg(F.collect_list(F.struct("count", "token")).alias("x"))
              .join(nodes.select("s", "n"), "s").filter(F.size("x") >= F.expr(f"ceil({percent} * n / 100)"))
              .select("s", "n", F.col("x.count").alias("counts"), F.col("x.token").alias("tokens")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, n = (batch.column(c).to_numpy() for c in ("s", "n"))
            counts, tokens = batch.column("counts"), batch.column("tokens")
            found, first, held = [], 0, 0
            for i in range(batch.num_rows):
                found.append(index_keys(int(n[i]), counts[i].values.to_numpy(), tokens[i].values.to_numpy().view(np.uint64), percent, rare, k))
                held += len(found[-1])
                if held > _CHUNK or i == batch.num_rows - 1:
                    sizes = np.array([len(x) for x in found], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(s[first:i + 1], sizes)),
                                                      pa.array(np.repeat(n[first:i + 1], sizes))], names=["key", "s", "n"])
                    found, first, held = [], i + 1, 0

    rows = stored(shared.mapInArrow(run, "key long, s long, n long"), "index")
    mixed = [F.min_by("s", F.xxhash64(F.lit(seed), "s")).alias(f"pivot{seed}") for seed in range(1, PIVOTS)]
    several = rows.groupBy("key").agg(F.min("s").alias("pivot"), F.max("s").alias("top"), *mixed).filter("pivot < top").drop("top")
    return rows.join(several, "key")


def verified(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough."""
    lists = nodes.select("s", "n", "tokens")
    near = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    sizes = nodes.select("s", "n")
    fit = (pairs.join(sizes.withColumnsRenamed({"s": "u", "n": "n1"}), "u").join(sizes.withColumnsRenamed({"s": "v", "n": "n2"}), "v")
           .filter(near(F.col("n1"), F.col("n2"))).select("u", "v"))
    both = (fit.join(lists.select(F.col("s").alias("u"), F.col("tokens").alias("t1")), "u")
            .join(lists.select(F.col("s").alias("v"), F.col("tokens").alias("t2")), "v").select("u", "v", "t1", "t2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch.column("t1"), batch.column("t2")
            total = np.cumsum(np.asarray(t1.value_lengths()) + np.asarray(t2.value_lengths()))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _CHUNK, side="right")))
                a, b = t1.slice(at, to - at), t2.slice(at, to - at)
                n1, n2 = np.asarray(a.value_lengths()), np.asarray(b.value_lengths())
                row = np.concatenate([np.repeat(np.arange(len(n1)), n1), np.repeat(np.arange(len(n2)), n2)])
                token = np.concatenate([a.flatten().to_numpy(), b.flatten().to_numpy()])
                order = np.lexsort((token, row))
                row, token = row[order], token[order]
                twice = (token[1:] == token[:-1]) & (row[1:] == row[:-1])
                common = np.bincount(row[1:][twice], minlength=len(n1))
                ok = pa.array(100 * common >= percent * (n1 + n2 - common))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, to - at).filter(ok) for c in ("u", "v")], names=["u", "v"])
                at = to

    return both.mapInArrow(run, "u long, v long")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    of = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    return (pairs.join(of("u"), "u", "left").join(of("v"), "v", "left")
            .filter(F.coalesce("c_u", "u") != F.coalesce("c_v", "v")).select("u", "v"))


def common_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Common tokens of every row of ``a`` with every row of ``b``; a side is
    the tokens of its rows in a row, and how many each row has (one at least).
    Exact while a set has under 2^24 tokens that are common."""
    (ta, na), (tb_, nb) = a, b
    shared = np.intersect1d(ta, tb_)
    sides = []
    for t, n in (a, b):
        at = np.minimum(np.searchsorted(shared, t), max(0, len(shared) - 1))
        ok = np.flatnonzero(shared[at] == t) if len(shared) else np.zeros(0, np.int64)
        at, row = at[ok], np.repeat(np.arange(len(n)), n)[ok]
        by = np.argsort(at, kind="stable")
        size = np.bincount(at, minlength=len(shared))
        sides.append((row[by], size, np.cumsum(size) - size))
    (ra, sa, fa), (rb, sb, fb) = sides
    out = np.zeros((len(na), len(nb)), np.float32)
    often = sa * sb * DENSE > out.size
    dense = np.flatnonzero(often)
    for i in range(0, len(dense), BLOCK):
        part = dense[i:i + BLOCK]
        of = []
        for row, size, first, rows in ((ra, sa, fa, len(na)), (rb, sb, fb, len(nb))):
            m = np.zeros((rows, len(part)), np.float32)
            m[row[gather(size[part], first[part])], np.repeat(np.arange(len(part)), size[part])] = 1
            of.append(m)
        out += of[0] @ of[1].T
    few = np.flatnonzero(~often)
    total = np.cumsum(sa[few] * sb[few])
    at = 0
    while at < len(few):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 4 * _CHUNK, side="right")))
        part = few[at:to]
        left = gather(sa[part], fa[part])  # places of the rows of a, each against its token's rows of b
        each = np.repeat(sb[part], sa[part])
        right = gather(each, np.repeat(fb[part], sa[part]))
        out += np.bincount(np.repeat(ra[left], each) * len(nb) + rb[right], minlength=out.size).reshape(out.shape)
        at = to
    return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of links of a block that hold together what all its
    links do: a spanning forest, under one link per row and column."""
    rows, cols = np.zeros(linked.shape[0], bool), np.zeros(linked.shape[1], bool)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i in np.flatnonzero(linked.any(1)):
        front = np.array([] if rows[i] else [i], np.int64)
        rows[i] = True
        while len(front):
            new = np.flatnonzero(linked[front].any(0) & ~cols)
            cols[new] = True
            found.append((front[linked[np.ix_(front, new)].argmax(0)] if len(new) else new, new))
            front = np.flatnonzero(linked[:, new].any(1) & ~rows)
            rows[front] = True
            found.append((front, new[linked[np.ix_(front, new)].argmax(1)] if len(front) else front))
    return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def late_links(rows: DataFrame, label: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(u, v): links that join all different components of which two sets that
    link share a bucket of ``rows``."""
    named = (rows.select("key", "s", "n").join(label.select(F.col("node").alias("s"), F.col("component").alias("c")), "s", "left")
             .withColumn("c", F.coalesce("c", "s")))
    per = named.groupBy("key", "c").agg(F.count(F.lit(1)).alias("rows"))
    mixed = (per.groupBy("key").agg(F.max_by("c", F.struct("rows", "c")).alias("k"), F.count(F.lit(1)).alias("parts"))
             .filter("parts > 1").select("key", "k"))
    members = stored(named.join(mixed, "key").select("k", "s", "c", "n").distinct(), "mixed")
    query = F.col("c") != F.col("k")
    parts = lambda rows, tokens: F.greatest(F.ceil(rows / BLOCK), F.ceil(tokens / BLOCK_TOKENS)).cast("int")
    blocks = members.groupBy("k").agg(parts(F.count(F.lit(1)), F.sum("n")).alias("j_n"),
                                      parts(F.count(F.when(query, 1)), F.sum(F.when(query, F.col("n")))).alias("i_n"))
    dealt = members.join(blocks, "k")
    own = lambda n: F.pmod(F.xxhash64("s"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.filter(query).select("k", own("i_n").alias("i"), every("j_n").alias("j"), "s", "c")
    right = dealt.select("k", every("i_n").alias("i"), own("j_n").alias("j"), "s", "c")
    key = ["k", "i", "j"]
    # fresh attributes: both sides come from the same rows
    a, b = (x.join(nodes.select("s", "tokens"), "s").select(*[F.col(c).alias(c) for c in (*key, "s", "c", "tokens")]) for x in (left, right))

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        u = v = np.zeros(0, np.int64)
        if a.num_rows and b.num_rows:
            lists = [t.column("tokens").combine_chunks() for t in (a, b)]
            sets = [(x.flatten().to_numpy(), np.asarray(x.value_lengths(), np.int64)) for x in lists]
            n = sets[0][1][:, None] + sets[1][1][None, :]
            linked = common_counts(*sets) >= -(-percent * n // (100 + percent))
            linked &= a.column("c").to_numpy()[:, None] != b.column("c").to_numpy()[None, :]
            i, j = forest(linked)
            u, v = a.column("s").to_numpy()[i], b.column("s").to_numpy()[j]
        return pa.table({"u": u, "v": v})

    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(compare, "u long, v long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, rare: int = RARE, k: int = COMBINE) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    if not 50 <= percent <= 100:
        raise ValueError("prefixes are made for 50 to 100 percent")
    rows = stored(light(docs, doc_id, text), "sets")
    sets = rows.filter("doc_id IS NOT NULL AND s IS NOT NULL").groupBy("s").agg(
        F.max("n_shingles").alias("n"), F.min("doc_id").alias("doc"))
    sets = stored(sets, "distinct")
    chosen = stored(partnered(docs, sets, doc_id, text, percent), "partnered")
    nodes = stored(token_lists(docs, chosen, doc_id, text), "lists")
    index = stored(buckets(nodes, percent, rare, k), "buckets")
    # stars, one candidate per set first
    star = index.filter("s <> pivot").select(F.col("s").alias("u"), F.col("pivot").alias("v"))
    links = stored(verified(star.groupBy("u").agg(F.min("v").alias("v")), nodes, percent), "links")
    # a doc_id with several sets links them
    own = rows.filter("doc_id IS NOT NULL AND s IS NOT NULL")
    several = own.groupBy("doc_id").agg(F.min("s").alias("v"), F.max("s").alias("top")).filter("v < top").select("doc_id", "v")
    links = links.unionByName(own.join(several, "doc_id").select(F.col("s").alias("u"), "v").filter("u <> v"))
    label = components(links)
    # then the other pivots of its buckets, where they lie in another component
    stars = index.select(F.col("s").alias("u"), F.explode(F.array("pivot", *[f"pivot{seed}" for seed in range(1, PIVOTS)])).alias("v")).filter("u <> v")
    more = stored(verified(_apart(stars.distinct(), label), nodes, percent), "links")
    links = links.unionByName(more)
    if not more.isEmpty():
        label = components(links)
    late = stored(late_links(index, label, nodes, percent), "links")
    if not late.isEmpty():
        label = components(links.unionByName(late))
    group = (sets.join(label.select(F.col("node").alias("s"), "component"), "s", "left")
             .select("s", "doc", F.coalesce("component", "s").alias("component")))
    least = group.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = group.join(least, "component").select("s", "component_id")
    return rows.join(named, "s", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
