"""Operator 4: exact substring dedup by a distributed merge sort of suffixes.

A byte goes when some ``LENGTH``-byte string that covers it also starts
anywhere else, in the same text or another. Sorting one suffix per byte would
move ``LENGTH`` bytes for each; instead the suffixes of *anchors* are sorted,
chosen so that nothing is lost.

Anchors. The anchor of a window of ``LENGTH`` bytes is its ``CORE``-byte
substring of least hash (leftmost on ties). It depends on the window's bytes
alone, so equal windows have their anchors at the same place. Each byte starts
one window; neighbouring windows mostly share an anchor, about one per
``(LENGTH - CORE) / 2`` bytes. A window is repeated only if its anchor's core
is, so anchors whose core occurs once are left out (a count by core hash; a
collision only keeps an anchor too many).

Exchange. What is left of an anchor is its suffix (from the anchor to the end
of its last window) and its left context (back to the start of its first
window). Tasks sort suffixes into runs, led by the core hash, which ranges
them evenly by its high bits; a run drops equal records (with their count)
and is front coded: each key sends the length of the prefix it shares with
the key before it and the rest.

Merge. A range's runs are combined by a loser tree that keeps, for every
contender, the length of its common prefix with the last winner: longer
shared prefixes win unseen, and only ties compare bytes, from that length on.
The lengths between neighbours of the merged order come out with it. With the
order of the reversed left contexts and its common prefix lengths, two
windows at distance d before their anchors are equal exactly if they agree in
the class of the suffix prefix of length LENGTH - d and in the class of the
left context of length d: classes are runs of the two orders, read off the
lengths. No hash decides a match.

Repeated windows return to the documents by the digest of the record they
were found in; a record's occurrences stay out of the merge, so thousands of
copies of one passage are one record per run there.

Bounds. A group is one range of core hashes: its records differ, its size is
set by ``spark.sql.shuffle.partitions``, with one exception. Where one core
stands in many different surroundings (the edges of a passage that many
documents share), its records meet in one range, about ``LENGTH`` + ``CORE``
bytes per different surrounding.

Defined cases. NULL or empty text and texts under ``LENGTH`` bytes: nothing
removed (NULL counts as empty). Rows equal in doc_id and text are separate
texts, so both lose what they share. NULL doc_id is a doc_id of its own.
Empty table: no rows. Very long texts are handled in overlapping chunks.
Other columns are not read. Cut bytes may split a character: what is kept is
bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .common import stored, text_key

LENGTH = 400
CORE = 200
#: Bytes of records that a task sorts into one run.
RUN_BYTES = 24 << 20
_CHUNK = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def _least_in_window(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(key) - width + 1
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(key)] = key
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).reshape(-1)
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def _anchors_of_chunk(buf: np.ndarray, starts: np.ndarray, length: int, core: int):
    """Anchors of the windows at ``starts`` (a mask over ``buf``)."""
    prefix = tb.prefix_hash(buf)
    _, down = tb._power_tables(len(prefix))
    grams = tb.mix((prefix[core:] - prefix[:-core]) * down[:len(buf) - core + 1])
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    at = (_least_in_window(key, length - core + 1) & _PLACE).astype(np.int64)
    p = np.flatnonzero(starts[:len(at)])
    a = at[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1 if len(p) else first
    a = a[first]
    return a, a - p[last], a - p[first], grams[a]


def anchors(s: tb.Slice, length: int = LENGTH, core: int = CORE):
    """Of each run of windows with one anchor: the text, the anchor's place in
    it, the least and largest distance from window start to anchor, and the
    core's hash."""
    n = len(s.buf)
    edge = np.zeros(n + 1, np.int32)
    long = s.lengths >= length
    edge[s.offsets[:-1][long]] += 1
    edge[s.offsets[1:][long] - length + 1] -= 1
    starts = np.cumsum(edge[:n]) > 0
    found = []
    for c in range(0, n, _CHUNK):
        buf, own = s.buf[c:c + _CHUNK + length - 1], starts[c:c + _CHUNK]
        if len(buf) >= length and own.any():
            a, low, high, h = _anchors_of_chunk(buf, own, length, core)
            found.append((a + c, low, high, h))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    a, low, high, h = (np.concatenate(x) for x in zip(*found))
    doc = s.doc_of(a)
    return doc, a - s.offsets[doc], low, high, h


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that ``known`` bytes agree."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs of (keys, shared prefix lengths with the key before).

    Yields (run, place in run, length shared with the key yielded before). A
    loser tree over the runs; each contender carries its common prefix length
    with the last winner it met, so known prefixes are never compared again.
    """
    k = len(runs)
    at = [0] * k
    shared = [0] * k
    size = 1
    while size < k:
        size *= 2
    loser = [-1] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser learns what it shares with the winner."""
        if b < 0:
            return a, b
        if a < 0:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = runs[a][0][at[a]], runs[b][0][at[b]]
        n = common_prefix(x, y, shared[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    level = [r if r < k and runs[r][0] else -1 for r in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            w, lost = play(level[i], level[i + 1])
            loser[node + i // 2] = lost
            up.append(w)
        level = up
    winner = level[0] if level else -1
    while winner >= 0:
        r = winner
        yield r, at[r], shared[r]
        at[r] += 1
        keys, lengths = runs[r]
        if at[r] < len(keys):
            shared[r] = lengths[at[r]]
            c = r
        else:
            c = -1
        n = (r + size) // 2
        while n:
            c, loser[n] = play(c, loser[n])
            n //= 2
        winner = c


def repeated_windows(keys: list[bytes], shared: np.ndarray, lefts: list[bytes], low: np.ndarray, high: np.ndarray,
                     copies: np.ndarray, length: int, core: int) -> np.ndarray:
    """For records in suffix order: which windows (by distance from window
    start to anchor) occur twice. ``shared``: suffix bytes in common with the
    record before."""
    n, widest = len(keys), length - core
    back = [x[::-1] for x in lefts]
    order = np.array(sorted(range(n), key=back.__getitem__), np.int64)
    left_shared = np.zeros(n, np.int64)
    for i in range(1, n):
        left_shared[i] = common_prefix(back[order[i]], back[order[i - 1]], 0)
    out = np.zeros((n, widest + 1), bool)
    left_class = np.zeros(n, np.int64)
    for d in range(widest + 1):
        own = np.flatnonzero((low <= d) & (high >= d))
        if not len(own):
            continue
        right = np.cumsum(shared < length - d)
        left_class[order] = np.cumsum(left_shared < d) if d else 0
        out[own, d] = tb.repeated(right[own] * (n + 1) + left_class[own]) | (copies[own] > 1)
    return out


RUN_SCHEMA = ("part int, run long, seq int, shared int, rest binary, back binary, low int, high int, n int, "
              "d1 long, d2 long")


def _records(part: pa.RecordBatch, length: int, core: int):
    """(row, place, key, left context, low, high) of each repeated anchor."""
    texts, marks = part.column("text"), part.column("marks")
    for i in range(part.num_rows):
        raw = texts[i].as_py().encode()
        whole = np.frombuffer(raw, np.uint8)
        m = np.sort(np.asarray(marks.slice(i, 1).flatten(), np.int64))
        place, low, high = m >> 20, (m >> 10) & 1023, m & 1023
        for a in range(0, len(place), 4096):
            p = place[a:a + 4096]
            base = int(p[0])
            prefix = tb.prefix_hash(whole[base:int(p[-1]) + core])
            h = tb.range_hash(prefix, p - base, p - base + core).astype(">u8").tobytes()
            for j, (x, lo, hi) in enumerate(zip(p.tolist(), low[a:a + 4096].tolist(), high[a:a + 4096].tolist())):
                yield i, x, h[8 * j:8 * j + 8] + raw[x:x - lo + length], raw[x - hi:x], lo, hi


def _digest(key: bytes, left: bytes, low: int, high: int) -> tuple[int, int]:
    d = hashlib.blake2b(key + left + low.to_bytes(2, "big") + high.to_bytes(2, "big"), digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _sorted_run(records: list, parts: int, run: int) -> pa.RecordBatch:
    """One front-coded run; equal records become one with their count."""
    records.sort()
    cols: list[list] = [[] for _ in range(11)]
    last_part, last, i = -1, b"", 0
    while i < len(records):
        r = records[i]
        n = 1
        while i + n < len(records) and records[i + n] == r:
            n += 1
        key, left, low, high = r
        part = int.from_bytes(key[:8], "big") * parts >> 64
        same = common_prefix(key, last, 0) if part == last_part else 0
        for c, v in zip(cols, (part, run, i, same, key[same:], left, low, high, n, *_digest(*r))):
            c.append(v)
        last_part, last = part, key
        i += n
    types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(),
             pa.int64(), pa.int64())
    names = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def covered(docs: DataFrame, length: int, core: int) -> DataFrame:
    """(doc_id, h, spans) of the texts of ``docs`` (doc_id, h, text) with
    repeated strings; spans are array<struct<a: long, b: long>>, unmerged."""
    if not 0 < core < length or length - core > 1000:
        raise ValueError("core must be positive and under length, by 1000 bytes at most")
    spark = docs.sparkSession

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                doc, place, low, high, h = anchors(s, length, core)
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), part.column("doc_id").take(rows), part.column("h").take(rows),
                     pa.array((place << 20) | (low << 10) | high)], names=["core", "doc_id", "h", "mark"])

    found = stored(docs.mapInArrow(find, "core long, doc_id long, h long, mark long"), "anchors")
    twice = found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core")
    marks = (found.join(twice, "core", "left_semi").groupBy("doc_id", "h").agg(F.collect_set("mark").alias("marks")))
    m = marks.select(F.col("doc_id").alias("m_id"), F.col("h").alias("m_h"), "marks")
    hit = docs.join(m, docs["doc_id"].eqNullSafe(m["m_id"]) & (docs["h"] == m["m_h"])).select("doc_id", "h", "text", "marks")
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, size, records = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for _, _, key, left, low, high in _records(batch, length, core):
                records.append((key, left, low, high))
                size += len(key) + len(left)
                if size >= RUN_BYTES:
                    yield _sorted_run(records, parts, run)
                    run, size, records = run + 1, 0, []
        if records:
            yield _sorted_run(records, parts, run)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, place, d1, d2 = [], [], [], []
                for i, x, *record in _records(part, length, core):
                    a, b = _digest(*record)
                    rows.append(i)
                    place.append(x)
                    d1.append(a)
                    d2.append(b)
                rows = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("h").take(rows), pa.array(place, pa.int64()),
                     pa.array(d1, pa.int64()), pa.array(d2, pa.int64())], names=["doc_id", "h", "place", "d1", "d2"])

    def combine(group: pa.Table) -> pa.Table:
        group = group.sort_by([("run", "ascending"), ("seq", "ascending")])
        col = {c: group.column(c).to_pylist() for c in ("run", "shared", "rest", "back", "low", "high", "n", "d1", "d2")}
        streams: list[tuple[list[bytes], list[int]]] = []
        first: list[int] = []
        last = b""
        for i, r in enumerate(col["run"]):
            if i == 0 or r != col["run"][i - 1]:
                streams.append(([], []))
                first.append(i)
                last = b""
            last = last[:col["shared"][i]] + col["rest"][i]
            streams[-1][0].append(last)
            streams[-1][1].append(col["shared"][i])
        keys, shared, at, copies = [], [], [], []
        equal: dict[tuple, int] = {}  # records of the last key
        for r, i, same in merge(streams):
            row, key = first[r] + i, streams[r][0][i]
            if not keys or same < len(key) or len(key) != len(keys[-1]):
                equal.clear()
            record = (col["back"][row], col["low"][row], col["high"][row])
            j = equal.setdefault(record, len(keys))
            if j < len(keys):  # the same record from another run
                copies[j] += col["n"][row]
                continue
            keys.append(key)
            shared.append(same)
            at.append(row)
            copies.append(col["n"][row])
        take = lambda c: [col[c][i] for i in at]
        low, high = np.array(take("low")), np.array(take("high"))
        # the core hash leads the key
        twice = repeated_windows(keys, np.array(shared) - 8, take("back"), low, high, np.array(copies), length, core)
        edge = np.diff(np.pad(twice, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        i0, d0 = np.nonzero(edge == 1)
        i1, d1 = np.nonzero(edge == -1)
        d1 -= 1  # windows at distances d0 .. d1 repeat
        ids = {c: np.array(take(c), np.int64) for c in ("d1", "d2")}
        return pa.table({"d1": ids["d1"][i0], "d2": ids["d2"][i0], "a": -d1.astype(np.int64), "b": length - d0.astype(np.int64)})

    spans = (hit.mapInArrow(runs, RUN_SCHEMA).groupBy("part")
             .applyInArrow(combine, "d1 long, d2 long, a long, b long"))
    placed = hit.mapInArrow(occurrences, "doc_id long, h long, place long, d1 long, d2 long").join(spans, ["d1", "d2"])
    return placed.groupBy("doc_id", "h").agg(F.collect_set(
        F.struct((F.col("place") + F.col("a")).alias("a"), (F.col("place") + F.col("b")).alias("b"))).alias("spans"))


def _cut(part: pa.RecordBatch):
    """Of each row: raw text and the mask of removed bytes."""
    texts, spans = part.column("text"), part.column("spans")
    for i in range(part.num_rows):
        raw = np.frombuffer((texts[i].as_py() or "").encode(), np.uint8)
        edge = np.zeros(len(raw) + 1, np.int64)
        if spans[i].is_valid:
            own = spans.slice(i, 1).flatten()
            np.add.at(edge, np.asarray(pc.struct_field(own, "a")), 1)
            np.subtract.at(edge, np.asarray(pc.struct_field(own, "b")), 1)
        yield raw, np.cumsum(edge[:-1]) > 0


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 core: int = CORE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row of
    ``docs``; ``kept`` is what is left of the text's bytes."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("h"), F.col(text).alias("text"))
    c = covered(d, length, core)
    c = c.select(F.col("doc_id").alias("c_id"), F.col("h").alias("c_h"), "spans")
    both = d.join(c, d["doc_id"].eqNullSafe(c["c_id"]) & (d["h"] == c["c_h"]), "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in tb.bounded(batch, "text", 8 << 20):
                rows: list[tuple] = []
                for raw, gone in _cut(part):
                    left = raw[~gone].tobytes()
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    rows.append((len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in cols[:3]), pa.array(cols[3], pa.string()),
                     pa.array(cols[4], pa.binary())], names=[f.split()[0] for f in OUT.split(", ")])

    return both.mapInArrow(cut, OUT)
