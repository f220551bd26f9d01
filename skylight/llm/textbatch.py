"""Vectorised work on the texts of an Arrow batch.

A batch is cut into slices of bounded bytes (a single longer text is a slice
of its own); inside a slice all texts lie in one byte buffer, and words,
windows and hashes are numpy arrays over it. Memory follows the slice, not
the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: White space that separates words: space, tab, \n, \v, \f, \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Byte to byte, A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``range_hash`` reads the hash of any range."""
    up, _ = _power_tables(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[:len(buf)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes in each [start, end)."""
    _, down = _power_tables(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * _U(0x2545F4914F6CDD1D))


_TAIL = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes in each [start, end): every block of 8 bytes is
    mixed with its place before the blocks are added, so no algebra between
    texts carries over to their hashes. Up to 8 bytes, equal lengths never
    collide."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    words = np.ndarray(len(buf) + 1, "<u8", padded.data, strides=(1,))
    length = end - start
    blocks = np.maximum(1, (length + 7) >> 3)
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at = np.repeat(start, blocks) + 8 * place
    left = np.clip(np.repeat(end, blocks) - at, 0, 8)
    x = words[at] & _TAIL[left]
    h = np.add.reduceat(mix(x ^ mix(place.astype(np.uint64) + _U(0x632BE59BD9B4E019))), first)
    return mix(h + length.astype(np.uint64) * _U(0x2545F4914F6CDD1D))


def window_hash(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes, in order (length n - k + 1)."""
    n = max(0, len(word) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h ^ word[j:j + n]) * _U(0x9FB21C651E98DF25)
        h ^= h >> _U(29)
    return mix(h)


def keyed(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The hash made different for each text of the slice."""
    return mix(h + (doc.astype(np.uint64) + _U(1)) * _U(0xD1342543DE82EF95))


def repeated(key: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    flags = np.zeros(len(key), bool)
    if len(key) > 1:
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        flags[order[1:][same]] = True
        flags[order[:-1][same]] = True
    return flags


class Slice:
    """Texts ``offsets[i]:offsets[i+1]`` of ``buf``; NULL is the empty text."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        self.n = len(texts)
        off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + self.n + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.buf = raw[off[0]:off[-1]]
        self.offsets = off - off[0]
        self.lengths = np.diff(self.offsets)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        total = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def words(self, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each maximal run of other bytes."""
        n = len(self.buf)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, z
        inside = ~separator[self.buf]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        first = self.offsets[:-1]
        before[first[first < n]] = False
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        last = self.offsets[1:] - 1
        after[last[self.lengths > 0]] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        return start, end, self.doc_of(start)

    def count(self, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, weights=weights, minlength=self.n).astype(np.int64)


def bounded(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Slice]]:
    """The batch in runs of rows with at most ``limit`` text bytes each, or
    one row; the text's slice beside each run."""
    if not batch.num_rows:
        return
    at = batch.schema.get_field_index(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    row = 0
    while row < batch.num_rows:
        to = int(np.searchsorted(total, total[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), batch.num_rows)
        part = batch.slice(row, to - row)
        yield part, Slice(part.column(at))
        row = to
