"""Operator 10: SentencePiece encoding and decoding by shared-prefix Viterbi.

Spaces become the mark U+2581 and one mark is put before the text; no other
normalisation. A text is cut before every mark that follows another
character. No piece of the vocabulary crosses such a place (checked on load),
so the marked words between cuts are encoded independently.

The distinct words of a block of texts are sorted, which lays them out as a
trie in depth-first order: what the forward pass holds for a word's first
characters is what it held for the common prefix with the word before it, and
only the rest is computed. Work follows trie nodes, not text length.

``kind`` says what the scores of the model file mean:

* ``unigram``: the path of highest total score (ties: the longest last piece).
* ``bpe``: scores order merges, and the highest sum is not what the library
  gives (about 1 word in 170 differs). The forward pass then keeps, per
  prefix, the last piece of the one valid path: a piece may follow the last
  piece of the prefix before it only if merging the two together leaves just
  these two. Exactly one path meets that, and it equals the library's merges.
  It depends on the prefix alone, so it is shared in the same way.

Characters outside the vocabulary become byte pieces. Blocks are bounded by
bytes, words by ``KEEP`` in a worker's table of coded words (emptied when
full; it changes speed only). There is no shuffle.

Decoding maps ids to pieces, joins bytes, turns marks to spaces and drops the
first one. Encoding then decoding gives the text back, except that a literal
U+2581 returns as a space.

Defined cases. NULL text: NULL ids and NULL text back. Empty text: no ids,
empty text back. Repeated rows and ties give equal results. A very long word
is one path, linear in its length. Empty table: no rows. Other columns are
passed through; on a name clash the new column gets a number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textbatch as tb
from .common import unused
from .tokens import Store, gather

MARK = "▁"
BLOCK_BYTES = 2 << 20
KEEP = 500_000
PAIRS = 200_000
_UNKNOWN = 10.0

_models: dict[tuple[str, str], "Pieces"] = {}


class Pieces:
    """Vocabulary of a model file, and the words coded so far."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece
        if kind not in ("bpe", "unigram"):
            raise ValueError("kind is bpe or unigram")
        self.kind = kind
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.text = [m.id_to_piece(i) for i in range(n)]
        special = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i) for i in range(n)]
        self.id_of = {p: i for i, p in enumerate(self.text) if not special[i]}
        crossing = [p for p in self.id_of if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross a word start: {crossing[:3]}")
        self.score = {p: m.get_score(i) for p, i in self.id_of.items()}
        self.unknown = min(self.score.values()) - _UNKNOWN
        self.bytes_id = {int(self.text[i][1:-1], 16): i for i in range(n) if m.is_byte(i)}
        # by the last two characters: piece lengths worth trying, longest first
        ends: dict[str, set[int]] = {}
        for p in self.id_of:
            if len(p) > 1:
                ends.setdefault(p[-2:], set()).add(len(p))
        self.ends = {e: sorted(s, reverse=True) for e, s in ends.items()}
        # what an id decodes to
        out = [b"" if special[i] else self.text[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in self.bytes_id.items():
            out[i] = bytes([b])
        self.unk_id = m.unk_id()
        self.sizes = np.array([len(x) for x in out], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        self.store = Store(KEEP)
        self.pairs: dict[int, bool] = {}

    def code(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of ``words`` (sorted, distinct)."""
        coded: dict[str, list[int]] = {}
        forward = self._best if self.kind == "unigram" else self._only
        state: list = [0.0]  # of each prefix: what the pass needs from it
        back = [0]           # of each prefix: the length of its last piece
        last = ""
        for w in words:
            k, m = 0, min(len(w), len(last))
            while k < m and w[k] == last[k]:
                k += 1
            del state[k + 1:], back[k + 1:]
            forward(w, k + 1, state, back)
            ids, e = [], len(w)
            while e:
                p = w[e - back[e]:e]
                i = self.id_of.get(p)
                if i is not None:
                    ids.append(i)
                elif self.bytes_id:
                    ids.extend(self.bytes_id[b] for b in reversed(p.encode()))
                else:
                    ids.append(self.unk_id)
                e -= back[e]
            ids.reverse()
            coded[w] = ids
            last = w
        return coded

    def _best(self, w: str, first: int, state: list, back: list) -> None:
        """Viterbi: the state of a prefix is its highest score."""
        score, ends, unknown = self.score, self.ends, self.unknown
        for e in range(first, len(w) + 1):
            top, by = state[e - 1] + score.get(w[e - 1], unknown), 1
            for size in ends.get(w[e - 2:e], ()) if e > 1 else ():
                if size <= e and (x := score.get(w[e - size:e])) is not None:
                    x += state[e - size]
                    if x > top or x == top and size > by:
                        top, by = x, size
            state.append(top)
            back.append(by)

    def _only(self, w: str, first: int, state: list, back: list) -> None:
        """The state of a prefix is the last piece of its only valid path."""
        id_of, ends, pairs = self.id_of, self.ends, self.pairs
        for e in range(first, len(w) + 1):
            for size in ends.get(w[e - 2:e], ()) if e > 1 else ():
                if size > e or (i := id_of.get(p := w[e - size:e])) is None:
                    continue
                if size == e:
                    ok = self._merged(p) == [p]
                else:
                    before = w[e - size - back[e - size]:e - size]
                    # an unknown character is told apart by its code, below 0
                    pair = (state[e - size] << 32) | i
                    ok = pairs.get(pair)
                    if ok is None:
                        ok = pairs[pair] = self._merged(before + p) == [before, p]
                if ok:
                    state.append(i)
                    back.append(size)
                    break
            else:
                state.append(id_of.get(w[e - 1], -1 - ord(w[e - 1])))
                back.append(1)

    def _merged(self, text: str) -> list[str]:
        """Characters merged pair by pair, best score first, then leftmost."""
        s, score = list(text), self.score
        while len(s) > 1:
            top, at = None, -1
            for i in range(len(s) - 1):
                x = score.get(s[i] + s[i + 1])
                if x is not None and (top is None or x > top):
                    top, at = x, i
            if at < 0:
                break
            s[at:at + 2] = [s[at] + s[at + 1]]
        return s

    def encode(self, s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if not len(s.buf):
            return np.zeros(0, np.int32), np.zeros(s.n, np.int64)
        space = s.buf == 32
        cut = np.empty(len(s.buf), bool)
        cut[0] = True
        mark_end = np.zeros(len(s.buf), bool)  # a literal mark is one run with the spaces after it
        mark_end[2:] = (s.buf[:-2] == 0xE2) & (s.buf[1:-1] == 0x96) & (s.buf[2:] == 0x81)
        cut[1:] = space[1:] & ~space[:-1] & ~mark_end[:-1]
        first = s.offsets[:-1][s.lengths > 0]
        cut[first] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(s.buf))
        at_start = np.zeros(len(s.buf), bool)
        at_start[first] = True
        lead = at_start[start]
        key = tb.span_hash(s.buf, start, end) ^ lead.astype(np.uint64)
        keys, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        new = self.store.missing(keys)
        if len(new):
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            raw = s.buf.tobytes()
            words = []
            for a, b, f in zip(start[at[new]].tolist(), end[at[new]].tolist(), lead[at[new]].tolist()):
                w = raw[a:b].decode().replace(" ", MARK)
                words.append(MARK + w if f else w)
            parts = [_split(w) for w in words]
            coded = self.code(sorted({p for ps in parts for p in ps}))
            lists = [coded[ps[0]] if len(ps) == 1 else [i for p in ps for i in coded[p]] for ps in parts]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.store.put(keys[new], sizes, np.fromiter((i for x in lists for i in x), np.int32, int(sizes.sum())))
        ids, each = self.store.get(keys, inverse)
        return ids, s.count(s.doc_of(start), each)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """Texts of ``n[i]`` ids each."""
        sizes = self.sizes[ids]
        data = self.bytes[gather(sizes, self.starts[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(n)]
        out, a = [], 0
        for b in ends.tolist():
            t = data[a:b].decode(errors="replace")
            out.append(t[1:] if t[:1] == " " else t)
            a = b
        return out


def _split(w: str) -> list[str]:
    """A word cut before marks that follow another character (a literal mark
    in the text can stand inside)."""
    if MARK not in w.lstrip(MARK):
        return [w]
    out, a = [], 0
    for i in range(1, len(w)):
        if w[i] == MARK and w[i - 1] != MARK:
            out.append(w[a:i])
            a = i
    return [*out, w[a:]]


def pieces(path: str, kind: str = "bpe") -> Pieces:
    if (path, kind) not in _models:
        _models[path, kind] = Pieces(path, kind)
    return _models[path, kind]


def _lists(ids: np.ndarray, n: np.ndarray, missing: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.int32(),
                       mask=np.append(missing, False))
    return pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "piece_ids", kind: str = "bpe",
           decoded: str | None = None) -> DataFrame:
    """``docs`` with an ``array<int>`` of piece ids appended, and, where a name
    is given, the text that they decode to (in the same pass)."""
    ids = unused(docs.columns, ids)
    new = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        decoded = unused([*docs.columns, ids], decoded)
        new.append(T.StructField(decoded, T.StringType()))
    schema = T.StructType([*docs.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_file, kind)
        for batch in batches:
            for part, s in tb.bounded(batch, text, BLOCK_BYTES):
                missing = np.asarray(pc.is_null(part.column(text)))
                found, n = model.encode(s)
                out = [_lists(found, n, missing)]
                if decoded:
                    out.append(pa.array(model.decode(found, n), pa.string(), mask=missing))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_file: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of its piece ids appended."""
    text = unused(rows.columns, text)
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_file)
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                lists = part.column(ids)
                n = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
                texts = model.decode(lists.flatten().to_numpy(zero_copy_only=False), n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string(), mask=np.asarray(pc.is_null(lists)))],
                    names=[*part.schema.names, text])

    return rows.mapInArrow(run, schema)
