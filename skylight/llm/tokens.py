"""Operator 3: token ids as Parquet list columns, read back selectively.

``write_tokens`` ranges the documents by id, encodes each range and writes it
sorted. Two column families share one file set: metadata (``doc_id``,
``n_tokens``), delta encoded (format v2, dictionary off), and the list column
``ids``, whose encoding is a parameter: ``dictionary`` (small id sets) or
``delta`` (binary packed). Row groups and pages have set sizes, and the
writer adds column and offset indexes, so a reader that wants a few documents
or only the metadata skips the other pages.

Encoding: a text is cut before every white-space character that follows a
character that is not white space. The tokenizer's own splitter always starts
a new piece there, so the pieces encode independently; a worker encodes each
distinct piece once. Texts with white space beyond ASCII, or with the string
of one of the tokenizer's added tokens, are encoded whole.

``read_tokens`` reads the files: the start of each document comes from
per-file totals of the metadata column (one row per file) and running sums
within a file; checksums come from the ids read.

Defined cases. NULL or empty text: the end id alone. An added token's
string in a text gets that token's id, as the library gives it. Repeated rows and equal ids: each row is written; equal
ids are ordered by text hash. NULL ids come first. Empty table: no files, no
rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbatch as tb
from .common import new_folder, text_key

END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
ENCODE_SLICE = 1 << 20
FILE_SCHEMA = "doc_id long, ord long, n_tokens int, ids array<int>"

#: Unicode white space other than ASCII's (fixed values of the standard).
_OTHER_SPACE = re.compile("[\u0085   -     　]")

#: The first two bytes of each of them.
_OTHER_PAIRS = np.array(sorted({int.from_bytes(c.encode()[:2], "big") for c in map(chr, range(0x80, 0xD800)) if _OTHER_SPACE.match(c)}), np.int64)

#: Pieces a worker keeps coded (thinned when full; speed only), and pieces encoded in one string.
KEEP = 400_000
JOINED = 500

_tokenizers: dict[str, object] = {}
_coded: dict[str, "Coded"] = {}
_whole: dict[str, re.Pattern] = {}


def tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def whole_texts(path: str) -> re.Pattern:
    """What a text holds that must be encoded whole."""
    if path not in _whole:
        added = [re.escape(t.content) for t in tokenizer(path).get_added_tokens_decoder().values()]
        _whole[path] = re.compile("|".join([_OTHER_SPACE.pattern, *added]))
    return _whole[path]


def gather(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i] + 1, ... (lengths[i] of them), in a row."""
    end = np.cumsum(lengths)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(starts - (end - lengths), lengths)


class Store:
    """Lists of ids by 64-bit key: what a worker has coded so far."""

    def __init__(self, limit: int):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)

    def _thin(self) -> None:
        """Leave the keys that were met again since the last time, unless they
        are over half the limit."""
        kept = np.flatnonzero(self.again[self.slots])
        if len(kept) > self.limit // 2:
            return self._clear()
        keys, slot = self.keys[kept], self.slots[kept]
        sizes = self.sizes[slot]
        ids = self.ids[gather(sizes.astype(np.int64), self.starts[slot])]
        self._clear()
        self.put(keys, sizes, ids)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted ``keys`` are not held; a full store is thinned first."""
        if len(self.keys) > self.limit:
            self._thin()
        at = np.searchsorted(self.keys, keys)
        held = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        held[inside] = self.keys[at[inside]] == keys[inside]
        self.again[self.slots[at[held]]] = True
        return np.flatnonzero(~held)

    def put(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Add sorted ``keys`` with ``sizes`` ids each, in a row."""
        at = np.searchsorted(self.keys, keys)
        self.slots = np.insert(self.slots, at, np.arange(len(keys), dtype=np.int32) + len(self.starts))
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        self.again = np.concatenate([self.again, np.zeros(len(keys), bool)])

    def get(self, keys: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``keys[inverse]`` in a row, and how many each has."""
        slot = self.slots[np.searchsorted(self.keys, keys)][inverse]
        each = self.sizes[slot].astype(np.int64)
        return self.ids[gather(each, self.starts[slot])], each


class Coded:
    """A tokenizer and the pieces a worker has met."""

    def __init__(self, path: str):
        self.t = tokenizer(path)
        size = self.t.get_vocab_size()
        # byte-level alphabet: a token has one character per byte
        self.width = np.array([len(self.t.id_to_token(i) or "") for i in range(size)], np.int64)
        self.store = Store(KEEP)

    def add(self, keys: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Encode the pieces [start, end) of ``buf``. Those that start with
        white space and end with another character are encoded joined, since
        the splitter cuts between them, and told apart by their bytes; the
        others one by one."""
        joins = tb.SPACE[buf[start]] & ~tb.SPACE[buf[end - 1]]
        single, many = np.flatnonzero(~joins), np.flatnonzero(joins)
        wide = (end - start)[many]
        until = np.cumsum(wide)
        texts = [buf[x:y].tobytes().decode() for x, y in zip(start[single].tolist(), end[single].tolist())]
        row = buf[gather(wide, start[many])].tobytes()
        cuts = [0, *until[JOINED - 1::JOINED].tolist()]
        cuts += [len(row)] * (cuts[-1] < len(row))
        texts += [row[x:y].decode() for x, y in zip(cuts[:-1], cuts[1:])]
        # places of the tokens in the text are not asked for
        own = [np.array(e.ids, np.int32) for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.zeros(len(keys), np.int64)
        sizes[~joins] = [len(c) for c in own[:len(single)]]
        flat = np.concatenate([np.zeros(0, np.int32), *own])
        if len(many):
            joined = flat[sizes.sum():]
            sizes[joins] = np.diff(np.searchsorted(np.cumsum(self.width[joined]), until) + 1, prepend=0)
        order = np.concatenate([single, many])
        starts = np.zeros(len(keys), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        self.store.put(keys, sizes, flat[gather(sizes, starts)])


def encode_slice(path: str, s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each text has."""
    if not len(s.buf):
        return np.zeros(0, np.int32), np.zeros(s.n, np.int64)
    space = tb.SPACE[s.buf]
    cut = np.empty(len(s.buf), bool)
    cut[0] = True
    cut[1:] = space[1:] & ~space[:-1]
    cut[s.offsets[:-1][s.lengths > 0]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(s.buf))
    keys, at, inverse = np.unique(tb.span_hash(s.buf, start, end), return_index=True, return_inverse=True)
    if path not in _coded:
        _coded[path] = Coded(path)
    coded = _coded[path]
    new = coded.store.missing(keys)
    if len(new):
        coded.add(keys[new], s.buf, start[at[new]], end[at[new]])
    ids, each = coded.store.get(keys, inverse)
    return ids, s.count(s.doc_of(start), each)


def encode(path: str, part: pa.RecordBatch, column: str, s: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """``encode_slice`` with the texts that hold other white space or an added
    token's string encoded whole."""
    pattern = whole_texts(path)
    marks = {t.content.encode()[0] for t in tokenizer(path).get_added_tokens_decoder().values()}
    lead = np.flatnonzero(s.buf[:-1] >= 0xC2)
    may = np.zeros(len(s.buf), bool)
    may[lead[np.isin(s.buf[lead].astype(np.int64) << 8 | s.buf[lead + 1], _OTHER_PAIRS)]] = True
    for c in marks:
        may |= s.buf == c
    odd = [i for i in np.flatnonzero(s.per_text(may) > 0).tolist() if pattern.search(part.column(column)[i].as_py())]
    if odd:  # nothing of them goes to the coded pieces
        left = part.column(column).to_pylist()
        for i in odd:
            left[i] = None
        s = tb.Slice(pa.array(left, pa.string()))
    ids, n = encode_slice(path, s)
    if odd:
        texts = [part.column(column)[i].as_py() for i in odd]
        whole = {i: e.ids for i, e in zip(odd, tokenizer(path).encode_batch_fast(texts, add_special_tokens=False))}
        at = np.cumsum(n) - n
        pieces = [np.array(whole[i], np.int32) if i in whole else ids[at[i]:at[i] + n[i]] for i in range(s.n)]
        ids, n = np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
    return ids, n


def with_end(ids: np.ndarray, n: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(n), end_id).astype(np.int32), n + 1


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES,
                 page_bytes: int = PAGE_BYTES) -> None:
    """Write ``docs`` as token files at ``path``, ascending by ``doc_id``;
    ``ord`` is the row's place in its file."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("h"),
                       F.col(text).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            for part, s in tb.bounded(batch, "text", ENCODE_SLICE):
                ids, counts = with_end(*encode(tokenizer_file, part, "text", s), end_id)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.arange(at, at + s.n)), pa.array(counts, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["doc_id", "ord", "n_tokens", "ids"])
                at += s.n

    (ranged.mapInArrow(run, FILE_SCHEMA).write
     .option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
     .option("parquet.block.size", str(row_group_bytes)).option("parquet.page.size", str(page_bytes))
     .option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files;
    ``start`` counts the ids of all documents before it."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # files carry their range's number in their names, in id order
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    meta = files.select(number.alias("file"), "n_tokens")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = (meta.groupBy("file").agg(F.sum("n_tokens").alias("n"))
              .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start")))
    schema = "file long, ord long, doc_id long, n_tokens long, ids_crc32 long"

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4").view(np.uint8)
            ends = np.cumsum(np.asarray(pc.list_value_length(lists), np.int64)) * 4
            crc, a = [], 0
            for b in ends.tolist():
                crc.append(zlib.crc32(values[a:b]))
                a = b
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("ord"), batch.column("doc_id"),
                 batch.column("n_tokens").cast(pa.int64()), pa.array(crc, pa.int64())],
                names=["file", "ord", "doc_id", "n_tokens", "ids_crc32"])

    summed = files.select(number.alias("file"), "ord", "doc_id", "n_tokens", "ids").mapInArrow(checksums, schema)
    inside = Window.partitionBy("file").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return (summed.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(starts, "file")
            .select("doc_id", (F.col("file_start") + F.col("inside")).cast("long").alias("start"), "n_tokens",
                    "ids_crc32"))


def read_ids(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """(doc_id, ids) of a doc_id range: the filter reaches the page index."""
    return spark.read.schema(FILE_SCHEMA).parquet(path).filter(F.col("doc_id").between(low, high)).select("doc_id", "ids")


def token_files(docs: DataFrame, tokenizer_file: str, **options) -> DataFrame:
    """Write ``docs`` to a new folder and return ``read_tokens`` of it."""
    spark = docs.sparkSession
    path = new_folder(spark, "tokens")
    write_tokens(docs, path, tokenizer_file, **options)
    return read_tokens(spark, path)
