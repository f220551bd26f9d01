"""Operator 6: benchmark decontamination by template windows.

Words are made canonical (case folded for ASCII and Latin-1, punctuation at
their ends stripped) and replaced by typed placeholders where a question may
be re-parameterised: a word that starts with a digit is a number, and so are
number words (neighbours together one number), a unit word after a number is a
unit, and capitalised words inside a sentence are a name (neighbours together
one name). The first word of a sentence may be a name or not, so there are two
readings of each text, one with all capitalised first words as names and one
with none; windows match within a reading. Windows of ``WINDOW`` template words are
hash-joined with the windows of all benchmark items; a window needs
``LITERALS`` words that are no placeholders.

Exact items. An item without a full window of that kind (short questions,
arithmetic, items in capitals), and one in a script without spaces, is also
looked for as it stands: as its whole sequence of tokens (words, and every
symbol and every character of three or four bytes by itself; symbols at the
end go unless a digit is before them). Its first and its last 2^k tokens,
which cover it, are hash-joined like windows, and both must match at one
alignment. Case is folded from ``LITERALS`` tokens on; under that it counts.

Slot consistency: matches of one document and item at one alignment count
only if each slot value of the item is always the same value of the document
(two values of the item may become one). A question with new numbers and names
passes; a text that merely shares its frame with changing fillers does not.

A document is contaminated when consistent windows of a reading cover
``SHARE`` of an item's windows, or ``RUN`` windows match at one alignment, or an exact item
stands in it.

Scale. The documents are read once. A bitmap of the benchmark's window
hashes, of the fixed size ``FILTER_BITS``, goes to the tasks, and only
windows that hit it leave them; it decides nothing, as the join follows.
Matches are grouped by (document, item), so an item found in a third of all
documents is no hot group.

Defined cases. NULL or empty texts match nothing. An item under ``WINDOW``
words is one window of all its words, if it has ``LITERALS`` literals, and an
exact item. An item of one word is found in every text with that word. Items equal as templates are all reported. Repeated documents are
all flagged. Empty tables: no rows, or nothing contaminated. NULL ids are
carried as they are. Very long texts are whole. Other columns are passed
through by ``drop_contaminated`` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .common import stored, text_key, unused

WINDOW = 8
LITERALS = 5
SHARE = 0.5
RUN = 6
FILTER_BITS = 1 << 22

#: Unit words (fixed values).
UNITS = ("percent % km kilometers kilometres kilometer m meters metres meter cm mm mile miles ft feet foot inch inches yard "
         "yards kg kilograms kilogram g grams gram mg lb lbs pound pounds oz ounce ounces ton tons l liter liters litre "
         "litres ml gallon gallons second seconds sec s minute minutes min hour hours h day days week weeks month months "
         "year years dollar dollars usd euro euros eur cent cents mph kmh degrees degree celsius fahrenheit watt watts "
         "volt volts newton newtons joule joules hz mb gb tb").split()

_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
#: Number words (fixed values).
NUMBERS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
           "eighteen nineteen hundred thousand million billion trillion dozen").split() + _TENS + [
               f"{a}-{b}" for a in _TENS for b in "one two three four five six seven eight nine".split()]

_LETTER_OR_DIGIT = np.zeros(256, bool)
_LETTER_OR_DIGIT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:128] = ~_LETTER_OR_DIGIT[33:128]
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _fold(buf: np.ndarray) -> np.ndarray:
    out = tb.LOWER[buf]
    if len(buf) > 1:  # U+00C0..U+00DE but U+00D7 are C3 80..C3 9E
        upper = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        out[1:][upper] += 0x20
    return out


def _word_hashes(words: list[str]) -> np.ndarray:
    s = tb.Slice(pa.array([" ".join(words)]))
    start, end, _ = s.words()
    return np.sort(tb.range_hash(tb.prefix_hash(s.buf), start, end)) | np.uint64(1)


def template(s: tb.Slice) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each reading: its way, and text number, template hash and slot value
    (0: literal) of each word."""
    start, end, _ = s.words()
    solid = np.flatnonzero(_LETTER_OR_DIGIT[s.buf])
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    has = b > a
    start, end, a, b = start[has], end[has], a[has], b[has]
    first, last = solid[a], solid[b - 1] + 1
    doc = s.doc_of(first)
    h = tb.range_hash(tb.prefix_hash(_fold(s.buf)), first, last) | np.uint64(1)
    digits = _DIGIT[s.buf[first]]
    spelt = ~digits & np.isin(h, _word_hashes(NUMBERS))
    number = digits | spelt
    same_doc = np.zeros(len(doc), bool)
    same_doc[1:] = doc[1:] == doc[:-1]
    after_number = np.zeros(len(doc), bool)
    after_number[1:] = number[:-1] & same_doc[1:]
    unit = ~number & after_number & np.isin(h, _word_hashes([u for u in UNITS if u != "%"]))
    breaks = np.concatenate([[0], np.cumsum(s.buf == 10)])
    inside = np.zeros(len(doc), bool)  # of a sentence
    inside[1:] = same_doc[1:] & ~_STOP[s.buf[end[:-1] - 1]] & (breaks[start[1:]] == breaks[end[:-1]])
    c0 = s.buf[first]
    c1 = s.buf[np.minimum(first + 1, len(s.buf) - 1)] if len(s.buf) else c0
    capital = ((c0 >= 65) & (c0 <= 90)) | ((c0 == 0xC3) & (c1 >= 0x80) & (c1 <= 0x9E) & (c1 != 0x97))
    further = np.zeros(len(doc), bool)  # a number's further words
    further[1:] = spelt[1:] & number[:-1] & inside[1:] & (last[:-1] == end[:-1])
    for way in (TEMPLATE, NAMED):
        name = capital & ~unit & ~number & (inside if way == TEMPLATE else True)
        code, slot = h.copy(), np.zeros(len(h), np.uint64)
        for mask, mark in ((number, _NUMBER), (unit, _UNIT), (name, _NAME)):
            code[mask] = mark
            slot[mask] = h[mask]
        follows = further.copy()  # with a name's further words
        follows[1:] |= name[1:] & name[:-1] & inside[1:]
        own = doc
        if follows.any():
            head = np.flatnonzero(~follows)
            slot = np.add.reduceat(slot * np.where(follows, np.uint64(0x9FB21C651E98DF25), np.uint64(1)), head)
            own, code = doc[head], code[head]
        yield way, own, code, slot


#: Kinds of rows: template windows without and with names at the start of
#: sentences, and tokens with case folded or kept.
TEMPLATE, NAMED, FOLDED, RAW = 0, 1, 2, 3


def windows(doc: np.ndarray, code: np.ndarray, slot: np.ndarray, size: int, way: int = TEMPLATE) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the windows of ``size`` words with enough
    literals and inside one text."""
    n = len(code) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    literals = np.concatenate([[0], np.cumsum(slot == 0)])
    at = np.flatnonzero((doc[:n] == doc[size - 1:]) & (literals[size:] - literals[:n] >= min(size, LITERALS)))
    return at, tb.window_hash(code, size)[at] ^ np.uint64(way << 32 | size)


def tokens(s: tb.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the tokens of exact items."""
    n = len(s.buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    later = (s.buf >= 0x80) & (s.buf < 0xC0)  # bytes of a character after its first
    wide = s.buf[np.maximum.accumulate(np.where(later, 0, np.arange(n)))] >= 0xE0
    word = _LETTER_OR_DIGIT[s.buf] & ~wide
    goes_on = wide & later
    goes_on[1:] |= word[1:] & word[:-1]
    goes_on[s.offsets[:-1][s.lengths > 0]] = False
    solid = ~tb.SPACE[s.buf]
    start = np.flatnonzero(solid & ~goes_on)
    end = np.flatnonzero(solid & ~np.append(goes_on[1:], False)) + 1
    return start, end, s.doc_of(start)


def token_windows(s: tb.Slice, start: np.ndarray, end: np.ndarray, way: int, sizes: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hash of each run of so many tokens) for the ``sizes``, powers of two."""
    h = tb.range_hash(tb.prefix_hash(_fold(s.buf) if way == FOLDED else s.buf), start, end)
    size, most = 1, max(sizes, default=0)
    while size <= most and len(h):
        if size in sizes:
            yield size, tb.mix(h ^ np.uint64(way << 32 | size))
        h = tb.mix(h[:-size] * np.uint64(0x9FB21C651E98DF25) + h[size:])
        size *= 2


def _exact_windows(s: tb.Slice, wanted: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(way, size, first tokens, hashes, text of each token) of the ``wanted`` texts as exact items."""
    start, end, doc = tokens(s)
    first = np.searchsorted(doc, np.arange(s.n + 1))
    symbol = _SYMBOL[s.buf[start]] if len(start) else np.zeros(0, bool)
    picked: dict[tuple[int, int], list[int]] = {}
    for i in np.flatnonzero(wanted).tolist():
        a, b = int(first[i]), int(first[i + 1])
        solid = np.flatnonzero(~symbol[a:b])
        if len(solid) and not _DIGIT[s.buf[end[a + solid[-1]] - 1]]:
            b = a + int(solid[-1]) + 1
        if a < b:
            size = 1 << ((b - a).bit_length() - 1)
            picked.setdefault((FOLDED if b - a >= LITERALS else RAW, size), []).extend({a, b - size})
    for way in (FOLDED, RAW):
        for size, h in token_windows(s, start, end, way, {k for w, k in picked if w == way}):
            at = np.array(picked[way, size], np.int64)
            yield way, size, at, h[at], doc


_WINDOWS = "id long, h long, pos int, window long, slots array<long>, way int, k int"


def _window_rows(part: pa.RecordBatch, doc, slot, way: int, chosen: list[tuple[int, np.ndarray, np.ndarray]]):
    """Rows of the chosen (size, first words, hashes); no ``slot``: all are literals."""
    first = np.searchsorted(doc, np.arange(part.num_rows))
    for size, at, h in chosen:
        values = slot[at[:, None] + np.arange(size)[None, :]] if slot is not None else np.zeros((len(at), 1), np.uint64)
        kept = values != 0
        offsets = np.concatenate([[0], np.cumsum(kept.sum(1))]).astype(np.int32)
        rows = pa.array(doc[at])
        yield pa.RecordBatch.from_arrays(
            [part.column("id").take(rows), part.column("h").take(rows), pa.array((at - first[doc[at]]).astype(np.int32)),
             pa.array(h.view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[kept].view(np.int64))),
             pa.array(np.full(len(at), way, np.int32)), pa.array(np.full(len(at), size, np.int32))],
            names=["id", "h", "pos", "window", "slots", "way", "k"])


def benchmark_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(id, h, pos, window, slots, way, k) of all items; short items as one
    window, and exact items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                full = np.zeros(s.n, np.int64)
                for way, doc, code, slot in template(s):
                    chosen = [(WINDOW, *windows(doc, code, slot, WINDOW, way))]
                    if way == TEMPLATE:
                        full = s.count(doc[chosen[0][1]])
                    size = s.count(doc)
                    for k in range(LITERALS, WINDOW):
                        at, h = windows(doc, code, slot, k, way)
                        short = size[doc[at]] == k
                        chosen.append((k, at[short], h[short]))
                    yield from _window_rows(part, doc, slot, way, chosen)
                # 0xE2 is mostly punctuation; the other wide characters are of scripts without spaces, or as good
                exact = (full == 0) | (s.per_text((s.buf >= 0xE0) & (s.buf != 0xE2)) > 0)
                for way, k, at, h, own in _exact_windows(s, exact):
                    yield from _window_rows(part, own, None, way, [(k, at, h)])

    rows = items.select(F.col(item_id).cast("long").alias("id"), text_key(text).alias("h"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _WINDOWS)


def _bitmap(bench: DataFrame) -> np.ndarray:
    """Bit per window hash; at most FILTER_BITS / 64 rows come to the driver."""
    place = F.pmod("window", F.lit(FILTER_BITS))
    rows = (bench.groupBy(F.floor(place / 64).cast("int").alias("w"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(window, {FILTER_BITS}) % 64 as int))")).alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        out[r["w"]] = r["bits"]
    return out.view(np.uint64)


def document_windows(docs: DataFrame, doc_id: str, text: str, bench: DataFrame) -> DataFrame:
    """(id, h, pos, window, slots, way, k) of the documents' windows that may match."""
    spark = docs.sparkSession
    sizes: dict[int, set[int]] = {}
    for r in bench.select("way", "k").distinct().collect():  # few: up to WINDOW, and powers of two
        sizes.setdefault(r["way"], set()).add(r["k"])
    bits = spark.sparkContext.broadcast(_bitmap(bench))  # FILTER_BITS / 8 bytes, whatever the tables hold

    def hits(h: np.ndarray) -> np.ndarray:
        place = h & np.uint64(FILTER_BITS - 1)
        return ((bits.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, "text"):
                for way, doc, code, slot in template(s) if TEMPLATE in sizes or NAMED in sizes else ():
                    chosen = []
                    for k in sorted(sizes.get(way, ())):
                        at, h = windows(doc, code, slot, k, way)
                        hit = hits(h)
                        chosen.append((k, at[hit], h[hit]))
                    yield from _window_rows(part, doc, slot, way, chosen)
                ways = [w for w in (FOLDED, RAW) if w in sizes]
                start, end, doc = tokens(s) if ways else (None, None, None)
                for way in ways:
                    for k, h in token_windows(s, start, end, way, sizes[way]):
                        at = np.flatnonzero(hits(h) & (doc[:len(h)] == doc[k - 1:]))
                        yield from _window_rows(part, doc, None, way, [(k, at, h[at])])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), text_key(text).alias("h"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _WINDOWS)


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", share: float = SHARE, run: int = RUN) -> DataFrame:
    """(id, h, item, item_h, share) of every contaminated (document, item)."""
    bench = stored(benchmark_windows(items, item_id, item_text), "benchmark").distinct()
    own = stored(document_windows(docs, doc_id, text, bench), "windows").distinct()
    b = bench.select(F.col("id").alias("item"), F.col("h").alias("item_h"), F.col("pos").alias("item_pos"), "window",
                     F.col("slots").alias("item_slots"), "way")
    pairs = own.drop("way", "k").join(b, "window").withColumn("line", F.col("pos") - F.col("item_pos"))
    key = ["id", "h", "item", "item_h", "way", "line"]
    slots = (pairs.filter(F.size("slots") > 0)
             .select(*key, F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
             .select(*key, F.col("z.item_slots").alias("x"), F.col("z.slots").alias("y")).distinct())
    torn = (slots.groupBy(*key, "x").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key).distinct()
            .withColumnsRenamed({k: f"t_{k}" for k in key}))
    cond = None
    for k in key:
        c = pairs[k].eqNullSafe(torn[f"t_{k}"])
        cond = c if cond is None else cond & c
    sound = pairs.join(torn, cond, "left_anti")
    sizes = b.groupBy("item", "item_h", "way").agg(F.count_distinct("item_pos").alias("size")).withColumnsRenamed(
        {"item": "s_item", "item_h": "s_h", "way": "s_way"})
    lines = sound.groupBy(*key).agg(F.count_distinct("pos").alias("run"), F.collect_set("item_pos").alias("at"))
    found = lines.groupBy("id", "h", "item", "item_h", "way").agg(
        F.max("run").alias("run"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("covered"))
    j = found.join(sizes, found["item"].eqNullSafe(sizes["s_item"]) & (found["item_h"] == sizes["s_h"])
                   & (found["way"] == sizes["s_way"]))
    part = F.col("covered") / F.col("size")
    # both ends of an exact item at one alignment
    enough = F.when(F.col("way") >= FOLDED, F.col("run") == F.col("size")).otherwise((part >= share) | (F.col("run") >= run))
    return j.withColumn("share", part).filter(enough).groupBy("id", "h", "item", "item_h").agg(F.max("share").alias("share"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, contaminated, item_ids, share) per row of ``docs``: the items
    found, ascending, and the largest part of one that was found."""
    m = matches(docs, items, doc_id, text, **options).groupBy("id", "h").agg(
        F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("share").alias("share"))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("d_h"))
    j = d.join(m, d["doc_id"].eqNullSafe(m["id"]) & (d["d_h"] == m["h"]), "left")
    return j.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                    F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
                    F.coalesce("share", F.lit(0.0)).alias("share"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with its own columns."""
    names = [unused(docs.columns, x) for x in ("bad_id", "bad_h")]
    bad = stored(matches(docs, items, doc_id, text, **options).select(
        F.col("id").alias(names[0]), F.col("h").alias(names[1])).distinct(), "contaminated")
    return docs.join(bad, docs[doc_id].eqNullSafe(bad[names[0]]) & (text_key(text) == bad[names[1]]), "left_anti")
