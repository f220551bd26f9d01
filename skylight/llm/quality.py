"""Operator 1: quality rules with adaptive thresholds.

Per document, word-level measures are taken of the whole text. Fixed base
rules (too few words, too many repeated words) fail a document outright.
Every further rule compares a ratio (symbols, repeated lines, repeated words,
stutter, word length) with a lower and an upper threshold that come from a
mergeable quantile sketch of the ratio for the document's (lang, source):
``q50 + SPREAD * (q75 - q50)`` and ``q50 - SPREAD * (q50 - q25)``. No cutoff of
a ratio is fixed. Small groups shrink: ``PRIOR`` documents distributed as the
language's sketch are merged into a group's sketch, and as many of the
corpus's into a language's, so that they fade as a group grows. A document goes only if its
ratio is beyond the threshold by more than ``SIGMAS`` standard errors of a count
of its size, so a short text with one repeated line stays. The filter is a
join with the thresholds.

The sketch is a logarithmic histogram (relative error below
``SKETCH_ERROR``): bucket counts by group, so sketches merge by adding, rows
are partially aggregated before the shuffle, and a group's size is bounded by
its buckets, however many documents it has. Results are deterministic.

Defined cases. NULL text: no words, base rules fail. NULL lang or source: a
group of its own. Empty table: no rows. Repeated rows: each counts and is
returned. Very long texts: whole; memory follows the text. Other columns are
passed through by ``keep_good`` and never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .common import stored, unused

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5

#: Ratios with adaptive thresholds: counted, out of, and the events behind the
#: count (a passage that stands twice is one event, however long) by how many of them are one.
RULES = {"symbol_ratio": ("n_symbols", "n_words", "n_symbols", 1), "dup_line_ratio": ("n_dup_lines", "n_lines", "n_dup_lines", 1),
         "repeat_ratio": ("n_repeat_words", "n_words", "n_repeat_runs", 2),
         "stutter_ratio": ("n_stutter", "n_words", "n_stutter", 1), "word_length": ("word_chars", "n_words", "word_chars", 1)}
SPREAD = 6.0
SIGMAS = 2.0
PRIOR = 100
#: Parts of a document in which sketches with a prior count.
_PARTS = 1024
SKETCH_ERROR = 0.01
_SMALLEST = 1e-6
_LOG_GAMMA = math.log((1 + SKETCH_ERROR) / (1 - SKETCH_ERROR))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter", "n_repeat_runs")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def measure(s: tb.Slice) -> dict[str, np.ndarray]:
    """The counts of every text of a slice."""
    start, end, doc = s.words()
    word_byte = np.zeros(len(s.buf) + 1, np.int32)
    word_byte[start] += 1
    word_byte[end] -= 1
    in_word = np.cumsum(word_byte[:-1]) > 0 if len(s.buf) else np.zeros(0, bool)
    out = {
        "n_words": s.count(doc),
        "word_chars": s.per_text(in_word & ((s.buf & 0xC0) != 0x80)),
        "n_symbols": s.per_text(_SYMBOL[s.buf]),
    }
    # lines with a word, by content
    l_start, l_end, l_doc = s.words(_newline)
    has_word = np.searchsorted(start, l_end) > np.searchsorted(start, l_start)
    l_start, l_end, l_doc = l_start[has_word], l_end[has_word], l_doc[has_word]
    key = tb.keyed(l_doc, tb.span_hash(s.buf, l_start, l_end))
    _, first = np.unique(key, return_index=True)
    out["n_lines"] = s.count(l_doc)
    out["n_dup_lines"] = out["n_lines"] - s.count(l_doc[first])
    # words equal to the word before
    word = tb.span_hash(s.buf, start, end)
    again = np.flatnonzero((word[1:] == word[:-1]) & (doc[1:] == doc[:-1])) + 1
    out["n_stutter"] = s.count(doc[again])
    # words covered by a window that occurs twice or more
    n = len(start) - WINDOW + 1
    covered = np.zeros(len(start) + 1, np.int32)
    if n > 0:
        whole = doc[:n] == doc[WINDOW - 1:]
        at = np.flatnonzero(whole)
        h = tb.window_hash(word, WINDOW)[at]
        at = at[tb.repeated(tb.keyed(doc[at], h))]
        covered[at] += 1
        covered[at + WINDOW] -= 1
    covered = np.cumsum(covered[:-1]) > 0
    out["n_repeat_words"] = s.count(doc[covered])
    goes_on = np.zeros(len(covered), bool)
    goes_on[1:] = covered[:-1] & (doc[1:] == doc[:-1])
    out["n_repeat_runs"] = s.count(doc[covered & ~goes_on])
    return out


_newline = np.zeros(256, bool)
_newline[10] = True


def with_counts(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with the counts as long columns named by ``names``."""
    schema = T.StructType(docs.schema.fields + [T.StructField(names[c], T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in tb.bounded(batch, text):
                m = measure(s)
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(m[c], pa.int64()) for c in COUNTS],
                    names=part.schema.names + [names[c] for c in COUNTS])

    return docs.mapInArrow(run, schema)


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (F.lit(100) * n_repeat_words > F.lit(REPEAT_PERCENT) * n_words)


def _ratio(c: dict, rule: str, sigmas: float = 0.0):
    """The rule's ratio, moved by so many standard errors of its count of events."""
    k, n, events, unit = RULES[rule]
    part = F.lit(1.0) if not sigmas else F.lit(1.0) + F.lit(sigmas) / F.sqrt(c[events] / F.lit(float(unit)))
    return F.when((c[n] > 0) & (c[k] > 0), c[k] / c[n] * part).otherwise(F.lit(0.0))


def _bucket(value):
    return F.when(value <= _SMALLEST, F.lit(0)).otherwise(
        F.ceil(F.log(value / F.lit(_SMALLEST)) / F.lit(_LOG_GAMMA))).cast("int")


def _value(bucket):
    """A bucket's middle: within SKETCH_ERROR of every value in it."""
    return F.when(bucket == 0, F.lit(0.0)).otherwise(
        F.lit(_SMALLEST * 2 / (1 + math.exp(_LOG_GAMMA))) * F.exp(bucket * F.lit(_LOG_GAMMA)))


def thresholds(measured: DataFrame, lang: str, source: str, counts: dict[str, str], spread: float = SPREAD,
               prior: int = PRIOR) -> DataFrame:
    """One row per (lang, source): ``lo_<rule>`` and ``hi_<rule>``.

    Sketches are built once per (lang, source) and merged upwards; only
    documents that pass the base rules count.
    """
    c = {k: F.col(v) for k, v in counts.items()}
    good = measured.filter(~base_failed(c["n_words"], c["n_repeat_words"]))
    sketch = (good.select(F.col(lang).alias("lang"), F.col(source).alias("source"),
                          F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _bucket(_ratio(c, r)).alias("bucket"))
                                              for r in RULES])).alias("m"))
              .groupBy("lang", "source", "m.rule", "m.bucket").agg(F.count(F.lit(1)).alias("n")))
    # stored, as it is read several times and the texts should be read once
    own = stored(sketch.select("lang", "source", "rule", "bucket", (F.col("n") * _PARTS).alias("n")), "sketch")
    by_lang = own.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    every = own.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    by_lang = _with_prior(by_lang, every, ["lang"], [], prior)
    merged = _with_prior(own, by_lang, ["lang", "source"], ["lang"], prior)
    group = Window.partitionBy("lang", "source", "rule")
    ranked = (merged.withColumn("total", F.sum("n").over(group))
              .withColumn("upto", F.sum("n").over(group.orderBy("bucket"))))
    at = lambda q: F.min(F.when(F.col("upto") >= F.lit(q) * F.col("total"), F.col("bucket")))
    q = (ranked.groupBy("lang", "source", "rule")
         .agg(*[_value(at(x)).alias(f"q{int(100 * x)}") for x in (0.25, 0.5, 0.75)]))
    lo = F.col("q50") - F.lit(spread) * (F.col("q50") - F.col("q25"))
    hi = F.col("q50") + F.lit(spread) * (F.col("q75") - F.col("q50"))
    # stored, so that the join sees its real size: one that may be broadcast leaves the texts in place
    return stored(q.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r, x)).alias(f"{side}_{r}") for r in RULES for side, x in (("lo", lo), ("hi", hi))]),
        "thresholds")


def _with_prior(own: DataFrame, parent: DataFrame, keys: list[str], shared: list[str], prior: int) -> DataFrame:
    """Sketches ``own`` by ``keys`` with ``prior`` documents as in ``parent``
    merged in, in whole parts; rows: groups x a sketch's buckets."""
    up = parent.withColumn("total", F.sum("n").over(Window.partitionBy(*shared, "rule"))).select(
        *[F.col(k).alias(f"up_{k}") for k in shared], F.col("rule").alias("up_rule"), "bucket",
        F.floor(F.lit(float(prior * _PARTS)) * (F.col("n").cast("double") / F.col("total").cast("double"))).alias("n"))
    groups = own.select(*keys, "rule").distinct()
    cond = groups["rule"] == up["up_rule"]
    for k in shared:
        cond = cond & groups[k].eqNullSafe(up[f"up_{k}"])
    added = groups.join(up, cond).select(*keys, "rule", "bucket", "n")
    return own.unionByName(added).groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def judge(measured: DataFrame, lang: str, source: str, counts: dict[str, str], failed: str, kept: str,
          sigmas: float = SIGMAS, **options) -> DataFrame:
    """``measured`` with boolean columns ``failed`` (base rules) and ``kept``."""
    t = thresholds(measured, lang, source, counts, **options)
    group, limit = unused(measured.columns, "group"), unused([*measured.columns, "group"], "limit")
    t = t.select(F.struct("lang", "source").alias(group), F.struct(*t.columns[2:]).alias(limit))
    joined = measured.join(t, measured[lang].eqNullSafe(t[group]["lang"])
                           & measured[source].eqNullSafe(t[group]["source"]), "left")
    c = {k: F.col(v) for k, v in counts.items()}
    ok = F.lit(True)
    for r in RULES:
        ok = ok & ~((_ratio(c, r, -sigmas) > F.col(limit)[f"hi_{r}"]) | (_ratio(c, r, sigmas) < F.col(limit)[f"lo_{r}"]))
    bad = base_failed(c["n_words"], c["n_repeat_words"])
    # a group without limits has no document that passes the base rules
    return joined.withColumn(failed, bad).withColumn(kept, ~bad & F.coalesce(ok, F.lit(True))).drop(group, limit)


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                  **options) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept`` appended; a name
    that ``docs`` already has gets a number (``kept_1``). Options:
    ``spread``, ``prior``, ``sigmas``."""
    names, taken = {}, list(docs.columns)
    for c in (*COUNTS, "base_failed", "kept"):
        names[c] = unused(taken, c)
        taken.append(names[c])
    counts = {c: names[c] for c in COUNTS}
    return judge(with_counts(docs, text, counts), lang, source, counts, names["base_failed"], names["kept"], **options)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that every rule passes, with its own columns."""
    judged = quality_rules(docs, **options)
    return judged.filter(F.col(judged.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])
