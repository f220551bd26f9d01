"""Operator 9: license scan by ordered signature rules (DataFrame functions).

A text is normalised to its lower-case words. A keyword prefilter decides
which texts (short stems that every match holds), and then which rules of
``license_rules``, are looked at; the patterns run on those pairs only. Matches are word intervals. Overlaps are
resolved by priority and containment: a match goes when another of the same
or a better priority (a smaller number) contains it and is longer, or when
one of a better priority covers the same words. What stays gives the labels;
the labels of the four base phrases always stay. ``score`` is the largest
weight of what stays (a base phrase alone: 0.5; nothing: 0).

The prefilter is a substring test per keyword, so clean texts cost no regular
expression beyond the split into words. The rule table is a fixed list, the
only broadcast. Texts are never shuffled: only (key, interval) rows of
matches are, by document and interval. A document is keyed by id and text
hash; equal rows share one result.

Defined cases. NULL or empty text: no words, no labels, score 0. Words with
other letters are words. Repeated rows: each gets its row. Empty table: no
rows. Ties between labels of one interval and priority: all stay. Very long
texts are whole; a document's matches are ordered in one task, its text is
not. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_key
from .license_rules import STEMS, rules

#: What separates words: ASCII that is no letter and no digit.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_SCORE = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced(pattern: str) -> str:
    """A pattern over words with one space between as one over ' a  b  c ',
    where every word has a space of its own on either side."""
    return " " + re.sub(r" (\?)?", lambda m: "(?:  )?" if m[1] else "  ", pattern).replace(".{1,", "[^\\x01\\x02]{1,") + " "


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def rule_table(spark) -> DataFrame:
    rows = [(i, label, p, w, k, f"({spaced(x)})") for i, label, p, w, k, x in rules()]
    return spark.createDataFrame(rows, "rule int, label string, priority int, weight double, keyword string, pattern string")


def _base(words: Column) -> dict[str, list[Column]]:
    """Per phrase: how often it stands in ' a  b ', first and last place."""
    out = {}
    for phrase in BASE:
        own = "  ".join(["", *phrase.split(" "), ""])[1:-1]
        parts = F.when(F.contains(words, F.lit(own)), F.split(words, own, -1))
        n = F.size(parts) - 1
        size = len(phrase.split(" "))
        before = F.aggregate(F.slice(parts, 1, F.greatest(n, F.lit(1))), F.lit(0), lambda s, x: s + _spaces(x))
        out[phrase] = [F.when(parts.isNotNull(), n).otherwise(0),
                       F.when(parts.isNotNull(), _spaces(parts[0]) / 2),
                       F.when(parts.isNotNull(), before / 2 + (n - 1) * size)]
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) per row of ``docs``."""
    norm = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SEPARATOR, " "))
    # each exploded single value is computed once, whatever reads it later
    once = lambda x: F.explode(F.array(x))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("h"), once(norm).alias("norm"))
    # lower() folds more than A-Z, so it only widens the gate
    d = d.select("doc_id", "h", "norm", once(F.lower("norm")).alias("low"))
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains("low", F.lit(stem))
    words = F.when(gate, F.concat(F.lit(" "), F.replace(F.translate("norm", _UPPER, _LOWER), F.lit(" "), F.lit("  ")), F.lit(" ")))
    n_words = F.when(F.col("norm") == "", 0).otherwise(_spaces(F.col("norm")) + 1)
    d = d.select("doc_id", "h", n_words.cast("long").alias("n_words"), once(words).alias("words"))
    base = _base(F.col("words"))
    labels = F.array_sort(F.array_compact(F.array(*[F.when(base[p][0] > 0, F.lit(label)) for p, label in BASE.items()])))
    first = F.array_min(F.array(*[base[p][1] for p in BASE]))
    last = F.array_max(F.array(*[base[p][2] for p in BASE]))
    rows = d.select("doc_id", "h", "n_words", sum((base[p][0] for p in BASE), F.lit(0)).cast("long").alias("n_base"),
                    first.cast("long").alias("first_word"), last.cast("long").alias("last_word"), labels.alias("base"))
    kept = surviving(d.filter("words IS NOT NULL").select("doc_id", "h", "words"))
    k = kept.select(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"), "found", "weight")
    j = rows.join(k, rows["doc_id"].eqNullSafe(k["k_id"]) & (rows["h"] == k["k_h"]), "left")
    every = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.size("base") > 0, F.lit(BASE_SCORE)).otherwise(0.0))
    return j.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                    F.array_join(every, ",").alias("labels"), score.alias("score"))


def matches(words: DataFrame) -> DataFrame:
    """(doc_id, h, a, b, priority, label, weight): the rules' word intervals
    [a, b) in (doc_id, h, words)."""
    table = rule_table(words.sparkSession)
    keywords = sorted({r[4] for r in rules()})
    spaced_keyword = lambda k: k.replace(" ", "  ")
    has = F.array_compact(F.array(*[F.when(F.contains("words", F.lit(spaced_keyword(k))), F.lit(k)) for k in keywords]))
    rows = words.withColumn("row", F.monotonically_increasing_id())  # equal rows apart
    pairs = rows.select("doc_id", "h", "row", "words", F.explode(has).alias("keyword")).join(F.broadcast(table), "keyword")
    marked = F.split(F.regexp_replace("words", F.col("pattern"), F.lit("\x01$1\x02")), "\x01", -1)
    parts = (pairs.select("doc_id", "h", "row", "rule", "priority", "label", "weight", marked.alias("parts"))
             .filter(F.size("parts") > 1)
             .select("doc_id", "h", "row", "rule", "priority", "label", "weight", F.posexplode(F.transform(
                 "parts", lambda x: F.struct((_spaces(x) / 2).cast("int").alias("all"),
                                             (_spaces(F.substring_index(x, "\x02", 1)) / 2).cast("int").alias("own"))))
                 .alias("k", "x")))
    before = Window.partitionBy("row", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("a", F.sum("x.all").over(before)).filter("k > 0")
    return placed.select("doc_id", "h", "a", (F.col("a") + F.col("x.own")).alias("b"), "priority", "label", "weight")


def surviving(words: DataFrame) -> DataFrame:
    """(doc_id, h, found, weight): labels and largest weight of the matches
    that no other suppresses."""
    best = (matches(words).groupBy("doc_id", "h", "a", "b", "priority")
            .agg(F.collect_set("label").alias("labels"), F.max("weight").alias("weight")))
    same = best.groupBy("doc_id", "h", "a", "b").agg(F.min_by(F.struct("priority", "labels", "weight"), "priority").alias("m"))
    rows = same.select("doc_id", "h", "a", "b", "m.*")
    # intervals differ, so one that starts no later and ends no earlier is longer
    over = Window.partitionBy("doc_id", "h").orderBy("a", F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for p in sorted({r[2] for r in rules()}):
        reach = F.max(F.when(F.col("priority") <= p, F.col("b"))).over(over)
        covered = covered | ((F.col("priority") == p) & F.coalesce(reach >= F.col("b"), F.lit(False)))
    left = rows.withColumn("covered", covered).filter("NOT covered")
    return left.groupBy("doc_id", "h").agg(F.array_distinct(F.flatten(F.collect_set("labels"))).alias("found"),
                                           F.max("weight").alias("weight"))
