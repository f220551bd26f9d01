"""Operator 2: site-relative line deduplication (DataFrame functions only).

A line is boilerplate of a site when it repeats (stands on ``min_pages`` or more
of its pages, two unless told otherwise) and stands on more than ``ratio`` of them. Such lines are dropped from
every page of that site; a line common elsewhere stays.

Only (site, line hash) pairs are shuffled, deduplicated within a page and
partially aggregated, so a line on every page of a site costs one row per
task. At most (mean distinct lines per page) / ratio lines can pass for a
site, so a site's list is small; it joins back as one array per site, and
texts are never exploded or regrouped. Lines are compared by 128 hash bits.

Defined cases. NULL text stays NULL, with no lines. NULL site is a site of
its own. Lines of white space only are never boilerplate. A page all of whose
lines go becomes the empty text. Repeated rows count as pages. Ties: a ratio
exactly at the limit keeps the line. Empty table: no rows. Very long texts
are handled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused

RATIO = 0.05
#: A line on one page does not repeat, whatever the size of its site.
MIN_PAGES = 2


def _line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def _has_word(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\x0b\x0c\r", "    ")) != ""


def boilerplate(pages: DataFrame, text: str, site: str, ratio: float, min_pages: int) -> DataFrame:
    """(site, drop): the keys of each site's boilerplate lines, as an array."""
    if not 0 <= ratio < 1:
        raise ValueError("ratio must be at least 0 and under 1")
    p = pages.select(F.col(site).alias("site"), F.col(text).alias("text"))
    totals = p.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n", -1), _has_word), _line_key))
    counts = (p.select("site", F.explode(keys).alias("line")).groupBy("site", "line")
              .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages))
    # limits are compared in whole numbers: n / pages > ratio
    t = totals.select(F.col("site").alias("t_site"), "pages")
    hits = counts.join(t, counts["site"].eqNullSafe(t["t_site"])).filter(
        F.col("n").cast("double") > F.lit(float(ratio)) * F.col("pages"))
    # stored, so that the join sees its real size: one that may be broadcast leaves the texts in place
    return stored(hits.groupBy("site").agg(F.collect_list("line").alias("drop")), "boilerplate")


def drop_boilerplate(pages: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, n_lines: str | None = None, n_dropped: str | None = None) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``; with counts of
    lines and dropped lines where column names for them are given."""
    b = boilerplate(pages, text, site, ratio, min_pages)
    own = [unused(pages.columns, x) for x in ("b_site", "b_drop", "b_lines", "b_kept")]
    b = b.select(F.col("site").alias(own[0]), F.col("drop").alias(own[1]))
    j = pages.join(b, pages[site].eqNullSafe(b[own[0]]), "left")
    lines, drop = F.col(own[2]), F.col(own[1])
    j = j.withColumn(own[2], F.split(F.col(text), "\n", -1))
    j = j.withColumn(own[3], F.when(drop.isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~(_has_word(x) & F.array_contains(drop, _line_key(x))))))
    out = [F.array_join(F.col(own[3]), "\n").alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns]
    if n_lines:
        out.append(F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines))
    if n_dropped:
        out.append(F.coalesce(F.size(lines) - F.size(F.col(own[3])), F.lit(0)).cast("long").alias(n_dropped))
    return j.select(*out)
