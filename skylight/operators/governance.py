"""Governance reports over text tables.

G1 re-aims the gateway's prompt guard: detectors run as JVM regular
expressions over whole texts (request = user turns, response = assistant
turns); a request with a hit is rejected, a response is masked.  Patterns
stay inside the RE2 / Java common subset (no look-around, no
back-references) so an RE2 engine finds the same matches.

G2 re-aims per-key rate limits as a fixed-window report.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Detector names and their patterns.
PII_PATTERNS = {
    "CreditCard": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "Ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "Email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PhoneNumber": r"(\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
}
# A character every match of the pattern contains: texts without it skip
# the regular expression (exact, and the email scan is the costly one).
REQUIRED_CHAR = {"Email": "@", "Ssn": "-"}
DEFAULT_DETECTORS = ("CreditCard", "Ssn", "Email")
MASK = "<{name}>"
DEFAULT_LIMIT = 60
UNITS = {"Second": "1 second", "Minute": "1 minute", "Hour": "1 hour"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _may_match(text: Column, name: str) -> Column:
    ch = REQUIRED_CHAR.get(name)
    return text.contains(ch) if ch else F.lit(True)


def pii_counts(df: DataFrame, text_col: str, detectors: Sequence[str] = tuple(PII_PATTERNS),
               keep: Sequence[str] = ()) -> DataFrame:
    """Number of matches of each detector in each text."""
    t = _c(text_col)
    return df.select(*keep, *[
        F.when(_may_match(t, d), F.regexp_count(t, F.lit(PII_PATTERNS[d]))).otherwise(
            F.when(t.isNotNull(), F.lit(0))).alias(d.lower()) for d in detectors])


def pii_hit(text_col, detectors: Sequence[str] = DEFAULT_DETECTORS) -> Column:
    t = _c(text_col)
    cond = F.lit(False)
    for d in detectors:
        cond = cond | F.coalesce(_may_match(t, d) & t.rlike(PII_PATTERNS[d]), F.lit(False))
    return cond


def pii_mask(text_col, detectors: Sequence[str] = DEFAULT_DETECTORS) -> Column:
    """Each detector's pattern is replaced once. The whole chain is guarded on
    the original text: a mask brings in none of the characters tested for, so
    a text without them has nothing to mask."""
    text = _c(text_col)
    out = text
    for d in detectors:
        out = F.regexp_replace(out, PII_PATTERNS[d], MASK.format(name=d))
    return F.when(pii_hit(text, detectors), out).otherwise(text)


def guard(df: DataFrame, text_col: str = "text", role_col: str = "role",
          detectors: Sequence[str] = DEFAULT_DETECTORS) -> DataFrame:
    """G1 on a conversation table: user turns with a hit are rejected,
    assistant turns are masked, other turns pass unchanged."""
    role = F.col(role_col)
    rejected = (role == "user") & pii_hit(text_col, detectors)
    text = F.when(role == "assistant", pii_mask(text_col, detectors)).otherwise(F.col(text_col))
    return df.withColumn("rejected", rejected).withColumn(text_col, text)


def rate_limit_report(df: DataFrame, key_col: str, ts_col: str = "ts", unit: str = "Minute",
                      limit: int = DEFAULT_LIMIT, only_breaches: bool = True) -> DataFrame:
    """Requests per key and fixed window; up to ``limit`` are allowed,
    the rest would have been rejected."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    g = df.groupBy(key_col, F.window(F.col(ts_col), UNITS[unit]).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"))
    out = g.select(key_col, F.col("w.start").alias("window_start"), "requests",
                   F.least(F.col("requests"), F.lit(limit).cast("bigint")).alias("allowed"),
                   F.greatest(F.col("requests") - F.lit(limit).cast("bigint"), F.lit(0).cast("bigint")).alias("rejected"))
    return out.filter(F.col("rejected") > 0) if only_breaches else out
