"""Registered governance queries (G1, G2) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylight.operators import governance as G
from skylight.plans.registry import register
from skylight.sources.fixtures import Views


def _count_sql(col: str, name: str) -> str:
    return f"len(regexp_extract_all({col}, '{G.PII_PATTERNS[name]}'))"


def _hit_sql(col: str, names) -> str:
    return "(" + " OR ".join(f"regexp_matches({col}, '{G.PII_PATTERNS[n]}')" for n in names) + ")"


def _mask_sql(col: str, names) -> str:
    out = col
    for n in names:
        out = f"regexp_replace({out}, '{G.PII_PATTERNS[n]}', '<{n}>', 'g')"
    return out


@register("pii_detect", oracle=f"""
SELECT doc_id, {_count_sql('text', 'CreditCard')} AS creditcard, {_count_sql('text', 'Ssn')} AS ssn,
  {_count_sql('text', 'Email')} AS email, {_count_sql('text', 'PhoneNumber')} AS phonenumber
FROM documents""")
def pii_detect(spark, sf_dir):
    docs = Views(spark, sf_dir).table("documents")
    c = G.pii_counts(docs, "text", keep=["doc_id"])
    return c.select("doc_id", *[F.col(x).cast("bigint").alias(x) for x in c.columns if x != "doc_id"])


@register("pii_reject", oracle=f"""
SELECT conv_id, turn, role, role = 'user' AND {_hit_sql('text', G.DEFAULT_DETECTORS)} AS rejected
FROM conversations""")
def pii_reject(spark, sf_dir):
    conv = Views(spark, sf_dir).table("conversations")
    return G.guard(conv).select("conv_id", "turn", "role", "rejected")


@register("pii_mask", oracle=f"""
SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN {_mask_sql('text', G.DEFAULT_DETECTORS)} ELSE text END AS text
FROM conversations""")
def pii_mask(spark, sf_dir):
    conv = Views(spark, sf_dir).table("conversations")
    return G.guard(conv).select("conv_id", "turn", "text")


@register("pii_mask_documents", oracle=f"""
SELECT doc_id, md5({_mask_sql('text', tuple(G.PII_PATTERNS))}) AS masked_md5,
  {_hit_sql('text', tuple(G.PII_PATTERNS))} AS had_pii FROM documents""")
def pii_mask_documents(spark, sf_dir):
    docs = Views(spark, sf_dir).table("documents")
    names = tuple(G.PII_PATTERNS)
    return docs.select("doc_id", F.md5(G.pii_mask("text", names)).alias("masked_md5"),
                       G.pii_hit("text", names).alias("had_pii"))


@register("rate_limit_breaches", oracle="""
SELECT event_type, window_start, requests, least(requests, 3) AS allowed, greatest(requests - 3, 0) AS rejected
FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests
      FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)) g
WHERE requests > 3""")
def rate_limit_breaches(spark, sf_dir):
    ev = Views(spark, sf_dir).events
    return G.rate_limit_report(ev, "event_type", "ts", unit="Hour", limit=3)
