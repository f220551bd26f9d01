"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, html_extract, licenses, lines, minhash, ngram_join, oracles, pieces, quality, repair, sharding,
               suffix, tokens, trie)
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality.quality_rules(docs).drop("text", "lang", "source")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs, n_lines="n_lines", n_dropped="n_dropped")


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.byte_shards(table(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_path("piece_bpe_32k.model")
    back = pieces.encode(docs, model, decoded="decoded")
    return back.select("doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), "piece_ids",
                       "decoded", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"), family=trie.FAMILY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_token_binary, op4_suffix_dedup, op5_minhash_near_dedup,
                            op6_decontamination, op7_sharding, op8_html_extraction, op9_license_scan, op10_sentencepiece,
                            op11_conversation_repair, op12_ngram_join, op13_prefix_trie)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL for operators 1, 2, 5, 9, 11, 12 and 13. The others (tokenizers, byte strings of
    any place, HTML, checksums that the engine lacks) are tested by brute force."""
    return oracles.oracle_sql()
