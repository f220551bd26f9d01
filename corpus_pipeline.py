"""Corpus pipeline: quality rules, line dedup, near-duplicate removal,
benchmark decontamination, SentencePiece encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir),
where ``docs`` is what the stage before kept, and returns a DataFrame. All but
the last return the columns of ``documents``. ``run`` applies them to
``documents``, each result written to the shared folder and read again.

ORACLE_SQL is None: minhash components and piece encoding are not expressed
in SQL; ``tests/llm/test_pipeline.py`` holds ``run`` against plain versions of
all stages.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skylight.llm import decontam, lines, minhash, pieces, quality  # noqa: E402
from skylight.llm.common import stored, table  # noqa: E402
from skylight.llm.queries import tokenizer_path  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of their language and source."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines; ``n_chars``
    counts what is left."""
    out = lines.drop_boilerplate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece_ids, n_pieces, decoded) of every document."""
    model = tokenizer_path("piece_bpe_32k.model")
    rows = pieces.encode(docs.select("doc_id", "text"), model, decoded="decoded")
    return rows.select("doc_id", "piece_ids", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), "decoded")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("minhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("sentencepiece", sentencepiece)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``; returns the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
