"""The pipeline against plain versions of its stages."""

import brute
import sentencepiece
from llm_fixtures import odd  # noqa: F401 - fixture, and the path of the repository
from pyspark.sql import functions as F

import corpus_pipeline
from skylight.llm import lines, quality
from skylight.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    m = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if i < 4:
            assert out.columns == docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = {r["doc_id"]: r for r in out.collect()}
        after = {k: r["text"] for k, r in rows.items()} if i < 4 else None
        if i == 0:
            verdict = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()}
            assert set(after) == {k for k, ok in verdict.items() if ok}
            assert not any(brute.quality(before[k])[-1] for k in after)
        elif i == 1:
            total, n = {}, {}
            for r in docs.collect():
                total[r["source"]] = total.get(r["source"], 0) + 1
                for x in {x for x in r["text"].split("\n") if x.strip()}:
                    n[r["source"], x] = n.get((r["source"], x), 0) + 1
            drop = {k for k, v in n.items() if v >= lines.MIN_PAGES and v / total[k[0]] > lines.RATIO}
            assert after == {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if (r["source"], x) not in drop)
                             for r in docs.collect()}
        elif i == 2:
            assert set(after) == {k for k, _, c in brute.near(list(before.items()))[0] if k == c}
        elif i == 3:
            assert set(after) == {k for k, t in before.items() if not any(x in t for x in items)}
        else:
            assert {k: list(r["piece_ids"]) for k, r in rows.items()} == {k: m.encode(t) for k, t in before.items()}
            assert {k: r["decoded"] for k, r in rows.items()} == before
        docs = out
    last = corpus_pipeline.run(spark, SMALL)
    assert last.agg(F.count("*"), F.sum("n_pieces")).first() == docs.agg(F.count("*"), F.sum("n_pieces")).first()


def test_odd_rows(odd, spark):
    """Nulls, empty texts, repeats and extra columns pass through all stages."""
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SMALL).count() == 0
        stage(spark, odd, SMALL).collect()
