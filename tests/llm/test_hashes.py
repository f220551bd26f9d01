"""Text hashes that do not follow the texts' algebra, and gaps of any length."""

import random

import numpy as np
import pyarrow as pa
from llm_fixtures import ROOT  # noqa: F401 - path

from skylight.llm import licenses, minhash, ngram_join, textbatch, tokens
from skylight.llm.queries import tokenizer_path


def mirrored(n=10):
    """A word doubled by its complement n times, and its mirror: equal under
    every polynomial hash modulo 2^64."""
    a, b = "ab", "ba"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_span_hash_tells_texts_apart():
    r = random.Random(2)
    texts = [*mirrored(), *mirrored(5), "", "a", "a\0", "\0", *("".join(r.choice("ab\0") for _ in range(r.randrange(40))) for _ in range(3000))]
    s = textbatch.Slice(pa.array(texts + texts))
    h = textbatch.span_hash(s.buf, s.offsets[:-1], s.offsets[1:])
    n = len(texts)
    assert (h[:n] == h[n:]).all() and len(np.unique(h)) == len(set(texts))
    part = textbatch.span_hash(s.buf, s.offsets[:-1][:1] + 3, s.offsets[:-1][:1] + 14)
    assert part == textbatch.span_hash(np.frombuffer(texts[0][3:14].encode(), np.uint8), np.array([0]), np.array([11]))


def test_operators_on_mirrored_words(spark):
    a, b = mirrored()
    rows = [(1, a), (2, b), (3, f"{a} one two three four five"), (4, f"{b} one two three four five"), (5, a)]
    t = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for f in (minhash.near_duplicates, ngram_join.classes):
        assert {r["doc_id"]: r["component_id"] for r in f(t).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_files(t, path).collect()}
    assert got == {i: len(lib.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows}
    import zlib
    crc = {r["doc_id"]: r["ids_crc32"] for r in tokens.token_files(t, path).collect()}
    want = {i: zlib.crc32(np.array(lib.encode(x, add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, x in rows}
    assert crc == want


def test_license_gaps_of_any_length(spark):
    holders = " ".join(f"Holder{i}" for i in range(2000))
    text = f"Neither the name of {holders} nor the names of its contributors may be used to endorse or promote products"
    other = f"No part of this work may be reproduced {holders} without the prior written permission"
    rows = [(1, text), (2, other), (3, "neither the name of anyone")]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "bsd-3-clause" in got[1].split(",") and "proprietary" in got[2].split(",") and got[3] == ""
