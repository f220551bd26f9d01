"""Every operator against a plain version, on whole small tables and on rows
with nulls, empty and very long texts, ties, repeats and clashing columns."""

import itertools
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import docs, empty, odd  # noqa: F401 - fixtures
from pyspark.sql import functions as F

from skylight.llm import (components, decontam, html_extract, licenses, lines, minhash, pieces, quality, sharding, suffix,
                          textbatch, tokens)
from skylight.llm.license_rules import rules
from skylight.llm.queries import QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def key(x):
    return repr(x)


@pytest.fixture(params=["docs", "odd"])
def table(request):
    return request.getfixturevalue(request.param)


def test_word_slices():
    texts = pa.array(["a b", None, "", " x", "tail ", "é ü"])
    batch = pa.record_batch([texts], names=["t"])
    for limit in (1, 4, 1 << 20):
        got = []
        for part, s in textbatch.bounded(batch, "t", limit):
            start, end, doc = s.words()
            got += [(part.column(0)[d].as_py(), s.buf[a:b].tobytes().decode()) for a, b, d in zip(start, end, doc)]
        assert got == [("a b", "a"), ("a b", "b"), (" x", "x"), ("tail ", "tail"), ("é ü", "é"), ("é ü", "ü")]


# operator 1

def test_quality_counts(table):
    got = quality.quality_rules(table.select("doc_id", "text", "lang", "source")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((r["doc_id"], *[r[n] for n in names]) for r in got), key=key) == sorted(
        ((i, *brute.quality(t)) for i, t in pairs(table)), key=key)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_quality_keeps_clean_and_columns(docs, odd, spark):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r[0] for r in kept.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r[0] for r in labels.filter("quality = 1").collect()}
    passed = {i for i, t in pairs(docs) if not brute.quality(t)[-1]}
    assert len(good & passed - ids) == 0
    assert quality.keep_good(odd).columns == odd.columns


def test_quality_thresholds_follow_the_group(spark):
    """A source whose normal symbol use is high keeps its texts; the same text
    is an outlier elsewhere."""
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore"
    rows = [(i, " ".join(random.Random(i).sample(words.split(), 15)) + (" a# b# c# d# e# f#" if i % 2 else ""), "en", f"s{i % 2}")
            for i in range(600)]
    rows.append((1000, " ".join(words.split()) + " a# b# c# d# e# f#", "en", "s0"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r[0] for r in quality.keep_good(df).select("doc_id").collect()}
    assert kept == set(range(600))


def test_quality_thresholds_from_quantiles(spark):
    """Thresholds differ between unlike sources, lie on both sides, shrink for
    small groups, and hold back short texts with a single event."""
    r, words = random.Random(3), ["lorem", "ipsum", "dolor", "sit", "amet", "elit"]
    line = lambda n, tail="": " ".join(r.choice(words) + f"{r.randint(0, 99)}" for _ in range(n)) + tail
    rows = [(i, line(r.randint(40, 60), " #" * r.randint(0, 1)), "en", "web") for i in range(300)]
    code = lambda: " ".join(f"{r.choice('abcdef')}{r.randint(0, 999)}" + "#" * (r.random() < 0.4) for _ in range(r.randint(40, 60)))
    rows += [(i, code(), "en", "code") for i in range(300, 600)]
    rows += [(i, line(50), "en", "tiny") for i in range(600, 603)]
    rows += [(1000, code(), "en", "web"), (1001, line(30) + "\nsame line\nsame line", "en", "web"),
             (1002, " ".join(f"ab{c}" for c in "abcdefghijklmnopqrstuvwxyz" * 4), "en", "web"),
             (1003, " ".join(f"a{c}" for c in "abcdefghijklmnopqrstuvwxyz0123456789" * 1), "en", "web"),
             (1004, " ".join(f"{w}wordwordwordword{i}" for i, w in enumerate(words * 8)), "en", "code")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    names = {c: c for c in quality.COUNTS}
    t = {x["source"]: x for x in quality.thresholds(quality.with_counts(df, "text", names), "lang", "source", names).collect()}
    assert t["code"]["hi_symbol_ratio"] > 1.5 * t["web"]["hi_symbol_ratio"] > 0
    assert t["code"]["lo_word_length"] < t["web"]["lo_word_length"] < t["web"]["hi_word_length"]
    # three documents without symbols hardly move the language's threshold
    assert t["tiny"]["hi_symbol_ratio"] > 0.5 * t["code"]["hi_symbol_ratio"]
    kept = {x[0] for x in quality.keep_good(df).select("doc_id").collect()}
    assert {x for x in range(603)} - kept == set() and kept - set(range(603)) == {1001}


def test_quality_clean_documents_stay(spark):
    base = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{base}/documents.parquet")
    judged = quality.quality_rules(d.select("doc_id", "text", "lang", "source")).filter("not base_failed")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    share = {r["quality"]: r["kept"] for r in judged.join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.99 and share[0] <= 0.05


def test_quality_sketch_error(spark):
    vals = [0.0, 1e-7, 0.001, 0.02, 0.5, 3.7, 91.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select("x", quality._value(quality._bucket(F.col("x"))).alias("y"))
    assert all(abs(r["y"] - r["x"]) <= max(1e-6, 1.01 * quality.SKETCH_ERROR * r["x"]) for r in df.collect())


# operator 2

def test_lines(odd, docs):
    for df, ratio, least in ((docs, 0.02, 2), (odd, 0.1, 2), (docs, 0.0, 3)):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
        total, n = {}, {}
        for _, t, s in rows:
            total[s] = total.get(s, 0) + 1
            for x in {x for x in (t or "").split("\n") if x.strip(" \t\x0b\x0c\r")} if t is not None else ():
                n[s, x] = n.get((s, x), 0) + 1
        drop = {k for k, v in n.items() if v >= least and v / total[k[0]] > ratio}
        want = [(i, None, 0) if t is None else
                (i, "\n".join(x for x in t.split("\n") if (s, x) not in drop), sum((s, x) in drop for x in t.split("\n")))
                for i, t, s in rows]
        got = lines.drop_boilerplate(df, ratio=ratio, min_pages=least, n_lines="nl", n_dropped="gone")
        assert got.columns == [*df.columns, "nl", "gone"]
        assert sorted(((r["doc_id"], r["text"], r["gone"]) for r in got.collect()), key=key) == sorted(want, key=key)


def test_lines_of_small_sites(spark):
    """No site is too small: a line on all of its pages goes, its own lines stay."""
    rows = [(i, f"menu of {s}\nown line {i}\n" + ("twice" if i % n < 2 else f"x{i}"), s)
            for s, n, at in (("four", 4, 0), ("two", 2, 4), ("one", 1, 6), ("big", 40, 40)) for i in range(at, at + n)]
    got = {r["doc_id"]: r["text"] for r in lines.drop_boilerplate(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == "own line 0" and got[3] == "own line 3\nx3" and got[5] == "own line 5"
    assert got[6] == "menu of one\nown line 6\ntwice"
    # two of 40 pages are not more than a twentieth
    assert got[40] == "own line 40\ntwice" and got[45] == "own line 45\nx45"


# operator 3

def test_tokens(table, spark, tmp_path):
    path = tokenizer_path("byte_bpe_50k.json")
    t = tokens.tokenizer(path)
    for encoding in ("dictionary", "delta"):
        out = f"{tmp_path}/{encoding}"
        tokens.write_tokens(table, out, path, encoding=encoding)
        got = sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokens.read_tokens(spark, out).collect()), key=key)
        coded = [(i, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for i, x in pairs(table)]
        assert got == sorted(((i, len(c), brute.crc(c)) for i, c in coded), key=key)
        rows = tokens.read_tokens(spark, out).orderBy("start").collect()
        assert [r["start"] for r in rows] == [0, *itertools.accumulate(r["n_tokens"] for r in rows)][:-1]
        ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in rows]
        assert ids == sorted(ids)
        want = {i: c for i, c in coded if i in (5, 10)}
        assert {r[0]: list(r[1]) for r in tokens.read_ids(spark, out, 5, 10).filter("doc_id in (5, 10)").collect()} == want


def test_tokens_as_the_library(spark, tmp_path):
    """Added tokens' strings give the ids of the unaltered library."""
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["x <|endoftext|> y", "plain text  here\n", "<|endoftext|>", "a<|endoftext|>\n\nb <|endoftext|", "é <|endoftext|>\u00a0x", "y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    tokens.write_tokens(df, f"{tmp_path}/t", path)
    want = [[*t.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    assert want[0] == [87, 220, 50256, 331, 2]
    rows = tokens.read_tokens(spark, f"{tmp_path}/t").orderBy("doc_id").collect()
    starts = [0, *itertools.accumulate(map(len, want))][:-1]
    assert [tuple(r) for r in rows] == [(i, a, len(c), brute.crc(c)) for i, (a, c) in enumerate(zip(starts, want))]


def test_token_files_have_indexes(docs, spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    out = f"{tmp_path}/t"
    tokens.write_tokens(docs, out, tokenizer_path("byte_bpe_50k.json"), encoding="delta", row_group_bytes=1 << 18)
    group = pq.ParquetFile(glob.glob(f"{out}/*.parquet")[0]).metadata.row_group(0)
    cols = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert all(c.has_column_index and c.has_offset_index for c in cols.values())
    assert "DELTA_BINARY_PACKED" in cols["doc_id"].encodings
    assert "DELTA_BINARY_PACKED" in cols["ids.list.element"].encodings
    plan = tokens.read_ids(spark, out, 3, 9)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,3)" in plan


# operator 4

def test_suffix(odd, docs):
    for df in (odd, docs.filter("length(text) < 20000")):
        got = suffix.suffix_dedup(df).drop("kept").collect()
        assert sorted((tuple(r) for r in got), key=key) == sorted(brute.suffix(pairs(df)), key=key)


def test_suffix_small_strings(spark):
    """Short strings over two letters: many overlapping and periodic matches."""
    r = random.Random(3)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randrange(60)))) for i in range(120)] + [(200, "ab" * 40), (201, "a" * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for length, core in ((14, 6), (12, 11), (20, 5)):
        got = suffix.suffix_dedup(df, length=length, core=core).drop("kept").collect()
        assert sorted(tuple(x) for x in got) == sorted(brute.suffix(rows, length))


def test_loser_tree():
    r = random.Random(5)
    for k in (1, 2, 3, 7, 16):
        runs, want = [], []
        for _ in range(k):
            keys = sorted(bytes(r.choice(b"ab\0") for _ in range(r.randrange(8))) for _ in range(r.randrange(40)))
            runs.append((keys, [0, *(suffix.common_prefix(a, b, 0) for a, b in zip(keys, keys[1:]))][:len(keys)]))
            want += keys
        merged = [(runs[a][0][i], n) for a, i, n in suffix.merge(runs)]
        assert [m[0] for m in merged] == sorted(want)
        assert all(n == suffix.common_prefix(a[0], m, 0) for a, (m, n) in zip(merged, merged[1:]))


def test_anchor_chunks(monkeypatch):
    s = textbatch.Slice(pa.array([bytes(np.random.default_rng(1).integers(97, 100, 5000, np.uint8)).decode(), "short"]))
    whole = suffix.anchors(s, 40, 10)
    windows = lambda x: sorted((a - d, a) for a, lo, hi in zip(*(v.tolist() for v in x[1:4])) for d in range(lo, hi + 1))
    monkeypatch.setattr(suffix, "_CHUNK", 333)
    assert windows(suffix.anchors(s, 40, 10)) == windows(whole)
    assert [p for p, _ in windows(whole)] == list(range(5000 - 39))


# operator 5

def test_near_duplicates(table):
    got = minhash.near_duplicates(table).collect()
    want, none = brute.near(pairs(table))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == want
    assert [r["n_shingles"] for r in got if r["doc_id"] is None] == none
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_bridge(spark, monkeypatch):
    """Texts that are linked only through others, in one bucket or several."""
    r = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(120)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(1000, 1250):  # mostly under the threshold to each other: late links in mixed buckets
        w = [f"v{j}" for j in range(90)]
        for _ in range(r.randrange(2, 6)):
            w[r.randrange(90)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(100, "Some Words HERE"), (101, "some words here"), (7, "some words here"), (102, "a b c d e f"), (102, "g h i j k l")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1024, 7):
        monkeypatch.setattr(minhash, "BLOCK", block)
        got = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in minhash.near_duplicates(df).collect())
        assert got == brute.near(rows)[0]
    kept = minhash.keep_first(df)
    assert kept.columns == df.columns
    assert {x["doc_id"] for x in kept.collect()} == {i for i, _, c in got if i == c}


def test_minima_recall():
    """At similarity 0.75 a pair shares a bucket and passes the signature."""
    rng = np.random.default_rng(9)
    bound = minhash.agreement_bound()
    for _ in range(40):
        h = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
        a, b = np.sort(h[:600]), np.sort(h[100:])  # 500 of 700 in common: under the threshold
        c = np.sort(np.concatenate([h[:514], h[600:686]]))  # 514 of 686: just under
        m = minhash._minima(np.concatenate([a, c]), np.array([0, 600, 600 + len(c)]))
        assert any((m[i:i + minhash.ROWS, 0] == m[i:i + minhash.ROWS, 1]).all() for i in range(0, len(m), minhash.ROWS))
        assert (textbatch.mix(m[:, 0]) & np.uint64(1) != textbatch.mix(m[:, 1]) & np.uint64(1)).sum() <= bound


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    edges += [(5, 5), (None, 3), (41, 40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = components.components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()
    assert sorted((x["node"], x["component"]) for x in got) == sorted((n, find(n)) for n in parent)
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# operator 6

def test_decontamination(docs, spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [(r["item_id"], r["text"]) for r in items.collect()]
    got = {r["doc_id"]: r for r in decontam.decontaminate(docs, items).collect()}
    want = {i for i, t in pairs(docs) if any(x in (t or "") for _, x in texts)}
    assert want and {i for i, r in got.items() if r["contaminated"]} == want
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(want)


def test_decontamination_slots(spark, odd, empty):
    item = ("If Maria Lopez buys 12 apples for 3 dollars each and then sells 12 of them to Jon at the market by the river, "
            "how many dollars does Maria Lopez have left in her purse after paying 5 percent tax?")
    again = (item.replace("Maria Lopez", "Ann").replace("12", "40").replace("Jon", "Ravi Rao").replace("3 dollars", "9 euros")
             .replace("5 percent", "8 percent"))
    torn = again.replace("sells 40 of", "sells 77 of").replace("does Ann", "does Omar")
    items = spark.createDataFrame([(1, item), (2, None), (3, "Short item only"), (4, "This is a six word item.")],
                                  "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"Intro text. {again} Outro."), (2, f"Intro text. {torn} Outro."), (3, item), (4, "A short item only is here"),
         (5, None), (6, "He said this is a six word item, twice."), (3, item)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontam.decontaminate(docs, items).collect()}
    assert [i for i, r in sorted(got.items()) if r["contaminated"]] == [1, 3, 6]
    assert got[1]["item_ids"] == [1] and got[6]["item_ids"] == [4] and got[2]["share"] == 0
    assert decontam.decontaminate(odd, items).filter("contaminated").count() == 0
    assert decontam.decontaminate(empty, items).count() == 0
    assert decontam.decontaminate(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontam.drop_contaminated(odd, items).columns == odd.columns


def test_decontamination_exact_items(spark):
    """Items without a literal-rich window are found as they stand."""
    texts = ["Who wrote Hamlet?", "What is 12 + 7 * 3 - 4 / 2?", "THE CAPITAL OF FRANCE IS WHICH OF THESE CITIES TODAY?",
             "What Is The Name Of The River That Runs Through London And Oxford?", "世界上最高的山峰是哪一座山？", "2 + 2"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(i, f"Some words stand before, {t} And some after it.") for i, t in enumerate(texts)]
    rows += [(10, f"前文{texts[4]}后文"), (11, "What is 12 - 7 * 3 + 4 / 2?"), (12, "Who wrote it? Hamlet did."), (13, "世界上最高的"),
             (14, texts[2].lower()), (15, "12 + 2"), (16, "THE CAPITAL OF FRANCE IS WHICH. IS WHICH OF THESE CITIES TODAY")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["item_ids"] for r in decontam.decontaminate(df, items).collect()}
    assert got == {**{i: [i] for i in range(6)}, 10: [4], 11: [], 12: [], 13: [], 14: [2], 15: [], 16: []}
    assert {r["doc_id"] for r in decontam.drop_contaminated(df, items).collect()} == {11, 12, 13, 15, 16}


def test_decontamination_readings(spark):
    """Names at the start of sentences, number words, and two values that
    become one are re-parameterised as well."""
    first = "Betty saves 5 dollars of her pocket money every week. Betty has already spent 20 dollars on new books."
    second = "The farmer sold 3 large boxes and 5 small boxes of ripe fruit to every shop along the road."
    third = "The baker sells three loaves of fresh bread to each of forty customers who visit the shop before noon."
    items = spark.createDataFrame([(1, first), (2, second), (3, third)], "item_id long, text string")
    docs = [(1, first.replace("Betty", "Carlos")), (2, second.replace("3", "4").replace("5", "4")),
            (3, third.replace("three", "twenty five").replace("forty", "ninety-one")), (4, third.replace("three", "7").replace("forty", "88")),
            (5, "Betty reads the paper. Then the farmer and the baker close their shops and walk home along the road.")]
    df = spark.createDataFrame([(i, f"Some text before. {t} And after.") for i, t in docs], "doc_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontam.decontaminate(df, items).collect()}
    assert got == {1: [1], 2: [2], 3: [3], 4: [3], 5: []}


# operator 7

def test_sharding(table):
    rows = sharding.byte_shards(table).collect()
    total = sum(r["size"] for r in rows)
    content = {}
    for i, t in pairs(table):
        b = (t or "").encode()
        content.setdefault(i, []).append((len(b) + 1, zlib.crc32(b)))
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["size"], r["text_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in content.items()}
    rows.sort(key=lambda r: (r["shard"], r["slot"]))
    for _, g in itertools.groupby(rows, key=lambda r: r["shard"]):
        slots = [r["slot"] for r in g]
        assert slots == list(range(len(slots)))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    largest = max(r["size"] for r in rows)
    sizes = {k: sum(r["size"] for r in rows if r["shard"] == k) for k in range(16)}
    assert all(abs(s - total / 16) <= largest for s in sizes.values())


# operator 8

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>x</p>";</script><style>p{}</style></head><body>
<header class="site"><a href="/">Home</a> Site name</header><nav><ul><li><a href=a>One</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="layout"><main><article class="post post-12">
<header><h1>Title &amp; more</h1></header><p>First   para<br>goes&nbsp;on.<p>Second <b>one</b>
<div class="ad">Buy!</div><ul><li>item a<li>item b</ul><form>Name <input name=n><button>Go</button></form>
<blockquote>Said.</blockquote><!-- <p>no</p> --></article><section class="comments"><p>Reader says a lot of things here, really a lot,
and goes on and on and on for more than the article itself has to say, which is how it is.</p></section></main>
<aside><p>Side text</p></aside></div><footer>&copy; me</footer></body></html>"""


def test_html_page(spark):
    want = "Title & more\n\nFirst para goes on.\n\nSecond one\n\nitem a\n\nitem b\n\nSaid."
    rows = [(i, f"http://h.example/{i}", PAGE) for i in range(3)]
    rows += [(10, None, None), (11, "nonsense", ""), (12, "http://h.example/x", "<p>Only text &lt;here&gt;"),
             (13, "http://h.example/y", PAGE[:PAGE.index("</article>") - 30]), (None, "http://h.example/1", PAGE), (14, None, "plain")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_extract.main_text(df).collect()}
    assert all(got[i]["text"] == want for i in (0, 1, 2, None))
    assert got[10]["text"] == "" and got[11]["text"] == "" and got[14]["text"] == "plain"
    assert got[12]["text"] == "Only text <here>"
    assert got[13]["text"].startswith("Title & more\n\nFirst para goes on.")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_html_consensus(spark):
    """A page whose own best container is not the article follows its host."""
    page = '<body><div class="story"><h1>Head</h1><p>{}</p></div><div class="box"><p>{}</p></div></body>'
    rows = [(i, f"http://x.org/{i}", page.format("Article text " * 30, "Boxed")) for i in range(9)]
    rows.append((99, "http://x.org/99", page.format("Little text.", "Very long box text. " * 50)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(df).collect()}
    assert got[99] == "Head\n\nLittle text."


def test_html_table(spark):
    """The article's blocks of the given pages, by a plain cut."""
    import html
    import re
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body))]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_html_noisy_names(spark):
    """Names of classes do not hide a page's text, and values are no attributes."""
    text = "<p>" + "The article text goes on. " * 12 + "</p>"
    want = " ".join(["The article text goes on."] * 12)
    bodies = [f'<article class="post tag-privacy">{text}</article><div class="comments"><p>{"Reader said so. " * 60}</p></div>',
              f'<div class="content has-sidebar">{text}<div class="sidebar"><p>Side.</p></div></div>',
              f'<section class="discussion">{text}</section>', f'<main class="search-page"><article>{text}</article></main>',
              f'<div title="a hidden gem" data-hidden="false" data-class="ad">{text}</div>', f'<div class="sidebar">{text}</div>',
              f'<article><div class="story">{text}</div><section class="comments"><p>{"Reader said so. " * 60}</p></section></article>',
              f'<article>{text}</article><article class="comment"><p>{"Reader said so. " * 60}</p></article>',
              f'<p class="notice">{text[3:-4]}</p>', f'<div hidden><p>No.</p></div><div>{text}</div>']
    rows = [(i, f"http://h{i}.example/", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extract.main_text(df).collect()} == {i: want for i in range(len(bodies))}


def test_html_raw_names(spark):
    """Custom elements named like raw ones, and unclosed raw ones, leave the article."""
    bodies = ['<svg-icon name="x"></svg-icon>{}', "<template-card>{}</template-card>", "<title-bar>T</title-bar>{}", "<svg><path d=x>{}",
              "<math>{}", "<noscript>{}", "<svg><text>No</text></svg >{}", "<iframe-resizer/>{}", "{}<script>var a = 1;"]
    rows = [(i, f"http://h{i}.example/", "<body>" + b.format("<article><p>All of it.</p></article>")) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in html_extract.main_text(df).collect()} == {"All of it."}


def test_html_two_templates(spark):
    """A minority page keeps its article; a title beside the text block stays."""
    major = '<body><div class="story"><p>{}</p></div><div class="foot"><p>Fine print.</p></div></body>'
    minor = '<body><div class="story"><p>A small block.</p></div><div class="longread"><p>{}</p></div></body>'
    plain = '<body><div class="story"><p>A small block.</p></div><p>{}</p></body>'
    titled = "<html><body><main><h1>Title</h1><div><p>{}</p></div></main></body></html>"
    long = " ".join(["Article text."] * 60)
    rows = [(i, f"http://two.example/{i}", major.format(long)) for i in range(9)]
    rows += [(20, "http://two.example/20", minor.format(long)), (21, "http://two.example/21", plain.format(long))]
    rows += [(i, f"http://main.example/{i}", titled.format(long)) for i in range(30, 34)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(df).collect()}
    assert all(long in t for t in got.values())
    assert got[20] == long and got[21] == f"A small block.\n\n{long}"
    assert all(got[i] == f"Title\n\n{long}" for i in range(30, 34))


# operator 9

def test_licenses(table):
    got = licenses.scan(table).collect()
    want = [(i, *brute.base_licenses(t), *brute.license_labels(t, rules(), licenses.BASE_SCORE)) for i, t in pairs(table)]
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == sorted(want, key=key)


def test_license_overlaps(spark):
    texts = ["Licensed under the GNU General Public License, version 3 (or GPL v2).", "cc by cc by cc-by-nc 4.0",
             "under the Apache License, Version 2.0; the MIT license; émit license mit licenses",
             "SPDX-License-Identifier: GPL-2.0-or-later", "Creative Commons Attribution-ShareAlike 4.0 International License"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["labels"], got[i]["score"]) == brute.license_labels(t, rules(), licenses.BASE_SCORE)
        assert tuple(got[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute.base_licenses(t)
    assert got[0]["labels"] == "gpl,gpl-2.0,gpl-3.0" and got[1]["labels"] == "cc-by,cc-by-nc-4.0"
    assert got[4]["labels"] == "cc-by-sa-4.0"


def sample(pattern, r):
    """A random text that the pattern matches."""
    import re._parser as parser

    def walk(items):
        out = ""
        for op, x in items:
            op = str(op)
            if op == "LITERAL":
                out += chr(x)
            elif op == "ANY":
                out += "z"
            elif op == "IN":
                kind, v = r.choice(x)
                out += chr(v) if str(kind) == "LITERAL" else chr(r.randint(*v))
            elif op == "BRANCH":
                out += walk(r.choice(x[1]))
            elif op == "SUBPATTERN":
                out += walk(x[3])
            else:  # repeats
                out += "".join(walk(x[2]) for _ in range(r.randint(x[0], min(x[1], x[0] + 2))))
        return out

    return walk(parser.parse(pattern))


def test_license_gates():
    """Every match of a rule holds its keyword and one of the stems."""
    from skylight.llm.license_rules import STEMS
    r = random.Random(8)
    for _, _, _, _, keyword, pattern in rules():
        for _ in range(40):
            text = sample(pattern, r)
            assert keyword in text and any(s in text for s in STEMS), (keyword, text)
    assert all(any(s in phrase for s in STEMS) for phrase in licenses.BASE)
    assert len(rules()) > 200


def test_license_scan_is_native(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = lines.drop_boilerplate(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# operator 10

def test_pieces(table):
    import sentencepiece
    model = tokenizer_path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = pieces.decode(pieces.encode(table, model), model)
    assert pieces.encode(table, model, decoded="decoded").exceptAll(rows).count() == 0
    assert rows.columns == [*table.columns, "piece_ids", "decoded"]
    for r in rows.collect():
        assert (r["piece_ids"] is None) == (r["text"] is None)
        if r["text"] is not None:
            assert list(r["piece_ids"]) == m.encode(r["text"])
            assert r["decoded"] == r["text"]


def test_pieces_literal_marks(spark):
    """A literal mark before spaces is one run with them, as in the library."""
    import sentencepiece
    model = tokenizer_path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=model)
    r = random.Random(5)
    texts = ["!▁ 0", "x▁ ", "▁", " ▁", "▁ a", "a ▁ ▁b"]
    texts += ["".join(r.choice("ab!0 ▁▂é") for _ in range(r.randint(0, 12))) for _ in range(10000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: list(x["piece_ids"]) for x in pieces.encode(df, model).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != m.encode(t)] == []


def test_viterbi_is_best():
    """Unigram: no segmentation scores higher; shared prefixes change nothing."""
    p = pieces.Pieces(tokenizer_path("piece_bpe_32k.model"), "unigram")
    words = sorted(pieces.MARK + w for w in ("the", "then", "thence", "hest", "heston", "nation", "national", "ouere", "é☃x"))
    coded = p.code(words)

    def all_cuts(w):
        return [[w]] + [[w[:i], *c] for i in range(1, len(w)) for c in all_cuts(w[i:])]

    cost = lambda c: sum(p.score.get(x, p.unknown if len(x) == 1 else -1e18) for x in c)
    for w in words:
        own = []
        for i in coded[w]:
            own.append(p.text[i])
        text = p.decode(np.array(coded[w]), np.array([len(coded[w])]))[0]
        assert text == w[1:]
        top = max(map(cost, all_cuts(w)))
        if all(x in p.score for x in own):
            assert cost(own) == top


# all

def test_empty_tables(empty, spark, tmp_path):
    model, bpe = tokenizer_path("piece_bpe_32k.model"), tokenizer_path("byte_bpe_50k.json")
    for df in (quality.quality_rules(empty), quality.keep_good(empty), lines.drop_boilerplate(empty), tokens.token_files(empty, bpe),
               suffix.suffix_dedup(empty), minhash.near_duplicates(empty), minhash.keep_first(empty), sharding.byte_shards(empty),
               licenses.scan(empty), pieces.decode(pieces.encode(empty, model), model)):
        assert df.count() == 0


def test_queries_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_op3_full_store_leaves_pieces_met_again():
    """A full store of coded pieces gave up all of them, and coded them anew."""
    import numpy as np

    from skylight.llm.tokens import Store
    s = Store(4)
    put = lambda *keys: s.put(np.array(keys, np.uint64), np.array([k % 3 for k in keys]),
                              np.array([k for k in keys for _ in range(k % 3)], np.int32))
    ask = lambda *keys: s.missing(np.array(keys, np.uint64)).tolist()
    assert ask(1, 2, 5) == [0, 1, 2]
    put(1, 2, 5)
    assert ask(2, 4, 7, 8) == [1, 2, 3]
    put(4, 7, 8)
    assert ask(2, 5) == [1]  # thinned: only 2 was met again
    put(5)
    ids, each = s.get(np.array([2, 5], np.uint64), np.array([1, 0, 1]))
    assert ids.tolist() == [5, 5, 2, 2, 5, 5] and each.tolist() == [2, 2, 2]


def test_op12_texts_without_partner_stay_out_of_the_shuffle(spark):
    """All texts were shuffled to find those of the chosen sets."""
    from skylight.llm import ngram_join
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(9))) for i in range(4000)] + [(7, "other words of an equal id"), (None, "a b")],
                                 "doc_id long, text string")
    docs = docs.unionByName(docs.filter("doc_id = 40"))
    want = spark.createDataFrame([(i,) for i in range(0, 4000, 20)], "doc_id long")
    left = [r.doc_id for r in ngram_join.among(docs, "doc_id", want).collect()]
    assert {*range(0, 4000, 20)} <= set(left) and left.count(40) == 2 and len(left) < 800
    assert ngram_join.among(docs, "doc_id", want.filter("false")).count() == 0
    sets = ngram_join.light(docs).filter("doc_id % 20 = 0").selectExpr("s", "doc_id as doc").distinct()
    lists = ngram_join.token_lists(docs, sets, "doc_id", "text").collect()
    assert sorted(r.s for r in lists) == sorted(r.s for r in sets.collect()) and all(r.n == len(r.tokens) == 5 for r in lists)
