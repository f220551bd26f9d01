"""Operators 11 to 13 against plain versions, whole small tables and odd rows."""

import itertools
import random

import brute
import pytest
from llm_fixtures import docs, empty, odd  # noqa: F401 - fixtures

from skylight.llm import ngram_join, repair, trie

SCHEMA = "conv_id long, turn long, role string, text string, k string, part string, seq string, live string, digest string"
LONG = "word " * 60_000


def key(r):
    return repr(tuple(r))


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")


@pytest.fixture(scope="module")
def strange(spark):
    """Nulls, empty and very long texts, ties, repeats, one conversation with
    most of the rows, and columns whose names the operators use."""
    r = random.Random(11)
    texts = ["Yes.", "No", "", "  \t", None, "Why?\n", "Ok!", LONG, "é ", " "]
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant"]
    rows = [(r.choice([None, *range(12)]), r.choice([None, *range(-2, 9)]), r.choice(roles), r.choice(texts)) for _ in range(400)]
    rows += [(3, i // 3, r.choice(["user", "assistant"]), r.choice(["a.", "b", "c?", ""])) for i in range(900)]
    rows += [(20, 1, "user", "same.")] * 40 + [(25, 0, "user", "same."), (26, 0, "user", "same.")]
    return spark.createDataFrame([(*x, "k", "p", "s", "l", "d") for x in rows], SCHEMA).repartition(5)


# operator 11

def all_repairs(roles, faults):
    """Least (cost, audit) over every sequence of edits."""
    best, accepted = None, {"", "s"}
    for n in range(2 * len(roles) + 4):
        accepted |= {p + "ua" * n for p in ("", "s")}
    accepted.discard("s")
    per = [["D"] if f in (1, 3) else ["D", "K", "Ru", "Ra"] for f in faults]
    gaps = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*per):
        for ins in itertools.product(gaps, repeat=len(roles) + 1):
            out, audit, cost = ins[0], "I" * len(ins[0]), 3 * len(ins[0])
            for x, f, e, more in zip(roles, faults, edits, ins[1:]):
                out += "" if e == "D" else x if e == "K" else e[1]
                cost += {"D": 4, "K": 0, "R": 3}[e[0]] + (3 if f == 2 and e != "D" else 0) + 3 * len(more)
                audit += e[0] + "I" * len(more)
                out += more
            if out in accepted and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def parsed(roles, faults):
    level, back = {0: (0, 0, repair.STACKS[0])}, []
    for x, f in zip(roles, faults):
        level, step = repair.advance(level, x, f)
        back.append(step)
    cost, top, last = repair.finish(level)
    return cost, "".join(repair.letters_of(back, top)) + last


def test_cheapest_edits_against_all_edits():
    r = random.Random(1)
    for _ in range(60):
        n = r.randrange(0, 4)
        roles, faults = [r.choice("suat") for _ in range(n)], [r.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert parsed(roles, faults) == all_repairs(roles, faults)


@pytest.mark.parametrize("name", ["talks", "strange"])
def test_repair_report(request, name):
    t = request.getfixturevalue(name)
    got = sorted((tuple(r) for r in repair.report(repair.damaged(t)).collect()), key=key)
    assert got == sorted(brute.repair(rows_of(t)), key=key)


def test_repair_is_the_same_however_rows_are_spread(spark, strange):
    hurt = repair.damaged(strange)
    want = sorted((tuple(r) for r in repair.report(hurt).collect()), key=key)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 23):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted((tuple(r) for r in repair.report(hurt).collect()), key=key) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_repaired_rows_follow_the_grammar(strange):
    import hashlib
    import re
    hurt = repair.damaged(strange)
    sha = {r["conv_id"]: r["repaired_sha256"] for r in repair.report(hurt).collect()}
    by = {}
    for r in repair.repaired(hurt).collect():
        by.setdefault(r["conv_id"], []).append((r["part"], r["position"], r["role"], r["text"]))
    for conv, want in sha.items():
        rows = sorted(by.get(conv, []))
        assert re.fullmatch("(s?(ua)+)?", "".join(x[2][:1] for x in rows))
        assert hashlib.sha256("\n".join(f"{x[2]}:{x[3]}" for x in rows).encode()).hexdigest() == want


def test_repair_and_trie_of_nothing(talks):
    assert repair.report(repair.damaged(talks.limit(0))).collect() == []
    assert trie.conversation_trie(talks.limit(0), 5).collect() == []


# operator 12

def near80(rows):
    sets = [(i, brute.shingles(t)) for i, t in rows]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, s), (j, t) in itertools.combinations(sets, 2):
        if i is not None and j is not None and (s or t) and 100 * len(s & t) >= 80 * len(s | t):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=key)


@pytest.mark.parametrize("name,rare,k", [("docs", 1, 3), ("odd", 16, 2)])
def test_ngram_join(request, name, rare, k):
    t = request.getfixturevalue(name)
    got = sorted((tuple(r) for r in ngram_join.classes(t, rare=rare, k=k).collect()), key=key)
    assert got == near80([(r["doc_id"], r["text"]) for r in t.select("doc_id", "text").collect()])


def test_ngram_join_families_of_edited_copies(spark):
    """Chains of copies near the threshold, where one class holds unlike ends."""
    r = random.Random(3)
    rows, n = [], 0
    for _ in range(6):
        words = [f"w{r.randrange(5000)}" for _ in range(r.choice([9, 40, 120]))]
        for _ in range(25):
            rows.append((n, " ".join(words)))
            n += 1
            if r.random() < 0.8:
                words[r.randrange(len(words))] = f"w{r.randrange(5000)}"
    t = spark.createDataFrame(rows, "doc_id long, text string")
    for rare in (1,):
        assert sorted((tuple(x) for x in ngram_join.classes(t, rare=rare).collect()), key=key) == near80(rows)


@pytest.mark.parametrize("block,dense", [(2048, 128), (7, 1 << 40), (7, 0)])
def test_ngram_join_late_links_are_a_forest(spark, monkeypatch, block, dense):
    """Two components of 30 copies each, any two of which link, and sets of
    their own in one bucket: a link per set is enough, and none is lost."""
    for name, value in (("BLOCK", block), ("DENSE", dense)):
        monkeypatch.setattr(ngram_join, name, value)
    near = [(s, 100, [*range(95), *range(1000 + 5 * s, 1005 + 5 * s)]) for s in range(60)]
    far = [(100 + s, 100, [*range(60), *range(9000 + 40 * s, 9040 + 40 * s)]) for s in range(20)]
    nodes = spark.createDataFrame(near + far, "s long, n long, tokens array<long>")
    rows = nodes.selectExpr("1L AS key", "s", "n").unionByName(nodes.selectExpr("2L AS key", "s", "n"))
    label = spark.createDataFrame([(s, 0 if s < 30 else 30) for s in range(60)], "node long, component long")
    got = [tuple(r) for r in ngram_join.late_links(rows, label, nodes, 80).collect()]
    assert got and all(min(p) < 30 <= max(p) < 60 for p in got)
    if block > 60:
        assert len(got) < 60
        assert len({x for p in got for x in p}) == 60


def test_ngram_join_empty(empty):
    assert ngram_join.classes(empty).collect() == []


# operator 13

@pytest.mark.parametrize("name", ["talks", "strange"])
@pytest.mark.parametrize("family", [5, None])
def test_trie(request, name, family):
    t = request.getfixturevalue(name)
    got = sorted((tuple(r) for r in trie.conversation_trie(t, family).collect()), key=key)
    want = sorted(brute.trie(rows_of(t), family), key=key)
    assert got == want


def test_trie_of_long_conversations_in_blocks(strange, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    got = sorted((tuple(r) for r in trie.conversation_trie(strange, 5).collect()), key=key)
    assert got == sorted(brute.trie(rows_of(strange)), key=key)
