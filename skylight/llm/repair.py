"""Operator 11: conversation structure repair by generalised LR.

The roles of a conversation, by their initials, should read ``(s?(ua)+)?``.
The parser of the grammar

    C -> (nothing) | P | s P        P -> u a | P u a

keeps a graph-structured stack: after every row one node per stack top, each
linked to the shared nodes below it. A row may be kept (0), reroled to user or
assistant (3) or deleted (4); an empty user or assistant row may be inserted
anywhere (3); a truncated row that stays adds 3; blank and repeated rows must
go. Equal tops are merged by the least (cost, audit). The audit has a letter
per edit (D, I, K, R). Inserts come right before a row that stays, never
before a deletion ("DI" < "ID"), so the audits of one level hold the same
rows, none is the start of another, and a rank of four or five of them stands
for the texts.

Rows are ordered by turn (NULL first), role, SHA-256 of the text, and sorted
by range over all partitions: a conversation of any size is spread like any
other rows. Conversations that lie inside a partition are repaired there, one
at a time. The first and the last of a partition may go on in the next one:
their rows are blocks of (conversation, partition). A block is parsed once
from every top it may start with, a small table of (cost, rank) by start and
end; the blocks of a conversation, no more than there are partitions, are
chained over these tables, and each block then gives its audit and its rows
for the chosen start and end. Only the SHA-256 of a repaired conversation is
serial by nature: one task streams over its rows with constant memory.

Defined cases. NULL role or text: one space, so a NULL text is blank; NULL
conv_id: a conversation of its own; NULL turn: first, counts in no gap. Equal
turns: by role and text digest, repeated rows stay adjacent and are
duplicates. Empty text: blank. Very long texts are whole. A role with another
initial can be kept nowhere. No live rows: zeros, empty audit, no rows. Empty
table: no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Faults of a row: none, blank, truncated; a row seen earlier is a duplicate.
NONE, BLANK, CUT, DUPLICATE = 0, 1, 2, 3
WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}

# LR(0) automaton of the grammar. 0: start, 1: s, 2: u of the first pair, 3 and
# 4: P without and with s, 5: u a, 6: u of a later pair, 7: P u a
SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 5}, 3: {"u": 6}, 4: {"u": 6}, 6: {"a": 7}}
REDUCE = {5: ("P", 2), 7: ("P", 3)}
GOTO = {(0, "P"): 3, (1, "P"): 4}
ACCEPT = {0, 3, 4}
#: A stack for every top; which node lies under an equal top changes no cost.
_BOTTOM = (0, None)
STACKS = {0: _BOTTOM, 1: (1, _BOTTOM), 2: (2, _BOTTOM), 3: (3, _BOTTOM), 4: (4, (1, _BOTTOM)), 6: (6, (3, _BOTTOM))}


@functools.cache
def shift(stack: tuple, initial: str) -> tuple | None:
    """The stack after a terminal, reduced; None where the grammar has none."""
    to = SHIFT[stack[0]].get(initial)
    if to is None:
        return None
    stack = (to, stack)
    while stack[0] in REDUCE:
        name, size = REDUCE[stack[0]]
        for _ in range(size):
            stack = stack[1]
        stack = (GOTO[stack[0], name], stack)
    return stack


@functools.cache
def after_inserts(stack: tuple) -> list[tuple[str, int, tuple]]:
    """(letters, cost, stack) after no, one and two inserted rows; more come
    back to an earlier top."""
    out = [("", 0, stack)]
    for _ in range(2):
        letters, cost, at = out[-1]
        to = shift(at, "u") or shift(at, "a")
        out.append((letters + "I", cost + INSERT, to))
    return out


@functools.cache
def actions(stack: tuple, initial: str, fault: int) -> list[tuple[int, str, tuple]]:
    """(cost, letters, stack): the best edit of one row towards each top."""
    best = {stack[0]: (DELETE, "D", stack)}
    if fault not in (BLANK, DUPLICATE):
        stays = TRUNCATED if fault == CUT else 0
        for letters, cost, at in after_inserts(stack):
            for to, own, letter in ((initial, KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
                new = shift(at, to)
                if new is not None:
                    found = (cost + own + stays, letters + letter, new)
                    best[new[0]] = min(best.get(new[0], found), found, key=lambda x: x[:2])
    return list(best.values())


Level = dict[int, tuple[int, int, tuple]]


def advance(level: Level, initial: str, fault: int) -> tuple[Level, dict[int, tuple[int, str]]]:
    """The stack tops after one row, and for each the top before and the edit's
    letters. A top has its cost, the rank of its audit, and its stack."""
    best: dict[int, tuple] = {}
    for top, (cost, rank, stack) in level.items():
        for more, letters, new in actions(stack, initial, fault):
            found = (cost + more, rank, letters)
            if new[0] not in best or found < best[new[0]][0]:
                best[new[0]] = (found, new, top)
    ranks = {t: i for i, t in enumerate(sorted(best, key=lambda t: best[t][0][1:]))}
    return ({t: (x[0][0], ranks[t], x[1]) for t, x in best.items()},
            {t: (x[2], x[0][2]) for t, x in best.items()})


def finish(level: Level) -> tuple[int, int, str]:
    """Cost, top and last inserts of the best end."""
    ends = []
    for top, (cost, rank, stack) in level.items():
        for letters, more, at in after_inserts(stack):
            if at[0] in ACCEPT:
                ends.append((cost + more, rank, letters, top))
                break
    cost, _, letters, top = min(ends)
    return cost, top, letters


def letters_of(back: list[dict[int, tuple[int, str]]], top: int) -> list[str]:
    """The letters of every row's edit, read backwards from the last top."""
    out = []
    for step in reversed(back):
        top, letters = step[top]
        out.append(letters)
    return out[::-1]


class Rewriter:
    """Repaired (role, text) rows from edits, in order."""

    def __init__(self, top: int = 0):
        self.next = "a" if top in (2, 6) else "u"

    def _turn(self) -> str:
        now, self.next = self.next, "a" if self.next == "u" else "u"
        return ROLES[now]

    def rows(self, letters: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        for x in letters:
            if x == "I":
                yield x, self._turn(), ""
            elif x == "R":
                yield x, self._turn(), text
            elif x == "K":
                if role[:1] != "s":
                    self._turn()
                yield x, role, text


def _line(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode()


LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
_KINDS = ("kind string, conv_id long, part int, seq long, turn long, role string, text string, fault int, edit string, "
          + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
_NAMES = [x.split()[0] for x in _KINDS.split(", ")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
_SCHEMA = pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in _KINDS.split(", ")])


def _gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def _whole(rows: list[tuple], as_turns: bool) -> list[dict]:
    """One conversation's rows (turn, role, text, fault): its report, or its
    repaired rows."""
    seen, level, back, faults, turns = set(), {0: (0, 0, _BOTTOM)}, [], [0, 0, 0, 0], []
    before, illegal = None, 0
    for turn, role, text, fault in rows:
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        faults[fault] += 1
        if turn is not None:
            turns.append(turn)
        illegal += before is not None and before + role[:1] not in LEGAL
        before = role[:1]
        level, step = advance(level, role[:1], fault)
        back.append(step)
    cost, top, last = finish(level)
    edits = letters_of(back, top)
    made, again = Rewriter(), []
    for (_, role, text, _), letters in zip(rows, edits):
        again += made.rows(letters, role, text)
    again += made.rows(last, "", "")
    if as_turns:
        return [{"kind": "turn", "seq": i, "edit": e, "role": r, "text": t} for i, (e, r, t) in enumerate(again)]
    return [{"kind": "report", "gaps": _gaps(turns), "blank": faults[BLANK], "duplicate": faults[DUPLICATE],
             "truncated": faults[CUT], "illegal": illegal, "cost": cost, "audit": "".join(edits) + last,
             "repaired_sha256": hashlib.sha256(b"\n".join(_line(r, t) for _, r, t in again)).hexdigest()}]


def _batches(rows: Iterator[dict], size: int = 4096, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for r in rows:
        held.append(r)
        held_bytes += len(r.get("text") or "")
        if len(held) >= size or held_bytes >= most:
            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)


def _sorted_runs(batches: Iterator[pa.RecordBatch], as_turns: bool) -> Iterator[dict]:
    """Reports (or turns) of the conversations inside the partition, and the
    rows of its first and its last one as they are."""
    part = TaskContext.get().partitionId()
    now, held, first, seq = None, [], True, 0

    def raw(conv, turn, role, text, fault, live):
        nonlocal seq
        seq += 1
        return {"kind": "cut" if live else "cut_gone", "conv_id": conv, "part": part, "seq": seq, "turn": turn, "role": role,
                "text": text, "fault": fault}

    begun = False
    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "live"))):
            if not begun or conv != now:
                if begun and not first:
                    yield from ({"conv_id": now, **r} for r in _whole([x[:4] for x in held if x[4]], as_turns))
                first, begun = not begun, True
                now, held = conv, []
            if first:  # may have begun in an earlier partition
                yield raw(conv, *row)
            else:
                held.append(row)
    for row in held:  # may go on in the next one
        yield raw(now, *row)


def _parsed(turns: DataFrame, as_turns: bool) -> DataFrame:
    """Rows of ``_KINDS``, stored."""
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "uid"]
    rows = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "live")
            .withColumn("digest", F.unhex(F.sha2("text", 256)))
            .withColumn("fault", _fault("text"))
            # identical rows are spread as well; which is which changes nothing
            .withColumn("uid", F.monotonically_increasing_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_sorted_runs(batches, as_turns))

    return stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .select("conv_id", "turn", "role", "text", "fault", "live").mapInArrow(run, _KINDS), "repair")


def _fault(text: str):
    bare = F.rtrim(F.col(text), F.lit(WHITE))
    return (F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), NONE).otherwise(CUT)).cast("int")


# conversations over several partitions

def _table(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block: (cost, rank) by start and end top, its counts and its edges."""
    pdf = pdf.sort_values("seq")
    rows = list(zip(pdf["initial"], pdf["fault"]))
    start, end, cost, rank = [], [], [], []
    for s, stack in STACKS.items():
        level: Level = {s: (0, 0, stack)}
        for initial, fault in rows:
            level, _ = advance(level, initial, fault)
        for t, (c, r, _) in level.items():
            start.append(s)
            end.append(t)
            cost.append(c)
            rank.append(r)
    initials = pdf["initial"].tolist()
    turns = pdf["turn"].dropna().astype("int64").tolist()
    fault = pdf["fault"].value_counts()
    return pd.DataFrame([{
        "k": pdf["k"].iloc[0], "part": pdf["part"].iloc[0], "start": start, "end": end, "cost": cost, "rank": rank,
        "first": initials[0], "last": initials[-1], "low": min(turns, default=None), "high": max(turns, default=None),
        "distinct": len(set(turns)), "blank": int(fault.get(BLANK, 0)), "duplicate": int(fault.get(DUPLICATE, 0)),
        "truncated": int(fault.get(CUT, 0)), "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))}])


_BLOCK = ("k string, part int, start array<int>, end array<int>, cost array<long>, rank array<int>, first string, last string, "
          "low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long")
_CHAIN = "k string, part int, start int, end int, tail string, head boolean, " + ", ".join(f"{c} long" for c in COUNTS)


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one conversation with the tops that the best parse has
    at their ends; the conversation's counts stand in its first block."""
    pdf = pdf.sort_values("part")
    level, back = {0: (0, 0)}, []
    gaps_low, gaps_high, distinct, illegal, before, before_high = None, None, 0, 0, None, None
    for b in pdf.itertuples():
        best: dict[int, tuple] = {}
        for s, t, c, r in zip(b.start, b.end, b.cost, b.rank):
            if s in level:
                found = (level[s][0] + c, level[s][1], r, s)
                if t not in best or found < best[t]:
                    best[t] = found
        order = {t: i for i, t in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
        level = {t: (x[0], order[t]) for t, x in best.items()}
        back.append({t: x[3] for t, x in best.items()})
        illegal += b.illegal + (before is not None and before + b.first not in LEGAL)
        before = b.last
        if b.distinct:
            # turns are sorted: a block shares at most its least turn with those before
            distinct += b.distinct - (before_high is not None and before_high == b.low)
            before_high = b.high
            gaps_low = b.low if gaps_low is None else gaps_low
            gaps_high = b.high
    cost, top, tail = finish({t: (c, r, STACKS[t]) for t, (c, r) in level.items()})
    tops = [top]
    for step in reversed(back):
        tops.append(step[tops[-1]])
    tops.reverse()
    out = pdf[["k", "part"]].copy()
    out["start"], out["end"] = tops[:-1], tops[1:]
    n = len(out)
    out["tail"] = [""] * (n - 1) + [tail]
    out["head"] = [True] + [False] * (n - 1)
    out["gaps"] = 0 if gaps_low is None else int(gaps_high - gaps_low + 1 - distinct)
    for c in ("blank", "duplicate", "truncated"):
        out[c] = int(pdf[c].sum())
    out["illegal"], out["cost"] = int(illegal), int(cost)
    return out


def _rewrite(pdf: pd.DataFrame) -> pd.DataFrame:
    """The repaired rows of one block; every row of the block carries at
    least an empty list of edits."""
    pdf = pdf.sort_values("seq")
    start, end, tail = (pdf[c].iloc[0] for c in ("start", "end", "tail"))
    level, back = {start: (0, 0, STACKS[start])}, []
    for role, fault in zip(pdf["role"], pdf["fault"]):
        level, step = advance(level, role[:1], fault)
        back.append(step)
    made, out = Rewriter(start), []
    edits = letters_of(back, end)
    edits[-1] += tail  # inserts after the last row
    for seq, role, text, letters in zip(pdf["seq"], pdf["role"], pdf["text"], edits):
        again = list(made.rows(letters, role, text))
        out.append((seq, letters, [r for _, r, _ in again], [t for _, _, t in again], [e for e, _, _ in again]))
    res = pd.DataFrame(out, columns=["seq", "letters", "roles", "texts", "edits"])
    res["k"], res["conv_id"], res["part"] = pdf["k"].iloc[0], pdf["conv_id"].iloc[0], pdf["part"].iloc[0]
    res["conv_id"] = res["conv_id"].astype("Int64")
    return res[["k", "conv_id", "part", "seq", "letters", "roles", "texts", "edits"]]


_REWRITTEN = ("k string, conv_id long, part int, seq long, letters string, roles array<string>, texts array<string>, "
              "edits array<string>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, streamed in order."""
    now, sha, some, out = None, None, False, []
    for batch in batches:
        for k, roles, texts in zip(*(batch.column(c).to_pylist() for c in ("k", "roles", "texts"))):
            if k != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha, some = k, hashlib.sha256(), False
            for r, t in zip(roles, texts):
                sha.update(b"\n" + _line(r, t) if some else _line(r, t))
                some = True
    if now is not None:
        out.append((now, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["k", "repaired_sha256"])


def _spread(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks with their tops, rewritten rows) of the conversations whose
    rows may lie in several partitions."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("k")
    cut = (parsed.filter("kind = 'cut'").select(key, "conv_id", "part", "seq", "turn", "role", "text", "fault")
           .withColumn("digest", F.sha2("text", 256)))
    first = cut.groupBy("k", "role", "digest").agg(F.min(F.struct("part", "seq")).alias("at"))
    again = (F.col("fault") != BLANK) & (F.col("at") != F.struct("part", "seq"))
    rows = stored(cut.join(first, ["k", "role", "digest"]).withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault")))
                  .drop("at", "digest"), "cut")
    blocks = (rows.select("k", "part", "seq", "turn", F.left("role", F.lit(1)).alias("initial"), "fault")
              .groupBy("k", "part").applyInPandas(_table, _BLOCK))
    chained = stored(blocks.groupBy("k").applyInPandas(_chain, _CHAIN), "chain")
    ends = chained.select("k", "part", "start", "end", "tail")
    rewritten = (rows.select("k", "conv_id", "part", "seq", "role", "text", "fault").join(ends, ["k", "part"])
                 .groupBy("k", "part").applyInPandas(_rewrite, _REWRITTEN))
    return chained, stored(rewritten, "rewritten")


def report(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, live):
    its faults, the cost and audit of the cheapest repair, and the SHA-256 of
    the repaired ``role:text`` lines. Rows that are not ``live`` only name
    their conversation."""
    parsed = _parsed(turns, as_turns=False)
    chained, rewritten = _spread(parsed)
    out = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    inside = parsed.filter("kind = 'report'").select(*out)
    joined = lambda by: F.array_join(F.sort_array(F.collect_list(F.struct(by, "letters")))["letters"], "")
    audit = (rewritten.groupBy("k", "part").agg(joined("seq").alias("letters"))
             .groupBy("k").agg(joined("part").alias("audit")))
    sha = (rewritten.select("k", "part", "seq", "roles", "texts").repartition("k").sortWithinPartitions("k", "part", "seq")
           .mapInArrow(_digests, "k string, repaired_sha256 string"))
    spread = (chained.filter("head").select("k", *COUNTS).join(audit, "k").join(sha, "k"))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("k")
    named = parsed.filter("kind IN ('cut', 'cut_gone')").select(key, "conv_id").distinct()
    edge = named.join(spread, "k", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
    return inside.unionByName(edge)


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, part, position, edit, role, text): the repaired rows, in the
    order of (part, position) per conversation; ``edit`` is K, R or I."""
    parsed = _parsed(turns, as_turns=True)
    _, rewritten = _spread(parsed)
    inside = parsed.filter("kind = 'turn'").select("conv_id", F.lit(0).alias("part"), F.col("seq").alias("position"), "edit", "role", "text")
    edge = (rewritten.select("conv_id", "part", "seq", F.posexplode(F.arrays_zip("edits", "roles", "texts")).alias("i", "x"))
            # at most two inserts before a row and two after it
            .select("conv_id", "part", (F.col("seq") * 8 + F.col("i")).alias("position"), F.col("x.edits").alias("edit"),
                    F.col("x.roles").alias("role"), F.col("x.texts").alias("text")))
    return inside.unionByName(edge)


def damaged(turns: DataFrame) -> DataFrame:
    """Fixed damage by crc32(``conv_id:turn``) modulo 20: 0 drops the row, 1
    empties its text, 2 removes its full stops, 3 repeats it, 4 makes it a
    user's. NULLs are one space there."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    return (turns.select("conv_id", "turn", "role", "text", how.alias("how"))
            .select("conv_id", F.when(F.col("how") != 0, F.col("turn")).alias("turn"),
                    F.when(F.col("how") == 0, "").when(F.col("how") == 4, "user").otherwise(blank("role")).alias("role"),
                    F.when(F.col("how") == 0, "").otherwise(text).alias("text"), (F.col("how") != 0).alias("live"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("how") == 3, 2).otherwise(1))).alias("copy")).drop("copy"))
