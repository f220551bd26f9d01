"""Plain per-row versions of the operators' contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def shingles(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def near(rows):
    """doc_id -> (sizes, component), exactly."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            by[x].add(k)
    seen = set()
    for ks in by.values():
        for a in ks:
            for b in ks:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    (i, s), (j, t) = sets[a], sets[b]
                    if i is not None and j is not None and 100 * len(s & t) >= 75 * len(s | t):
                        x, y = sorted((find(i), find(j)))
                        parent[y] = x
    return sorted((i, len(s), None if i is None else find(i)) for i, s in sets if i is not None), [len(s) for i, s in sets if i is None]


def suffix(rows, length=400):
    """Per row: (doc_id, n_bytes, n_removed, n_spans, sha256)."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words_of(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def base_licenses(text):
    w = words_of(text)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def license_labels(text, rules, base_score):
    """Labels and score by trying every rule at every word."""
    w = words_of(text)
    s = " ".join(w)
    starts = {}
    at = 0
    for i, x in enumerate(w):
        starts[at] = i
        at += len(x) + 1
    ends = {a + len(w[i]): i + 1 for a, i in starts.items()}
    found = []
    for _, label, priority, weight, _, pattern in rules:
        place = 0
        while place <= len(s):  # left to right, whole words, without overlap
            m = re.compile(r"(?:(?<= )|^)(?:" + pattern + r")(?= |$)").search(s, place)
            if not m:
                break
            found.append((starts[m.start()], ends[m.end()], priority, label, weight))
            place = m.end()
    keep = [m for m in found if not any(
        (o[0] <= m[0] and o[1] >= m[1]) and ((o[2] <= m[2] and o[1] - o[0] > m[1] - m[0]) or (o[2] < m[2] and o[:2] == m[:2]))
        for o in found)]
    base = base_licenses(text)[4]
    labels = {m[3] for m in keep} | set(filter(None, base.split(",")))
    return ",".join(sorted(labels)), max([0.0, *(m[4] for m in keep), *([base_score] if base else [])])


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def damaged(rows):
    """conv_id -> (turn, role, text) rows after the fixed damage, in order."""
    out = {}
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        mine = out.setdefault(c, [])
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            mine += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def _repairs(roles, must_go, truncated):
    """Best (cost, audit) of one conversation: whole audits, states of the
    wanted pattern, no ranks and no stack."""
    to = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for x in "ua":
                    if (state, x) in to:
                        new = (cost + 3, audit + "I")
                        best[to[state, x]] = min(best.get(to[state, x], new), new)
        return best

    best = {"": (0, "")}
    for role, gone, cut in zip(roles, must_go, truncated):
        new = {}
        for state, (cost, audit) in best.items():
            new[state] = min(new.get(state, (cost + 4, audit + "D")), (cost + 4, audit + "D"))
        # inserts from one state at a time: their audits continue that state's
        for state, found in best.items():
            for mid, (cost, audit) in insert({state: found}).items():
                for x, own, letter in ((role, 0, "K"), ("u", 3, "R"), ("a", 3, "R")):
                    if not gone and (mid, x) in to:
                        one = (cost + own + 3 * cut, audit + letter)
                        new[to[mid, x]] = min(new.get(to[mid, x], one), one)
        best = new
    ends = [e for state, found in best.items() for end, e in insert({state: found}).items() if end in ("", "a")]
    return min(ends)


def repair(rows):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) per conversation."""
    out = []
    for c, mine in damaged(rows).items():
        seen, faults = set(), []
        for _, role, text in mine:
            bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit = _repairs([r[:1] for _, r, _ in mine], [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        left, lines, n = iter(mine), [], 0
        for x in audit:
            _, role, text = (None, None, "") if x == "I" else next(left)
            if x != "D":
                want = "user" if n % 2 == 0 else "assistant"
                n += not (x == "K" and role[:1] == "s")
                lines.append(f"{role if x == 'K' else want}:{text}")
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def trie(rows, family=5, head=9):
    """Nodes of the prefix trie of the rebuilt conversations."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, (role or "").encode(), hashlib.sha256((text or "").encode()).digest(), (role or "", text or "")))
    convs = {c: [r[4] for r in sorted(x)] for c, x in convs.items()}
    if family:
        old = convs
        convs = {}
        for c, x in old.items():
            h = zlib.crc32(str(c).encode()) % head
            convs[c] = old.get(c - c % family, [])[:h] + x[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, x in convs.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
        ends[tuple(x)].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        own = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += own
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items()), key=repr)
