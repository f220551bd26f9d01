"""DuckDB texts for the queries that SQL can express."""

from __future__ import annotations

from . import license_rules, licenses, lines, quality, trie

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def op1() -> str:
    g = f"CAST({quality._LOG_GAMMA!r} AS DOUBLE)"
    rules = " UNION ALL ".join(
        f"SELECT r, lang, source, '{x}' AS rule, CASE WHEN {k} > 0 THEN {k} / {n} ELSE 0 END AS v, "
        f"CASE WHEN {k} > 0 THEN CAST({quality.SIGMAS} AS DOUBLE) / sqrt({e} / CAST({u} AS DOUBLE)) ELSE 0 END AS part FROM good"
        for x, (k, n, e, u) in quality.RULES.items())
    value = lambda b: f"CASE WHEN {b} = 0 THEN 0 ELSE CAST({quality._SMALLEST * 2} AS DOUBLE) / (1 + exp({g})) * exp({b} * {g}) END"
    spread = f"CAST({quality.SPREAD} AS DOUBLE)"
    part = lambda by: (f"CAST(floor({float(quality.PRIOR * quality._PARTS)} * (CAST(n AS DOUBLE) / CAST(sum(n) OVER "  # noqa: E731
                       f"(PARTITION BY {by}) AS DOUBLE))) AS BIGINT)")
    space = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{space}') AS w FROM d),
u AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM w),
x AS (SELECT *, lag(word) OVER o AS before, CASE WHEN lead(k, 4) OVER o IS NOT NULL THEN
        word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o END AS win
      FROM u WINDOW o AS (PARTITION BY r ORDER BY k)),
y AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 AS again FROM x),
z0 AS (SELECT *, bool_or(again) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM y),
z AS (SELECT *, covered AND NOT coalesce(lag(covered) OVER (PARTITION BY r ORDER BY k), false) AS run FROM z0),
c AS (SELECT r, count(*) AS n_words, sum(len(word)) AS word_chars, count(*) FILTER (WHERE covered) AS n_repeat_words,
        count(*) FILTER (WHERE word = before) AS n_stutter,
        count(*) FILTER (WHERE run) AS n_repeat_runs FROM z GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '{space}') GROUP BY r),
m AS (SELECT d.r, doc_id, lang, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_stutter, 0) AS n_stutter,
        coalesce(n_repeat_runs, 0) AS n_repeat_runs
      FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN n ON d.r = n.r),
f AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed FROM m),
good AS (SELECT * FROM f WHERE NOT base_failed),
v AS ({rules}),
b AS (SELECT *, CASE WHEN v <= {quality._SMALLEST} THEN 0 ELSE CAST(ceil(ln(v / CAST({quality._SMALLEST} AS DOUBLE)) / {g}) AS INT) END AS bucket FROM v),
s0 AS (SELECT lang, source, rule, bucket, {quality._PARTS} * count(*) AS n FROM b GROUP BY ALL),
s2 AS (SELECT rule, bucket, {part('rule')} AS n FROM (SELECT rule, bucket, sum(n) AS n FROM s0 GROUP BY ALL)),
s1 AS (SELECT lang, rule, bucket, sum(n) AS n FROM (SELECT lang, rule, bucket, n FROM s0
        UNION ALL SELECT x.lang, s2.rule, s2.bucket, s2.n FROM s2 JOIN (SELECT DISTINCT lang, rule FROM s0) x ON x.rule = s2.rule) GROUP BY ALL),
s3 AS (SELECT lang, rule, bucket, {part('lang, rule')} AS n FROM s1),
s AS (SELECT lang, source, rule, bucket, sum(n) AS n FROM (SELECT * FROM s0 UNION ALL SELECT x.lang, x.source, s3.rule, s3.bucket, s3.n
        FROM s3 JOIN (SELECT DISTINCT lang, source, rule FROM s0) x ON x.rule = s3.rule AND x.lang IS NOT DISTINCT FROM s3.lang) GROUP BY ALL),
q AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule) AS total,
        sum(n) OVER (PARTITION BY lang, source, rule ORDER BY bucket) AS upto FROM s),
p AS (SELECT lang, source, rule,
        min(CASE WHEN upto >= CAST(0.25 AS DOUBLE) * total THEN bucket END) AS b25,
        min(CASE WHEN upto >= CAST(0.5 AS DOUBLE) * total THEN bucket END) AS b50,
        min(CASE WHEN upto >= CAST(0.75 AS DOUBLE) * total THEN bucket END) AS b75 FROM q GROUP BY lang, source, rule),
val AS (SELECT *, {value('b25')} AS q25, {value('b50')} AS q50, {value('b75')} AS q75 FROM p),
own AS (SELECT *, q50 - {spread} * (q50 - q25) AS lo, q50 + {spread} * (q75 - q50) AS hi FROM val),
bad AS (SELECT DISTINCT v.r FROM v JOIN own ON v.rule = own.rule AND v.lang IS NOT DISTINCT FROM own.lang
        AND v.source IS NOT DISTINCT FROM own.source WHERE v * (1 - part) > hi OR v * (1 + part) < lo)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stutter, n_repeat_runs, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept FROM f"""


def op2() -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k
      FROM d WHERE text IS NOT NULL),
t AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
n AS (SELECT source, line, count(DISTINCT r) AS n FROM l
      WHERE trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ')) <> '' GROUP BY source, line),
b AS (SELECT n.source, n.line FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
      WHERE n.n >= {lines.MIN_PAGES} AND n.n > CAST({lines.RATIO} AS DOUBLE) * t.pages),
k AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.k) FILTER (WHERE b.line IS NULL) AS text, count(*) AS n_lines,
        count(b.line) AS n_dropped
      FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line GROUP BY l.r)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
  coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped FROM d LEFT JOIN k ON d.r = k.r"""


def near_classes(percent: int, last: str) -> str:
    """Components of documents whose shingle sets are ``percent`` similar."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM c JOIN n x ON c.a = x.doc_id JOIN n y ON c.b = y.doc_id WHERE 100 * k >= {percent} * (x.n + y.n - k)),
r(a, b) AS (SELECT DISTINCT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id{last}
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN m ON d.doc_id = m.a"""


def op5() -> str:
    return near_classes(75, ", d.doc_id = m.component_id AS kept")


def op12() -> str:
    return near_classes(80, "")


def op9() -> str:
    rules = ",\n".join(f"({i}, {_text(label)}, {p}, CAST({w} AS DOUBLE), {_text(k.replace(' ', '  '))}, {_text('(' + licenses.spaced(x) + ')')})"
                       for i, label, p, w, k, x in license_rules.rules())
    spaces = "(len({0}) - len(replace({0}, ' ', '')))"
    parts, places = [], []
    for i, phrase in enumerate(licenses.BASE):
        size = len(phrase.split())
        parts.append(f"string_split(words, {_text(' ' + phrase.replace(' ', '  ') + ' ')}) AS p{i}")
        inner = spaces.format(f"array_to_string(p{i}[:-2], '')")
        places.append((f"len(p{i}) - 1", f"CASE WHEN len(p{i}) > 1 THEN {spaces.format(f'p{i}[1]')} // 2 END",
                       f"CASE WHEN len(p{i}) > 1 THEN {inner} // 2 + (len(p{i}) - 2) * {size} END"))
    labels = ", ".join(f"CASE WHEN len(p{i}) > 1 THEN {_text(x)} END" for i, x in enumerate(licenses.BASE.values()))
    reach = " OR ".join(f"(priority = {p} AND coalesce(max(CASE WHEN priority <= {p} THEN b END) OVER o >= b, false))" for p in (1, 2, 3, 4))
    return rf"""
WITH rules(rule, label, priority, weight, keyword, pattern) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS norm FROM documents),
e AS (SELECT *, ' ' || replace(norm, ' ', '  ') || ' ' AS words FROM d),
f AS (SELECT *, {', '.join(parts)} FROM e),
base AS (SELECT r, doc_id, CASE WHEN norm = '' THEN 0 ELSE {spaces.format('norm')} + 1 END AS n_words, {' + '.join(x[0] for x in places)} AS n_base,
        list_min(list_filter([{', '.join(x[1] for x in places)}], lambda x: x IS NOT NULL)) AS first_word,
        list_max(list_filter([{', '.join(x[2] for x in places)}], lambda x: x IS NOT NULL)) AS last_word,
        list_sort(list_filter([{labels}], lambda x: x IS NOT NULL)) AS base FROM f),
p AS (SELECT r, rule, label, priority, weight, string_split(regexp_replace(words, pattern, chr(1) || '\1' || chr(2), 'g'), chr(1)) AS parts
      FROM e JOIN rules ON contains(words, keyword)),
q AS (SELECT r, rule, label, priority, weight, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM p WHERE len(parts) > 1),
m AS (SELECT *, sum({spaces.format('part')}) OVER (PARTITION BY r, rule ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 2 AS a,
        {spaces.format('string_split(part, chr(2))[1]')} // 2 AS own FROM q),
i AS (SELECT r, a, a + own AS b, priority, label, weight FROM m WHERE k > 1),
j AS (SELECT r, a, b, min(priority) AS priority FROM i GROUP BY r, a, b),
o AS (SELECT *, {reach} AS covered FROM j WINDOW o AS (PARTITION BY r ORDER BY a, b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS (SELECT i.r, list(DISTINCT label) AS found, max(weight) AS weight FROM o JOIN i USING (r, a, b, priority) WHERE NOT covered GROUP BY i.r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_base AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
  greatest(coalesce(weight, 0), CASE WHEN len(base) > 0 THEN {licenses.BASE_SCORE} ELSE 0 END)::DOUBLE AS score
FROM base LEFT JOIN kept ON base.r = kept.r"""


def _crc32(x: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(string_split({x}, ''), lambda b: ord(b)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda v, j: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""


def op11() -> str:
    white = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE
-- states: 0 nothing, 1 s, 2 u, 3 a
ins(st, ins, n, mid) AS (VALUES (0, '', 0, 0), (0, 'I', 1, 2), (0, 'II', 2, 3), (1, '', 0, 1), (1, 'I', 1, 2), (1, 'II', 2, 3),
  (2, '', 0, 2), (2, 'I', 1, 3), (2, 'II', 2, 2), (3, '', 0, 3), (3, 'I', 1, 2), (3, 'II', 2, 3)),
con(mid, x, st2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
src AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
how AS (SELECT *, {_crc32('name')} % 20 AS how FROM src),
hurt AS (SELECT r, conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
  CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy FROM how WHERE how <> 0),
seq AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), r, copy) AS i FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  regexp_replace(text, '{white}+', '', 'g') AS bare, left(role, 1) AS x, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS x0 FROM seq),
rows AS (SELECT *, bare = '' AS blank, bare <> '' AND again AS dup, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM seen),
act AS (SELECT c, i, blank OR dup AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more, x FROM rows),
opt AS (SELECT st, x, ins || 'K' AS letters, 3 * n AS cost, st2, true AS keeps FROM ins JOIN con USING (mid)
  UNION ALL SELECT st, NULL, ins || 'R', 3 * n + 3, st2, true FROM ins JOIN con USING (mid) WHERE x <> 's'
  UNION ALL SELECT DISTINCT st, NULL, 'D', 4, st, false FROM ins),
run(c, i, st, best) AS (SELECT DISTINCT c, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': ''}} FROM act
  UNION ALL SELECT run.c, act.i, opt.st2, min({{'cost': run.best.cost + opt.cost + CASE WHEN keeps THEN more ELSE 0 END, 'audit': run.best.audit || opt.letters}})
  FROM run JOIN act ON act.c = run.c AND act.i = run.i + 1 JOIN opt ON opt.st = run.st AND (opt.x IS NULL OR opt.x = act.x) AND NOT (keeps AND gone)
  GROUP BY run.c, act.i, opt.st2),
size AS (SELECT c, max(i) AS n FROM act GROUP BY c),
fin AS (SELECT run.c, min({{'cost': best.cost + 3 * ins.n, 'audit': best.audit || ins.ins}}) AS best
  FROM run JOIN size ON size.c = run.c AND size.n = run.i JOIN ins ON ins.st = run.st AND ins.mid IN (0, 3) GROUP BY run.c),
edit AS (SELECT c, unnest(string_split(best.audit, '')) AS e, generate_subscripts(string_split(best.audit, ''), 1) AS p FROM fin WHERE best.audit <> ''),
place AS (SELECT *, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY p) AS i FROM edit),
put AS (SELECT place.*, role, text, x, sum(CASE WHEN e = 'D' OR (e = 'K' AND x = 's') THEN 0 ELSE 1 END) OVER (PARTITION BY place.c ORDER BY p) AS k
  FROM place LEFT JOIN rows ON rows.c = place.c AND rows.i = place.i),
made AS (SELECT c, string_agg(CASE WHEN e = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END,
  chr(10) ORDER BY p) AS lines FROM put WHERE e <> 'D' GROUP BY c),
counts AS (SELECT conv_id, c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
  count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
  count(*) FILTER (WHERE x0 IS NOT NULL AND x0 || x NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id, c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(fin.best.cost, 0)::BIGINT AS cost, coalesce(fin.best.audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN fin ON fin.c = counts.c LEFT JOIN made ON made.c = counts.c"""


def op13() -> str:
    return rf"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place,
  length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || sha256(coalesce(text, '')) AS id,
  octet_length(encode(coalesce(text, '')))::BIGINT AS bytes FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT conv_id, conv_id - conv_id % {trie.FAMILY} AS base, {_crc32('conv_id::VARCHAR')} % {trie.HEAD} AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
turn AS (SELECT c.conv_id, 0 AS part, place, id, bytes FROM conv c JOIN own o ON o.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, id, bytes FROM conv c JOIN own o ON o.conv_id = c.conv_id AND place > h),
path AS (SELECT conv_id, list(id) OVER w AS key, bytes FROM turn WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
member AS (SELECT conv_id, key, bytes FROM path UNION ALL SELECT conv_id, [], 0 FROM conv),
node AS (SELECT key, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes, len(key) AS depth FROM member GROUP BY key),
child AS (SELECT key[:-2] AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
below AS (SELECT node.key[:d] AS key, sum((node.n - 1) * bytes) AS saved, count(*) FILTER (WHERE child.n IS NULL) AS leaves
  FROM node LEFT JOIN child USING (key), LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY ALL),
whole AS (SELECT conv_id, arg_max(key, len(key)) AS key FROM member GROUP BY conv_id),
fin AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM whole GROUP BY key)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(child.n, 0) AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM node JOIN below USING (key) LEFT JOIN child USING (key) LEFT JOIN fin USING (key) LEFT JOIN node up ON node.depth > 0 AND up.key = node.key[:-2]"""


def oracle_sql() -> dict[str, str]:
    return {"op11_conversation_repair": op11(), "op12_ngram_join": op12(), "op13_prefix_trie": op13(), "op1_quality_rules": op1(), "op2_line_dedup": op2(), "op5_minhash_near_dedup": op5(), "op9_license_scan": op9()}
