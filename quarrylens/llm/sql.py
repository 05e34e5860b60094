"""The operators that SQL can express, as SQL over the same tables."""

from __future__ import annotations


from . import quality
from .mixing import MixParams
from .queries import RULES

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _quality() -> str:
    p = quality.QualityParams()
    path = ", ".join(f"({k}, '{rule}', {c})" for k, (rule, c) in enumerate(quality.PATH, 1))
    bad = lambda cutoff: " OR ".join(f"(rule = '{rule}' AND 1000 * {a} > {cutoff} * {b})" for rule, (a, b) in quality.RULES.items())
    ws = r"[^\x20\x09-\x0D]"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, lang, text, regexp_extract_all(text, '{ws}+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{ws}')) AS lines FROM t),
g AS (SELECT rid, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
r AS (SELECT rid, count(DISTINCT i + j) AS n FROM (SELECT rid, i, unnest(range(0, 5)) AS j FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1) GROUP BY rid),
m AS (SELECT w.rid, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals, CAST(len(lines) AS BIGINT) AS n_lines
      FROM w LEFT JOIN r ON w.rid = r.rid),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
good AS (SELECT * FROM f WHERE doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)),
path(step, rule, cutoff) AS (VALUES {path}),
firsts AS (SELECT good.rid, any_value(good.lang) AS lang, min(step) AS step FROM good LEFT JOIN path ON {bad("cutoff")} WHERE NOT base_failed GROUP BY good.rid),
strata AS (SELECT lang, count(*) AS n FROM firsts GROUP BY lang HAVING count(*) >= {p.rows_needed(1)}),
tests AS (SELECT s.lang, s.n, p.step, (SELECT count(*) FROM firsts f WHERE f.lang IS NOT DISTINCT FROM s.lang AND f.step <= p.step) AS x FROM strata s, path p),
level AS (SELECT {p.level!r} / count(*) AS alpha FROM strata),
passed AS (SELECT lang, step, x < n AND list_sum(list_transform(range(0, x + 1), lambda i: exp(lgamma(n + 1) - (CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END) - (CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END) + i * ln({p.risk}) + (n - i) * ln(1 - {p.risk})))) <= alpha AS ok
           FROM tests, level),
held AS (SELECT lang, coalesce(min(step) FILTER (NOT ok), {len(quality.PATH) + 1}) - 1 AS step FROM passed GROUP BY lang),
cut AS (SELECT lang, rule, min(cutoff) AS cutoff FROM held JOIN path ON path.step <= held.step GROUP BY lang, rule),
bad AS (SELECT DISTINCT f.rid FROM f JOIN cut ON f.lang IS NOT DISTINCT FROM cut.lang WHERE {bad("cutoff")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept FROM f
"""


def _mixing() -> str:
    p = MixParams()
    weights = f"({list(p.weights)})[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(p.weights)} + 1 AS INT)]"
    return rf"""
WITH s AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(concat('{p.seed}', '|', coalesce(CAST(doc_id AS VARCHAR), ''), '|', md5(coalesce(text, '')))) AS digest FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
wt AS (SELECT source, source_size, CAST({weights} AS BIGINT) AS weight FROM src),
run AS (SELECT *, coalesce(sum(source_size) OVER o, 0) AS capped_size, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS left_weight, sum(source_size) OVER () AS all_size
        FROM wt WINDOW o AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT *, {p.share_percent} * all_size - {100 * p.most_copies} * capped_size AS rest FROM run),
cap AS (SELECT *, weight * rest >= left_weight * source_size * {100 * p.most_copies} AS capped FROM lvl),
free AS (SELECT rest AS r, left_weight AS lw FROM cap WHERE NOT capped ORDER BY left_weight DESC LIMIT 1),
tg AS (SELECT source, source_size, CASE WHEN capped THEN CAST({p.most_copies} * source_size AS DOUBLE) ELSE CAST(weight * (SELECT r FROM free) AS DOUBLE) / CAST(100 * (SELECT lw FROM free) AS DOUBLE) END AS target FROM cap),
rk AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, digest) AS rank FROM s),
off AS (SELECT source, target, source_size, CAST(concat('0x', substr(md5(concat('{p.seed}', '|offset|', coalesce(source, ''))), 1, 5)) AS BIGINT) / CAST({1 << 20} AS DOUBLE) AS u FROM tg),
c AS (SELECT doc_id, size, off.source_size, off.target, CASE WHEN off.source_size = 0 THEN 0 ELSE CAST(floor(target / CAST(source_size AS DOUBLE) * rank + u) - floor(target / CAST(source_size AS DOUBLE) * (rank - 1) + u) AS BIGINT) END AS copies
      FROM rk JOIN off ON rk.source IS NOT DISTINCT FROM off.source)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""


def _urls() -> str:
    order = sorted(RULES, key=lambda r: (-len(r.text), -len(r.host)))
    fits = lambda r: f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')"
    pick = lambda value, other: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in order) + f" ELSE {other} END"
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, {pick(lambda r: r.text, "NULL")} AS rule, {pick(lambda r: r.verdict, "'allow'")} AS verdict FROM h
"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, unsigned: its bytes in turn, eight shifts (-1) after each."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), lambda c, e: {step}), 4294967295)"


def _merkle() -> str:
    field = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
    leaf = lambda text: f"sha256({field('doc_id')} || {field('source')} || {field('lang')} || {field('n_chars')} || {field(text)})"
    # A tree's levels, and the path of each node: siblings before and after, from the node up.
    levels = lambda name, base: f"""
{name}(tree, level, number, n, hash) AS (SELECT tree, 0, number, n, hash FROM {base} UNION ALL
    SELECT tree, level + 1, number // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY number)) FROM {name} WHERE n > 1 GROUP BY tree, level, number // 16, n),
{name}_steps AS (SELECT a.tree, a.level, a.number, coalesce(string_agg(b.hash, '' ORDER BY b.number) FILTER (b.number < a.number), '') AS before, coalesce(string_agg(b.hash, '' ORDER BY b.number) FILTER (b.number > a.number), '') AS after
    FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.number // 16 = b.number // 16 WHERE a.n > 1 GROUP BY a.tree, a.level, a.number)"""  # noqa: E731
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf('low')} ELSE {leaf('text')} END AS altered
    FROM (SELECT *, translate(text, {_AZ}) AS low FROM documents)),
p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS number FROM d),
leaves AS (SELECT tree, number, count(*) OVER (PARTITION BY tree) AS n, leaf AS hash FROM p),{levels('low', 'leaves')},
tops AS (SELECT 0 AS tree, tree AS number, count(*) OVER () AS n, hash FROM low WHERE n = 1),{levels('high', 'tops')},
top AS (SELECT hash AS root FROM high WHERE n = 1),
fold(doc_id, leaf, tree, leaf_number, subroot, level, depth, node, proof) AS (
    SELECT doc_id, leaf, p.tree, p.number, s.hash, 0, CAST((SELECT max(level) FROM low l WHERE l.tree = p.tree) AS INT), altered, '' FROM p JOIN (SELECT tree, hash FROM low WHERE n = 1) s ON s.tree = p.tree
    UNION ALL
    SELECT doc_id, leaf, f.tree, leaf_number, subroot, f.level + 1, depth, sha256(coalesce(a.before, b.before) || node || coalesce(a.after, b.after)), proof || coalesce(a.before, b.before) || coalesce(a.after, b.after)
    FROM fold f LEFT JOIN low_steps a ON f.level < depth AND a.tree = f.tree AND a.level = f.level AND a.number = leaf_number // CAST(pow(16, f.level) AS BIGINT)
    LEFT JOIN high_steps b ON f.level >= depth AND b.level = f.level - depth AND b.number = f.tree // CAST(pow(16, greatest(f.level - depth, 0)) AS BIGINT)
    WHERE coalesce(a.before, b.before) IS NOT NULL)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM fold, top WHERE level = depth + (SELECT max(level) FROM high)
"""


def _structure() -> str:
    kept = "CASE WHEN ini = 's' AND q = 1 THEN 2 WHEN ini = 'u' AND q IN (1, 2, 4) THEN 3 WHEN ini = 'a' AND q = 3 THEN 4 END"
    least = lambda q, keep: f"least(4 + v[{q}], CASE WHEN fault < 2 THEN least(3 + fault * 3 + v[{(3, 3, 4, 3)[q - 1]}], CASE WHEN {keep} THEN fault * 3 + v[{(3, 3, 4, 3)[q - 1]}] ELSE 99999999 END) ELSE 99999999 END)"
    start = f"least({least(1, 'ini = ' + chr(39) + 'u' + chr(39))}, CASE WHEN fault < 2 AND ini = 's' THEN fault * 3 + v[2] ELSE 99999999 END)"
    u, a = "ini = 'u'", "ini = 'a'"
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c FROM conversations),
d AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
o AS (SELECT c, turn, role, text, rtrim(text, {ws}) AS stripped, left(role, 1) AS ini, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
f AS (SELECT c, turn, role, text, ini, i, CASE WHEN stripped = '' THEN 3 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2 WHEN right(stripped, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault, lag(ini) OVER (PARTITION BY c ORDER BY i) || ini AS pair FROM o),
n AS (SELECT c, conv_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT c, conv_id FROM k) LEFT JOIN (SELECT c, count(*) AS n FROM f GROUP BY c) USING (c)),
w(c, i, v) AS (SELECT c, n + 1, [0, 6, 3, 0] FROM n UNION ALL
    SELECT c, i, [least(w1, 3 + w3, 6 + w4), least(w2, 3 + w3, 6 + w4), least(w3, 3 + w4), least(w4, 3 + w3)]
    FROM (SELECT w.c, f.i, {start} AS w1, {least(2, u)} AS w2, {least(3, a)} AS w3, {least(4, u)} AS w4 FROM w JOIN f ON f.c = w.c AND f.i = w.i - 1)),
t(c, i, q, audit, body) AS (SELECT c, CAST(1 AS BIGINT), 1, '', '' FROM n UNION ALL
    SELECT c, CASE WHEN letter = 'I' THEN i ELSE i + 1 END, CASE letter WHEN 'D' THEN q WHEN 'K' THEN kept ELSE after END, audit || letter,
           CASE letter WHEN 'D' THEN body ELSE body || CASE WHEN body = '' THEN '' ELSE chr(10) END || CASE letter WHEN 'K' THEN role ELSE CASE after WHEN 3 THEN 'user' ELSE 'assistant' END END || ':' || CASE letter WHEN 'I' THEN '' ELSE text END END
    FROM (SELECT *, CASE WHEN role IS NOT NULL AND 4 + v1[q] = v0[q] THEN 'D' WHEN 3 + v0[after] = v0[q] THEN 'I' WHEN fault < 2 AND kept IS NOT NULL AND fault * 3 + v1[kept] = v0[q] THEN 'K' ELSE 'R' END AS letter
          FROM (SELECT t.*, role, text, fault, w0.v AS v0, w1.v AS v1, ([3, 3, 4, 3])[q] AS after, {kept} AS kept
                FROM t JOIN w w0 ON w0.c = t.c AND w0.i = t.i LEFT JOIN w w1 ON w1.c = t.c AND w1.i = t.i + 1 LEFT JOIN f ON f.c = t.c AND f.i = t.i)
          WHERE NOT (role IS NULL AND v0[q] = 0))),
counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(w.v[1] AS BIGINT) AS cost, audit, sha256(body) AS repaired_sha256
FROM n JOIN w ON w.c = n.c AND w.i = 1 JOIN t ON t.c = n.c AND t.i = n + 1 JOIN w e ON e.c = n.c AND e.i = n + 1 AND e.v[t.q] = 0 LEFT JOIN counts ON counts.c = n.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": DECONTAMINATION, "op8_quality": _quality(), "op9_mixing": _mixing(), "op10_urls": _urls(), "op11_merkle": _merkle(), "op12_conversations": _structure()}
