"""DuckDB SQL of the operators that SQL can express, written from their definitions."""

from __future__ import annotations

from salesmart.llm.quality import ENDS, NOTICES, SENTENCE, SEPARATORS, STOPS, SYMBOLS, Limits
from salesmart.llm.url_filter import Rule, Tree

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


EXACT_DEDUP = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def url_filter(rules: tuple[Rule, ...], tree: Tree = Tree()) -> str:
    def case(value: str) -> str:
        whens = [
            f"WHEN (host = {_text(r.host)} OR ends_with(host, {_text('.' + r.host)})) AND starts_with(path, {_text(r.path)})"
            f" THEN {_text(str(r) if value == 'rule' else r.verdict)}"
            for r in sorted(rules, key=lambda r: -len(str(r)))
        ]
        return f"CASE {' '.join(whens)} END"

    parts = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    segments = r"'(?s)^(/[^/]*)?(/[^/]*)?(.*)$'"
    levels, prefix = "", "host"
    for k in (1, 2, 3):
        seg, gen, source = f"s{k}", f"g{k}", "t0" if k == 1 else f"t{k - 1}"
        levels += f""",
child{k} AS (
  SELECT {prefix}, {seg}, CAST(sum(n) AS BIGINT) AS cn, CAST(sum(b) AS BIGINT) AS cb FROM {source} GROUP BY ALL),
parent{k} AS (
  SELECT *, sum(cn) OVER (PARTITION BY {prefix}) AS pn, sum(cb) OVER (PARTITION BY {prefix}) AS pb FROM child{k}),
named{k} AS (
  SELECT *, CASE WHEN cn < {tree.min_count} OR cn < CAST({tree.min_share} AS DOUBLE) * pn
                   OR abs(cb / cn - pb / pn) <= {tree.z}::DOUBLE * sqrt(pb / pn * (1 - pb / pn) / cn)
                 THEN '/*' ELSE {seg} END AS {gen} FROM parent{k}),
merged{k} AS (SELECT {prefix}, {gen}, CAST(sum(cn) AS BIGINT) AS tn, CAST(sum(cb) AS BIGINT) AS tb FROM named{k} GROUP BY ALL),
t{k} AS (
  SELECT t.* EXCLUDE (q), {gen}, (tb + {tree.weight}::DOUBLE * q) / (tn + {tree.weight}::DOUBLE) AS q
  FROM {source} t JOIN named{k} USING ({prefix}, {seg}) JOIN merged{k} USING ({prefix}, {gen}))"""
        prefix += f", {gen}"
    return f"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), {parts}, 1), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(coalesce(url, ''), {parts}, 2) AS path
  FROM pages),
r AS (
  SELECT *, {case("rule")} AS rule, {case("verdict")} AS said, regexp_replace(path, '[0-9]+', '{{n}}', 'g') AS typed FROM u),
s AS (
  SELECT *, regexp_extract(typed, {segments}, 1) AS s1, regexp_extract(typed, {segments}, 2) AS s2,
         regexp_extract(typed, {segments}, 3) AS s3 FROM r),
c AS (SELECT host, s1, s2, s3, count(*) AS n, count(*) FILTER (WHERE said = 'block') AS b FROM s GROUP BY ALL),
t0 AS (
  SELECT *, (sum(b) OVER h + {tree.weight}::DOUBLE * 0.5::DOUBLE) / (sum(n) OVER h + {tree.weight}::DOUBLE) AS q
  FROM c WINDOW h AS (PARTITION BY host)){levels}
SELECT s.page_id, s.host, s.path, s.rule,
       coalesce(s.said, CASE WHEN t3.q > {tree.limit}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict
FROM s JOIN t3 USING (host, s1, s2, s3)
"""


def quality(limits: Limits = Limits()) -> str:
    def count(text: str, pattern: str) -> str:
        return f"len(regexp_extract_all({text}, {_text(pattern)}))"

    fails = (
        f"(NOT regexp_matches(line, {_text(ENDS + '$')}) AND {SENTENCE} * {count('line', STOPS)} < n)"
        f" OR regexp_matches(line, {_text('(?i)(' + NOTICES + ')')}) OR {count('line', SYMBOLS)} > n"
        f" OR ({count('line', SEPARATORS)} >= 2 AND 4 * {count('line', SEPARATORS)} >= n)"
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_text(WORD)}) AS words FROM documents),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
v AS (SELECT *, lead(word) OVER o AS word2, lead(word, 2) OVER o AS word3 FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
x AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, word, word2, word3) AS times FROM v WHERE word3 IS NOT NULL),
y AS (SELECT rid, count(DISTINCT pos + k) AS n_repeat_words FROM x, range(3) AS o(k) WHERE times > 1 GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT *, {count("line", WORD)} AS n FROM l),
f AS (SELECT *, {fails} AS fails FROM m WHERE n > 0),
g AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_removed_lines,
         coalesce(sum(length(line)) FILTER (WHERE fails), 0) AS lost_chars, sum(length(line)) AS chars FROM f GROUP BY rid),
z AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         {count("text", "[#*$%&|<>]")} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines,
         coalesce(lost_chars, 0) AS lost_chars, coalesce(chars, 0) AS chars
  FROM d LEFT JOIN y USING (rid) LEFT JOIN g USING (rid)),
b AS (
  SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeated_percent} * n_words AS base_failed FROM z)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= {limits.max_lost_percent} * chars AS kept,
       CAST(n_removed_lines AS BIGINT) AS n_removed_lines, CAST(lost_chars AS BIGINT) AS lost_chars
FROM b
"""


SUBSTRING_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), {_text(WORD)}) AS words FROM documents),
w AS (SELECT rid, doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM d WHERE len(words) >= 50),
s AS (SELECT rid, doc_id, pos, array_to_string(list_slice(words, pos, pos + 49), ' ') AS win FROM w),
m AS (SELECT win, min(doc_id) AS least FROM s GROUP BY win),
r AS (
  SELECT DISTINCT rid, pos + k AS pos FROM s JOIN m USING (win), range(50) AS o(k) WHERE least < coalesce(doc_id, 9223372036854775807)),
u AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
k AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept FROM u ANTI JOIN r USING (rid, pos) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""

# CRC-32 of an ASCII text, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT)"""


def _leaf(text: str) -> str:
    frames = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(frames)})"


def _levels(name: str, rows: str) -> str:
    return f"""{name} AS (
  {rows}
  UNION ALL
  SELECT g, lvl + 1, idx // 8, (max(size) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE size > 1 GROUP BY g, lvl, idx // 8)"""


def _sides(name: str) -> str:
    run = "OVER (PARTITION BY g, lvl, idx // 8 ORDER BY idx ROWS BETWEEN"
    return f"""SELECT *, coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
    coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post FROM {name} WHERE size > 1"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC.format("(doc_id::VARCHAR)")} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS given
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS size FROM d),
{_levels("t", "SELECT lang AS g, 0 AS lvl, idx, size, leaf AS digest FROM r")},
s AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS size FROM t WHERE size = 1),
{_levels("p", "SELECT 0 AS g, 0 AS lvl, idx, size, subroot AS digest FROM s")},
root AS (SELECT digest AS root FROM p WHERE size = 1),
ts AS ({_sides("t")}),
ps AS ({_sides("p")}),
path AS (
  SELECT rid, ts.lvl AS step, pre, post FROM r JOIN ts ON ts.g IS NOT DISTINCT FROM r.lang AND ts.idx = r.idx // CAST(8 ** ts.lvl AS BIGINT)
  UNION ALL
  SELECT rid, 1000 + ps.lvl, pre, post
  FROM r JOIN s ON s.g IS NOT DISTINCT FROM r.lang JOIN ps ON ps.idx = s.idx // CAST(8 ** ps.lvl AS BIGINT)),
n AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY step) AS nth FROM path),
f AS (
  SELECT rid, 1 AS nth, coalesce(given, leaf) AS node FROM r
  UNION ALL
  SELECT rid, nth + 1, sha256(pre || node || post) FROM f JOIN n USING (rid, nth)),
e AS (SELECT rid, max_by(node, nth) AS folded_root FROM f GROUP BY rid),
q AS (SELECT rid, sha256(string_agg(pre || post, '' ORDER BY nth)) AS proof_sha256 FROM n GROUP BY rid)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM r JOIN s ON s.g IS NOT DISTINCT FROM r.lang CROSS JOIN root JOIN e USING (rid) LEFT JOIN q USING (rid)
"""

SOURCE_DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
l AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, l.term, l.n AS total, count(w.rid) AS n
  FROM g JOIN l USING (lang) LEFT JOIN w ON w.lang = g.lang AND w.source = g.source AND w.term = l.term GROUP BY ALL),
p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER h + count(*) OVER h) AS p,
         1 + (1000000000::HUGEINT * (total + 1)) // (sum(total) OVER h + count(*) OVER h) AS q
  FROM c WINDOW h AS (PARTITION BY lang, source)),
v AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM v QUALIFY part = 'pair' OR rank <= 200
"""
