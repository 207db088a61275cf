"""DuckDB texts of the contracts that SQL can express. They state results, not methods, and are written for small tables."""

from __future__ import annotations

from .line_rules import BOILERPLATE, NAVIGATION, SENTENCE, SYMBOLS
from .secrets import ALLOWED, BASE, CLASSES, WINDOW

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


SUBSTRING = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
x AS (SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS u(i) WHERE len(w) >= 50 AND doc_id IS NOT NULL),
f AS (SELECT h, min(doc_id) AS first FROM x GROUP BY 1),
g AS (SELECT DISTINCT rid, i + k AS p FROM x JOIN f USING (h), unnest(range(50)) AS v(k) WHERE first < doc_id),
c AS (SELECT rid, list(p) AS gone FROM g GROUP BY 1),
p AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
r AS (SELECT p.rid, string_agg(word, ' ' ORDER BY p.p) AS rest FROM p LEFT JOIN g ON g.rid = p.rid AND g.p = p.p WHERE g.p IS NULL GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM d LEFT JOIN c USING (rid) LEFT JOIN r USING (rid)"""

JACCARD = rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (SELECT DISTINCT rid, doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.rid != b.rid AND a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * common >= 75 * (a.n + b.n - common)),
r(x, y) AS (SELECT rid, rid FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT a.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(b.doc_id) AS component_id FROM r JOIN d a ON a.rid = r.x JOIN d b ON b.rid = r.y LEFT JOIN n ON n.rid = r.x GROUP BY a.rid, a.doc_id, n.n"""

LINKS = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
s AS (SELECT DISTINCT rid, doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.rid != b.rid AND a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT x, common = a.n AND common = b.n AS same FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * common >= 75 * (a.n + b.n - common)),
k AS (SELECT x, count(*) FILTER (same) AS n_copies, count(*) AS n_links FROM l GROUP BY 1)
SELECT o.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN o.doc_id IS NOT NULL THEN coalesce(n_copies, 0) END::BIGINT AS n_copies, CASE WHEN o.doc_id IS NOT NULL THEN coalesce(n_links, 0) END::BIGINT AS n_links
FROM documents o JOIN d ON d.doc_id IS NOT DISTINCT FROM o.doc_id AND d.text IS NOT DISTINCT FROM o.text LEFT JOIN n USING (rid) LEFT JOIN k ON k.x = d.rid"""

DECONTAMINATION = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
z AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, z, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
h AS (SELECT rid, i, n, item FROM dw JOIN bw USING (n, win)),
c AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM h, unnest(range(n)) AS v(k) GROUP BY 1),
t AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)"""

_FAILS = f"NOT regexp_matches(x, '{_q(SENTENCE)}') OR regexp_matches(x, '{_q(NAVIGATION)}') OR regexp_matches(x, '{_q(BOILERPLATE)}') OR 100 * len(regexp_extract_all(x, '{SYMBOLS}')) > 10 * length(x)"

QUALITY = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS ls FROM documents),
g AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM d, unnest(range(1, len(w) - 1)) AS u(i) WHERE len(w) >= 3),
m AS (SELECT *, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM m, unnest(range(3)) AS v(k) WHERE n > 1 GROUP BY 1),
o AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
  coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0)::BIGINT AS chars,
  len(list_filter(ls, lambda x: {_FAILS}))::BIGINT AS n_failed_lines,
  coalesce(list_sum(list_transform(list_filter(ls, lambda x: {_FAILS}), lambda x: length(x))), 0)::BIGINT AS chars_lost FROM d LEFT JOIN r USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * chars_lost <= 50 * chars AS kept FROM o"""


def _cut(pattern: str, table: str) -> str:
    """A text's pieces between the matches of a pattern, the matches and their first groups."""
    p = _q(pattern)
    return f"SELECT rid, t, string_split_regex(t, '{p}') AS pieces, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', 1) AS vs FROM {table} WHERE regexp_matches(t, '{p}')"


def _matches(kind: str, rank: int, pattern: str, least: int, table: str) -> str:
    return f"""SELECT rid, {rank} AS rank, '{kind}' AS kind, k, list_sum(list_transform(pieces[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0) AS a, ms[k] AS run
  FROM ({_cut(pattern, table)}), unnest(range(1, len(ms) + 1)) AS u(k) WHERE length(vs[k]) >= {least}"""


def _blanked(pattern: str, table: str, good: str, more: str = "") -> str:
    """The table's texts with the good matches as line feeds."""
    joined = f"array_to_string(list_transform(range(1, len(ms) + 1), lambda k: pieces[k] || CASE WHEN {good} THEN repeat(chr(10), length(ms[k])) ELSE ms[k] END), '') || pieces[len(pieces)]"
    return f"SELECT rid, {joined} AS t FROM ({_cut(pattern, table)}) {more} UNION ALL SELECT rid, t FROM {table} WHERE NOT regexp_matches(t, '{_q(pattern)}')"


def _secrets() -> str:
    every = "".join(sorted({c for _, alphabet, _ in CLASSES for c in alphabet}))
    parts = [f"base AS ({' UNION ALL '.join(_matches(kind, k, pattern, least, 'd') for k, (kind, pattern, least) in enumerate(BASE))})"]
    table = "d"
    for k, (_, pattern, least) in enumerate(BASE):
        parts.append(f"b{k} AS ({_blanked(pattern, table, f'length(vs[k]) >= {least}')})")
        table = f"b{k}"
    for k, rule in enumerate(ALLOWED):
        rule = "|".join(("\\" + c if not c.isalnum() else c) + "{8}" for c in every) if rule == r"(.)\1{7}" else rule
        parts.append(f"a{k} AS ({_blanked(f'({rule})', table, 'true')})")
        table = f"a{k}"
    for k, (kind, alphabet, bits) in enumerate(CLASSES):
        pattern = "([" + "".join("\\" + c if c in "+/_-" else c for c in alphabet) + f"]{{{WINDOW},}})"
        parts.append(f"f{k} AS (SELECT * FROM ({_matches(kind, len(BASE) + k, pattern, WINDOW, table)}) WHERE regexp_matches(run, '[0-9]') AND regexp_matches(run, '[A-Za-z]'))")
        parts.append(f"w{k} AS (SELECT rid, a, i, ch, count(*) AS n FROM (SELECT rid, a, i, unnest(string_split(substr(run, i, {WINDOW}), '')) AS ch FROM f{k}, unnest(range(1, length(run) - {WINDOW} + 2)) AS u(i)) GROUP BY ALL)")
        parts.append(f"e{k} AS (SELECT rid, a FROM (SELECT rid, a, i, log2({WINDOW}) - sum(n * log2(n)) / {WINDOW} AS bits FROM w{k} GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING round(max(bits), 9) >= {bits})")
        parts.append(f"s{k} AS (SELECT f{k}.* FROM f{k} SEMI JOIN e{k} USING (rid, a))")
        parts.append(f"c{k} AS ({_blanked(pattern, table, 'coalesce(list_contains(good, k), false)', f'LEFT JOIN (SELECT rid, list(k) AS good FROM s{k} GROUP BY 1) USING (rid)')})")
        table = f"c{k}"
    spans = " UNION ALL ".join(["SELECT * FROM base", *(f"SELECT * FROM s{k}" for k in range(len(CLASSES)))])
    name = "kind || ':' || a::BIGINT || ':' || (a + length(run))::BIGINT"
    numbers = ", ".join(f"coalesce(count(*) FILTER (kind = '{kind}'), 0)::BIGINT AS n_{kind}" for kind, _, _ in BASE)
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), {', '.join(parts)}, al AS ({spans}),
g AS (SELECT rid, {numbers}, string_agg({name}, ',' ORDER BY a, rank) FILTER (rank < {len(BASE)}) AS b, string_agg({name}, ',' ORDER BY a, rank) AS s FROM al GROUP BY 1)
SELECT doc_id, {', '.join(f'coalesce(n_{kind}, 0)::BIGINT AS n_{kind}' for kind, _, _ in BASE)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans FROM d LEFT JOIN g USING (rid)"""


TEXTS = {
    "op4_secret_scan": _secrets(),
    "op5_substring_dedup": SUBSTRING,
    "op8_jaccard_join": JACCARD,
    "op8_jaccard_links": LINKS,
    "op9_decontamination": DECONTAMINATION,
    "op10_quality_rules": QUALITY,
}
