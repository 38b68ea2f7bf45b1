"""DuckDB SQL that queries of this subpackage must equal, written apart from their Spark code."""

from __future__ import annotations

from claimspark.llm.quality import LADDER, RATE, RISK

_SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACE}'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 80 * (a.n + b.n - i)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM reach r JOIN both_ways e ON r.v = e.u),
c AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

LINE_DEDUP = rf"""
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line,
    unnest(string_split(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), chr(10))) AS s FROM documents),
w AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(s, '{_SPACE}'), lambda x: x <> ''))) AS w FROM l),
f AS (SELECT w, len(w) AS n, min((doc_id, line)) AS first FROM w WHERE len(w) >= 1 GROUP BY 1),
t AS (SELECT first, n, unnest(w) AS x FROM f),
p AS (SELECT b.first, a.n AS m, b.n, count(*) AS i FROM t a JOIN t b ON a.x = b.x AND a.first < b.first AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.first, b.first, a.n, b.n),
m AS (SELECT DISTINCT first FROM p WHERE 100 * i >= 80 * (m + n - i)),
gone AS (
  SELECT doc_id, line FROM w JOIN f USING (w) WHERE (doc_id, line) <> f.first OR f.first IN (SELECT first FROM m))
SELECT d.doc_id, len(string_split(coalesce(text, ''), chr(10)))::INT AS n_lines, coalesce(g.n, 0)::INT AS n_removed, coalesce(g.removed, '') AS removed
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(line, ',' ORDER BY line) AS removed FROM gone GROUP BY 1) g USING (doc_id)
"""

#: Statistics of each text, one CTE each, for any table t (doc_id, text, lang).
_STATS = rf"""
w AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w,
  coalesce(text, '') AS text FROM t),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
i AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM i),
h AS (SELECT doc_id, g FROM g GROUP BY 1, 2 HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g JOIN h USING (doc_id, g)) GROUP BY 1),
stats AS (
  SELECT w.doc_id, w.lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE {' '.join(
        f'WHEN 1000 * n_symbols >= {a} * n_words OR 100 * word_chars >= {b} * n_words '
        f'OR 1000 * n_dup_lines >= {c} * greatest(n_lines, 1) OR 1000 * n_repeat_words >= {d} * n_words THEN {j}'
        for j, (a, b, c, d) in enumerate(LADDER))} ELSE {len(LADDER)} END AS strict
  FROM stats),
good AS (SELECT j.* FROM judged j WHERE NOT base_failed AND lang IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
tests AS (
  SELECT lang, level, count(*) AS n, count(*) FILTER (strict <= level) AS k FROM good, (SELECT unnest(range({len(LADDER)})) AS level) GROUP BY 1, 2),
tails AS (
  SELECT lang, level, sum(exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({RATE}) + (n - x) * ln(1 - {RATE}))) AS tail
  FROM (SELECT *, unnest(range(k + 1)) AS x FROM tests) GROUP BY 1, 2),
failed AS (SELECT lang, min(level) AS level FROM tails WHERE tail > {RISK} / (SELECT count(DISTINCT lang) FROM good) GROUP BY 1),
levels AS (SELECT DISTINCT lang, coalesce(f.level, {len(LADDER)}) - 1 AS level FROM tests LEFT JOIN failed f USING (lang)),
verdicts AS (SELECT j.*, NOT base_failed AND (v.level IS NULL OR strict > v.level) AS kept FROM judged j LEFT JOIN levels v USING (lang))
"""

QUALITY = f"""
WITH t AS (SELECT doc_id, text, lang FROM documents), {_STATS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdicts
"""

FILL_IN_MIDDLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(concat('7:', doc_id)) AS h FROM documents),
u AS (
  SELECT doc_id, text, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4,
    list_filter(list_concat(list_transform(string_split(text, chr(10))[:-2], lambda x: x || chr(10)), string_split(text, chr(10))[-1:]),
      lambda x: x <> '') AS l
  FROM t),
c AS (
  SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, coalesce(array_to_string(l[1:a], ''), '') AS p, coalesce(array_to_string(l[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(l[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

SPELLING = rf"""
WITH RECURSIVE k AS (  -- the checksum's table, from its polynomial
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS k),
r AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY 1, 2),
b AS (  -- UTF-8 bytes of characters below 256
  SELECT w, n, flatten(list_transform(string_split(concat(doc_id, ':', w), ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)) AS bytes FROM r),
h AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, k[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, k),
v AS (
  SELECT w, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w FROM h)
  WHERE length(w) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
x AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v),
y AS (SELECT w, n, i, substr(w, 1, i - 1) AS a, substr(w, i + 1) AS z FROM x),
near AS (
  SELECT DISTINCT * FROM (
    SELECT s.w, t.w AS o, t.n FROM y s JOIN y t ON s.i = t.i AND s.a = t.a AND s.z = t.z AND s.w <> t.w
    UNION ALL SELECT y.w, v.w, v.n FROM y JOIN v ON v.w = y.a || y.z
    UNION ALL SELECT v.w, y.w, y.n FROM y JOIN v ON v.w = y.a || y.z)),
best AS (SELECT w, count(*) AS n_near, max(n) AS form_n FROM near GROUP BY 1),
picked AS (SELECT b.w, b.n_near, b.form_n, min(o) AS form FROM best b JOIN near ON near.w = b.w AND near.n = b.form_n GROUP BY 1, 2, 3),
f AS (SELECT v.w, v.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN p.form_n >= 5 * v.n THEN p.form END AS form,
  CASE WHEN p.form_n >= 5 * v.n THEN p.form_n END AS form_n FROM v LEFT JOIN picked p USING (w)),
chain AS (
  SELECT w, w AS z, 0 AS step FROM f
  UNION ALL SELECT c.w, f.form, c.step + 1 FROM chain c JOIN f ON f.w = c.z WHERE f.form IS NOT NULL),
root AS (SELECT w, max_by(z, step) AS root FROM chain GROUP BY 1)
SELECT f.w AS word, f.form, root.root, f.n, f.n_near, f.form_n FROM f JOIN root USING (w)
"""
