"""DuckDB SQL for the queries of this subpackage that SQL can express, over whole tables and whole texts."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: Links by shared shingles, then the smallest id reachable.
NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""

#: Windows by digest; a word goes if a repeated window started at most 34 words before it.
WINDOW_DEDUP = rf"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
k AS (SELECT doc_id, list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' '))) AS k FROM w),
h AS (SELECT doc_id, unnest(k) AS h, generate_subscripts(k, 1) AS i FROM k),
r AS (SELECT doc_id, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
g AS (SELECT e.doc_id, e.i, e.word, coalesce(max(r.i) OVER (PARTITION BY e.doc_id ORDER BY e.i) >= e.i - 34, false) AS gone FROM e LEFT JOIN r ON r.doc_id = e.doc_id AND r.i = e.i)
SELECT d.doc_id, count(g.i)::BIGINT AS n_words, count(*) FILTER (WHERE g.gone)::BIGINT AS n_removed, sha256(coalesce(string_agg(g.word, ' ' ORDER BY g.i) FILTER (WHERE NOT g.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id GROUP BY d.doc_id
"""

#: Windows of 100 bytes as 200 hexadecimal digits; all but the first in (doc_id, start) repeat.
SUFFIX_DEDUP = """
WITH t AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
k AS (SELECT doc_id, list_transform(range(1, length(x) // 2 - 98), lambda i: md5_number(substr(x, 2 * i - 1, 200))) AS k FROM t),
h AS (SELECT doc_id, unnest(k) AS h, generate_subscripts(k, 1) AS i FROM k),
f AS (SELECT h, min((doc_id, i)) AS f FROM h GROUP BY h),
r AS (SELECT h.doc_id, h.i FROM h JOIN f ON h.h = f.h AND f.f <> (h.doc_id, h.i)),
v AS (SELECT doc_id, list_transform(range(1, length(x) // 2 + 1), lambda i: substr(x, 2 * i - 1, 2)) AS v FROM t),
b AS (SELECT doc_id, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM v),
g AS (SELECT b.doc_id, b.i, b.c, coalesce(max(r.i) OVER (PARTITION BY b.doc_id ORDER BY b.i) >= b.i - 99, false) AS gone FROM b LEFT JOIN r ON r.doc_id = b.doc_id AND r.i = b.i),
s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM g)
SELECT t.doc_id, count(s.i)::BIGINT AS n_bytes, count(*) FILTER (WHERE s.gone)::BIGINT AS n_removed, count(*) FILTER (WHERE s.opens)::BIGINT AS n_spans,
  sha256(unhex(coalesce(string_agg(s.c, '' ORDER BY s.i) FILTER (WHERE NOT s.gone), ''))) AS kept_sha256
FROM t LEFT JOIN s ON s.doc_id = t.doc_id GROUP BY t.doc_id
"""
