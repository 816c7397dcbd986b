"""Queries of the scalar text functions (T*) over the driver's tables."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.entities import REFERENCE, REPLACED
from ..functions.profiles import LATIN_CLASSES
from ..operators import pages as P
from .base import ORACLES, norm, query, table, words

_LETTERS = "".join(LATIN_CLASSES)
_CLASSES = "".join(chr(0xE000 + i) for i, g in enumerate(LATIN_CLASSES) for _ in g)


@query(f"SELECT doc_id, md5({norm('text')}) AS norm_md5, length({norm('text')})::BIGINT AS norm_chars FROM documents")
def norm_documents(spark: SparkSession, d: str) -> DataFrame:
    """The Latin profile over all documents."""
    t = X.normalize(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(t).alias("norm_md5"), F.length(t).cast("long").alias("norm_chars"))


@query(f"SELECT doc_id, md5(replace({norm('text')}, ' ', '')) AS compact_md5, length(replace({norm('text')}, ' ', ''))::BIGINT AS compact_chars FROM documents")
def compact_text(spark: SparkSession, d: str) -> DataFrame:
    """T4."""
    t = X.compact(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(t).alias("compact_md5"), F.length(t).cast("long").alias("compact_chars"))


@query("SELECT doc_id, translate(doc_id::VARCHAR, '0123456789', '০১২৩৪৫৬৭৮৯') AS bangla, doc_id::INTEGER AS back, CASE WHEN doc_id BETWEEN 1 AND 500 THEN doc_id::INTEGER END AS page, substr(sha1(source || '::' || doc_id::VARCHAR), 1, 12) AS record_id FROM documents")
def digits_and_ids(spark: SparkSession, d: str) -> DataFrame:
    """T16, T17, T18."""
    b = X.to_bangla_digits(F.col("doc_id"))
    return table(spark, d, "documents").select("doc_id", b.alias("bangla"), X.from_bangla_digits(b).alias("back"), X.page_number(b).alias("page"), X.stable_id(F.col("source"), F.col("doc_id").cast("string")).alias("record_id"))


@query(f"SELECT doc_id, md5(translate({norm('text')}, '{_LETTERS}', '{_CLASSES}')) AS signature_md5 FROM documents")
def class_signature(spark: SparkSession, d: str) -> DataFrame:
    """T6 with the Latin classes."""
    return table(spark, d, "documents").select("doc_id", F.md5(X.class_signature(X.normalize(F.col("text")), LATIN_CLASSES)).alias("signature_md5"))


@query(f"""WITH t AS (SELECT item_id, replace({norm('text')}, ' ', '') AS c FROM benchmark), g AS (SELECT item_id, unnest(range(1, length(c) - 1)) AS i, c FROM t)
SELECT item_id, count(*)::BIGINT AS grams, count(DISTINCT substr(c, i, 3))::BIGINT AS distinct_grams, md5(string_agg(substr(c, i, 3), '|' ORDER BY i)) AS grams_md5 FROM g GROUP BY item_id""")
def char_ngrams3(spark: SparkSession, d: str) -> DataFrame:
    """T7, T8."""
    t = table(spark, d, "benchmark").select("item_id", X.compact(F.col("text")).alias("c"))
    g = X.char_ngrams(F.col("c"), 3)
    return t.select("item_id", F.size(g).cast("long").alias("grams"), F.size(X.char_ngram_set(F.col("c"), 3)).cast("long").alias("distinct_grams"), F.md5(F.array_join(g, "|")).alias("grams_md5"))


@query(f"""WITH t AS (SELECT doc_id, {norm('text')} AS n FROM documents), w AS (SELECT doc_id, list_filter({words('n')}, lambda x: length(x) >= 3) AS w FROM t)
SELECT doc_id, len(list_distinct(w))::BIGINT AS tokens, md5(array_to_string(list_sort(list_distinct(w)), ' ')) AS tokens_md5 FROM w""")
def token_set(spark: SparkSession, d: str) -> DataFrame:
    """T9."""
    t = X.token_set(X.normalize(F.col("text")))
    return table(spark, d, "documents").select("doc_id", F.size(t).cast("long").alias("tokens"), F.md5(F.array_join(F.array_sort(t), " ")).alias("tokens_md5"))


@query(f"""WITH t AS (SELECT doc_id, {norm('text')} AS n FROM documents)
SELECT doc_id, len(list_filter({words('n')}, lambda x: regexp_full_match(x, '[0-9]+') OR length(x) >= 2))::BIGINT AS listed, len(list_filter({words('n')}, lambda x: NOT regexp_full_match(x, '[0-9]+') AND length(x) >= 2))::BIGINT AS phrased FROM t""")
def token_lists(spark: SparkSession, d: str) -> DataFrame:
    """T10, T11."""
    n = X.normalize(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(X.token_list(n)).cast("long").alias("listed"), F.size(X.phrase_tokens(n)).cast("long").alias("phrased"))


@query(f"""WITH t AS (SELECT item_id, {norm('text')} AS n FROM benchmark), w AS (SELECT item_id, list_filter({words('n')}, lambda x: NOT regexp_full_match(x, '[0-9]+') AND length(x) >= 2) AS w FROM t),
s AS (SELECT item_id, w, unnest([6, 5, 4]) AS size FROM w), p AS (SELECT item_id, w, size, unnest(range(0, len(w) - size + 1)) AS start FROM s)
SELECT item_id, start::INTEGER AS start, size::INTEGER AS size, array_to_string(w[start + 1:start + size], ' ') AS phrase FROM p""")
def token_windows(spark: SparkSession, d: str) -> DataFrame:
    """T13."""
    w = X.token_windows(X.phrase_tokens(X.normalize(F.col("text"))))
    return table(spark, d, "benchmark").select("item_id", F.explode(w).alias("w")).select("item_id", "w.*")


_NB = r"list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_FEATURES = rf"""WITH t AS (SELECT doc_id, text, {_NB} AS x FROM documents)
SELECT doc_id, len(x)::BIGINT AS line_count, length(regexp_replace(text, '[ \t\n\r\f\x0b]+', '', 'g'))::BIGINT AS char_count, len(regexp_extract_all(text, '[A-Za-z]'))::BIGINT AS letter_count,
 len(regexp_extract_all(text, '[০১২৩৪৫৬৭৮৯0-9]'))::BIGINT AS digit_count, len(list_filter(x, lambda s: length(s) >= 30))::BIGINT AS long_line_count, len(list_filter(x, lambda s: length(s) <= 16))::BIGINT AS short_line_count,
 len(list_filter(x, lambda s: length(s) <= 24))::BIGINT AS centeredish_line_count, 1.0::DOUBLE - least(length(regexp_replace(text, '[ \t\n\r\f\x0b]+', '', 'g'))::DOUBLE / 2200.0::DOUBLE, 1.0::DOUBLE) AS blank_ratio_estimate FROM t"""


@query(_FEATURES)
def structural_features(spark: SparkSession, d: str) -> DataFrame:
    """T33, T63."""
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in X.structural_features(F.col("text"), "A-Za-z").items()])


_CONTENTS = rf"""WITH t AS (SELECT doc_id, {_NB} AS x FROM documents), e AS (SELECT doc_id, x, list_filter(x, lambda s: regexp_matches(s, '[০-৯0-9]') AND regexp_matches(s, '[A-Za-z]')) AS e FROM t),
c AS (SELECT doc_id, len(x) AS n, coalesce(list_sum(list_transform(e, lambda s: len(regexp_extract_all(s, '[০-৯0-9]{{1,3}}')))), 0) AS numbers, len(list_filter(e, lambda s: length(s) <= 54)) AS short, len(list_filter(e, lambda s: regexp_matches(s, '[A-Za-z].{{0,48}}[০-৯0-9]{{1,3}} *$'))) AS refs FROM e)
SELECT doc_id, n >= 5 AND numbers >= 5 AND short >= 4 AND (refs >= 3 OR short >= greatest(5, n // 3)) AS is_contents FROM c"""


@query(_CONTENTS)
def contents_page(spark: SparkSession, d: str) -> DataFrame:
    """C2."""
    return table(spark, d, "documents").select("doc_id", P.is_contents(F.col("text"), P.LATIN).alias("is_contents"))


@query(rf"""WITH f AS ({_FEATURES}), c AS ({_CONTENTS}), n AS (SELECT doc_id, {_NB} AS x FROM documents),
k AS (SELECT doc_id, len(list_filter(list_concat(x[1:4], x[greatest(len(x) - 3, 1):len(x)]), lambda s: regexp_full_match(s, '[^\p{{L}}\p{{M}}\p{{N}}]*[০-৯0-9]{{1,3}}[^\p{{L}}\p{{M}}\p{{N}}]*'))) > 0 AS numbered FROM n),
t AS (SELECT f.*, is_contents, numbered, regexp_replace(d.text, '\s+', '', 'g') AS p FROM documents d JOIN f USING (doc_id) JOIN c USING (doc_id) JOIN k USING (doc_id))
SELECT doc_id, CASE WHEN char_count < 25 OR line_count <= 1 THEN 'blank_or_near_blank' WHEN regexp_matches(p, 'publish|printedby|firstedition') THEN 'publisher_page' WHEN regexp_matches(p, '^["'']*contents') OR is_contents THEN 'front_matter'
 WHEN regexp_matches(p, 'dedicat|preface|written') AND long_line_count < 8 THEN 'front_matter' WHEN regexp_matches(p, 'essay|review') THEN 'critical_prose_page' WHEN line_count <= 8 AND centeredish_line_count >= greatest(2, line_count // 2) THEN 'section_title_page'
 WHEN long_line_count <= 2 AND line_count <= 14 THEN 'poem_start_or_short_page' WHEN numbered AND line_count >= 8 THEN 'normal_poem_page' ELSE 'poem_or_text_page' END AS page_type FROM t""")
def page_type(spark: SparkSession, d: str) -> DataFrame:
    """C1, C2, T33, T34."""
    return P.classified(table(spark, d, "documents").select("doc_id", "text"), "text", P.LATIN).select("doc_id", "page_type")


_NUMBER_LINE = r"^[^\p{L}\p{M}\p{N}]*([০-৯0-9]{1,3})[^\p{L}\p{M}\p{N}]*$"


@query(rf"""WITH t AS (SELECT doc_id, {_NB} AS x FROM documents), l AS (SELECT doc_id, zone, i, x[i + 1] AS raw, i + CASE zone WHEN 'top' THEN 0 ELSE 1000000000 END AS pos FROM t, (VALUES ('top'), ('bottom')) AS z(zone), unnest(range(0, len(x))) AS u(i) WHERE (zone = 'top' AND i < 4) OR (zone = 'bottom' AND i >= greatest(len(x) - 4, 0))),
c AS (SELECT *, translate(regexp_extract(raw, '{_NUMBER_LINE}', 1), '০১২৩৪৫৬৭৮৯', '0123456789')::INTEGER AS value FROM l WHERE regexp_matches(raw, '{_NUMBER_LINE}')), f AS (SELECT doc_id, value, zone, min(pos) AS place, arg_max(i, pos) AS i, arg_max(raw, pos) AS raw FROM c GROUP BY 1, 2, 3),
j AS (SELECT doc_id, count(*) AS n, '[' || string_agg('{{"value":' || value || ',"zone":"' || zone || '","line_index":' || i || ',"raw":' || to_json(raw) || '}}', ',' ORDER BY place) || ']' AS found FROM f GROUP BY 1)
SELECT p.doc_id, p.page_type, coalesce(j.n, 0)::INTEGER AS candidates, coalesce(j.found, '[]') AS found FROM ({ORACLES['page_type']}) p LEFT JOIN j USING (doc_id)""")
def page_candidates(spark: SparkSession, d: str) -> DataFrame:
    """T34, W1's input: page number candidates of all documents, with the page type."""
    t = P.classified(table(spark, d, "documents").select("doc_id", "text"), "text", P.LATIN)
    return t.select("doc_id", "page_type", F.size("page_candidates").alias("candidates"), F.to_json("page_candidates").alias("found"))


@query(rf"""WITH t AS (SELECT doc_id, {_NB} AS x FROM documents)
SELECT doc_id, md5(array_to_string(x[1:4], chr(10))) AS header_md5, md5(array_to_string(CASE WHEN len(x) > 8 THEN x[5:len(x) - 4] ELSE x END, chr(10))) AS body_md5, md5(array_to_string(x[greatest(len(x) - 3, 1):len(x)], chr(10))) AS footer_md5 FROM t""")
def zones(spark: SparkSession, d: str) -> DataFrame:
    """T32."""
    z = table(spark, d, "documents").select("doc_id", X.zones(F.col("text")).alias("z"))
    return z.select("doc_id", *[F.md5(f"z.{n}_text").alias(f"{n}_md5") for n in ("header", "body", "footer")])


@query(r"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS raw FROM documents), t AS (SELECT trim(raw) AS s FROM l),
k AS (SELECT unnest(list_filter([CASE WHEN regexp_matches(s, '[A-Za-z0-9]') THEN 'western_alnum' END, CASE WHEN regexp_matches(s, '[�□■▪]') THEN 'replacement_char' END, CASE WHEN regexp_full_match(s, '[০-৯0-9]+') THEN 'section_digit_line' END,
 CASE WHEN NOT regexp_full_match(s, '[০-৯0-9]+') AND regexp_matches(s, '[০-৯0-9]') THEN 'inline_digit' END, CASE WHEN regexp_full_match(s, '-{5,}') THEN 'dash_divider' END, CASE WHEN regexp_matches(s, '^-[ ]*[^- ]') THEN 'single_leading_dash' END,
 CASE WHEN NOT regexp_full_match(s, '-{5,}') AND regexp_matches(s, '^--+\S') THEN 'multi_leading_dash' END, CASE WHEN regexp_matches(s, '^—\s*\S') THEN 'leading_em_dash' END], lambda x: x IS NOT NULL)) AS kind FROM t)
SELECT kind, count(*)::BIGINT AS n FROM k GROUP BY kind""")
def line_issues(spark: SparkSession, d: str) -> DataFrame:
    """T40."""
    kinds = F.flatten(F.transform(X.lines(F.col("text")), lambda x: X.line_issues(x)))
    return table(spark, d, "documents").select(F.explode(kinds).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


_QUOTED = lambda x: "'" + x.replace("'", "''") + "'"
_NAMES = ", ".join(f"({_QUOTED(k)}, {_QUOTED(v)})" for k, v in html5.items())
_NUMBERS = ", ".join(f"({k}, chr({ord(v)}))" for k, v in REPLACED.items())
_SPACES = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

#: References meet the table of all names: whole, or by the longest one that they begin with.
_HTML = f"""names(name, value) AS (VALUES {_NAMES}), numbers(number, value) AS (VALUES {_NUMBERS}),
h AS (SELECT page_id, regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g') AS t FROM pages),
p AS (SELECT page_id, string_split_regex(t, '{REFERENCE}') AS between, regexp_extract_all(t, '{REFERENCE}') AS refs FROM h),
r AS (SELECT page_id, i, refs[i][2:] AS body FROM p, unnest(range(1, len(refs) + 1)) AS u(i)), b AS (SELECT DISTINCT body FROM r),
f AS (SELECT body, arg_max(n.value || body[length(n.name) + 1:], length(n.name)) AS value FROM b JOIN names n ON starts_with(body, n.name) AND (n.name = body OR NOT ends_with(n.name, ';')) GROUP BY body),
d AS (SELECT body, (CASE WHEN body[2] IN ('x', 'X') THEN list_reduce(list_prepend(0::BIGINT, list_transform(string_split(lower(rtrim(body[3:], ';')), ''), lambda c: (strpos('0123456789abcdef', c) - 1)::BIGINT)), lambda a, c: least(16 * a + c, 2000000)) ELSE list_reduce(list_prepend(0::BIGINT, list_transform(string_split(rtrim(body[2:], ';'), ''), lambda c: c::BIGINT)), lambda a, c: least(10 * a + c, 2000000)) END) AS number FROM b WHERE body[1] = '#'),
g AS (SELECT body, coalesce(n.value, CASE WHEN number BETWEEN 55296 AND 57343 OR number > 1114111 THEN chr(65533) WHEN number BETWEEN 1 AND 8 OR number = 11 OR number BETWEEN 14 AND 31 OR number BETWEEN 127 AND 159 OR number BETWEEN 64976 AND 65007 OR number % 65536 >= 65534 THEN '' ELSE chr(number::INTEGER) END) AS value FROM d LEFT JOIN numbers n USING (number)),
v AS (SELECT page_id, i, coalesce(g.value, f.value, '&' || r.body) AS value FROM r LEFT JOIN g ON g.body = r.body LEFT JOIN f ON f.body = r.body), a AS (SELECT page_id, list(value ORDER BY i) AS values FROM v GROUP BY 1),
x AS (SELECT page_id, array_to_string(list_transform(range(1, len(between) + 1), lambda i: between[i] || coalesce(values[i], '')), '') AS x FROM p LEFT JOIN a USING (page_id)), y AS (SELECT page_id, regexp_replace(regexp_replace(x, '{_SPACES}', ' ', 'g'), '^ | $', '', 'g') AS x FROM x)"""


@query(f"WITH {_HTML} SELECT page_id, md5(x) AS text_md5, length(x)::BIGINT AS text_chars FROM y")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    """All character references are resolved; script and style text stays."""
    t = X.html_text(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("text_chars"))


@query(r"""WITH l AS (SELECT page_id, list_transform(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1), lambda x: trim(x)) AS l FROM pages)
SELECT page_id, len(list_distinct(l))::BIGINT AS labels, array_to_string(list_sort(list_distinct(l)), '|') AS label_list, CASE WHEN len(list_distinct(l)) = 1 THEN l[1] END AS only_label FROM l""")
def html_labels(spark: SparkSession, d: str) -> DataFrame:
    """T25, T28."""
    x = X.html_labels(F.col("html"), "<a [^>]*>([^<]*)</a>")
    return table(spark, d, "pages").select("page_id", F.size(x).cast("long").alias("labels"), F.array_join(F.array_sort(x), "|").alias("label_list"), X.unique_marker(x).alias("only_label"))


@query("SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE url END AS canonical, contains(url, '.org') OR contains(url, 'example') AS matches, true AS matches_any FROM pages")
def url_filter(spark: SparkSession, d: str) -> DataFrame:
    """T26, T27."""
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", X.canonical_url(u).alias("canonical"), X.domain_matches(u, [".org", "example"]).alias("matches"), X.domain_matches(u, []).alias("matches_any"))


_MARKERS = ("Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.")


_SPOTS = " UNION ALL ".join(f"SELECT doc_id, i, '{m}' AS m, regexp_extract(raw, '[\\s\\p{{Z}}]*{m.replace('.', '[.]')}[\\s\\p{{Z}}]*$') AS span FROM l WHERE contains(raw, '{m}')" for m in _MARKERS)


@query(rf"""WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents), l AS (SELECT doc_id, raw, i FROM (SELECT doc_id, unnest(s) AS raw, generate_subscripts(s, 1) - 1 AS i, len(s) AS n FROM s) WHERE NOT (i = n - 1 AND raw = '')),
h AS (SELECT * FROM ({_SPOTS}) WHERE span <> ''), o AS (SELECT doc_id, min(i) AS i, min(m) AS m, min(span) AS span FROM h GROUP BY doc_id HAVING count(*) = 1),
c AS (SELECT l.doc_id, l.i, CASE WHEN l.i = o.i THEN nullif(rtrim(raw[1:length(raw) - length(span)]), '') ELSE raw END AS raw FROM l JOIN o USING (doc_id)), k AS (SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE raw IS NOT NULL), '') AS t FROM c GROUP BY doc_id)
SELECT d.doc_id, o.m AS marker, o.i::INTEGER AS line, md5(coalesce(k.t, d.text, '')) AS rest_md5 FROM documents d LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)""")
def line_markers(spark: SparkSession, d: str) -> DataFrame:
    """The only marker at a line's end of a document, and the text without its span."""
    t = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), X.embedded_marker(F.col("text"), _MARKERS, (r"\s*{m}\s*$",)).alias("m"))
    return t.select("doc_id", F.col("m.marker").alias("marker"), F.col("m.line").alias("line"), F.md5(X.without_span(F.col("text"), F.col("m"))).alias("rest_md5"))


@query(r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)
SELECT doc_id, len(list_filter(x, lambda s: regexp_matches(trim(s), '(?i)licen[sc]e'))) > 0 AS has_reference, md5(array_to_string(list_filter(x, lambda s: NOT regexp_matches(trim(s), '(?i)licen[sc]e')), chr(10))) AS rest_md5 FROM l""")
def references(spark: SparkSession, d: str) -> DataFrame:
    """T31."""
    p = "(?i)licen[sc]e"
    return table(spark, d, "documents").select("doc_id", X.has_reference(F.col("text"), p).alias("has_reference"), F.md5(X.without_references(F.col("text"), p)).alias("rest_md5"))


@query(rf"""WITH t AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(coalesce(text, ''), '\n[ \t]+\n', chr(10) || chr(10), 'g'), '\n{{2,}}'), lambda g: list_filter(list_transform(string_split(g, chr(10)), lambda x: trim(x)), lambda x: x <> '')), lambda g: len(g) > 0) AS s FROM documents)
SELECT doc_id, len(s)::BIGINT AS stanzas, md5(array_to_string(flatten(s)[1:3], chr(10))) AS first_md5 FROM t""")
def stanza_lines(spark: SparkSession, d: str) -> DataFrame:
    """T57, T59."""
    return table(spark, d, "documents").select("doc_id", F.size(X.stanzas(F.col("text"))).cast("long").alias("stanzas"), F.md5(F.array_join(X.first_lines(F.col("text"), 3), "\n")).alias("first_md5"))


_STRIP = r"regexp_replace(x, '^[ \t\n\r\f\x0b]+|[ \t\n\r\f\x0b]+$', '', 'g')"
_VERSE = r"text || chr(10) || '১২ *' || chr(10) || chr(10) || 'a' || chr(10) || 'b' || chr(10) || '(note)' || chr(10) || '— said' || chr(10) || 'c'"


@query(rf"""WITH l AS (SELECT doc_id, [{_STRIP} for x in string_split({_VERSE}, chr(10))] AS l FROM documents), e AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM l),
k AS (SELECT *, CASE WHEN s = '' THEN 'blank' WHEN regexp_full_match(s, '[\p{{Nd}}*.·\-–— ]+') THEN 'section-marker' WHEN (s[1] IN ('(', '[') AND s[-1] IN (')', ']')) OR s[1] = '—' THEN 'source-note' ELSE 'stanza' END AS k FROM e),
b AS (SELECT *, lag(k) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM k) SELECT doc_id, k AS kind, count(*)::BIGINT AS n FROM b WHERE k <> 'blank' AND (k <> 'stanza' OR before IS DISTINCT FROM 'stanza') GROUP BY doc_id, k""")
def verse_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Kinds and sizes of verse blocks."""
    from ..functions.kernels import verse_blocks as blocks

    text = F.concat("text", F.lit("\n১২ *\n\na\nb\n(note)\n— said\nc"))
    t = table(spark, d, "documents").select("doc_id", F.explode(blocks(text)).alias("b"))
    return t.select("doc_id", F.substring_index("b", "|", 1).alias("kind")).groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


@query(r"""WITH k AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+', '', 'g') AS k FROM documents)
SELECT md5(k) AS body_md5, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM k GROUP BY k HAVING count(*) > 1""")
def duplicate_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Texts that are equal once folded; the groups are counted by digest."""
    k = table(spark, d, "documents").select("doc_id", F.md5(X.body_key(F.col("text"))).alias("body_md5"))
    return k.groupBy("body_md5").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query(r"""WITH t AS (SELECT doc_id, string_split(text, chr(10))[1] AS title FROM documents)
SELECT doc_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(coalesce(title, ''), '\s*[\(\[][^\)\]]*[\)\]]\s*$', '')), '[^\p{L}\p{M}\p{N}\s]+', ' ', 'g'), '[ \t\n\r\f\x0b]+', ' ', 'g')) AS title_key FROM t""")
def title_keys(spark: SparkSession, d: str) -> DataFrame:
    """T54."""
    return table(spark, d, "documents").select("doc_id", X.title_key(F.get(F.split("text", "\n"), F.lit(0))).alias("title_key"))


@query(r"""WITH t AS (SELECT doc_id, list_filter([lang, CASE WHEN regexp_matches(text, '[*#$%&]{3}') THEN 'symbols' END, CASE WHEN contains(text, ' | ') THEN 'table' END, CASE WHEN regexp_matches(text, '[A-Z]{4,}') THEN 'capitals' END, CASE WHEN regexp_matches(text, '[0-9]') THEN 'digits' END], lambda x: x IS NOT NULL) AS g FROM documents)
SELECT doc_id, array_to_string(CASE WHEN len(g) > 0 THEN g[1:3] ELSE ['other'] END, ',') AS tags FROM t""")
def tag_rules(spark: SparkSession, d: str) -> DataFrame:
    """The language first, then rules in order, three at most."""
    rules = [("[*#$%&]{3}", "symbols"), (r" \| ", "table"), ("[A-Z]{4,}", "capitals"), ("[0-9]", "digits")]
    return table(spark, d, "documents").select("doc_id", F.array_join(X.tag_rules(F.col("text"), rules, F.col("lang")), ",").alias("tags"))


@query("""SELECT doc_id, CASE WHEN strpos(text, 'License') > 0 THEN substr(text, greatest(strpos(text, 'License') - 36, 1), strpos(text, 'License') - greatest(strpos(text, 'License') - 36, 1) + 7 + 36) ELSE '' END AS context FROM documents""")
def keyword_context(spark: SparkSession, d: str) -> DataFrame:
    """T22."""
    return table(spark, d, "documents").select("doc_id", X.keyword_context(F.col("text"), F.lit("License")).alias("context"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), h AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM l WHERE contains(t, 'the'))
SELECT doc_id, i::INTEGER AS line, md5(t) AS text_md5 FROM h WHERE rn <= 2""")
def lines_with_word(spark: SparkSession, d: str) -> DataFrame:
    """T23."""
    t = table(spark, d, "documents").select("doc_id", F.explode(X.lines_with(F.col("text"), F.lit("the"), 2)).alias("l"))
    return t.select("doc_id", F.col("l.line").alias("line"), F.md5("l.text").alias("text_md5"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents), e AS (SELECT doc_id, regexp_matches(lower(t), '\b(january|february|march|april|may|june|july|august|september|october|november|december)\b') AS m, regexp_matches(t, '[০-৯0-9]') AS g, regexp_matches(t, '\b(1[89]|20)[0-9]{2}\b') AS y, regexp_matches(lower(t), '\b(city|village|town|calcutta|london|paris)\b') AS p, length(regexp_replace(t, '[ \t\n\r\f\x0b]+', '', 'g')) AS n FROM l)
SELECT doc_id, count(*) FILTER (WHERE g)::BIGINT AS digit_lines, count(*) FILTER (WHERE y)::BIGINT AS year_lines, count(*) FILTER (WHERE n BETWEEN 4 AND 48 AND ((m AND g) OR (y AND p)))::BIGINT AS date_lines FROM e GROUP BY doc_id""")
def date_strength(spark: SparkSession, d: str) -> DataFrame:
    """T37, T38."""
    t = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("t"))
    e = X.date_evidence(F.col("t"))
    return t.groupBy("doc_id").agg(F.count_if(F.array_contains(e, "digit")).alias("digit_lines"), F.count_if(F.array_contains(e, "year")).alias("year_lines"), F.count_if(X.is_date_line(F.col("t"))).alias("date_lines"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'label ' || o_orderkey WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 90)::VARCHAR ELSE (o_orderkey % 90)::VARCHAR || '-' || (o_orderkey % 90 + o_orderkey % 3)::VARCHAR END AS label,
 replace('order {key} is {status}', '{key}', o_orderkey::VARCHAR).replace('{status}', o_orderstatus) AS said, 'order-' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') AS item FROM orders""")
def labels_and_templates(spark: SparkSession, d: str) -> DataFrame:
    """T50, T51, T56."""
    k = F.col("o_orderkey")
    label = X.page_label(F.when(k % 7 == 0, F.concat(F.lit("label "), k.cast("string"))), k % 90, k % 90 + k % 3)
    return table(spark, d, "orders").select("o_orderkey", label.alias("label"), X.interpolate(F.lit("order {key} is {status}"), {"key": k, "status": F.col("o_orderstatus")}).alias("said"), X.numbered_id(F.lit("order"), k % 1000).alias("item"))


@query(rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents), n AS (SELECT doc_id, i, {norm('t')} AS n FROM l)
SELECT doc_id, count(*) FILTER (WHERE length(replace(n, ' ', '')) >= 18)::BIGINT AS long_lines, min(i) FILTER (WHERE length(replace(n, ' ', '')) >= 18)::INTEGER AS first_index, count(*) FILTER (WHERE n <> '')::BIGINT AS merged FROM n GROUP BY doc_id""")
def substantial_lines(spark: SparkSession, d: str) -> DataFrame:
    """T60, T61."""
    t = table(spark, d, "documents").select("doc_id", X.long_lines(F.col("text"), 18).alias("l"), F.size(X.merged_lines([F.col("text")])).cast("long").alias("merged"))
    return t.select("doc_id", F.size("l").cast("long").alias("long_lines"), F.get("l", F.lit(0))["line_index"].alias("first_index"), "merged")
