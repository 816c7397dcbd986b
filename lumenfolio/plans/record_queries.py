"""Queries of text functions, flags and joins over made-up records (T*, C*, J*, A*, U*, O*)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions import text as X
from ..functions.profiles import BANGLA_CORPUS, BANGLA_MATCH, LEXICON_EQUIVALENCES, MATCH_EQUIVALENCES, CORPUS_EQUIVALENCES
from ..operators import audits, joins, pages, reports, sequence, views
from .base import WS, folder, norm, query, table, words

_LATIN, _BANGLA = "abcdefghijklmnopqrstuvwxyz0123456789", "আইউঊএঐওঔকখগঘচজটডিীুূেৈোৌনণ০১২৩৪৫৬৭৮৯"
_TEXT = f"translate(lower(text), '{_LATIN}', '{_BANGLA}')"


def _bangla(spark: SparkSession, d: str) -> DataFrame:
    """The documents in Bengali letters, one for each Latin one."""
    return table(spark, d, "documents").withColumn("text", F.translate(F.lower("text"), _LATIN, _BANGLA))


def _replaced(t: str, groups: tuple[tuple[str, ...], ...]) -> str:
    for variant, first in X.equivalence_pairs(groups):
        t = f"replace({t}, '{variant}', '{first}')"
    return t


_KEEP = f"regexp_replace(translate({_TEXT}, '০১২৩৪৫৬৭৮৯', '0123456789'), '[^ঀ-৿0-9 \\t\\n\\r\\f\\x0b]+', ' ', 'g')"
_TRIM = f"trim(regexp_replace({{}}, '{WS}+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({_TRIM.format(_replaced(_KEEP, MATCH_EQUIVALENCES))}) AS for_matching, md5({_TRIM.format(_replaced(_KEEP, CORPUS_EQUIVALENCES))}) AS for_corpus FROM documents")
def bangla_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    """T1, T3 with the Bengali profiles."""
    t = F.col("text")
    return _bangla(spark, d).select("doc_id", F.md5(X.normalize(t, BANGLA_MATCH)).alias("for_matching"), F.md5(X.normalize(t, BANGLA_CORPUS)).alias("for_corpus"))


@query(f"SELECT doc_id, md5({_TRIM.format('text')}) AS spaced, list_filter(regexp_extract_all({_TRIM.format(_TEXT)}, '[ঀ-৿]+'), lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '[০-৯0-9]+') AND x NOT IN ('গে', 'জে', 'দে', 'মে', 'তে', 'রে', 'সস', 'এস', 'টট', 'কক')) AS found FROM documents")
def bangla_words(spark: SparkSession, d: str) -> DataFrame:
    """Collapsed white space, and runs of letters in order."""
    spaced = table(spark, d, "documents").select("doc_id", F.md5(X.normalize_spacing(F.col("text"))).alias("spaced"))
    return spaced.join(_bangla(spark, d).select("doc_id", X.lexicon_words(F.col("text")).alias("found")), "doc_id")


_KEYED = _replaced("translate(token, '০১২৩৪৫৬৭৮৯', '0123456789')", LEXICON_EQUIVALENCES)


@query(f"WITH t AS (SELECT DISTINCT unnest(regexp_extract_all({_TEXT}, '[ঀ-৿]+')) AS token FROM documents) SELECT token, {_KEYED} AS key, regexp_replace({_KEYED}, '[ঁংঃািীুূৃেৈোৌ্]', '', 'g') AS loose FROM t")
def bangla_keys(spark: SparkSession, d: str) -> DataFrame:
    """T14, T15 with the Bengali equivalences."""
    t = _bangla(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit("[ঀ-৿]+"), 0)).alias("token")).distinct()
    return t.select("token", X.token_key(F.col("token")).alias("key"), X.loose_key(F.col("token")).alias("loose"))


_TOC = r"regexp_replace(regexp_replace({}, '\([^)]*\)', ' ', 'g'), '[.·•…_\-–—:;|]+', ' ', 'g')"
_LINE = "'  12 ' || string_split(text, chr(10))[1] || ' (' || lang || ') ..... ' || (doc_id % 200)"


@query(f"WITH t AS (SELECT doc_id, {_TOC.format(_LINE)} AS t FROM documents) SELECT doc_id, {_TRIM.format(r'''regexp_replace(t, '^[০-৯0-9 \t]+|[০-৯0-9 \t]+$', ' ', 'g')''')} AS title FROM t")
def contents_titles(spark: SparkSession, d: str) -> DataFrame:
    """Contents lines without leaders, brackets and numbers at the edges."""
    line = F.concat(F.lit("  12 "), F.get(F.split("text", "\n"), F.lit(0)), F.lit(" ("), "lang", F.lit(") ..... "), (F.col("doc_id") % 200).cast("string"))
    return table(spark, d, "documents").select("doc_id", X.toc_title(line).alias("title"))


@query(r"SELECT doc_id, md5(regexp_replace('(১) ' || text || '. ', '[\p{P}\p{S} \t\n\r\f\x0b]+', '', 'g')) AS plain FROM documents")
def compact_digits(spark: SparkSession, d: str) -> DataFrame:
    """Texts without punctuation and white space."""
    t = F.concat(F.lit("(১) "), "text", F.lit(". "))
    return table(spark, d, "documents").select("doc_id", F.md5(X.compact_digits(t)).alias("plain"))


@query("""WITH c AS (SELECT doc_id, unnest([1, 2, 3, 4]) AS i FROM documents), v AS (SELECT doc_id, doc_id * i % 90 AS value, CASE WHEN (doc_id + i) % 3 = 0 THEN 'latin' ELSE 'bangla' END AS script, (doc_id * 7 + i * 31) % 100 / 100.0 AS y, (doc_id * i) % 97 / 97.0 AS conf FROM c),
z AS (SELECT *, CASE WHEN y < 0.22 THEN 0 WHEN y > 0.78 THEN 1 END AS zone FROM v)
SELECT doc_id, string_agg(value || ':' || CASE zone WHEN 0 THEN 'top' ELSE 'bottom' END || ':' || script, ' ' ORDER BY script <> 'bangla', zone, conf DESC, value) AS found FROM z WHERE zone IS NOT NULL GROUP BY doc_id""")
def layout_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Page numbers by their place on the page."""
    k = F.col("doc_id")

    def row(i: int) -> Column:
        script = F.when((k + i) % 3 == 0, "latin").otherwise("bangla")
        return F.struct((k * i % 90).alias("value"), script.alias("script"), ((k * 7 + i * 31) % 100 / 100.0).alias("y_center"), ((k * i) % 97 / 97.0).alias("avg_conf"))

    found = X.layout_candidates(F.array(*[row(i) for i in (1, 2, 3, 4)]))
    shown = F.transform(found, lambda c: F.concat_ws(":", c["value"].cast("string"), c["zone"], c["script"]))
    return table(spark, d, "documents").where(F.size(found) > 0).select("doc_id", F.array_join(shown, " ").alias("found"))


@query("""WITH t AS (SELECT doc_id, (doc_id % 40)::VARCHAR AS want, CASE doc_id % 4 WHEN 0 THEN (doc_id % 40)::VARCHAR WHEN 1 THEN (doc_id % 40) || '7' WHEN 2 THEN 'p ' || (doc_id % 40) ELSE (doc_id % 41)::VARCHAR END AS foot FROM documents)
SELECT doc_id, foot = want AS exact, foot = want OR (doc_id % 4 <> 2 AND starts_with(foot, want) AND length(foot) = length(want) + 1) AS with_digit FROM t""")
def footer_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Whether a footer has the expected page, or one more digit behind it."""
    k = F.col("doc_id")
    want = (k % 40).cast("int")
    number = want.cast("string")
    foot = F.when(k % 4 == 0, F.concat(F.lit("- "), number, F.lit(" -"))).when(k % 4 == 1, F.concat(number, F.lit("7"))).when(k % 4 == 2, F.concat(F.lit("p "), number)).otherwise((k % 41).cast("string"))
    t = table(spark, d, "documents").withColumns({"foot": F.concat(F.lit("text above\n"), foot), "want": want})
    return t.select("doc_id", X.footer_has_page(F.col("foot"), F.col("want")).alias("exact"), X.footer_has_page(F.col("foot"), F.col("want"), True).alias("with_digit"))


@query(r"SELECT doc_id, md5(regexp_replace(translate(replace(chr(65279) || text || chr(13) || chr(10) || ' ', chr(13) || chr(10), chr(10)), '০১২৩৪৫৬৭৮৯' || chr(65279), '0123456789'), '^[ \t\n\r\f\x0b]+|[ \t\n\r\f\x0b]+$', '', 'g')) AS h FROM documents")
def import_texts(spark: SparkSession, d: str) -> DataFrame:
    """Digits, line ends, byte order marks and edges of imported texts."""
    return table(spark, d, "documents").select("doc_id", F.md5(X.import_normalize(F.concat(F.lit("﻿"), "text", F.lit("\r\n ")))).alias("h"))


_NUKTA = "replace(replace(replace({}, 'o', 'ড়'), 'e', 'ঢ়'), 'a', 'য়')"


@query(f"SELECT doc_id, md5(replace(replace(replace(replace({_NUKTA.format('lower(text)')}, 'ড়', 'ড'), 'ঢ়', 'ঢ'), 'য়', 'য'), '়', '')) AS folded FROM documents")
def folded_letters(spark: SparkSession, d: str) -> DataFrame:
    """Letters with a nukta become plain ones."""
    t = F.lower("text")
    for plain, letter in (("o", "ড়"), ("e", "ঢ়"), ("a", "য়")):
        t = F.replace(t, F.lit(plain), F.lit(letter))
    return table(spark, d, "documents").select("doc_id", F.md5(X.fold_letters(t)).alias("folded"))


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), i AS (SELECT doc_id, l, CASE WHEN len(l) <= 4 THEN range(0, len(l)) ELSE list_sort(list_distinct([round_even((len(l) - 1) / 3.0 * k, 0)::BIGINT for k in range(0, 4)])) END AS i FROM l)
SELECT doc_id, list_transform(i, lambda k: md5(l[k + 1])) AS lines FROM i""")
def sampled_lines(spark: SparkSession, d: str) -> DataFrame:
    """At most four lines of each text, evenly spaced."""
    lines = X.sample_evenly(F.split("text", "\n"), 4)
    return table(spark, d, "documents").select("doc_id", F.transform(lines, F.md5).alias("lines"))


@query("""WITH t AS (SELECT doc_id, ['b', 'a', 'b'] AS f, CASE doc_id % 3 WHEN 0 THEN 'x' ELSE 'y' END AS o, CASE doc_id % 2 WHEN 0 THEN 'x' ELSE 'y' END AS n FROM documents)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(f, CASE WHEN o <> n THEN ['page_type_changed:' || o || '->' || n] ELSE [] END))), ' ') AS flags, CASE WHEN doc_id % 5 < 3 THEN true ELSE false END AS trusted FROM t""")
def page_flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags of a changed page type, and trusted types."""
    k = F.col("doc_id")
    old, new = F.when(k % 3 == 0, "x").otherwise("y"), F.when(k % 2 == 0, "x").otherwise("y")
    kind = F.element_at(F.array(*map(F.lit, (*pages.TRUSTED, "front_matter", "publisher_page"))), (k % 5 + 1).cast("int"))
    flags = pages.changed_flags(F.array(F.lit("b"), F.lit("a"), F.lit("b")), old, new)
    return table(spark, d, "documents").select("doc_id", F.array_join(flags, " ").alias("flags"), pages.is_trusted(kind).alias("trusted"))


_SOURCE = "role:string,page_basis:string,page_start:int,page_end:int,publication_year:int"
_PRIMARY, _PRINTED, _YEAR = "doc_id % 3 <> 0", "doc_id % 5 <> 0 AND doc_id % 7 <> 0", "doc_id % 4 <> 0"


def _sourced(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    basis, end = F.when(k % 5 != 0, "printed_page").otherwise("scan"), F.when(k % 7 != 0, (k % 9 + 2).cast("int"))
    one = F.struct(F.when(k % 3 != 0, "primary").otherwise("secondary").alias("role"), basis.alias("page_basis"), (k % 9).cast("int").alias("page_start"), end.alias("page_end"), F.when(k % 4 != 0, F.lit(1954)).alias("publication_year"))
    none = F.array().cast(f"array<struct<{_SOURCE}>>")
    return table(spark, d, "documents").select("doc_id", F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, none).otherwise(F.array(one)).alias("book_sources"))


@query(f"""WITH t AS (SELECT doc_id, doc_id % 11 <> 0 AND doc_id % 13 <> 0 AS has, {_PRIMARY} AS p, {_PRINTED} AS q, {_YEAR} AS y FROM documents)
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE has AND p AND q END AS printed, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CASE WHEN has AND p AND q THEN 1 ELSE 0 END END::INTEGER AS n_printed, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE has AND p AND y END AS dated FROM t""")
def printed_sources(spark: SparkSession, d: str) -> DataFrame:
    """Primary sources with printed pages, and with a year."""
    s = F.col("book_sources")
    n = F.when(s.isNotNull(), F.size(views.printed_sources(s)))
    return _sourced(spark, d).select("doc_id", views.has_printed_pages(s).alias("printed"), n.alias("n_printed"), views.has_book_year(s).alias("dated"))


@query(f"SELECT doc_id FROM documents WHERE NOT (doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND {_PRIMARY} AND {_PRINTED})")
def gap_documents(spark: SparkSession, d: str) -> DataFrame:
    """Records without a primary source with printed pages."""
    return views.gap_rows(_sourced(spark, d), "book_sources").select("doc_id")


@query("SELECT s_suppkey, n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON s_nationkey = n_nationkey")
def optional_dimension(spark: SparkSession, d: str) -> DataFrame:
    """A dimension that not all rows have."""
    return views.with_dimension(table(spark, d, "supplier"), table(spark, d, "nation").where("n_nationkey < 12"), "s_nationkey", "n_nationkey").select("s_suppkey", "n_name")


@query("SELECT o_orderkey, l_linenumber::INTEGER AS line FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber BETWEEN 2 AND (o_orderkey % 5)")
def exact_book_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a range in one book, by equal book and page."""
    cited = table(spark, d, "orders").select("o_orderkey", F.lit(2).alias("s"), (F.col("o_orderkey") % 5).cast("int").alias("e"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("int").alias("line"))
    return joins.expand_range(cited, "s", "e", "line").join(lines, ["o_orderkey", "line"]).select("o_orderkey", "line")


@query(f"""WITH b AS (SELECT item_id, {norm('text')} AS n FROM benchmark), d AS (SELECT doc_id, doc_id % (SELECT count(*) FROM benchmark) AS item_id, {norm('text')} AS n FROM documents) SELECT doc_id, item_id, b.n = d.n OR contains(b.n, d.n) OR contains(d.n, b.n) AS meets FROM b JOIN d USING (item_id)""")
def containment(spark: SparkSession, d: str) -> DataFrame:
    """Texts of which either holds the other; each document with the passage of its number among all."""
    passages = table(spark, d, "benchmark")
    t = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % passages.count()).alias("item_id"), X.normalize(F.col("text")).alias("b"))
    return t.join(passages.select("item_id", X.normalize(F.col("text")).alias("a")), "item_id").select("doc_id", "item_id", joins.contains_either_way(F.col("a"), F.col("b")).alias("meets"))


_EDITION = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN 'B1' ELSE 'B9' END"


@query(f"SELECT doc_id, b AS book FROM (SELECT doc_id, {_EDITION} AS e FROM documents), (VALUES ('b1'), ('b2'), ('b3')) AS v(b) WHERE e IS NULL OR e = 'unknown' OR (e = 'B1' AND b IN ('b1', 'b2'))")
def allowed_books(spark: SparkSession, d: str) -> DataFrame:
    """Any book for an unknown edition, the mapped ones, or none for an edition without a mapping."""
    k = F.col("doc_id")
    edition = F.when(k % 4 == 1, "unknown").when(k % 4 == 2, "B1").when(k % 4 == 3, "B9")
    mapped = F.when(edition == "B1", F.array(F.lit("b1"), F.lit("b2")))
    t = table(spark, d, "documents").select("doc_id", joins.allowed_books(edition, mapped, "unknown").alias("allowed"), F.explode(F.array(F.lit("b1"), F.lit("b2"), F.lit("b3"))).alias("book"))
    return t.where(joins.is_allowed(F.col("allowed"), F.col("book"))).select("doc_id", "book")


@query("""WITH p AS (SELECT doc_id, source AS book, CASE WHEN doc_id % 6 <> 0 THEN doc_id % 50 END AS page FROM documents WHERE doc_id % 5 < 3), i AS (SELECT item_id, 'src' || item_id % 20 AS book, item_id % 50 AS page FROM benchmark) SELECT i.item_id, p.doc_id FROM i JOIN p ON i.book = p.book AND i.page = p.page""")
def indexed_pages(spark: SparkSession, d: str) -> DataFrame:
    """The trusted pages under a book and a printed page."""
    k = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, (*pages.TRUSTED, "front_matter", "publisher_page"))), (k % 5 + 1).cast("int"))
    p = table(spark, d, "documents").select("doc_id", F.col("source").alias("book_id"), F.when(k % 6 != 0, k % 50).alias("printed_page"), kind.alias("page_type"))
    i = table(spark, d, "benchmark").select("item_id", F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("book_id"), (F.col("item_id") % 50).alias("printed_page"))
    return i.join(pages.page_index(p), ["book_id", "printed_page"]).select("item_id", "doc_id")


@query("""WITH t AS (SELECT doc_id, [x for x in string_split((doc_id % 300) || chr(10) || text || chr(10) || '- ' || (doc_id % 77) || ' -', chr(10)) if trim(x) <> ''] AS l FROM documents),
n AS (SELECT doc_id, list_distinct([regexp_extract(x, '^[^\\p{L}\\p{M}\\p{N}]*([0-9]{1,3})[^\\p{L}\\p{M}\\p{N}]*$', 1) for x in l[1:4]]) AS a, list_distinct([regexp_extract(x, '^[^\\p{L}\\p{M}\\p{N}]*([0-9]{1,3})[^\\p{L}\\p{M}\\p{N}]*$', 1) for x in l[greatest(len(l) - 3, 1):]]) AS b FROM t),
m AS (SELECT doc_id, len(list_distinct([x::INTEGER for x in a if x <> '']))::INTEGER AS top, len(list_distinct([x::INTEGER for x in b if x <> '']))::INTEGER AS bottom FROM n) SELECT doc_id, top, bottom, top + bottom AS total FROM m""")
def candidate_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many page numbers the top and the bottom of a page may hold."""
    k = F.col("doc_id")
    text = F.concat((k % 300).cast("string"), F.lit("\n"), "text", F.lit("\n- "), (k % 77).cast("string"), F.lit(" -"))
    return table(spark, d, "documents").select("doc_id", pages.candidate_counts(text).alias("c")).select("doc_id", "c.top", "c.bottom", "c.total")


@query("SELECT doc_id, CASE WHEN n_chars % 7 >= n_chars % 5 AND n_chars % 7 >= n_chars % 3 THEN 'raw' WHEN n_chars % 5 >= n_chars % 3 THEN 'gray' ELSE 'sharp' END AS profile FROM documents")
def longest_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The first profile with the longest text."""
    made = [F.struct(F.lit(name).alias("profile"), F.repeat(F.lit("x"), (F.col("n_chars") % n).cast("int")).alias("text")) for name, n in (("raw", 7), ("gray", 5), ("sharp", 3))]
    return table(spark, d, "documents").select("doc_id", pages.longest_profile(F.array(*made))["profile"].alias("profile"))


_SET = f"list_distinct(list_filter({words(norm('text'))}, lambda x: length(x) >= 3))"


@query(f"WITH b AS (SELECT item_id, {_SET} AS a FROM benchmark), d AS (SELECT doc_id, {_SET} AS b FROM documents) SELECT item_id, len(a)::INTEGER AS n_a, len(b)::INTEGER AS n_b, len(list_intersect(a, b))::INTEGER AS n_both FROM b JOIN d ON item_id = doc_id")
def set_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of sets and of what they share."""
    sets = lambda name, key, out: table(spark, d, name).select(F.col(key).alias("item_id"), X.token_set(X.normalize(F.col("text"))).alias(out))
    t = sets("benchmark", "item_id", "a").join(sets("documents", "doc_id", "b"), "item_id")
    return t.select("item_id", F.size("a").alias("n_a"), F.size("b").alias("n_b"), F.size(F.array_intersect("a", "b")).alias("n_both"))


@query("SELECT source, lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1")
def best_per_key(spark: SparkSession, d: str) -> DataFrame:
    """The best row of each key."""
    return joins.keep_first(table(spark, d, "documents"), ["source", "lang"], [F.col("n_chars").desc(), "doc_id"]).select("source", "lang", "doc_id", "n_chars")


#: What is written around a document's text, by doc_id % 8: each form of a marker, a bare name, two markers.
_AROUND = ("{t}", "{t} # Alpha", "{t}\n— (Alpha) ", "[Beta]\n{t}", "{t}\nverse text  book: Beta", "{t} (Alpha  collection)", "Beta\n{t}", "# Alpha\n{t}\nlast (Beta)")
_AROUND_SQL = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN " + " || ".join({"t": "text", "\n": "chr(10)"}.get(x, f"'{x}'") for x in re.split(r"(\n)|\{(t)\}", a) if x) for i, a in enumerate(_AROUND)) + " END"
_MARKED = f"SELECT doc_id, {_AROUND_SQL} AS text, CASE doc_id % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'Alpha' WHEN 2 THEN 'Beta' END AS edition FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)"
_S = r"[\s\p{Z}]"
_FORMS = (rf"{_S}*[#＃]{_S}*M{_S}*$", rf"{_S}*[—-]?{_S}*[(\[]{_S}*M{_S}*[)\]]{_S}*$", rf"{_S}*(collection|book){_S}*[:：-]{_S}*M{_S}*$", rf"{_S}*[(\[]{_S}*M{_S}+(collection|book){_S}*[)\]]{_S}*$")
_FOUND = ", ".join(f"('{m}', '{f.replace('M', m)}')" for m in ("Alpha", "Beta") for f in _FORMS)


@query(rf"""WITH t AS MATERIALIZED ({_MARKED}), s AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM t), l AS (SELECT doc_id, raw, i FROM (SELECT doc_id, unnest(s) AS raw, generate_subscripts(s, 1) - 1 AS i, len(s) AS n FROM s) WHERE NOT (i = n - 1 AND raw = '')),
f(m, form) AS (VALUES {_FOUND}), h AS (SELECT doc_id, i, m, regexp_extract(raw, form) AS span FROM (SELECT * FROM l WHERE contains(raw, 'Alpha') OR contains(raw, 'Beta')), f WHERE regexp_matches(raw, form)), o AS (SELECT doc_id, min(i) AS i, min(m) AS m, min(span) AS span FROM h GROUP BY doc_id HAVING count(*) = 1),
c AS (SELECT l.doc_id, l.i, CASE WHEN l.i = o.i THEN nullif(rtrim(raw[1:length(raw) - length(span)]), '') ELSE raw END AS raw FROM l JOIN o USING (doc_id)), k AS (SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE raw IS NOT NULL), '') AS t FROM c GROUP BY doc_id)
SELECT t.doc_id, m AS marker, CASE WHEN m IS NULL THEN 'no_marker' WHEN edition = 'unknown' THEN 'unknown_edition_marker' WHEN m = edition THEN 'match' ELSE 'conflict' END AS status, m IS NOT NULL AND edition <> 'unknown' AND edition <> m AS clash, span, md5(coalesce(k.t, t.text)) AS clean_md5 FROM t LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)""")
def marker_audit(spark: SparkSession, d: str) -> DataFrame:
    """Markers in each of their forms at a line's end, also behind other text, against the edition."""
    k = F.col("doc_id")
    around = lambda a: F.concat(*[F.col("t") if x == "{t}" else F.lit(x) for x in re.split(r"(\{t\})", a) if x])
    text = F.element_at(F.array(*map(around, _AROUND)), (k % len(_AROUND) + 1).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select("doc_id", text.alias("text"), F.element_at(F.array(*map(F.lit, ("unknown", "Alpha", "Beta"))), (k % 3 + 1).cast("int")).alias("edition"))
    t = audits.marker_audit(rows, "text", ("Alpha", "Beta"), "edition", "unknown")
    return t.select("doc_id", "marker", F.col("marker_status").alias("status"), F.col("marker_conflict").isNotNull().alias("clash"), F.col("marker_span").alias("span"), F.md5("clean_text").alias("clean_md5"))


_LINE = f"SELECT item_id AS id, k, array_to_string(w[k * 12 + 1:k * 12 + 12], ' ') AS t, w[k * 12 + 1:k * 12 + 12] AS w FROM (SELECT item_id, {words(norm('text'))} AS w FROM benchmark), unnest(range(0, (len(w) + 11) // 12)) AS u(k)"


@query(rf"""WITH RECURSIVE l AS MATERIALIZED ({_LINE}), p AS MATERIALIZED (SELECT a.id, a.k, a.t AS a, b.t AS b, a.w AS x, b.w AS y FROM l a JOIN l b ON b.id = a.id + 1 AND b.k = a.k),
s AS (SELECT id, k, max(n) AS n FROM (SELECT id, k, n FROM p, unnest(range(1, length(a) + 1)) AS u(i), unnest(range(1, length(a) + 1)) AS v(n) WHERE i + n <= length(a) + 1 AND contains(b, substr(a, i, n))) GROUP BY 1, 2),
r AS (SELECT id, k, max(n) AS n FROM (SELECT id, k, n FROM p, unnest(range(1, len(x) + 1)) AS u(i), unnest(range(1, len(x) + 1)) AS v(n) WHERE i + n <= len(x) + 1 AND contains(' ' || array_to_string(y, ' ') || ' ', ' ' || array_to_string(x[i:i + n - 1], ' ') || ' ')) GROUP BY 1, 2),
q AS (SELECT id, k, 0 AS i, list_transform(y, lambda z: 0) AS row FROM p UNION ALL SELECT q.id, q.k, q.i + 1, list_transform(range(1, len(y) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda t: greatest(q.row[t], CASE WHEN p.x[q.i + 1] = p.y[t] THEN 1 + CASE WHEN t > 1 THEN q.row[t - 1] ELSE 0 END ELSE 0 END)))) FROM q JOIN p ON p.id = q.id AND p.k = q.k WHERE q.i < len(p.x)),
z AS (SELECT id, k, max(row[len(row)]) AS n FROM q GROUP BY 1, 2)
SELECT p.id AS item_id, p.k::INTEGER AS line_index, coalesce(s.n, 0)::INTEGER AS run, coalesce(r.n, 0)::INTEGER AS token_run, coalesce(z.n, 0)::INTEGER AS lcs FROM p LEFT JOIN s ON s.id = p.id AND s.k = p.k LEFT JOIN r ON r.id = p.id AND r.k = p.k LEFT JOIN z ON z.id = p.id AND z.k = p.k""")
def pair_kernels(spark: SparkSession, d: str) -> DataFrame:
    """T43-T45 of unlike texts: each line of a passage and the same line of the next passage."""
    w = X.words(X.normalize(F.col("text")))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 12).cast("int")), lambda i: F.slice("w", i * 12 + 1, 12))
    lines = table(spark, d, "benchmark").select("item_id", w.alias("w")).where("size(w) > 0").select("item_id", F.posexplode(cut).alias("line_index", "x"))
    after = lines.select((F.col("item_id") - 1).alias("item_id"), "line_index", F.col("x").alias("y"))
    t = lines.join(after, ["item_id", "line_index"]).withColumns({"a": F.array_join("x", " "), "b": F.array_join("y", " ")})
    return t.select("item_id", "line_index", kernels.common_substring("a", "b").alias("run"), kernels.token_common_run("x", "y").alias("token_run"), kernels.token_lcs("x", "y").alias("lcs"))


@query(f"SELECT item_id, 1.0::DOUBLE AS same, (CASE WHEN length(text) > 0 THEN length(text) END)::INTEGER AS run, len({words(norm('text'))})::INTEGER AS lcs FROM benchmark")
def self_kernels(spark: SparkSession, d: str) -> DataFrame:
    """T41, T43, T44, T45 of texts against themselves: ratio 1, and the whole text in common; ``pair_kernels`` and ``gestalt_pairs`` have unlike ones."""
    w = X.words(X.normalize(F.col("text")))
    t = table(spark, d, "benchmark").select("item_id", "text", w.alias("w"))
    run, lcs, tokens = kernels.common_substring("text", "text"), kernels.token_lcs("w", "w"), kernels.token_common_run("w", "w")
    return t.select("item_id", kernels.gestalt_ratio("text", "text").alias("same"), run.alias("run"), lcs.alias("lcs"), tokens.alias("tokens")).where("lcs = tokens").drop("tokens")


_TITLE = "array_to_string(string_split(text, ' ')[1:6], ' ')"
_BLOCKS = "flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(range(1, length(a) - i + 2), lambda k: {'k': k, 'i': -i, 'j': strpos(b, substr(a, i, k))})))"


@query(f"""WITH RECURSIVE p AS (SELECT x.item_id, {_TITLE.replace('text', 'x.text')} AS a, {_TITLE.replace('text', 'y.text')} AS b FROM benchmark x JOIN benchmark y ON y.item_id = x.item_id + 1),
s AS (SELECT item_id, a, b, 0::BIGINT AS k FROM p UNION ALL SELECT item_id, CASE WHEN side = 0 THEN substr(a, 1, -m.i - 1) ELSE substr(a, m.k - m.i) END, CASE WHEN side = 0 THEN substr(b, 1, m.j - 1) ELSE substr(b, m.k + m.j) END, CASE WHEN side = 0 THEN m.k ELSE 0 END FROM (SELECT item_id, a, b, list_max(list_filter({_BLOCKS}, lambda x: x.j > 0)) AS m FROM s WHERE a <> '' AND b <> ''), (VALUES (0), (1)) v(side) WHERE m IS NOT NULL)
SELECT p.item_id, round(2.0 * sum(s.k) / (length(p.a) + length(p.b)), 6)::DOUBLE AS ratio FROM p JOIN s USING (item_id) GROUP BY p.item_id, p.a, p.b""")
def gestalt_pairs(spark: SparkSession, d: str) -> DataFrame:
    """T41 of unlike texts: the first words of a passage and of the next one."""
    t = table(spark, d, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), 1, 6), " ").alias("a"))
    after = t.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return t.join(after, "item_id").select("item_id", F.round(kernels.gestalt_ratio("a", "b"), 6).alias("ratio"))


# Report orders: rows by arithmetic on the id, and the place that each order gives them.
_REPORT = """SELECT doc_id, 'f' || lpad(doc_id::VARCHAR, 9, '0') AS key, doc_id % 7 AS ordered_run, doc_id % 5 AS longest_line_run, doc_id % 11 AS line_matches, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE doc_id % 4 END AS exact_lines, (doc_id % 13) / 4.0 AS score,
 doc_id % 2 = 0 AS verified, (doc_id % 6) / 8.0 AS ratio, (doc_id % 17) AS page, 'e' || doc_id % 3 AS edition, 't' || lpad((doc_id * 7919 % 100003)::VARCHAR, 6, '0') || doc_id AS title, doc_id % 8 AS evidence_score, CASE doc_id % 4 WHEN 0 THEN 'reviewed_negative' WHEN 1 THEN 'no_candidate' WHEN 2 THEN 'review' ELSE 'token_or_title_only_candidate' END AS bucket,
 (doc_id % 32) / 32.0 AS posterior, (doc_id % 25) / 25.0 AS unknown_ratio, doc_id % 12 AS unknown, source AS book_id, doc_id AS scan_page, doc_id % 19 AS count, 'k' || doc_id AS token,
 CASE doc_id % 3 WHEN 0 THEN 'strong_fuzzy_review' WHEN 1 THEN 'manual_collection_review' ELSE 'weak' END AS s_fuzzy, CASE doc_id % 3 WHEN 0 THEN 'strong_ordered_review' WHEN 1 THEN 'manual_ordered_review' ELSE 'weak' END AS s_ordered,
 CASE doc_id % 5 WHEN 0 THEN 'supported' WHEN 1 THEN 'supported_token_only' WHEN 2 THEN 'weak_current_citation' ELSE 'missing_page_rows' END AS s_citation, CASE doc_id % 4 WHEN 0 THEN 'safe_same_book_repair_candidate' WHEN 1 THEN 'canonical_book_page_conflict' WHEN 2 THEN 'alias_alternate_page_evidence' ELSE 'other' END AS s_repair,
 CASE doc_id % 3 WHEN 0 THEN 'strong_date_review' WHEN 1 THEN 'date_review' ELSE 'no_date_evidence' END AS s_date FROM documents"""
_ORDERS = {
    "fuzzy_candidates": ("", "ordered_run DESC, longest_line_run DESC, line_matches DESC, coalesce(exact_lines, 0) DESC, score DESC, doc_id", reports.fuzzy_candidate_order),
    "fuzzy_rows": ("s_fuzzy", "s_fuzzy <> 'strong_fuzzy_review', s_fuzzy <> 'manual_collection_review', line_matches DESC, exact_lines DESC NULLS LAST, key", reports.fuzzy_row_order),
    "ordered_candidates": ("", "coalesce(exact_lines, 0) DESC, ordered_run DESC, line_matches DESC, score DESC, doc_id", reports.ordered_candidate_order),
    "ordered_rows": ("s_ordered", "s_ordered <> 'strong_ordered_review', s_ordered <> 'manual_ordered_review', exact_lines DESC NULLS LAST, ordered_run DESC, line_matches DESC, key", reports.ordered_row_order),
    "contents_candidates": ("", "verified DESC, score DESC, ratio DESC, page, doc_id", reports.contents_candidate_order),
    "gaps": ("", "starts_with(bucket, 'reviewed_'), bucket IN ('no_candidate', 'token_or_title_only_candidate'), evidence_score DESC, edition, title", reports.gap_order),
    "factors": ("", "posterior DESC, key", reports.factor_order),
    "citations": ("s_citation", "s_citation = 'supported', s_citation = 'supported_token_only', s_citation = 'weak_current_citation', key", reports.citation_order),
    "repairs": ("s_repair", "s_repair <> 'safe_same_book_repair_candidate', s_repair <> 'canonical_book_page_conflict', s_repair <> 'alias_alternate_page_evidence', key", reports.repair_order),
    "dates": ("s_date", "s_date <> 'strong_date_review', s_date <> 'date_review', key", reports.date_order),
    "worst_pages": ("", "unknown_ratio DESC, unknown DESC, book_id, scan_page", reports.worst_page_order),
    "suggestions": ("", "score DESC, count DESC, token", reports.suggestion_order),
}


def _report_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (k % n + 1).cast("int"))
    s = lambda c: c.cast("string")
    return table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("f"), F.lpad(s(k), 9, "0")).alias("key"), (k % 7).alias("ordered_run"), (k % 5).alias("longest_line_run"), (k % 11).alias("line_matches"), F.when(k % 9 != 0, k % 4).alias("exact_lines"), (k % 13 / 4).alias("score"),
        (k % 2 == 0).alias("verified"), (k % 6 / 8).alias("ratio"), (k % 17).alias("page"), F.concat(F.lit("e"), s(k % 3)).alias("edition"), F.concat(F.lit("t"), F.lpad(s(k * 7919 % 100003), 6, "0"), s(k)).alias("title"), (k % 8).alias("evidence_score"),
        pick(4, "reviewed_negative", "no_candidate", "review", "token_or_title_only_candidate").alias("bucket"), (k % 32 / 32).alias("posterior"), (k % 25 / 25).alias("unknown_ratio"), (k % 12).alias("unknown"), F.col("source").alias("book_id"), k.alias("scan_page"), (k % 19).alias("count"), F.concat(F.lit("k"), s(k)).alias("token"),
        pick(3, "strong_fuzzy_review", "manual_collection_review", "weak").alias("s_fuzzy"), pick(3, "strong_ordered_review", "manual_ordered_review", "weak").alias("s_ordered"),
        pick(5, "supported", "supported_token_only", "weak_current_citation", "missing_page_rows", "missing_page_rows").alias("s_citation"), pick(4, "safe_same_book_repair_candidate", "canonical_book_page_conflict", "alias_alternate_page_evidence", "other").alias("s_repair"), pick(3, "strong_date_review", "date_review", "no_date_evidence").alias("s_date"),
    )


@query(f"WITH r AS ({_REPORT}) " + " UNION ALL ".join(f"SELECT '{name}' AS report, doc_id, row_number() OVER (ORDER BY {order}) AS place FROM r" for name, (_, order, _f) in _ORDERS.items()))
def report_orders(spark: SparkSession, d: str) -> DataFrame:
    """The place of every row in each report's order."""
    rows, path, out = _report_rows(spark, d), folder(spark), None
    for name, (status, _, order) in _ORDERS.items():
        t = rows.withColumn("status", F.col(status)) if status else rows
        part = sequence.numbered(t, [*order(), "doc_id"], "place", f"{path}/{name}").select(F.lit(name).alias("report"), "doc_id", "place")
        out = part if out is None else out.unionByName(part)
    return out
