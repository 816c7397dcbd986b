"""Queries of the matchers: phrase windows, page scores, anchors, spans, fuzzy lines, lexicon and citations (M*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.profiles import LATIN_CLASSES
from ..operators import audits, contents, joins, lexicon, matching, page_pool, regions, reports
from ..operators import pages as P
from . import text_queries  # noqa: F401  (its SQL is part of some here)
from .base import ORACLES, norm, query, table, words, written
from .relational_queries import document_tokens

_WINDOWS = """w AS (SELECT id, list_filter({words}, lambda x: NOT regexp_full_match(x, '[0-9]+') AND length(x) >= 2) AS w FROM (SELECT {id} AS id, {norm} AS n FROM {table})), s AS (SELECT id, w, unnest([6, 5, 4]) AS size FROM w), p AS (SELECT id, w, size, unnest(range(0, len(w) - size + 1)) AS start FROM s) SELECT id, start, size, array_to_string(w[start + 1:start + size], ' ') AS phrase FROM p"""


def _windows(name: str, key: str) -> str:
    return "WITH " + _WINDOWS.format(words=words("n"), id=key, norm=norm("text"), table=name)


@query(f"""WITH a AS ({_windows('benchmark', 'item_id')}), b AS (SELECT DISTINCT id, phrase FROM ({_windows('documents', 'doc_id')}) WHERE phrase IN (SELECT phrase FROM a)), r AS (SELECT phrase FROM b GROUP BY phrase HAVING count(*) <= 2),
m AS (SELECT a.id AS item_id, b.id AS doc_id, a.start, a.size FROM a JOIN b USING (phrase) JOIN r USING (phrase)), c AS (SELECT item_id, doc_id, count(DISTINCT p)::BIGINT AS covered FROM (SELECT item_id, doc_id, unnest(range(start, start + size)) AS p FROM m) GROUP BY 1, 2),
h AS (SELECT item_id, doc_id, count(*) FILTER (WHERE size = 6)::BIGINT AS hits_6, count(*) FILTER (WHERE size = 5)::BIGINT AS hits_5, count(*) FILTER (WHERE size = 4)::BIGINT AS hits_4, sum(size)::BIGINT AS score FROM m GROUP BY 1, 2), t AS (SELECT * FROM h JOIN c USING (item_id, doc_id) WHERE score >= 20)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY hits_6 DESC, hits_5 DESC, hits_4 DESC, covered DESC, score DESC, doc_id)::INTEGER AS rank FROM t) WHERE rank <= 5""")
def phrase_window_audit(spark: SparkSession, d: str) -> DataFrame:
    """M6 (J8, A11, A21, O2): the documents that hold windows of each benchmark passage, phrases of at most two documents."""
    needles = written(matching.phrase_windows(table(spark, d, "benchmark"), "item_id", "text"))
    pages = written(matching.phrase_pages(needles, table(spark, d, "documents").withColumnRenamed("doc_id", "page_id"), "text"))
    return matching.top_pages(matching.phrase_hits(needles, pages)).withColumnRenamed("page_id", "doc_id").select("item_id", "doc_id", "hits_6", "hits_5", "hits_4", "covered", "score", "rank")


def corpus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Benchmark items as passages (the first six words as title), documents as prepared, numbered, trusted pages."""
    p = P.document_pages(table(spark, d, "documents")).withColumnRenamed("doc_id", "page_id")
    p = p.withColumns({"printed_page": F.when(F.col("page_id") % 5 != 0, F.col("scan_page") + 3), "page_type": F.lit("normal_poem_page")})
    items = table(spark, d, "benchmark").withColumn("title", F.array_join(F.slice(F.split("text", " "), 1, 6), " "))
    return matching.prepared_passages(items, "title", "text"), written(matching.prepared_pages(p).drop("text"))


_PASSAGES = f"""i AS (SELECT item_id, {norm("array_to_string(string_split(text, ' ')[1:6], ' ')")} AS title, {norm('text')} AS n, list_filter(list_transform(string_split(text, chr(10)), lambda x: {norm('x')}), lambda x: length(x) >= 8) AS lines FROM benchmark),
d AS (SELECT doc_id, source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS scan_page, {norm('text')} AS n, list_filter(list_transform(string_split(text, chr(10)), lambda x: {norm('x')}), lambda x: x <> '') AS lines FROM documents),
it AS (SELECT item_id, unnest(list_distinct(list_filter({words('n')}, lambda x: length(x) >= 3))) AS token FROM i), dt AS (SELECT doc_id, book_id, unnest(list_distinct(list_filter({words('n')}, lambda x: length(x) >= 3))) AS token FROM d),
pr AS (SELECT item_id, doc_id, count(*) AS overlap FROM it JOIN dt USING (token) GROUP BY 1, 2), sz AS (SELECT item_id, count(*) AS n FROM it GROUP BY 1)"""
_HEAD = r"""len(list_filter(d.lines, lambda x: trim(regexp_replace(regexp_replace(x, '(^|[ ])[0-9]+([ ][0-9]+)*([ ]|$)', ' ', 'g'), '^ +| +$', '', 'g')) = i.title OR (contains(i.title, ' ') AND starts_with(x || ' ', i.title || ' ') AND len(string_split(x, ' ')) <= len(string_split(i.title, ' ')) + 2))) > 0"""


_SCORES = f"""t AS (SELECT i.item_id, d.doc_id, d.book_id, d.scan_page, coalesce(pr.overlap, 0) AS overlap, coalesce(sz.n, 0) AS total, i.title <> '' AND {_HEAD} AS heading, i.title <> '' AND contains(d.n, i.title) AS phrase, coalesce(contains(d.n, i.lines[1]), false) AS first, coalesce(contains(d.n, i.lines[len(i.lines)]), false) AS last, d.doc_id % 5 <> 0 AS paged FROM i CROSS JOIN d LEFT JOIN pr ON pr.item_id = i.item_id AND pr.doc_id = d.doc_id LEFT JOIN sz ON sz.item_id = i.item_id),
s AS (SELECT *, (least(overlap, 40) * 0.4 + CASE WHEN heading THEN 12 WHEN phrase THEN 2 ELSE 0 END + CASE WHEN first THEN 8 ELSE 0 END + CASE WHEN last THEN 8 ELSE 0 END + CASE WHEN paged THEN 1 ELSE 0 END)::DOUBLE AS score,
 list_sort(list_filter([CASE WHEN heading THEN 'title_match' END, CASE WHEN phrase AND NOT heading THEN 'title_phrase_match' END, CASE WHEN first THEN 'first_line_match' END, CASE WHEN last THEN 'last_line_match' END, CASE WHEN overlap >= 8 THEN 'body_token_overlap' END, CASE WHEN overlap / greatest(total, 1) >= 0.35 THEN 'high_body_coverage' END, CASE WHEN paged THEN 'page_sequence_present' END], lambda x: x IS NOT NULL)) AS e FROM t)"""


@query(f"""WITH {_PASSAGES}, {_SCORES} SELECT item_id, doc_id, round(score, 6) AS score, array_to_string(e, ',') AS evidence FROM s WHERE score >= 10""")
def page_score(spark: SparkSession, d: str) -> DataFrame:
    """M1, J7, C8, T19: the scores of all documents for each passage."""
    passages, pages = corpus(spark, d)
    s = matching.score_pages(passages, pages)
    return s.select("item_id", F.col("page_id").alias("doc_id"), F.round("score", 6).alias("score"), F.array_join("evidence", ",").alias("evidence"))


_BOOKS = "w AS (SELECT item_id, book_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, book_id, scan_page) AS rn FROM s WHERE score >= 10), bb AS (SELECT item_id, book_id FROM w WHERE rn = 1)"
_ANCHORS = f"""{_PASSAGES}, {_SCORES}, {_BOOKS}, l AS (SELECT item_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS k FROM i), c AS (SELECT l.item_id, d.doc_id, d.book_id, l.k, l.line, contains(d.n, l.line) AS exact FROM bb JOIN l USING (item_id) JOIN d USING (book_id)),
df AS (SELECT book_id, token, count(*) AS df FROM dt GROUP BY 1, 2), bp AS (SELECT book_id, count(*) AS pages FROM d GROUP BY 1), lt AS (SELECT item_id, k, unnest(list_distinct(list_filter({words('line')}, lambda x: length(x) >= 3))) AS token FROM l),
f AS (SELECT c.item_id, c.doc_id, c.k, count(*) AS n, count(dt.token) AS found, count(*) FILTER (WHERE coalesce(df.df, 0) <= greatest(3, floor(bp.pages * 0.08))) AS rare, count(dt.token) FILTER (WHERE coalesce(df.df, 0) <= greatest(3, floor(bp.pages * 0.08))) AS rare_found FROM c JOIN lt ON lt.item_id = c.item_id AND lt.k = c.k JOIN bp ON bp.book_id = c.book_id LEFT JOIN df ON df.book_id = c.book_id AND df.token = lt.token LEFT JOIN dt ON dt.doc_id = c.doc_id AND dt.token = lt.token WHERE NOT c.exact GROUP BY 1, 2, 3),
m AS (SELECT item_id, doc_id, k, 'exact' AS kind FROM c WHERE exact UNION ALL SELECT item_id, doc_id, k, 'fuzzy' FROM f WHERE n >= 4 AND found / n >= 0.82 AND (rare = 0 OR rare_found >= least(2, rare)))"""


@query(f"WITH {_ANCHORS} SELECT item_id, doc_id, k::INTEGER AS line_index, kind FROM m")
def line_anchors(spark: SparkSession, d: str) -> DataFrame:
    """M2, A3, O1: lines of passages on the documents of the book that has their best page."""
    passages, pages = corpus(spark, d)
    return matching.line_anchors(written(matching.best_page(matching.score_pages(passages, pages))), passages, pages).withColumnRenamed("page_id", "doc_id").select("item_id", "doc_id", "line_index", "kind")


@query(f"""WITH {_ANCHORS}, a AS (SELECT item_id, doc_id, count(*) AS n, count(*) FILTER (WHERE kind = 'exact') AS x, bool_or(kind = 'exact' AND k = 0) AS x0, list(k) FILTER (WHERE kind = 'exact') AS xs FROM m GROUP BY 1, 2)
SELECT a.item_id, a.doc_id, a.n::BIGINT AS matches, x::BIGINT AS exact, (i.title <> '' AND {_HEAD}) OR x >= 2 OR x0 OR coalesce(list_contains(xs, len(i.lines) - 1), false) OR (x >= 1 AND a.n - x >= 2) OR a.n - x >= 4 AS is_anchor FROM a JOIN i USING (item_id) JOIN d USING (doc_id)""")
def anchor_flag(spark: SparkSession, d: str) -> DataFrame:
    """M3."""
    passages, pages = corpus(spark, d)
    matches = matching.line_anchors(written(matching.best_page(matching.score_pages(passages, pages))), passages, pages)
    return matching.anchor_pages(matches, passages, pages).select("item_id", F.col("page_id").alias("doc_id"), "matches", "exact", "is_anchor")


@query()
def span_proposal(spark: SparkSession, d: str) -> DataFrame:
    """M4, M5, W15, C9, O1: the proposed span of each passage; the span is held against a model in the tests."""
    passages, pages = corpus(spark, d)
    t = matching.propose(passages, pages, keep=written)
    return t.select("item_id", "book_id", "start_scan", "end_scan", "printed_page_start", "printed_page_end", "score", F.array_join("evidence", ",").alias("evidence"), "basis", "anchor_count", "line_matches", "exact_matches", "gap", "status")


@query(f"""WITH {_PASSAGES}, b AS (SELECT pr.item_id, pr.doc_id, overlap, row_number() OVER (PARTITION BY pr.item_id ORDER BY overlap DESC, pr.doc_id) AS rn FROM pr WHERE overlap >= 4) SELECT item_id, doc_id, overlap::BIGINT AS common FROM b WHERE rn <= 3""")
def overlap_topk(spark: SparkSession, d: str) -> DataFrame:
    """J9, O11: the three documents that share the most tokens with a passage."""
    side = lambda name, key, to: table(spark, d, name).select(F.col(key).alias(to), X.normalize(F.col("text")).alias("plain"), F.lit("").alias("signed"))  # noqa: E731
    met = page_pool.page_pool(side("benchmark", "item_id", "item_id"), side("documents", "doc_id", "page_id"), page_pool.token_features(), 3, least_sum=4.0)
    return met.select("item_id", F.col("page_id").alias("doc_id"), F.col("exact").alias("common"))


_GRAMS = "SELECT {id} AS id, list_distinct(list_transform(range(1, length(c) - 3), lambda i: substr(c, i, 5))) AS g FROM (SELECT {id}, replace({norm}, ' ', '') AS c FROM {table})"


def _gram_vectors(name: str, key: str) -> str:
    inner = _GRAMS.format(id=key, norm=norm("text"), table=name)
    return f"SELECT id, unnest(g) AS f, 1.0 AS w FROM ({inner})"


@query(f"""WITH a AS ({_gram_vectors('benchmark', 'item_id')}), b AS ({_gram_vectors('benchmark', 'item_id')}), n AS (SELECT id, sqrt(sum(w * w)) AS n FROM a GROUP BY id), p AS (SELECT a.id AS x, b.id AS y, sum(a.w * b.w) AS dot FROM a JOIN b USING (f) WHERE a.id <> b.id GROUP BY 1, 2)
SELECT x AS item_id, y AS other_id, round((dot / (u.n * v.n))::DOUBLE, 6) AS cosine FROM p JOIN n u ON u.id = x JOIN n v ON v.id = y WHERE dot / (u.n * v.n) >= 0.03""")
def sparse_cosine(spark: SparkSession, d: str) -> DataFrame:
    """J11, T48 without hashing: cosine of passages' 5-gram sets."""
    t = table(spark, d, "benchmark").select("item_id", F.explode(X.char_ngram_set(X.compact(F.col("text")), 5)).alias("feature"), F.lit(1.0).alias("weight"))
    out = joins.cosine_join(t.withColumnRenamed("item_id", "a_id"), t.withColumnRenamed("item_id", "b_id"), 0.03)
    return out.where("a_id <> b_id").select(F.col("a_id").alias("item_id"), F.col("b_id").alias("other_id"), F.round("cosine", 6).alias("cosine"))


def passage_lines(spark: SparkSession, d: str) -> DataFrame:
    """item_id, line_index, text: stretches of twelve words of each passage, as lines."""
    w = X.words(X.normalize(F.col("text")))
    cut = X.let(w, lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / 12)), lambda i: F.struct(i.cast("int").alias("line_index"), F.array_join(F.slice(x, (i * 12 + 1).cast("int"), 12), " ").alias("text"))))
    return table(spark, d, "benchmark").select("item_id", F.explode(cut).alias("l")).select("item_id", "l.*")


def _audit_pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Documents cut into pages (written), and their places: page_id, book_id, scan_page, printed_page."""
    texts = written(matching.leaves(table(spark, d, "documents")))
    places = matching.leaf_numbers(texts)
    return texts, places.withColumn("printed_page", F.when(F.col("scan_page") % 9 != 0, F.col("scan_page")))


@query()
def sparse_cosine_hashed(spark: SparkSession, d: str) -> DataFrame:
    """M8, T46, T47: hashed, weighted gram vectors of passage lines against one another's passages."""
    lines = passage_lines(spark, d)
    regions = lines.select(F.col("item_id").alias("page_id"), F.col("line_index").alias("window"), "text")
    out = matching.vector_prefilter(lines, regions).where("a_id.item_id <> b_id.page_id")
    return out.select("a_id.item_id", "a_id.line_index", F.col("b_id.page_id").alias("other_id"), F.col("b_id.window").alias("other_line"), F.round("cosine", 6).alias("cosine"))


def _reviewed(best: DataFrame, status: Column) -> DataFrame:
    return best.select("item_id", "book_id", F.col("start").alias("start_scan"), F.col("end").alias("end_scan"), "line_matches", "exact_lines", "longest_line_run", "ordered_run", F.round("total_score", 4).alias("total_score"), status.alias("status"))


def _texts(t: DataFrame, key: str, name: str, plain: Column) -> DataFrame:
    """A side of the page pool: its id, a text and the text's class signature."""
    return t.select(F.col(key).alias(name), plain.alias("plain")).withColumn("signed", X.class_signature(F.col("plain"), LATIN_CLASSES))


def _gram_texts(t: DataFrame, key: str, name: str, normal: bool = False) -> DataFrame:
    return _texts(t, key, name, F.translate("text", " \n", "") if normal else X.compact(F.col("text")))


def _token_texts(t: DataFrame, key: str, name: str, normal: bool = False) -> DataFrame:
    return _texts(t, key, name, F.translate("text", "\n", " ") if normal else X.normalize(F.col("text")))


def _pool(spark: SparkSession, d: str, pages: DataFrame, texts, features, top: int, **least: float) -> DataFrame:
    """The exact page pool of all passages, written, as several steps read it."""
    return written(page_pool.page_pool(texts(table(spark, d, "benchmark"), "item_id", "item_id"), texts(pages, pages.columns[0], "page_id", pages.columns[0] == "page_id"), features, top, **least))


#: Sizes of n-grams and pages of the fuzzy pool (twice the pages that vectors leave), and pages of the ordered one.
POOL_GRAMS, FUZZY_PAGES, ORDERED_PAGES = 5, 16, 36


def fuzzy_pool(spark: SparkSession, d: str, pages: DataFrame) -> DataFrame:
    return _pool(spark, d, pages, _gram_texts, page_pool.gram_features(POOL_GRAMS), FUZZY_PAGES, least_sum=3.0 * POOL_GRAMS)


def ordered_pool(spark: SparkSession, d: str, pages: DataFrame) -> DataFrame:
    return _pool(spark, d, pages, _token_texts, page_pool.token_features(), ORDERED_PAGES, least_share=0.02)


_LETTERS = "".join(LATIN_CLASSES)
_SIGNS = "".join(chr(0xE000 + i) for i, g in enumerate(LATIN_CLASSES) for _ in g)


def _pool_sql(features: str, top: int, able: str) -> str:
    """All pairs' common features and classes; ``features`` is a list over a text t."""
    part = lambda name, key: f"SELECT {key} AS id, {features.format(t='n')} AS e, {features.format(t=f"translate(n, '{_LETTERS}', '{_SIGNS}')")} AS c FROM (SELECT {key}, {norm('text')} AS n FROM {name})"  # noqa: E731
    return f"""WITH a AS MATERIALIZED ({part('benchmark', 'item_id')}), b AS MATERIALIZED ({part('documents', 'doc_id')}), ae AS (SELECT id, len(e) AS n, unnest(e) AS f FROM a), be AS (SELECT id, unnest(e) AS f FROM b), ac AS (SELECT id, unnest(c) AS f FROM a), bc AS (SELECT id, unnest(c) AS f FROM b),
e AS (SELECT ae.id AS item_id, be.id AS doc_id, count(*) AS e FROM ae JOIN be USING (f) GROUP BY 1, 2), c AS (SELECT ac.id AS item_id, bc.id AS doc_id, count(*) AS c FROM ac JOIN bc USING (f) GROUP BY 1, 2), n AS (SELECT id AS item_id, len(e) AS n FROM a),
p AS (SELECT item_id, doc_id, n, coalesce(e, 0) AS e, c, coalesce(e, 0) + 0.5 * greatest(0, c - coalesce(e, 0)) AS score FROM c LEFT JOIN e USING (item_id, doc_id) JOIN n USING (item_id))
SELECT item_id, doc_id, score::DOUBLE AS score, e::BIGINT AS exact, c::BIGINT AS by_class FROM p WHERE {able} QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, e DESC, doc_id) <= {top}"""


#: All 5-grams of a text without spaces: those at each of five offsets are neighbours that don't overlap.
_FIVE = "list_distinct(flatten([{parts}]))".replace("{parts}", ", ".join(f"regexp_extract_all(substr(replace({{t}}, ' ', ''), {k + 1}), '.{{{{5}}}}')" for k in range(POOL_GRAMS)))


@query(_pool_sql(_FIVE, FUZZY_PAGES, f"e + c >= {3 * POOL_GRAMS}"))
def fuzzy_pages(spark: SparkSession, d: str) -> DataFrame:
    """J9 and the first step of M10: of all documents those that share most 5-grams with a passage, class ones by half."""
    return fuzzy_pool(spark, d, table(spark, d, "documents").select("doc_id", "text")).withColumnRenamed("page_id", "doc_id")


@query(_pool_sql("list_distinct(list_filter(string_split({t}, ' '), lambda x: length(x) >= 3))", ORDERED_PAGES, "score >= 0.02 * n"))
def ordered_pages(spark: SparkSession, d: str) -> DataFrame:
    """J9 and the first step of M12: of all documents those that share most words with a passage."""
    return ordered_pool(spark, d, table(spark, d, "documents").select("doc_id", "text")).withColumnRenamed("page_id", "doc_id")


def _chosen(pages: DataFrame, pool: DataFrame) -> DataFrame:
    return pages.join(pool.select("page_id").distinct(), "page_id", "left_semi")


def _vector_pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Places of pages, lines, regions of the pool's pages (written), and the pages that vectors leave (M8)."""
    texts, places = _audit_pages(spark, d)
    pool = fuzzy_pool(spark, d, texts.select("page_id", "text"))
    lines = regions.gathered_lines(passage_lines(spark, d))
    made = written(matching.page_regions(_chosen(texts, pool)))
    return places, lines, made, regions.vector_pages(pool, lines, made)


@query()
def vector_pages(spark: SparkSession, d: str) -> DataFrame:
    """M8, T46-T48, T65, W14: of each passage's pool the eight pages whose regions' vectors are nearest to its representative lines."""
    found = _vector_pages(spark, d)[3]
    return found.select("item_id", "page_id", "ordered_run", "line_run", "line_hits", F.round("vector_score", 6).alias("vector_score"))


@query()
def fuzzy_audit(spark: SparkSession, d: str) -> DataFrame:
    """M7-M10, J9, J10, A12, W11, W12, W14, C10, O3: fuzzy lines of passages on the pages that share most grams and are nearest by vectors."""
    places, lines, made, chosen = _vector_pages(spark, d)
    matches = written(regions.fuzzy_matches(chosen, lines, made))
    found = matching.audit_candidates(matches, places, 2)
    best = matching.best_candidates(found.withColumn("score", F.col("total_score")), reports.fuzzy_candidate_order())
    paged = F.col("printed_page_start").isNotNull() & F.col("printed_page_end").isNotNull()
    return _reviewed(best, matching.fuzzy_status(paged, F.col("longest_line_run"), F.col("ordered_run"), F.col("exact_lines"), F.col("line_matches"), F.col("span_pages"), F.col("item_id") % 4 == 0))


@query()
def ordered_audit(spark: SparkSession, d: str) -> DataFrame:
    """M11, M12, J9, J10, W14, C11, O4: ordered tokens of passages' lines on the pages that share most words."""
    texts, places = _audit_pages(spark, d)
    pool = ordered_pool(spark, d, texts.select("page_id", "text"))
    lines = regions.gathered_lines(passage_lines(spark, d).where(F.size(X.token_list(F.col("text"))) >= 3))
    made = written(matching.page_regions(_chosen(texts, pool), 4, 700, 3))
    matches = written(regions.ordered_matches(pool, lines, made))
    found = matching.audit_candidates(matches, places, 3, strict=False)
    best = matching.best_candidates(found.withColumn("score", F.col("total_score")), reports.ordered_candidate_order())
    paged = F.col("printed_page_start").isNotNull() & F.col("printed_page_end").isNotNull()
    return _reviewed(best, matching.ordered_status(paged, F.col("ordered_run"), F.col("exact_lines"), F.col("line_matches"), F.col("span_pages"), F.col("item_id") % 4 == 0))


_CITE = "SELECT item_id AS citation_id, 'src' || (item_id % 20)::VARCHAR AS book, (item_id % 30 + 1)::INTEGER AS s, (item_id % 30 + 3)::INTEGER AS e, text FROM benchmark"


@query(f"""WITH c AS ({_CITE}), p AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS scan, text FROM documents), r AS (SELECT book_id, min(scan) AS lo, max(scan) AS hi, count(*)::BIGINT AS n FROM p GROUP BY 1),
j AS (SELECT citation_id, count(*)::BIGINT AS rows, string_agg(p.text, chr(10) ORDER BY scan) AS t FROM c JOIN p ON p.book_id = c.book AND p.scan BETWEEN c.s AND c.e GROUP BY 1), k AS (SELECT c.*, coalesce(j.rows, 0) AS rows, {norm("coalesce(j.t, '')")} AS pt, {norm('c.text')} AS ct FROM c LEFT JOIN j USING (citation_id)),
x AS (SELECT citation_id, list_distinct(list_filter({words('ct')}, lambda x: length(x) >= 3)) AS a, list_distinct(list_filter({words('pt')}, lambda x: length(x) >= 3)) AS b, len(list_filter(list_transform(string_split(k.text, chr(10)), lambda x: {norm('x')}), lambda x: length(replace(x, ' ', '')) >= 18 AND contains(pt, x)))::INTEGER AS lines FROM k)
SELECT k.citation_id, k.rows AS canonical_rows, coalesce(r.n, 0) AS book_rows, coalesce(k.e < r.lo OR k.s > r.hi, false) AS outside_range, x.lines AS line_matches, round(len(list_intersect(a, b)) / greatest(1, len(a)), 4) AS body_coverage FROM k JOIN x USING (citation_id) LEFT JOIN r ON r.book_id = k.book""")
def citation_evidence(spark: SparkSession, d: str) -> DataFrame:
    """M19, J12, J14, A4, A5: what the cited pages hold of each passage."""
    return _citations(spark, d).select("citation_id", "canonical_rows", "book_rows", "outside_range", "line_matches", "body_coverage")


def _citations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("item_id")
    c = table(spark, d, "benchmark").select(k.alias("citation_id"), F.concat(F.lit("src"), (k % 20).cast("string")).alias("book"), (k % 30 + 1).cast("int").alias("page_start"), (k % 30 + 3).cast("int").alias("page_end"), F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("title"), F.col("text").alias("body"))
    p = P.document_pages(table(spark, d, "documents")).withColumns({"canonical_book": F.col("book_id"), "printed_page": F.col("scan_page")})
    return audits.citation_evidence(c, p)


@query(f"""WITH c AS ({_CITE}), p AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS scan, text FROM documents), r AS (SELECT book_id, min(scan) AS lo, max(scan) AS hi, count(*) AS n FROM p GROUP BY 1),
j AS (SELECT citation_id, count(*) AS rows, string_agg(p.text, chr(10) ORDER BY scan) AS t FROM c JOIN p ON p.book_id = c.book AND p.scan BETWEEN c.s AND c.e GROUP BY 1),
k AS (SELECT c.*, coalesce(j.rows, 0) AS rows, {norm("coalesce(j.t, '')")} AS pt, {norm("array_to_string(string_split(c.text, ' ')[1:3], ' ')")} AS title, {norm('c.text')} AS ct, list_filter(list_transform(string_split(c.text, chr(10)), lambda x: {norm('x')}), lambda x: length(replace(x, ' ', '')) >= 18) AS lines, r.n, r.lo, r.hi FROM c LEFT JOIN j USING (citation_id) LEFT JOIN r ON r.book_id = c.book),
x AS (SELECT *, citation_id % 4 = 0 AS conflict, title <> '' AND contains(pt, title) AS has_title, coalesce(contains(pt, lines[1]), false) AS first, len(list_filter(lines, lambda x: contains(pt, x))) AS hits, round(len(list_intersect(list_distinct(list_filter({words('ct')}, lambda x: length(x) >= 3)), list_distinct(list_filter({words('pt')}, lambda x: length(x) >= 3)))) / greatest(1, len(list_distinct(list_filter({words('ct')}, lambda x: length(x) >= 3)))), 4) AS coverage FROM k)
SELECT citation_id, CASE WHEN rows = 0 AND n IS NULL THEN 'missing_book_corpus' WHEN rows = 0 AND (e < lo OR s > hi) THEN 'outside_corpus_range' WHEN rows = 0 THEN 'missing_page_rows' WHEN conflict AND NOT (has_title OR hits >= 2 OR coverage >= 0.45) THEN 'candidate_conflict' WHEN has_title OR first OR hits >= 2 THEN 'supported' WHEN coverage >= 0.45 THEN 'supported_token_only' ELSE 'weak_current_citation' END AS status FROM x""")
def citation_status(spark: SparkSession, d: str) -> DataFrame:
    """M20, C13."""
    return _citations(spark, d).select("citation_id", audits.citation_status(F.col("citation_id") % 4 == 0).alias("status"))


_TAGS = ", ".join(f"CASE WHEN regexp_matches(lower(raw), '{p}') THEN '{n}' END" for n, p in (("month", X.LATIN_MONTHS), ("digit", "[০-৯0-9]"), ("year", X.LATIN_YEAR), ("place", X.LATIN_PLACES)))


@query(rf"""WITH b AS (SELECT item_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {norm('x')}), lambda x: length(replace(x, ' ', '')) >= 14) AS body FROM benchmark), s AS (SELECT doc_id, doc_id % (SELECT count(*) FROM benchmark) AS item_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
l AS (SELECT item_id, doc_id, raw, i FROM (SELECT item_id, doc_id, unnest(s) AS raw, generate_subscripts(s, 1) - 1 AS i, len(s) AS n FROM s) WHERE NOT (i = n - 1 AND raw = '')), p AS (SELECT l.*, {norm('raw')} AS plain, body FROM l JOIN b USING (item_id)),
h AS (SELECT *, plain <> '' AND len(list_filter(body, lambda x: contains(plain, x) OR (length(plain) >= 14 AND contains(x, plain)))) > 0 AS hit FROM p),
n AS (SELECT *, max(CASE WHEN hit THEN i END) OVER (PARTITION BY item_id, doc_id) AS last, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY i DESC) AS rn FROM h),
t AS (SELECT *, list_filter([{_TAGS}], lambda x: x IS NOT NULL) AS tags FROM n WHERE (i > last AND i <= last + 5) OR rn <= 5),
f AS (SELECT * FROM t WHERE length(regexp_replace(raw, '[ 	

]+', '', 'g')) BETWEEN 4 AND 48 AND ((list_contains(tags, 'month') AND list_contains(tags, 'digit')) OR (list_contains(tags, 'year') AND list_contains(tags, 'place')))),
a AS (SELECT item_id, count(*) AS n, count(*) FILTER (WHERE len(tags) >= 3) AS strong, arg_min(raw, (doc_id, i)) AS first FROM f GROUP BY 1)
SELECT item_id, coalesce(n, 0)::BIGINT AS date_lines, first AS first_date, CASE WHEN coalesce(n, 0) = 0 THEN 'no_date_evidence' WHEN strong > 0 THEN 'strong_date_review' ELSE 'date_review' END AS status FROM (SELECT DISTINCT item_id FROM s JOIN b USING (item_id)) LEFT JOIN a USING (item_id)""")
def date_audit(spark: SparkSession, d: str) -> DataFrame:
    """M22, J13, W20: passages against the lines of the documents that cite them, each document the passage of its number among all."""
    passages, docs = table(spark, d, "benchmark"), table(spark, d, "documents")
    cited = docs.select((F.col("doc_id") % passages.count()).alias("item_id"), F.col("doc_id").alias("page_id"))
    items = cited.join(passages.select("item_id", F.col("text").alias("body")), "item_id")
    lines = docs.select(F.col("doc_id").alias("page_id"), F.posexplode(X.lines(F.col("text"))).alias("line_no", "text"))
    return audits.date_audit(items, lines)


def _odd(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    key = F.translate("token", "éèêäá0", "eeeaao")
    known = lexicon.lexicon(document_tokens(spark, d), key, F.regexp_replace(key, "[aeiouy]", "")).where("length(token) >= 4")
    frequent = written(known.where("count >= 3"))  # several steps read it: the documents are counted once
    t = table(spark, d, "benchmark").select(F.explode(X.token_set(X.normalize(F.col("text")), 4)).alias("token"))
    odd = t.groupBy("token").agg(F.count("*").alias("count")).join(frequent.select("token"), "token", "left_anti")
    return written(odd.withColumns({"key": key, "loose": F.regexp_replace(key, "[aeiouy]", "")})), frequent


@query()
def gestalt_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """M15: known tokens for the rare tokens of the passages."""
    odd, known = _odd(spark, d)
    return lexicon.suggestions(odd, known)


@query()
def substitution_pick(spark: SparkSession, d: str) -> DataFrame:
    """M16: sure replacements, with thresholds that suit the table's size."""
    odd, known = _odd(spark, d)
    return lexicon.substitutions(odd, lexicon.suggestions(odd, known), 1, 0.9, 3)


_SUGGESTED = "SELECT o_custkey AS c, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank, CASE o_custkey % 4 WHEN 0 THEN 0.9 ELSE 0.95 END AS score, o_orderkey % 41 AS n FROM orders"


@query(f"""WITH s AS (SELECT *, lead(score) OVER w AS s2, lead(n) OVER w AS n2 FROM ({_SUGGESTED}) WINDOW w AS (PARTITION BY c ORDER BY rank)) SELECT 't' || c AS odd_token, 'k' || o_orderkey AS replacement, c % 17 AS odd_count, n AS known_count FROM s
WHERE rank = 1 AND score >= 0.94 AND n >= 20 AND c % 17 >= 8 AND (s2 IS NULL OR s2 <> score OR n >= floor(n2 * 2.0))""")
def substitution_rules(spark: SparkSession, d: str) -> DataFrame:
    """M16 over made-up suggestions: sure ones for frequent tokens, twice as frequent as the next of the same score."""
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    made = table(spark, d, "orders").select(F.concat(F.lit("t"), c.cast("string")).alias("odd_token"), F.concat(F.lit("k"), k.cast("string")).alias("token"), F.when(c % 4 == 0, 0.9).otherwise(0.95).alias("score"), (k % 41).alias("count"), F.lit("key").alias("basis"), F.row_number().over(w).alias("rank"))
    odd = table(spark, d, "orders").select(F.concat(F.lit("t"), c.cast("string")).alias("token"), (c % 17).alias("count")).distinct()
    return lexicon.substitutions(odd, made).select("odd_token", "replacement", "odd_count", "known_count")


@query()
def levenshtein_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """Extension of M15: the nearest known token within two edits of code points (DuckDB counts bytes, so it has no SQL)."""
    odd, known = _odd(spark, d)
    a = odd.select(F.col("token").alias("odd_token")).withColumn("len", F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda x: F.length("odd_token") + x)))
    p = a.join(known.select("token", "count"), (F.substring("odd_token", 1, 1) == F.substring("token", 1, 1)) & (F.col("len") == F.length("token"))).withColumn("distance", F.levenshtein("odd_token", "token")).where("distance <= 2")
    w = Window.partitionBy("odd_token").orderBy("distance", F.col("count").desc(), "token")
    return p.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("odd_token", "token", "distance")


#: Lines of a contents page, and where documents' scans begin behind the contents pages of their book.
CONTENTS_LINES, BODY_SCANS = 9, 1000


def _contents_pages(spark: SparkSession, d: str) -> DataFrame:
    """Books with front matter that lists the passages, as a scanner might have read it, and documents as their numbered pages.

    A fifth of the entries each: the title as it is, with a wrong letter, without its last word, a line of the text, and a title that repeats a word.
    """
    k, t = F.col("item_id"), F.col("title")
    line = F.array_join(F.slice(F.split("text", " "), 13, 12), " ")
    read = F.element_at(F.array(t, F.concat(F.substring(t, 1, 4), F.lit("x"), F.substring(t, F.lit(6), F.length(t))), F.regexp_replace(t, " [^ ]+$", ""), line, F.concat(t, F.lit(" "), F.substring_index(t, " ", 1))), (k % 5 + 1).cast("int"))
    listed = _titled(spark, d).withColumns({"book_id": F.concat(F.lit("src"), (k % 20).cast("string")), "line": F.concat(read, F.lit(" ... "), (k % 400 + 1).cast("string"))})
    place = F.row_number().over(Window.partitionBy("book_id").orderBy("item_id")) - 1
    paged = listed.withColumn("leaf", F.floor(place / CONTENTS_LINES)).groupBy("book_id", "leaf").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    own = lambda **c: [v.alias(n) for n, v in c.items()]  # noqa: E731
    front = paged.select(F.col("book_id").alias("physical_book"), "book_id", *own(scan_page=(F.col("leaf") + 1).cast("int"), page_type=F.lit("front_matter"), printed_page=F.lit(None).cast("int"), basis=F.lit("missing"), confidence=F.lit(0.0), text=F.when(F.col("leaf") == 0, F.concat(F.lit("contents\n"), "lines")).otherwise(F.col("lines"))))
    n = F.col("scan_page")
    body = P.document_pages(table(spark, d, "documents").select("doc_id", "source", F.lit("").alias("text"))).select(F.col("book_id").alias("physical_book"), "book_id", *own(scan_page=n + BODY_SCANS, page_type=F.lit("normal_poem_page"), printed_page=F.when(n % 7 != 0, n), basis=F.lit("offset"), confidence=F.lit(0.9)), "text")
    return front.unionByName(body)


def _titled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", "text", F.array_join(F.slice(F.split("text", " "), 1, 6), " ").alias("title"))


@query()
def toc_audit(spark: SparkSession, d: str) -> DataFrame:
    """M13, M14, C12, C24, W18, T20, T39, T42, J21, J22, J29: passages against the entries of detected contents pages, at the review's least score."""
    entries = written(contents.contents_entries(_contents_pages(spark, d), "contents", r"\p{L}"))
    k = F.col("item_id")
    items = _titled(spark, d)
    body = passage_lines(spark, d).groupBy("item_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_index", "text"))), lambda x: x["text"]), "\n").alias("body"))
    surfaces = written(matching.surfaces(items.join(body, "item_id"), "title", "body"))
    edition = F.when(k % 3 == 0, "unknown").when(k % 3 == 1, F.concat(F.lit("E"), (k % 20).cast("string"))).otherwise(F.concat(F.lit("E"), ((k + 1) % 20).cast("string")))
    titles = entries.select(F.col("candidate_book").alias("book_id")).distinct().withColumn("canonical", F.regexp_replace("book_id", "^src", "E"))
    out = contents.contents_audit(items.select("item_id", edition.alias("edition"), X.normalize(F.col("title")).alias("title")), surfaces, entries, titles, "unknown")
    return out.select("item_id", "toc_book", "toc_scan", "page", "candidate_scan", "basis", "entry_title", "score", F.round("runner_up_gap", 4).alias("runner_up_gap"), "status")


_ISSUES = ORACLES["line_issues"].replace("SELECT unnest(string_split(text, chr(10))) AS raw FROM documents", "SELECT doc_id, unnest(string_split(text, chr(10))) AS raw FROM documents").replace("SELECT trim(raw) AS s FROM l", "SELECT doc_id, trim(raw) AS s FROM l").replace("k AS (SELECT unnest(", "k AS (SELECT doc_id, unnest(").replace("SELECT kind, count(*)::BIGINT AS n FROM k GROUP BY kind", "SELECT doc_id, count(*)::BIGINT AS issues FROM k GROUP BY doc_id")


@query(f"SELECT d.doc_id, coalesce(i.issues, 0) AS issues, coalesce(u.unknown, 0) AS unknown, u.unknown_ratio FROM documents d LEFT JOIN ({_ISSUES}) i USING (doc_id) LEFT JOIN ({ORACLES['unknown_token_ratio']}) u USING (doc_id)")
def text_quality(spark: SparkSession, d: str) -> DataFrame:
    """M17, M18: line issues and unknown tokens of each document."""
    issues = lexicon.quality_issues(table(spark, d, "documents"), "doc_id", "text").groupBy("doc_id").agg(F.sum("n").alias("issues"))
    t = document_tokens(spark, d)
    odd = lexicon.unknown_tokens(t, t.groupBy("token").count().where("count >= 5"), "doc_id").select("doc_id", "unknown", "unknown_ratio")
    return table(spark, d, "documents").select("doc_id").join(issues, "doc_id", "left").join(odd, "doc_id", "left").select("doc_id", F.coalesce("issues", F.lit(0)).alias("issues"), F.coalesce("unknown", F.lit(0)).alias("unknown"), "unknown_ratio")


_SIX = "SELECT item_id, unnest(list_distinct(list_transform(range(1, length(c) - 4), lambda i: substr(c, i, 6)))) AS g FROM ({})"
_COMPACT = f"SELECT item_id, replace({norm('text')}, ' ', '') AS c FROM benchmark"
_CLASSED = f"SELECT item_id, translate(c, '{_LETTERS}', '{_SIGNS}') AS c FROM ({_COMPACT})"


@query(f"""WITH e AS ({_SIX.format(_COMPACT)}), k AS ({_SIX.format(_CLASSED)}), p AS (SELECT a.item_id AS a_id, b.item_id AS b_id, 1.0 AS w FROM e a JOIN e b USING (g) WHERE a.item_id < b.item_id UNION ALL SELECT a.item_id, b.item_id, 0.5 FROM k a JOIN k b USING (g) WHERE a.item_id < b.item_id)
SELECT a_id, b_id, sum(w)::DOUBLE AS score FROM p GROUP BY 1, 2 HAVING sum(w) >= 3""")
def class_overlap(spark: SparkSession, d: str) -> DataFrame:
    """J10: passages whose grams agree exactly (weight 1) and by class (0.5)."""
    t = table(spark, d, "benchmark").select("item_id", X.compact(F.col("text")).alias("c"))
    exact = t.select("item_id", F.explode(X.char_ngram_set(F.col("c"), 6)).alias("gram"))
    by_class = t.select("item_id", F.explode(X.char_ngram_set(X.class_signature(F.col("c"), LATIN_CLASSES), 6)).alias("gram"))
    sides = lambda x: (x.withColumnRenamed("item_id", "a_id"), x.withColumnRenamed("item_id", "b_id"))  # noqa: E731
    return joins.weighted_overlap([(*sides(exact), 1.0), (*sides(by_class), 0.5)], 3.0).where("a_id < b_id")
