"""Queries of joins, aggregates, sets, sorts and views (J*, A*, O*, U*, S*, V*) over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import audits, joins, lexicon, pages, reports, sequence, views
from ..sources import readers
from .base import folder, norm, query, table, words

_TOKENS = f"SELECT doc_id, source, unnest(list_filter({words(norm('text'))}, lambda x: length(x) >= 3)) AS token FROM documents"


def document_tokens(spark: SparkSession, d: str) -> DataFrame:
    w = F.filter(X.words(X.normalize(F.col("text"))), lambda x: F.length(x) >= 3)
    return table(spark, d, "documents").select("doc_id", "source", F.posexplode(w).alias("pos", "token"))


@query("SELECT s.s_suppkey, n.n_name, r.r_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey")
def dimension_chain(spark: SparkSession, d: str) -> DataFrame:
    """Record to dimension to dimension; a missing one is an error."""
    s = table(spark, d, "supplier").withColumn("n_nationkey", F.col("s_nationkey"))
    n = joins.checked_join(s, table(spark, d, "nation"), "n_nationkey", "nation").withColumn("r_regionkey", F.col("n_regionkey"))
    return joins.checked_join(n, table(spark, d, "region"), "r_regionkey", "region").select("s_suppkey", "n_name", "r_name")


@query("SELECT r.r_name, coalesce(list_sort(list(n.n_name) FILTER (WHERE n.n_name IS NOT NULL)), []) AS nations FROM region r LEFT JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name")
def phase_lists(spark: SparkSession, d: str) -> DataFrame:
    """J3."""
    out = views.collected(table(spark, d, "region"), table(spark, d, "nation"), "r_regionkey", "n_regionkey", "n_name", "nations")
    return out.select("r_name", "nations")


_TAGS = "SELECT doc_id, list_filter([lang, CASE WHEN contains(text, ' | ') THEN 'table' END, CASE WHEN contains(text, '***') THEN 'symbols' END], lambda x: x IS NOT NULL) AS tags FROM documents"
_DIM = "(VALUES ('en', 'English'), ('fr', 'French'), ('de', 'German'), ('table', 'Tables'), ('symbols', 'Symbols'), ('empty', 'Nothing')) AS t(id, label)"


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    t = F.array_compact(F.array("lang", F.when(F.contains("text", F.lit(" | ")), "table"), F.when(F.contains("text", F.lit("***")), "symbols")))
    return table(spark, d, "documents").select("doc_id", t.alias("tags"))


def _tag_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("en", "English"), ("fr", "French"), ("de", "German"), ("table", "Tables"), ("symbols", "Symbols"), ("empty", "Nothing")], "id string, label string")


@query(f"WITH g AS ({_TAGS}), e AS (SELECT doc_id, unnest(tags) AS tag FROM g) SELECT e.doc_id, t.label FROM e JOIN {_DIM} ON e.tag = t.id")
def tag_membership(spark: SparkSession, d: str) -> DataFrame:
    """J4."""
    return joins.membership(_tagged(spark, d), "tags", F.broadcast(_tag_dim(spark)), "id").select("doc_id", "label")


@query(f"WITH g AS ({_TAGS}), e AS (SELECT doc_id, unnest(tags) AS tag FROM g) SELECT t.label, count(e.doc_id)::BIGINT AS n FROM {_DIM} LEFT JOIN e ON e.tag = t.id GROUP BY t.label")
def zero_count_groups(spark: SparkSession, d: str) -> DataFrame:
    """Tags without documents count zero."""
    rows = _tagged(spark, d).select("doc_id", F.explode("tags").alias("tag"))
    return views.counts_with_zero(_tag_dim(spark), rows, "id", "tag").select("label", "n")


@query("SELECT item_id, row_number() OVER (ORDER BY CASE WHEN item_id % 3 = 0 THEN NULL ELSE item_id % 7 END ASC NULLS LAST, text)::INTEGER AS place FROM benchmark")
def nulls_last_sort(spark: SparkSession, d: str) -> DataFrame:
    """By an order number, missing ones last, then by text."""
    order = [F.when(F.col("item_id") % 3 != 0, F.col("item_id") % 7).asc_nulls_last(), "text"]
    return sequence.numbered(table(spark, d, "benchmark"), order, "place", folder(spark)).select("item_id", F.col("place").cast("int").alias("place"))


_RULES = "(VALUES (1, 'src1', 5, 12, 'copy-a'), (2, 'src1', 10, 20, 'copy-b'), (3, 'src3', 1, 8, 'appendix'), (4, 'src0', 30, 45, 'part-two')) AS r(o, k, s, e, b)"


@query(f"""WITH p AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS scan FROM documents), h AS (SELECT p.*, r.b, row_number() OVER (PARTITION BY p.doc_id ORDER BY r.o) AS rn FROM p LEFT JOIN {_RULES} ON p.source = r.k AND p.scan BETWEEN r.s AND r.e)
SELECT doc_id, scan::INTEGER AS scan_page, coalesce(b, source) AS book_id FROM h WHERE rn = 1""")
def range_section_join(spark: SparkSession, d: str) -> DataFrame:
    """J5."""
    p = pages.document_pages(table(spark, d, "documents")).withColumnRenamed("book_id", "physical_book_id")
    rules = spark.createDataFrame([(1, "src1", 5, 12, "copy-a"), (2, "src1", 10, 20, "copy-b"), (3, "src3", 1, 8, "appendix"), (4, "src0", 30, 45, "part-two")], "rule_order int, physical_book_id string, start_scan int, end_scan int, book_id string")
    return pages.logical_sections(p, rules).select("doc_id", "scan_page", "book_id")


@query("""SELECT doc_id, CASE source WHEN 'src1' THEN 'src0' WHEN 'src3' THEN 'src2' ELSE source END AS canonical, coalesce(a.v, b.v) AS value FROM documents
LEFT JOIN (VALUES ('src5', 'first'), ('src7', 'second')) AS a(k, v) ON source = a.k LEFT JOIN (VALUES ('en', 'English'), ('fr', 'French')) AS b(k, v) ON lang = b.k""")
def alias_and_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A canonical id, and a value under the first of two keys that has one."""
    rows = table(spark, d, "documents").select("doc_id", "source", "lang")
    dim = spark.createDataFrame([("src5", "first"), ("src7", "second"), ("en", "English"), ("fr", "French")], "k string, value string")
    out = joins.fallback_lookup(rows, F.broadcast(dim), [["source"], ["lang"]], ["k"], "value")
    return out.select("doc_id", joins.canonical(F.col("source"), {"src1": "src0", "src3": "src2"}).alias("canonical"), "value")


@query("SELECT o.o_orderkey, x.p::BIGINT AS line FROM orders o, LATERAL (SELECT unnest(range(1, (o.o_orderkey % 4)::BIGINT + 1)) AS p) x")
def range_to_keys(spark: SparkSession, d: str) -> DataFrame:
    """Ranges as equi keys; an empty range has none."""
    rows = table(spark, d, "orders").select("o_orderkey", F.lit(1).cast("long").alias("s"), (F.col("o_orderkey") % 4).alias("e"))
    return joins.expand_range(rows, "s", "e", "line").select("o_orderkey", "line")


_CAND = "SELECT doc_id, 'f' || (doc_id % 50)::VARCHAR AS filename, source AS candidate_book_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE (doc_id % 20)::INTEGER END AS printed_page_start, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE (doc_id % 20 + doc_id % 3)::INTEGER END AS printed_page_end FROM documents"
_EXCL = "(VALUES ('f1', 'src1', 1, 2), ('f2', NULL, 12, NULL), ('f3', 'src3', NULL, NULL), ('f9', NULL, NULL, NULL), ('f18', NULL, 18, 18)) AS r(f, b, s, e)"


@query(f"""WITH c AS ({_CAND}), m AS (SELECT c.doc_id, bool_or(s IS NOT DISTINCT FROM printed_page_start AND e IS NOT DISTINCT FROM printed_page_end) AS strict, bool_or(coalesce(printed_page_start BETWEEN s AND coalesce(e, s), false)) AS single, bool_or((s IS NULL OR coalesce(s = printed_page_start, false)) AND (e IS NULL OR coalesce(e = printed_page_end, false))) AS wild
 FROM c JOIN {_EXCL} ON c.filename = r.f AND (r.b IS NULL OR r.b = c.candidate_book_id) GROUP BY c.doc_id)
SELECT mode, count(*)::BIGINT AS kept FROM (SELECT 'strict' AS mode, c.doc_id FROM c LEFT JOIN m USING (doc_id) WHERE NOT coalesce(strict, false) UNION ALL SELECT 'single', c.doc_id FROM c LEFT JOIN m USING (doc_id) WHERE NOT coalesce(single, false) UNION ALL SELECT 'wildcard', c.doc_id FROM c LEFT JOIN m USING (doc_id) WHERE NOT coalesce(wild, false)) GROUP BY mode""")
def exclusion_modes(spark: SparkSession, d: str) -> DataFrame:
    """The three meanings of a missing page in an exclusion."""
    k = F.col("doc_id")
    page = F.when(k % 9 != 0, (k % 20).cast("int"))
    c = table(spark, d, "documents").select(k, F.concat(F.lit("f"), (k % 50).cast("string")).alias("filename"), F.col("source").alias("candidate_book_id"), page.alias("printed_page_start"), (page + (k % 3).cast("int")).alias("printed_page_end"))
    rules = spark.createDataFrame([("f1", "src1", 1, 2), ("f2", None, 12, None), ("f3", "src3", None, None), ("f9", None, None, None), ("f18", None, 18, 18)], "filename string, candidate_book_id string, page_start int, page_end int")
    return readers.union_corpora([joins.excluded(c, rules, m).groupBy(F.lit(m).alias("mode")).agg(F.count("*").alias("kept")) for m in ("strict", "single", "wildcard")])


@query("""WITH t AS (SELECT doc_id, trim(string_split(text, chr(10))[1]) AS title FROM documents), g AS (SELECT title, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM t WHERE title <> '' GROUP BY title HAVING count(*) > 1)
SELECT t.doc_id, g.n - 1 AS others, g.first_id FROM t JOIN g USING (title)""")
def duplicate_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles that other documents have too; groups are counted before the join, so no pairs are made."""
    t = table(spark, d, "documents").select("doc_id", F.trim(F.get(F.split("text", "\n"), F.lit(0))).alias("title")).where("title <> ''")
    g = t.groupBy("title").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")
    return t.join(g, "title").select("doc_id", (F.col("n") - 1).alias("others"), "first_id")


@query("""WITH a AS (SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id, source FROM documents WHERE doc_id % 3 = 0)
SELECT 'left' AS side, count(*)::BIGINT AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', count(*)::BIGINT FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def set_equality(spark: SparkSession, d: str) -> DataFrame:
    """Rows of either side alone."""
    t = table(spark, d, "documents").select("doc_id", "source")
    return joins.set_difference(t.where("doc_id % 2 = 0"), t.where("doc_id % 3 = 0")).groupBy("side").agg(F.count("*").alias("n"))


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.source <> 'src0' AND NOT EXISTS (SELECT 1 FROM labels h WHERE h.doc_id = d.doc_id AND h.toxic = 1)")
def public_documents(spark: SparkSession, d: str) -> DataFrame:
    """An owner's rows without hidden ones, with their labels where there are any."""
    labels = table(spark, d, "labels")
    rows = views.public_rows(table(spark, d, "documents"), F.col("source") != "src0", labels.where("toxic = 1"), "doc_id")
    return rows.join(labels.select("doc_id", "quality"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_per_key(spark: SparkSession, d: str) -> DataFrame:
    """The last row of each key."""
    e = table(spark, d, "events").withColumn("o", F.struct("ts", "event_id"))
    return readers.last_per_key(e, "user_id", "o").select("user_id", "event_id", "event_type")


@query("SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    return reports.value_counts(table(spark, d, "events"), "event_type")


@query("SELECT count(*) FILTER (WHERE event_type = 'error')::BIGINT AS errors, count(*) FILTER (WHERE value > 50)::BIGINT AS large, count(*) FILTER (WHERE json_extract(props, '$.k')::BIGINT % 2 = 0)::BIGINT AS even_k FROM events")
def condition_counts(spark: SparkSession, d: str) -> DataFrame:
    """A2, and a JSON function over props."""
    e = table(spark, d, "events")
    return reports.condition_counts(e, {"errors": F.col("event_type") == "error", "large": F.col("value") > 50, "even_k": F.get_json_object("props", "$.k").cast("long") % 2 == 0})


@query(f"WITH t AS ({_TOKENS}) SELECT source, token, count(DISTINCT doc_id)::BIGINT AS df FROM t GROUP BY source, token")
def doc_freq_by_source(spark: SparkSession, d: str) -> DataFrame:
    """A3: documents of a source that have a token."""
    t = table(spark, d, "documents").select("source", F.explode(X.token_set(X.normalize(F.col("text")))).alias("token"))
    return t.groupBy("source", "token").agg(F.count("*").alias("df"))


@query("""WITH p AS (SELECT source AS book, doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id END AS page FROM documents)
SELECT CASE book WHEN 'src1' THEN 'src0' ELSE book END AS canonical_book, min(page) AS page_min, max(page) AS page_max, count(*)::BIGINT AS book_rows FROM p GROUP BY 1""")
def book_page_ranges(spark: SparkSession, d: str) -> DataFrame:
    """A4, A5."""
    p = table(spark, d, "documents").select(joins.canonical(F.col("source"), {"src1": "src0"}).alias("canonical_book"), F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("printed_page"))
    return audits.book_ranges(p)


_KEY = "translate(token, 'éèêäá0', 'eeeaao')"


@query(f"WITH t AS ({_TOKENS}) SELECT token, count(*)::BIGINT AS count, {_KEY} AS key, regexp_replace({_KEY}, '[aeiouy]', '', 'g') AS loose FROM t GROUP BY token")
def lexicon_counts(spark: SparkSession, d: str) -> DataFrame:
    """A6, T14, T15 with Latin equivalences."""
    key = F.translate("token", "éèêäá0", "eeeaao")
    return lexicon.lexicon(document_tokens(spark, d), key, F.regexp_replace(key, "[aeiouy]", ""))


@query(f"""WITH t AS ({_TOKENS}), k AS (SELECT token FROM t GROUP BY token HAVING count(*) >= 5), u AS (SELECT doc_id, token, count(*) AS n FROM t WHERE token NOT IN (SELECT token FROM k) GROUP BY doc_id, token),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, token) AS rn FROM u), s AS (SELECT doc_id, sum(n)::BIGINT AS unknown, list(token ORDER BY rn) FILTER (WHERE rn <= 12) AS top_unknown FROM r GROUP BY doc_id), a AS (SELECT doc_id, count(*)::BIGINT AS total FROM t GROUP BY doc_id)
SELECT a.doc_id, total, coalesce(unknown, 0) AS unknown, round(coalesce(unknown, 0) / total, 3) AS unknown_ratio, coalesce(top_unknown, []) AS top_unknown FROM a LEFT JOIN s USING (doc_id)""")
def unknown_token_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Tokens that the corpus has under five times."""
    t = document_tokens(spark, d)
    return lexicon.unknown_tokens(t, t.groupBy("token").count().where("count >= 5"), "doc_id")


@query(f"""WITH t AS (SELECT doc_id, source, {words(norm('text'))} AS w FROM documents), e AS (SELECT doc_id, source, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM t), f AS (SELECT * FROM e WHERE length(token) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY doc_id, i) AS rn FROM f)
SELECT token, count(DISTINCT source)::BIGINT AS books, count(*)::BIGINT AS count, list(doc_id ORDER BY rn) FILTER (WHERE rn <= 4) AS first_pages FROM r GROUP BY token""")
def token_places(spark: SparkSession, d: str) -> DataFrame:
    """A8."""
    return lexicon.token_places(document_tokens(spark, d), "source", "doc_id")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents)
SELECT source, lang, count(*)::BIGINT AS n, string_agg(doc_id::VARCHAR, ' · ' ORDER BY rn) FILTER (WHERE rn <= 8) || CASE WHEN count(*) > 8 THEN ' · +' || (count(*) - 8)::VARCHAR || ' more' ELSE '' END AS label FROM r GROUP BY source, lang""")
def capped_groups(spark: SparkSession, d: str) -> DataFrame:
    """A13, A15, K6."""
    return reports.capped_groups(table(spark, d, "documents"), ["source", "lang"], "doc_id", ["doc_id"], 8).select("source", "lang", "n", "label")


@query("""SELECT 'lang' AS category, 1 AS priority, lang AS grp, count(*)::BIGINT AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', 2, source, count(*)::BIGINT FROM documents GROUP BY source
UNION ALL SELECT 'size', 3, (n_chars // 1000)::VARCHAR, count(*)::BIGINT FROM documents GROUP BY n_chars // 1000""")
def backlog_union(spark: SparkSession, d: str) -> DataFrame:
    """A14, U2."""
    t = table(spark, d, "documents")
    by = lambda c: t.groupBy(c.alias("grp")).agg(F.count("*").alias("n"))
    return reports.backlog([("lang", 1, by(F.col("lang"))), ("source", 2, by(F.col("source"))), ("size", 3, by(F.floor(F.col("n_chars") / 1000)))])


@query("""SELECT 'no_label' AS check_name, doc_id::VARCHAR AS key FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'length', doc_id::VARCHAR FROM documents WHERE n_chars <> length(text)
UNION ALL SELECT 'repeated_text', min(doc_id)::VARCHAR FROM documents GROUP BY text HAVING count(*) > 1""")
def validators(spark: SparkSession, d: str) -> DataFrame:
    """V1, U7."""
    t, labels = table(spark, d, "documents"), table(spark, d, "labels")
    again = t.groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1")
    return reports.violations([("no_label", t.join(labels, "doc_id", "left_anti")), ("length", t.where(F.col("n_chars") != F.length("text"))), ("repeated_text", again)], "doc_id")


@query("SELECT doc_id, CASE WHEN lang NOT IN ('en', 'fr') THEN 'lang is not allowed' END AS error FROM documents WHERE lang NOT IN ('en', 'fr')")
def schema_errors(spark: SparkSession, d: str) -> DataFrame:
    """V3, S15."""
    return reports.schema_errors(table(spark, d, "documents"), "doc_id", {"doc_id": "bigint", "text": "string"}, {"lang": ("en", "fr")})


@query("""SELECT p.page_id, unnest(list_filter([CASE WHEN NOT contains(regexp_replace(html, '<[^>]+>', ' ', 'g'), 'Home') THEN 'heading' END, CASE WHEN NOT contains(regexp_replace(html, '<[^>]+>', ' ', 'g'), page_id::VARCHAR) THEN 'number' END], lambda x: x IS NOT NULL)) AS missing FROM pages p""")
def render_checks(spark: SparkSession, d: str) -> DataFrame:
    """V2."""
    t = table(spark, d, "pages").withColumn("shown", F.regexp_replace("html", "<[^>]+>", " "))
    return reports.render_checks(t, "page_id", "shown", {"heading": F.lit("Home"), "number": F.col("page_id").cast("string")})


@query("""WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, ts, event_id AS click_id, value AS click_value FROM events WHERE event_type = 'click'),
j AS (SELECT e.event_id, c.click_id, c.click_value, row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts DESC, c.click_id DESC) AS rn FROM e LEFT JOIN c ON c.user_id = e.user_id AND c.ts <= e.ts) SELECT event_id, click_id, click_value FROM j WHERE rn = 1""")
def asof_join(spark: SparkSession, d: str) -> DataFrame:
    """Extension: each purchase with the user's last click before it."""
    e = table(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("click_id"), F.max_by("value", "event_id").alias("click_value"))
    return joins.asof_join(left, right, ["user_id"], "ts", "ts", ["click_id", "click_value"]).select("event_id", "click_id", "click_value")


@query("""WITH t AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings), q AS (SELECT * FROM t WHERE vec_id % 100 = 0), s AS (SELECT q.vec_id AS query_id, t.vec_id, list_cosine_similarity(q.v, t.v) AS cosine FROM q JOIN t ON q.vec_id <> t.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, vec_id) AS rn FROM s) SELECT query_id, vec_id, round(cosine, 6) AS cosine FROM r WHERE rn <= 5""")
def dense_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """J11 over dense vectors: the queries (ids divisible by 100) against all vectors, the best five.

    Queries are dealt in blocks; each block is one row that meets every vector
    once, and keeps the best of its task before anything is shuffled.
    """
    t = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    t = t.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    q = t.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("norm").alias("q_norm"))
    return joins.dense_topk(t, q, 5).select("query_id", "vec_id", F.round("cosine", 6).alias("cosine"))


_URL = "CASE page_id % 5 WHEN 0 THEN 'not a url' WHEN 1 THEN 'ftp://host/x' WHEN 2 THEN NULL ELSE url END"


@query(f"SELECT page_id, 'page-' || lpad((page_id % 1000)::VARCHAR, 3, '0') AS name, 'not a URL' AS error FROM pages WHERE coalesce(NOT regexp_matches({_URL}, '^https?://[^/ ]+'), true)")
def checked_urls(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose URL isn't an absolute one of the web; the crawled table stands for fetching."""
    k = F.col("page_id")
    url = F.when(k % 5 == 0, "not a url").when(k % 5 == 1, "ftp://host/x").when(k % 5 != 2, F.col("url"))
    return table(spark, d, "pages").where(~X.is_url(url)).select("page_id", X.numbered_id(F.lit("page"), k % 1000).alias("name"), F.lit("not a URL").alias("error"))
