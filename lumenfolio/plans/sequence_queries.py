"""Queries of page sequences, runs, groups and windows (W*) over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import pages as P
from ..operators import sequence as S
from .base import norm, query, table

# Documents as numbered pages: a made-up candidate number, outliers and untrusted pages, in both engines.
_PAGES = """SELECT source AS book_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS scan_page,
 CASE WHEN doc_id % 11 = 0 THEN 'front_matter' WHEN doc_id % 17 = 0 THEN 'blank_or_near_blank' ELSE 'normal_poem_page' END AS page_type FROM documents"""
_CANDIDATES = f"""SELECT *, CASE WHEN doc_id % 5 <> 0 THEN scan_page + 3 + CASE WHEN doc_id % 13 = 0 THEN 80 ELSE 0 END END AS value FROM ({_PAGES})"""


def numbered_pages(spark: SparkSession, d: str) -> DataFrame:
    p = P.document_pages(table(spark, d, "documents"))
    k = F.col("doc_id")
    kind = F.when(k % 11 == 0, "front_matter").when(k % 17 == 0, "blank_or_near_blank").otherwise("normal_poem_page")
    value = F.when(k % 5 != 0, F.col("scan_page") + 3 + F.when(k % 13 == 0, 80).otherwise(0))
    footer = F.when(k % 10 == 0, F.concat(F.lit("* "), (F.col("scan_page") + 3).cast("string")))
    return p.withColumns({"page_type": kind, "value": value, "source": F.lit("page_corpus_ocr_zone"), "footer": footer})


@query(f"""WITH p AS ({_PAGES}), c AS (SELECT book_id, scan_page, page_type, unnest([0, 1, 2]) AS i, doc_id FROM p), v AS (SELECT *, ((doc_id * (i + 3)) % 520)::INTEGER AS value, CASE WHEN (doc_id + i) % 3 = 0 THEN 'tesseract_tsv_line' ELSE 'page_corpus_ocr_zone' END AS src, CASE WHEN (doc_id + i) % 2 = 0 THEN 'bangla' ELSE 'ascii' END AS script, CASE WHEN (doc_id * i) % 2 = 0 THEN 'bottom' ELSE 'top' END AS zone, ((doc_id * 7 + i * 5) % 40)::DOUBLE AS conf FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY src = 'tesseract_tsv_line' DESC, script = 'bangla' DESC, zone = 'bottom' DESC, conf DESC, length(value::VARCHAR) DESC, i) AS rn FROM v WHERE value BETWEEN 1 AND 500)
SELECT p.doc_id, CASE WHEN p.page_type = 'normal_poem_page' THEN r.value END AS value, CASE WHEN p.page_type = 'normal_poem_page' THEN r.src END AS source FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND r.rn = 1""")
def seq_best_candidate(spark: SparkSession, d: str) -> DataFrame:
    """W1."""
    p, k = numbered_pages(spark, d), F.col("doc_id")

    def one(i: int):
        v = ((k * (i + 3)) % 520).cast("int")
        return F.struct(v.alias("value"), F.when((k * i) % 2 == 0, "bottom").otherwise("top").alias("zone"), v.cast("string").alias("raw"), F.when((k + i) % 2 == 0, "bangla").otherwise("ascii").alias("script"), F.when((k + i) % 3 == 0, S.LAYOUT).otherwise("page_corpus_ocr_zone").alias("source"), ((k * 7 + i * 5) % 40).cast("double").alias("avg_conf"))

    best = S.best_candidate(F.array(*[one(i) for i in range(3)]), P.is_trusted(F.col("page_type")))
    return p.select("doc_id", best.alias("b")).select("doc_id", F.col("b.value").alias("value"), F.col("b.source").alias("source"))


_TRUSTED = f"SELECT book_id, scan_page, value FROM ({_CANDIDATES}) WHERE page_type = 'normal_poem_page' AND value IS NOT NULL"


@query(f"""WITH c AS ({_TRUSTED}), o AS (SELECT book_id, value - scan_page AS off, count(*) AS n, max(scan_page) - min(scan_page) AS span FROM c GROUP BY 1, 2 HAVING count(*) >= 3),
r AS (SELECT *, row_number() OVER w AS rk, lead(n) OVER w AS second FROM o WINDOW w AS (PARTITION BY book_id ORDER BY n DESC, span DESC, abs(off), off)), f AS (SELECT *, first_value(second IS NOT NULL AND n >= 2 * second) OVER (PARTITION BY book_id ORDER BY rk) AS alone FROM r)
SELECT book_id, off::INTEGER AS offset_pages FROM f WHERE rk = 1 OR NOT alone""")
def seq_offsets(spark: SparkSession, d: str) -> DataFrame:
    """W2."""
    c = numbered_pages(spark, d).where(P.is_trusted(F.col("page_type")) & F.col("value").isNotNull())
    return S.supported_offsets(c.select("book_id", "scan_page", "value")).select("book_id", F.col("offset").alias("offset_pages"))


@query(f"""WITH c AS ({_TRUSTED}) SELECT book_id, scan_page, coalesce(value <= lag(value) OVER w, false) OR coalesce(value >= lead(value) OVER w, false) AS rejected FROM c WINDOW w AS (PARTITION BY book_id ORDER BY scan_page)""")
def seq_nonmonotonic(spark: SparkSession, d: str) -> DataFrame:
    """W3."""
    c = numbered_pages(spark, d).where(P.is_trusted(F.col("page_type")) & F.col("value").isNotNull())
    return S.nonmonotonic(c.select("book_id", "scan_page", "value")).select("book_id", "scan_page", "rejected")


@query()
def seq_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The repaired numbers of all books; a Python model checks it in the tests."""
    out = S.repair(numbered_pages(spark, d))
    return out.select("book_id", "scan_page", "page_type", "printed_page", "basis", "confidence", F.array_join("flags", ",").alias("flags"))


@query("""WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, value > 50 AS f FROM events), g AS (SELECT user_id, f, rn - row_number() OVER (PARTITION BY user_id, f ORDER BY rn) AS grp FROM e)
SELECT user_id, coalesce(max(n), 0)::INTEGER AS longest FROM (SELECT user_id, grp, count(*) FILTER (WHERE f) AS n FROM g GROUP BY user_id, grp, f) GROUP BY user_id""")
def longest_run(spark: SparkSession, d: str) -> DataFrame:
    """Each user's longest run of events over 50."""
    return S.longest_flag_runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("value") > 50)


@query("""WITH e AS (SELECT DISTINCT user_id, floor(epoch(ts) / 3600)::BIGINT AS h FROM events), g AS (SELECT user_id, h - row_number() OVER (PARTITION BY user_id ORDER BY h) AS grp FROM e)
SELECT user_id, max(n)::INTEGER AS longest FROM (SELECT user_id, count(*) AS n FROM g GROUP BY user_id, grp) GROUP BY user_id""")
def consecutive_run(spark: SparkSession, d: str) -> DataFrame:
    """Each user's longest run of consecutive hours."""
    hours = table(spark, d, "events").select("user_id", F.floor(F.unix_timestamp("ts") / 3600).alias("h"))
    return S.longest_number_runs(hours, ["user_id"], "h")


_HOURS = "SELECT DISTINCT user_id, floor(epoch(ts) / 3600)::BIGINT AS h FROM events"
_GROUPS = f"SELECT user_id, h, sum(n) OVER (PARTITION BY user_id ORDER BY h)::BIGINT AS grp FROM (SELECT user_id, h, CASE WHEN h - lag(h) OVER (PARTITION BY user_id ORDER BY h) > 1 THEN 1 ELSE 0 END AS n FROM ({_HOURS}))"


def _hour_groups(spark: SparkSession, d: str) -> DataFrame:
    hours = table(spark, d, "events").select("user_id", F.floor(F.unix_timestamp("ts") / 3600).alias("h")).distinct()
    return S.gap_groups(hours, ["user_id"], "h")


@query(f"SELECT user_id, grp, min(h) AS first_hour, count(*)::BIGINT AS hours FROM ({_GROUPS}) GROUP BY user_id, grp")
def page_groups(spark: SparkSession, d: str) -> DataFrame:
    """W11."""
    return _hour_groups(spark, d).groupBy("user_id", "grp").agg(F.min("h").alias("first_hour"), F.count("*").alias("hours"))


@query(f"""WITH g AS ({_GROUPS}), s AS (SELECT user_id, grp, count(*) AS n, min(h) AS f FROM g GROUP BY user_id, grp), w AS (SELECT user_id, grp, f, n, unnest(CASE WHEN n <= 3 THEN [n] ELSE [1, 2, 3] END) AS k FROM s), x AS (SELECT user_id, grp, k, unnest(CASE WHEN n <= 3 THEN [f] ELSE range(f, f + n - k + 1) END) AS start FROM w)
SELECT user_id, grp, start AS first_hour, k::INTEGER AS hours FROM x""")
def page_subwindows(spark: SparkSession, d: str) -> DataFrame:
    """Sub-windows of at most three hours."""
    w = S.page_windows(_hour_groups(spark, d), ["user_id", "grp"], "h", 3)
    return w.select("user_id", "grp", F.get("scans", F.lit(0)).alias("first_hour"), F.size("scans").alias("hours"))


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents), n AS (SELECT doc_id, i, {norm('raw')} AS t FROM l),
k AS (SELECT doc_id, i, t, length(replace(t, ' ', '')) AS c, row_number() OVER (PARTITION BY doc_id, t ORDER BY i) AS rep FROM n WHERE length(replace(t, ' ', '')) BETWEEN 3 AND 520 AND NOT regexp_full_match(t, '[0-9 ]+')), o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM k WHERE rep = 1),
w AS (SELECT a.doc_id, a.i AS s, max(b.i) AS e, sum(b.c) AS c FROM o a JOIN o b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 2 JOIN (SELECT unnest([0, 1, 2]) AS k) x ON b.p <= a.p + x.k JOIN o z ON z.doc_id = a.doc_id AND z.p = a.p + x.k GROUP BY a.doc_id, a.i, x.k)
SELECT doc_id, count(*)::BIGINT AS windows, sum(e - s)::BIGINT AS spread FROM w WHERE c <= 520 GROUP BY doc_id""")
def region_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of one to three lines within the budget, per document."""
    w = S.region_windows(X.region_lines(F.col("text")))
    t = table(spark, d, "documents").select("doc_id", F.explode(w).alias("w"))
    return t.groupBy("doc_id").agg(F.count("*").alias("windows"), F.sum(F.col("w.line_end") - F.col("w.line_start")).cast("long").alias("spread"))


@query("""WITH r AS (SELECT source, doc_id, n_chars, row_number() OVER w AS rn, n_chars - lead(n_chars) OVER w AS gap FROM documents WINDOW w AS (PARTITION BY source ORDER BY n_chars DESC, doc_id)) SELECT source, doc_id, gap AS runner_up_gap FROM r WHERE rn = 1""")
def runner_up_gap(spark: SparkSession, d: str) -> DataFrame:
    """The longest document of each source and its lead."""
    return S.runner_up(table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], "n_chars", ["doc_id"]).select("source", "doc_id", "runner_up_gap")


@query("""WITH t AS (SELECT conv_id, turn, role = 'user' AS o, role = 'assistant' AS c FROM conversations), b AS (SELECT *, CASE WHEN coalesce(turn - lag(turn) OVER w > 1, true) OR NOT (o OR c) THEN 1 ELSE 0 END AS b FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), g AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM b)
SELECT conv_id, turn, coalesce(max(CASE WHEN o THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, g ORDER BY turn), 0) = 1 AND (o OR c) AS active FROM g""")
def state_islands(spark: SparkSession, d: str) -> DataFrame:
    """Turns are active from a user's turn on."""
    t = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return S.state_islands(t, ["conv_id"], "turn", F.col("role") == "user", F.col("role") == "assistant").select("conv_id", "turn", "active")


@query("""WITH t AS (SELECT conv_id, turn, length(text) > 300 AS hit FROM conversations), m AS (SELECT *, max(CASE WHEN hit THEN turn END) OVER (PARTITION BY conv_id) AS last, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM t)
SELECT conv_id, turn FROM m WHERE coalesce(turn > last AND turn <= last + 2, false) OR rn <= 1""")
def lines_after_match(spark: SparkSession, d: str) -> DataFrame:
    """Two turns behind a conversation's last long one, and its last turn."""
    t = table(spark, d, "conversations").select("conv_id", "turn", (F.length("text") > 300).alias("hit"))
    return S.lines_after(t, ["conv_id"], "turn", "hit", 2, 1).select("conv_id", "turn")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """Extension: what the streaming counts come to once all events are in."""
    from ..streaming.ingest import windowed_counts

    return windowed_counts(table(spark, d, "events"), "ts", "event_type")
