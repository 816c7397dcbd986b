"""Queries of the import-side rules over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import imports as I
from .base import query, table


@query("""WITH r AS (SELECT doc_id, lang AS title FROM documents), k AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE 'known' || doc_id END AS phase FROM documents WHERE doc_id % 5 = 0), h AS (SELECT doc_id, 'hint' || doc_id AS phase FROM documents WHERE doc_id % 3 = 0),
t AS (SELECT lang AS title, arg_min(source, doc_id) AS phase FROM documents WHERE lang <> 'de' GROUP BY lang) SELECT r.doc_id, CASE WHEN k.doc_id IS NOT NULL THEN k.phase ELSE coalesce(h.phase, t.phase) END AS phase FROM r LEFT JOIN k USING (doc_id) LEFT JOIN h USING (doc_id) LEFT JOIN t USING (title)""")
def import_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Known, hinted, by title; the first title wins and a known null stays null."""
    docs, k = table(spark, d, "documents"), F.col("doc_id")
    known = docs.where("doc_id % 5 = 0").select(k, F.when(k % 10 != 0, F.concat(F.lit("known"), k.cast("string"))).alias("phase"))
    hints = docs.where("doc_id % 3 = 0").select(k, F.concat(F.lit("hint"), k.cast("string")).alias("phase"))
    titles = I.first_titles(docs.where("lang <> 'de'").select(F.col("lang").alias("title"), F.col("source").alias("phase"), k), "title", "phase", "doc_id")
    return I.with_precedence(docs.select(k, F.col("lang").alias("title")), known, hints, titles, "doc_id", "title", "phase").select("doc_id", "phase")


@query("""SELECT d.doc_id, CASE WHEN coalesce(l.quality = 1, false) THEN 'kept ' || l.toxic ELSE d.source END AS body FROM documents d LEFT JOIN labels l USING (doc_id)""")
def previous_versions(spark: SparkSession, d: str) -> DataFrame:
    """J27."""
    old = table(spark, d, "labels").select("doc_id", F.concat(F.lit("kept "), F.col("toxic").cast("string")).alias("body"), (F.col("quality") == 1).alias("verified"))
    return I.keep_verified(table(spark, d, "documents").select("doc_id", F.col("source").alias("body")), old, "doc_id", "body", "verified").select("doc_id", "body")


@query("""WITH c AS (SELECT doc_id * 2 AS doc_id FROM documents) SELECT c.doc_id, d.doc_id IS NOT NULL AS found, d.source FROM c LEFT JOIN documents d USING (doc_id)""")
def candidate_rows_found(spark: SparkSession, d: str) -> DataFrame:
    """J18."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    return I.candidates_of(docs, docs.select((F.col("doc_id") * 2).alias("doc_id")), "doc_id").select("doc_id", "found", "source")


@query(r"""SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'missing_image' WHEN doc_id % 4 = 0 THEN 'empty_tsv' ELSE 'ok' END AS layout, doc_id % 2 = 0 AND regexp_matches(text, 'License') AS toc_start, len(regexp_extract_all(text, '[০-৯0-9]{1,3}')) >= 8 AND len(regexp_extract_all(text, '[A-Za-z]')) >= 80 AS toc_more, CASE WHEN doc_id % 3 <> 0 THEN doc_id::INTEGER END AS page, coalesce(CASE WHEN doc_id % 3 <> 0 THEN doc_id END, doc_id + 1) AS scan FROM documents""")
def layout_and_contents(spark: SparkSession, d: str) -> DataFrame:
    """C23, C24, C28."""
    k, t = F.col("doc_id"), F.col("text")
    page = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("x"))).otherwise(k.cast("string"))
    return table(spark, d, "documents").select(
        "doc_id", I.layout_status(k % 9 != 0, k % 4).alias("layout"), I.toc_start(F.when(k % 2 == 0, "front_matter").otherwise("other"), t, "License").alias("toc_start"),
        I.toc_continues(t, "A-Za-z").alias("toc_more"), I.whole_number(page).alias("page"), I.scan_number(F.when(k % 3 != 0, k), k).alias("scan"),
    )


@query("SELECT doc_id FROM documents")
def guarded_import(spark: SparkSession, d: str) -> DataFrame:
    """All languages here are allowed; a row of another one would raise."""
    return I.guarded(table(spark, d, "documents").select("doc_id", "lang"), "lang", ["en", "fr", "de", "es"], ["xx"]).select("doc_id")
