"""Readers (S1-S24). Paths may be in any store that Spark reads; schemas are given, so no pass infers them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Schemas of records.
BOOK_SOURCE = "role string, title_bn string, publisher_bn string, edition_bn string, publication_year int, isbn string, purchase_url string, page_start int, page_end int, page_label_bn string, page_basis string, note_bn string"
POEM = f"id string, poet_id string, phase_id string, title_bn string, body_bn string, tags array<string>, source_edition string, source_year int, source_name_bn string, source_url string, isbn string, sort_order int, verified boolean, book_sources array<struct<{BOOK_SOURCE.replace(' string', ':string').replace(' int', ':int')}>>"
CANDIDATE = "value int, label_bn string, zone string, line_index int, raw string, script string, source string, avg_conf double"
PAGE = f"record_id string, book_id string, physical_book_id string, collection_bn string, scan_page int, raw_ocr string, raw_pdftotext string, normalized_match_text string, page_type string, printed_page_candidates array<struct<{', '.join(':'.join(c.split()) for c in CANDIDATE.split(', '))}>>, printed_page_fixed int, printed_page_basis string, sequence_confidence double, flags array<string>"
TSV = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"


def json_document(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Whole JSON files; a malformed one is an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON Lines without blank lines; a malformed line is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row"))
    return parsed.select("row.*")


def record_directory(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """S3: one JSON file per record with its file name, by name; the limit applies behind the sort."""
    rows = json_document(spark, path, schema).withColumn("filename", F.col("_metadata.file_name"))
    return rows.orderBy("filename").limit(limit) if limit is not None else rows


def scraped_ids(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Distinct ids that a pattern finds in a source text."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.regexp_extract_all("value", F.lit(pattern), 1)).alias("id")).distinct()


def form_feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Filename, scan_page, text: a text file is cut into pages at form feeds."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("filename"), "value")
    return whole.select("filename", F.posexplode(F.split("value", "\f")).alias("pos", "text")).select("filename", (F.col("pos") + 1).alias("scan_page"), "text")


def word_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Words of a recogniser's TSV; without empty text and boxes that aren't positive numbers."""
    rows = spark.read.schema(TSV).option("sep", "\t").option("header", True).option("mode", "PERMISSIVE").option("quote", "").csv(path)
    sized = F.coalesce((F.col("width") > 0) & (F.col("height") > 0) & F.col("left").isNotNull() & F.col("top").isNotNull(), F.lit(False))
    return rows.where(sized & (F.trim(F.coalesce("text", F.lit(""))) != ""))


def word_lines(words: DataFrame) -> DataFrame:
    """Lines of words: bounds, mean confidence of those that have one, and the text in word order."""
    right, bottom = F.col("left") + F.col("width"), F.col("top") + F.col("height")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_num", "text"))), lambda s: s["text"]), " ")
    return words.groupBy("block_num", "par_num", "line_num").agg(F.min("left").alias("left"), F.min("top").alias("top"), F.max(right).alias("right"), F.max(bottom).alias("bottom"), F.avg(F.when(F.col("conf") >= 0, F.col("conf"))).alias("avg_conf"), text.alias("text"))


def layout_summary(lines: DataFrame, height: int) -> DataFrame:
    """A10: lines in the header, body and footer bands, and the median width in the body."""
    y = (F.col("top") + F.col("bottom")) / 2.0 / height
    body = y.between(0.22, 0.78)
    return lines.agg(F.count("*").alias("line_count"), F.count_if(y < 0.22).alias("header_lines"), F.count_if(body).alias("body_lines"), F.count_if(y > 0.78).alias("footer_lines"), F.median(F.when(body, F.col("right") - F.col("left"))).alias("median_body_width"))


def side_files(spark: SparkSession, path: str) -> DataFrame:
    """Directory, source, class and body of a directory of three text files each; a missing one is null."""
    files = spark.read.text(f"{path}/*/*", wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("directory"), F.lower(F.col("_metadata.file_name")).alias("name"), "value")
    pick = lambda n: F.max(F.when(F.startswith("name", F.lit(n)), F.col("value"))).alias(n)
    return files.groupBy("directory").agg(pick("source"), pick("class"), pick("body"))


def substitution_map(spark: SparkSession, path: str) -> dict[str, str]:
    """A flat JSON map, or one under ``substitutions``; without empty and identical pairs. It is configuration, read on the driver."""
    text = spark.read.text(path, wholetext=True)
    row = text.select(F.coalesce(F.from_json(F.get_json_object("value", "$.substitutions"), "map<string,string>"), F.from_json("value", "map<string,string>")).alias("m")).first()
    return {k: v for k, v in (row["m"] or {}).items() if k and v and k != v} if row else {}


def optional(spark: SparkSession, path: str | None, schema: str, reader=json_lines) -> DataFrame:
    """An empty table where no path is given."""
    return reader(spark, path, schema) if path else spark.createDataFrame([], schema)


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with the same key the last in order."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def union_corpora(parts: list[DataFrame]) -> DataFrame:
    """A bag union; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def select_books(books: DataFrame, ids: list[str] | None = None, primary_only: bool = False) -> DataFrame:
    """Primary collections only, if asked; explicit ids override; an unknown id is an error."""
    if ids:
        known = {r[0] for r in books.where(F.col("book_id").isin(ids)).select("book_id").distinct().limit(len(ids)).collect()}
        if missing := sorted(set(ids) - known):
            raise ValueError(f"unknown books: {missing}")
        return books.where(F.col("book_id").isin(ids))
    return books.where("source_kind = 'primary_collection'") if primary_only else books


def page_range(pages: DataFrame, start: int | None = None, end: int | None = None, limit: int | None = None) -> DataFrame:
    """Inclusive scans; the limit applies to the first scans."""
    lower = F.col("scan_page") >= start if start is not None else F.lit(True)
    upper = F.col("scan_page") <= end if end is not None else F.lit(True)
    rows = pages.where(lower & upper)
    return rows.orderBy("scan_page").limit(limit) if limit is not None else rows


def keyed_rows(rows: DataFrame, sidecar: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with their row of a side table (the last by order of all its columns) as a map of texts, empty where there is none.

    Rows of the side table without a key are ignored.
    """
    fields = [c for c in sidecar.columns if c != key]
    made = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.col(c).cast("string") for c in fields])), lambda _, v: v.isNotNull())
    side = sidecar.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(made, F.struct(*fields)).alias(name))
    return rows.join(side, key, "left").withColumn(name, F.coalesce(name, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))


def option_errors(options: dict[str, str], allowed: dict[str, tuple[str, ...]], required: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """V4: (option, error) of comma-separated options: a required one that is missing or empty, and values outside an option's list."""
    out = [(name, "is required") for name in required if not any(x.strip() for x in options.get(name, "").split(","))]
    for name, known in allowed.items():
        given = {x.strip() for x in options.get(name, "").split(",")} - {"", "all"}
        if unknown := sorted(given - set(known)):
            out.append((name, f"unknown: {', '.join(unknown)}"))
    return sorted(out)
