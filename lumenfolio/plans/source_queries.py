"""Queries of readers and writers (S*, K*): tables go out in a format and come back, and the rows are compared with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import joins, reports, views
from ..sources import ledger, readers, writers
from .base import folder, query, table


def _nations(spark: SparkSession, d: str) -> list[tuple[int, str, int]]:
    """The 25 rows of ``nation``, a table of fixed size."""
    return sorted((r.n_nationkey, r.n_name, r.n_regionkey) for r in table(spark, d, "nation").collect())


@query("SELECT doc_id, lang, n_chars FROM documents")
def read_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """JSON Lines with blank lines among them."""
    path = folder(spark)
    rows = table(spark, d, "documents").select(F.to_json(F.struct("doc_id", "lang", "n_chars")).alias("value"))
    rows.select(F.explode(F.array("value", F.lit(""), F.lit("  "))).alias("value")).write.text(path)
    return readers.json_lines(spark, path, "doc_id long, lang string, n_chars long")


@query("""SELECT '{"doc_id":' || doc_id || ',"lang":' || CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE '"' || lang || '"' END || ',"n_chars":' || n_chars || '}' AS line FROM documents""")
def written_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """K1, K2: columns in the order of their names, nulls kept."""
    path = folder(spark)
    writers.json_lines(table(spark, d, "documents").select("n_chars", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"), "doc_id"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("""SELECT 'nation-' || lpad(n_nationkey::VARCHAR, 2, '0') || '.json' AS filename, n_name AS title_bn, n_regionkey::INTEGER AS sort_order FROM nation ORDER BY 1 LIMIT 10""")
def record_directory(spark: SparkSession, d: str) -> DataFrame:
    """One JSON file per record, by file name, the first ten."""
    import json

    path = folder(spark)
    for k, name, region in _nations(spark, d):
        writers.text_file(spark, f"{path}/nation-{k:02}.json", json.dumps({"title_bn": name, "sort_order": region}, indent=1))
    return readers.record_directory(spark, path, readers.POEM, 10).select("filename", "title_bn", "sort_order")


@query("SELECT n_name AS id FROM nation WHERE n_nationkey % 2 = 0")
def scraped_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids in quotes in a source text, each once."""
    path = folder(spark)
    body = "\n".join(f'  "{name}", // no {k}' if k % 2 == 0 else f"  // {name}" for k, name, _ in _nations(spark, d))
    writers.text_file(spark, f"{path}/content.ts", f"export const hidden = new Set([\n{body}\n{body}\n]);\n")
    return readers.scraped_ids(spark, path, '"([^"]+)"')


@query("SELECT 'region-' || n_regionkey || '.txt' AS filename, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)::INTEGER AS scan_page, n_name AS text FROM nation")
def form_feed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Text files cut into pages at form feeds."""
    path, rows = folder(spark), _nations(spark, d)
    for region in sorted({r for _, _, r in rows}):
        writers.text_file(spark, f"{path}/region-{region}.txt", "\f".join(name for _, name, r in rows if r == region))
    return readers.form_feed_pages(spark, path)


_BOXES = """SELECT c_custkey AS k, (c_custkey % 5)::INTEGER AS block_num, (c_custkey // 5 % 4)::INTEGER AS par_num, (c_custkey // 20 % 6)::INTEGER AS line_num, c_custkey::INTEGER AS word_num, (c_custkey % 90 * 10)::INTEGER AS l, (c_custkey // 20 % 6 * 200)::INTEGER AS t, (c_custkey % 7 * 5)::INTEGER AS w, 12 AS h,
 CASE WHEN c_custkey % 11 = 0 THEN -1 ELSE c_custkey % 100 END::DOUBLE AS conf, CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE 'w' || c_custkey END AS text FROM customer"""
_KEPT = f"SELECT * FROM ({_BOXES}) WHERE w > 0 AND trim(text) <> ''"
_LINES = f"SELECT block_num, par_num, line_num, min(l) AS lo, min(t) AS top, max(l + w) AS hi, max(t + h) AS bottom, avg(conf) FILTER (WHERE conf >= 0) AS c, string_agg(text, ' ' ORDER BY word_num) AS text FROM ({_KEPT}) GROUP BY 1, 2, 3"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    n = lambda c: c.cast("int")
    part = lambda a, b: n(F.floor(k / a) % b)
    values = {
        "level": F.lit(5), "page_num": F.lit(1), "block_num": n(k % 5), "par_num": part(5, 4), "line_num": part(20, 6), "word_num": n(k), "left": n(k % 90 * 10), "top": part(20, 6) * 200,
        "width": n(k % 7 * 5), "height": F.lit(12), "conf": F.when(k % 11 == 0, -1).otherwise(k % 100).cast("double"), "text": F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("w"), k.cast("string"))),
    }
    path = folder(spark)
    table(spark, d, "customer").select(*[c.alias(name) for name, c in values.items()]).write.options(sep="\t", header=True, quote="", emptyValue="").csv(path)
    return readers.word_boxes(spark, path)


@query(f"SELECT word_num, text, l AS lo, w AS wide, conf FROM ({_KEPT})")
def word_boxes(spark: SparkSession, d: str) -> DataFrame:
    """A recogniser's TSV without empty words and boxes of no size."""
    return _boxes(spark, d).select("word_num", "text", F.col("left").alias("lo"), F.col("width").alias("wide"), "conf")


@query(f"SELECT block_num, par_num, line_num, lo, top, hi, bottom, round(c, 6) AS avg_conf, text FROM ({_LINES})")
def word_lines(spark: SparkSession, d: str) -> DataFrame:
    """Words as lines."""
    t = readers.word_lines(_boxes(spark, d))
    return t.select("block_num", "par_num", "line_num", F.col("left").alias("lo"), "top", F.col("right").alias("hi"), "bottom", F.round("avg_conf", 6).alias("avg_conf"), "text")


@query(f"""WITH l AS (SELECT (top + bottom) / 2.0 / 1200 AS y, hi - lo AS w FROM ({_LINES})) SELECT count(*)::BIGINT AS line_count, count(*) FILTER (WHERE y < 0.22)::BIGINT AS header_lines, count(*) FILTER (WHERE y BETWEEN 0.22 AND 0.78)::BIGINT AS body_lines,
 count(*) FILTER (WHERE y > 0.78)::BIGINT AS footer_lines, median(w) FILTER (WHERE y BETWEEN 0.22 AND 0.78)::DOUBLE AS median_body_width FROM l""")
def layout_summary(spark: SparkSession, d: str) -> DataFrame:
    """A10: lines in bands of a page, and the median width."""
    return readers.layout_summary(readers.word_lines(_boxes(spark, d)), 1200)


@query("""SELECT 'n' || n_nationkey AS directory, 'made by ' || n_name AS source, CASE WHEN n_nationkey % 3 <> 0 THEN 'class ' || n_regionkey END AS "class", n_name || chr(10) || 'end' AS body FROM nation""")
def side_files(spark: SparkSession, d: str) -> DataFrame:
    """Directories of three text files each; a missing one is null."""
    path = folder(spark)
    for k, name, region in _nations(spark, d):
        writers.text_file(spark, f"{path}/n{k}/SOURCE.txt", f"made by {name}")
        writers.text_file(spark, f"{path}/n{k}/body.txt", f"{name}\nend")
        if k % 3:
            writers.text_file(spark, f"{path}/n{k}/CLASS", f"class {region}")
    return readers.side_files(spark, path)


_WORD_PARTS = r"regexp_extract_all(text, '[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+')"


@query(f"SELECT doc_id, md5(array_to_string(list_transform({_WORD_PARTS}, lambda x: CASE x WHEN 'the' THEN 'THE' WHEN 'la' THEN 'LA' WHEN 'die' THEN '<die>' ELSE x END), '')) AS h FROM documents")
def substituted_words(spark: SparkSession, d: str) -> DataFrame:
    """A substitution file, without empty and identical pairs, over the words of all texts."""
    path = folder(spark)
    writers.text_file(spark, f"{path}/map.json", '{"substitutions": {"the": "THE", "la": "LA", "die": "<die>", "und": "und", "": "x"}}')
    known = readers.substitution_map(spark, path)
    return table(spark, d, "documents").select("doc_id", F.md5(X.substitute_words(F.col("text"), known)).alias("h"))


@query("SELECT 'without' AS given, 0::BIGINT AS n UNION ALL SELECT 'with', count(*)::BIGINT FROM documents")
def optional_inputs(spark: SparkSession, d: str) -> DataFrame:
    """An input that isn't given is an empty table of the same columns."""
    path = folder(spark)
    writers.json_report(table(spark, d, "documents").select("doc_id", "lang"), path)
    count = lambda name, p: readers.optional(spark, p, "doc_id long, lang string").agg(F.count("*").alias("n")).select(F.lit(name).alias("given"), "n")
    return count("without", None).union(count("with", path))


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, NULL, n_chars FROM documents WHERE doc_id % 3 = 0")
def corpora_union(spark: SparkSession, d: str) -> DataFrame:
    """Corpora one behind the other; a column that one lacks is null there."""
    t = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return readers.union_corpora([t.where("doc_id % 2 = 0"), t.where("doc_id % 3 = 0").drop("lang")])


_KIND = "CASE WHEN s_suppkey % 3 = 0 THEN 'primary_collection' ELSE 'periodical' END"


@query(f"SELECT 'primary' AS chosen, s_suppkey AS k FROM supplier WHERE {_KIND} = 'primary_collection' UNION ALL SELECT 'named', s_suppkey FROM supplier WHERE s_suppkey IN (1, 2, 3)")
def selected_books(spark: SparkSession, d: str) -> DataFrame:
    """Primary collections, or the named books whatever they are."""
    k = F.col("s_suppkey")
    books = table(spark, d, "supplier").select(k.alias("k"), k.cast("string").alias("book_id"), F.when(k % 3 == 0, "primary_collection").otherwise("periodical").alias("source_kind"))
    pick = lambda name, t: t.select(F.lit(name).alias("chosen"), "k")
    return pick("primary", readers.select_books(books, primary_only=True)).union(pick("named", readers.select_books(books, ["1", "2", "3"])))


@query("SELECT doc_id FROM documents WHERE doc_id BETWEEN 20 AND 900 ORDER BY doc_id LIMIT 50")
def page_range(spark: SparkSession, d: str) -> DataFrame:
    """Scans of a range, the first fifty of them."""
    return readers.page_range(table(spark, d, "documents").withColumn("scan_page", F.col("doc_id")), 20, 900, 50).select("doc_id")


@query("SELECT doc_id FROM documents WHERE source = 'src1'")
def owner_documents(spark: SparkSession, d: str) -> DataFrame:
    """An owner's rows, hidden ones too."""
    return views.owner_rows(table(spark, d, "documents"), F.col("source") == "src1").select("doc_id")


@query("SELECT d.doc_id, l.quality::VARCHAR AS quality, l.toxic::VARCHAR AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def sidecar_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows with their row of a side table; without one the map is empty."""
    t = readers.keyed_rows(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id", "label")
    return t.select("doc_id", F.try_element_at("label", F.lit("quality")).alias("quality"), F.try_element_at("label", F.lit("toxic")).alias("toxic"))


@query("SELECT 'appended' AS how, doc_id, 2::BIGINT AS n FROM documents UNION ALL SELECT 'forced', doc_id, 1::BIGINT FROM documents")
def corpus_writes(spark: SparkSession, d: str) -> DataFrame:
    """K3: a second append repeats rows, a forced write doesn't."""
    t, path = table(spark, d, "documents").select("doc_id"), folder(spark)
    for how in ("appended", "forced"):
        writers.corpus(t, f"{path}/{how}")
        writers.corpus(t, f"{path}/{how}", force=how == "forced")
    read = lambda how: spark.read.parquet(f"{path}/{how}").groupBy("doc_id").agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "doc_id", "n")
    return read("appended").union(read("forced"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN upper(lang) ELSE lang END AS lang FROM documents UNION ALL SELECT -1, 'new'")
def upserted_rows(spark: SparkSession, d: str) -> DataFrame:
    """K4: a new version of a table, written beside the old one."""
    t, path = table(spark, d, "documents").select("doc_id", "lang"), folder(spark)
    fresh = t.where("doc_id % 4 = 0").withColumn("lang", F.upper("lang")).union(spark.createDataFrame([(-1, "new")], "doc_id long, lang string"))
    writers.upsert(t, fresh, "doc_id", path, dry_run=False)
    return spark.read.parquet(path)


@query("""SELECT '# Regions' || chr(10) || chr(10) || '| key | name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || r_regionkey || ' | a\\|' || r_name || ' |', chr(10) ORDER BY r_regionkey) || chr(10) AS report FROM region""")
def markdown_report(spark: SparkSession, d: str) -> DataFrame:
    """K5: a Markdown table; pipes are escaped."""
    rows = table(spark, d, "region").orderBy("r_regionkey").select(F.col("r_regionkey").alias("key"), F.concat(F.lit("a|"), "r_name").alias("name"))
    return spark.createDataFrame([(reports.markdown(rows, "Regions"),)], "report string")


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey::INTEGER AS region FROM nation WHERE n_regionkey <> 1 OR n_nationkey % 2 = 0")
def replaced_partitions(spark: SparkSession, d: str) -> DataFrame:
    """K7: the partitions that new rows have are replaced as a whole, all others stay."""
    t, path = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("int").alias("region")), folder(spark)
    writers.replace_partition(t, path, "region")
    writers.replace_partition(t.where("region = 1 AND n_nationkey % 2 = 0").withColumn("n_name", F.lower("n_name")), path, "region")
    return spark.read.parquet(path)


@query("SELECT 'profiles' AS option, 'unknown: blurred, sharp' AS error UNION ALL SELECT 'profiles_empty', 'is required'")
def option_errors(spark: SparkSession, d: str) -> DataFrame:
    """V4: checks of options before a run."""
    given = {"profiles": "raw, sharp,blurred", "profiles_empty": " , ", "scope": "all"}
    found = readers.option_errors(given, {"profiles": ("raw", "gray"), "scope": ("books",)}, ("profiles", "profiles_empty"))
    return spark.createDataFrame(found, "option string, error string")


_RULES = "(VALUES (1, 'src1', 10, 'first'), (2, 'src1', NULL, 'any'), (3, 'src2', 20, 'second'), (4, 'src2', 20, 'third')) AS r(o, k, p, note)"


@query(f"""WITH c AS (SELECT doc_id, source, doc_id % 30 AS page FROM documents), m AS (SELECT c.doc_id, r.note, row_number() OVER (PARTITION BY c.doc_id ORDER BY r.o) AS rn FROM c LEFT JOIN {_RULES} ON r.k = c.source AND (r.p IS NULL OR r.p = c.page)) SELECT doc_id, note FROM m WHERE rn = 1""")
def exclusion_notes(spark: SparkSession, d: str) -> DataFrame:
    """Each row with the first rule that fits it."""
    rules = spark.createDataFrame([(1, "src1", 10, "first"), (2, "src1", None, "any"), (3, "src2", 20, "second"), (4, "src2", 20, "third")], "o int, source string, p int, note string")
    c = table(spark, d, "documents").select("doc_id", "source", (F.col("doc_id") % 30).alias("page"))
    fits = F.col("p").isNull() | (F.col("p") == F.col("page"))
    t = joins.best_match(c, rules, ["source"], ["doc_id"], [F.coalesce(fits, F.lit(False)).desc(), F.col("o")])
    return t.select("doc_id", F.when(fits, F.col("note")).alias("note"))


_RUNS = "SELECT doc_id, doc_id % 3 <> 0 AS first, doc_id % 7 = 0 AS changed FROM documents"


def _incremental(spark: SparkSession, d: str) -> tuple[ledger.VersionedTable, list[ledger.Update]]:
    """Three runs over documents: two thirds of them; all, some with other content; all once more."""
    docs, target = table(spark, d, "documents").select("doc_id", "lang", "text"), ledger.VersionedTable(spark, folder(spark))
    changed = docs.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, F.concat("lang", F.lit("!"))).otherwise(F.col("lang")))
    runs = []
    for run, rows in enumerate((docs.where("doc_id % 3 <> 0"), changed, changed), 1):
        made = lambda t, run=run: t.select("doc_id", "lang", F.md5("text").alias("text_md5"), F.lit(run).alias("made_in"))
        runs.append(ledger.append_new(target, rows, ["doc_id"], made))
    return target, runs


@query(f"SELECT doc_id, lang || CASE WHEN changed THEN '!' ELSE '' END AS lang, md5(text) AS text_md5, CASE WHEN first AND NOT changed THEN 1 ELSE 2 END::INTEGER AS made_in FROM ({_RUNS}) JOIN documents USING (doc_id)")
def incremental_corpus(spark: SparkSession, d: str) -> DataFrame:
    """K3, cache-skip: each run works on new and changed rows alone, told by a ledger of content digests."""
    return _incremental(spark, d)[0].read().drop(ledger.LEDGER)


@query(f"""SELECT 1 AS run, 1 AS version, count(*) FILTER (WHERE first)::BIGINT AS fresh, 0::BIGINT AS skipped FROM ({_RUNS}) UNION ALL SELECT 2, 2, count(*) FILTER (WHERE NOT first OR changed), count(*) FILTER (WHERE first AND NOT changed) FROM ({_RUNS}) UNION ALL SELECT 3, 2, 0, count(*) FROM ({_RUNS})""")
def incremental_runs(spark: SparkSession, d: str) -> DataFrame:
    """K3, idempotent re-run: what each run made and skipped; a run without new rows writes no version."""
    runs = _incremental(spark, d)[1]
    return spark.createDataFrame([(i, r.version, r.fresh, r.skipped) for i, r in enumerate(runs, 1)], "run int, version int, fresh long, skipped long")


@query("""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'reviewed' WHEN doc_id % 2 = 0 THEN source ELSE lang END AS edition, CASE WHEN doc_id % 5 = 4 THEN 'missing' WHEN doc_id % 2 = 1 OR doc_id % 6 = 0 THEN 'changed_meanwhile' ELSE 'applied' END AS outcome FROM documents WHERE doc_id % 5 <> 4
UNION ALL SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'reviewed' WHEN doc_id % 2 = 0 THEN 'unknown' ELSE lang END, 'missing' FROM documents WHERE doc_id % 5 = 4""")
def checked_apply(spark: SparkSession, d: str) -> DataFrame:
    """Proposals for documents of unknown edition, applied where the row still is what it was when they were judged; the rest are conflicts."""
    docs, target = table(spark, d, "documents"), ledger.VersionedTable(spark, folder(spark))
    target.commit(lambda _: docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "unknown").otherwise(F.col("lang")).alias("edition")))
    id_ = F.when(F.col("doc_id") % 5 == 4, -1 - F.col("doc_id")).otherwise(F.col("doc_id"))  # some name rows that aren't there
    judged = docs.select(id_.alias("doc_id"), "source", F.lit("unknown").alias("edition")).withColumn("judged_on", ledger.row_digest(["edition"]))
    proposals = judged.select("doc_id", "judged_on", F.col("source").alias("edition"))
    target.commit(lambda t: t.withColumn("edition", F.when(F.col("doc_id") % 6 == 0, "reviewed").otherwise(F.col("edition"))))  # another writer in between
    _, outcome = ledger.checked_update(target, proposals, "doc_id", "judged_on", ["edition"])
    told = outcome.select(F.when(F.col("doc_id") < 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"), "outcome")
    return target.read().join(told, "doc_id")
