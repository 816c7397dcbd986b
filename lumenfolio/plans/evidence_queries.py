"""Queries of evidence ledgers, gates and statuses over candidate rows made up from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audits, evidence, gates, matching, reports
from ..operators import gap_report as gap_report_
from .base import ORACLES, folder, query, table

UNKNOWN = "unknown"
_EV = ("title_match", "first_line_match", "last_line_match", "high_body_coverage", "page_sequence_present", "body_token_overlap")

# A candidate row per document, by arithmetic on its id that both engines do alike.
_ROWS = f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '{UNKNOWN}' WHEN 1 THEN 'B1' WHEN 2 THEN 'B2' ELSE 'B9' END AS edition, CASE doc_id % 4 WHEN 1 THEN 'b1' WHEN 2 THEN 'b2' END AS edition_book,
 CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 < 2 THEN 'b1' WHEN doc_id % 5 < 4 THEN 'b2' ELSE 'b1-copy' END AS candidate_book_id,
 CASE WHEN doc_id % 7 <> 0 AND doc_id % 9 <> 0 THEN (doc_id % 40)::INTEGER END AS printed_page_start, CASE WHEN doc_id % 7 <> 0 AND doc_id % 9 <> 0 THEN (doc_id % 40 + doc_id % 3)::INTEGER END AS printed_page_end,
 CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 6 < 2 THEN 'accepted_candidate' WHEN doc_id % 6 < 4 THEN 'needs_manual_review' ELSE 'ambiguous' END AS status,
 list_filter([{', '.join(f"CASE WHEN doc_id % {k} <> 0 THEN '{e}' END" for k, e in zip((2, 3, 5, 7, 11, 13), _EV, strict=True))}], lambda x: x IS NOT NULL) AS evidence,
 CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 8 = 0 THEN 'best_page_no_line_anchor' ELSE 'line_anchor_cluster' END AS span_basis, (doc_id % 23)::INTEGER AS exact_count, (doc_id % 29)::INTEGER AS line_count, (doc_id % 5)::INTEGER AS anchor_count,
 CASE WHEN doc_id % 6 <> 5 THEN (doc_id % 21) / 2.0 END AS runner_up_gap, (doc_id % 33)::DOUBLE AS score,
 CASE doc_id % 5 WHEN 0 THEN 'source_scan_supported' WHEN 1 THEN 'source_scan_token_only' WHEN 2 THEN 'source_scan_weak' WHEN 3 THEN 'unscanned_source_edition' END AS scan_status, doc_id % 31 = 0 AS excluded FROM documents"""


def candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    mod = lambda n: k % n
    paged = (mod(7) != 0) & (mod(9) != 0)
    return table(spark, d, "documents").select(
        "doc_id",
        F.when(mod(4) == 0, UNKNOWN).when(mod(4) == 1, "B1").when(mod(4) == 2, "B2").otherwise("B9").alias("edition"),
        F.when(mod(4) == 1, "b1").when(mod(4) == 2, "b2").alias("edition_book"),
        F.when(mod(7) == 0, None).when(mod(5) < 2, "b1").when(mod(5) < 4, "b2").otherwise("b1-copy").alias("candidate_book_id"),
        F.when(paged, mod(40).cast("int")).alias("printed_page_start"), F.when(paged, (mod(40) + mod(3)).cast("int")).alias("printed_page_end"),
        F.when(mod(7) == 0, None).when(mod(6) < 2, "accepted_candidate").when(mod(6) < 4, "needs_manual_review").otherwise("ambiguous").alias("status"),
        F.array_compact(F.array(*[F.when(mod(n) != 0, e) for n, e in zip((2, 3, 5, 7, 11, 13), _EV, strict=True)])).alias("evidence"),
        F.when(mod(7) == 0, None).when(mod(8) == 0, "best_page_no_line_anchor").otherwise("line_anchor_cluster").alias("span_basis"),
        mod(23).cast("int").alias("exact_count"), mod(29).cast("int").alias("line_count"), mod(5).cast("int").alias("anchor_count"),
        F.when(mod(6) != 5, mod(21) / 2.0).alias("runner_up_gap"), mod(33).cast("double").alias("score"),
        F.when(mod(5) == 0, "source_scan_supported").when(mod(5) == 1, "source_scan_token_only").when(mod(5) == 2, "source_scan_weak").when(mod(5) == 3, "unscanned_source_edition").alias("scan_status"),
        (mod(31) == 0).alias("excluded"),
    )


def scored_rows(spark: SparkSession, d: str) -> DataFrame:
    book = F.when(F.col("candidate_book_id") == "b1-copy", "b1").otherwise(F.col("candidate_book_id"))
    t = evidence.ledger(candidate_rows(spark, d).withColumn("candidate_book", book), UNKNOWN)
    return t.withColumn("blockers", evidence.blockers()).withColumn("action", evidence.next_action())


_ALIGN = f"CASE WHEN candidate_book IS NULL THEN 'no_candidate_book' WHEN edition = '{UNKNOWN}' THEN 'unknown_source' WHEN edition_book IS NULL THEN 'unmapped_source' WHEN candidate_book = edition_book THEN 'same_source_book' ELSE 'source_conflict' END"
_B = f"SELECT *, {_ALIGN} AS alignment FROM (SELECT *, CASE WHEN candidate_book_id = 'b1-copy' THEN 'b1' ELSE candidate_book_id END AS candidate_book FROM ({_ROWS}))"
_HAS = "list_contains(evidence, '{}')"
_FACTORS = f"""SELECT *, CASE WHEN excluded THEN -8.0 ELSE 0 END AS w1, CASE WHEN edition = '{UNKNOWN}' THEN -0.9 WHEN edition_book IS NULL THEN -0.6 ELSE 0.8 END + CASE alignment WHEN 'same_source_book' THEN 1.8 WHEN 'unmapped_source' THEN -0.4 WHEN 'source_conflict' THEN -2.2 ELSE 0 END AS w2,
 CASE WHEN printed_page_start IS NOT NULL THEN 1.2 WHEN status IS NOT NULL THEN -2.0 ELSE 0 END + CASE WHEN {_HAS.format('page_sequence_present')} THEN 0.9 ELSE 0 END AS w3,
 CASE WHEN span_basis = 'line_anchor_cluster' THEN 1.6 WHEN span_basis IS NOT NULL THEN -0.9 ELSE 0 END + least(2.4, 0.45 * exact_count) + least(1.4, 0.18 * line_count) + CASE WHEN {_HAS.format('title_match')} THEN 0.8 ELSE 0 END + CASE WHEN {_HAS.format('first_line_match')} THEN 1.1 ELSE 0 END + CASE WHEN {_HAS.format('last_line_match')} THEN 0.7 ELSE 0 END + CASE WHEN {_HAS.format('high_body_coverage')} THEN 0.7 ELSE 0 END AS w4,
 CASE WHEN runner_up_gap IS NULL THEN 0 WHEN runner_up_gap >= 4 THEN 0.7 WHEN runner_up_gap >= 1 THEN 0.25 ELSE -0.7 END AS w5, CASE coalesce(status, 'no_candidate') WHEN 'accepted_candidate' THEN 1.4 WHEN 'needs_manual_review' THEN 0.2 WHEN 'ambiguous' THEN -0.8 ELSE -2.5 END AS w6,
 CASE scan_status WHEN 'source_scan_supported' THEN 1.5 WHEN 'source_scan_token_only' THEN 0.4 WHEN 'source_scan_weak' THEN -0.7 WHEN 'unscanned_source_edition' THEN -0.8 ELSE 0 END AS w7 FROM ({_B})"""
_SCORED = f"SELECT *, (-3.0 + w1 + w2 + w3 + w4 + w5 + w6 + w7)::DOUBLE AS log_odds FROM ({_FACTORS})"


@query(f"SELECT doc_id, alignment, round(log_odds, 6) AS log_odds, round(1.0 / (1.0 + exp(-log_odds)), 6) AS posterior FROM ({_SCORED})")
def factor_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Log odds and posterior of every candidate."""
    return scored_rows(spark, d).select("doc_id", "alignment", F.round("log_odds", 6).alias("log_odds"), F.round("posterior", 6).alias("posterior"))


@query(f"""WITH t AS ({_SCORED}), b AS (SELECT doc_id, list_filter([CASE WHEN excluded THEN 'reviewed_negative' END, CASE WHEN status IS NULL THEN 'no_candidate' END, CASE WHEN printed_page_start IS NULL THEN 'no_printed_page' END, CASE WHEN span_basis IS DISTINCT FROM 'line_anchor_cluster' THEN 'no_line_anchor_cluster' END, CASE WHEN exact_count = 0 THEN 'no_exact_line_anchor' END,
 CASE WHEN alignment = 'source_conflict' THEN 'source_conflict' END, CASE WHEN alignment = 'unknown_source' THEN 'unknown_source_collection' END, CASE WHEN scan_status = 'unscanned_source_edition' THEN 'missing_source_corpus' END], lambda x: x IS NOT NULL) AS b, 1.0 / (1.0 + exp(-log_odds)) AS p, alignment FROM t)
SELECT doc_id, array_to_string(b, ',') AS blockers, CASE WHEN list_contains(b, 'reviewed_negative') THEN 'keep_excluded' WHEN list_contains(b, 'missing_source_corpus') THEN 'add_or_review_source_corpus' WHEN list_contains(b, 'no_candidate') THEN 'needs_better_text_extraction' WHEN list_contains(b, 'unknown_source_collection') AND p >= 0.65 THEN 'manual_collection_review'
 WHEN list_contains(b, 'source_conflict') THEN 'manual_source_conflict_review' WHEN p >= 0.72 AND NOT list_contains(b, 'no_line_anchor_cluster') AND NOT list_contains(b, 'no_printed_page') THEN 'manual_printed_page_review' WHEN alignment = 'unknown_source' THEN 'identify_collection' ELSE 'needs_stronger_text_anchors' END AS action FROM b""")
def next_actions(spark: SparkSession, d: str) -> DataFrame:
    """C18, C19."""
    return scored_rows(spark, d).select("doc_id", F.array_join("blockers", ",").alias("blockers"), "action")


_STAGES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(evidence.STAGES, 1))


@query(f"""WITH t AS ({_FACTORS}), s AS (SELECT doc_id, unnest([1, 2, 3, 4, 5, 6, 7]) AS i, unnest([w1, w2, w3, w4, w5, w6, w7])::DOUBLE AS w, unnest([excluded, true, printed_page_start IS NOT NULL OR status IS NOT NULL OR list_contains(evidence, 'page_sequence_present'), span_basis IS NOT NULL OR exact_count > 0 OR line_count > 0 OR list_contains(evidence, 'title_match') OR list_contains(evidence, 'first_line_match') OR list_contains(evidence, 'last_line_match') OR list_contains(evidence, 'high_body_coverage'), runner_up_gap IS NOT NULL, true, true]) AS has FROM t),
n AS (SELECT s.*, name FROM s JOIN (VALUES {_STAGES}) AS v(k, name) ON s.i = v.k WHERE has) SELECT doc_id, name AS stage, round(w, 6) AS delta, round(-3.0 + sum(w) OVER (PARTITION BY doc_id ORDER BY i), 6) AS log_odds_after FROM n""")
def stage_updates(spark: SparkSession, d: str) -> DataFrame:
    """Running log odds by stage."""
    return evidence.stage_updates(scored_rows(spark, d), "doc_id").select("doc_id", "stage", F.round("delta", 6).alias("delta"), F.round("log_odds_after", 6).alias("log_odds_after"))


def _case(column: str, values: dict[str, float], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


# One row a factor: its stage and weight, null where a candidate doesn't have it.
_WEIGHTS = [
    ("human_review", "CASE WHEN excluded THEN -8.0 END"),
    ("source_prior", f"CASE WHEN edition = '{UNKNOWN}' THEN -0.9 WHEN edition_book IS NULL THEN -0.6 ELSE 0.8 END"),
    ("source_prior", f"CASE WHEN candidate_book IS NOT NULL THEN {_case('alignment', evidence.ALIGNMENT, '0.0')} END"),
    ("page_sequence_repair", "CASE WHEN printed_page_start IS NOT NULL THEN 1.2 WHEN status IS NOT NULL THEN -2.0 END"),
    ("page_sequence_repair", "CASE WHEN list_contains(evidence, 'page_sequence_present') THEN 0.9 END"),
    ("text_alignment", "CASE WHEN span_basis = 'line_anchor_cluster' THEN 1.6 WHEN span_basis IS NOT NULL THEN -0.9 END"),
    ("text_alignment", "CASE WHEN exact_count > 0 THEN least(2.4, 0.45 * exact_count) END"),
    ("text_alignment", "CASE WHEN line_count > 0 THEN least(1.4, 0.18 * line_count) END"),
    *[("text_alignment", f"CASE WHEN list_contains(evidence, '{e}') THEN {w} END") for e, w in evidence.EVIDENCE.items()],
    ("competition", "CASE WHEN runner_up_gap >= 4 THEN 0.7 WHEN runner_up_gap >= 1 THEN 0.25 WHEN runner_up_gap IS NOT NULL THEN -0.7 END"),
    ("candidate_generation", _case("coalesce(status, 'no_candidate')", evidence.STATUS, "-0.5")),
    ("corpus_coverage", _case("coalesce(scan_status, 'not_applicable')", evidence.SCAN, "-0.2")),
]


@query("WITH f AS (" + " UNION ALL ".join(f"SELECT '{stage}' AS stage, ({w})::DOUBLE AS w FROM ({_B})" for stage, w in _WEIGHTS) + """)
SELECT stage, round(sum(w), 6) AS total, count(*) FILTER (WHERE w > 0)::BIGINT AS positive, count(*) FILTER (WHERE w < 0)::BIGINT AS negative FROM f WHERE w IS NOT NULL GROUP BY stage""")
def stage_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals and signs by stage."""
    return evidence.stage_totals(scored_rows(spark, d)).withColumn("total", F.round("total", 6))


@query(f"""SELECT doc_id, CASE WHEN excluded THEN 'reviewed_negative' WHEN status IS NULL THEN 'no_candidate' WHEN printed_page_start IS NULL THEN 'missing_printed_page' WHEN alignment = 'source_conflict' THEN 'source_conflict' WHEN alignment = 'unknown_source' THEN 'unknown_collection' WHEN status = 'ambiguous' THEN 'ambiguous_candidate' WHEN status = 'accepted_candidate' THEN 'ready_for_review' ELSE 'manual_review' END AS bucket,
 least(line_count, 10) + CASE WHEN list_contains(evidence, 'title_match') THEN 3 ELSE 0 END + CASE WHEN list_contains(evidence, 'high_body_coverage') THEN 2 ELSE 0 END AS evidence_score FROM ({_B})""")
def gap_buckets(spark: SparkSession, d: str) -> DataFrame:
    """C16, C17."""
    t = scored_rows(spark, d)
    paged = F.col("printed_page_start").isNotNull()
    bucket = evidence.review_bucket(F.when(F.col("excluded"), "reviewed_negative"), F.col("status"), paged, F.col("alignment"))
    flags = {e: F.array_contains("evidence", e) for e in ("title_match", "high_body_coverage")}
    return t.select("doc_id", bucket.alias("bucket"), evidence.evidence_score(flags, {"title_match": 3, "high_body_coverage": 2}, F.col("line_count")).alias("evidence_score"))


@query(f"""WITH t AS (SELECT *, 1.0 / (1.0 + exp(-log_odds)) AS p FROM ({_SCORED})), b AS (SELECT doc_id, edition, CASE WHEN scan_status = 'unscanned_source_edition' THEN 'acquire_source_scan' WHEN NOT excluded AND status IS NULL THEN 'improve_text_extraction' WHEN NOT excluded AND printed_page_start IS NOT NULL AND alignment = 'unknown_source' THEN 'identify_collection' WHEN p >= 0.72 THEN 'review_printed_page' ELSE 'review_alignment' END AS action FROM t)
SELECT edition, action, count(*)::BIGINT AS n FROM b GROUP BY edition, action""")
def manifest_actions(spark: SparkSession, d: str) -> DataFrame:
    """M25, C26, A15, A16."""
    t = scored_rows(spark, d)
    bucket = evidence.review_bucket(F.when(F.col("excluded"), "reviewed_negative"), F.col("status"), F.col("printed_page_start").isNotNull(), F.col("alignment"))
    action = evidence.acquisition_action(bucket, F.coalesce("scan_status", F.lit("")), F.col("posterior"))
    return t.select("edition", action.alias("action")).groupBy("edition", "action").agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT doc_id, doc_id % 4 <> 0 AS known, doc_id % 6 AS pages, doc_id % 4 AS exact, (doc_id % 10) / 20.0 AS coverage, doc_id % 2 = 0 AS title FROM documents)
SELECT doc_id, CASE WHEN NOT known THEN NULL WHEN pages = 0 THEN 'unscanned_source_edition' WHEN exact >= 2 OR (exact >= 1 AND title) THEN 'source_scan_supported' WHEN coverage >= 0.35 THEN 'source_scan_token_only' WHEN coverage >= 0.18 THEN 'source_scan_weak' ELSE 'source_scan_no_support' END AS status FROM t""")
def scan_statuses(spark: SparkSession, d: str) -> DataFrame:
    """C15."""
    k = F.col("doc_id")
    return table(spark, d, "documents").select("doc_id", evidence.scan_status(k % 4 != 0, k % 6, k % 4, (k % 10) / 20.0, k % 2 == 0).alias("status"))


#: The driver's rows fire most gates; one made-up row for each gate, which holds just what it asks for, fires the others.
_GATE_COLUMNS = (
    "doc_id bigint, edition string, candidate_book_id string, printed_page_start int, printed_page_end int, status string, evidence array<string>, span_basis string, span_exact_line_match_count int, span_line_match_count int, "
    "span_anchor_count int, runner_up_gap double, score double, book_title string, is_alias boolean, has_marker boolean, has_reference boolean, outside_corpus boolean, pages_exist boolean, has_existing_source boolean"
)


def _row_of(i: int, g: gates.Gate) -> tuple:
    book, title = ("b2", "B2") if g.single_book else ("b1-copy", "B1") if g.alias else ("b1", "B1")
    edition = {"same": title, "unknown": UNKNOWN, "different": "B9"}[g.edition]
    end = 5 if g.pages == "single" or g.anchors == "one" else 6
    anchors = 1 if g.anchors in ("one", "some") else 2
    status = next((x for x in g.status if x != gates.ACCEPTED), g.status[0])
    return (-1 - i, edition, book, 5, end, status, [*g.evidence, *g.one_of[-1:]], "line_anchor_cluster", g.exact, g.lines, anchors, None if g.gap is None else float(g.gap), float(g.score), title, bool(g.alias), g.marker, g.reference, g.outside, True, False)


_MADE = [_row_of(i, g) for i, g in enumerate((*gates.OVERRIDES, *gates.REVIEWED))]
_MADE.append((-1000, "B1", "b7", 5, 6, gates.ACCEPTED, ["title_match"], "line_anchor_cluster", 3, 9, 2, 5.0, 30.0, None, False, False, False, False, True, False))


def _sql_value(v: object) -> str:
    if isinstance(v, list):
        return "[" + ", ".join(map(_sql_value, v)) + "]"
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else repr(v)


def gate_rows(spark: SparkSession, d: str) -> DataFrame:
    k, b = F.col("doc_id"), F.col("candidate_book_id")
    t = candidate_rows(spark, d).withColumnRenamed("exact_count", "span_exact_line_match_count").withColumnRenamed("line_count", "span_line_match_count").withColumnRenamed("anchor_count", "span_anchor_count")
    t = t.withColumns({
        "book_title": F.when(b.isin("b1", "b1-copy"), "B1").when(b == "b2", "B2"), "is_alias": F.coalesce(b == "b1-copy", F.lit(False)),
        "has_marker": k % 3 == 0, "has_reference": k % 4 == 0, "outside_corpus": k % 5 != 0, "pages_exist": k % 19 != 0, "has_existing_source": k % 2 == 0,
    })
    made = spark.createDataFrame(_MADE, _GATE_COLUMNS)
    return t.select(*made.columns).unionByName(made)


_TABLE_ROWS = f"SELECT *, CASE WHEN candidate_book_id IN ('b1', 'b1-copy') THEN 'B1' WHEN candidate_book_id = 'b2' THEN 'B2' END AS book_title, coalesce(candidate_book_id = 'b1-copy', false) AS is_alias, doc_id % 3 = 0 AS has_marker, doc_id % 4 = 0 AS has_reference, doc_id % 5 <> 0 AS outside_corpus, doc_id % 19 <> 0 AS pages_exist, doc_id % 2 = 0 AS has_existing_source FROM ({_ROWS})"
_GATE_NAMES = "doc_id, edition, candidate_book_id, printed_page_start, printed_page_end, status, evidence, span_basis, exact_count, line_count, anchor_count, runner_up_gap, score, book_title, is_alias, has_marker, has_reference, outside_corpus, pages_exist, has_existing_source"
_GATE_ROWS = f"SELECT {_GATE_NAMES} FROM ({_TABLE_ROWS}) UNION ALL SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(_sql_value, r)) + ")" for r in _MADE) + ")"
_SPAN_SQL = "coalesce(span_basis = 'line_anchor_cluster' AND anchor_count > 0 AND (exact_count > 0 OR line_count >= 2) AND printed_page_start IS NOT NULL AND (printed_page_end - printed_page_start + 1 < 5 OR anchor_count >= printed_page_end - printed_page_start + 1), false)"


def gate_sql(g: gates.Gate) -> str:
    """A gate as SQL over the same columns."""
    span = "(printed_page_end - printed_page_start + 1)"
    parts = [f"status IN ({', '.join(repr(s) for s in g.status)})", "printed_page_start IS NOT NULL", "printed_page_end IS NOT NULL"]
    parts.append({"same": "edition = book_title", "unknown": f"edition = '{UNKNOWN}'", "different": f"edition <> book_title AND edition <> '{UNKNOWN}'"}[g.edition])
    parts.append({"any": "true", "ordered": "printed_page_end >= printed_page_start", "single": "printed_page_end = printed_page_start", "several": "printed_page_end > printed_page_start"}[g.pages])
    parts.append({"": "true", "two": f"anchor_count >= least({span}, 2)", "span": f"anchor_count >= {span}", "one": "anchor_count = 1", "some": "anchor_count >= 1"}[g.anchors])
    parts += ["span_basis = 'line_anchor_cluster'"] * g.cluster + [f"list_contains(evidence, '{e}')" for e in g.evidence]
    parts += ["(" + " OR ".join(f"list_contains(evidence, '{e}')" for e in g.one_of) + ")"] if g.one_of else []
    parts += [f"score >= {g.score}", f"line_count >= {g.lines}", f"exact_count >= {g.exact}"]
    parts += [f"coalesce(runner_up_gap >= {g.gap}, {str(g.gap_null).lower()})"] if g.gap is not None else []
    parts += [f"is_alias = {str(g.alias).lower()}"] if g.alias is not None else []
    parts += ["candidate_book_id = 'b2'"] * g.single_book + [_SPAN_SQL] * g.span_evidence + ["has_marker"] * g.marker + ["has_reference"] * g.reference + ["outside_corpus"] * g.outside
    return " AND ".join(f"({p})" for p in parts)


_REASONS = " ".join(
    ["CASE WHEN printed_page_start IS NULL THEN 'missing_printed_page' WHEN book_title IS NULL THEN 'unknown_candidate_book' WHEN NOT pages_exist THEN 'candidate_pages_not_in_corpus'"]
    + [f"WHEN {gate_sql(g)} THEN 'eligible_{g.reason}'" for g in gates.OVERRIDES]
    + ["WHEN is_alias AND has_existing_source THEN 'alias_existing_source'"]
    + [f"WHEN status <> 'accepted_candidate' AND {gate_sql(g)} THEN 'eligible_{g.reason}'" for g in gates.REVIEWED]
    + [f"WHEN status <> 'accepted_candidate' THEN 'not_accepted' WHEN NOT {_SPAN_SQL} THEN 'missing_span_anchor_evidence' WHEN edition <> '{UNKNOWN}' AND edition <> book_title THEN 'known_collection_conflict' ELSE 'eligible' END"]
)


@query(f"SELECT doc_id, {_REASONS} AS reason FROM ({_GATE_ROWS})")
def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The rule engine: the first gate that holds, for every candidate."""
    return gates.dispatch(gate_rows(spark, d), UNKNOWN, "b2").select("doc_id", "reason")


_FILLED = f"CASE WHEN edition = '{UNKNOWN}' THEN {{}} END"


@query(f"""WITH r AS (SELECT *, {_REASONS} AS reason FROM ({_GATE_ROWS})) SELECT doc_id, reason, CASE WHEN edition = '{UNKNOWN}' THEN book_title ELSE edition END AS edition, {_FILLED.format("1954")}::INTEGER AS source_year, {_FILLED.format("'late'")} AS phase_id,
 '[{{"role":"primary","title_bn":"' || book_title || '","page_start":' || printed_page_start || ',"page_end":' || printed_page_end || '}}]' AS sources FROM r WHERE starts_with(reason, 'eligible')""")
def gated_upsert(spark: SparkSession, d: str) -> DataFrame:
    """K4: the new version of the records that the gates let through."""
    t = gates.dispatch(gate_rows(spark, d), UNKNOWN, "b2").withColumns({"book_year": F.lit(1954), "book_phase": F.lit("late"), "source_year": F.lit(None).cast("int"), "phase_id": F.lit(None).cast("string"), "book_sources": F.lit(None).cast("array<struct<role:string,title_bn:string,page_start:int,page_end:int>>")})
    out = gates.apply_plan(t, UNKNOWN)
    return out.select("doc_id", "reason", "edition", "source_year", "phase_id", F.to_json("book_sources").alias("sources"))


_LEAD = "coalesce(runner_up_gap >= {}, true)"


@query(f"""WITH t AS (SELECT *, list_contains(evidence, 'first_line_match') OR list_contains(evidence, 'last_line_match') OR list_contains(evidence, 'high_body_coverage') AS strong, anchor_count > 0 AND (exact_count > 0 OR line_count >= 2) AND printed_page_start IS NOT NULL AS base FROM ({_ROWS}))
SELECT doc_id, CASE WHEN runner_up_gap < 4 THEN 'ambiguous' WHEN base AND ((score >= 18 AND list_contains(evidence, 'title_match') AND strong AND {_LEAD.format(4)}) OR (score >= 24 AND strong AND {_LEAD.format(6)}) OR (score >= 24 AND list_contains(evidence, 'high_body_coverage') AND line_count >= 12 AND exact_count >= 6 AND {_LEAD.format(4)})) THEN 'accepted_candidate' ELSE 'needs_manual_review' END AS status FROM t""")
def span_statuses(spark: SparkSession, d: str) -> DataFrame:
    """C9."""
    t = candidate_rows(spark, d)
    paged = F.col("printed_page_start").isNotNull()
    return t.select("doc_id", matching.span_status(F.col("score"), F.col("evidence"), F.col("anchor_count"), F.col("line_count"), F.col("exact_count"), paged, F.col("runner_up_gap")).alias("status"))


@query("""WITH t AS (SELECT doc_id AS k, doc_id % 9 <> 0 AS paged, doc_id % 7 AS longest, doc_id % 5 AS run, doc_id % 4 AS exact, doc_id % 8 AS lines, doc_id % 6 AS pages, doc_id % 3 = 0 AS unknown, (doc_id % 101) / 100.0 AS score, (doc_id % 13) / 100.0 AS gap, CASE WHEN doc_id % 2 = 0 THEN 'title' ELSE 'body_line' END AS basis, doc_id % 10 = 0 AS dup, doc_id % 15 = 0 AS conflict FROM documents)
SELECT k AS doc_id, CASE WHEN NOT paged THEN 'needs_printed_page_sequence' WHEN longest < 3 OR run < 2 THEN 'weak_fuzzy_review' WHEN exact >= 2 OR (exact >= 1 AND lines >= 6 AND longest >= 4 AND pages <= 3) THEN 'strong_fuzzy_review' WHEN unknown AND lines >= 4 THEN 'manual_collection_review' ELSE 'weak_fuzzy_review' END AS fuzzy,
 CASE WHEN NOT paged THEN 'needs_printed_page_sequence' WHEN exact >= 2 AND run >= 3 THEN 'strong_ordered_review' WHEN exact >= 1 AND run >= 3 AND lines >= 5 AND pages <= 3 THEN 'manual_ordered_review' WHEN unknown AND exact >= 1 AND lines >= 4 THEN 'manual_collection_review' ELSE 'weak_ordered_review' END AS ordered,
 CASE WHEN NOT paged THEN 'needs_page_sequence' WHEN dup AND basis = 'title' THEN 'duplicate_title_conflict' WHEN conflict THEN 'known_source_conflict' WHEN basis = 'body_line' AND NOT unknown AND score >= 0.985 AND gap >= 0.025 THEN 'strong_toc_line_review' WHEN basis = 'body_line' AND NOT unknown AND score >= 0.93 AND gap >= 0.04 THEN 'manual_toc_line_review' WHEN basis = 'body_line' THEN 'weak_toc_line_review'
 WHEN score >= 0.985 AND gap >= 0.025 THEN 'strong_toc_review' WHEN score >= 0.93 AND gap >= 0.04 THEN 'manual_toc_review' ELSE 'weak_toc_review' END AS toc FROM t""")
def review_statuses(spark: SparkSession, d: str) -> DataFrame:
    """C10, C11, C12."""
    k = F.col("doc_id")
    m = lambda n: k % n
    paged, unknown = m(9) != 0, m(3) == 0
    basis: Column = F.when(m(2) == 0, "title").otherwise("body_line")
    return table(spark, d, "documents").select(
        "doc_id", matching.fuzzy_status(paged, m(7), m(5), m(4), m(8), m(6), unknown).alias("fuzzy"), matching.ordered_status(paged, m(5), m(4), m(8), m(6), unknown).alias("ordered"),
        matching.toc_status(paged, m(10) == 0, basis, m(15) == 0, unknown, m(101) / 100.0, m(13) / 100.0).alias("toc"),
    )


@query("""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'A' ELSE 'B' END AS m, CASE doc_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'A' WHEN 2 THEN 'B' END AS e, doc_id % 5 AS lines, doc_id % 10 // 7 AS strong FROM documents)
SELECT doc_id, CASE WHEN m IS NULL THEN 'no_marker' WHEN e = 'unknown' THEN 'unknown_edition_marker' WHEN m = e THEN 'match' ELSE 'conflict' END AS marker_status, CASE WHEN m IS NOT NULL AND e IS NOT NULL AND e <> 'unknown' AND e <> m THEN m || '/' || e END AS clash, CASE WHEN lines = 0 THEN 'no_date_evidence' WHEN strong > 0 THEN 'strong_date_review' ELSE 'date_review' END AS date_status FROM t""")
def marker_statuses(spark: SparkSession, d: str) -> DataFrame:
    """C21, C22, C27."""
    k = F.col("doc_id")
    m, e = F.when(k % 3 == 1, "A").when(k % 3 == 2, "B"), F.when(k % 4 == 0, UNKNOWN).when(k % 4 == 1, "A").when(k % 4 == 2, "B")
    clash = audits.marker_conflict(m, e, UNKNOWN)
    return table(spark, d, "documents").select("doc_id", audits.marker_status(m, e, UNKNOWN).alias("marker_status"), F.concat_ws("/", clash["marker"], clash["edition"]).alias("c"), audits.date_status(k % 5, F.floor((k % 10) / 7)).alias("date_status")).select("doc_id", "marker_status", F.when(F.col("c") != "", F.col("c")).alias("clash"), "date_status")


@query(f"""WITH t AS (SELECT *, CASE WHEN candidate_book_id = 'b1-copy' THEN 'b1' ELSE candidate_book_id END AS canon, CASE doc_id % 2 WHEN 0 THEN 'b1' ELSE 'b2' END AS book, (doc_id % 40)::INTEGER + CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS cs, CASE WHEN doc_id % 5 < 3 THEN 'weak_current_citation' ELSE 'supported' END AS st FROM ({_ROWS}))
SELECT doc_id, CASE WHEN canon = book AND candidate_book_id = book AND st = 'weak_current_citation' THEN 'safe_same_book_repair_candidate' WHEN canon = book AND candidate_book_id <> book THEN 'alias_alternate_page_evidence' WHEN canon = book THEN 'canonical_book_page_conflict' ELSE 'different_collection_candidate' END AS repair_status FROM t
WHERE status = 'accepted_candidate' AND span_basis = 'line_anchor_cluster' AND anchor_count >= 1 AND line_count >= 3 AND exact_count >= 1 AND list_contains(evidence, 'page_sequence_present') AND printed_page_start IS NOT NULL AND NOT (printed_page_start = cs AND printed_page_end = cs)""")
def repair_audit(spark: SparkSession, d: str) -> DataFrame:
    """M21, C14, J24."""
    k = F.col("doc_id")
    start = (k % 40).cast("int") + F.when(k % 3 == 0, 0).otherwise(1)
    cites = table(spark, d, "documents").select(k.alias("citation_id"), F.when(k % 2 == 0, "b1").otherwise("b2").alias("book"), start.alias("page_start"), start.alias("page_end"), F.when(k % 5 < 3, "weak_current_citation").otherwise("supported").alias("status"))
    c = candidate_rows(spark, d).select(F.col("doc_id").alias("citation_id"), F.col("candidate_book_id").alias("candidate_book"), F.when(F.col("candidate_book_id") == "b1-copy", "b1").otherwise(F.col("candidate_book_id")).alias("candidate_canonical"), F.col("printed_page_start").alias("candidate_start"), F.col("printed_page_end").alias("candidate_end"), F.col("status").alias("candidate_status"), "span_basis", F.col("anchor_count").alias("span_anchor_count"), F.col("line_count").alias("span_line_match_count"), F.col("exact_count").alias("span_exact_line_match_count"), "evidence")
    return audits.repair_audit(cites, c, ("weak_current_citation",)).select(F.col("citation_id").alias("doc_id"), "repair_status")


_BY = "SELECT '{0}' AS category, {1} AS priority, {2}::VARCHAR AS grp, count(*)::BIGINT AS n FROM {3} GROUP BY {2}"


@query(f"""WITH b AS ({ORACLES['gap_buckets']}), a AS ({ORACLES['next_actions']}), r AS ({_B}) """ + " UNION ALL ".join(_BY.format(*x) for x in (("bucket", 1, "bucket", "b"), ("action", 2, "action", "a"), ("edition", 3, "edition", "r"), ("alignment", 4, "alignment", "r"), ("status", 5, "status", "r"))))
def gap_report(spark: SparkSession, d: str) -> DataFrame:
    """The gap relation with its bucket, score, posterior and action, and the backlog by category."""
    t = scored_rows(spark, d)
    bucket = evidence.review_bucket(F.when(F.col("excluded"), "reviewed_negative"), F.col("status"), F.col("printed_page_start").isNotNull(), F.col("alignment"))
    rows = t.withColumn("bucket", bucket)
    by = lambda c: rows.groupBy(F.col(c).alias("grp")).agg(F.count("*").alias("n"))
    return reports.backlog([("bucket", 1, by("bucket")), ("action", 2, by("action")), ("edition", 3, by("edition")), ("alignment", 4, by("alignment")), ("status", 5, by("status"))])


#: Records of the gap report: documents as public texts, their state by arithmetic on the id.
_RECORDS = f"""SELECT doc_id AS key, 'text ' || lang || CASE WHEN doc_id % 9 = 0 THEN ' 19' || (10 + doc_id % 80) ELSE '' END AS title, CASE WHEN doc_id % 4 = 0 THEN '{UNKNOWN}' WHEN doc_id % 11 <> 0 THEN source END AS edition, CASE WHEN doc_id % 5 <> 0 THEN 1900 + doc_id % 50 END AS source_year,
 doc_id % 3 = 0 AS paged, doc_id % 6 = 0 AS book_year_known, CASE WHEN doc_id % 7 = 0 THEN '1930' WHEN doc_id % 7 = 1 THEN '' END AS composition_date, CASE doc_id % 13 WHEN 0 THEN 'reviewed_negative' WHEN 1 THEN 'no_candidate' WHEN 2 THEN 'token_or_title_only_candidate' ELSE 'line_match_review' END AS bucket, (doc_id % 23)::INTEGER AS score,
 CASE doc_id % 8 WHEN 0 THEN 'unscanned_source_edition' WHEN 1 THEN 'no_source_scan_pages' WHEN 2 THEN 'source_scan_weak' WHEN 3 THEN 'source_scan_no_support' WHEN 4 THEN 'source_scan_supported' WHEN 5 THEN 'source_scan_token_only' END AS scan_status, doc_id % 13 = 0 AS excluded, doc_id % 17 = 0 AS clash, CASE WHEN doc_id % 10 < 3 THEN 'strong_toc_review' WHEN doc_id % 10 = 3 THEN 'weak_toc_review' END AS toc_status, doc_id % 20 = 3 AS toc_excluded FROM documents"""
_MISSING_CITES = "SELECT doc_id AS key, 'text ' || lang AS title, source AS edition, CASE WHEN doc_id % 19 = 0 THEN 'missing_book_corpus' ELSE 'supported' END AS status FROM documents"
_GROUP = "SELECT *, {2} AS o FROM (SELECT '{0}' AS relation, {1} AS status, coalesce(edition, '') AS edition, count(*)::BIGINT AS n, list_sort(list(key::VARCHAR))[1:12] AS items FROM {3} WHERE {4} GROUP BY ALL)"
_EACH = "SELECT '{0}' AS relation, {1} AS status, coalesce(edition, '') AS edition, 1::BIGINT AS n, [key::VARCHAR] AS items, {2} AS o FROM r WHERE {3}"
_KIND = f"CASE WHEN edition = '{UNKNOWN}' THEN 'unknown_source_collection' WHEN scan_status IN ('unscanned_source_edition', 'no_source_scan_pages') THEN 'missing_source_corpus_for_uncited_poems' WHEN scan_status IN ('source_scan_weak', 'source_scan_no_support') AND starts_with(bucket, 'reviewed_') THEN 'reviewed_scanned_source_gap/' || scan_status || '/' || bucket WHEN scan_status IN ('source_scan_weak', 'source_scan_no_support') THEN 'scanned_source_needs_better_extraction/' || scan_status END"
_URGENCY = "CASE split_part({0}, '/', 1) WHEN 'missing_corpus_for_existing_citations' THEN 1 WHEN 'missing_source_corpus_for_uncited_poems' THEN 2 WHEN 'scanned_source_needs_better_extraction' THEN 3 WHEN 'reviewed_scanned_source_gap' THEN 4 ELSE 5 END"
_SORT = lambda *x: "row(" + ", ".join(x) + ")::STRUCT(a INTEGER, b INTEGER, c INTEGER, d BIGINT, e VARCHAR, f VARCHAR, g VARCHAR, h VARCHAR)"
_BY_COUNT = _SORT("0", "0", "0", "-n", "edition", "''", "''", "''")
_BY_KEY = _SORT("0", "0", "0", "0", "''", "''", "''", "key::VARCHAR")
_RELATIONS = " UNION ALL ".join([
    f"SELECT relation, status, edition, n, items, {_SORT(_URGENCY.format('status'), '0', '0', '-n', 'edition', chr(39) * 2, 'status', chr(39) * 2)} AS o FROM (SELECT 'source_corpus_backlog' AS relation, status, coalesce(edition, '') AS edition, count(*)::BIGINT AS n, list_sort(list(key::VARCHAR))[1:12] AS items FROM (SELECT key, edition, {_KIND} AS status FROM r WHERE NOT paged UNION ALL SELECT key, edition, 'missing_corpus_for_existing_citations' FROM cites WHERE status = 'missing_book_corpus') WHERE status IS NOT NULL GROUP BY 2, 3)",
    _GROUP.format("source_coverage_blockers", "coalesce(scan_status, 'not_applicable')", _SORT("(status <> 'unscanned_source_edition')::INTEGER", "0", "0", "0", "edition", "''", "status", "''"), "r", f"NOT paged AND edition <> '' AND edition <> '{UNKNOWN}' AND coalesce(scan_status, '') NOT IN ('source_scan_supported', 'source_scan_token_only')"),
    _EACH.format("toc_index_blockers", "toc_status", _BY_KEY, "toc_status IS NOT NULL AND NOT toc_excluded"), _EACH.format("toc_index_reviewed_exclusions", "toc_status", _BY_KEY, "toc_status IS NOT NULL AND toc_excluded"),
    _GROUP.format("source_year_blockers", "NULL", _BY_COUNT, "r", "source_year IS NULL"), _GROUP.format("primary_printed_book_year_blockers", "NULL", _BY_COUNT, "r", "NOT book_year_known"),
    _EACH.format("title_date_candidates", "NULL", _BY_KEY, "key % 9 = 0"), _GROUP.format("composition_date_blockers", "NULL", _BY_COUNT, "r", "coalesce(composition_date, '') = ''"), _EACH.format("embedded_source_conflicts", "NULL", _BY_KEY, "clash"),
    _EACH.format("missing", "bucket", _SORT("starts_with(bucket, 'reviewed_')::INTEGER", "(bucket IN ('no_candidate', 'token_or_title_only_candidate'))::INTEGER", "-score", "0", "coalesce(edition, '')", "title", "''", "key::VARCHAR"), "NOT paged"),
])


def _gap_report(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, int]]:
    k, s = F.col("doc_id"), lambda c: c.cast("string")
    pick = lambda n, *names: F.get(F.array(*[F.lit(x).cast("string") for x in names]), (k % n).cast("int"))
    docs = table(spark, d, "documents")
    records = docs.select(
        k.alias("key"), F.concat(F.lit("text "), "lang", F.when(k % 9 == 0, F.concat(F.lit(" 19"), s(10 + k % 80))).otherwise("")).alias("title"), F.when(k % 4 == 0, UNKNOWN).when(k % 11 != 0, F.col("source")).alias("edition"), F.when(k % 5 != 0, 1900 + k % 50).alias("source_year"),
        (k % 3 == 0).alias("paged"), (k % 6 == 0).alias("book_year_known"), F.when(k % 7 == 0, "1930").when(k % 7 == 1, "").alias("composition_date"), pick(13, "reviewed_negative", "no_candidate", "token_or_title_only_candidate", *["line_match_review"] * 10).alias("bucket"), (k % 23).cast("int").alias("score"),
        pick(8, *gap_report_.NO_SCAN, *gap_report_.WEAK_SCAN, *gap_report_.GOOD_SCAN, None, None).alias("scan_status"), (k % 13 == 0).alias("excluded"), (k % 17 == 0).alias("clash"), F.when(k % 10 < 3, "strong_toc_review").when(k % 10 == 3, "weak_toc_review").alias("toc_status"), (k % 20 == 3).alias("toc_excluded"),
    )
    cites = docs.select(k.alias("key"), F.concat(F.lit("text "), "lang").alias("title"), F.col("source").alias("edition"), F.when(k % 19 == 0, "missing_book_corpus").otherwise("supported").alias("status"))
    return gap_report_.gap_report(records, folder(spark), UNKNOWN, cites)


@query(f"WITH r AS ({_RECORDS}), cites AS ({_MISSING_CITES}), t AS ({_RELATIONS}) SELECT relation, row_number() OVER (PARTITION BY relation ORDER BY o) AS place, status, edition, n, array_to_string(items, ' ') AS items FROM t")
def gap_relations(spark: SparkSession, d: str) -> DataFrame:
    """The ten relations of the gap report, each in its order."""
    return _gap_report(spark, d)[0].withColumn("items", F.array_join("items", " "))


_M = "count(*) FILTER (WHERE {})"


@query(f"WITH r AS ({_RECORDS}) " + " UNION ALL ".join(f"SELECT '{n}' AS counter, ({c})::BIGINT AS value FROM r" for n, c in {
    "public_poem_count": "count(*)", "missing_printed_page_count": _M.format("NOT paged"), "unknown_collection_missing_count": _M.format(f"NOT paged AND edition = '{UNKNOWN}'"), "missing_source_year_count": _M.format("source_year IS NULL"), "missing_primary_printed_book_year_count": _M.format("NOT book_year_known"),
    "missing_composition_date_count": _M.format("coalesce(composition_date, '') = ''"), "reviewed_exclusion_count": _M.format("NOT paged AND excluded"), "embedded_source_conflict_count": _M.format("clash"), "missing_embedded_source_conflict_count": _M.format("NOT paged AND clash"), "title_date_candidate_count": _M.format("key % 9 = 0"),
    "title_date_source_year_gap_count": _M.format("key % 9 = 0 AND source_year IS NULL"), "toc_index_candidate_count": _M.format("toc_status IS NOT NULL AND NOT toc_excluded"), "toc_index_reviewed_exclusion_count": _M.format("toc_status IS NOT NULL AND toc_excluded"),
}.items()))
def gap_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counters of the gap report, observed while its relations are made."""
    return spark.createDataFrame(sorted(_gap_report(spark, d)[1].items()), "counter string, value long")
