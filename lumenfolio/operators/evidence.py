"""Additive log-odds ledgers: factors, posterior, stages, blockers and next actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sigmoid

# The weights of the factor model.
BASE = -3.0
STAGES = ("human_review", "source_prior", "page_sequence_repair", "text_alignment", "competition", "candidate_generation", "corpus_coverage")
ALIGNMENT = {"same_source_book": 1.8, "no_candidate_book": 0.0, "unknown_source": 0.0, "unmapped_source": -0.4, "source_conflict": -2.2}
STATUS = {"accepted_candidate": 1.4, "needs_manual_review": 0.2, "ambiguous": -0.8, "no_candidate": -2.5}
SCAN = {"source_scan_supported": 1.5, "source_scan_token_only": 0.4, "source_scan_weak": -0.7, "source_scan_no_support": -1.4, "unscanned_source_edition": -0.8, "no_source_scan_pages": -0.8, "not_applicable": 0.0}
EVIDENCE = {"title_match": 0.8, "first_line_match": 1.1, "last_line_match": 0.7, "high_body_coverage": 0.7}


def chosen(value: Column, table: dict[str, float], other: float) -> Column:
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


def alignment(edition: Column, edition_book: Column, candidate: Column, unknown: str) -> Column:
    """C20; ``edition_book`` is the book of the edition, null if there is none; ``candidate`` is canonical."""
    return (
        F.when(candidate.isNull() | (candidate == ""), "no_candidate_book")
        .when(edition.eqNullSafe(F.lit(unknown)), "unknown_source")
        .when(edition_book.isNull(), "unmapped_source")
        .when(candidate == edition_book, "same_source_book")
        .otherwise("source_conflict")
    )


def factor(stage: str, name: str, weight: Column, observation: Column, when: Column | None = None) -> Column:
    """A struct of the ledger, or null where ``when`` doesn't hold."""
    made = F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("name"), weight.cast("double").alias("weight"), observation.cast("string").alias("observation"))
    return made if when is None else F.when(F.coalesce(when, F.lit(False)), made)


def ledger(rows: DataFrame, unknown: str) -> DataFrame:
    """``rows`` with alignment, factors (in stage order), log_odds and posterior.

    Needs edition, edition_book, candidate_book, printed_page_start/_end,
    status, evidence, span_basis, exact_count, line_count, runner_up_gap,
    scan_status and excluded (boolean).
    """
    align = alignment(F.col("edition"), F.col("edition_book"), F.col("candidate_book"), unknown)
    t = rows.withColumn("alignment", align)
    is_unknown = F.col("edition").eqNullSafe(F.lit(unknown))
    paged = F.col("printed_page_start").isNotNull() & F.col("printed_page_end").isNotNull()
    has = lambda e: F.coalesce(F.array_contains("evidence", e), F.lit(False))
    cluster = F.coalesce(F.col("span_basis") == "line_anchor_cluster", F.lit(False))
    exact, lines = F.coalesce("exact_count", F.lit(0)), F.coalesce("line_count", F.lit(0))
    gap, status, scan = F.col("runner_up_gap"), F.coalesce("status", F.lit("no_candidate")), F.coalesce("scan_status", F.lit("not_applicable"))
    prior = F.when(is_unknown, -0.9).when(F.col("edition_book").isNull(), -0.6).otherwise(0.8)
    factors = [
        factor("human_review", "reviewed_negative", F.lit(-8.0), F.lit("excluded"), F.col("excluded")),
        factor("source_prior", "source_edition", prior, F.col("edition")),
        factor("source_prior", "candidate_source_alignment", chosen(F.col("alignment"), ALIGNMENT, 0.0), F.col("alignment"), F.col("candidate_book").isNotNull()),
        factor("page_sequence_repair", "printed_page_available", F.lit(1.2), F.concat_ws("-", F.col("printed_page_start").cast("string"), F.col("printed_page_end").cast("string")), paged),
        factor("page_sequence_repair", "missing_printed_page", F.lit(-2.0), F.lit(None), ~paged & F.col("status").isNotNull() & (F.col("status") != "no_candidate")),
        factor("page_sequence_repair", "page_sequence_present", F.lit(0.9), F.lit("true"), has("page_sequence_present")),
        factor("text_alignment", "line_anchor_cluster", F.lit(1.6), F.col("span_basis"), cluster),
        factor("text_alignment", "non_anchor_span_basis", F.lit(-0.9), F.col("span_basis"), ~cluster & F.col("span_basis").isNotNull()),
        factor("text_alignment", "exact_line_matches", F.least(F.lit(2.4), exact * 0.45), exact, exact > 0),
        factor("text_alignment", "line_matches", F.least(F.lit(1.4), lines * 0.18), lines, lines > 0),
        *[factor("text_alignment", e, F.lit(w), F.lit("true"), has(e)) for e, w in EVIDENCE.items()],
        factor("competition", "runner_up_gap", F.when(gap >= 4, 0.7).when(gap >= 1, 0.25).otherwise(-0.7), gap, gap.isNotNull()),
        factor("candidate_generation", "candidate_status", chosen(status, STATUS, -0.5), status),
        factor("corpus_coverage", "source_scan_status", chosen(scan, SCAN, -0.2), scan),
    ]
    t = t.withColumn("factors", F.array_compact(F.array(*factors)))
    t = t.withColumn("log_odds", F.aggregate("factors", F.lit(BASE), lambda a, f: a + f["weight"]))
    return t.withColumn("posterior", sigmoid(F.col("log_odds")))


def blockers() -> Column:
    """C18, over the columns of ``ledger``."""
    paged = F.col("printed_page_start").isNotNull() & F.col("printed_page_end").isNotNull()
    tests = [
        (F.col("excluded"), "reviewed_negative"),
        (F.coalesce("status", F.lit("no_candidate")) == "no_candidate", "no_candidate"),
        (~paged, "no_printed_page"),
        (~F.col("span_basis").eqNullSafe(F.lit("line_anchor_cluster")), "no_line_anchor_cluster"),
        (F.coalesce("exact_count", F.lit(0)) == 0, "no_exact_line_anchor"),
        (F.col("alignment") == "source_conflict", "source_conflict"),
        (F.col("alignment") == "unknown_source", "unknown_source_collection"),
        (F.coalesce("scan_status", F.lit("")).isin("unscanned_source_edition", "no_source_scan_pages"), "missing_source_corpus"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for c, n in tests]))


def next_action() -> Column:
    """C19, over blockers, posterior and alignment."""
    b = lambda n: F.array_contains("blockers", n)
    return (
        F.when(b("reviewed_negative"), "keep_excluded")
        .when(b("missing_source_corpus"), "add_or_review_source_corpus")
        .when(b("no_candidate"), "needs_better_text_extraction")
        .when(b("unknown_source_collection") & (F.col("posterior") >= 0.65), "manual_collection_review")
        .when(b("source_conflict"), "manual_source_conflict_review")
        .when((F.col("posterior") >= 0.72) & ~b("no_line_anchor_cluster") & ~b("no_printed_page"), "manual_printed_page_review")
        .when(F.col("alignment") == "unknown_source", "identify_collection")
        .otherwise("needs_stronger_text_anchors")
    )


def stage_updates(scored: DataFrame, key: str) -> DataFrame:
    """Key, stage, delta, log odds and posteriors before and after each stage."""
    each = scored.select(key, F.posexplode("factors").alias("pos", "f")).groupBy(key, F.col("f.stage").alias("stage")).agg(F.sum("f.weight").alias("delta"), F.min("pos").alias("at"))
    w = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    after = F.lit(BASE) + F.sum("delta").over(w)
    return each.select(key, "stage", "delta", after.alias("log_odds_after"), sigmoid(after - F.col("delta")).alias("posterior_before"), sigmoid(after).alias("posterior_after"))


def stage_totals(scored: DataFrame) -> DataFrame:
    """Stage, total weight, positive and negative counts."""
    f = scored.select(F.explode("factors").alias("f")).select("f.*")
    return f.groupBy("stage").agg(F.sum("weight").alias("total"), F.count_if(F.col("weight") > 0).alias("positive"), F.count_if(F.col("weight") < 0).alias("negative"))


def scan_status(known: Column, pages: Column, exact_lines: Column, coverage: Column, title: Column) -> Column:
    """What the pages of the known source say; null for an unknown source."""
    return (
        F.when(~known, F.lit(None).cast("string"))
        .when(pages == 0, "unscanned_source_edition")
        .when((exact_lines >= 2) | ((exact_lines >= 1) & title), "source_scan_supported")
        .when(coverage >= 0.35, "source_scan_token_only")
        .when(coverage >= 0.18, "source_scan_weak")
        .otherwise("source_scan_no_support")
    )


def evidence_score(flags: dict[str, Column], weights: dict[str, int], counts: Column, most: int = 10) -> Column:
    """C17: a capped integer sum of flags' weights and a capped count."""
    total = F.least(F.coalesce(counts, F.lit(0)), F.lit(most)).cast("int")
    for name, value in flags.items():
        total = total + F.when(value, F.lit(weights[name])).otherwise(F.lit(0))
    return total


def review_bucket(excluded_bucket: Column, status: Column, paged: Column, align: Column) -> Column:
    """Seven buckets; an exclusion's own bucket overrides."""
    own = (
        F.when(status.isNull() | (status == "no_candidate"), "no_candidate")
        .when(~paged, "missing_printed_page")
        .when(align == "source_conflict", "source_conflict")
        .when(align == "unknown_source", "unknown_collection")
        .when(status == "ambiguous", "ambiguous_candidate")
        .when(status == "accepted_candidate", "ready_for_review")
        .otherwise("manual_review")
    )
    return F.coalesce(excluded_bucket, own)


def acquisition_action(bucket: Column, scan: Column, posterior: Column) -> Column:
    """What to acquire or review next."""
    return (
        F.when(scan.isin("unscanned_source_edition", "no_source_scan_pages"), "acquire_source_scan")
        .when(bucket == "no_candidate", "improve_text_extraction")
        .when(bucket == "unknown_collection", "identify_collection")
        .when(posterior >= 0.72, "review_printed_page")
        .otherwise("review_alignment")
    )
