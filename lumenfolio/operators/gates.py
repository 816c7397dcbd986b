"""Rule gates that decide which candidates may change a record, and the planned change.

A gate is a conjunction, declared as data and turned into one Column. The
dispatcher takes the first gate that holds, in a fixed order. Nothing is
updated in place: ``apply_plan`` computes the new version of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRONG = ("title_match", "first_line_match", "last_line_match", "high_body_coverage")
ACCEPTED, REVIEW, AMBIGUOUS = "accepted_candidate", "needs_manual_review", "ambiguous"
#: Fixed value: the collection of records whose source is not known.
UNKNOWN_BN = "সংকলন অজানা"


@dataclass(frozen=True)
class Gate:
    """One conjunction; what is left out isn't asked for.

    edition: same, unknown or different. pages: any, ordered (end >= start),
    single (equal) or several. anchors: two (at least the span, or 2), span,
    one (exactly) or some. gap: least lead; gap_null: whether no lead will do.
    """

    reason: str
    status: tuple[str, ...]
    edition: str
    pages: str = "any"
    cluster: bool = True
    evidence: tuple[str, ...] = ()
    one_of: tuple[str, ...] = ()
    score: float = 0.0
    lines: int = 0
    exact: int = 0
    anchors: str = ""
    gap: float | None = None
    gap_null: bool = True
    alias: bool | None = None
    single_book: bool = False
    span_evidence: bool = False
    marker: bool = False
    reference: bool = False
    outside: bool = False


# The gates, in the dispatcher's order. The first five come before
# the alias rule, the others hold for candidates that aren't accepted.
OVERRIDES = (
    Gate("conflict_exact_rich", (ACCEPTED, AMBIGUOUS, REVIEW), "different", evidence=("title_match", "page_sequence_present"), score=27, lines=20, exact=10, anchors="two", gap=3, alias=False),
    Gate("conflict_accepted", (ACCEPTED,), "different", "ordered", evidence=("high_body_coverage", "page_sequence_present"), one_of=("title_match", "first_line_match"), score=25, lines=9, exact=3, anchors="two", gap=4, alias=False),
    Gate("conflict_embedded_collection", (ACCEPTED, AMBIGUOUS, REVIEW), "different", score=17, lines=4, exact=4, anchors="some", alias=False, marker=True),
    Gate("outside_range_conflict", (ACCEPTED,), "different", "ordered", evidence=("high_body_coverage", "page_sequence_present"), one_of=STRONG[:3], score=29, lines=7, exact=2, anchors="two", gap=8, alias=False, outside=True),
    Gate("outside_range_alias_repair", (ACCEPTED,), "same", "ordered", evidence=("high_body_coverage", "page_sequence_present"), one_of=STRONG[:3], score=25, lines=5, exact=3, anchors="two", gap=8, alias=True, outside=True),
)
REVIEWED = (
    Gate("known_review", (REVIEW,), "same", cluster=False, evidence=("page_sequence_present",), one_of=STRONG, score=17, lines=4, exact=1, gap=4, span_evidence=True),
    Gate("known_ambiguous", (AMBIGUOUS,), "same", cluster=False, evidence=("page_sequence_present",), one_of=STRONG, score=25, lines=10, exact=5, anchors="two", span_evidence=True),
    Gate("known_exact_rich", (AMBIGUOUS,), "same", cluster=False, evidence=("page_sequence_present",), one_of=STRONG, score=17, lines=12, exact=8, anchors="two"),
    Gate("known_line_rich", (AMBIGUOUS, REVIEW), "same", one_of=(*STRONG, "page_sequence_present"), lines=3, exact=3, anchors="two"),
    Gate("known_fuzzy_rich", (AMBIGUOUS, REVIEW), "same", evidence=("title_match", "high_body_coverage", "page_sequence_present"), score=24, lines=18, exact=2, anchors="two"),
    Gate("known_continuation", (REVIEW,), "same", "ordered", evidence=("title_match", "body_token_overlap"), score=22, lines=10, exact=4, anchors="some", gap=4),
    Gate("known_long_ambiguous", (AMBIGUOUS,), "same", "ordered", evidence=("body_token_overlap", "page_sequence_present"), score=17, lines=15, exact=2, anchors="two"),
    Gate("known_single_page_body", (AMBIGUOUS,), "same", "single", evidence=("body_token_overlap", "high_body_coverage", "page_sequence_present"), score=25, lines=7, exact=1, anchors="one"),
    Gate("unknown_exact_rich", (AMBIGUOUS, REVIEW), "unknown", evidence=("page_sequence_present",), one_of=STRONG, score=17, lines=15, exact=10, anchors="two"),
    Gate("unknown_exact_anchor", (AMBIGUOUS, REVIEW), "unknown", evidence=("page_sequence_present",), score=17, lines=20, exact=20, anchors="span"),
    Gate("unknown_single_page_body", (REVIEW,), "unknown", "single", evidence=("high_body_coverage", "page_sequence_present"), score=17, lines=3, exact=1, anchors="one", gap=4, single_book=True),
    Gate("unknown_ambiguous_line", (AMBIGUOUS,), "unknown", "ordered", evidence=("body_token_overlap",), one_of=("title_match", "high_body_coverage"), score=19, lines=7, exact=2, anchors="two", gap=2, gap_null=False),
    Gate("unknown_continuation_body", (AMBIGUOUS,), "unknown", "several", evidence=("body_token_overlap", "high_body_coverage", "page_sequence_present"), score=17, lines=8, exact=1, anchors="some"),
    Gate("unknown_fuzzy_single_page_body", (REVIEW,), "unknown", "single", evidence=("body_token_overlap", "high_body_coverage", "page_sequence_present"), score=17, lines=4, anchors="one", single_book=True),
    Gate("unknown_single_page_ambiguous_body", (AMBIGUOUS,), "unknown", "single", evidence=("body_token_overlap", "high_body_coverage", "page_sequence_present", "title_match"), score=25, lines=4, exact=1, anchors="one", single_book=True),
    Gate("unknown_embedded_collection", (ACCEPTED, AMBIGUOUS, REVIEW), "unknown", evidence=("page_sequence_present",), lines=8, exact=4, anchors="two", reference=True),
)


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def pages_known() -> Column:
    return F.col("printed_page_start").isNotNull() & F.col("printed_page_end").isNotNull()


def span_evidence() -> Column:
    """A cluster of anchors with an exact line or two lines; a span of five pages or more has an anchor for each."""
    span = F.col("printed_page_end") - F.col("printed_page_start") + 1
    some = (_count("span_exact_line_match_count") > 0) | (_count("span_line_match_count") >= 2)
    return F.coalesce((F.col("span_basis") == "line_anchor_cluster") & (_count("span_anchor_count") > 0) & some & pages_known() & ((span < 5) | (_count("span_anchor_count") >= span)), F.lit(False))


def condition(g: Gate, unknown: str, single_book: str) -> Column:
    """The gate as a Column that is never null.

    Needs the candidate's columns, edition (the record's), book_title (the
    candidate book's), is_alias, has_marker, has_reference, outside_corpus.
    """
    start, end = F.col("printed_page_start"), F.col("printed_page_end")
    span, anchors = end - start + 1, _count("span_anchor_count")
    same, is_unknown = F.col("edition").eqNullSafe(F.col("book_title")), F.col("edition").eqNullSafe(F.lit(unknown))
    parts = [F.col("status").isin(*g.status), pages_known()]
    parts.append({"same": same, "unknown": is_unknown, "different": ~same & ~is_unknown}[g.edition])
    parts += {"any": [], "ordered": [end >= start], "single": [end == start], "several": [end > start]}[g.pages]
    parts += {"": [], "two": [anchors >= F.least(span, F.lit(2))], "span": [anchors >= span], "one": [anchors == 1], "some": [anchors >= 1]}[g.anchors]
    parts += [F.col("span_basis") == "line_anchor_cluster"] if g.cluster else []
    parts += [F.array_contains("evidence", e) for e in g.evidence]
    parts += [F.arrays_overlap("evidence", F.array(*map(F.lit, g.one_of)))] if g.one_of else []
    parts += [_count(c) >= v for c, v in (("score", g.score), ("span_line_match_count", g.lines), ("span_exact_line_match_count", g.exact)) if v]
    if g.gap is not None:
        lead = F.col("runner_up_gap")
        parts.append((lead.isNull() | (lead >= g.gap)) if g.gap_null else (lead.isNotNull() & (lead >= g.gap)))
    parts += [F.col("is_alias") == F.lit(g.alias)] if g.alias is not None else []
    parts += [F.col("candidate_book_id") == single_book] if g.single_book else []
    parts += [span_evidence()] if g.span_evidence else []
    parts += [F.col("has_marker")] if g.marker else []
    parts += [F.col("has_reference")] if g.reference else []
    parts += [F.col("outside_corpus"), F.col("pages_exist")] if g.outside else []
    return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


def dispatch(rows: DataFrame, unknown: str = UNKNOWN_BN, single_book: str = "rupasi-bangla", enabled: set[str] | None = None, legacy: bool = False) -> DataFrame:
    """``rows`` with eligible and reason: the first rule that holds, gates in their order."""
    on = lambda gates: [g for g in gates if enabled is None or g.reason in enabled]
    same, is_unknown = F.col("edition").eqNullSafe(F.col("book_title")), F.col("edition").eqNullSafe(F.lit(unknown))
    reason = F.when(~pages_known(), "missing_printed_page").when(F.col("book_title").isNull(), "unknown_candidate_book").when(~F.col("pages_exist"), "candidate_pages_not_in_corpus")
    for g in on(OVERRIDES):
        reason = reason.when(condition(g, unknown, single_book), f"eligible_{g.reason}")
    reason = reason.when(F.col("is_alias") & F.col("has_existing_source"), "alias_existing_source")
    open_ = ~F.col("status").eqNullSafe(F.lit(ACCEPTED))
    for g in on(REVIEWED):
        reason = reason.when(open_ & condition(g, unknown, single_book), f"eligible_{g.reason}")
    reason = reason.when(open_, "not_accepted")
    if not legacy:
        reason = reason.when(~span_evidence(), "missing_span_anchor_evidence")
    reason = reason.when(~is_unknown & ~same, "known_collection_conflict").otherwise("eligible")
    return rows.withColumn("reason", reason).withColumn("eligible", F.startswith(F.col("reason"), F.lit("eligible")))


def apply_plan(rows: DataFrame, unknown: str = UNKNOWN_BN, force: Column | None = None) -> DataFrame:
    """The new version of eligible records: edition, year and phase where unknown or forced, and the primary source replaced.

    Needs edition, source_year, phase_id, book_title, book_year, book_phase and
    book_sources (array of struct with role, title_bn, page_start, page_end).
    Running it again changes nothing.
    """
    fill = F.col("edition").eqNullSafe(F.lit(unknown)) | (force if force is not None else F.lit(False))
    edition = F.when(fill, F.col("book_title")).otherwise(F.col("edition"))
    new = F.struct(F.lit("primary").alias("role"), F.col("book_title").alias("title_bn"), F.col("printed_page_start").cast("int").alias("page_start"), F.col("printed_page_end").cast("int").alias("page_end"))
    drop = lambda s: F.when(edition == F.col("book_title"), s["role"] == "primary").otherwise((s["role"] == "primary") & (s["title_bn"] == F.col("book_title")))
    kept = F.filter(F.coalesce("book_sources", F.array().cast("array<struct<role:string,title_bn:string,page_start:int,page_end:int>>")), lambda s: ~drop(s))
    changed = rows.where("eligible").withColumns({
        "book_sources": F.array_append(kept, new),
        "source_year": F.when(fill, F.col("book_year")).otherwise(F.col("source_year")),
        "phase_id": F.when(fill, F.col("book_phase")).otherwise(F.col("phase_id")),
    })
    return changed.withColumn("edition", edition)
