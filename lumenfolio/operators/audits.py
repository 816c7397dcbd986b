"""Consistency audits of citations, repairs, dates and markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.profiles import LATIN, NormProfile
from .joins import expand_range


def book_ranges(pages: DataFrame) -> DataFrame:
    """A4/A5: per canonical book the least and greatest printed page and all rows."""
    return pages.groupBy("canonical_book").agg(F.min("printed_page").alias("page_min"), F.max("printed_page").alias("page_max"), F.count("*").alias("book_rows"))


def citation_evidence(citations: DataFrame, pages: DataFrame, least_chars: int = 18, profile: NormProfile = LATIN) -> DataFrame:
    """What the cited pages hold of each passage.

    Citations: citation_id, book, page_start, page_end, title, body. Pages:
    book_id, canonical_book, printed_page, scan_page, text. Ranges become
    equi keys (J14); a citation's few pages are joined in scan order, so a
    line may match across a page break.
    """
    keyed = expand_range(citations.select("citation_id", "book", "page_start", "page_end"), "page_start", "page_end", "page")
    met = keyed.join(pages, (F.col("book") == F.col("canonical_book")) & (F.col("page") == F.col("printed_page")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "scan_page", "book_id", "text"))), lambda s: F.coalesce(s["text"], F.lit(""))), "\n")
    seen = met.groupBy("citation_id").agg(
        F.count("*").alias("canonical_rows"), F.count_if(F.col("book_id") == F.col("book")).alias("exact_rows"),
        F.array_sort(F.collect_set("scan_page")).alias("scan_pages"), X.normalize(text, profile).alias("page_text"),
    )
    t = citations.join(seen, "citation_id", "left").join(book_ranges(pages), F.col("book") == F.col("canonical_book"), "left")
    t = t.withColumn("page_text", F.coalesce("page_text", F.lit(""))).withColumn("lines", X.long_lines(F.col("body"), least_chars, profile))
    title = X.normalize(F.col("title"), profile)
    hits = F.filter("lines", lambda s: F.contains(F.col("page_text"), s["text"]))
    body = X.token_set(X.normalize(F.col("body"), profile))
    overlap = F.size(F.array_intersect(body, X.token_set(F.col("page_text"))))
    known = F.col("page_min").isNotNull()
    return t.select(
        "citation_id", "book", "page_start", "page_end", "page_min", "page_max",
        F.coalesce("book_rows", F.lit(0)).alias("book_rows"), F.coalesce("canonical_rows", F.lit(0)).alias("canonical_rows"), F.coalesce("exact_rows", F.lit(0)).alias("exact_rows"),
        (known & ((F.col("page_end") < F.col("page_min")) | (F.col("page_start") > F.col("page_max")))).alias("outside_range"),
        ((title != "") & F.contains("page_text", title)).alias("title_match"),
        F.coalesce(F.contains("page_text", F.get("lines", F.lit(0))["text"]), F.lit(False)).alias("first_line_match"),
        F.size(hits).alias("line_matches"), F.slice(F.transform(hits, lambda s: s["line_index"]), 1, 20).alias("line_indexes"),
        F.round(overlap / F.greatest(F.lit(1), F.size(body)), 4).alias("body_coverage"),
    )


def citation_status(conflict: Column) -> Column:
    """C13, over the columns of ``citation_evidence``; ``conflict``: an accepted candidate says otherwise."""
    none = F.col("canonical_rows") == 0
    held = F.col("title_match") | (F.col("line_matches") >= 2) | (F.col("body_coverage") >= 0.45)
    return (
        F.when(none & (F.col("book_rows") == 0), "missing_book_corpus")
        .when(none & (F.col("page_min").isNull() | F.col("page_max").isNull()), "missing_printed_page_sequence")
        .when(none & F.col("outside_range"), "outside_corpus_range")
        .when(none, "missing_page_rows")
        .when(conflict & (F.col("exact_rows") == 0), "candidate_conflict")
        .when(conflict & ~held, "candidate_conflict")
        .when(F.col("title_match") | F.col("first_line_match") | (F.col("line_matches") >= 2), "supported")
        .when(F.col("body_coverage") >= 0.45, "supported_token_only")
        .otherwise("weak_current_citation")
    )


def strong_candidate() -> Column:
    """C14: accepted, clustered anchors, three lines, one exact, in a page sequence."""
    n = lambda c, least: F.coalesce(F.col(c), F.lit(0)) >= least
    parts = (F.col("candidate_status") == "accepted_candidate") & (F.col("span_basis") == "line_anchor_cluster")
    return F.coalesce(parts & n("span_anchor_count", 1) & n("span_line_match_count", 3) & n("span_exact_line_match_count", 1) & F.array_contains("evidence", "page_sequence_present"), F.lit(False))


def repair_class(issues: tuple[str, ...]) -> Column:
    """C14: what a strong candidate with other pages means, or null."""
    known = F.col("candidate_start").isNotNull() & F.col("candidate_end").isNotNull()
    same_pages = F.col("candidate_start").eqNullSafe(F.col("page_start")) & F.col("candidate_end").eqNullSafe(F.col("page_end"))
    canonical, exact = F.col("book").eqNullSafe(F.col("candidate_canonical")), F.col("book").eqNullSafe(F.col("candidate_book"))
    kind = F.when(exact & F.col("status").isin(*issues), "safe_same_book_repair_candidate").when(canonical & ~exact, "alias_alternate_page_evidence").when(canonical, "canonical_book_page_conflict").otherwise("different_collection_candidate")
    return F.when(strong_candidate() & known & ~same_pages, kind)


def repair_audit(citations: DataFrame, candidates: DataFrame, issues: tuple[str, ...]) -> DataFrame:
    """Citations joined with their best candidate (J24: without one they drop out), classified."""
    return citations.join(candidates, "citation_id").withColumn("repair_status", repair_class(issues)).where("repair_status IS NOT NULL")


def date_audit(items: DataFrame, lines: DataFrame, least_chars: int = 14, profile: NormProfile = LATIN) -> DataFrame:
    """Dates near a passage's end.

    Items: item_id, page_id, body. Lines: page_id, line_no, text. The page
    lines that hold a body line (or are held by one) are found within the
    cited page; then the five lines behind the last one and the page's last
    five are searched.
    """
    from .sequence import lines_after

    wanted = items.select("item_id", "page_id", X.long_lines(F.col("body"), least_chars, profile).alias("body_lines"))
    t = wanted.join(lines, "page_id").withColumn("plain", X.normalize(F.col("text"), profile))
    hold = F.exists("body_lines", lambda s: F.contains(F.col("plain"), s["text"]) | ((F.length("plain") >= least_chars) & F.contains(s["text"], F.col("plain"))))
    near = lines_after(t.withColumn("hit", hold & (F.col("plain") != "")), ["item_id", "page_id"], "line_no", "hit")
    found = near.where(X.is_date_line(F.col("text"))).groupBy("item_id").agg(F.count("*").alias("date_lines"), F.count_if(F.size(X.date_evidence(F.col("text"))) >= 3).alias("strong_lines"), F.min_by("text", F.struct("page_id", "line_no")).alias("first_date"))
    return items.select("item_id").distinct().join(found, "item_id", "left").select("item_id", F.coalesce("date_lines", F.lit(0)).alias("date_lines"), "first_date", date_status(F.coalesce("date_lines", F.lit(0)), F.coalesce("strong_lines", F.lit(0))).alias("status"))


def date_status(lines: Column, strong: Column) -> Column:
    """C22."""
    return F.when(lines == 0, "no_date_evidence").when(strong > 0, "strong_date_review").otherwise("date_review")


def marker_status(marker: Column, edition: Column, unknown: str) -> Column:
    """C21."""
    return F.when(marker.isNull(), "no_marker").when(edition.eqNullSafe(F.lit(unknown)), "unknown_edition_marker").when(marker == edition, "match").otherwise("conflict")


def marker_conflict(marker: Column, edition: Column, unknown: str) -> Column:
    """struct(marker, edition) if a marker names another edition than a known one, else null."""
    clash = marker.isNotNull() & edition.isNotNull() & (edition != unknown) & (edition != marker)
    return F.when(clash, F.struct(marker.alias("marker"), edition.alias("edition")))


def marker_audit(rows: DataFrame, text: str, markers: tuple[str, ...], edition: str, unknown: str) -> DataFrame:
    """The only embedded marker of each text, the text without its span, status and conflict."""
    t = rows.withColumn("found", X.embedded_marker(F.col(text), markers))
    return t.withColumns({
        "marker": F.col("found.marker"),
        "marker_span": F.col("found.text"),
        "marker_status": marker_status(F.col("found.marker"), F.col(edition), unknown),
        "marker_conflict": marker_conflict(F.col("found.marker"), F.col(edition), unknown),
        "clean_text": X.without_span(F.col(text), F.col("found")),
    }).drop("found")
