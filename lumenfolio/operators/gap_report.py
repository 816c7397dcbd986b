"""The gap report: ten relations and their counters from one scan.

Each record is looked at once. It becomes a row for each relation that it
belongs to, written as a narrow table (relation, group, key, order); the same
scan's counters are observed on the way. Groups are counted from that table, and
their first items ranked before they are gathered, so a group that holds a third
of all records is never one list. Places within a relation come from one order
of all rows that is made by ranges, not in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import title_date_parts
from .sequence import numbered

#: The relations, in the report's order.
RELATIONS = (
    "source_corpus_backlog", "source_coverage_blockers", "toc_index_blockers", "toc_index_reviewed_exclusions", "source_year_blockers",
    "primary_printed_book_year_blockers", "title_date_candidates", "composition_date_blockers", "embedded_source_conflicts", "missing",
)
#: Kinds of backlog groups, most urgent first.
BACKLOG = ("missing_corpus_for_existing_citations", "missing_source_corpus_for_uncited_poems", "scanned_source_needs_better_extraction", "reviewed_scanned_source_gap", "unknown_source_collection")
NO_SCAN, WEAK_SCAN, GOOD_SCAN = ("unscanned_source_edition", "no_source_scan_pages"), ("source_scan_weak", "source_scan_no_support"), ("source_scan_supported", "source_scan_token_only")
NO_TEXT = ("no_candidate", "token_or_title_only_candidate")

ROW = "relation string, status string, edition string, grp string, key string, rank1 int, rank2 int, rank3 int, title string"


def backlog_kind(unknown: str) -> Column:
    """The kind of backlog that a record without printed pages falls into, or null."""
    scan = F.col("scan_status")
    return (
        F.when(F.col("edition") == unknown, BACKLOG[4])
        .when(scan.isin(*NO_SCAN), BACKLOG[1])
        .when(scan.isin(*WEAK_SCAN), F.when(F.startswith("bucket", F.lit("reviewed_")), BACKLOG[3]).otherwise(BACKLOG[2]))
    )


def memberships(unknown: str) -> Column:
    """A record's rows in all relations, as an array of structs of ``ROW``."""
    missing, edition, key = ~F.col("paged"), F.coalesce("edition", F.lit("")), F.col("key").cast("string")
    scan, kind = F.col("scan_status"), backlog_kind(unknown)

    def row(name: str, holds: Column, status: Column | None = None, of_edition: bool = False, ranks: tuple[Column, ...] = ()) -> Column:
        none = F.lit(None).cast("string")
        ranks = [*[r.cast("int") for r in ranks], *[F.lit(0)] * (3 - len(ranks))]
        fields = {"relation": F.lit(name), "status": status if status is not None else none, "edition": edition, "grp": F.lit("") if of_edition else key, "key": key} | {f"rank{i}": r for i, r in enumerate(ranks, 1)} | {"title": F.coalesce("title", F.lit(""))}
        return F.when(F.coalesce(holds, F.lit(False)), F.struct(*[c.alias(n) for n, c in fields.items()]))

    detail = F.when(kind.isin(*BACKLOG[2:4]), F.concat_ws("/", kind, scan, F.when(kind == BACKLOG[3], F.col("bucket")))).otherwise(kind)
    urgency = F.array_position(F.array(*map(F.lit, BACKLOG)), kind)
    toc = F.col("toc_status").isNotNull()
    return F.array_compact(F.array(
        row(RELATIONS[0], missing & kind.isNotNull(), detail, True, (urgency,)),
        row(RELATIONS[1], missing & (edition != "") & (edition != unknown) & ~F.coalesce(scan.isin(*GOOD_SCAN), F.lit(False)), F.coalesce(scan, F.lit("not_applicable")), True, (F.coalesce(scan != NO_SCAN[0], F.lit(True)),)),
        row(RELATIONS[2], toc & ~F.col("toc_excluded"), F.col("toc_status")),
        row(RELATIONS[3], toc & F.col("toc_excluded"), F.col("toc_status")),
        row(RELATIONS[4], F.col("source_year").isNull(), None, True),
        row(RELATIONS[5], ~F.col("book_year_known"), None, True),
        row(RELATIONS[6], F.size(title_date_parts(F.col("title"))) > 0),
        row(RELATIONS[7], F.coalesce("composition_date", F.lit("")) == "", None, True),
        row(RELATIONS[8], F.col("clash")),
        row(RELATIONS[9], missing, F.col("bucket"), False, (F.startswith("bucket", F.lit("reviewed_")), F.col("bucket").isin(*NO_TEXT), -F.col("score"))),
    ))


def counters(unknown: str) -> dict[str, Column]:
    """The summary's counters, as aggregates over records."""
    missing = ~F.col("paged")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return {
        "public_poem_count": F.count(F.lit(1)), "missing_printed_page_count": count(missing), "unknown_collection_missing_count": count(missing & (F.col("edition") == unknown)),
        "missing_source_year_count": count(F.col("source_year").isNull()), "missing_primary_printed_book_year_count": count(~F.col("book_year_known")), "missing_composition_date_count": count(F.coalesce("composition_date", F.lit("")) == ""),
        "reviewed_exclusion_count": count(missing & F.col("excluded")), "embedded_source_conflict_count": count(F.col("clash")), "missing_embedded_source_conflict_count": count(missing & F.col("clash")),
        "title_date_candidate_count": count(F.size(title_date_parts(F.col("title"))) > 0), "title_date_source_year_gap_count": count((F.size(title_date_parts(F.col("title"))) > 0) & F.col("source_year").isNull()),
        "toc_index_candidate_count": count(F.col("toc_status").isNotNull() & ~F.col("toc_excluded")), "toc_index_reviewed_exclusion_count": count(F.col("toc_status").isNotNull() & F.col("toc_excluded")),
    }


def gap_report(records: DataFrame, path: str, unknown: str, citations: DataFrame | None = None, most: int = 12) -> tuple[DataFrame, dict[str, int]]:
    """(relations, counters). Relations: relation, place, status, edition, n, items (the first ``most`` keys of a group).

    Records have key, title, edition, source_year, paged, book_year_known,
    composition_date, bucket, score, scan_status, excluded, clash, toc_status and
    toc_excluded. ``citations`` (key, title, edition, status): existing citations, of
    which those without a corpus join the backlog. ``path``: a new shared folder.
    """
    spark, seen = records.sparkSession, Observation("gap report")
    watched = records.observe(seen, *[c.alias(n) for n, c in counters(unknown).items()])
    rows = watched.select(F.explode(memberships(unknown)).alias("r")).select("r.*")
    rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in ROW.split(", ")]).write.parquet(f"{path}/rows")
    tagged = spark.read.schema(ROW).parquet(f"{path}/rows")
    if citations is not None:
        lacking = citations.where(F.col("status") == "missing_book_corpus")
        tagged = tagged.unionByName(lacking.select(F.lit(RELATIONS[0]).alias("relation"), F.lit(BACKLOG[0]).alias("status"), F.coalesce("edition", F.lit("")).alias("edition"), F.lit("").alias("grp"), F.col("key").cast("string").alias("key"), F.lit(1).alias("rank1"), F.lit(0).alias("rank2"), F.lit(0).alias("rank3"), F.coalesce("title", F.lit("")).alias("title")))
    group = ["relation", "status", "edition", "grp"]
    sized = tagged.groupBy(*group).agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("rank1", "rank2", "rank3", "title")])
    first = tagged.withColumn("rn", F.row_number().over(Window.partitionBy(*group).orderBy("key"))).where(F.col("rn") <= most)
    first = first.groupBy(*group).agg(F.array_sort(F.collect_list("key")).alias("items"))
    both = sized.join(first.select(*[F.col(c).alias(f"__{c}") for c in group], "items"), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group])
    by_count = F.when(F.col("relation").isin(RELATIONS[0], RELATIONS[4], RELATIONS[5], RELATIONS[7]), -F.col("n")).otherwise(0)
    place = F.array_position(F.array(*map(F.lit, RELATIONS)), F.col("relation"))
    named = F.when(F.col("relation").isin(RELATIONS[2], RELATIONS[3], RELATIONS[6], RELATIONS[8]), "").otherwise(F.col("edition"))
    titled = F.when(F.col("relation") == RELATIONS[9], F.col("title")).otherwise("")
    told = F.when(F.col("relation").isin(*RELATIONS[:2]), F.col("status")).otherwise("")
    ordered = both.select("relation", "status", "edition", "n", "items", place.cast("int").alias("r0"), "rank1", "rank2", "rank3", by_count.alias("r4"), named.alias("r5"), titled.alias("r6"), told.alias("r7"), "grp")
    done = numbered(ordered, ["r0", "rank1", "rank2", "rank3", *[f"r{i}" for i in range(4, 8)], "grp"], "at", f"{path}/order")
    starts = done.groupBy("relation").agg((F.min("at") - 1).alias("before"))  # a row a relation
    placed = done.join(F.broadcast(starts), "relation")
    return placed.select("relation", (F.col("at") - F.col("before")).alias("place"), "status", "edition", "n", "items"), {k: int(v) for k, v in seen.get.items()}
