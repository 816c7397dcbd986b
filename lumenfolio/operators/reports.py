"""Report relations, validators and Markdown."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """A1: values by falling count; equal counts by value."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)


def condition_counts(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """A2: one row with the number of rows that meet each condition."""
    return rows.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def capped_groups(rows: DataFrame, keys: list[str], item: str, order: list[Column | str], most: int = 12) -> DataFrame:
    """Per group the count, the first ``most`` items, and ``a · b · +n more``.

    The cap is a window rank before the list is made, so a large group is never gathered.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    first = rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= most).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__rn", item))).alias("__i"))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    cond = [F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    t = sizes.alias("s").join(first.alias("f"), cond).select("s.*", F.transform("__i", lambda x: x[item].cast("string")).alias("items"))
    more = F.when(F.col("n") > most, F.concat(F.lit(" · +"), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return t.withColumn("label", F.concat(F.array_join("items", " · "), more))


def backlog(parts: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """Group-bys (name, priority, rows with group and n) as one relation in priority order."""
    made = [p.select(F.lit(name).alias("category"), F.lit(rank).alias("priority"), F.col("grp").cast("string").alias("grp"), F.col("n").cast("long").alias("n")) for name, rank, p in parts]
    return reduce(DataFrame.unionByName, made)


def manifest(gaps: DataFrame, factors: DataFrame, markers: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Gap rows with their factor, marker and candidate rows, each unique by key; a missing one is null."""
    return gaps.join(factors, key, "left").join(markers, key, "left").join(candidates, key, "left")


def violations(checks: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """V1: check, key of all rows that break a check; an empty result means that all hold."""
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("check_name"), F.col(key).cast("string").alias("key")) for name, rows in checks])


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """U7."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def render_checks(rows: DataFrame, key: str, html_text: str, needed: dict[str, Column]) -> DataFrame:
    """V2: key, missing: what a rendered page lacks of the texts that it has to show; a missing page lacks ``page``."""
    lacking = F.array_compact(F.array(F.when(F.col(html_text).isNull(), F.lit("page")), *[F.when(~F.contains(F.col(html_text), v), F.lit(n)) for n, v in needed.items()]))
    return rows.select(key, F.explode(lacking).alias("missing"))


def schema_errors(rows: DataFrame, key: str, required: dict[str, str], enums: dict[str, tuple[str, ...]]) -> DataFrame:
    """V3: key, error of rows with a missing required value or a value outside its list; a missing column is an error of its own."""
    kinds = dict(rows.dtypes)
    wrong = [f"{c}: {kinds.get(c, 'missing')} instead of {t}" for c, t in required.items() if kinds.get(c) != t]
    if wrong:
        raise TypeError("; ".join(wrong))
    tests = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    tests += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), F.lit(f"{c} is not allowed")) for c, v in enums.items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*tests))).alias("error"))


def statuses_first(status: Column, *names: str) -> list[Column]:
    """Order keys that put rows of the named statuses first, in the order of the names."""
    return [F.coalesce(status == n, F.lit(False)).desc() for n in names]


def statuses_last(status: Column, *names: str) -> list[Column]:
    """Order keys that put rows of the named statuses last, the first named one behind all others."""
    return [F.coalesce(status == n, F.lit(False)).asc() for n in names]


def fuzzy_candidate_order() -> list[Column]:
    """O3: candidates of one passage."""
    return [F.coalesce(c, F.lit(0)).desc() for c in ("ordered_run", "longest_line_run", "line_matches", "exact_lines", "score")]


def fuzzy_row_order() -> list[Column]:
    """O3: rows of the fuzzy report."""
    return [*statuses_first(F.col("status"), "strong_fuzzy_review", "manual_collection_review"), F.col("line_matches").desc(), F.col("exact_lines").desc(), F.col("key").asc()]


def ordered_candidate_order() -> list[Column]:
    """Exact lines first."""
    return [F.coalesce(c, F.lit(0)).desc() for c in ("exact_lines", "ordered_run", "line_matches", "score")]


def ordered_row_order() -> list[Column]:
    """Rows of the ordered report."""
    return [*statuses_first(F.col("status"), "strong_ordered_review", "manual_ordered_review"), F.col("exact_lines").desc(), F.col("ordered_run").desc(), F.col("line_matches").desc(), F.col("key").asc()]


def contents_candidate_order() -> list[Column]:
    """Verified pages, then score, ratio and the smaller page."""
    return [F.coalesce("verified", F.lit(False)).desc(), F.coalesce("score", F.lit(0)).desc(), F.coalesce("ratio", F.lit(0)).desc(), F.coalesce("page", F.lit(0)).asc()]


def gap_order() -> list[Column]:
    """Rows not yet reviewed, those with a candidate, then the better evidence."""
    weak = F.col("bucket").isin("no_candidate", "token_or_title_only_candidate")
    return [F.startswith("bucket", F.lit("reviewed_")).asc(), weak.asc(), F.col("evidence_score").desc(), F.coalesce("edition", F.lit("")).asc(), F.coalesce("title", F.lit("")).asc()]


def factor_order() -> list[Column]:
    """O7."""
    return [F.col("posterior").desc(), F.coalesce("key", F.lit("")).asc()]


def citation_order() -> list[Column]:
    """What needs work first."""
    return [*statuses_last(F.col("status"), "supported", "supported_token_only", "weak_current_citation"), F.coalesce("key", F.lit("")).asc()]


def repair_order() -> list[Column]:
    """O8."""
    return [*statuses_first(F.col("status"), "safe_same_book_repair_candidate", "canonical_book_page_conflict", "alias_alternate_page_evidence"), F.coalesce("key", F.lit("")).asc()]


def date_order() -> list[Column]:
    """O8."""
    return [*statuses_first(F.col("status"), "strong_date_review", "date_review"), F.coalesce("key", F.lit("")).asc()]


def worst_page_order() -> list[Column]:
    """Pages with the most unknown tokens."""
    return [F.col("unknown_ratio").desc(), F.col("unknown").desc(), F.coalesce("book_id", F.lit("")).asc(), F.coalesce("scan_page", F.lit(0)).asc()]


def suggestion_order() -> list[Column]:
    """Suggestions of one token."""
    return [F.col("score").desc(), F.col("count").desc(), F.col("token").asc()]


def markdown(rows: DataFrame, title: str, most: int = 50) -> str:
    """K5: a Markdown table of the first rows; pipes are escaped. Only those rows reach the driver."""
    found = rows.limit(most).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    head = ["| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    return "\n".join([f"# {title}", "", *head, *("| " + " | ".join(map(cell, r)) + " |" for r in found)]) + "\n"
