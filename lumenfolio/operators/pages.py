"""Page records: features, classification and logical sections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

# Page types.
TRUSTED = ("normal_poem_page", "poem_or_text_page", "poem_start_or_short_page")
EXTENSION = (*TRUSTED, "blank_or_near_blank")


@dataclass(frozen=True)
class PagePatterns:
    """Patterns that classification looks for, over the compact text."""

    publisher: str
    contents: str
    front: str
    prose: str
    letters: str
    digits: str = "০-৯0-9"


# The Bengali patterns.
BANGLA = PagePatterns(
    publisher="প্রকাশক|মুদ্রক|প্রথমমুদ্রণ|প্রথমসংস্করণ|প্রচ্ছদ",
    contents="^[\"'‘’“”।]*(সূচ|সুচ)",
    front="উৎসর্গ|ভূমিকা|রচনাকাল",
    prose="জীবনানন্দেরচেতনাজগৎ|প্রবন্ধ|আলোচনা|পর্যালোচনা",
    letters="ঀ-৿",
)
LATIN = PagePatterns(publisher="publish|printedby|firstedition", contents="^[\"']*contents", front="dedicat|preface|written", prose="essay|review", letters="A-Za-z")


def is_contents(text: Column, p: PagePatterns = BANGLA) -> Column:
    """Five lines and digit groups, four short entries, and three page references at line ends or a third of lines as entries."""

    def judge(x: Column) -> Column:
        entry = F.filter(x, lambda s: s.rlike(f"[{p.digits}]") & s.rlike(f"[{p.letters}]"))
        squeezed = F.transform(entry, lambda s: F.regexp_replace(s, f"{X.WS}+", " "))
        numbers = F.aggregate(entry, F.lit(0), lambda a, s: a + F.regexp_count(s, F.lit(f"[{p.digits}]{{1,3}}")))
        short = F.size(F.filter(squeezed, lambda s: F.length(s) <= 54))
        refs = F.size(F.filter(squeezed, lambda s: s.rlike(f"[{p.letters}].{{0,48}}[{p.digits}]{{1,3}} *$")))
        return (F.size(x) >= 5) & (numbers >= 5) & (short >= 4) & ((refs >= 3) | (short >= F.greatest(F.lit(5), F.floor(F.size(x) / 3))))

    return X.let(X.nonblank_lines(text), judge)


def page_type(text: Column, features: dict[str, Column], has_candidates: Column, p: PagePatterns = BANGLA) -> Column:
    """Eight types; the first rule that holds decides."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s​‌‍]+", "")
    n, chars, long, centred = (features[k] for k in ("line_count", "char_count", "long_line_count", "centeredish_line_count"))
    return (
        F.when((chars < 25) | (n <= 1), "blank_or_near_blank")
        .when(plain.rlike(p.publisher), "publisher_page")
        .when(plain.rlike(p.contents), "front_matter")
        .when(is_contents(text, p), "front_matter")
        .when(plain.rlike(p.front) & (long < 8), "front_matter")
        .when(plain.rlike(p.prose), "critical_prose_page")
        .when((n <= 8) & (centred >= F.greatest(F.lit(2), F.floor(n / 2))), "section_title_page")
        .when((long <= 2) & (n <= 14), "poem_start_or_short_page")
        .when(has_candidates & (n >= 8), "normal_poem_page")
        .otherwise("poem_or_text_page")
    )


def classified(pages: DataFrame, text: str = "text", p: PagePatterns = BANGLA) -> DataFrame:
    """``pages`` with the features, the candidates of page numbers and the page type."""
    features = X.structural_features(F.col(text), p.letters)
    out = pages.withColumns(features).withColumn("page_candidates", X.page_candidates(F.col(text)))
    named = {k: F.col(k) for k in features}
    return out.withColumn("page_type", page_type(F.col(text), named, F.size("page_candidates") > 0, p))


def changed_flags(flags: Column, old: Column, new: Column) -> Column:
    """A sorted set of flags with ``page_type_changed:a->b``."""
    flag = F.when(old != new, F.concat(F.lit("page_type_changed:"), old, F.lit("->"), new))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(F.coalesce(flags, X.no_strings()), F.array(flag)))))


def is_trusted(kind: Column) -> Column:
    """C4."""
    return kind.isin(*TRUSTED)


def candidate_counts(text: Column) -> Column:
    """struct(top, bottom, total) of the page-number candidates of a text."""
    found = X.page_candidates(text)
    of = lambda c, zone: F.size(F.filter(c, lambda s: s["zone"] == zone))
    return X.let(found, lambda c: F.struct(of(c, "top").alias("top"), of(c, "bottom").alias("bottom"), F.size(c).alias("total")))


def page_index(pages: DataFrame, trusted_only: bool = True) -> DataFrame:
    """The pages that an index by (book, printed page) holds: trusted first, and only those that have both keys.

    Joins on the two columns are the lookups; nothing is gathered by book.
    """
    rows = pages.where(is_trusted(F.col("page_type"))) if trusted_only else pages
    return rows.where("book_id IS NOT NULL AND printed_page IS NOT NULL")


def longest_profile(profiles: Column) -> Column:
    """Of struct(profile, text) the first with the longest text."""
    keyed = F.transform(profiles, lambda p, i: F.struct(F.length(p["text"]).alias("n"), (-i).alias("i"), p.alias("p")))
    return F.array_max(keyed)["p"]


def logical_sections(pages: DataFrame, rules: DataFrame, key: str = "physical_book_id", scan: str = "scan_page") -> DataFrame:
    """Each page gets the logical book of the first rule (by ``rule_order``) whose scan range holds it.

    A range join on an equal key. The few rules are a dimension; a page meets
    the rules of its own book only, and pages without one keep their book.
    """
    r = rules.select(F.col(key).alias("__k"), "start_scan", "end_scan", F.struct("rule_order", F.col("book_id").alias("logical_book_id")).alias("__r"))
    by_book = r.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct(F.col("__r.rule_order").alias("o"), "start_scan", "end_scan", F.col("__r.logical_book_id").alias("b")))).alias("__rules"))
    hit = F.filter("__rules", lambda x: F.col(scan).between(x["start_scan"], x["end_scan"]))
    joined = pages.join(by_book, F.col(key) == F.col("__k"), "left")
    return joined.withColumn("book_id", F.coalesce(F.get(hit, F.lit(0))["b"], F.col(key))).drop("__k", "__rules")


def document_pages(docs: DataFrame) -> DataFrame:
    """Documents as pages: a source is a book, the order of doc_id gives the scan numbers.

    Only the numbers are ordered by source; the texts are joined to them.
    """
    order = Window.partitionBy("book_id").orderBy("doc_id")
    numbers = docs.select("doc_id", F.col("source").alias("book_id")).withColumn("scan_page", F.row_number().over(order))
    return docs.select("doc_id", "text").join(numbers, "doc_id").select("doc_id", "book_id", "scan_page", "text")
