"""Tables of contents: from detected pages to entries, and from entries to reviewed matches.

Titles meet entries by a set-similarity join that loses no pair of the least
score. A score is the largest of three (T42), and each has a key of its own:

* token F1 of at least t: both hold t / (2 - t) of either side's tokens, so they
  share one of the rarest n - ceil(t * n / (2 - t)) + 1 of each;
* gestalt ratio of at least t: what it matches is a common subsequence, so one
  text becomes the other by at most (1 - t) * (a + b) insertions and deletions.
  A deletion destroys at most two bigrams of a text, an insertion one, so some
  stay (``least_bigrams``), and they share one of the rarest of each;
* one text holds the other: the shorter one's bigrams are all in the longer.

Texts of at most seven characters meet over what is left of them after up to two
deletions. Keys carry the other side's length, so a common bigram's
rows are spread over lengths, and the prefix filters keep common tokens and
bigrams out of the keys of all texts that have rarer ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.profiles import LATIN, NormProfile
from . import sequence
from .matching import chosen_page, title_similarity, toc_status

#: Texts of at most so many characters meet by deletions; longer ones by bigrams.
SHORT, DELETIONS = 7, 2
#: The length ratio from which containment counts.
CONTAINED = 0.72


def compact(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def longest_ratio(least: float) -> float:
    """How many times longer one of two texts may be at most."""
    return max((2 - least) / least, 1 / CONTAINED)


def least_bigrams(length: Column, least: float) -> Column:
    """Bigrams that a text of this length has in common with any that reaches ``least``, by ratio or containment; at least 1.

    With d deletions alone, d <= (1 - least) * (2n - d), so d <= n * (2 - 2 least) / (2 - least);
    insertions alone destroy fewer. Of the n - 1 bigrams 2d go at most.
    """
    lost = 2 * (2 - 2 * least) / (2 - least)
    return F.greatest(F.lit(1), F.ceil(length * (1 - lost) - 1 - 1e-9)).cast("int")


def deletions(text: Column, most: int = DELETIONS) -> Column:
    """The text and all that is left of it after up to so many deletions."""
    out = F.array(text)
    for _ in range(most):
        cut = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, cut))))
    return out


def numbered_bigrams(text: Column) -> Column:
    """A text's bigrams, repeats told apart by their number."""
    grams = X.char_ngrams(text, 2)
    return X.let(grams, lambda g: F.transform(g, lambda x, i: F.concat(x, F.size(F.filter(F.slice(g, F.lit(1), i), lambda y: y == x)).cast("string"))))


def rarest(rows: DataFrame, seen: DataFrame, keep: Column) -> DataFrame:
    """Of (id, feature, n) each id's ``keep`` rarest features, by the counts of ``seen`` (feature, df)."""
    w = Window.partitionBy("id").orderBy(F.coalesce("df", F.lit(0)), "feature")
    return rows.join(seen, "feature", "left").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= keep)


def alike_pairs(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """Distinct (a_id, b_id) of texts (id, text) that may reach ``least``: all that do are among them."""
    ratio, t = longest_ratio(least), least / (2 - least)
    made = [x.where("text <> ''").withColumns({"c": compact(F.col("text")), "w": X.token_set(F.col("text"), 1)}).withColumn("len", F.length("c")) for x in (a, b)]

    def sizes(n: Column, most: float) -> Column:
        """All sizes of the other side that a side of size n may meet."""
        return F.explode(F.sequence(F.greatest(F.lit(1), F.ceil(n / most - 1e-9)).cast("int"), F.floor(n * most + 1e-9).cast("int")))

    def route(feature: Column, size: str, keep: Column, most: float, able: Column) -> DataFrame:
        each = [x.where(able).select("id", F.explode(feature).alias("feature"), F.col(size).alias("n")) for x in made]
        seen = each[1].groupBy("feature").agg(F.count("*").alias("df"))
        left, right = (rarest(x, seen, keep) for x in each)
        left = left.select(F.col("id").alias("a_id"), "feature", sizes(F.col("n"), most).alias("n"))
        return left.join(right.select(F.col("id").alias("b_id"), "feature", "n"), ["feature", "n"]).select("a_id", "b_id")

    made = [x.withColumn("n_words", F.size("w")) for x in made]
    by_token = route(F.col("w"), "n_words", F.col("n") - F.ceil(F.col("n") * t - 1e-9).cast("int") + 1, 1 / t, F.size("w") > 0)
    by_bigram = route(numbered_bigrams(F.col("c")), "len", F.col("n") - 1 - least_bigrams(F.col("n"), least) + 1, ratio, F.col("len") >= 6)
    short = [x.where(F.col("len") <= SHORT + 1).select(F.col("id").alias(f"{k}_id"), F.explode(deletions(F.col("c"))).alias("key")) for k, x in zip("ab", made, strict=True)]
    return by_token.union(by_bigram).union(short[0].join(short[1], "key").select("a_id", "b_id")).distinct()


def best_surfaces(surfaces: DataFrame, entries: DataFrame, least: float = 0.82) -> DataFrame:
    """For each item and entry the best surface by score, title first, of at least ``least``.

    Surfaces are (item_id, basis, line_index, text), entries (entry_id, entry_title),
    both normalised. Distinct texts are compared once.
    """
    a = surfaces.select(F.col("text")).distinct().withColumn("id", F.xxhash64("text", F.lit(1)))
    b = entries.select(F.col("entry_title").alias("text")).distinct().withColumn("id", F.xxhash64("text", F.lit(2)))
    pairs = alike_pairs(a, b, least).join(a.select(F.col("id").alias("a_id"), F.col("text").alias("text")), "a_id").join(b.select(F.col("id").alias("b_id"), F.col("text").alias("entry_title")), "b_id")
    x, y = compact(F.col("text")), compact(F.col("entry_title"))
    both = F.length(x) + F.length(y)
    close = (2 * F.least(F.length(x), F.length(y)) >= (least - 1e-4) * both) & (F.levenshtein(x, y) <= (1 - least) * both + 1e-4)
    able = close | (X.token_f1(X.token_set(F.col("text"), 1), X.token_set(F.col("entry_title"), 1)) >= least - 1e-4) | (X.containment_score(x, y) >= least - 1e-4)
    scored = pairs.where(able).select("text", "entry_title", title_similarity(F.col("text"), F.col("entry_title")).alias("score")).where(F.col("score") >= least)
    met = surfaces.join(scored, "text").join(entries, "entry_title")
    w = Window.partitionBy("item_id", "entry_id").orderBy(F.col("score").desc(), (F.col("basis") == "title").desc(), F.col("line_index").asc_nulls_first())
    return met.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def contents_entries(pages: DataFrame, marker: str, letters: str, profile: NormProfile = LATIN) -> DataFrame:
    """entry_id, toc_book, toc_scan, toc_line, entry_title, page, verified, candidate_book, candidate_scan: the entries of all contents pages.

    Pages are (physical_book, book_id, scan_page, page_type, printed_page, basis,
    confidence, text). A contents page opens with the marker and goes on through
    front matter with numbers and letters enough (C24, W18). An entry's page is
    looked up among its physical book's printed pages (J22), the best row of each;
    entries that repeat (book, page, title) count once, the first in order.
    """
    from .imports import toc_continues, toc_start

    front = F.col("page_type") == "front_matter"
    states = sequence.state_islands(pages, ["physical_book"], "scan_page", toc_start(F.col("page_type"), F.lower("text"), marker), front & toc_continues(F.col("text"), letters))
    lines = states.where("active").select("physical_book", F.col("book_id").alias("own_book"), F.col("scan_page").alias("toc_scan"), F.posexplode(X.lines(F.col("text"))).alias("toc_line", "raw"))
    found = lines.select("physical_book", "own_book", "toc_scan", "toc_line", F.posexplode(X.toc_entries(F.col("raw"))).alias("at", "e"))
    found = found.select("*", X.normalize(F.col("e.title"), profile).alias("entry_title"), F.col("e.page").alias("page")).where((X.letter_count(F.col("e.title"), letters) >= 2) & ~F.col("entry_title").rlike(f"^({marker})$"))
    rows = chosen_page(pages.where("printed_page IS NOT NULL").select("physical_book", F.col("printed_page").alias("page"), F.col("book_id").alias("page_book"), "scan_page", "page_type", "basis", "confidence"), ["physical_book", "page"])
    t = found.join(rows.select("physical_book", "page", "page_book", F.col("scan_page").alias("candidate_scan")), ["physical_book", "page"], "left")
    t = t.withColumn("candidate_book", F.coalesce("page_book", "own_book"))
    w = Window.partitionBy("physical_book", "candidate_book", "page", "entry_title").orderBy("toc_scan", "toc_line", "at")
    t = t.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    key = F.xxhash64("physical_book", "candidate_book", "page", "entry_title")
    return t.select(key.alias("entry_id"), F.col("physical_book").alias("toc_book"), "toc_scan", "toc_line", "entry_title", "page", F.col("candidate_scan").isNotNull().alias("verified"), "candidate_book", "candidate_scan")


def contents_audit(items: DataFrame, surfaces: DataFrame, entries: DataFrame, titles: DataFrame, unknown: str, least: float = 0.82) -> DataFrame:
    """Of each item its best entry, the lead over the next, and its status.

    Items are (item_id, edition, title), title normalised; ``titles`` (book_id, canonical) names
    books. An item of unknown edition may match any book (J29), others their own
    edition's. Titles that several items have are duplicates (J21).
    """
    from .reports import duplicates

    met = best_surfaces(surfaces, entries.select("entry_id", "entry_title"), least)
    t = met.join(entries.drop("entry_title"), "entry_id").join(titles.select(F.col("book_id").alias("candidate_book"), "canonical"), "candidate_book", "left").join(items.select("item_id", "edition", "title"), "item_id")
    open_ = (F.col("edition") == unknown) | F.col("edition").eqNullSafe(F.col("canonical"))
    order = (F.col("verified").desc(), F.col("score").desc(), (F.col("basis") == "title").desc(), "page", "entry_id")
    w = Window.partitionBy("item_id").orderBy(*order)
    ranked = t.where(open_).withColumns({"rn": F.row_number().over(w), "next": F.lead("score").over(w)}).where("rn = 1")
    twice = duplicates(items.where("title <> ''"), "title").select("title", F.lit(True).alias("twice"))
    out = ranked.join(twice, "title", "left")
    conflict = (F.col("edition") != unknown) & ~F.col("edition").eqNullSafe(F.col("canonical"))
    status = toc_status(F.col("verified"), F.coalesce("twice", F.lit(False)), F.col("basis"), conflict, F.col("edition") == unknown, F.col("score"), F.col("score") - F.coalesce("next", F.lit(0.0)))
    return out.select("item_id", "entry_id", "toc_book", "toc_scan", "page", "candidate_book", "candidate_scan", "basis", "entry_title", "score", (F.col("score") - F.col("next")).alias("runner_up_gap"), status.alias("status"))

