"""Lexicon building, unknown tokens, suggestions and substitutions, and text quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.kernels import gestalt_ratio


def tokens_of(rows: DataFrame, key: str, words: Column) -> DataFrame:
    """key, pos, token."""
    return rows.select(key, F.posexplode(words).alias("pos", "token"))


def lexicon(tokens: DataFrame, key: Column, loose: Column) -> DataFrame:
    """Token, count, and its two grouping keys, which are expressions over ``token``."""
    return tokens.groupBy("token").agg(F.count("*").alias("count")).withColumns({"key": key, "loose": loose})


def unknown_tokens(tokens: DataFrame, known: DataFrame, page: str, top: int = 12) -> DataFrame:
    """Per page the unknown tokens, their share (3 decimals) and the most frequent ones."""
    missing = tokens.join(known.select("token"), "token", "left_anti").groupBy(page, "token").agg(F.count("*").alias("n"))
    ranked = missing.withColumn("rn", F.row_number().over(Window.partitionBy(page).orderBy(F.col("n").desc(), "token")))
    sums = ranked.groupBy(page).agg(F.sum("n").alias("unknown"), F.array_sort(F.collect_list(F.when(F.col("rn") <= top, F.struct("rn", "token")))).alias("t"))
    total = tokens.groupBy(page).agg(F.count("*").alias("total"))
    out = total.join(sums, page, "left").withColumn("unknown", F.coalesce("unknown", F.lit(0)))
    return out.select(page, "total", "unknown", F.round(F.col("unknown") / F.col("total"), 3).alias("unknown_ratio"), F.coalesce(F.transform("t", lambda x: x["token"]), X.no_strings()).alias("top_unknown"))


def token_places(tokens: DataFrame, book: str, page: str, most: int = 4) -> DataFrame:
    """Token, books, pages in order (a page may repeat) up to ``most``; only those few are gathered per token."""
    w = Window.partitionBy("token").orderBy(page, "pos")
    first = tokens.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most).groupBy("token").agg(F.array_sort(F.collect_list(F.struct("rn", page))).alias("p"))
    books = tokens.groupBy("token").agg(F.countDistinct(book).alias("books"), F.count("*").alias("count"))
    return books.join(first, "token").select("token", "books", "count", F.transform("p", lambda x: x[page]).alias("first_pages"))


#: Tokens of at most so many characters meet by deletions, those of at least so many by bigrams; together they leave no pair out.
MOST_DELETED, LEAST_BIGRAMS = 5, 4


def similar_pairs(odd: DataFrame, known: DataFrame, least: float = 0.78, apart: int = 2) -> DataFrame:
    """odd_token, token: pairs of the same first letter and lengths at most ``apart`` that may reach a gestalt ratio; all that do are among them.

    What a ratio matches is a common subsequence, so it bounds the deletions and
    insertions between two tokens, and these the bigrams that stay common
    (``contents.least_bigrams``). Long tokens meet over one of their rarest
    bigrams, with the first letter and the length, so no key holds all
    tokens of a letter; short ones over what is left after deletions. Sides are (odd_token)
    and (token), distinct; known tokens count the bigrams.
    """
    from .contents import deletions, least_bigrams, numbered_bigrams, rarest

    sides = [x.select(F.col(c).alias("id"), F.length(c).alias("n"), F.substring(c, 1, 1).alias("letter")) for x, c in ((odd, "odd_token"), (known, "token"))]
    each = [x.where(F.col("n") >= LEAST_BIGRAMS).select("id", "letter", "n", F.explode(numbered_bigrams(F.col("id"))).alias("feature")) for x in sides]
    seen = each[1].groupBy("feature").agg(F.count("*").alias("df"))
    left, right = (rarest(x, seen, F.col("n") - least_bigrams(F.col("n"), least)) for x in each)
    near = F.explode(F.transform(F.sequence(F.lit(-apart), F.lit(apart)), lambda d: F.col("n") + d))
    by_bigram = left.select(F.col("id").alias("odd_token"), "letter", "feature", near.alias("n")).join(right.select(F.col("id").alias("token"), "letter", "feature", "n"), ["letter", "feature", "n"])
    short = [x.where(F.col("n") <= MOST_DELETED).select(F.col("id").alias(c), "letter", F.explode(deletions(F.col("id"))).alias("rest")) for x, c in zip(sides, ("odd_token", "token"), strict=True)]
    pairs = by_bigram.select("odd_token", "token").union(short[0].join(short[1], ["letter", "rest"]).select("odd_token", "token")).distinct()
    return pairs.where((F.abs(F.length("odd_token") - F.length("token")) <= apart) & (F.levenshtein("odd_token", "token") <= (1 - least) * (F.length("odd_token") + F.length("token")) + 1e-9))


def suggestions(odd: DataFrame, known: DataFrame, most: int = 5, least_ratio: float = 0.78, own: DataFrame | None = None) -> DataFrame:
    """odd_token, token, score, count, basis, rank: equal keys 1.0, equal loose keys 0.94, else a gestalt ratio.

    Loose keys are asked only where keys give fewer than ``most``, similarity
    only where both do; of the similar ones the first 6 * most in the order
    of counts are looked at. Similar pairs have the same first letter and lengths within
    2, and meet by ``similar_pairs``. ``own`` (odd_token, token, count) is taken
    off the counts: what the odd token's own file holds.
    """
    a = odd.select(F.col("token").alias("odd_token"), F.col("key").alias("odd_key"), F.col("loose").alias("odd_loose"))
    usable = known
    pick = lambda t, score, basis: t.where(F.col("token") != F.col("odd_token")).select("odd_token", "token", F.lit(score).alias("score") if not isinstance(score, Column) else score.alias("score"), "count", F.lit(basis).alias("basis"))
    first = lambda t, n: t.withColumn("rn", F.row_number().over(Window.partitionBy("odd_token").orderBy(F.col("count").desc(), "token"))).where(F.col("rn") <= n).drop("rn")

    def less_own(t: DataFrame) -> DataFrame:
        if own is None:
            return t.where("count > 0")
        left = t.join(own.withColumnRenamed("count", "mine"), ["odd_token", "token"], "left")
        return left.withColumn("count", F.greatest(F.lit(0), F.col("count") - F.coalesce("mine", F.lit(0)))).drop("mine").where("count > 0")

    exact = less_own(pick(first(a.join(usable, F.col("odd_key") == F.col("key")), 2 * most), 1.0, "ocr_equivalence"))
    have = exact.groupBy("odd_token").agg(F.count("*").alias("have"))
    open_ = a.join(have, "odd_token", "left").where((F.coalesce("have", F.lit(0)) < most) & (F.length("odd_loose") >= 2))
    loose = less_own(pick(first(open_.join(usable, F.col("odd_loose") == F.col("loose")), 2 * most), 0.94, "loose_vowel_key"))
    have = exact.unionByName(loose).groupBy("odd_token").agg(F.count("*").alias("have"))
    left = a.join(have, "odd_token", "left").withColumn("have", F.coalesce("have", F.lit(0))).where(F.col("have") < most)
    pairs = similar_pairs(left.select("odd_token").distinct(), usable.select("token").distinct(), least_ratio)
    pairs = pairs.join(left.select("odd_token", "have"), "odd_token").join(usable.select("token", "count"), "token")
    similar = less_own(pairs.where(F.col("token") != F.col("odd_token")).select("odd_token", "have", "token", "count")).withColumn("score", gestalt_ratio(F.col("odd_token"), F.col("token"))).where(F.col("score") >= least_ratio)
    rank = F.row_number().over(Window.partitionBy("odd_token").orderBy(F.col("count").desc(), "token"))
    similar = similar.withColumn("rn", rank).where(F.col("rn") <= 6 * most - F.col("have")).select("odd_token", "token", "score", "count", F.lit("edit_similarity").alias("basis"))
    every = exact.unionByName(loose).unionByName(similar)
    order = F.when(F.col("basis") == "ocr_equivalence", 0).when(F.col("basis") == "loose_vowel_key", 1).otherwise(2)
    best = every.withColumn("rn", F.row_number().over(Window.partitionBy("odd_token", "token").orderBy(F.col("score").desc(), order))).where("rn = 1").drop("rn")
    w = Window.partitionBy("odd_token").orderBy(F.col("score").desc(), F.col("count").desc(), "token")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).withColumn("score", F.round("score", 3))


def substitutions(odd: DataFrame, suggested: DataFrame, least_count: int = 8, least_score: float = 0.94, least_known: int = 20, dominance: float = 2.0) -> DataFrame:
    """Token, replacement, score of odd tokens frequent enough whose first suggestion is sure: on equal scores twice as frequent as the second."""
    w = Window.partitionBy("odd_token").orderBy("rank")
    s = suggested.withColumn("next_score", F.lead("score").over(w)).withColumn("next_count", F.lead("count").over(w)).where("rank = 1")
    sure = (F.col("score") >= least_score) & (F.col("count") >= least_known)
    alone = F.col("next_score").isNull() | (F.col("next_score") != F.col("score")) | (F.col("count") >= F.floor(F.col("next_count") * dominance))
    frequent = odd.where(F.col("count") >= least_count).select(F.col("token").alias("odd_token"), F.col("count").alias("odd_count"))
    return s.where(sure & alone).join(frequent, "odd_token").select("odd_token", F.col("token").alias("replacement"), "odd_count", "score", F.col("count").alias("known_count"), "basis")


def quality_issues(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Key, kind and count of line issues."""
    issue = F.explode(F.flatten(F.transform(X.lines(F.col(text)), lambda x: X.line_issues(x))))
    return rows.select(key, issue.alias("kind")).groupBy(key, "kind").agg(F.count("*").alias("n"))
