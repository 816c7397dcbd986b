"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio.

Every document gets base counts and a score: the mean, over its token
unigrams and bigrams, of log p_target - log p_raw, where both are smoothed
multinomials over hash buckets. The raw counts cover the whole corpus; the
target counts come from trusted documents. A document is kept if it passes
the base rule and its score is at least a threshold, taken from the trusted
documents' scores; nothing is drawn at random.

All of it is DataFrame expressions: no Python runs on executors. Counts are
pre-aggregated per task into a fixed number of buckets, and only those
buckets reach the driver, whatever the input's size. Scoring is row-local.

Defined cases: a null text has no words and fails the base rule; an empty
text likewise; null doc_ids stay null; repeated rows are judged once each;
with no trusted documents the base rule alone decides; an empty table gives
no rows; other columns pass through ``judge`` untouched, and where one has the
name of an added column, the added one gets an underscore behind its name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, Scratch, free_names, table

#: Buckets of unigrams and of bigrams; one more for a token that repeats the one before it.
BUCKETS = 1 << 13
SLOTS = 2 * BUCKETS + 1
#: Up to so many ids of trusted documents (8 bytes each) are broadcast; beyond it, ids and texts are shuffled.
BROADCAST_IDS = 500_000
#: Standard deviations below the trusted documents' mean score.
DEVIATIONS = 8.0
#: Runs of letters, marks, digits and _, or of other signs; ASCII ranges stand first and runs are possessive only for speed.
TOKEN = r"[a-zA-Z0-9_\p{L}\p{M}\p{N}]++|[!-/:-@\[-^`{-~[^\p{L}\p{M}\p{N}_\s]]++"
WINDOW = 8
MIN_WORDS = 20


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, even where lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")  # only the ends can be empty


def repeat_words(words: Column, k: int = WINDOW) -> Column:
    """How many words lie in a k-word window that is found twice or more in the text."""

    def covered(hashes: Column) -> Column:
        # (hash, place) sorted: a window is repeated if a neighbour has its hash
        def places(s: Column) -> Column:
            n = F.size(s)
            near = lambda i, d: F.coalesce(F.get(s, i + d)["h"] == F.get(s, i)["h"], F.lit(False))
            again = F.filter(F.sequence(F.lit(0), n - 1), lambda i: near(i, 1) | near(i, -1))
            at = F.array_sort(F.transform(again, lambda i: F.get(s, i)["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(at, start, lambda a, p: F.struct((a["n"] + p + k - F.greatest(p, a["end"])).alias("n"), (p + k).alias("end")))["n"]

        keyed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(keyed, places))

    def joined(a: Column, b: Column, width: int) -> Column:
        # hashes of windows of two widths, one behind the other
        n = F.size(b) - width
        return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(width + 1), n), lambda x, y: F.xxhash64(x, y))

    def windows(single: Column, width: int) -> Column:
        # of half the width twice, so a window costs few hashes however wide it is
        if width == 1:
            return single
        half = lambda h: joined(h, h, width // 2)
        even = let(windows(single, width // 2), half)
        return even if width % 2 == 0 else let(even, lambda e: joined(e, single, width - 1))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= k, F.lit(0)).otherwise(let(let(hashes, lambda h: windows(h, k)), covered))


def base_columns() -> dict[str, Column]:
    """The base counts, as expressions over columns ``text`` and ``__words``."""
    t, w = F.col("text"), F.col("__words")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(w).cast("long"),
    }


def buckets(text: Column) -> Column:
    """Hash buckets of a text's tokens (runs of letters and digits, or of other signs) and of their bigrams.

    A token equal to the one before it makes a bigram of its own bucket,
    whatever the token.
    """
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 0)

    def both(t: Column) -> Column:
        single = F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))
        follow = F.when(F.size(t) > 1, F.slice(t, F.lit(2), F.size(t) - 1)).otherwise(F.array().cast("array<string>"))
        pair = F.zip_with(F.slice(t, F.lit(1), F.size(follow)), follow, lambda a, b: F.when(a == b, F.lit(2 * BUCKETS)).otherwise(F.lit(BUCKETS) + F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int")))
        return F.concat(single, pair)

    return let(tokens, both)


def counts(docs: DataFrame) -> list[int]:
    """Occurrences of each bucket in all texts; SLOTS numbers, whatever the input."""
    return counts_by(docs.withColumn("flag", F.lit(True)))[True]


def counts_by(docs: DataFrame) -> dict[bool, list[int]]:
    """Occurrences of each bucket in the texts with and in those without ``flag``; 2 * SLOTS numbers."""
    out = {flag: [0] * SLOTS for flag in (True, False)}
    for r in docs.select("flag", F.explode(buckets(F.col("text"))).alias("b")).groupBy("flag", "b").count().collect():
        out[r["flag"]][r["b"]] = r["count"]
    return out


def weights(target: list[int], raw: list[int], smooth: float = 1.0) -> list[float]:
    """log p_target - log p_raw of each bucket, to four decimals."""
    t, r = sum(target) + smooth * len(target), sum(raw) + smooth * len(raw)
    return [round(math.log((a + smooth) / t) - math.log((b + smooth) / r), 4) for a, b in zip(target, raw, strict=True)]


def score(text: Column, table_: list[float]) -> Column:
    """Mean weight of a text's n-grams; 0 for a text without any."""
    known = F.split(F.lit(",".join(map(str, table_))), ",").cast("array<double>")  # folded to one literal
    mean = lambda b: F.aggregate(b, F.lit(0.0), lambda a, x: a + F.get(known, x)) / F.greatest(F.size(b), F.lit(1))
    return let(buckets(text), mean)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of all documents that labels call good; a broadcast if they are few enough."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return F.broadcast(good) if good.count() <= BROADCAST_IDS else good


class Verdict:
    """Weights and threshold learned from a corpus."""

    def __init__(self, table_: list[float] | None, threshold: float):
        self.weights, self.threshold = table_, threshold


def learn_weights(docs: DataFrame, labels: DataFrame) -> list[float] | None:
    """Weights from the multinomials of the whole corpus and of all trusted documents, counted in one scan; None without any."""
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(trusted_ids(labels).withColumn("flag", F.lit(True)), "doc_id", "left")
    found = counts_by(flagged.withColumn("flag", F.coalesce("flag", F.lit(False))))
    target = found[True]
    return weights(target, [a + b for a, b in zip(target, found[False], strict=True)]) if sum(target) else None


def threshold_of(scores: DataFrame, deviations: float = DEVIATIONS) -> float:
    """So many deviations below the mean of trusted documents' scores ``llr_score``."""
    mean, spread = scores.agg(F.avg("llr_score"), F.stddev_pop("llr_score")).first()
    return -math.inf if mean is None else round(mean - deviations * spread, 6)


def learn(docs: DataFrame, labels: DataFrame, deviations: float = DEVIATIONS) -> Verdict:
    """Weights, and the threshold from the trusted documents that are long enough."""
    known = learn_weights(docs, labels)
    if known is None:
        return Verdict(None, 0.0)
    good = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(trusted_ids(labels), "doc_id", "left_semi")
    long = good.where(F.size(words_of(F.col("text"))) >= MIN_WORDS)
    return Verdict(known, threshold_of(long.select(score(F.col("text"), known).alias("llr_score")), deviations))


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr_score", "kept")


def judge(docs: DataFrame, verdict: Verdict) -> DataFrame:
    """``docs`` with the columns ``ADDED``: the base counts, whether the base rule fails, the score, and the verdict."""
    names = free_names(docs.columns, ADDED)
    text = F.coalesce(F.col("text"), F.lit(""))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text")).withColumn("__words", words_of(F.col("text")))
    inner = inner.withColumns(base_columns())
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    ratio = score(F.col("text"), verdict.weights) if verdict.weights else F.lit(0.0)
    inner = inner.withColumn("base_failed", failed).withColumn("llr_score", ratio)
    good = F.lit(True) if verdict.weights is None else F.col("llr_score") >= verdict.threshold
    inner = inner.withColumn("kept", ~F.col("base_failed") & good)
    return inner.select(*[F.col("row")[c].alias(c) for c in docs.columns], *[F.col(n).alias(names[n]) for n in ADDED])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge all documents; each is scored once, and the threshold comes from the scores of the trusted ones."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    known = learn_weights(docs, labels)
    scored = Scratch(spark).keep(judge(docs, Verdict(known, -math.inf)).drop("text"))
    if known is not None:
        least = threshold_of(scored.where(F.col("n_words") >= MIN_WORDS).join(trusted_ids(labels), "doc_id", "left_semi"))
        scored = scored.withColumn("kept", F.col("kept") & (F.col("llr_score") >= least))
    return scored.select("doc_id", *ADDED)
