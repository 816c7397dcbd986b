"""Import-side rules: precedence of metadata, earlier versions, guards, and small statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def candidates_of(rows: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Every candidate with its row; ``found`` tells the candidates whose row is missing."""
    return candidates.join(rows.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def first_titles(known: DataFrame, title: str, value: str, order: str) -> DataFrame:
    """A map from title to value in which the first title wins."""
    return known.groupBy(title).agg(F.min_by(value, order).alias(value))


def with_precedence(rows: DataFrame, known: DataFrame, hints: DataFrame, titles: DataFrame, key: str, title: str, value: str) -> DataFrame:
    """Known by key, else hinted by key, else by title.

    Each side is unique by its key; a known row wins even if its value is null.
    """
    k = known.select(key, F.struct(F.col(value).alias("v")).alias("__k"))
    t = rows.join(k, key, "left").join(hints.select(key, F.col(value).alias("__h")), key, "left").join(titles.select(title, F.col(value).alias("__t")), title, "left")
    return t.withColumn(value, F.when(F.col("__k").isNotNull(), F.col("__k.v")).otherwise(F.coalesce("__h", "__t"))).drop("__k", "__h", "__t")


def keep_verified(new: DataFrame, old: DataFrame, key: str, column: str, verified: str) -> DataFrame:
    """The earlier version's value where that version is verified, else the new one."""
    o = old.select(key, F.col(column).alias("__old"), F.col(verified).alias("__ok"))
    return new.join(o, key, "left").withColumn(column, F.when(F.coalesce("__ok", F.lit(False)), F.col("__old")).otherwise(F.col(column))).drop("__old", "__ok")


def guarded(rows: DataFrame, owner: str, allowed: list[str], denied: list[str]) -> DataFrame:
    """A denied owner, or one that isn't allowed, is an error when its row is reached."""
    c = F.col(owner)
    bad = F.when(c.isin(denied), F.concat(F.lit("excluded: "), c)).when(~c.isin(allowed), F.concat(F.lit("not allowed: "), c))
    return rows.where(F.when(bad.isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(F.lit(True)))


def layout_status(image: Column, words: Column) -> Column:
    """C23."""
    return F.when(~image, "missing_image").when(words == 0, "empty_tsv").otherwise("ok")


def toc_start(kind: Column, text: Column, marker: str) -> Column:
    """Front matter with a contents marker."""
    return (kind == "front_matter") & F.coalesce(text, F.lit("")).rlike(marker)


def toc_continues(text: Column, letters: str, numbers: int = 8, least: int = 80) -> Column:
    """Enough page numbers and letters."""
    digits = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[০-৯0-9]{1,3}"))
    return (digits >= numbers) & (X.letter_count(text, letters) >= least)


def whole_number(value: Column) -> Column:
    """The value if it is a whole number, else null."""
    return F.when(value.cast("string").rlike("^-?[0-9]+$"), value.cast("string").try_cast("int"))


def scan_number(scan: Column, position: Column) -> Column:
    """The scan page, or else the row's position from 1."""
    return F.coalesce(scan, position + 1)
