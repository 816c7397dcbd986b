"""Site-style views: dimensions joined to records, counts that include zero, ordered listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_dimension(rows: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """A left join on a dimension."""
    return rows.join(dim, F.col(key) == F.col(dim_key), "left")


def collected(parent: DataFrame, child: DataFrame, key: str, child_key: str, item: str, name: str) -> DataFrame:
    """Parents with the sorted list of their children, empty where there are none."""
    lists = child.groupBy(F.col(child_key).alias("__k")).agg(F.array_sort(F.collect_list(item)).alias(name))
    out = parent.join(lists, F.col(key) == F.col("__k"), "left").drop("__k")
    kind = out.schema[name].dataType.simpleString()
    return out.withColumn(name, F.coalesce(name, F.array().cast(kind)))


def counts_with_zero(dim: DataFrame, rows: DataFrame, key: str, row_key: str) -> DataFrame:
    """Every member of the dimension with the number of its rows; rows are counted before the join."""
    n = rows.groupBy(F.col(row_key).alias("__k")).agg(F.count("*").alias("__n"))
    return dim.join(n, F.col(key) == F.col("__k"), "left").withColumn("n", F.coalesce("__n", F.lit(0))).drop("__k", "__n")


def owner_rows(rows: DataFrame, owner: Column) -> DataFrame:
    """An owner's rows, hidden ones too."""
    return rows.where(owner)


def public_rows(rows: DataFrame, owner: Column, hidden: DataFrame, key: str) -> DataFrame:
    """An owner's rows without the hidden ones."""
    return rows.where(owner).join(hidden.select(key), key, "left_anti")


def has_printed_pages(sources: Column) -> Column:
    """A primary source with printed pages."""
    return F.exists(sources, lambda s: (s["role"] == "primary") & (s["page_basis"] == "printed_page") & s["page_start"].isNotNull() & s["page_end"].isNotNull())


def printed_sources(sources: Column) -> Column:
    """C6."""
    return F.filter(sources, lambda s: (s["role"] == "primary") & (s["page_basis"] == "printed_page") & s["page_start"].isNotNull() & s["page_end"].isNotNull())


def has_book_year(sources: Column) -> Column:
    """C7."""
    return F.exists(sources, lambda s: (s["role"] == "primary") & s["publication_year"].isNotNull())


def gap_rows(rows: DataFrame, sources: str) -> DataFrame:
    """Rows without a primary source with printed pages."""
    return rows.where(~F.coalesce(has_printed_pages(F.col(sources)), F.lit(False)))


def listing(rows: DataFrame, order: str, title: str, language: str = "bn") -> DataFrame:
    """By an order number, missing ones last, then by the title in a language's collation."""
    return rows.orderBy(F.col(order).asc_nulls_last(), F.collate(F.col(title), language))


def all_phases(phases: Column, strands: Column) -> Column:
    """Phases, then strands if there are any."""
    return F.concat(phases, F.coalesce(strands, F.slice(phases, 1, 0)))
