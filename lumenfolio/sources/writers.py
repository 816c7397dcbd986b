"""Writers (K1-K7). Tables are written by executors; only one-row summaries and capped reports pass the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_report(rows: DataFrame, path: str) -> None:
    """K1: rows as JSON, null fields kept, non-ASCII as it is."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_lines(rows: DataFrame, path: str) -> None:
    """K2: columns in the order of their names."""
    rows.select(*sorted(rows.columns)).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def corpus(rows: DataFrame, path: str, force: bool = False) -> None:
    """K3: appends by default (a second run repeats its rows), overwrites if forced."""
    rows.write.mode("overwrite" if force else "append").parquet(path)


def upsert(current: DataFrame, changed: DataFrame, key: str, path: str | None, dry_run: bool = True) -> DataFrame:
    """K4: the new version of a table: changed rows in place of those with their key.

    It is returned; unless ``dry_run`` it is also written, as a new version at
    ``path``. The current table is never touched.
    """
    new = current.join(changed.select(key), key, "left_anti").unionByName(changed.select(*current.columns))
    if not dry_run:
        new.write.mode("errorifexists").parquet(path)
    return new


def replace_partition(rows: DataFrame, path: str, partition: str) -> None:
    """K7: replaces the partitions that the rows have, and leaves the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def report(rows: DataFrame, summary: DataFrame, path: str) -> None:
    """A relation and its one-row summary, side by side."""
    json_report(rows, f"{path}/rows")
    json_report(summary.limit(1).select(F.struct("*").alias("summary")), f"{path}/summary")


def text_file(spark: SparkSession, path: str, text: str) -> None:
    """A small text file under a given name, by the file system that its path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(text.encode()))
    out.close()
