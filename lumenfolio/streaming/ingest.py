"""Extension: page rows as a stream, with the same classifiers (the engine's batch operators are row-local there)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pages as P


def page_stream(spark: SparkSession, path: str, schema: str, most_files: int = 64) -> DataFrame:
    """Page rows as they arrive in a folder of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def classified_stream(pages: DataFrame, text: str = "text", patterns: P.PagePatterns = P.LATIN) -> DataFrame:
    return P.classified(pages, text, patterns)


def windowed_counts(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts of each kind in tumbling windows; rows later than the watermark are dropped, and its state is bounded by it."""
    w = F.window(time, window)
    return events.withWatermark(time, late).groupBy(w, kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def deduplicated(rows: DataFrame, key: str, time: str, late: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
