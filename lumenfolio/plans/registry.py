"""All queries over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import evidence_queries, import_queries, matching_queries, record_queries, relational_queries, sequence_queries, source_queries, text_queries  # noqa: F401
from .base import ORACLES, QUERIES


def queries() -> dict:
    return QUERIES


def oracles() -> dict[str, str]:
    return ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["phrase_window_audit"](spark, sf_dir)
