"""Registration of queries with their SQL, and the driver's tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name; ``sql`` is DuckDB SQL for the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share: under ``spark.checkpoint.dir``, or a temporary one of a local session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="lumenfolio-")
        atexit.register(shutil.rmtree, found, True)
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found}/lumenfolio/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: worked out once, however many steps read it, and safe from lost executors."""
    path = folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# SQL fragments: the Latin normalisation profile, and words of a normalised text.
WS = r"[ \t\n\r\f\x0b]"


def norm(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(translate(regexp_replace(coalesce({t}, ''), '[\x{{200b}}\x{{200c}}\x{{200d}}]', '', 'g'), '০১২৩৪৫৬৭৮৯', '0123456789')), '[^\p{{L}}\p{{M}}\p{{N}} \t\n\r\f\x0b]+', ' ', 'g'), '{WS}+', ' ', 'g'))"


def words(normal: str) -> str:
    return f"(CASE WHEN {normal} = '' THEN [] ELSE string_split({normal}, ' ') END)"
