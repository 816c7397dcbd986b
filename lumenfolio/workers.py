"""This package on the Python path of a session's workers, which run its functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parent.parent)


def importable(job: Callable):
    """A job, whose first argument is the session, with the package's folder on the Python path of the workers."""

    @wraps(job)
    def run(spark: SparkSession, *args):
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
        if ROOT not in paths:
            env["PYTHONPATH"] = ":".join([ROOT, *paths])
        return job(spark, *args)

    return run
