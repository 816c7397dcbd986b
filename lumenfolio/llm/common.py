"""Pieces shared by the training-data operators: tables, scratch tables, column helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words everywhere in this subpackage.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, read by Spark's Parquet reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what ``spark.checkpoint.dir`` names. Where that is unset, a local
    session (as in tests) gets a temporary folder of its own; on a cluster, no
    folder of one machine would do, so it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="lumenfolio-")
        atexit.register(shutil.rmtree, found, True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


class Scratch:
    """Tables of one run in the shared folder, which cut the lineage.

    Compressed and columnar, so they are smaller than a checkpoint of rows, and
    they survive the loss of any executor.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and read it again."""
        path = f"{shared_dir(self.spark)}/lumenfolio/{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Write the result, which stays, and delete all other tables of the run."""
        done, spent = self.keep(df), self.paths[:-1]
        self.paths = self.paths[-1:]
        for path in spent:
            remove(self.spark, path)
        return done


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder by the file system that its path names."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; one scan of one column with a partial sum."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def free_names(taken: list[str], names: tuple[str, ...]) -> dict[str, str]:
    """A name for each of an operator's columns: its own, or with underscores behind it where an input column has it."""
    used, out = {t.lower() for t in taken}, {}
    for name in names:
        free = name
        while free.lower() in used:
            free += "_"
        used.add(free.lower())
        out[name] = free
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents whose labels must not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def release() -> None:
    """Give freed memory back to the system: a Python worker that waits for its next task must not hold it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not a GNU system
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``f`` of batches, with ``release`` behind the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        release()

    return run


#: Groups between two releases: each makes the next group fault its memory in again.
RELEASE_EVERY = 4
_groups = 0


def _release_at_times() -> None:
    global _groups
    _groups += 1
    if _groups % RELEASE_EVERY == 0:
        release()


def tidy_group(f: Callable[[pa.Table], pa.Table]):
    """``f`` of one group, with ``release`` behind every few of them."""

    def run(t: pa.Table) -> pa.Table:
        out = f(t)
        _release_at_times()
        return out

    return run


def tidy_cogroup(f: Callable[[pa.Table, pa.Table], pa.Table]):
    """``f`` of two groups, with ``release`` behind every few of them."""

    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        out = f(t, r)
        _release_at_times()
        return out

    return run
