"""Versioned tables with a ledger of content digests: incremental appends and checked updates (K3, K4, idempotent re-runs).

A versioned table is a folder. Each version is a folder of Parquet files of its
own, ``v-<number>-<token>``, written whole before anybody can read it. A version
counts once its pointer stands: ``current/<number>``, a file that holds the
folder's name, made by renaming a finished file to a name that must not exist
yet. A file system whose rename refuses to replace (HDFS; on a local disk the
check and the rename are two steps) lets just one of two writers take a number;
the other sees its rename refused and starts again from the new version. A job
that is killed leaves an unreferenced folder, which ``vacuum`` deletes, and the
old version whole.

Nothing but the pointer's name passes the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Attempts to take the next number before a writer gives up.
MOST_ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another writer took the number of the version that was to be published."""


def content_digest(columns: list[str]) -> Column:
    """SHA-256 of some columns' values, nulls told apart from texts."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


class VersionedTable:
    """A table at ``path``, read and written by its versions."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.spark, self.path, self._place = spark, path.rstrip("/"), jvm.org.apache.hadoop.fs.Path
        self.files = self._place(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place = self._place(f"{self.path}/{folder}" if folder else self.path)
        return [s.getPath().getName() for s in self.files.listStatus(place)] if self.files.exists(place) else []

    def number(self) -> int:
        """The current version's number; 0 before there is one."""
        return max((int(n) for n in self._names("current") if n.isdigit()), default=0)

    def folder(self, number: int) -> str:
        stream = self.files.open(self._place(f"{self.path}/current/{number:012}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, number: int | None = None) -> DataFrame | None:
        """A version's rows, by default the current one's; None before there is one."""
        number = self.number() if number is None else number
        return self.spark.read.parquet(f"{self.path}/{self.folder(number)}") if number else None

    def publish(self, rows: DataFrame, base: int) -> int:
        """Writes ``rows`` as the version behind ``base``; a Conflict if there is one already."""
        name = f"v-{base + 1:012}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.path}/{name}")
        ready, pointer = self._place(f"{self.path}/pending/{name}"), self._place(f"{self.path}/current/{base + 1:012}")
        self.files.mkdirs(pointer.getParent())
        out = self.files.create(ready, False)
        out.write(bytearray(name.encode()))
        out.close()
        if self.files.exists(pointer) or not self._take(ready, pointer):
            raise Conflict(f"version {base + 1} of {self.path} is taken")
        return base + 1

    def _take(self, ready, pointer) -> bool:
        """One rename that doesn't replace: True for the writer that gets the name."""
        from py4j.protocol import Py4JJavaError

        hadoop, conf = self.spark.sparkContext._jvm.org.apache.hadoop.fs, self.spark.sparkContext._jsc.hadoopConfiguration()
        plainly = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(self.files.getUri(), conf).rename(self.files.makeQualified(ready), self.files.makeQualified(pointer), plainly)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def commit(self, make: Callable[[DataFrame | None], DataFrame | None]) -> int:
        """Publishes what ``make`` gives for the current rows, again from the newest version if another writer was first; None changes nothing."""
        for _ in range(MOST_ATTEMPTS):
            base = self.number()
            rows = make(self.read(base) if base else None)
            if rows is None:
                return base
            try:
                return self.publish(rows, base)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: no version could be published in {MOST_ATTEMPTS} attempts")

    def vacuum(self) -> list[str]:
        """Deletes folders that no pointer names and pointers in waiting; not to be run beside writers."""
        known = {self.folder(int(n)) for n in self._names("current") if n.isdigit()}
        gone = [n for n in self._names("") if n.startswith("v-") and n not in known]
        for name in [*gone, *(["pending"] if self._names("pending") else [])]:
            self.files.delete(self._place(f"{self.path}/{name}"), True)
        return gone


@dataclass
class Update:
    """What a run did: the version behind it, and how many rows were new or changed, and skipped."""

    version: int
    fresh: int
    skipped: int


LEDGER = "__digest"


def _beside(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, list[Column]]:
    """Some columns of the right side of a join under names of their own, and null-safe conditions."""
    return rows.select(*[F.col(c).alias(f"__r_{c}") for c in columns]), [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in columns]


def append_new(table: VersionedTable, rows: DataFrame, key: list[str], work: Callable[[DataFrame], DataFrame] = lambda t: t) -> Update:
    """Incremental corpus: only rows whose key and content the table hasn't seen go through ``work``.

    The table holds each key once, with the digest of the input row that it was
    made from. Rows that it has are skipped by an anti join on key and digest,
    which reads narrow columns; rows whose content changed take the place of
    the old ones. A run without new rows writes no version. Keys are compared
    null-safely; of input rows that share a key the one with the smallest digest
    counts.
    """
    counts: dict[str, int] = {}
    both = [*key, LEDGER]

    def make(current: DataFrame | None) -> DataFrame | None:
        marked = rows.withColumn(LEDGER, content_digest(sorted(rows.columns)))
        first = marked.groupBy(*key).agg(F.min(LEDGER).alias(LEDGER))
        chosen = marked.join(*_beside(first, both), "left_semi").dropDuplicates(both)
        fresh = chosen if current is None else chosen.join(*_beside(current, both), "left_anti")
        counts["all"], counts["fresh"] = first.count(), fresh.count()
        if not counts["fresh"]:
            return None
        told, same = _beside(fresh, both)
        done = work(fresh.drop(LEDGER)).join(told, same[:-1]).withColumn(LEDGER, F.col(f"__r_{LEDGER}")).drop(*told.columns)
        if current is None:
            return done
        return current.join(told, same[:-1], "left_anti").unionByName(done)

    version = table.commit(make)
    return Update(version, counts["fresh"], counts["all"] - counts["fresh"])


APPLIED, UNCHANGED, SUPERSEDED, CHANGED_MEANWHILE, MISSING = "applied", "unchanged", "superseded", "changed_meanwhile", "missing"


def row_digest(values: list[str]) -> Column:
    """What ``checked_update`` expects of a row: the digest of its values."""
    return content_digest(values)


def _judged(current: DataFrame, proposals: DataFrame, key: str, expected: str, values: list[str]) -> DataFrame:
    """Key, new values and outcome of each proposal on the rows of one version."""
    now = current.select(F.col(key).alias("__key"), row_digest(values).alias("__now"), F.struct(*values).alias("__old"))
    offered = proposals.select(key, F.col(expected).alias("__expected"), F.struct(*values).alias("__new"))
    first = offered.groupBy(key, "__expected").agg(F.min("__new").alias("__first"))
    right, _ = _beside(first, [key, "__expected", "__first"])
    met = offered.join(right, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in (key, "__expected")]).withColumnRenamed("__r___first", "__first").join(now, F.col(key) == F.col("__key"), "left")
    outcome = (
        F.when(F.col("__key").isNull(), MISSING)
        .when(~F.col("__expected").eqNullSafe(F.col("__now")), CHANGED_MEANWHILE)
        .when(F.col("__old").eqNullSafe(F.col("__new")), UNCHANGED)
        .when(F.col("__new").eqNullSafe(F.col("__first")), APPLIED)
        .otherwise(SUPERSEDED)
    )
    return met.select(key, "__new", outcome.alias("outcome"))


def checked_update(table: VersionedTable, proposals: DataFrame, key: str, expected: str, values: list[str]) -> tuple[int, DataFrame]:
    """Compare-and-swap by row: (version, key and ``outcome`` of each proposal).

    A proposal has the key, ``expected`` (the row's ``row_digest`` when it was
    judged) and the new values. It is applied only if the row still has that
    digest when the version is made; a row that is gone or has other values by
    now is a conflict, which is told and not written. Of proposals for one row
    the smallest is applied. Check and write are one version: if another writer
    publishes first, all proposals are judged again on what it left.
    """
    wrote: dict[str, bool] = {}

    def make(current: DataFrame | None) -> DataFrame | None:
        if current is None:
            return None
        chosen = _judged(current, proposals, key, expected, values).where(F.col("outcome") == APPLIED).select(F.col(key).alias("__key"), "__new").distinct()
        wrote["now"] = bool(chosen.limit(1).count())
        merged = current.join(chosen, F.col(key) == F.col("__key"), "left")
        swapped = [F.when(F.col("__key").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in current.columns]
        return merged.select(*swapped) if wrote["now"] else None

    version = table.commit(make)
    base = table.read(version - 1 if wrote.get("now") else version) if version else None
    if base is None:
        return version, proposals.select(key, F.lit(MISSING).alias("outcome"))
    return version, _judged(base, proposals, key, expected, values).select(key, "outcome")
