"""Versioned tables: incremental runs, concurrent writers, killed writers, checked updates."""

import threading

import pytest
from pyspark.sql import functions as F

from lumenfolio.sources.ledger import VersionedTable, append_new, checked_update, row_digest

ROW = "id long, v string"


@pytest.fixture
def target(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def rows_of(table):
    return sorted(((r.id, r.v) for r in table.read().select("id", "v").collect()), key=str)


def test_a_second_run_reads_only_what_is_new(spark, target):
    work = lambda t: t.withColumn("v", F.upper("v"))
    first = spark.createDataFrame([(1, "a"), (2, None), (None, "n"), (3, "c"), (3, "b"), (1, "a")], ROW)
    one = append_new(target, first, ["id"], work)
    assert (one.version, one.fresh, one.skipped) == (1, 4, 0)
    again = append_new(target, first, ["id"], work)
    assert (again.version, again.fresh, again.skipped) == (1, 0, 4) and target.number() == 1
    held = dict(rows_of(target))
    assert held[1] == "A" and held[2] is None and held[None] == "N" and held[3] in ("B", "C") and len(held) == 4
    later = append_new(target, spark.createDataFrame([(1, "a"), (2, "now"), (9, "z")], ROW), ["id"], work)
    assert (later.version, later.fresh, later.skipped) == (2, 2, 1)
    assert dict(rows_of(target)) == held | {2: "NOW", 9: "Z"} and dict(rows_of_version(target, 1)) == held
    assert append_new(target, spark.createDataFrame([], ROW), ["id"]).version == 2


def rows_of_version(table, number):
    return [(r.id, r.v) for r in table.read(number).collect()]


def test_a_killed_writer_leaves_the_old_version(spark, target):
    assert target.read() is None and target.number() == 0
    target.commit(lambda _: spark.createDataFrame([(1, "a")], ROW))
    spark.createDataFrame([(1, "half")], ROW).write.parquet(f"{target.path}/v-000000000002-dead")
    boom = F.udf(lambda v: 1 / 0, "string")
    with pytest.raises(Exception, match="division"):
        target.commit(lambda t: t.withColumn("v", boom("v")))
    assert target.number() == 1 and rows_of(target) == [(1, "a")]
    assert len(target.vacuum()) == 2 and rows_of(target) == [(1, "a")] and target.vacuum() == []


def test_two_writers_lose_nothing(spark, target):
    """Both read version 1 before either publishes; the second starts again from the first one's version."""
    target.commit(lambda _: spark.createDataFrame([(0, "start")], ROW))
    gate, failed = threading.Barrier(2, timeout=60), []

    def write(i):
        waited = []

        def make(t):
            if not waited:
                waited.append(1)
                gate.wait()
            return t.unionByName(spark.createDataFrame([(i, "w")], ROW))

        try:
            VersionedTable(spark, target.path).commit(make)
        except Exception as e:  # a thread's failure must reach the test
            failed.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and target.number() == 3 and rows_of(target) == [(0, "start"), (1, "w"), (2, "w")]


def test_checked_updates(spark, target):
    target.commit(lambda _: spark.createDataFrame([(1, "unknown"), (2, "unknown"), (3, "x"), (4, None), (5, "same")], ROW))
    digest = lambda v: spark.createDataFrame([(v,)], "v string").select(row_digest(["v"])).first()[0]
    unknown = digest("unknown")
    offers = [(1, unknown, "A"), (2, unknown, "B"), (2, unknown, "C"), (3, unknown, "D"), (4, digest(None), "E"), (5, digest("same"), "same"), (7, unknown, "F"), (None, unknown, "G"), (1, None, "H")]
    proposals = spark.createDataFrame(offers, "id long, judged string, v string")
    version, outcome = checked_update(target, proposals, "id", "judged", ["v"])
    told = sorted(((r.id, r.outcome) for r in outcome.collect()), key=str)
    assert version == 2 and rows_of(target) == [(1, "A"), (2, "B"), (3, "x"), (4, "E"), (5, "same")]
    assert told == sorted([(1, "applied"), (2, "applied"), (2, "superseded"), (3, "changed_meanwhile"), (4, "applied"), (5, "unchanged"), (7, "missing"), (None, "missing"), (1, "changed_meanwhile")], key=str)
    version, outcome = checked_update(target, proposals, "id", "judged", ["v"])
    assert version == 2 and {r.outcome for r in outcome.where("id IN (1, 2, 4)").collect()} == {"changed_meanwhile"}


def test_concurrent_checked_updates(spark, target):
    """Two applies judged on the same version: each row goes to one of them, and the other is told."""
    target.commit(lambda _: spark.createDataFrame([(i, "unknown") for i in range(6)], ROW))
    unknown = target.read().select(row_digest(["v"]).alias("d")).first().d
    offer = lambda name, ids: spark.createDataFrame([(i, unknown, name) for i in ids], "id long, judged string, v string")
    done = {}
    threads = [threading.Thread(target=lambda n=n, ids=ids: done.update({n: {r.id: r.outcome for r in checked_update(VersionedTable(spark, target.path), offer(n, ids), "id", "judged", ["v"])[1].collect()}})) for n, ids in (("a", range(0, 4)), ("b", range(2, 6)))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    held = dict(rows_of(target))
    assert set(held) == set(range(6)) and "unknown" not in held.values()
    for i, v in held.items():
        assert done[v][i] == "applied" and all(o.get(i, "changed_meanwhile") == "changed_meanwhile" for n, o in done.items() if n != v)
