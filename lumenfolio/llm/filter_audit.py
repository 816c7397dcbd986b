"""Filter interaction audit by inclusion-exclusion.

Which documents does a filter remove that no other would, which twice, and what
does the order cost? One scan makes each document's failures A to D and a digest
of its text; E, a copy of a smaller id's text, comes from the smallest id of each
digest that repeats. From these, the documents that fail all filters of a set
are counted for each of the 32 sets, as sums of products of failure flags, by
part of the corpus. Everything else follows from those 32 counts alone:

* Moebius inversion gives the survivors of each set of filters, so what an order
  keeps and removes at each step, and what only one filter fails;
* the counts with alternating signs are the Harsanyi dividends of the game
  whose value is the number of documents removed, and a filter's dividends, each
  divided by its set's size, add up to its Shapley value.

Texts are never shuffled: a document goes on as a digest and four flags, written
to the shared folder once. Copies meet their first by ``join_sized``, so a text
that a third of all documents share isn't dealt to one task; labels meet
documents over inner joins, so null ids meet nobody; sums are made in each task
before they are dealt by part.

Defined cases: a null text is empty, and empty texts are copies of each other; a
null part is the empty string; a null id is larger than any other, and rows of
the smallest id of a text are no copies of each other; a document is good or
toxic if any of its label rows says so; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, tidy
from .components import join_sized

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: The filter that looks at other rows.
COPY = FILTERS.index("E")
#: What is counted: all documents, good ones, toxic ones.
WEIGHTS = ("one", "good", "toxic")
FEW_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
CAPITALS, SIGNS = bytes(range(ord("A"), ord("Z") + 1)), b"#$%&*|"


def flags_of(text: bytes, chars: int) -> tuple[bool, bool, bool, bool]:
    """A to D of a text of so many code points; bytes split at the six ASCII white spaces alone."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return len(words) < FEW_WORDS, 100 * len(set(words)) < LEAST_DISTINCT * len(words), 100 * capitals > MOST_CAPITALS * chars, len(text.translate(None, SIGNS)) < len(text)


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, A to D as 0 or 1, and a digest of the text; ``docs`` has doc_id, source and text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags, digests = [[] for _ in "ABCD"], []
            for text, chars in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                text = text.as_py()
                digests.append(hashlib.sha256(text).digest())
                for kept, flag in zip(flags, flags_of(text, chars), strict=True):
                    kept.append(int(flag))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(f, pa.int32()) for f in flags), pa.array(digests, pa.binary())], ["doc_id", "part", *"ABCD", "digest"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.cast("binary").alias("text"), F.length(text).alias("chars"))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, part string, A int, B int, C int, D int, digest binary")


def copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``failures`` whose text a smaller id has too."""
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("members")).where("members > 1")
    met = join_sized(rows, scratch.keep(first), "digest", rows.count())
    later = F.when(F.col("doc_id").isNull(), F.col("first").isNotNull()).otherwise(F.col("doc_id") > F.col("first"))
    return met.where(later).select(*rows.columns)


def joint_counts(rows: DataFrame, copied: DataFrame, labels: DataFrame) -> DataFrame:
    """part, and for each of ``WEIGHTS`` an array: at place s, the documents that fail all filters of set s (bit i: filter i)."""
    rows = rows.drop("digest").withColumn("E", F.lit(0)).unionByName(copied.drop("digest").withColumn("E", F.lit(1)))
    said = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))])
    plain = rows.select("part", *FILTERS, F.lit(1).alias("one"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    marked = rows.join(said, "doc_id").select("part", *FILTERS, F.lit(0).alias("one"), "good", "toxic")

    def fails(s: int) -> Column:
        """1 for a row that fails all of set s; copies have a row of their own for the sets with E."""
        out = F.col("E") if s >> COPY & 1 else 1 - F.col("E")
        for i, name in enumerate(FILTERS):
            if i != COPY and s >> i & 1:
                out = out * F.col(name)
        return out

    sums = [F.sum(fails(s) * F.col(w)).alias(f"{w}_{s}") for w in WEIGHTS for s in range(SETS)]
    wide = plain.unionByName(marked).groupBy("part").agg(*sums)
    return wide.select("part", *[F.array(*[f"{w}_{s}" for s in range(SETS)]).alias(w) for w in WEIGHTS])


def survivors(joint: Column) -> Column:
    """At place s, the documents that fail no filter of set s: Moebius inversion over its subsets."""
    sets = F.array(*map(F.lit, range(SETS)))
    signed = F.transform(joint, lambda n, t: F.when(F.bit_count(t) % 2 == 0, n).otherwise(-n))
    inside = lambda s: F.filter(sets, lambda t: t.bitwiseAND(s) == t)
    return F.transform(sets, lambda s: F.aggregate(F.transform(inside(s), lambda t: F.get(signed, t)), F.lit(0).cast("long"), lambda a, x: a + x))


def dividends(joint: Column) -> Column:
    """At place s, the Harsanyi dividend of set s in the game of removed documents; nothing for the empty set."""
    return F.transform(joint, lambda n, s: F.when(s == 0, 0).when(F.bit_count(s) % 2 == 1, n).otherwise(-n))


def shapley(dividend: Column, filter_: Column) -> Column:
    """A filter's removed documents summed over all orders: its dividends by set size, times the number of orders."""
    orders = factorial(len(FILTERS))
    with_it = lambda d, s: F.when(s.bitwiseAND(filter_) == 0, 0).otherwise(d * (F.lit(orders) / F.bit_count(s)).cast("long"))
    return F.aggregate(F.transform(dividend, with_it), F.lit(0).cast("long"), lambda a, x: a + x)


def only_fails(joint: Column, filter_: Column) -> Column:
    """Documents that fail this filter and no other: the sets with it, by alternating signs."""
    signed = lambda n, s: F.when(s.bitwiseAND(filter_) == 0, 0).when(F.bit_count(s) % 2 == 1, n).otherwise(-n)
    return F.aggregate(F.transform(joint, signed), F.lit(0).cast("long"), lambda a, x: a + x)


def steps() -> Column:
    """All orders' steps as structs: the order, the step, its filter's set and the set of those before it."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for i, name in enumerate(order, 1):
            rows.append({"filter_order": "".join(order), "step": i, "own": 1 << FILTERS.index(name), "before": before})
            before |= 1 << FILTERS.index(name)
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, own: int, before: int>>")


def audit(joint: DataFrame) -> DataFrame:
    """One row per part, order and step, from the joint counts alone."""
    left = joint.select("part", *[survivors(F.col(w)).alias(f"left_{w}") for w in WEIGHTS], dividends(F.col("one")).alias("dividend"), F.col("one").alias("joint"))
    t = left.select("*", F.explode(steps()).alias("s")).select("*", "s.*")
    after = F.col("before").bitwiseOR(F.col("own"))
    removed = lambda w: F.get(f"left_{w}", F.col("before")) - F.get(f"left_{w}", after)
    return t.select(
        "part", "filter_order", "step", F.get("left_one", after).alias("kept"), removed("one").alias("removed"), (F.get("joint", F.col("own")) - removed("one")).alias("redundant"),
        only_fails(F.col("joint"), F.col("own")).alias("unique_fails"), removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), shapley(F.col("dividend"), F.col("own")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, by source."""
    scratch = Scratch(spark)
    rows = scratch.keep(failures(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    joint = scratch.keep(joint_counts(rows, copies(rows, scratch), table(spark, sf_dir, "labels")))
    return scratch.finish(audit(joint))


#: DuckDB SQL for op12_filter_audit: every document goes through every order, step by step.
OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, list_filter([
  CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END, CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' END, CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
  CASE WHEN coalesce(t.doc_id > min(t.doc_id) OVER same, min(t.doc_id) OVER same IS NOT NULL) THEN 'E' END], lambda x: x IS NOT NULL) AS failed FROM t LEFT JOIN l ON l.doc_id = t.doc_id WINDOW same AS (PARTITION BY text)),
k(k) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before FROM o, unnest(range(1, 6)) AS u(step)),
g AS (SELECT part, good, toxic, failed, count(*) AS n FROM f GROUP BY ALL),
r AS (SELECT part, filter_order, step, own, n, good, toxic, list_contains(failed, own) AS fails, len(failed) = 1 AS alone, len(list_filter(failed, lambda x: contains(before, x))) > 0 AS gone FROM g, s),
a AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fails AND alone), 0)::BIGINT AS unique_fails,
  coalesce(sum(n * good) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS good_lost, coalesce(sum(n * toxic) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM a
"""
