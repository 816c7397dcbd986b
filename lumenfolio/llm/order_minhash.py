"""Order MinHash fingerprints, sensitive to edit distance.

A text is a sequence of k-mers of code points, each numbered by how often it
has occurred before, so all items differ. For each of ``sketches`` hash
functions the ``keep`` items with the smallest hashes are selected, put back
into text order, and their k-mers hashed as a tuple. Texts agree in a tuple
if they share its items *in the same order*; the share of equal tuples is the
likeness of two fingerprints.

``with_next`` pairs each document with the next one by falling doc_id, in one
shuffle of the texts: rows are cut into ranges of even size, by a sample, each
range also gets a copy of the document that follows its last one, and sorted
rows stream through, two at a time. An id, or no id, that more than a range of
rows share is cut further, by a hash of the text. Ranges are one task each;
beyond ``MOST_RANGES`` of them they grow, which costs a task time, not memory.

Defined cases: a null text is empty; a text shorter than k code points is one
k-mer, an empty text is the empty k-mer; with fewer items than ``keep`` all
are used; null doc_ids come after all others, equal ones are ordered by a hash
of the text, then the text; a document alone in its table is its own next; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, tidy
from .texthash import U, mix, windows

K, SKETCHES, KEEP = 8, 24, 2
#: Texts of one range, the most ranges (their edges are sent to every task), and rows that the sample has for each.
RANGE_BYTES, MOST_RANGES, SAMPLES = 8 << 20, 1 << 16, 16
#: What a row weighs besides its text, and the bits of the hash that orders texts of one id.
ROW_BYTES, TIE_BITS = 64, 40
#: Items hashed at once by all functions; longer texts are taken in pieces.
PIECE = 1 << 14


def numbered_kmers(text: str, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers in text order, and of the k-mers with their occurrence numbers."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    kmers = windows(mix(codes + U(1)), min(k, len(codes))) if len(codes) else np.array([0x5EED], U)
    items = kmers.copy()
    order = np.sort(kmers)
    twice = order[1:][order[1:] == order[:-1]]
    if len(twice):
        twice = np.unique(twice)
        at = np.minimum(np.searchsorted(twice, kmers), len(twice) - 1)
        own = np.flatnonzero(twice[at] == kmers)
        group = at[own]
        ranked = np.argsort(group, kind="stable")
        group = group[ranked]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        number = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        items[own[ranked]] += mix(number.astype(U) + U(77)) * (number > 0)
    return kmers, mix(items)


def fingerprint(text: str, k: int = K, sketches: int = SKETCHES, keep: int = KEEP) -> np.ndarray:
    """So many tuple hashes (32 bits each)."""
    kmers, items = numbered_kmers(text, k)
    seeds = mix(np.arange(1, sketches + 1, dtype=U)) | U(1)
    n = len(items)
    values, places = [], []
    for a in range(0, n, PIECE):
        part = items[None, a : a + PIECE] * seeds[:, None]
        part ^= part >> U(32)
        part *= U(0x9E3779B97F4A7C15)
        for _ in range(min(keep, part.shape[1])):
            at = part.argmin(1)
            values.append(np.take_along_axis(part, at[:, None], 1)[:, 0])
            places.append(at + a)
            np.put_along_axis(part, at[:, None], np.iinfo(U).max, 1)
    values, places = np.stack(values, 1), np.stack(places, 1)
    if values.shape[1] > keep:
        chosen = np.argsort(values, 1, kind="stable")[:, :keep]
        places = np.take_along_axis(places, chosen, 1)
    places.sort(axis=1)  # text order
    out = np.zeros(sketches, U)
    for j in range(places.shape[1]):
        out = mix(out * U(0xD6E8FEB86659FD93) + kmers[places[:, j]])
    return (out >> U(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) of each whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t or "").tobytes().hex() for t in b.column(1).to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, fingerprint string")


def at_most(edges: list[int], value: Column) -> Column:
    """How many of the sorted ``edges`` are at most ``value``: a binary search by falling powers of two."""
    known = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")  # folded to one literal
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(known, low + step - 1) <= value, low + step).otherwise(low))


def cut(sample: list[tuple[int | None, int]]) -> tuple[list[int], dict[int | None, int]]:
    """Edges between ids, and into how many ranges an id is cut, from sampled ids and how often each was drawn."""
    edges, split, held = [], {}, 0
    for key, drawn in sorted((x for x in sample if x[0] is not None)):
        if drawn >= 2 * SAMPLES:
            split[key] = drawn // SAMPLES
        if held + drawn > SAMPLES and held or key in split:
            edges.append(key)
            held = 0
        held += drawn
    nulls = sum(drawn for key, drawn in sample if key is None)
    return edges, split | ({None: nulls // SAMPLES} if nulls >= 2 * SAMPLES else {})


def in_ranges(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """part, is_copy, doc_id, tie, text: ranges in reading order, each with a copy of what follows its last document; and their number.

    What reaches the driver is the number of bytes and a sample of at most
    some ``SAMPLES`` ids for each range, drawn by a hash, weighted by size.
    """
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.pmod(F.xxhash64(text), F.lit(1 << TIE_BITS)).alias("tie"))
    weight = F.octet_length("text") + ROW_BYTES
    total = int(docs.agg(F.sum(weight)).first()[0] or 0)
    step = max(range_bytes, -(-total // MOST_RANGES))
    edges, split = [], {}
    if total > step:
        draw = F.pmod(F.xxhash64(F.lit(7), "doc_id", "text"), F.lit(1 << TIE_BITS)) * step < weight.cast("double") * SAMPLES * (1 << TIE_BITS)
        times = F.greatest(F.lit(1), weight * SAMPLES / step).cast("long")
        edges, split = cut([tuple(r) for r in docs.where(draw).groupBy("doc_id").agg(F.sum(times)).collect()])
    # ranges by falling id; an id that is cut is the least one of its range, null ids are the last
    own = [split.get(e, 1) for e in [None, *edges]]  # of the range that starts at each edge; [0] is of null ids
    first, at = [0] * (len(edges) + 1), 0
    for i in range(len(edges), -1, -1):
        first[i] = at
        at += own[i] if i else 1
    null_first, parts = at, at + own[0]
    bucket = at_most(edges, F.col("doc_id")) if edges else F.lit(0)
    starts = F.split(F.lit(",".join(map(str, first))), ",").cast("array<int>")
    sub = F.lit(0)
    if split:
        hot = F.broadcast(spark.createDataFrame([(k, n) for k, n in split.items()], "hot_id long, hot_parts long"))
        docs = docs.join(hot, F.col("doc_id").eqNullSafe(F.col("hot_id")) & F.col("hot_parts").isNotNull(), "left")
        sub = F.coalesce(F.shiftright(F.col("tie") * F.col("hot_parts"), TIE_BITS), F.lit(0)).cast("int")
    part = F.when(F.col("doc_id").isNull(), F.lit(null_first)).otherwise(F.get(starts, bucket)) + sub
    docs = docs.select(part.alias("part"), "doc_id", "tie", "text")

    order = F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id").alias("falling"), "tie")
    heads = docs.groupBy("part").agg(F.min(order).alias("head"))
    rising = Window.orderBy("part")  # a row per range, at most 2 * MOST_RANGES
    whole = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goes = heads.select(F.bitwise_not("head.falling").alias("head_id"), F.col("head.tie").alias("head_tie"), F.coalesce(F.lag("part").over(rising), F.last("part").over(whole)).alias("to"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    copies = docs.join(F.broadcast(goes), is_head).groupBy("to", "doc_id", "tie").agg(F.min("text").alias("text"))
    copies = copies.select(F.col("to").alias("part"), "doc_id", "tie", "text", F.lit(True).alias("is_copy"))
    return docs.withColumn("is_copy", F.lit(False)).unionByName(copies), parts


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, is_copy, doc_id, text), each followed by its next document."""
    names = [x.split()[0] for x in RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    before: tuple | None = None
    for batch in batches:
        rows = []
        for part, copy, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = fingerprint(text)
            if before is not None and before[0] == part:
                _, was, said, known = before
                other = edited(said, text)
                changed = fingerprint(other)
                rows.append((was, len(said), hashlib.sha256(other.encode()).hexdigest(), known.tobytes().hex(), changed.tobytes().hex(), likeness(known, changed), likeness(known, own)))
            before = None if copy else (part, key, text, own)
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document against its edited text and against the next document."""
    rows, parts = in_ranges(docs, range_bytes)
    dealt = rows.select("part", "is_copy", "doc_id", "text", "tie").repartitionById(parts, "part")
    ordered = dealt.sortWithinPartitions("part", "is_copy", F.col("doc_id").desc_nulls_last(), "tie", "text").drop("tie")
    return ordered.mapInArrow(tidy(compare_rows), RESULT)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint all documents and their edited texts."""
    return with_next(table(spark, sf_dir, "documents"))
