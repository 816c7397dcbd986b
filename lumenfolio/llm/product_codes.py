"""Vector code compression: product codes found by partial-distance search.

Each vector becomes whole numbers, floor(1024 * x) a component, and is cut into
equal consecutive parts. A part is replaced by the number of the nearest entry
of its position's codebook, which starts from the vectors of the smallest ids
and is moved to the mean of its parts in each of a few rounds.

The nearest entry is sought dimension by dimension, those in which the
codebook's entries differ most first. After the first few, the entry that leads
is completed; from then on a mask drops every entry whose sum so far strictly
exceeds the row's best complete distance, and the leader is completed again
every few dimensions. What is dropped can neither be nearest nor tie with the
nearest, so the codes are those of a search over all entries; ties go to the
lower number. Sums are of whole numbers and exact.

A round is one scan: a task adds up its own parts by entry and sends the sums, so
what is shuffled and what reaches the driver is as large as a codebook
(``ENTRIES`` entries of a vector's width), whatever the table holds. Nothing but
the codebook goes from round to round, so a lost executor costs a scan of
its splits.

Defined cases: rows whose vector is null, or holds null or non-finite components,
are dropped; shorter vectors, and a width that the parts don't divide, are
filled up with zeros; components beyond 2^62 count as that, and errors beyond
2^63 - 1 as that; with fewer vectors than entries a codebook has as many entries
as there are vectors; entries start in the order of (vec_id, vector), null ids
last, so repeated rows may start equal entries, of which the lower one is used;
labels of any type are compared as text, nulls together; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, free_names, table, tidy
from .components import join_sized

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components and errors that are larger count as these.
MOST_COMPONENT, MOST_ERROR = 2**62, 2**63 - 1
#: Rows searched at a time, dimensions before the first entry is completed, dimensions between completions.
BLOCK, HEAD, EVERY = 512, 4, 4


def finite(vector: Column) -> Column:
    """True for vectors that hold neither nulls nor numbers that aren't finite."""
    good = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, good), F.lit(False))


def floats(column: pa.Array, width: int) -> np.ndarray:
    """One row for each vector of a list column without nulls, in double precision, filled up with zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def whole(x: np.ndarray, width: int) -> np.ndarray:
    """floor(1024 * x) of a matrix that is filled up to ``width``; Python's integers where 64 bits would not do for distances."""
    x = np.floor(x * SCALE)
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    most = float(np.abs(x).max(initial=0))
    if fits(int(min(most, MOST_COMPONENT)), width):
        return x.astype(np.int64)
    clip = lambda v: max(-MOST_COMPONENT, min(MOST_COMPONENT, int(v)))
    return np.array([[clip(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def fits(most: int, width: int) -> bool:
    return 4 * most * most * max(1, width) < 2**62


def leaders(row: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Index of each row's smallest distance, the first of equal ones; ``row`` is ascending and has every number."""
    start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    hit = np.flatnonzero(dist == np.minimum.reduceat(dist, start)[row])
    return hit[np.r_[True, row[hit][1:] != row[hit][:-1]]]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the entry nearest to each row."""
    if x.dtype != book.dtype:
        x, book = x.astype(object), book.astype(object)
    order = np.argsort(-book.astype(float).var(axis=0), kind="stable")
    x, book = x[:, order], book[:, order]
    found = [_nearest(x[at : at + BLOCK], book) for at in range(0, len(x), BLOCK)]
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, width = x.shape
    dense = np.zeros((n, len(book)), dtype=x.dtype)
    for j in range(min(HEAD, width)):
        step = x[:, j, None] - book[None, :, j]
        dense += step * step

    def completed(row: np.ndarray, entry: np.ndarray, dist: np.ndarray, done: int) -> np.ndarray:
        rest = x[row, done:] - book[entry, done:]
        return dist + (rest * rest).sum(axis=1)

    first = dense.argmin(axis=1)
    every = np.arange(n)
    best = completed(every, first, dense[every, first], HEAD)
    row, entry = np.nonzero(dense <= best[:, None])
    dist = dense[row, entry]
    for j in range(HEAD, width):
        step = x[row, j] - book[entry, j]
        dist = dist + step * step
        if (j - HEAD) % EVERY == EVERY - 1 and j + 1 < width and len(row) > n:
            lead = leaders(row, dist)
            best = np.minimum(best, completed(every, entry[lead], dist[lead], j + 1))
        on = (dist <= best[row]).astype(bool)
        row, entry, dist = row[on], entry[on], dist[on]
    lead = leaders(row, dist)
    return entry[lead], dist[lead]


def parts_of(x: np.ndarray) -> list[np.ndarray]:
    return np.split(x, PARTS, axis=1)


def matrix_width(vectors: DataFrame) -> int:
    """The longest vector's length, rounded up to what the parts divide."""
    longest = int(vectors.agg(F.max(F.size("vector"))).first()[0] or 0)
    return -(-longest // PARTS) * PARTS


def first_entries(vectors: DataFrame, width: int) -> np.ndarray:
    """The vectors of the smallest ids, at most ``ENTRIES``, as whole numbers."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").toArrow().column(0)
    return whole(floats(rows.combine_chunks(), width), width)


SUMS = "part int, entry int, place int, n long, total decimal(38,0)"


def moved(vectors: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """One round: each entry becomes the floored mean of the parts nearest to it; unused ones stay."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])
    step = width // PARTS

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            x = whole(floats(batch.column(0), width), width)
            for p, (part, book) in enumerate(zip(parts_of(x), books, strict=True)):
                entry, _ = nearest(part, book)
                counts[p] += np.bincount(entry, minlength=len(book))
                here = np.zeros(book.shape, part.dtype)  # of a batch, so 64 bits do where they do for its distances
                np.add.at(here, entry, part)
                totals[p] = totals[p] + here
        for p in range(len(books)):
            entry, place = (a.ravel() for a in np.meshgrid(np.flatnonzero(counts[p]), np.arange(step), indexing="ij"))
            sums = [Decimal(int(t)) for t in totals[p][entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array([p] * len(entry), pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(counts[p][entry], pa.int64()), pa.array(sums, pa.decimal128(38, 0))], schema=schema)

    sums = vectors.select("vector").mapInArrow(tidy(add_up), SUMS).groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    new = [b.astype(object) for b in books]
    for r in sums.toArrow().to_pylist():  # one number for each of a codebook at most
        new[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    most = max((abs(int(v)) for b in new for v in b.ravel()), default=0)
    return [b.astype(np.int64) for b in new] if fits(most, width) else new


def learn(vectors: DataFrame) -> tuple[list[np.ndarray], int]:
    """Codebooks by part, and the width that vectors are filled up to; ``vectors`` has vec_id and a finite ``vector``."""
    width = matrix_width(vectors)
    books = parts_of(first_entries(vectors, width))
    for _ in range(ROUNDS if len(books[0]) else 0):
        books = moved(vectors, books, width)
    return books, width


def encode(vectors: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """All columns but ``vector``, with ``code`` and ``error`` behind them."""
    rest = [f for f in vectors.schema if f.name != "vector"]
    names = free_names([f.name for f in rest], ("code", "error"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"`{names['code']}` string", f"`{names['error']}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(floats(batch.column(batch.schema.get_field_index("vector")), width), width)
            found = [nearest(part, book) for part, book in zip(parts_of(x), books, strict=True)]
            text = np.stack([f[0] for f in found], axis=1).astype(np.uint8).tobytes().hex()
            error = [min(MOST_ERROR, int(e)) for e in sum(f[1].astype(object) for f in found)] if any(f[1].dtype == object for f in found) else np.minimum(sum(f[1] for f in found), MOST_ERROR)
            codes = [text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
            kept = [i for i, n in enumerate(batch.schema.names) if n != "vector"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(codes, pa.string()), pa.array(error, pa.int64())], [*(batch.schema.names[i] for i in kept), *names.values()])

    return vectors.mapInArrow(tidy(run), schema)


def books_digest(books: list[np.ndarray]) -> str:
    """Hexadecimal SHA-256 of all entries' components, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def op11_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors, and the errors of all that share a label."""
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("key"), F.col("embedding").alias("vector")).where(finite(F.col("vector")))
    books, width = learn(vectors)
    scratch = Scratch(spark)
    coded = scratch.keep(encode(vectors, books, width).select(F.col("vec_id").cast("long").alias("vec_id"), "key", "code", "error"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_ERROR)).cast("long")
    sums = scratch.keep(coded.groupBy("key").agg(total.alias("label_error"), F.count("*").alias("members")))
    out = join_sized(coded, sums, "key", coded.count())
    return scratch.finish(out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))


_ROUND = """
n{r} AS MATERIALIZED (SELECT vec_id, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
  SELECT p.vec_id, p.part, p.x, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.y[i]) * (p.x[i] - b.y[i])))::BIGINT AS d FROM p JOIN b{r} b USING (part)) GROUP BY ALL),"""
_MOVE = """
b{s} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.y, b.y) AS y FROM b{r} b LEFT JOIN (
  SELECT part, entry, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS y FROM (
    SELECT part, entry, i, sum(x[i])::BIGINT AS s, count(*) AS c FROM n{r}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY ALL) GROUP BY ALL) m USING (part, entry)),"""

#: DuckDB SQL for op11_product_codes: all entries are compared with all parts, round by round; for vectors of one length.
OP11_SQL = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, q AS part, x[q * len(x) // {PARTS} + 1:(q + 1) * len(x) // {PARTS}] AS x FROM v, unnest(range({PARTS})) AS u(q)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS y FROM p QUALIFY entry < {ENTRIES}),
{"".join(_ROUND.format(r=r) + _MOVE.format(r=r, s=r + 1) for r in range(ROUNDS))}
{_ROUND.format(r=ROUNDS)}
e AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM n{ROUNDS} GROUP BY 1),
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS h FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h.h AS codebooks_sha256 FROM e JOIN v USING (vec_id), h
"""
