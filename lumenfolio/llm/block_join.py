"""Nearest neighbours by a block matrix join with int8 product tiles.

Queries and candidates are dealt into blocks, and each pair of a query block and
a candidate block is a tile. Within a tile both sides are quantised to int8, one
scale a vector, and a matrix product gives all approximate inner products at
once. With q = sq * cq + eq and x = sx * cx + ex,

    q.x - sq * sx * cq.cx  =  (sq * cq).ex + eq.x,

which is at most |sq * cq| * |ex| + |eq| * |x| in size. So each pair has a lower
and an upper bound. A pair whose upper bound is below the k-th largest lower
bound, or below the k-th best score found so far, can't be among the nearest; all
others are computed again in double precision and go through a heap for each
query. Tiles' lists are then merged by heaps. No neighbour is lost.

Matrix products are taken in float32, where sums of int8 products are exact up
to 1,040 dimensions; longer vectors are cut into such chunks.

Blocks are bounded in bytes, so a tile fits a worker at any table size; their
number grows with the table. What is shuffled is each side times the number of
the other side's blocks; what comes out of a tile is one list for each query.

Defined cases: rows whose vector is null, zero (or empty), or holds null or
non-finite components, take no part; missing components of shorter vectors count
as zeros; repeated rows count once; rows that share a vec_id with different
vectors are each candidates, and as queries they ask together (the best of all
their pairs); no row is a candidate of its own vec_id; null ids ask nothing and
come last among ties; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table, tidy, tidy_cogroup
from .product_codes import finite, floats

NEAREST, ASKING = 20, 20
#: Bytes of a block of queries and of candidates, as four-byte numbers.
QUERY_BYTES, CANDIDATE_BYTES = 4 << 20, 16 << 20
#: A block has at least so many rows where there are that many, and there are so many blocks for a core.
LEAST_ROWS, BLOCKS_A_CORE = 1024, 3
#: Rows and columns of a matrix product, and dimensions of one: 127 * 127 * 1,040 < 2^24.
TILE_ROWS, TILE_COLUMNS, EXACT_DIMENSIONS = 256, 4096, 1040
#: Share of the norms' product that covers all rounding in double precision.
ROUNDING = 1e-11
#: What a null id counts as: more than any other.
NO_ID = 1 << 63


class Quantised:
    """A matrix as int8 codes with one scale a row, and the norms that bound what the codes leave out."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.scale = np.maximum(np.abs(x).max(axis=1, initial=0.0) / 127, np.finfo(float).tiny)
        codes = np.rint(x / self.scale[:, None])
        self.codes = codes.astype(np.int8)
        near = codes * self.scale[:, None]
        self.norm, self.near, self.rest = (np.sqrt((m * m).sum(axis=1)) for m in (x, near, x - near))

    def slice(self, at: int, n: int) -> Quantised:
        out = object.__new__(Quantised)
        for k, v in self.__dict__.items():
            setattr(out, k, v[at : at + n])
        return out


def products(q: Quantised, c: Quantised) -> np.ndarray:
    """All inner products of codes: whole numbers, exact."""
    out = np.zeros((len(q.codes), len(c.codes)))
    for at in range(0, q.codes.shape[1], EXACT_DIMENSIONS):
        out += q.codes[:, at : at + EXACT_DIMENSIONS].astype(np.float32) @ c.codes[:, at : at + EXACT_DIMENSIONS].astype(np.float32).T
    return out


def exact_scores(a: np.ndarray, b: np.ndarray, rows: int = 4096) -> np.ndarray:
    """Inner products of paired rows in double precision, summed from the first component on, so equal vectors score equally."""
    if not a.shape[1]:
        return np.zeros(len(a))
    return np.concatenate([np.cumsum(a[i : i + rows] * b[i : i + rows], axis=1)[:, -1] for i in range(0, len(a), rows)] or [np.zeros(0)])


def best_of_tile(q: Quantised, q_ids: list, c: Quantised, c_ids: list, k: int) -> tuple[list[list[tuple[float, int]]], int]:
    """For each query the heap of its best (score, minus id) among the candidates, and how many pairs were computed in full."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    asked, offered, computed = np.array(q_ids, dtype=object), np.array([NO_ID if i is None else i for i in c_ids], dtype=object), 0
    asked64, offered64 = asked.astype(np.int64), np.array([0 if i is None else i for i in c_ids], np.int64)
    known = np.array([i is not None for i in c_ids], bool)
    for i in range(0, len(q_ids), TILE_ROWS):
        a = q.slice(i, TILE_ROWS)
        for j in range(0, len(c_ids), TILE_COLUMNS):
            b = c.slice(j, TILE_COLUMNS)
            about = products(a, b) * a.scale[:, None] * b.scale
            slack = (np.outer(a.near, b.rest) + np.outer(a.rest, b.norm)) * (1 + 1e-9) + np.outer(a.norm, b.norm) * ROUNDING
            own = (asked64[i : i + TILE_ROWS, None] == offered64[j : j + TILE_COLUMNS]) & known[j : j + TILE_COLUMNS]
            low = about - slack
            low[own | np.isnan(low)] = -np.inf
            least = np.array([heaps[i + r][0][0] if len(heaps[i + r]) == k else -np.inf for r in range(len(low))])
            if low.shape[1] >= k:
                least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
            rows, columns = np.nonzero(~(about + slack < least[:, None]) & ~own)
            scores = exact_scores(a.x[rows], b.x[columns])
            computed += len(scores)
            for r, n, s in zip(rows.tolist(), offered[j + columns].tolist(), scores.tolist(), strict=True):
                heap, entry = heaps[i + r], (s, -n)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
    return heaps, computed


LISTS = "query_id long, found array<struct<score: double, vec_id: long>>"
_FOUND = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))


def _tile(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        sides = [t.combine_chunks() for t in (queries, candidates)]
        columns = [t.column("vector").combine_chunks() for t in sides]
        width = max((pc.max(pc.list_value_length(c)).as_py() or 0 for c in columns if len(c)), default=0)
        if not all(len(c) for c in columns):
            return pa.table({"query_id": pa.array([], pa.int64()), "found": pa.array([], _FOUND)})
        ids = [t.column("vec_id").to_pylist() for t in sides]
        q, c = (Quantised(floats(x, width)) for x in columns)
        heaps, _ = best_of_tile(q, ids[0], c, ids[1], k)
        found = [[{"score": s, "vec_id": None if n == -NO_ID else -n} for s, n in h] for h in heaps]
        return pa.table({"query_id": pa.array(ids[0], pa.int64()), "found": pa.array(found, _FOUND)})

    return tidy_cogroup(run)


RANKED = "query_id long, rank int, vec_id long, score double"


def merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of all lists of a query, by a heap over rows that stream by query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heap = None, []

        def rows(query: int) -> list[tuple]:
            return [(query, i, None if n == -NO_ID else -n, s) for i, (s, n) in enumerate(sorted(heap, reverse=True), 1)]

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            done = []
            for query, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if query != now:
                    done += rows(now) if now is not None else []
                    now, heap = query, []
                for f in found:
                    entry = (f["score"], -NO_ID if f["vec_id"] is None else -f["vec_id"])
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
            if done:
                yield batch_of(done)
        if now is not None and (done := rows(now)):
            yield batch_of(done)

    return lists.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(tidy(run), RANKED)


def blocks(rows: int, width: int, most_bytes: int, spread: int) -> int:
    """How many blocks so many vectors make: none over ``most_bytes`` on the average, and ``spread`` of them where they are long enough."""
    return max(1, -(-rows * width * 4 // most_bytes), min(spread, rows // LEAST_ROWS))


def nearest(vectors: DataFrame, k: int = NEAREST, asking: int = ASKING) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``asking``, the k rows of the largest inner product; ``vectors`` has vec_id and vector."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    usable = finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    rows = scratch.keep(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").where(usable).dropDuplicates())
    asks = F.col("vec_id") % asking == 0
    n, asked, width = rows.agg(F.count("*"), F.count_if(asks), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    across = blocks(n, width, CANDIDATE_BYTES, BLOCKS_A_CORE * spark.sparkContext.defaultParallelism)
    down = blocks(asked, width, QUERY_BYTES, 1)
    place = lambda m: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = rows.where(asks).select(place(down).alias("row"), every(across).alias("column"), "vec_id", "vector")
    candidates = rows.select(every(down).alias("row"), place(across).alias("column"), "vec_id", "vector")
    lists = queries.groupBy("row", "column").cogroup(candidates.groupBy("row", "column")).applyInArrow(_tile(k), LISTS)
    return scratch.finish(merged(lists, k))


def op13_block_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest neighbours of every row whose id is divisible by 20, among all rows."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))


#: DuckDB SQL for op13_block_join: all pairs.
OP13_SQL = f"""
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e) AS score FROM v a JOIN v b ON a.vec_id % {ASKING} = 0 AND a.vec_id IS DISTINCT FROM b.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= {NEAREST}
"""
