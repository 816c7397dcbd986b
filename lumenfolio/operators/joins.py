"""Joins of the engine: ranges, fallback keys, optional keys, phrases, grams and vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checked_join(left: DataFrame, right: DataFrame, on: str, what: str) -> DataFrame:
    """An inner join in which a missing right side is an error (raised when the row is reached)."""
    marked = left.join(right.withColumn("__hit", F.lit(True)), on, "left")
    bad = F.raise_error(F.concat(F.lit(f"{what} is missing: "), F.col(on).cast("string")))
    return marked.withColumn("__hit", F.when(F.col("__hit").isNull(), bad.cast("boolean")).otherwise(F.col("__hit"))).where("__hit").drop("__hit")


def membership(rows: DataFrame, array: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows joined with the members of their array: an explosion and an equi join."""
    return rows.withColumn("__m", F.explode(array)).join(dim, F.col("__m") == F.col(key)).drop("__m")


def fallback_lookup(rows: DataFrame, dim: DataFrame, keys: list[list[str]], dim_key: list[str], value: str) -> DataFrame:
    """The value under the first key that has one; one left join per key, the dimension unique by its key."""
    out, found = rows, []
    for i, key in enumerate(keys):
        d = dim.select(*[F.col(c).alias(f"__k{i}_{j}") for j, c in enumerate(dim_key)], F.col(value).alias(f"__v{i}"))
        cond = [F.col(c) == F.col(f"__k{i}_{j}") for j, c in enumerate(key)]
        out = out.join(d, cond, "left").drop(*[f"__k{i}_{j}" for j in range(len(key))])
        found.append(f"__v{i}")
    return out.withColumn(value, F.coalesce(*found)).drop(*found)


def canonical(ids: Column, alias: dict[str, str]) -> Column:
    """The canonical id, or the id itself; the aliases are a fixed small map."""
    table = F.create_map(*[F.lit(x) for kv in alias.items() for x in kv])
    return F.coalesce(F.try_element_at(table, ids), ids)


def expand_range(rows: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per number of a range, so that the range becomes an equi key; none for a missing or empty range."""
    return rows.where(F.col(start) <= F.col(end)).withColumn(name, F.explode(F.sequence(F.col(start), F.col(end))))


def best_match(left: DataFrame, right: DataFrame, on: list[str], key: list[str], rank: list[Column]) -> DataFrame:
    """A left join that keeps the best right row of each left row."""
    w = Window.partitionBy(*key).orderBy(*rank)
    return left.join(right, on, "left").withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def excluded(rows: DataFrame, rules: DataFrame, mode: str = "wildcard") -> DataFrame:
    """Rows that no rule excludes, by file, book and pages.

    ``strict``: both pages equal, null equals null only. ``single``: the start
    page within the rule's pages. ``wildcard``: a rule's null page fits all.
    """
    r = rules.select(F.col("filename").alias("f"), F.col("candidate_book_id").alias("b"), F.col("page_start").alias("s"), F.col("page_end").alias("e"))
    s, e = F.col("printed_page_start"), F.col("printed_page_end")
    pages = {
        "strict": F.col("s").eqNullSafe(s) & F.col("e").eqNullSafe(e),
        "single": s.between(F.col("s"), F.coalesce("e", "s")),
        "wildcard": (F.col("s").isNull() | (F.col("s") == s)) & (F.col("e").isNull() | (F.col("e") == e)),
    }[mode]
    book = F.col("b").isNull() | (F.col("b") == F.col("candidate_book_id"))
    return rows.join(r, (F.col("filename") == F.col("f")) & book & pages, "left_anti")


def allowed_books(edition: Column, mapped: Column, unknown: str) -> Column:
    """Null (any book) for an unknown edition, the mapped books, or no book at all for an unmapped edition."""
    return F.when(edition.isNull() | (edition == unknown), F.lit(None).cast("array<string>")).otherwise(F.coalesce(mapped, F.array().cast("array<string>")))


def is_allowed(allowed: Column, book: Column) -> Column:
    return allowed.isNull() | F.array_contains(allowed, book)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side alone, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def keep_first(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def phrase_join(needles: DataFrame, pages: DataFrame, most_pages: int = 2) -> DataFrame:
    """Needle windows met by page windows of the same phrase, for phrases on at most so many pages.

    Both sides are distinct (key, size, phrase); needles also have ``start``.
    The needles are the small side: their phrases select the pages' windows
    by a semi join before anything is counted or shuffled by phrase.
    """
    wanted = needles.select("phrase").distinct()
    hit = pages.join(wanted, "phrase", "left_semi").select("page_id", "phrase").distinct()
    rare = hit.groupBy("phrase").agg(F.count("*").alias("pages")).where(F.col("pages") <= most_pages)
    return needles.join(hit.join(rare.select("phrase"), "phrase"), "phrase")


def overlap_join(a: DataFrame, b: DataFrame, least: int, top: int | None = None) -> DataFrame:
    """Pairs (a_id, b_id) with at least so many common grams, the best ``top`` per a_id.

    Both sides are distinct (id, gram). Counts are aggregated before the rank.
    """
    met = a.join(b, "gram").groupBy("a_id", "b_id").agg(F.count("*").alias("common")).where(F.col("common") >= least)
    if top is None:
        return met
    w = Window.partitionBy("a_id").orderBy(F.col("common").desc(), "b_id")
    return met.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top).drop("rn")


def weighted_overlap(parts: list[tuple[DataFrame, DataFrame, float]], least: float) -> DataFrame:
    """Pairs whose common grams of several kinds have at least that weight."""
    out = None
    for a, b, weight in parts:
        part = a.join(b, "gram").select("a_id", "b_id", F.lit(weight).alias("w"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("a_id", "b_id").agg(F.sum("w").alias("score")).where(F.col("score") >= least)


def cosine_join(a: DataFrame, b: DataFrame, least: float = 0.0) -> DataFrame:
    """Cosine of sparse vectors given as (id, feature, weight): products summed over equal features, by the norms."""
    norm = lambda t, key: t.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias(f"norm_{key}"))
    dot = a.join(b.withColumnRenamed("weight", "weight_b"), "feature").groupBy("a_id", "b_id").agg(F.sum(F.col("weight") * F.col("weight_b")).alias("dot"))
    both = dot.join(norm(a, "a_id"), "a_id").join(norm(b, "b_id"), "b_id")
    return both.withColumn("cosine", F.col("dot") / (F.col("norm_a_id") * F.col("norm_b_id"))).where(F.col("cosine") >= least).select("a_id", "b_id", "cosine")


class _Nearest:
    """The ``top`` vectors of each query of a block that a task has seen, by cosines to 9 decimals, then the smaller id; NaN comes first, null last."""

    def __init__(self, sent: tuple[list[int], np.ndarray, np.ndarray, np.ndarray], top: int):
        self.ids, self.q, self.norms, self.null = sent
        self.top, self.least = top, np.full(len(self.ids), -np.inf)
        self.best = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0)

    def add(self, ids: np.ndarray, v: np.ndarray, norms: np.ndarray, null: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            cosine = (v @ self.q.T) / (norms[:, None] * self.norms)
        key = np.where(np.isnan(cosine), np.inf, np.round(cosine, 9))
        key[null[:, None] | self.null] = -np.inf
        own = ids[:, None] == np.array(self.ids)
        if np.count_nonzero(key >= self.least) > 32 * len(self.ids) and len(ids) > self.top + 1:  # the query itself may be among them
            self.least = np.maximum(self.least, np.partition(np.where(own, -np.inf, key), -self.top, axis=0)[-self.top])
        row, of = np.nonzero((key >= self.least) & ~own)
        found = of, key[row, of], ids[row], cosine[row, of]
        every = [np.concatenate(x) for x in zip(self.best, found, strict=True)]
        order = np.lexsort((every[2], -every[1], every[0]))
        of, key, ids, cosine = (x[order] for x in every)
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        last = rank == self.top - 1
        self.least[of[last]] = key[last]
        self.best = tuple(x[rank < self.top] for x in (of, key, ids, cosine))


def _dense(vectors: pa.Array, norms: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrix, norms, and which rows have none: null, with a null component, or of another length."""
    null = ~np.array([x == dim for x in pc.list_value_length(vectors).to_pylist()], bool) | np.array(norms.is_null())
    kept = pa.array(~null)
    out, n = np.zeros((len(null), dim)), np.zeros(len(null))
    out[~null] = vectors.filter(kept).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    n[~null] = norms.filter(kept).to_numpy(zero_copy_only=False)
    return out, n, null


def dense_topk(vectors: DataFrame, queries: DataFrame, top: int, block: int = 4096) -> DataFrame:
    """J11 over dense vectors: query_id, vec_id, cosine of the ``top`` nearest of each query.

    Vectors are (vec_id, v, norm), queries (query_id, q, q_norm), a stated set
    that is small beside the vectors. Queries go in blocks of some ``block``, each sent to the
    tasks of the vectors, which take products of matrices; only each task's best leave it.
    """
    spark = vectors.sparkSession
    n, out = max(1, -(-queries.count() // block)), None
    schema = "query_id long, vec_id long, cosine double"
    for i in range(n):
        asked = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).select(F.col("query_id").cast("long"), "q", "q_norm").toArrow().combine_chunks()
        if not asked.num_rows:
            continue
        q, q_norm = (asked[c].combine_chunks() for c in ("q", "q_norm"))
        dim = max(pc.list_value_length(q).drop_null().to_pylist(), default=0)
        sent = spark.sparkContext.broadcast((asked["query_id"].to_pylist(), *_dense(q, q_norm, dim)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, dim=dim) -> Iterator[pa.RecordBatch]:
            best = _Nearest(sent.value, top)
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    b = whole.slice(at, 1024)
                    best.add(b.column(0).to_numpy(zero_copy_only=False), *_dense(b.column(1), b.column(2), dim))
            of, key, ids, cosine = best.best
            names = np.array(best.ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names[of]), pa.array(ids, pa.int64()), pa.array(cosine, pa.float64(), mask=np.isneginf(key))], ["query_id", "vec_id", "cosine"])

        part = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), "v", "norm").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    best = out.withColumn("__rn", F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("cosine", 9).desc(), "vec_id")))
    return best.where(F.col("__rn") <= top).drop("__rn")


def contains_either_way(a: Column, b: Column) -> Column:
    """J12/J13."""
    return (a == b) | F.contains(a, b) | F.contains(b, a)


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str, values: list[str]) -> DataFrame:
    """Extension: each left row with the last right row at or before it: a union and one window, no range join."""
    lt = left.withColumns({"__t": F.col(left_order), "__side": F.lit(1), "__v": F.lit(None).cast(right.select(F.struct(*values).alias("v")).schema["v"].dataType)})
    rt = right.select(*keys, F.col(right_order).alias("__t"), F.lit(0).alias("__side"), F.struct(*values).alias("__v"))
    w = Window.partitionBy(*keys).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = lt.unionByName(rt, allowMissingColumns=True).withColumn("__v", F.last("__v", True).over(w)).where("__side = 1")
    return both.select(*left.columns, *[F.col(f"__v.{v}").alias(v) for v in values])
