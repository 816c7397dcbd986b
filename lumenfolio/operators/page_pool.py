"""The pages that share most features with a passage, exactly (J9, M8's and M12's first step).

A page's score for a passage is the number of features that they share, and half
of what only the features' classes share: max(e, (e + c) / 2) for e common
features and c common classes. The best ``top`` pages of every passage are
wanted, among all pages, however common a feature is.

Passages are the small side, pages the large one. So passages become posting
lists (feature -> passages) in blocks of bounded size; a block is sent to all
tasks, and each page is read, cut into features and scored once a block, where
it lies. No feature of a page is ever shuffled, and only each task's best pages
of each passage leave it.

Within a task a threshold algorithm keeps the work small. A block's features
are in two parts: rare ones, of few passages, and common ones, of many. Of a
page, the rare ones are counted first. A passage whose count, with all of its
common features added as a bound, can't reach its k-th best score so far (nor
the least score asked for) is done; the common features are counted for the
others alone. The bound leaves out no page that belongs to the best: the tests
hold it against all pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kernels import code_points

#: Bytes of passages' texts that make one block of posting lists.
BLOCK_BYTES = 4 << 20
#: Features of more than this share of a block's passages are counted last.
COMMON_SHARE = 0.1
#: Parts in which a passage's pages are ranked before they are ranked together.
RANK_PARTS = 32

Features = Callable[[str], np.ndarray]


def gram_features(n: int) -> Features:
    """Distinct hashes of a text's character n-grams; 64 bits of a mixed polynomial."""

    def of(text: str) -> np.ndarray:
        c = code_points(text).astype(np.uint64) + np.uint64(1)
        if len(c) < n:
            return np.zeros(0, np.uint64)
        h = np.zeros(len(c) - n + 1, dtype=np.uint64)
        for i in range(n):
            h = (h ^ c[i : len(c) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return np.unique(h)

    return of


def token_features(least: int = 3) -> Features:
    """Distinct hashes of a text's words of at least so many characters."""

    def of(text: str) -> np.ndarray:
        found = {w for w in text.split(" ") if len(w) >= least}
        return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), dtype=np.uint64, count=len(found)))

    return of


@dataclass
class Postings:
    """One kind of a block's features: rare ones as lists of passages, common ones as a table."""

    words: np.ndarray
    start: np.ndarray
    lists: np.ndarray
    #: Row in ``table`` of each feature, or -1.
    common: np.ndarray
    table: np.ndarray
    #: Common features of each passage: what counting them can add at most.
    bound: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray], most: int) -> Postings:
        words, index = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(index, kind="stable")
        count = np.bincount(index, minlength=len(words))
        start = np.concatenate([[0], np.cumsum(count)])
        lists = owner[order].astype(np.int32)
        often = np.flatnonzero(count > most)
        common = np.full(len(words), -1, dtype=np.int64)
        common[often] = np.arange(len(often))
        table = np.zeros((len(often), len(sets)), dtype=np.int16)
        for row, w in enumerate(often):
            table[row, lists[start[w] : start[w + 1]]] = 1
        return cls(words, start, lists, common, table, table.sum(axis=0, dtype=np.int64))

    def known(self, features: np.ndarray) -> np.ndarray:
        """Numbers of the features that some passage has."""
        at = np.searchsorted(self.words, features)
        at[at == len(self.words)] = 0
        return at[self.words[at] == features] if len(self.words) else np.zeros(0, np.int64)

    def rare_counts(self, known: np.ndarray, passages: int) -> np.ndarray:
        rare = known[self.common[known] < 0]
        sizes = self.start[rare + 1] - self.start[rare]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[rare] - (ends - sizes), sizes)
        return np.bincount(self.lists[at], minlength=passages)

    def common_counts(self, known: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        rows = self.common[known]
        return self.table[rows[rows >= 0]][:, chosen].sum(axis=0, dtype=np.int64)


@dataclass
class Block:
    """A block of passages: their ids, postings of both kinds, allowed books, the least score of each and the least of e + c."""

    ids: list
    exact: Postings
    by_class: Postings
    allowed: list[frozenset | None]
    least: np.ndarray
    least_sum: float
    top: int

    @classmethod
    def of(cls, rows: list[dict], features: Features, top: int, least_share: float, least_sum: float, common: float = COMMON_SHARE) -> Block:
        most = max(1, int(common * len(rows)))
        exact, by_class = ([features(r[k] or "") for r in rows] for k in ("plain", "signed"))
        allowed = [None if r["allowed"] is None else frozenset(r["allowed"]) for r in rows]
        least = np.maximum(least_sum / 2, least_share * np.array([len(e) for e in exact], float))
        return cls([r["item_id"] for r in rows], Postings.of(exact, most), Postings.of(by_class, most), allowed, least, least_sum, top)


class Best:
    """Each passage's best pages so far, as heaps of (score, exact, minus page id), and how many pairs needed their common features."""

    def __init__(self, block: Block):
        self.block, self.heaps = block, [[] for _ in block.ids]
        self.threshold = block.least.copy()
        self.counted, self.open_books = 0, {}

    def _open(self, book: str | None) -> np.ndarray:
        if book not in self.open_books:
            self.open_books[book] = np.array([a is None or book in a for a in self.block.allowed], dtype=bool)
        return self.open_books[book]

    def add(self, page_id: int, book: str | None, exact: np.ndarray, by_class: np.ndarray) -> None:
        block, n = self.block, len(self.block.ids)
        e_known, c_known = block.exact.known(exact), block.by_class.known(by_class)
        e, c = block.exact.rare_counts(e_known, n), block.by_class.rare_counts(c_known, n)
        e_most, c_most = e + block.exact.bound, c + block.by_class.bound
        chosen = np.flatnonzero((np.maximum(e_most, (e_most + c_most) / 2) >= self.threshold) & self._open(book))
        if not len(chosen):
            return
        self.counted += len(chosen)
        e = e[chosen] + block.exact.common_counts(e_known, chosen)
        c = c[chosen] + block.by_class.common_counts(c_known, chosen)
        score = np.maximum(e, (e + c) / 2)
        for k in np.flatnonzero((score >= self.threshold[chosen]) & (e + c >= max(1, block.least_sum))):
            i, entry = chosen[k], (float(score[k]), int(e[k]), -page_id, int(c[k]))
            heap = self.heaps[i]
            if len(heap) < block.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == block.top:
                self.threshold[i] = max(block.least[i], heap[0][0])

    def rows(self) -> list[tuple]:
        return [(self.block.ids[i], -p, s, e, c) for i, heap in enumerate(self.heaps) for s, e, p, c in heap]


POOL = "item_id long, page_id long, score double, exact long, by_class long"


def _scan(sent, features: Features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(sent.value)
        for batch in batches:
            for page_id, book, plain, signed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if page_id is not None:
                    best.add(page_id, book, features(plain or ""), features(signed or ""))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        columns = zip(*rows, strict=True) if (rows := best.rows()) else ((),) * 5
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in POOL.split(", ")])

    return run


def page_pool(items: DataFrame, pages: DataFrame, features: Features, top: int, least_share: float = 0.0, least_sum: float = 1.0) -> DataFrame:
    """item_id, page_id, score, exact, by_class: the best ``top`` pages of every passage, ties by exact features, then the smaller id.

    Both sides have ``plain`` and ``signed``, a text and its class signature;
    ids are integers. Passages may have ``allowed``, an array of books (null: all),
    if pages have ``book_id``. Scores of less than ``least_share`` of a passage's
    features don't count, nor do sums e + c of less than ``least_sum``.
    """
    spark = items.sparkSession
    extra = F.col("allowed") if "allowed" in items.columns else F.lit(None).cast("array<string>")
    book = F.col("book_id") if "book_id" in pages.columns else F.lit(None).cast("string")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "plain", "signed", extra.alias("allowed"))
    blocks = 1 + int(asked.agg(F.sum(F.octet_length("plain"))).first()[0] or 0) // BLOCK_BYTES
    scanned, out = pages.select(F.col("page_id").cast("long").alias("page_id"), book.alias("book"), "plain", "signed"), None
    for i in range(blocks):  # each of bounded size, whatever the number of passages
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).toArrow().to_pylist()
        if rows:
            sent = spark.sparkContext.broadcast(Block.of(rows, features, top, least_share, least_sum))
            part = scanned.mapInArrow(_scan(sent, features), POOL)
            out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], POOL)
    order = (F.col("score").desc(), F.col("exact").desc(), "page_id")
    ranked = out.withColumn("part", F.pmod(F.xxhash64("page_id"), F.lit(RANK_PARTS)))
    for keys in (("item_id", "part"), ("item_id",)):  # a passage's many short lists don't meet in one task before they are cut
        ranked = ranked.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= top).drop("rn")
    return ranked.drop("part")
