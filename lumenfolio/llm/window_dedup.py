"""Substring dedup of word windows behind a count-min prefilter.

Round 1: each group of documents sketches its windows; a part of a sketch is
the sorted cells that it hits, so it is as large as the group's text, not as
the sketch. Parts are merged cell by cell, for each of two hash rows, and each
group learns which of its cells were hit twice or more. A count-min estimate
is never too small, so no repeated window is lost. Round 2: only windows that
both rows estimate as repeated are grouped exactly, by 128-bit digests of
their bytes, in shards; each group learns which of them are repeated. Round 3
removes the words that a repeated window covers.

The sketch is as wide as four times the estimated number of windows, cut into
segments of a fixed size, so the share of false estimates doesn't grow.

Defined cases: a null text has no words and gives an empty kept text; a text
with fewer words than a window loses nothing; null doc_ids stay null; repeated
rows are separate documents, so all their windows are repeated; an empty
table gives no rows; other columns are ignored. A text of any length is taken
whole by one task, at about 25 bytes of memory per byte of text.
"""

from __future__ import annotations

import hashlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as H
from .common import table, text_bytes, tidy_cogroup, tidy_group
from .rounds import ANSWER, answer_table, codes, cuts, group_size, grouped, log2, member, pack_sorted, unique_counts, unpack_sorted

WINDOW = 35
#: Least and most text of a group.
GROUP_BYTES, MOST_GROUP_BYTES = 3 << 20, 12 << 20
#: Bytes per word that the estimate of the number of windows assumes.
WORD_BYTES = 5
ROWS = 2
#: Cells of a segment, and keys of a shard of the exact grouping, as powers of two.
SEGMENT_BITS, SHARD_KEY_BITS = 22, 18
_ROW_SEEDS = (H.U(0x9FB21C651E98DF25), H.U(0xD1B54A32D192ED03))
EXACT = 9


class Grid:
    """Sizes of the sketch and of the exact grouping, from the bytes of all texts."""

    def __init__(self, total_bytes: int, window: int = WINDOW):
        n = max(1, total_bytes // WORD_BYTES)
        self.window = window
        self.bits = log2(4 * n, 12)
        self.segment_bits = min(SEGMENT_BITS, max(8, self.bits - 6))
        self.shard_bits = max(4, log2(n, 0) - SHARD_KEY_BITS)


class Group:
    """The windows of one group's texts, whose words are joined by one space each."""

    def __init__(self, texts: pa.ChunkedArray, grid: Grid):
        k, self.grid = grid.window, grid
        buf, offsets = H.flat(texts)
        split = H.words_of(buf.tobytes(), offsets)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        #: words in order, each text's first one, and each word's text
        self.words = list(chain.from_iterable(split))
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.doc = np.repeat(np.arange(len(split)), counts)
        self.data = b" ".join(self.words)
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        every = H.windows(H.word_hashes(self.words), k)
        self.at = np.flatnonzero(self.doc[k - 1 :] == self.doc[: len(every)]) if len(every) else np.zeros(0, np.int64)
        self.hashes = every[self.at]

    def cells(self, row: int) -> np.ndarray:
        return H.mix(self.hashes * _ROW_SEEDS[row]) >> H.U(64 - self.grid.bits)

    def candidates(self, replies: pa.Table) -> np.ndarray:
        """Indexes of the windows that every row of the merged sketch estimates as repeated."""
        likely = np.ones(len(self.at), bool)
        for row in range(ROWS):
            own = self.cells(row)
            known, _ = unique_counts(own)
            likely &= member(known, codes(replies, row, len(known)), own) > 0
        return np.flatnonzero(likely)

    def digests(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of a 128-bit digest of each chosen window's bytes."""
        at, data, digest = self.at[chosen], self.data, xxhash.xxh3_128_digest
        spans = zip(self.starts[at].tolist(), self.ends[at + self.grid.window - 1].tolist(), strict=True)
        halves = np.frombuffer(b"".join([digest(data[a:b]) for a, b in spans]), "<u8").reshape(-1, 2)
        return halves[:, 0], halves[:, 1]

    def keys(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The chosen windows in order of their digests, where a new digest begins, and the halves and shard of each distinct one."""
        high, low = self.digests(chosen)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(order) else np.zeros(0, np.int64)
        high, low = high[first], low[first]
        return chosen[order], first, high, low, (high >> H.U(64 - self.grid.shard_bits)).astype(np.int64)


def sketch_part(t: pa.Table, grid: Grid) -> pa.Table:
    """Round 1, in a group: its cells of each row and segment, and which of them it hits twice."""
    group, out = Group(t["text"], grid), []
    for row in range(ROWS):
        cells, counts = unique_counts(group.cells(row))
        segments = (cells >> H.U(grid.segment_bits)).astype(np.int64)
        for segment, a, b in cuts(segments):
            inner = cells[a:b] & H.U((1 << grid.segment_bits) - 1)
            out.append((row, segment, t["g"][0].as_py(), pack_sorted(inner), np.packbits(counts[a:b] > 1).tobytes()))
    return _columns(out, [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["row", "shard", "g", "cells", "twice"])


def _columns(rows: list[tuple], types: list, names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, x) for c, x in zip(columns, types, strict=True)], names)


def merge_sketch(t: pa.Table, grid: Grid) -> pa.Table:
    """Merge the parts of one segment of one row; counts stop at 2."""
    counts = np.zeros(1 << grid.segment_bits, np.uint8)
    row, segment = t["row"][0].as_py(), t["shard"][0].as_py()
    asked = [(g, unpack_sorted(c).astype(np.int64), w) for g, c, w in zip(t["g"].to_pylist(), t["cells"].to_pylist(), t["twice"].to_pylist(), strict=True)]
    for _, cells, twice in asked:
        more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(cells))
        counts[cells] = np.minimum(counts[cells] + more, 2)
    return answer_table([(g, row, segment, (counts[cells] > 1).astype(np.uint8).tobytes()) for g, cells, _ in asked])


def exact_part(t: pa.Table, replies: pa.Table, grid: Grid) -> pa.Table:
    """Round 2, in a group: the distinct keys of its candidates."""
    group, out = Group(t["text"], grid), []
    order, first, high, low, shards = group.keys(group.candidates(replies))
    counts = np.diff(np.append(first, len(order)))
    for shard, a, b in cuts(shards):
        out.append((shard, t["g"][0].as_py(), high[a:b].tobytes(), low[a:b].tobytes(), np.packbits(counts[a:b] > 1).tobytes()))
    return _columns(out, [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], ["shard", "g", "high", "low", "twice"])


def merge_exact(t: pa.Table) -> pa.Table:
    """Group the keys of one shard exactly."""
    highs = [np.frombuffer(x, np.uint64) for x in t["high"].to_pylist()]
    high, low = np.concatenate(highs), np.concatenate([np.frombuffer(x, np.uint64) for x in t["low"].to_pylist()])
    weight = 1 + np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)) for x, h in zip(t["twice"].to_pylist(), highs, strict=True)]).astype(np.int64)
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
    sums = np.add.reduceat(weight[order], first)
    repeated = np.zeros(len(high), np.uint8)
    repeated[order] = np.repeat(sums > 1, np.diff(np.append(first, len(h))))
    ends = np.cumsum([len(x) for x in highs])
    shard = t["shard"][0].as_py()
    return answer_table([(g, EXACT, shard, repeated[e - len(x) : e].tobytes()) for g, x, e in zip(t["g"].to_pylist(), highs, ends.tolist(), strict=True)])


def removed_words(t: pa.Table, replies: pa.Table, grid: Grid) -> tuple[Group, np.ndarray]:
    """Round 3, in a group: which words a repeated window covers."""
    group = Group(t["text"], grid)
    order, first, _, _, shards = group.keys(group.candidates(replies))
    flags = np.repeat(codes(replies, EXACT, len(shards)), np.diff(np.append(first, len(order))))
    at = group.at[order[flags > 0]]
    edges = np.zeros(len(group.doc) + 1, np.int32)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + grid.window, -1)
    return group, np.cumsum(edges[:-1]) > 0


RESULT = "doc_id long, n_words long, n_removed long, kept_text string"


def cut_rows(t: pa.Table, replies: pa.Table, grid: Grid) -> pa.Table:
    group, removed = removed_words(t, replies, grid)
    out = []
    for key, a, b in zip(t["doc_id"].to_pylist(), group.first[:-1].tolist(), group.first[1:].tolist(), strict=True):
        gone = int(removed[a:b].sum())
        kept = b" ".join(compress(group.words[a:b], (~removed[a:b]).tolist()) if gone else group.words[a:b])
        out.append((key, b - a, gone, kept))
    return _columns(out, [pa.int64(), pa.int64(), pa.int64(), pa.binary()], ["doc_id", "n_words", "n_removed", "kept_text"])


def cut_repeats(docs: DataFrame, window: int = WINDOW, group_bytes: int | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words: as kept_text, or as their SHA-256 if ``digest``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = text_bytes(docs)
    grid = Grid(total, window)
    texts = grouped(docs, [F.col("doc_id"), F.col("text")], total, group_bytes or group_size(total, GROUP_BYTES, MOST_GROUP_BYTES)).groupBy("g")

    parts = texts.applyInArrow(tidy_group(lambda t: sketch_part(t, grid)), "row int, shard long, g long, cells binary, twice binary")
    sketch = parts.groupBy("row", "shard").applyInArrow(tidy_group(lambda t: merge_sketch(t, grid)), ANSWER)
    asked = texts.cogroup(sketch.groupBy("g")).applyInArrow(tidy_cogroup(lambda t, r: exact_part(t, r, grid)), "shard long, g long, high binary, low binary, twice binary")
    exact = asked.groupBy("shard").applyInArrow(tidy_group(merge_exact), ANSWER)
    replies = sketch.unionByName(exact).groupBy("g")

    def last(t: pa.Table, r: pa.Table) -> pa.Table:
        out = cut_rows(t, r, grid)
        if digest:
            kept = [hashlib.sha256(x).hexdigest() for x in out["kept_text"].to_pylist()]
            return out.drop_columns("kept_text").append_column("kept_sha256", pa.array(kept, pa.string()))
        return out.set_column(3, "kept_text", out["kept_text"].cast(pa.string()))

    schema = RESULT.replace("kept_text", "kept_sha256") if digest else RESULT
    return texts.cogroup(replies).applyInArrow(tidy_cogroup(last), schema)


def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove the words of repeated 35-word windows from all documents."""
    return cut_repeats(table(spark, sf_dir, "documents"), digest=True)
