"""Questions from groups of documents to shards of a key space, and answers back.

Texts are dealt once into groups of a few megabytes. In each round a group
works out sorted distinct keys from its own texts and sends them, packed, to
the shards that own them; a shard merges what all groups sent and answers each
group with a code per key, in the same order. Answers meet the texts again in
a cogroup, which reuses the one shuffle of the texts. Nothing is broadcast,
nothing reaches the driver, and a group's or a shard's memory is bounded, at
any size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANSWER = "g long, kind int, shard long, codes binary"


def grouped(docs: DataFrame, by: list[Column], total_bytes: int, group_bytes: int) -> DataFrame:
    """``docs`` with ``g``, one of so many groups that each has about ``group_bytes`` of text."""
    return docs.withColumn("g", F.pmod(F.xxhash64(*by), F.lit(max(1, -(-total_bytes // group_bytes)))))


def group_size(total_bytes: int, least: int, most: int) -> int:
    """Bytes of a group's texts: they grow as the root of the total, so that what a group sends to a shard doesn't dwindle, up to what a worker can hold."""
    return int(min(most, max(least, 90 * total_bytes**0.5)))


def log2(n: float, least: int, most: int = 60) -> int:
    return min(most, max(least, int(np.ceil(np.log2(max(1.0, n))))))


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising integers as differences of two bytes, or of four or eight where they need it."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    size = 2 if not len(steps) or steps.max() < 1 << 16 else 4 if steps.max() < 1 << 32 else 8
    return bytes([size]) + steps.astype(f"<u{size}").tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.uint64), dtype=np.uint64)


def cuts(sorted_shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of each run of equal numbers."""
    if len(sorted_shards):
        at = np.flatnonzero(sorted_shards[1:] != sorted_shards[:-1]) + 1
        for a, b in zip([0, *at.tolist()], [*at.tolist(), len(sorted_shards)], strict=True):
            yield int(sorted_shards[a]), a, b


def unique_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def member(known: np.ndarray, flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The flag of each key in the sorted ``known``; zero for a key that isn't there."""
    if not len(known):
        return np.zeros(len(keys), flags.dtype)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, flags[at], flags.dtype.type(0))


def answers(table: pa.Table, kind: int) -> list[bytes]:
    """The answers of one kind, by shard."""
    rows = [(s, c) for k, s, c in zip(table["kind"].to_pylist(), table["shard"].to_pylist(), table["codes"].to_pylist(), strict=True) if k == kind]
    return [c for _, c in sorted(rows)]


def codes(table: pa.Table, kind: int, count: int) -> np.ndarray:
    """One code per key that the group asked about, over all shards in order."""
    found = b"".join(answers(table, kind))
    if len(found) != count:
        raise ValueError(f"{len(found)} answers to {count} questions")
    return np.frombuffer(found, np.uint8)


def answer_table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    g, kind, shard, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table([pa.array(g, pa.int64()), pa.array(kind, pa.int32()), pa.array(shard, pa.int64()), pa.array(data, pa.binary())], ["g", "kind", "shard", "codes"])
