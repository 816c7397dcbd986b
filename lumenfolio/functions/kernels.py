"""Arrow-batched kernels for what no built-in function computes (T41, T43-T45, full NFC).

Sequences are arrays of integers (code points, or numbers of tokens), and the
kernels work on all pairs of a batch at once: common runs by one row of the
dynamic programme for all pairs, common subsequences bit-parallel, 64 elements
of one side in a word, gestalt ratios in rounds that cut all open pieces of all
pairs. Pairs go through in chunks of similar length, so memory is bounded.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType

#: Cells of a chunk's padded matrix.
CELLS = 1 << 20
#: Padding of either side, which equals nothing.
NO_A, NO_B = -1, -2


def code_points(text: str | None) -> np.ndarray:
    """A text as integers; null counts as empty."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)


def numbered_tokens(lists: Sequence) -> list[np.ndarray]:
    """Lists of tokens as integers, equal ones for equal tokens; null counts as empty."""
    numbers: dict = {}
    return [np.array([numbers.setdefault(t, len(numbers)) for t in (x if x is not None else ())], dtype=np.int64) for x in lists]


def padded(rows: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows), default=0)), fill, dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def chunks(a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Indexes of pairs without an empty side, in chunks of bounded size and similar lengths."""
    order = sorted((i for i in range(len(a)) if len(a[i]) and len(b[i])), key=lambda i: (len(b[i]), len(a[i])))
    at = 0
    while at < len(order):
        end = min(len(order), at + max(1, CELLS // len(b[order[min(len(order) - 1, at + 64)]])))
        while end > at + 1 and (end - at) * len(b[order[end - 1]]) > 2 * CELLS:
            end -= 1
        yield np.array(order[at:end])
        at = end


def longest_blocks(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(start in a, start in b, length) of each pair's longest common run; of equal ones the first in a, then in b."""
    out = np.zeros((len(a), 3), dtype=np.int64)
    for pick in chunks(a, b):
        x, y = padded([a[i] for i in pick], NO_A), padded([b[i] for i in pick], NO_B)
        before = np.zeros((len(pick), y.shape[1] + 1), dtype=np.int32)
        best = np.zeros((len(pick), 3), dtype=np.int64)
        for i in range(x.shape[1]):
            now = np.zeros_like(before)
            np.multiply(before[:, :-1] + 1, y == x[:, i, None], out=now[:, 1:])
            most = now.max(axis=1)
            longer = np.flatnonzero(most > best[:, 2])
            if len(longer):
                end = now[longer].argmax(axis=1)
                best[longer] = np.stack([i + 1 - most[longer], end - most[longer], most[longer]], axis=1)
            before = now
        out[pick] = best
    return out


def common_runs(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Length of each pair's longest common run."""
    return longest_blocks(a, b)[:, 2]


def common_subsequences(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Length of each pair's longest common subsequence.

    Bit-parallel: a word's bit i is 0 once the subsequences that end at element
    i of one side have grown; one addition carries all of a step. Where the
    shorter side has more than 64 elements, Python's integers are the words.
    """
    out = np.zeros(len(a), dtype=np.int64)
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    for pick in chunks(short, long):
        wide = [i for i in pick if len(short[i]) > 64]
        for i in wide:
            out[i] = _wide_subsequence(short[i], long[i])
        pick = np.array([i for i in pick if len(short[i]) <= 64])
        if not len(pick):
            continue
        x, y = padded([short[i] for i in pick], NO_A), padded([long[i] for i in pick], NO_B)
        masks = np.zeros(y.shape, dtype=np.uint64)
        for i in range(x.shape[1]):
            masks |= (y == x[:, i, None]).astype(np.uint64) << np.uint64(i)
        words = np.full(len(pick), ~np.uint64(0))
        for j in range(y.shape[1]):
            hit = words & masks[:, j]
            words = (words + hit) | (words - hit)
        out[pick] = np.bitwise_count(~words)
    return out


def _wide_subsequence(short: np.ndarray, long: np.ndarray) -> int:
    masks: dict[int, int] = {}
    for i, v in enumerate(short.tolist()):
        masks[v] = masks.get(v, 0) | 1 << i
    full = (1 << len(short)) - 1
    word = full
    for v in long.tolist():
        hit = word & masks.get(v, 0)
        word = ((word + hit) | (word - hit)) & full
    return len(short) - word.bit_count()


#: From this length on, elements that make up more than one in a hundred of the second sequence start no block.
POPULAR_FROM = 200


def gestalt_ratios(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Twice the matched elements over both lengths; 1 for two empty sequences.

    The longest block of a piece is matched, then what is left and right of
    it, as pieces of the next round. A block starts among elements of the second
    sequence that aren't popular, and then grows over equal neighbours.
    """
    rare = []
    for y in b:
        if len(y) >= POPULAR_FROM:
            often = [v for v, n in Counter(y.tolist()).items() if n > len(y) // 100 + 1]
            y = np.where(np.isin(y, often), NO_B, y)
        rare.append(y)
    matched = np.zeros(len(a), dtype=np.int64)
    pieces = [(i, 0, len(x), 0, len(y)) for i, (x, y) in enumerate(zip(a, b, strict=True)) if len(x) and len(y)]
    while pieces:
        blocks = longest_blocks([a[i][lo:hi] for i, lo, hi, _, _ in pieces], [rare[i][lo:hi] for i, _, _, lo, hi in pieces])
        left = []
        for (i, alo, ahi, blo, bhi), (s, t, n) in zip(pieces, blocks.tolist(), strict=True):
            if not n:
                s = t = 0  # a block may still grow from the piece's start
            s, t, e = alo + s, blo + t, 0
            while s > alo and t > blo and a[i][s - 1] == b[i][t - 1]:
                s, t, n = s - 1, t - 1, n + 1
            while s + n + e < ahi and t + n + e < bhi and a[i][s + n + e] == b[i][t + n + e]:
                e += 1
            n += e
            if n:
                matched[i] += n
                left += [p for p in ((i, alo, s, blo, t), (i, s + n, ahi, t + n, bhi)) if p[1] < p[2] and p[3] < p[4]]
        pieces = left
    size = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    return np.where(size > 0, 2.0 * matched / np.maximum(size, 1), 1.0)


@F.pandas_udf(DoubleType())
def gestalt_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """T41; null counts as empty."""
    return pd.Series(gestalt_ratios([code_points(x) for x in a], [code_points(x) for x in b]), dtype=float)


def _of_tokens(a: pd.Series, b: pd.Series, kernel) -> pd.Series:
    both = numbered_tokens([*a, *b])
    return pd.Series(kernel(both[: len(a)], both[len(a) :]), dtype="int32")


@F.pandas_udf(IntegerType())
def token_lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    """T43; null counts as empty."""
    return _of_tokens(a, b, common_subsequences)


@F.pandas_udf(IntegerType())
def token_common_run(a: pd.Series, b: pd.Series) -> pd.Series:
    """T44; null counts as empty."""
    return _of_tokens(a, b, common_runs)


@F.pandas_udf(IntegerType())
def common_substring(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common substring; null counts as empty."""
    return pd.Series(common_runs([code_points(x) for x in a], [code_points(x) for x in b]), dtype="int32")


@F.pandas_udf(StringType())
def nfc_fold(text: pd.Series) -> pd.Series:
    """T53 in full: NFC, then letters with a nukta become plain ones."""
    table = {0x09DC: "ড", 0x09DD: "ঢ", 0x09DF: "য", 0x09BC: None}
    return pd.Series([None if t is None else unicodedata.normalize("NFC", t).translate(table) for t in text], dtype=object)


#: Kinds of a verse block, by the line that opens it.
SECTION, NOTE, STANZA = "section-marker", "source-note", "stanza"


def verse_blocks_of(text: str) -> list[tuple[str, str]]:
    """(kind, text): blank lines end a block; a line of digits or stars alone, and a bracketed or dashed note, are blocks of their own."""
    out: list[tuple[str, list[str]]] = []
    open_ = False
    for raw in text.split("\n"):
        line = raw.strip()
        if not line:
            open_ = False
        elif all(c.isdigit() or c in "*.·-–— " for c in line):
            out.append((SECTION, [line]))
            open_ = False
        elif (line[0] in "([" and line[-1] in ")]") or line[0] == "—":
            out.append((NOTE, [line]))
            open_ = False
        elif open_:
            out[-1][1].append(line)
        else:
            out.append((STANZA, [line]))
            open_ = True
    return [(kind, "\n".join(x)) for kind, x in out]


@F.pandas_udf(ArrayType(StringType()))
def verse_blocks(text: pd.Series) -> pd.Series:
    """``kind|text`` of each block; null has none."""
    return pd.Series([[f"{k}|{v}" for k, v in verse_blocks_of(t or "")] for t in text])
