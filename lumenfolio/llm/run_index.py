"""A run-length index of a set of strings: run-compressed Burrows-Wheeler transform with sampled run ends.

In the transform of a repetitive text equal letters stand in long runs. Only
where a run begins are a suffix's position, the end of the run before it (its
lexicographic predecessor) and the length of their common prefix kept. For all
other positions they follow: one step on in the text, the predecessor moves
one step on and the common prefix loses one letter. Streaming the text through
these samples gives its matching statistics: for every position the best
earlier-sorted match and its length.

The suffixes are sorted once, when the index is built, and forgotten; the
index keeps five numbers a run and answers from them.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def first_letters(letters: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, int]:
    """The first letters of each suffix as one number that sorts like them, and how many they are; zeros follow a separator, which is zero."""
    present = np.bincount(letters) > 0
    code = (np.cumsum(present) - present[0]).astype(U)  # small numbers for the letters that occur
    key, bits, count = code[letters], max(1, int(code[-1]).bit_length()), 1
    while bits * count <= 32:
        behind = np.zeros_like(key)
        behind[:-count] = key[count:]
        behind[left < count] = 0
        key = key << U(bits * count) | behind
        count *= 2
    return key, count


def sorted_suffixes(letters: np.ndarray, left: np.ndarray) -> np.ndarray:
    """All suffixes in order, by the ranks of two or three places at once; ties up to a separator go by position.

    ``left`` has how many letters there are up to the separator that follows.
    """
    n = len(left)
    key, step = first_letters(letters, left)
    short = left < step
    order = np.argsort(key)
    ties = np.flatnonzero(short[order])
    own = order[ties]
    order[ties] = own[np.lexsort((own, key[own]))]
    key = key[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | short[order[1:]]])
    slot = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = slot
    open_ = _tied(order, slot)
    while len(open_):
        key = rank[open_] * n + rank[np.minimum(open_ + step, n - 1)]
        if n < 1 << 21:  # where the second place is beyond the separator its rank is its own, and the third one decides nothing
            key = key * n + rank[np.minimum(open_ + 2 * step, n - 1)]
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        old = rank[open_]
        at = np.arange(len(open_))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        fresh = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), at, 0))
        slot = old + fresh - group
        rank[open_] = slot
        open_ = _tied(open_, slot)
        step *= 3 if n < 1 << 21 else 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


def _tied(order: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The suffixes that share their rank with a neighbour."""
    same = slot[1:] == slot[:-1]
    return order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]


def common_prefixes(a: np.ndarray, b: np.ndarray, four: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Common prefix of suffixes, never past a separator; 0 where ``b`` is -1."""
    out = np.zeros(len(a), np.int64)
    limit = np.where(b >= 0, np.minimum(left[a], left[b]), 0)
    live = np.flatnonzero(limit > 0)
    done = 0
    while len(live):
        diff = four[a[live] + done] ^ four[b[live] + done]
        same = (diff >> U(48) == 0).astype(np.int64)
        for shift in (32, 16, 0):
            same += (same == (48 - shift) // 16) & (diff >> U(shift) == 0)
        done += 4
        out[live] += same
        live = live[(same == 4) & (limit[live] > done)]
    return np.minimum(out, limit)


def ranges(starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range behind the other."""
    return np.repeat(starts - (np.cumsum(widths) - widths), widths) + np.arange(widths.sum())


class RunIndex:
    """Index of strings, each closed by a separator of its own; positions count separators.

    ``heads`` and ``run_lengths`` are the run-compressed transform. The samples,
    in text order, are each run's first suffix, its predecessor (the last
    suffix of the run before it) and their common prefix.
    """

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        ends = self.starts + lengths
        self.size = n = int(ends[-1]) + 1 if len(strings) else 0
        letters = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.uint16) + np.uint16(1)  # 0 is for separators
        if not n:
            self.heads = self.run_lengths = self.sample_at = self.sample_ahead = self.sample_prefix = np.zeros(0, np.int64)
            return
        letters[ends] = 0
        left = np.repeat(ends, lengths + 1) - np.arange(n)
        wide = np.concatenate([letters, np.zeros(3, np.uint16)]).astype(U)
        four = (wide[:n] << U(48)) | (wide[1 : n + 1] << U(32)) | (wide[2 : n + 2] << U(16)) | wide[3 : n + 3]
        suffixes = sorted_suffixes(letters, left)
        before = letters[suffixes - 1]
        first = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)]))
        self.heads, self.run_lengths = before[first], np.diff(np.append(first, n))
        at, ahead = suffixes[first], np.where(first > 0, suffixes[first - 1], -1)
        by = np.argsort(at)
        self.sample_at, self.sample_ahead = at[by], ahead[by]
        self.sample_prefix = common_prefixes(self.sample_at, self.sample_ahead, four, left)

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(at, span, ahead, prefix) by sample: for d < span, the best earlier-sorted match of position at + d is at ahead + d, of prefix - d letters."""
        return self.sample_at, np.diff(np.append(self.sample_at, self.size)), self.sample_ahead, self.sample_prefix

    def repeats(self, length: int) -> np.ndarray:
        """True where ``length`` letters start that also start at a smaller position.

        Positions with a match that long are linked to their predecessors;
        following the links leads all places of one string to the same end.
        """
        out = np.zeros(self.size, bool)
        at, span, ahead, prefix = self.matching_statistics()
        width = np.minimum(span, prefix - length + 1)
        long = np.flatnonzero(width > 0)
        matched, before = ranges(at[long], width[long]), ranges(ahead[long], width[long])
        place = np.union1d(matched, before)  # of all strings that have a match, in text order
        link = np.arange(len(place))
        link[np.searchsorted(place, matched)] = np.searchsorted(place, before)
        while True:
            further = link[link]
            if np.array_equal(further, link):
                break
            link = further
        least = np.empty(len(place), np.int64)
        least[link[::-1]] = np.arange(len(place))[::-1]  # of several places with one end the first in the text is written last
        out[place[least[link] != np.arange(len(place))]] = True
        return out
