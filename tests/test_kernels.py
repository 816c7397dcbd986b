"""Batch kernels against their definitions."""

from difflib import SequenceMatcher

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenfolio.functions import kernels


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def common_run(a, b):
    return max((n for n in range(1, len(a) + 1) for i in range(len(a) - n + 1) if any(b[j : j + n] == a[i : i + n] for j in range(len(b) - n + 1))), default=0)


SHORT = st.lists(st.tuples(st.text("abc", max_size=14), st.text("abcd", max_size=14)), min_size=1, max_size=12)
LONG = st.lists(st.tuples(st.text("ab", max_size=90), st.text("abé😀", max_size=260)), min_size=1, max_size=4)


@given(SHORT)
@settings(max_examples=60, deadline=None)
def test_runs_and_subsequences(pairs):
    a, b = ([kernels.code_points(x) for x in side] for side in zip(*pairs, strict=True))
    assert kernels.common_runs(a, b).tolist() == [common_run(x, y) for x, y in pairs]
    assert kernels.common_subsequences(a, b).tolist() == [subsequence(x, y) for x, y in pairs]


@given(st.lists(st.tuples(st.lists(st.integers(0, 5), max_size=150), st.lists(st.integers(0, 5), max_size=150)), min_size=1, max_size=4))
@settings(max_examples=40, deadline=None)
def test_subsequences_beyond_a_word(pairs):
    a, b = ([np.array(x, dtype=np.int64) for x in side] for side in zip(*pairs, strict=True))
    assert kernels.common_subsequences(a, b).tolist() == [subsequence(x, y) for x, y in pairs]


@given(st.one_of(SHORT, LONG))
@settings(max_examples=80, deadline=None)
def test_gestalt_ratios(pairs):
    """Long second sides have popular elements, which start no block."""
    a, b = ([kernels.code_points(x) for x in side] for side in zip(*pairs, strict=True))
    assert kernels.gestalt_ratios(a, b).tolist() == [SequenceMatcher(None, x, y).ratio() for x, y in pairs]


def test_chunks_hold_every_pair(monkeypatch):
    monkeypatch.setattr(kernels, "CELLS", 16)
    pairs = [("a" * i, "a" * (40 - i)) for i in range(41)]
    a, b = ([kernels.code_points(x) for x in side] for side in zip(*pairs, strict=True))
    assert kernels.common_runs(a, b).tolist() == [min(i, 40 - i) for i in range(41)] == kernels.common_subsequences(a, b).tolist()


def test_nulls_and_empty_sides(spark):
    t = spark.createDataFrame([(None, "abc", None, ["a"]), ("", "", [], []), ("abcd", "xbcx", ["a", "b", "a"], ["b", "a"])], "a string, b string, x array<string>, y array<string>")
    rows = t.select(kernels.common_substring("a", "b").alias("s"), kernels.gestalt_ratio("a", "b").alias("g"), kernels.token_lcs("x", "y").alias("l"), kernels.token_common_run("x", "y").alias("r")).collect()
    assert [tuple(r) for r in rows] == [(0, 0.0, 0, 0), (0, 1.0, 0, 0), (2, 0.5, 2, 2)]
