"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is binned; the model is an intercept, one lookup table
per feature and one table per chosen pair of features. The tables are learned
by cyclic boosting: round after round, each feature in turn gets a shallow
tree over its bins, scaled by a small rate and added to its table; then the
pairs with the largest gain on the residuals get trees of four quadrants in
the same way. A score is a logistic function of vectorised bin additions.

Learning uses at most ``max_rows`` labelled documents, the first by a hash of
the id, so its cost doesn't grow with the input; scoring is one scan without
a shuffle. Labels of held-out documents (crc32 of the id modulo 3 is 1) are
never read into learning, and labels, lang, source and doc_id are no features.

Defined cases: a null text counts as empty and is scored; a null doc_id is
held out; of several labels of a document the largest counts, null labels
don't; with no labels, or one class of labels, every score is the smoothed
base rate; repeated rows are scored once each; an empty table gives no rows;
other columns pass through ``score`` untouched, and if one has the name of the
added column, the added one gets an underscore behind its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, held_out, table, tidy
from .sentencepieces import slices

#: Most labelled documents that learning looks at.
MAX_ROWS = 20_000
FEATURES = ("words", "word_length", "symbols", "upper", "exclaim", "pipes", "distinct", "adjacent", "dup_lines", "digits", "stops", "line_words", "short_words", "entropy")
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def features(text: str | None) -> list[float]:
    """The features of a whole text, in the order of FEATURES; counts are shares where length would dominate."""
    raw = (text or "").encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n, chars = len(words), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = seen[65:91].sum(), seen[97:123].sum()
    share = seen[seen > 0] / chars
    return [
        np.log1p(n),
        sum(map(len, words)) / max(1, n),
        seen[_SYMBOLS].sum() / chars,
        upper / max(1, upper + lower),
        seen[33] / max(1, n),
        seen[124] / max(1, n),
        len(set(words)) / max(1, n) ** 0.8,
        sum(map(bytes.__eq__, words, words[1:])) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)),
        seen[48:58].sum() / chars,
        (seen[44] + seen[46]) / max(1, n),
        n / max(1, len(lines)),
        sum(len(w) < 4 for w in words) / max(1, n),
        float(-(share * np.log2(share)).sum()),
    ]


@dataclass
class Gam:
    """Bin edges, tables of features and of pairs, and the intercept."""

    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    intercept: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.intercept)
        if self.tables:
            bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)]
            for b, t in zip(bins, self.tables, strict=True):
                logit += t[b]
            for i, j, to_i, to_j, t in self.pairs:
                logit += t[to_i[bins[i]], to_j[bins[j]]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A value for each bin: a tree of so many leaves over sums of gradients and weights, grown by gain."""
    cuts = [0, len(g)]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                at = np.arange(a + 1, b)
                left, right, whole = cg[at] - cg[a], cg[b] - cg[at], cg[b] - cg[a]
                hl, hr = ch[at] - ch[a] + ridge, ch[b] - ch[at] + ridge
                gain = left**2 / hl + right**2 / hr - whole**2 / (ch[b] - ch[a] + ridge)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree of four quadrants over a grid of sums."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    best = (0.0, np.zeros_like(g))
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(0, j)), (slice(i, None), slice(j, None))]
            sums = []
            for c in (cg, ch):
                a, b, d, whole = c[i, j], c[i, -1], c[-1, j], c[-1, -1]
                sums.append((a, b - a, d - a, whole - b - d + a))
            gain = sum(x * x / (y + ridge) for x, y in zip(*sums, strict=True))
            if gain > best[0]:
                out = np.zeros_like(g)
                for p, x, y in zip(parts, *sums, strict=True):
                    out[p] = x / (y + ridge)
                best = (gain, out)
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 30, pairs: int = 6, bins: int = 32, grid: int = 8, rate: float = 0.15, ridge: float = 4.0) -> Gam:
    """Learn a model; deterministic."""
    n = len(y)
    base = (float(y.sum()) + 1) / (n + 2)
    model = Gam(intercept=float(np.log(base / (1 - base))))
    if n == 0 or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for b, t in zip(binned, model.tables, strict=True):
            g, h = slopes()
            step = rate * _tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), 3, ridge)
            t += step
            logit += step[b]
    coarse = [(np.arange(len(t)) * grid // len(t)) for t in model.tables]
    small = [c[b] for c, b in zip(coarse, binned, strict=True)]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell = small[i] * grid + small[j]
        return tuple(np.bincount(cell, v, grid * grid).reshape(grid, grid) for v in (g, h))

    gains = sorted(((_quadrants(*sums(i, j), ridge)[0], i, j) for i in range(len(binned)) for j in range(i)), reverse=True)
    model.pairs = [(i, j, coarse[i], coarse[j], np.zeros((grid, grid))) for _, i, j in gains[:pairs]]
    for _ in range(pair_rounds):
        for i, j, _, _, t in model.pairs:
            step = rate * _quadrants(*sums(i, j), ridge)[1]
            t += step
            logit += step[small[i], small[j]]
    for f, (b, t) in enumerate(zip(binned, model.tables, strict=True)):  # tables have mean 0; the intercept holds the rest
        mean = float(t[b].mean())
        model.tables[f] = t - mean
        model.intercept += mean
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Gam:
    """Fit on the labels that may be learned from; at most ``max_rows`` rows reach the driver."""
    usable = labels.where(F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("y"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    found = known.select("text", F.col("y").cast("double").alias("y")).mapInArrow(tidy(_feature_rows), "x array<double>, y double").collect()
    found.sort(key=lambda r: (r.y, r.x))
    return fit(np.array([r.x for r in found]).reshape(-1, len(FEATURES)), np.array([r.y for r in found]))


def score(docs: DataFrame, model: Gam, name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of each whole text."""
    name = free_names(docs.columns, (name,))[name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1024):
                x = np.array([features(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*batch.schema.names, name])

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from labels that aren't held out."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
