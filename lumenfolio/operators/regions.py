"""Lines of passages on the regions of a page (M8, M9, M12, J10), for chosen pairs of a passage and a page.

A pair is one row: the passage's lines and the page's region windows as arrays.
Nothing is exploded and no gram is shuffled; a row's regions become tables of
numpy once, all lines are compared with all regions by gathers from them, and
only the kernels of common runs and subsequences (T43-T45) are left, for pairs
of a line and a region that a bound lets through, all of a row at once.

Regions of very long pages go through in blocks, so memory follows the longest
text and not its square.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kernels import code_points, common_runs, common_subsequences, numbered_tokens
from ..functions.profiles import LATIN_CLASSES

#: Regions whose features stand in one table.
BLOCK_REGIONS = 512
#: Fixed values of M8: sizes of n-grams, dimensions, the weight of class grams.
VECTOR_SIZES, VECTOR_DIMENSIONS, CLASS_WEIGHT = (3, 5, 8), 32768, 0.5


def signature_table(groups: tuple[str, ...] = LATIN_CLASSES) -> dict[int, int]:
    """T6 for str.translate."""
    return {ord(c): 0xE000 + i for i, g in enumerate(groups) for c in g}


def grams(text: str, n: int) -> list[str]:
    return [text[i : i + n] for i in range(len(text) - n + 1)]


def longest_flags(flags: np.ndarray) -> np.ndarray:
    """The longest run of true in each row."""
    count = np.cumsum(flags, axis=1)
    reset = np.maximum.accumulate(np.where(flags, 0, count), axis=1)
    return (count - reset).max(axis=1, initial=0)


class FeatureTable:
    """Which features of a block of regions stand in which region."""

    def __init__(self, regions: list[list[str]]):
        self.number: dict[str, int] = {}
        at = [[self.number.setdefault(f, len(self.number)) for f in r] for r in regions]
        self.has = np.zeros((len(regions), len(self.number) + 1), dtype=bool)  # the last column is for features that no region has
        for row, r in zip(self.has, at, strict=True):
            row[r] = True

    def flags(self, features: list[str]) -> np.ndarray:
        """Region by feature: whether it stands there."""
        return self.has[:, [self.number.get(f, -1) for f in features]]


@dataclass
class Line:
    index: int
    text: str
    plain: str
    signed: str
    #: Features in order with repeats, exact and by class: grams or tokens.
    exact: list[str]
    by_class: list[str]


@dataclass
class Found:
    """A line on a region: what orders the results, and what is returned."""

    region: int
    score: float
    order: tuple
    exact: bool


def distinct(features: list[str]) -> list[str]:
    return list(dict.fromkeys(features))


class Page:
    """A page's regions, prepared: texts, grams or tokens, tables of which stand where."""

    def __init__(self, regions: list[dict], features, signs: dict[int, int]):
        self.texts = [r["text"] for r in regions]
        self.spans = [(r["line_start"], r["line_end"]) for r in regions]
        self.made = [features(i, t, signs) for i, t in enumerate(self.texts)]

    @cached_property
    def tables(self) -> list[tuple[int, FeatureTable, FeatureTable]]:
        part = lambda at: self.made[at : at + BLOCK_REGIONS]
        return [(at, FeatureTable([m.exact for m in part(at)]), FeatureTable([m.by_class for m in part(at)])) for at in range(0, len(self.made), BLOCK_REGIONS)]

    @cached_property
    def vectors(self) -> list[Vectors]:
        return [Vectors(self.made[at : at + BLOCK_REGIONS]) for at in range(0, len(self.made), BLOCK_REGIONS)]

    def ranked(self, line: Line, least: float, top: int) -> list[int]:
        """The regions of the largest weight: distinct common features, class ones by half; ties by exact ones, then in order."""
        g, cg = distinct(line.exact), distinct(line.by_class)
        hits = np.concatenate([e.flags(g).sum(axis=1) for _, e, _ in self.tables])
        weight = hits + 0.5 * np.concatenate([c.flags(cg).sum(axis=1) for _, _, c in self.tables])
        able = np.flatnonzero(weight >= least)
        return able[np.lexsort((able, -hits[able], -weight[able]))][:top].tolist()

    def flags(self, line: Line, region: int) -> tuple[np.ndarray, np.ndarray]:
        at, exact, by_class = self.tables[region // BLOCK_REGIONS]
        return tuple(t.has[region - at, [t.number.get(f, -1) for f in fs]] for t, fs in ((exact, line.exact), (by_class, line.by_class)))


def with_class(exact, by_class):
    """What is common, and half of what only classes have in common."""
    return exact + 0.5 * np.maximum(0, by_class - exact)


def gram_line(n: int):
    def made(index: int, text: str, signs: dict[int, int]) -> Line:
        plain = text.replace(" ", "")
        signed = plain.translate(signs)
        return Line(index, text, plain, signed, grams(plain, n), grams(signed, n))

    return made


def token_line(index: int, text: str, signs: dict[int, int]) -> Line:
    """Numbers, and words of at least two characters."""
    tokens = [w for w in text.split(" ") if len(w) >= 2 or (w.isascii() and w.isdigit())]
    return Line(index, text, text, text, tokens, [w.translate(signs) for w in tokens])


def fuzzy_lines(lines: list[Line], page: Page, least: float = 0.62, top: int = 16) -> list[tuple[Line, Found]]:
    """M9: for each line the best region, if it holds the line or scores at least ``least`` by M7.

    A score is the share of grams and at most 0.22 more, so a region with less
    than ``least`` - 0.22 never comes to the kernel of common runs.
    """
    open_, found = [], []
    for line in lines:
        if not line.exact:
            continue
        few = max(3.0, 0.2 * min(len(set(line.exact)), len(set(line.by_class))))
        for region in page.ranked(line, few, top):
            flags, signed = page.flags(line, region)
            e, c = flags.mean(), signed.mean()
            share, holds = with_class(e, c), line.text in page.texts[region]
            if holds or share >= least - 0.22:
                runs = max(longest_flags(flags[None])[0], 0.5 * longest_flags(signed[None])[0]) / len(flags)
                open_.append((line, region, holds, e, share, runs))
    if not open_:
        return found
    pairs = [(line.plain, page.made[r].plain) for line, r, *_ in open_], [(line.signed, page.made[r].signed) for line, r, *_ in open_]
    chars, by_class = (common_runs([code_points(a) for a, _ in p], [code_points(b) for _, b in p]) for p in pairs)
    for (line, region, holds, e, share, runs), n, m in zip(open_, chars.tolist(), by_class.tolist(), strict=True):
        close = min(1.0, with_class(n, m) / max(1, len(line.plain)))
        score = 1.0 if holds else min(1.0, share + min(0.22, 0.14 * close + 0.08 * runs))
        if score >= least:
            start, end = page.spans[region]
            found.append((line, Found(region, float(score), (-score, -e, end - start), holds)))
    return best_regions(found)


def ordered_lines(lines: list[Line], page: Page, least: float = 0.78, top: int = 20, few: float = 3.0) -> list[tuple[Line, Found]]:
    """M12's lines: the best region of each by M11, if it holds the line or scores at least ``least``.

    No common subsequence or run is longer than the tokens in common, which
    bounds the score before a kernel runs.
    """
    open_, found = [], []
    for line in lines:
        n, kinds = max(1, len(line.exact)), max(1, len(set(line.exact)))
        for region in page.ranked(line, few, top):
            other = page.made[region]
            flags, signed = page.flags(line, region)
            overlap = with_class(len(set(line.exact) & set(other.exact)), len(set(line.by_class) & set(other.by_class))) / kinds
            holds = line.text != "" and line.text in page.texts[region]
            if holds or 0.7 * with_class(flags.sum(), signed.sum()) / n + 0.3 * overlap >= least:
                open_.append((line, region, holds, overlap, n))
    if not open_:
        return found
    sides = numbered_tokens([line.exact for line, *_ in open_] + [page.made[r].exact for _, r, *_ in open_]), numbered_tokens([line.by_class for line, *_ in open_] + [page.made[r].by_class for _, r, *_ in open_])
    k = len(open_)
    lcs, class_lcs = (common_subsequences(s[:k], s[k:]) for s in sides)
    run, class_run = (common_runs(s[:k], s[k:]) for s in sides)
    for i, (line, region, holds, overlap, n) in enumerate(open_):
        score = 1.0 if holds else min(1.0, 0.5 * with_class(lcs[i], class_lcs[i]) / n + 0.3 * overlap + 0.2 * with_class(run[i], class_run[i]) / n)
        if score >= least:
            found.append((line, Found(region, float(score), (-score, -int(lcs[i]), -int(run[i])), holds)))
    return best_regions(found)


def best_regions(found: list[tuple[Line, Found]]) -> list[tuple[Line, Found]]:
    """The first of each line's regions by order; ties stay in the order of weight."""
    best: dict[int, tuple[Line, Found]] = {}
    for line, f in found:
        if line.index not in best or f.order < best[line.index][1].order:
            best[line.index] = (line, f)
    return list(best.values())


# --- M8: hashed vectors of regions ---------------------------------------------

def window_keys(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A number for each window of n codes of so many bits, equal for equal windows: packed, or else made of the halves' numbers."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    if n * bits <= 63:
        out = np.zeros(size, np.int64)
        for i in range(n):
            out = out << bits | codes[i : i + size]
        return out
    left, right = (np.unique(window_keys(c, m, bits), return_inverse=True)[1] for c, m in ((codes, n // 2), (codes[n // 2 :], n - n // 2)))
    return left[:size] * (int(right.max(initial=0)) + 1) + right[:size]


def crc_table() -> np.ndarray:
    """CRC-32 of each byte, by its polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), t >> np.uint32(1) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


CRC = crc_table()


def window_crcs(codes: np.ndarray, alphabet: np.ndarray, n: int, prefix: str) -> np.ndarray:
    """CRC-32 of ``prefix`` and each window's UTF-8 bytes, for all windows at once."""
    letters = [chr(c).encode("utf-8", "surrogatepass") for c in alphabet.tolist()]
    sizes = np.array([len(x) for x in letters], dtype=np.int64)
    table = np.array([list(x.ljust(4, b"\0")) for x in letters], dtype=np.uint32).reshape(-1, 4)
    count = len(codes) - n + 1
    crc = np.full(max(0, count), zlib.crc32(prefix.encode()) ^ 0xFFFFFFFF, dtype=np.uint32)
    for i in range(n if count > 0 else 0):
        c = codes[i : i + count]
        for k in range(int(sizes.max())):
            step = CRC[(crc ^ table[c, k]) & np.uint32(255)] ^ crc >> np.uint32(8)
            crc = step if k == 0 else np.where(sizes[c] > k, step, crc)
    return crc ^ np.uint32(0xFFFFFFFF)


def hashed_windows(texts: list[str], sizes: tuple[int, ...], name: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n: (n, hashes, numbers of the texts) of the distinct n-grams of each text."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    alphabet, codes = np.unique(code_points("".join(texts)), return_inverse=True)
    codes = codes.astype(np.int64)
    owner, end = np.repeat(np.arange(len(texts)), lengths), np.repeat(np.cumsum(lengths), lengths)
    for n in sizes:
        keys = window_keys(codes, n, max(1, int(len(alphabet)).bit_length()))
        at = np.flatnonzero(np.arange(len(keys)) + n <= end[: len(keys)])  # windows that don't cross into the next text
        order = at[np.lexsort((keys[at], owner[at]))]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (keys[order[1:]] != keys[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
        once = order[fresh]
        yield n, window_crcs(codes, alphabet, n, f"{name}:{n}:")[once].astype(np.int64) % VECTOR_DIMENSIONS, owner[once]


class Vectors:
    """Hashed, weighted gram vectors of several texts as postings, and their norms."""

    def __init__(self, made: list[Line]):
        keys, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
        self.rows = max(1, len(made))
        for name, texts, base in (("exact", [m.plain for m in made], 1.0), ("class", [m.signed for m in made], CLASS_WEIGHT)):
            for n, hashes, owner in hashed_windows(texts, VECTOR_SIZES, name):
                keys.append(hashes * self.rows + owner)
                weights.append(np.full(len(owner), base * n / min(VECTOR_SIZES)))
        cells, at = np.unique(np.concatenate(keys), return_inverse=True)  # features that fall together are added up
        self.feature, self.owner = cells // self.rows, cells % self.rows
        self.weight = np.bincount(at, weights=np.concatenate(weights), minlength=len(cells)) if len(cells) else np.zeros(0)
        self.norm = np.sqrt(np.bincount(self.owner, weights=self.weight**2, minlength=self.rows))

    def cosines(self, other: Vectors) -> np.ndarray:
        """Cosine of every text of ``other`` (rows) with every own one: postings of equal features, merged."""
        low, high = np.searchsorted(self.feature, other.feature), np.searchsorted(self.feature, other.feature, side="right")
        size = high - low
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)
        place = np.repeat(other.owner, size) * self.rows + self.owner[at]
        dot = np.bincount(place, weights=self.weight[at] * np.repeat(other.weight, size), minlength=other.rows * self.rows).reshape(other.rows, self.rows)
        scale = other.norm[:, None] * self.norm
        return np.divide(dot, scale, out=np.zeros_like(dot), where=scale > 0)


def representative(lines: list[Line], most: int) -> list[Line]:
    """At most so many lines, evenly spaced, by half-even rounded index."""
    if most <= 0 or len(lines) <= most:
        return lines
    return lines[:1] if most == 1 else [lines[i] for i in sorted({round(k * (len(lines) - 1) / (most - 1)) for k in range(most)})]


def longest_integers(values: list[int]) -> int:
    held, best = set(values), 0
    for v in held:
        if v - 1 not in held:
            n = 1
            while v + n in held:
                n += 1
            best = max(best, n)
    return best


def vector_score(lines: list[Line], page: Page, most_lines: int, regions: int, least: float, needed: int, gap: int) -> tuple[int, int, int, float] | None:
    """M8 of a page: (ordered run of placements, longest run of lines, lines with a hit, mean of the best ``needed`` hits); None with fewer hits."""
    from .matching import ordered_run

    asked = representative(lines, most_lines)
    if not asked or not page.made:
        return None
    lines_ = Vectors(asked)
    cosines = np.concatenate([b.cosines(lines_) for b in page.vectors], axis=1)
    needed, hits, placed = min(needed, len(asked)), [], []
    width = np.array([end - start for start, end in page.spans])
    for line, row in zip(asked, cosines, strict=True):
        able = np.flatnonzero((row >= least) & (row > 0))
        if len(able):
            best = able[np.lexsort((able, width[able], -row[able]))][: max(1, regions)]
            hits.append((line.index, float(row[best[0]])))
            placed += [(line.index, 0, "text", *page.spans[r]) for r in best.tolist()]
    if len(hits) < needed:
        return None
    top = sorted((s for _, s in hits), reverse=True)[:needed]
    return ordered_run(placed, gap), longest_integers([i for i, _ in hits]), len(hits), sum(top) / max(1, needed)


# --- as jobs ---------------------------------------------------------------------

LINE = "array<struct<line_index: int, text: string>>"
REGION = "array<struct<line_start: int, line_end: int, text: string>>"


def gathered_lines(lines: DataFrame) -> DataFrame:
    """item_id and its lines (line_index, text) as one array: a passage's own lines."""
    return lines.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct(F.col("line_index").cast("int").alias("line_index"), "text"))).alias("lines"))


#: Parts in which the passages of one page are dealt.
PAGE_PARTS = 8


def pair_rows(pairs: DataFrame, lines: DataFrame, regions: DataFrame) -> DataFrame:
    """item_id, page_id, lines, regions of the pairs, both arrays joined by id.

    Rows of a page come one after the other, so that it is prepared once for
    them; a page that very many passages chose is dealt to several tasks. The
    number of partitions is stated, as rows are few and their work isn't.
    """
    t = pairs.select("item_id", "page_id").join(lines, "item_id").join(regions.select("page_id", "regions"), "page_id")
    t = t.select(F.col("item_id").cast("long").alias("item_id"), F.col("page_id").cast("long").alias("page_id"), F.col("lines").cast(LINE).alias("lines"), F.col("regions").cast(REGION).alias("regions"))
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * pairs.sparkSession.sparkContext.defaultParallelism)
    return t.repartition(tasks, "page_id", F.pmod(F.xxhash64("item_id"), F.lit(PAGE_PARTS))).sortWithinPartitions("page_id", "item_id")


def _per_pair(features, work, columns: list[tuple[str, pa.DataType]], classes: tuple[str, ...]):
    """A function of batches: ``work`` of each row's lines and page gives rows behind item_id and page_id."""
    schema = pa.schema([("item_id", pa.int64()), ("page_id", pa.int64()), *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, now, page = signature_table(classes), None, None
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                item, page_id, lines = (batch.column(i)[k].as_py() for i in range(3))
                if page is None or page_id != now:
                    now, page = page_id, Page(batch.column(3)[k].as_py() or [], features, signs)
                if lines and page.made:
                    rows += [(item, page_id, *r) for r in work([features(x["line_index"], x["text"], signs) for x in lines], page)]
            columns_ = zip(*rows, strict=True) if rows else ((),) * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns_, schema, strict=True)], schema=schema)

    return run


MATCH = "item_id long, page_id long, line_index int, kind string, score double, line_start int, line_end int"
_MATCH = [("line_index", pa.int32()), ("kind", pa.string()), ("score", pa.float64()), ("line_start", pa.int32()), ("line_end", pa.int32())]


def _matches(rows: DataFrame, features, work, kind: str, classes: tuple[str, ...]) -> DataFrame:
    def told(lines: list[Line], page: Page) -> list[tuple]:
        return [(line.index, "exact" if f.exact else kind, f.score, *page.spans[f.region]) for line, f in work(lines, page)]

    return rows.mapInArrow(_per_pair(features, told, _MATCH, classes), MATCH)


def fuzzy_matches(pairs: DataFrame, lines: DataFrame, regions: DataFrame, least: float = 0.62, n: int = 3, top: int = 16, classes: tuple[str, ...] = LATIN_CLASSES) -> DataFrame:
    """M9 over pairs (item_id, page_id): lines are (item_id, lines), regions (page_id, regions), both as arrays."""
    return _matches(pair_rows(pairs, lines, regions), gram_line(n), lambda x, p: fuzzy_lines(x, p, least, top), "fuzzy_char", classes)


def ordered_matches(pairs: DataFrame, lines: DataFrame, regions: DataFrame, least: float = 0.78, least_tokens: float = 3.0, top: int = 20, classes: tuple[str, ...] = LATIN_CLASSES) -> DataFrame:
    """M12's lines over pairs (item_id, page_id)."""
    return _matches(pair_rows(pairs, lines, regions), token_line, lambda x, p: ordered_lines(x, p, least, top, least_tokens), "ordered_token", classes)


VECTOR = "item_id long, page_id long, ordered_run int, line_run int, line_hits int, vector_score double"


def vector_pages(pairs: DataFrame, lines: DataFrame, regions: DataFrame, top: int = 8, most_lines: int = 6, per_line: int = 2, least: float = 0.03, needed: int = 3, gap: int = 4, classes: tuple[str, ...] = LATIN_CLASSES) -> DataFrame:
    """M8: of each passage's prefiltered pages the best ``top`` by vectors of its representative lines; all of them if none has enough hits.

    Pairs have item_id, page_id. The result has the vector columns, null where no page could be scored.
    """
    kinds = [("ordered_run", pa.int32()), ("line_run", pa.int32()), ("line_hits", pa.int32()), ("vector_score", pa.float64())]
    features = gram_line(min(VECTOR_SIZES))

    def scored(x: list[Line], page: Page) -> list[tuple]:
        found = vector_score([line for line in x if line.plain], page, most_lines, per_line, least, needed, gap)
        return [found] if found else []

    made = pair_rows(pairs, lines, regions).mapInArrow(_per_pair(features, scored, kinds, classes), VECTOR)
    by_item = Window.partitionBy("item_id")
    order = by_item.orderBy(F.col("ordered_run").desc_nulls_last(), F.col("line_run").desc(), F.col("line_hits").desc(), F.col("vector_score").desc(), "page_id")
    t = pairs.select("item_id", "page_id").join(made, ["item_id", "page_id"], "left")
    ranked = t.withColumns({"rn": F.row_number().over(order), "able": F.count("ordered_run").over(by_item)})
    return ranked.where((F.col("able") == 0) | ((F.col("rn") <= top) & F.col("ordered_run").isNotNull())).drop("rn", "able")
