"""Hierarchical multi-length packing of tokenised documents.

Every document becomes its token ids and an end id. Whole windows of the
longest tier are cut off; the remainder is routed to the tier of the smallest
power of two that holds it. Tiers are packed from the longest down: a window
takes one remainder of its tier, then its gap takes the longest shorter-tier
remainders that fit, and a last gap takes a cut from the shortest one. Windows
of one tier are dealt to step groups of equal tokens, by cost in a snake order.

Each task packs the rows of its own input partition in blocks of bounded size:
no shuffle, no state beyond a block, and the same result when a lost task runs
again. What is left at the end of a partition (less than one window) is cut at
its binary digits into windows that are themselves powers of two, so that no
window is ever padded.

Defined cases: a null or empty text is the end id alone; a null doc_id is kept
as null; repeated rows are packed once each; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import table, tidy
from .sentencepieces import THREADS, slices

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 16 * 2048
#: Tokens and rows gathered before a block is packed.
BLOCK_TOKENS, BLOCK_ROWS = 1 << 20, 4096
#: Texts encoded at once.
BATCH_ROWS = 256
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Distinct pre-tokens kept by a process, in two generations.
CACHE_WORDS = 500_000
#: Code points below it, whose classes are fixed, are split here; texts with others are left to the library.
LATIN_END = 0x250


def _latin(test) -> str:
    """The code points below LATIN_END that pass, as ranges of a character class."""
    own = [c for c in range(LATIN_END) if test(chr(c))]
    starts = [c for c in own if c - 1 not in set(own)]
    ends = [c for c in own if c + 1 not in set(own)]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))


def latin_splitter() -> re.Pattern:
    """The library's byte-level split of texts, for code points below LATIN_END."""
    letter, number = (_latin(lambda c, k=kind: unicodedata.category(c)[0] == k) for kind in "LN")
    space = r"\t-\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class Known(dict):
    """Ids of pre-tokens, little-endian and of 32 bits, from ``encode`` when first asked for.

    Half of ``CACHE_WORDS`` make a generation; of the one before stays what is asked for again.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.before.get(word) or self.encode(word)
        return ids

    def age(self) -> None:
        if len(self) > CACHE_WORDS // 2:
            self.before = dict(self)
            self.clear()


class ByteLevelEncoder:
    """Ids of a byte-level BPE file, by the tokenizers library.

    Pre-tokens can't influence one another, so the library's model encodes each
    distinct one once while it is known, and a text's ids are those of its
    pre-tokens. The split is the library's too for all code points that it is
    used for, and so are the letters that stand for their bytes; both are
    checked when a process starts. Other texts, and those with special strings,
    the library encodes whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.split = latin_splitter().findall
        self.known = Known(self.word)
        # of each code point the letters that stand for its bytes
        self.letters = {c: "".join(x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(chr(c))) for c in range(LATIN_END)}
        self.tokens = self.library.model.tokenize
        self.wide = [i.to_bytes(4, "little") for i in range(1 + max(self.library.get_vocab().values()))]
        self.by_word = self.library.normalizer is None and self.splits_alike()

    def splits_alike(self) -> bool:
        """Whether every code point below LATIN_END is split off from all kinds of neighbours as the library does it, and gets its ids."""
        tests = [f"{c}{c} {c}a{c}1{c}.{c}\n{c} '{c}  {c}s'll{c}" for c in map(chr, range(LATIN_END))]
        split = [self.split(text) for text in tests]
        if not all([text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)] == own for text, own in zip(tests, split, strict=True)):
            return False
        return [b"".join(self.lines(own)) for own in split] == self.alone(tests)

    def alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, word: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        wide = self.wide
        return b"".join([wide[t.id] for t in self.tokens(word.translate(self.letters))])

    def lines(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens."""
        return list(map(self.known.__getitem__, words))

    @staticmethod
    def latin(text: str) -> bool:
        """Whether all code points are below LATIN_END; most texts that are, are Latin-1, which is quicker to see."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return ord(max(text)) < LATIN_END
        return True

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        self.known.age()
        plain = [self.by_word and self.latin(t) and not any(s in t for s in self.special) for t in texts]
        others = iter(self.alone([t for t, p in zip(texts, plain, strict=True) if not p]))
        # one text at a time, so its pre-tokens are still in the processor's cache
        return [np.frombuffer(b"".join(self.lines(self.split(t))) if p else next(others), "<u4") for t, p in zip(texts, plain, strict=True)]


@lru_cache(2)
def encoder(path: str) -> ByteLevelEncoder:
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    return ByteLevelEncoder(path)


def binary_digits(n: int) -> list[int]:
    """Powers of two that add up to n, the largest first."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def pack_block(rest: list[tuple[int, int, int]], last: bool, tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list]], list[tuple[int, int, int]]]:
    """Windows, as (tier, pieces), of the (length, document, start) in ``rest``, and what has to wait.

    Unless ``last``, a window that can't be filled waits with its parts.
    """
    pool, total, out = sorted(rest), sum(x[0] for x in rest), []
    while pool:
        tier = next(t for t in tiers if t >= pool[-1][0])
        if total < tier:
            if not last:
                break
            tier = binary_digits(total)[0]
        window, gap = [], tier
        while gap:
            i = bisect_right(pool, (gap, float("inf"), 0)) - 1
            if i >= 0:
                size, doc, start = pool.pop(i)
            else:
                size, doc, start = pool.pop(0)
                insort(pool, (size - gap, doc, start + gap))
                size = gap
            window.append((size, doc, start))
            gap -= size
        total -= tier
        out.append((tier, window))
    return out, pool


def snake(costs: list[int], groups: int) -> list[int]:
    """A group for each item, of equal counts: by falling cost, forth and back."""
    out = [0] * len(costs)
    for rank, i in enumerate(sorted(range(len(costs)), key=lambda i: (-costs[i], i))):
        lap, at = divmod(rank, groups)
        out[i] = groups - 1 - at if lap % 2 else at
    return out


def pack_rows(batches: Iterator[pa.RecordBatch], encode, part: int, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, step_tokens: int = STEP_TOKENS) -> Iterator[pa.RecordBatch]:
    """Pack the rows (doc_id, text) of one partition; ``encode`` gives the ids of a list of texts."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
    longest, number, groups = tiers[-1], 0, 0
    ids: dict[int, np.ndarray] = {}
    keys: dict[int, int | None] = {}
    rest: list[tuple[int, int, int]] = []
    full: list[tuple[int, list]] = []
    rows, held = 0, 0

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal rest, full, number, groups, held
        made, rest = pack_block(rest, last, tiers)
        made, full = full + made, []
        out: list[tuple] = []
        for tier in sorted({t for t, _ in made}):
            own = [w for t, w in made if t == tier]
            count = -(-len(own) * tier // step_tokens)
            dealt = snake([sum(s * s for s, _, _ in w) for w in own], count)
            for w, g in zip(own, dealt, strict=True):
                at = 0
                for size, doc, start in w:
                    crc = zlib.crc32(ids[doc][start : start + size].astype("<u4", copy=False).tobytes())
                    out.append((keys[doc], start, size, crc, len(ids[doc]), part << 36 | number, at, tier, part << 36 | groups + g))
                    at += size
                number += 1
            groups += count
        alive = {doc for _, doc, _ in rest}
        for doc in [d for d in ids if d not in alive]:
            del ids[doc], keys[doc]
        held = sum(x[0] for x in rest)
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in chain.from_iterable(slices(b, BATCH_ROWS) for b in batches):
        for key, own in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
            tokens = np.append(own, np.uint32(end_id))
            ids[rows], keys[rows] = tokens, key
            whole = len(tokens) // longest * longest
            full += [(longest, [(longest, rows, s)]) for s in range(0, whole, longest)]
            if len(tokens) > whole:
                rest.append((len(tokens) - whole, rows, whole))
            rows += 1
            held += len(tokens)
            if held >= BLOCK_TOKENS or len(rest) >= BLOCK_ROWS:
                yield from flush(False)
    yield from flush(True)


def pack(docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of all documents (doc_id, text) in packed windows; see the module for the columns' meaning."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pack_rows(batches, encoder(path).encode_batch, TaskContext.get().partitionId(), tiers, end_id, step_tokens)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), SCHEMA)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into windows of at most 2,048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
