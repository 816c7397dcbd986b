"""SentencePiece encoding and decoding by the tokenizers library.

The model file is parsed from its protobuf wire format. From it are rebuilt:
the normaliser (compiled character map, white space rules), the metaspace
marker, the unigram scores or else the BPE merges (in the order of the merged
pieces' scores) and the byte fallback. Where no piece holds a marker after
another character, words can't influence one another; then each distinct word
is encoded once, in multithreaded batches, decoded once, and kept in a bounded
cache.

Every distinct word is also encoded by the sentencepiece library, and decoded,
as it enters the cache; where words aren't independent, or text is changed
before it is split, every whole text is. So parity is verified for all rows; a
row whose ids differ says so in a column, and the job goes on. Rows are
independent: no shuffle, and lost tasks rerun.

Defined cases: a null text gives null ids and is treated as an empty text in
``op2_sentencepiece``; an empty text has no ids; texts of any length are
encoded whole; repeated rows are encoded once each; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, tidy

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Distinct words kept by a process; the cache starts anew beyond it.
CACHE_WORDS = 800_000
#: Threads that encode a batch, unless the environment says otherwise; more than an executor's cores only spin.
THREADS = 2


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        elif kind == 2:
            size = varint()
            yield number, data[at : (at := at + size)]
        elif kind in (1, 5):
            yield number, data[at : (at := at + (8 if kind == 1 else 4))]
        else:
            raise ValueError(f"wire type {kind}")


@dataclass
class Model:
    """What a SentencePiece model file holds."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse_model(data: bytes) -> Model:
    m = Model([])
    for number, value in wire(data):
        if number == 1:
            part = dict(wire(value))
            m.pieces.append((part[1].decode(), struct.unpack("<f", part.get(2, b"\0\0\0\0"))[0], part.get(3, NORMAL)))
        elif number == 2:
            part = dict(wire(value))
            m.kind, m.byte_fallback = part.get(3, UNIGRAM), bool(part.get(35, 0))
        elif number == 3:
            part = dict(wire(value))
            m.charsmap, m.dummy_prefix, m.squeeze, m.escape = part.get(2, b""), bool(part.get(3, 1)), bool(part.get(4, 1)), bool(part.get(5, 1))
    m.unk_id = next((i for i, (_, _, kind) in enumerate(m.pieces) if kind == UNKNOWN), 0)
    if m.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {m.kind} has no counterpart here")
    return m


def merges(m: Model) -> list[tuple[str, str]]:
    """Pairs whose union is a piece, by that piece's score (high first), then by the pair.

    Of pieces of one score sentencepiece merges the leftmost pair first, so a
    run of markers grows from its left end as far as a piece goes; the pair
    with the longest left part first has the same effect.
    """
    ids = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (NORMAL, USER)}
    pieces = Counter(m.pieces[i][1] for i in ids.values())
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-m.pieces[i][1], -cut if pieces[m.pieces[i][1]] > 1 else 0, left, right))
    return [(m.pieces[a][0], m.pieces[b][0]) for _, _, a, b in sorted(found)]


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        with open(path, "rb") as f:
            self.model = m = parse_model(f.read())
        self.path = path
        if m.kind == UNIGRAM:
            inner = models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk_id, m.byte_fallback)
        else:
            inner = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m), unk_token=m.pieces[m.unk_id][0], fuse_unk=True, byte_fallback=m.byte_fallback)
        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        steps += [normalizers.Prepend(MARK)] if m.dummy_prefix else []
        steps += [normalizers.Replace(" ", MARK)] if m.escape else []
        self.normalizer = normalizers.Sequence(steps)
        self.whole = Tokenizer(inner)
        ends = [decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []
        self.whole.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
        #: Words are independent if a marker never follows another character within a piece.
        self.by_word = m.escape and not any(MARK in p.lstrip(MARK) for p, _, kind in m.pieces if kind in (NORMAL, USER))
        self.identity = not (m.charsmap or m.squeeze) and m.dummy_prefix and m.escape
        self.cache: dict[str, bytes] = {}  # little-endian 32-bit ids
        #: cached words that decode to something else, and those whose ids differ from the sentencepiece library's
        self.wrong: set[str] = set()
        self.differ: set[str] = set()

    def normalize(self, text: str) -> str:
        if self.identity:
            return MARK + text.replace(" ", MARK) if text else ""
        return self.normalizer.normalize_str(text)

    def words(self, normal: str) -> list[str]:
        """A run of markers and what follows up to the next marker."""
        head, *rest = normal.split(MARK)
        if "" not in rest:
            return ([head] if head else []) + [MARK + x for x in rest]
        out, run = [head] if head else [], 0
        for x in rest:
            run += 1
            if x:
                out.append(MARK * run + x)
                run = 0
        return out + ([MARK * run] if run else [])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; words are split, encoded and checked once."""
        return [ids for ids, _, _ in self.encode_checked(texts)]

    def encode_checked(self, texts: list[str]) -> list[tuple[np.ndarray, bool, bool]]:
        """Ids of each text, whether they are the sentencepiece library's, and whether they decode to the normalised text."""
        normal = [self.normalize(t) for t in texts]
        if not self.by_word:
            out = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast(normal, add_special_tokens=False)]
            return list(zip(out, self.parity(texts, out), self.round_trips(texts, out), strict=True))
        split = [self.words(t) for t in normal]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
            self.wrong.clear()
            self.differ.clear()
        cache = self.cache
        missing = list(set(chain.from_iterable(split)).difference(cache))
        for a in range(0, len(missing), 20_000):
            part = missing[a : a + 20_000]
            ids = [e.ids for e in self.whole.encode_batch_fast(part, add_special_tokens=False)]
            cache.update(zip(part, (struct.pack(f"<{len(i)}I", *i) for i in ids), strict=True))
            self.wrong.update(w for w, back in zip(part, self.decode_batch(ids), strict=True) if back != plain_word(self, w))
            if self.identity:
                self.differ.update(self.differing(part, ids))
        out = [np.frombuffer(b"".join(map(cache.__getitem__, w)), "<u4") for w in split]
        free = lambda bad, words: not bad or bad.isdisjoint(words)
        same = [free(self.differ, w) for w in split] if self.identity else self.parity(texts, out)
        return list(zip(out, same, (free(self.wrong, w) for w in split), strict=True))

    def differing(self, words: list[str], ids: list[list[int]]) -> Iterator[str]:
        """The words to which the sentencepiece library, which adds the first marker itself, gives other ids."""
        known = reference(self.path).encode([w[1:] for w in words], num_threads=1)
        for word, own, other in zip(words, ids, known, strict=True):
            if word == MARK:  # a last marker; as a text of its own it would be empty
                other = [reference(self.path).piece_to_id(MARK)]
            if own != other:
                yield word

    def parity(self, texts: list[str], ids: list[np.ndarray]) -> list[bool]:
        """Whether the sentencepiece library gives each whole text the same ids."""
        return [own.tolist() == known for own, known in zip(ids, reference(self.path).encode(texts, num_threads=1), strict=True)]

    def round_trips(self, texts: list[str], ids: list[np.ndarray]) -> list[bool]:
        """Whether each text's ids decode to the normalised text."""
        return [back == plain(self, text) for back, text in zip(self.decode_batch([i.tolist() for i in ids]), texts, strict=True)]

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(2)
def reference(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def slices(batch: pa.RecordBatch, most: int = 512) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, most):
        yield batch.slice(a, most)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids, parity_equal: the token ids of each text (null for a null text), and whether they are the sentencepiece library's."""
    path = model or default_model()

    def run(batches):
        for batch in chain.from_iterable(map(slices, batches)):
            texts = batch.column(1).to_pylist()
            found = codec(path).encode_checked([t or "" for t in texts])
            ids = [None if t is None else i.astype(np.int32) for t, (i, _, _) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([same for _, same, _ in found], pa.bool_())], ["doc_id", "ids", "parity_equal"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, ids array<int>, parity_equal boolean")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text: the text that each list of ids stands for (null for null)."""
    path = model or default_model()

    def run(batches):
        for batch in chain.from_iterable(map(slices, batches)):
            ids = batch.column(1).to_pylist()
            texts = codec(path).decode_batch([i or [] for i in ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if i is None else t for i, t in zip(ids, texts, strict=True)], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, text string")


RESULT = "doc_id long, n_tokens long, ids_crc32 long, n_unknown long, decoded_equal boolean, parity_equal boolean"


def encode_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Encode and decode every whole text, and report per document.

    Columns: n_tokens; ids_crc32 (unsigned, of little-endian 32-bit ids);
    n_unknown; decoded_equal (decoding gives the normalised text back);
    parity_equal (the ids are the sentencepiece library's). Both hold for all
    rows, by their distinct words where these are independent.
    """
    path = model or default_model()

    def run(batches):
        for batch in chain.from_iterable(map(slices, batches)):
            c = codec(path)
            found = c.encode_checked([t or "" for t in batch.column(1).to_pylist()])
            rows = [(len(i), zlib.crc32(i.astype("<u4", copy=False).tobytes()), int((i == c.model.unk_id).sum()), back, same) for i, same, back in found]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(columns, types, strict=True))], [x.split()[0] for x in RESULT.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), RESULT)


def plain(c: Codec, text: str) -> str:
    """The normalised text as decoding shows it: markers are spaces, and the added first one is gone."""
    if c.identity:
        return text.replace(MARK, " ")
    normal = c.normalize(text).replace(MARK, " ")
    return normal[1:] if c.model.dummy_prefix and normal.startswith(" ") else normal


def plain_word(c: Codec, word: str) -> str:
    """A word as decoding it alone shows it."""
    shown = word.replace(MARK, " ")
    return shown[1:] if c.model.dummy_prefix and shown.startswith(" ") else shown


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    return encode_digests(table(spark, sf_dir, "documents"))
