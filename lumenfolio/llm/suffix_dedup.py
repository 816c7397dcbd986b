"""Suffix-array dedup by run-length indexes over shards of the corpus.

A byte goes if a 100-byte string that covers it also starts earlier. Every
100-byte window is owned by its anchor, the smallest hash among the 32-byte
grams inside it; equal windows have equal anchors, so all copies of a window
meet in the shard of its anchor, and each shard's answer is exact.

Round 1 counts anchors, and windows whose anchor occurs once are settled.
Round 2 sends the others to their shards as fragments, the runs of
consecutive windows with one anchor; a group sends each distinct fragment
once, and a shard merges equal ones, so a passage costs it one fragment
however many documents hold it. A fragment that is then alone with its anchor,
and can't hold a window twice, is settled. The shard builds run-length indexes
of all others, in document order and some anchors at a time, streams their
matching statistics, and answers with the runs of windows that start earlier
elsewhere, by their places in each group. Round 3 lays them over the texts,
which it need not hash again, and removes the bytes that they cover.

An anchor of more than ``HOT`` occurrences (a passage that very many documents
share has one such anchor near each edge) is split: its windows go to shards
one by one, by their own hash. So no shard grows with a group of copies.

Defined cases: a null text is empty; a text under 100 bytes loses nothing; a
null doc_id comes after all others; rows that repeat a doc_id, or have none,
are laid one after the other, by a hash of the text (the group that it falls
in) and then by text; an empty table gives no rows; other columns are ignored.
Kept bytes that no longer form UTF-8 at a cut are dropped from ``kept_text``,
not from the digests. A text of any length is taken whole by one task, at
about 60 bytes of memory per byte of text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import texthash as H
from .common import table, text_bytes, tidy_cogroup, tidy_group
from .rounds import ANSWER, answer_table, answers, codes, cuts, group_size, grouped, log2, unique_counts
from .run_index import RunIndex, ranges

LENGTH, GRAM = 100, 32
#: Least and most text of a group.
GROUP_BYTES, MOST_GROUP_BYTES = 2 << 20, 8 << 20
#: Windows of one fragment at most, and occurrences beyond which an anchor is split.
FRAGMENT, HOT = 1024, 4096
ANCHOR_SHARD_BITS, SHARD_BYTES = 20, 4 << 20
#: Fragments that a shard indexes at once; only a single class of more goes beyond it.
INDEX_BYTES = 1 << 20
#: What a group sends to a shard, packed.
SENT = ("bytes", "sizes", "classes", "docs", "starts", "begins", "copies")
ONCE, REPEATED, SPLIT = 0, 1, 2
ANCHORS, FRAGMENTS, COPIES = 1, 2, 3
LAST_ID = (1 << 63) - 1


class Sizes:
    """Numbers of shards, from the bytes of all texts."""

    def __init__(self, total_bytes: int, hot: int = HOT):
        self.hot = hot
        self.anchor_bits = max(4, log2(total_bytes / 24, 0) - ANCHOR_SHARD_BITS)
        self.shard_bits = max(4, log2(total_bytes / SHARD_BYTES, 0))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` consecutive values."""
    span, out = 1, values
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[:-rest], out[rest:]) if rest else out


def anchors_of(buf: np.ndarray, valid: np.ndarray, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each window's anchor (0 where it isn't ``valid``), and, if ``counted``, the grams that are some window's anchor.

    Worked out in blocks that stay in a processor's cache, each with the grams on either side that its windows share.
    """
    n, width = len(valid), LENGTH - GRAM + 1
    least, picked = np.empty(n, H.U), [np.zeros(0, H.U)]
    for a in range(0, n, H.BLOCK):
        low, b = max(0, a - width + 1), min(n, a + H.BLOCK)
        grams = H.byte_windows(buf[low : b + LENGTH - 1], GRAM)
        grams |= H.U(1)
        own = sliding(grams, width, np.minimum)
        own[~valid[low:b]] = 0
        least[a:b] = own[a - low :]
        if counted:
            end = b if b < n else n + width - 1
            around = np.concatenate([np.zeros(width - 1 - (a - low), H.U), own, np.zeros(end - b, H.U)])
            mine = grams[a - low : end - low]
            picked.append(mine[sliding(around, width, np.maximum) == mine])
    return least, np.concatenate(picked)


class Group:
    """The windows of one group's texts, in the order of (doc_id, text).

    Only ``counted`` groups know how often their anchors occur.
    """

    def __init__(self, t: pa.Table, sizes: Sizes, counted: bool = False):
        self.table, self.buf, self.offsets = laid_out(t)
        self.sizes = sizes
        windows = max(0, len(self.buf) - LENGTH + 1)
        self.counted, self.valid = counted, np.zeros(windows, bool)
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            self.valid[a : max(a, b - LENGTH + 1)] = True
        if not self.valid.any():
            self.anchor = self.picked = np.zeros(0, H.U)
            self.begin = self.size = np.zeros(0, np.int64)
            return
        least, picked = anchors_of(self.buf, self.valid, counted)
        self.picked = H.mix(picked)
        change = np.flatnonzero(least[1:] != least[:-1]) + 1
        begin = np.concatenate([[0], change])
        size = np.diff(np.append(begin, windows))
        own = least[begin] != 0
        begin, size = begin[own], size[own]
        # a run may go on over the end of a text only through invalid windows, so it never does
        pieces = -(-size // FRAGMENT)
        which = np.repeat(np.arange(len(begin)), pieces)
        part = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.begin = begin[which] + part * FRAGMENT
        self.size = np.minimum(FRAGMENT, size[which] - part * FRAGMENT)
        self.anchor = H.mix(least[self.begin])

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, their occurrences (if counted), and their shards."""
        keys, counts = unique_counts(self.picked if self.counted else self.anchor)
        return keys, counts, (keys >> H.U(64 - self.sizes.anchor_bits)).astype(np.int64)

    def fragments(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, number of windows and key (anchor, or own hash) of each fragment that isn't settled, by shard; windows of split anchors are single."""
        keys, _, _ = self.anchors()
        known = codes(replies, ANCHORS, len(keys))
        state = known[np.searchsorted(keys, self.anchor)] if len(self.anchor) else np.zeros(0, np.uint8)
        whole, split = np.flatnonzero(state == REPEATED), np.flatnonzero(state == SPLIT)
        begin, size, key = self.begin[whole], self.size[whole], H.mix(self.anchor[whole])
        if len(split):
            count = self.size[split]
            single = np.repeat(self.begin[split] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            begin = np.concatenate([begin, single])
            size = np.concatenate([size, np.ones(len(single), np.int64)])
            key = np.concatenate([key, H.byte_windows(self.buf, LENGTH, 1)[single]])
        order = np.lexsort((begin, key >> H.U(64 - self.sizes.shard_bits)))
        return begin[order], size[order], key[order]

    def places(self, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document key, start within what this group's documents of that key hold) of byte positions."""
        doc = np.searchsorted(self.offsets, begin, "right") - 1
        ids = np.array([LAST_ID if x is None else x for x in self.table["doc_id"].to_pylist()], np.int64)
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        base = self.offsets[:-1][np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))]
        return ids[doc], begin - base[doc]


def laid_out(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A group's rows in the order of (doc_id, text), the bytes of their texts and the texts' offsets."""
    t = t.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return (t, *H.flat(t["text"]))


def _columns(rows: list[tuple], types: list, names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, x) for c, x in zip(columns, types, strict=True)], names)


def anchor_part(t: pa.Table, sizes: Sizes) -> pa.Table:
    """Round 1, in a group: distinct anchors (32 bits within the shard) and counts up to 255."""
    g = t["g"][0].as_py()
    keys, counts, shards = Group(t, sizes, counted=True).anchors()
    short = (keys << H.U(sizes.anchor_bits) >> H.U(32)).astype(np.uint32)
    few = np.minimum(counts, 255).astype(np.uint8)
    return _columns([(s, g, short[a:b].tobytes(), few[a:b].tobytes()) for s, a, b in cuts(shards)], [pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["shard", "g", "keys", "counts"])


def merge_anchors(t: pa.Table, sizes: Sizes) -> pa.Table:
    asked = [np.frombuffer(x, np.uint32) for x in t["keys"].to_pylist()]
    keys = np.concatenate(asked)
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in t["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    sums = np.add.reduceat(counts[order], first)
    code = np.where(sums > sizes.hot, SPLIT, np.where(sums > 1, REPEATED, ONCE)).astype(np.uint8)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(code, np.diff(np.append(first, len(s))))
    ends, shard = np.cumsum([len(x) for x in asked]).tolist(), t["shard"][0].as_py()
    return answer_table([(g, ANCHORS, shard, out[e - len(x) : e].tobytes()) for g, x, e in zip(t["g"].to_pylist(), asked, ends, strict=True)])


def fragment_part(t: pa.Table, replies: pa.Table, sizes: Sizes) -> pa.Table:
    """Round 2, in a group: for each shard the distinct fragments, their keys (32 bits within the shard) and first places.

    What repeats one of them in the group goes in any case: those windows, as runs, go along with one shard's row.
    """
    group, out = Group(t, sizes), []
    begin, size, anchor = group.fragments(replies)
    doc, start = group.places(begin)
    short = (anchor << H.U(sizes.shard_bits) >> H.U(32)).astype(np.uint32)
    data, ends = group.buf.tobytes(), (begin + size + LENGTH - 1).tolist()
    pieces = [data[a:b] for a, b in zip(begin.tolist(), ends, strict=True)]
    copied = np.ones(len(begin), bool)
    shards = list(cuts((anchor >> H.U(64 - sizes.shard_bits)).astype(np.int64)))
    g = t["g"][0].as_py()
    for s, a, b in shards:
        seen: dict[bytes, int] = {}
        for i, f in enumerate(pieces[a:b], a):
            seen.setdefault(f, i)
        own = np.fromiter(seen.values(), np.int64, len(seen))
        copied[own] = False
        sent = (size[own].astype(np.uint16), short[own], doc[own], start[own], begin[own].astype(np.uint32))
        out.append([s, g, b"".join(seen), *(x.tobytes() for x in sent), b""])
    if copied.any():
        out[g % len(out)][-1] = packed_runs(*joined(begin[copied], size[copied]))
    return _columns(out, [pa.int64(), pa.int64(), *[pa.binary()] * len(SENT)], ["shard", "g", *SENT])


def joined(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows that don't overlap, with runs that follow one another as one."""
    order = np.argsort(begin)
    begin, end = begin[order], (begin + size)[order]
    first = np.flatnonzero(np.concatenate([[True], begin[1:] != end[:-1]]))
    return begin[first], end[np.append(first[1:], len(begin)) - 1] - begin[first]


def packed_runs(begin: np.ndarray, size: np.ndarray) -> bytes:
    return np.stack([begin, size]).astype(np.uint32).tobytes()


def settled(fragment: bytes, windows: int) -> bool:
    """Whether no window of a fragment can be another window of it too.

    All its windows hold the bytes from the start of its last one to the end of its first one; equal windows
    would hold them at two places.
    """
    return windows <= LENGTH and fragment.find(fragment[windows - 1 : LENGTH], windows) < 0


def repeated_runs(fragments: list[bytes], windows: np.ndarray, classes: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, first window, number of windows) of the runs of windows that start earlier too, ``rank`` being the order of the fragments' first places.

    Only fragments of one class can share a window, so what is alone in its class is settled, and classes are
    indexed a few at a time.
    """
    _, which, count = np.unique(classes, return_inverse=True, return_counts=True)
    alone = np.flatnonzero(count[which] == 1)
    live = np.ones(len(fragments), bool)
    live[[i for i, w in zip(alone.tolist(), windows[alone].tolist(), strict=True) if settled(fragments[i], w)]] = False
    live = np.flatnonzero(live)
    live = live[np.argsort(which[live], kind="stable")]
    own, out = which[live], [np.zeros((3, 0), np.int64)]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(live) else np.zeros(0, np.int64)
    size = np.cumsum(windows[live] + LENGTH)  # with separators
    a = 0
    while a < len(live):  # whole classes, as many as fit
        room = np.searchsorted(size, (size[a - 1] if a else 0) + INDEX_BYTES, "right")
        ends = np.append(first[first > a], len(live))
        b = int(ends[max(0, np.searchsorted(ends, room, "right") - 1)])
        part = live[a:b]
        part = part[np.argsort(rank[part])]
        index = RunIndex([fragments[i] for i in part.tolist()])
        edge = np.diff(np.concatenate([[0], index.repeats(LENGTH), [0]]).astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = np.searchsorted(index.starts, start, "right") - 1
        out.append(np.stack([part[at], start - index.starts[at], stop - start]))
        a = b
    fragment, begin, width = np.concatenate(out, axis=1)
    return fragment, begin, width


def merge_fragments(t: pa.Table) -> pa.Table:
    """Index one shard's distinct fragments in document order, and answer with the runs of windows that start earlier too, by their places in each group."""
    groups, shard = t["g"].to_pylist(), t["shard"][0].as_py()
    size, short, doc, start, begin = ([np.frombuffer(x, kind) for x in t[c].to_pylist()] for c, kind in zip(SENT[1:-1], (np.uint16, np.uint32, np.int64, np.int64, np.uint32), strict=True))
    seen: dict[bytes, int] = {}
    which = []  # of each group's distinct fragments, among all
    for data, w in zip(t["bytes"].to_pylist(), size, strict=True):
        ends = np.cumsum(w.astype(np.int64) + LENGTH - 1).tolist()
        which.append(np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip([0, *ends], ends, strict=False)), np.int64, len(w)))
    every = np.concatenate(which)
    # documents that share a key are in order of their groups
    order = np.lexsort((np.concatenate(start), np.repeat(groups, [len(w) for w in which]), np.concatenate(doc)))
    unique, first = np.unique(every[order], return_index=True)  # of each fragment the first place
    best, rank = np.zeros(len(every), bool), np.empty(len(unique), np.int64)
    best[order[first]] = True
    rank[unique] = first
    one = np.unique(every, return_index=True)[1]
    windows = np.concatenate(size)[one].astype(np.int64)
    fragment, offset, width = repeated_runs(list(seen), windows, np.concatenate(short)[one], rank)
    by = np.argsort(fragment, kind="stable")
    offset, width = offset[by], width[by]
    runs = np.bincount(fragment, minlength=len(unique))
    run_at = np.cumsum(runs) - runs
    out, at = [], 0
    for g, own, b, copies in zip(groups, which, begin, t["copies"].to_pylist(), strict=True):
        head = best[at : at + len(own)]
        at += len(own)
        lead, rest = own[head], own[~head]
        n = runs[lead]
        run = ranges(run_at[lead], n)
        gone = np.concatenate([b[~head], np.repeat(b[head], n) + offset[run]])
        answer = packed_runs(gone, np.concatenate([windows[rest], width[run]])) if len(gone) else b""
        out += [(g, kind, shard, x) for kind, x in ((FRAGMENTS, answer), (COPIES, copies)) if x]
    return answer_table(out)


def removed_bytes(replies: pa.Table, size: int) -> np.ndarray:
    """Round 3, in a group: which of ``size`` bytes an earlier-starting window covers."""
    gone = np.zeros(size + 1, np.int32)
    for found in (*answers(replies, FRAGMENTS), *answers(replies, COPIES)):
        begin, windows = np.frombuffer(found, np.uint32).astype(np.int64).reshape(2, -1)
        np.add.at(gone, begin, 1)
        np.subtract.at(gone, begin + windows + LENGTH - 1, 1)
    return np.cumsum(gone[:-1], dtype=np.int32) > 0


def cut_rows(t: pa.Table, replies: pa.Table, digest: bool) -> pa.Table:
    """The rows of a group with what is left of their texts."""
    t, buf, offsets = laid_out(t)
    gone = removed_bytes(replies, len(buf))
    data, rows = buf.tobytes(), []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = gone[a:b]
        n = int(np.count_nonzero(own))
        kept = buf[a:b][~own].tobytes() if n else data[a:b]
        spans = int(own[0]) + int(np.count_nonzero(own[1:] & ~own[:-1])) if n else 0
        rows.append((b - a, n, spans, hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "ignore")))
    columns = list(zip(*rows, strict=True)) or [()] * 4
    added = [pa.array(c, x) for c, x in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)]
    base = t.drop_columns(["g", "text"])
    for name, c in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept_text"), added, strict=True):
        base = base.append_column(name, c)
    return base


def cut_matches(docs: DataFrame, digest: bool = False, group_bytes: int | None = None, hot: int = HOT, carry: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes: as kept_text, or as their SHA-256 if ``digest``.

    With ``carry`` the column ``row`` of ``docs`` (anything) goes along.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *["row"] * carry)
    total = text_bytes(docs)
    sizes = Sizes(total, hot)
    texts = grouped(docs, [F.col("doc_id"), F.col("text")], total, group_bytes or group_size(total, GROUP_BYTES, MOST_GROUP_BYTES)).groupBy("g")

    parts = texts.applyInArrow(tidy_group(lambda t: anchor_part(t, sizes)), "shard long, g long, keys binary, counts binary")
    anchors = parts.groupBy("shard").applyInArrow(tidy_group(lambda t: merge_anchors(t, sizes)), ANSWER)
    sent = texts.cogroup(anchors.groupBy("g")).applyInArrow(tidy_cogroup(lambda t, r: fragment_part(t, r, sizes)), ", ".join(["shard long, g long", *(f"{c} binary" for c in SENT)]))
    found = sent.groupBy("shard").applyInArrow(tidy_group(merge_fragments), ANSWER)
    long, text = T.LongType(), T.StringType()
    added = [("n_bytes", long), ("n_removed", long), ("n_spans", long), ("kept_sha256" if digest else "kept_text", text)]
    schema = T.StructType([T.StructField("doc_id", long), *([docs.schema["row"]] if carry else []), *(T.StructField(n, k) for n, k in added)])
    return texts.cogroup(found.groupBy("g")).applyInArrow(tidy_cogroup(lambda t, r: cut_rows(t, r, digest)), schema)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove 100-byte matches with earlier text from all documents."""
    return cut_matches(table(spark, sf_dir, "documents"), digest=True)
