"""MinHash near-deduplication by a chosen-path set similarity join.

A document's set is its distinct word shingles, as 64-bit hashes. Equal sets
are one class; only classes are joined. Several independent trees branch the
classes recursively: a node's members go to the child named by their minwise
token of that tree and level. A pair of similarity s stays together through a
level with probability s, so ten trees miss a pair at the threshold, at the
first level, once in a hundred million. Nodes of one member end; nodes of at
most ``NODE`` members are leaves and are compared exhaustively; larger ones
branch again, up to the last level.

Work that a large group of near copies would square is avoided without losing
links. Round 1: each class meets the pivots of its nodes; the one whose sketch
agrees best is confirmed, and all those of large nodes are. Round 2: within leaves, members that round 1
left in different components meet. Nodes still large at the last level hold
near copies of one text: their pivot is the most central member, the one with
the most frequent shingles, and in round 2 their members meet over the rarest
shingles that any link must share (a prefix filter, which loses no link), if
the shingles that others have too are enough for a link; a copy with many
edits has too many of its own and meets nobody. Both
rounds first ask that a sketch of ``BITS`` one-bit minwise hashes agrees to six
standard deviations below the threshold, and confirm every link on full sets.

Sets are never broadcast; texts are shuffled only where candidates exceed a
checked number. Members of a large node, pairs of one pivot and copies of one
set are never dealt to one task (see ``join_sized``; in ``confirm`` the pivot's
set is sent to several). Trees, levels and the sketch bound the recall;
confirmed links are exact.

Defined cases: words are lower-cased A-Z only; a text with fewer words than a
shingle is one shingle; null and word-less texts have an empty set and no
links; a row with a null doc_id takes no part in links, its component_id is
null and it is kept (``judge`` links it as any other if asked to); rows that
repeat a doc_id are judged by their own texts; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as H
from .common import Scratch, table, tidy, tidy_cogroup, tidy_group
from .components import LARGE_KEY, SENT_KEYS, components, join_sized
from .rounds import ANSWER, answer_table, answers, cuts, grouped, log2, unique_counts

SHINGLE = 5
TREES, LEVELS, NODE = 10, 3, 64
#: Up to so many keys of candidate rows (8 bytes each) are broadcast to find their texts; beyond it, keys and texts are shuffled.
BROADCAST_IDS = 500_000
#: One-bit minwise hashes of every class, and of the members of large nodes.
BITS, FINE_BITS = 256, 2048
_SEEDS = H.mix(np.arange(1, TREES * LEVELS + BITS + 1, dtype=H.U)) | H.U(1)
_FINE_SEEDS = H.mix(np.arange(1, FINE_BITS + 1, dtype=H.U) + H.U(1 << 32)) | H.U(1)
#: Shingles hashed at once by all functions.
PIECE = 4096


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> Iterator[tuple[np.ndarray, int]]:
    """The sorted distinct shingle hashes of each text, in blocks of texts."""
    buf, offsets = H.flat(column)
    split = H.words_of(buf.tobytes(), offsets, lower=True)
    hashes = H.word_hashes(list(chain.from_iterable(split)))
    every, a = H.windows(hashes, k), 0
    for n in map(len, split):
        if n >= k:
            yield np.unique(every[a : a + n - k + 1])
        elif n:
            yield H.windows(hashes[a : a + n], n) + H.U(n)
        else:
            yield np.zeros(0, H.U)
        a += n


def signature(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8", copy=False).tobytes())


def least_hashes(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    least = np.full(len(seeds), np.iinfo(H.U).max, H.U)
    step = max(1, PIECE * len(_SEEDS) // len(seeds))
    for a in range(0, len(shingles), step):
        np.minimum(least, (shingles[None, a : a + step] * seeds[:, None]).min(1), out=least)
    return H.mix(least)


def one_bit(least: np.ndarray) -> np.ndarray:
    """The lowest bits, as signed 64-bit words."""
    return np.packbits((least & H.U(1)).astype(np.uint8)).view("<i8")


def minwise(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minwise token of every tree and level, and the one-bit sketch."""
    least = least_hashes(shingles, _SEEDS)
    return least[: TREES * LEVELS].view(np.int64), one_bit(least[TREES * LEVELS :])


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            sizes, keys, found, bits = [], [], [], []
            for s in shingle_sets(batch.column(1)):
                sizes.append(len(s))
                keys.append(signature(s))
                own = minwise(s) if len(s) else (None, None)
                found.append(own[0])
                bits.append(own[1])
            made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 2, 3)), *made], SKETCH_NAMES)


SKETCH = "doc_id long, rid long, rid2 long, n_shingles long, class binary, tokens array<long>, bits array<long>"
SKETCH_NAMES = [x.split()[0] for x in SKETCH.split(", ")]


def row_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's doc_id and text; only rows that agree in both columns share them."""
    doc_id = F.col("doc_id").cast("long")
    return F.xxhash64(doc_id, "text").alias("rid"), F.xxhash64(F.lit(1), doc_id, "text").alias("rid2")


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, rid, rid2 (see ``row_keys``), n_shingles, class (128 bits of the set), tokens and bits (null for an empty set)."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *row_keys(docs))
    return chosen.mapInArrow(tidy(_sketch_rows), SKETCH)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            sets = list(shingle_sets(whole.slice(at, 512).column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["class", "items"])


def agreement(a: Column, b: Column, bits: int = BITS) -> Column:
    """How many bits of two sketches agree.

    A short sketch is unrolled into the generated code; a long one would make
    the compiler of the executors take more memory than the join itself.
    """
    if bits > BITS:
        words = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        return F.lit(bits) - F.aggregate(words, F.lit(0), lambda n, w: n + w)
    differ = [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(bits // 64)]
    return F.lit(bits) - sum(differ[1:], differ[0])


def enough(a: Column, b: Column, percent: int, bits: int = BITS) -> Column:
    """Whether the sketches agree as often as a pair at the threshold would, less six deviations."""
    p = (1 + percent / 100) / 2
    return agreement(a, b, bits) >= int(bits * p - 6 * (bits * p * (1 - p)) ** 0.5)


def alike_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def branch(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """node, class, pivot, leaf, hot: members of all nodes that have company.

    ``leaf`` marks the nodes whose members are compared exhaustively, ``hot``
    those that are still large at the last level.
    Sizes and pivots come from pre-aggregated counts; a node's members are
    neither gathered nor, if they are many, dealt to one task.
    """
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    rows = classes.select("class", "tokens", F.explode(trees).alias("tree"))
    token = lambda level: F.get("tokens", F.col("tree") * LEVELS + level)
    rows = rows.select("class", "tree", *[token(i).alias(f"t{i}") for i in range(LEVELS)]).withColumn("node", F.xxhash64("tree", "t0"))
    total, out = classes.count() * TREES, None
    for level in range(LEVELS):
        sizes = scratch.keep(rows.groupBy("node").agg(F.count("*").alias("members"), F.min("class").alias("pivot")).where("members > 1"))
        met = scratch.keep(join_sized(rows, sizes, "node", total))
        last = level == LEVELS - 1
        large = F.col("members") > NODE
        part = met.select("node", "class", "pivot", (~large).alias("leaf"), (large & F.lit(last)).alias("hot"))
        out = part if out is None else out.unionByName(part)
        if not last:
            rows = met.where(large).drop("members", "pivot").withColumn("node", F.xxhash64("node", f"t{level + 1}"))
    return out


def texts_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """text of a document of each wanted class."""
    ids = scratch.keep(wanted.join(classes, "class").select("rid").distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.select(row_keys(docs)[0], "text").join(ids, "rid", "left_semi")


def with_sets(pairs: DataFrame, sets: DataFrame, end: str, other: str, most: int, scratch: Scratch) -> DataFrame:
    """``pairs`` with the set of one end; pairs of an end that has more than ``most`` are dealt by (end, part), and its set is sent to each part."""
    sets = sets.toDF(end, f"of_{end}")
    many = scratch.keep(pairs.groupBy(end).count().where(F.col("count") > most).select(end, F.ceil(F.col("count") / most).alias("parts")))
    if not many.limit(1).count():
        return pairs.join(sets, end)
    one = F.coalesce("parts", F.lit(1))
    sets = sets.join(F.broadcast(many), end, "left").select(end, f"of_{end}", F.explode(F.sequence(F.lit(0).cast("long"), one - 1)).alias("part"))
    dealt = pairs.join(F.broadcast(many), end, "left").withColumn("part", F.pmod(F.xxhash64(other), one)).drop("parts")
    return dealt.join(sets, [end, "part"]).drop("part")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of classes, written already, whose full sets are similar enough."""
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    sets = texts_of(ends, classes, docs, scratch).select("text").mapInArrow(tidy(_set_rows), "class binary, items array<long>")
    sets = sets.groupBy("class").agg(F.first("items").alias("items"))
    most = max(LARGE_KEY, pairs.count() // SENT_KEYS)
    met = with_sets(with_sets(pairs.select("a", "b"), sets, "a", "b", most, scratch), sets, "b", "a", most, scratch)
    common = F.size(F.array_intersect("of_a", "of_b"))
    similar = 100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)
    return met.where(similar).select("a", "b")


def _ask_frequencies(t: pa.Table, bits: int) -> pa.Table:
    keys, counts = unique_counts(np.concatenate([*shingle_sets(t["text"]), np.zeros(0, H.U)]))
    few, g = np.minimum(counts, 65535).astype(np.uint16), t["g"][0].as_py()
    rows = [(s, g, keys[a:b].tobytes(), few[a:b].tobytes()) for s, a, b in cuts((keys >> H.U(64 - bits)).astype(np.int64))]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.table([pa.array(c, x) for c, x in zip(columns, [pa.int64(), pa.int64(), pa.binary(), pa.binary()], strict=True)], ["shard", "g", "keys", "counts"])


def _merge_frequencies(t: pa.Table) -> pa.Table:
    asked = [np.frombuffer(x, H.U) for x in t["keys"].to_pylist()]
    keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    sums = np.bincount(inverse, np.concatenate([np.frombuffer(x, np.uint16) for x in t["counts"].to_pylist()]), len(keys))
    found = np.minimum(sums, 65535).astype(np.uint16)[inverse]
    ends, shard = np.cumsum([len(x) for x in asked]).tolist(), t["shard"][0].as_py()
    return answer_table([(g, 0, shard, found[e - len(x) : e].tobytes()) for g, x, e in zip(t["g"].to_pylist(), asked, ends, strict=True)])


def _profile_rows(t: pa.Table, replies: pa.Table, percent: int) -> pa.Table:
    sets = list(shingle_sets(t["text"]))
    keys, _ = unique_counts(np.concatenate([*sets, np.zeros(0, H.U)]))
    known = np.frombuffer(b"".join(answers(replies, 0)), np.uint16)
    names, centres, prefixes, fine, shared = [], [], [], [], []
    for s in sets:
        if len(s):
            often = known[np.searchsorted(keys, s)]
            order = np.lexsort((s, often))[: len(s) + percent * len(s) // -100 + 1]
            names.append(signature(s))
            centres.append(float(np.log(often).mean()))
            prefixes.append(s[order][often[order] > 1].view(np.int64))
            fine.append(one_bit(least_hashes(s, _FINE_SEEDS)))
            shared.append(int((often > 1).sum()))
    return pa.table([pa.array(names, pa.binary()), pa.array(centres, pa.float64()), *(pa.array(x, pa.list_(pa.int64())) for x in (prefixes, fine)), pa.array(shared, pa.int64())], ["class", "centre", "prefix", "fine", "shared"])


def profiles(hot: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """class, centre, prefix, fine, shared of the members of large nodes, by the frequencies of shingles among them all.

    ``centre`` is the mean log frequency. ``prefix`` has the rarest shingles,
    so many that a linked pair must share one, without those of this class alone.
    ``fine`` is the longer sketch, ``shared`` the number of shingles that another
    member has too: no link has more in common.
    """
    items = int(hot.join(classes, "class").agg(F.sum("n")).first()[0] or 0)
    bits = log2(items / (1 << 18), 4)
    texts = grouped(texts_of(hot, classes, docs, scratch), [F.col("rid")], 8 * items, 4 << 20).groupBy("g")
    asked = texts.applyInArrow(tidy_group(lambda t: _ask_frequencies(t, bits)), "shard long, g long, keys binary, counts binary")
    found = asked.groupBy("shard").applyInArrow(tidy_group(_merge_frequencies), ANSWER)
    rows = texts.cogroup(found.groupBy("g")).applyInArrow(tidy_cogroup(lambda t, r: _profile_rows(t, r, percent)), "class binary, centre double, prefix array<long>, fine array<long>, shared long")
    return rows.join(hot, "class", "left_semi").dropDuplicates(["class"])


def meet(x: DataFrame, key: str, percent: int, scratch: Scratch, fine: bool = False) -> DataFrame:
    """Pairs (a, b) with equal ``key``, different roots, and alike sizes and sketches.

    Under each key all members meet those outside its commonest root, so the
    members of one large component never meet each other. Members of a large
    key are dealt by (key, part), and those outside are sent to each part. Two
    members of large nodes meet over their fine sketches only, and once: at the
    smallest of the rare shingles that they share.
    """
    held = scratch.keep(x.groupBy(key, "root").agg(F.count("*").alias("held")))
    total = held.agg(F.sum("held")).first()[0] or 0
    found = held.groupBy(key).agg(F.max(F.struct("held", "root")).alias("most"), F.count("*").alias("roots"), F.sum("held").alias("members"))
    bulk = scratch.keep(found.where("roots > 1").select(key, F.col("most.root").alias("bulk"), "members"))
    x = join_sized(x, bulk, key, total).withColumn("parts", F.ceil(F.col("members") / max(LARGE_KEY, total // SENT_KEYS)))
    x = scratch.keep(x.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts"))))
    y = x.where(F.col("root") != F.col("bulk")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    x, y = (side.toDF(*[f"{c}_{end}" for c in side.columns]) for side, end in ((x, "a"), (y, "b")))
    apart = (F.col(f"{key}_a") == F.col(f"{key}_b")) & (F.col("part_a") == F.col("part_b"))
    apart &= (F.col("root_a") != F.col("root_b")) & ((F.col("root_a") == F.col("bulk_a")) | (F.col("root_a") < F.col("root_b")))
    apart &= alike_sizes(F.col("n_a"), F.col("n_b"), percent)
    if fine:
        common = F.least("shared_a", "shared_b")
        apart &= ((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))) & enough(F.col("fine_a"), F.col("fine_b"), percent, FINE_BITS)
        apart &= F.col(f"{key}_a") == F.array_min(F.array_intersect("prefix_a", "prefix_b"))
    else:
        apart &= ~(F.col("hot_a") & F.col("hot_b")) & enough(F.col("bits_a"), F.col("bits_b"), percent)
    return x.join(y, apart).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))


def _with_degrees(side: DataFrame, key: str, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``side`` with ``members``, how many of the pairs hold its key."""
    return scratch.keep(side.join(pairs.groupBy(key).agg(F.count("*").alias("members")), key))


def judge(docs: DataFrame, percent: int = 80, null_ids: bool = False) -> DataFrame:
    """Per row: doc_id, rid, rid2, n_shingles, component (16 bytes) and component_id; links are pairs of at least ``percent`` similarity.

    ``component`` is null for rows that take no part in links, as those with a
    null doc_id don't unless ``null_ids``; component_id is the smallest doc_id.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(sketch(docs))
    takes_part = (F.col("n_shingles") > 0) & (F.col("doc_id").isNotNull() | F.lit(null_ids))
    usable = rows.where(takes_part)
    least = [F.min("doc_id").alias("doc_id"), F.min("rid").alias("rid"), F.count("*").alias("members")]
    classes = scratch.keep(usable.groupBy("class").agg(*least, *[F.first(c).alias(n) for c, n in (("n_shingles", "n"), ("tokens", "tokens"), ("bits", "bits"))]))
    members = branch(classes.select("class", "tokens"), scratch)
    size = classes.select("class", "n", "bits")

    hot = scratch.keep(members.where("hot").select("node", "class"))
    profile = None
    star = members.where("class <> pivot AND NOT hot").select(F.col("pivot").alias("a"), F.col("class").alias("b"), F.lit(False).alias("central"))
    if hot.limit(1).count():
        profile = scratch.keep(profiles(hot.select("class").distinct(), classes, docs, percent, scratch))
        centre = hot.join(profile.select("class", "centre"), "class").groupBy("node").agg(F.max(F.struct("centre", "class")).alias("x"), F.count("*").alias("members"))
        pivots = scratch.keep(centre.select("node", F.col("x.class").alias("a"), "members"))
        star = star.union(join_sized(hot, pivots, "node", hot.count()).where("a <> class").select("a", F.col("class").alias("b"), F.lit(True)))
    star = scratch.keep(star.groupBy("a", "b").agg(F.max("central").alias("central")))
    pivot_sizes = _with_degrees(size.toDF("a", "n_a", "bits_a"), "a", star, scratch)
    met = join_sized(star, pivot_sizes, "a", star.count()).join(size.toDF("b", "n_b", "bits_b"), "b")
    alike = alike_sizes(F.col("n_a"), F.col("n_b"), percent) & enough(F.col("bits_a"), F.col("bits_b"), percent)
    likely = scratch.keep(met.where(alike).select("a", "b", "central", agreement(F.col("bits_a"), F.col("bits_b")).alias("agree")))
    best = likely.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
    first = scratch.keep(best.union(likely.where("central").select("a", "b")).distinct())
    links = scratch.keep(confirm(first, classes, docs, percent, scratch))
    roots = components(links, scratch=scratch)

    # what round 1 left in different components, though a node or a shared rare shingle brings it together
    is_hot = hot.select("class").distinct().withColumn("hot", F.lit(True))
    rooted = size.join(roots.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted = scratch.keep(rooted.join(is_hot, "class", "left").withColumn("hot", F.coalesce("hot", F.lit(False))))
    second = meet(members.where("leaf").select("node", "class").distinct().join(rooted, "class"), "node", percent, scratch)
    if profile is not None:
        able = profile.join(rooted.drop("bits", "hot"), "class").where((100 + percent) * F.col("shared") * 100 >= percent * F.col("n") * (100 + percent))
        fine = able.select("class", "root", "n", "shared", "fine", "prefix", F.explode("prefix").alias("item"))
        second = second.union(meet(fine, "item", percent, scratch, fine=True))
    ends = rooted.select("class", "root", "hot")
    of_pivots = _with_degrees(ends.toDF("a", "root_a", "hot_a"), "a", likely, scratch)
    labelled = join_sized(likely, of_pivots, "a", likely.count()).join(ends.toDF("b", "root_b", "hot_b"), "b")
    second = second.union(labelled.where((F.col("root_a") != F.col("root_b")) & ~(F.col("hot_a") & F.col("hot_b"))).select("a", "b"))
    second = scratch.keep(second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = scratch.keep(confirm(second, classes, docs, percent, scratch))
    if more.limit(1).count():
        roots = components(links.union(more), scratch=scratch)

    named = classes.select("class", "doc_id", "members").join(roots.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    named = scratch.keep(join_sized(named.withColumnRenamed("members", "copies"), scratch.keep(smallest), "root", classes.count()))
    of_class = named.select("class", F.col("root").alias("component"), "component_id", F.col("copies").alias("members"))
    own = rows.drop("tokens", "bits")
    linked = join_sized(own.where(takes_part), of_class, "class", rows.count())
    alone = own.where(~takes_part).withColumn("component", F.lit(None).cast("binary")).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "rid", "rid2", "n_shingles", "component", "component_id"]
    return scratch.finish(linked.select(*columns).union(alone.select(*columns)))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; links are pairs of at least ``percent`` similarity."""
    return judge(docs, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, at a similarity of 85 %."""
    return near_duplicates(table(spark, sf_dir, "documents"), 85)
