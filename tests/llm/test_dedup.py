"""Near-dedup, window dedup and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenfolio.llm import near_dedup, suffix_dedup, texthash, window_dedup
from lumenfolio.llm.components import components
from lumenfolio.llm.run_index import RunIndex

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = WORDS.findall(text.translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(sets, percent):
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    held = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            held[x].append(k)
    common = Counter()
    for ks in held.values():
        for i, a in enumerate(ks):
            common.update((min(a, b), max(a, b)) for b in ks[:i])
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, percent):
    sets = {k: shingles(t) for k, t in texts_of(docs)}
    roots = linked(sets, percent)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs, percent).collect()}
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {k: (len(s), roots[k], roots[k] == k) for k, s in sets.items()}


def test_large_group_of_near_copies(spark):
    rnd = random.Random(3)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(300):
        w = list(base)
        for _ in range(rnd.randint(0, 8)):
            w[rnd.randrange(150)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    roots = linked({i: shingles(t) for i, t in rows}, 85)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 85).collect()
    assert {r.doc_id: r.component_id for r in got} == roots


def test_near_duplicates_of_odd_rows(odd, empty):
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(odd, 85).collect()), key=str)
    by = defaultdict(set)
    for known, k, n, c, kept in got:
        by[k if known else None].add((n, c, kept))
    assert len(got) == 15 and by[8] == {(56, 5, False)} and by[5] == {(56, 5, True)} and by[6] == {(56, 5, False)} and by[7] == {(57, 5, False)}
    assert {x[1:] for x in by[None]} == {(None, True)} and by[1] == by[2].__class__({(0, 1, True)}) and by[4] == {(1, 4, True)}
    assert near_dedup.near_duplicates(empty, 85).count() == 0


def test_components(spark):
    n = 70
    links = [(bytes([i]), bytes([i + 1])) for i in range(n)] + [(bytes([200]), bytes([100]))]
    got = {r.node[0]: r.root[0] for r in components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 200: 100}


def expected_words(rows, k):
    words = [WORDS.findall(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_window_dedup(request, which):
    df = request.getfixturevalue(which)
    got = window_dedup.cut_repeats(df, digest=True, group_bytes=1 << 16).collect()
    assert sorted(map(tuple, got), key=str) == expected_words(texts_of(df), 35)


def test_window_dedup_texts_and_empty(spark, empty):
    rows = [(1, "a b c d e"), (2, "x a b c y"), (3, None)]
    got = window_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=3).collect()
    assert {r.doc_id: r.kept_text for r in got} == {1: "d e", 2: "x y", 3: ""}
    assert window_dedup.cut_repeats(empty).count() == 0


def test_count_min_never_underestimates():
    rnd = np.random.default_rng(0)
    grid = window_dedup.Grid(200_000, 2)
    texts = [" ".join(map(str, rnd.integers(0, 40, 300))) for _ in range(6)]
    tables = [pa.table({"text": pa.array([t]), "g": pa.array([i])}) for i, t in enumerate(texts)]
    parts = pa.concat_tables([window_dedup.sketch_part(t, grid) for t in tables])
    merged = []
    for row in range(window_dedup.ROWS):
        for s in set(parts["shard"].to_pylist()):
            rows = [i for i, (r, x) in enumerate(zip(parts["row"].to_pylist(), parts["shard"].to_pylist())) if (r, x) == (row, s)]
            if rows:
                merged.append(window_dedup.merge_sketch(parts.take(rows), grid))
    replies = pa.concat_tables(merged)
    pairs = Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    for i, t in enumerate(tables):
        own = replies.filter(pa.compute.equal(replies["g"], i))
        found = set(window_dedup.Group(t["text"], grid).candidates(own).tolist())
        words = texts[i].split()
        assert {k for k in range(len(words) - 1) if pairs[words[k], words[k + 1]] > 1} <= found


def expected_bytes(rows, length=100, groups=None):
    """``groups`` has, for texts of one id, the number that orders them before the text does."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, (groups or {}).get(rows[i], 0), rows[i][1].encode()))
    seen, out = set(), []
    for i in order:
        key, data = rows[i][0], rows[i][1].encode()
        gone = bytearray(len(data))
        for j in range(len(data) - length + 1):
            w = data[j : j + length]
            if w in seen:
                gone[j : j + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((key, len(data), sum(gone), sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("which", "hot"), [("docs", 4096), ("docs", 5), ("odd", 4096), ("odd", 3)])
def test_suffix_dedup(request, which, hot):
    df = request.getfixturevalue(which)
    got = suffix_dedup.cut_matches(df, digest=True, group_bytes=1 << 16, hot=hot).collect()
    assert sorted(map(tuple, got), key=str) == expected_bytes(texts_of(df))


@pytest.mark.parametrize("hot", [4096, 3])
def test_suffix_dedup_spreads_one_id(spark, hot):
    """Rows without an id, or of one id, aren't dealt to one group, and are still judged in one order."""
    from lumenfolio.llm.rounds import grouped

    rnd = random.Random(8)
    share = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(90, 260))) for _ in range(12)]
    rows = [(rnd.choice([None, None, 7, rnd.randrange(20)]), "".join(rnd.choice(share)[rnd.randrange(30) :] + rnd.choice(["", "x", "é"]) for _ in range(3))) for _ in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    total, size = sum(len(t.encode()) for _, t in rows), 4000
    dealt = grouped(df, [F.col("doc_id"), F.col("text")], total, size).collect()
    assert len({r.g for r in dealt if r.doc_id is None}) > 10 and len({r.g for r in dealt if r.doc_id == 7}) > 10
    got = suffix_dedup.cut_matches(df, digest=True, group_bytes=size, hot=hot).collect()
    assert sorted(map(tuple, got), key=str) == expected_bytes(rows, groups={(r.doc_id, r.text): r.g for r in dealt})


def test_suffix_fragments_alone_are_not_indexed(spark, monkeypatch):
    """Exact copies cost the indexes nothing, repeats inside a fragment and between unlike ones are still found."""
    sizes = []
    monkeypatch.setattr(suffix_dedup, "RunIndex", lambda strings: sizes.append(sum(map(len, strings))) or RunIndex(strings))
    rnd = random.Random(5)
    copied = "".join(rnd.choice("abcdefgh ") for _ in range(6000))
    rows = [(i, copied) for i in range(4)]

    def run(rows, size):
        sizes.clear()
        t = pa.table({"g": pa.array([0] * len(rows)), "doc_id": [i for i, _ in rows], "text": [x for _, x in rows]})
        few = suffix_dedup.Sizes(len(copied))
        monkeypatch.setattr(suffix_dedup, "INDEX_BYTES", size)
        by = lambda f, t, c: pa.concat_tables([f(t.filter(pa.compute.equal(t[c], s))) for s in set(t[c].to_pylist())])
        anchors = by(lambda x: suffix_dedup.merge_anchors(x, few), suffix_dedup.anchor_part(t, few), "shard")
        found = by(suffix_dedup.merge_fragments, suffix_dedup.fragment_part(t, anchors, few), "shard")
        cut = suffix_dedup.cut_rows(t, found, True)
        return sorted(zip(*(c.to_pylist() for c in cut.columns), strict=True), key=str)

    assert run(rows, 1 << 20) == expected_bytes(rows) and not sizes
    mixed = [*rows, (4, "ab" * 300), (5, copied[:3000] + "!" + copied[3050:]), (6, "xyz" * 50 + copied[100:400]), (7, "=" * 3000)]
    for size in (1, 2000, 1 << 20):
        assert run(mixed, size) == expected_bytes(mixed) and sizes


def test_suffix_rows_do_not_dwindle():
    """What a group sends to a shard at 6 GB (10 GB of text) still comes from kilobytes."""
    total = 10 << 30
    groups = total / suffix_dedup.group_size(total, suffix_dedup.GROUP_BYTES, suffix_dedup.MOST_GROUP_BYTES)
    assert total / (groups * 2 ** suffix_dedup.Sizes(total).shard_bits) >= 1024


def test_suffix_dedup_empty(empty):
    assert suffix_dedup.cut_matches(empty).count() == 0


def test_run_index():
    rnd = random.Random(1)
    for _ in range(120):
        strings = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 8))]
        strings += [strings[0][2:] + b"ab" * 20, b"a" * 50] * (rnd.random() < 0.5)
        length, seen = rnd.randint(1, 9), set()
        index = RunIndex(strings)
        got = index.repeats(length)
        assert index.run_lengths.sum() == index.size and len(index.heads) <= index.size
        for at, s in zip(index.starts, strings):
            for i in range(len(s) + 1):
                w = s[i : i + length]
                assert got[at + i] == (len(w) == length and w in seen)
                if len(w) == length:
                    seen.add(w)
    for times in (300, 30_000):  # what is kept grows with the runs, not with the text
        repetitive = RunIndex([b"abcdefghij" * times])
        assert len(repetitive.heads) < 40
        assert sum(x.nbytes for x in vars(repetitive).values() if isinstance(x, np.ndarray)) < 40 * 40
        assert repetitive.repeats(100).sum() == 10 * times - 99 - 10


def test_run_index_transform_and_statistics():
    rnd = random.Random(12)
    for _ in range(60):
        strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 25))) for _ in range(rnd.randint(1, 5))]
        text = [c for i, s in enumerate(strings) for c in (*((1, x) for x in s), (0, i))]
        index = RunIndex(strings)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        heads = [text[i - 1][1] + 1 if text[i - 1][0] else 0 for i in order]
        assert np.repeat(index.heads, index.run_lengths).tolist() == heads
        at, span, ahead, prefix = (x.tolist() for x in index.matching_statistics())
        for a, w, b, p in zip(at, span, ahead, prefix):
            for d in range(w):
                i = a + d
                k = order.index(i)
                before = order[k - 1] if k else -1
                same = 0
                while before >= 0 and text[i + same] == text[before + same]:
                    same += 1
                assert max(0, p - d) == same and (not same or b + d == before)


def test_hashes_don_t_depend_on_place():
    words = ["alpha", "Beta", "a", "é" * 9, "x" * 3000]
    alone = texthash.word_hashes([w.encode() for w in words])
    for lead in ("", "some text before "):
        text = lead + " ".join(words)
        buf, off = texthash.flat(pa.array([None, text, ""]))
        split = texthash.words_of(buf.tobytes(), off)
        assert list(map(len, split)) == [0, len(text.split()), 0]
        assert (texthash.word_hashes(split[1])[-len(words) :] == alone).all()
        low = texthash.word_hashes(texthash.words_of(buf.tobytes(), off, lower=True)[1])[-len(words) :]
        assert low[0] == alone[0] and low[1] != alone[1] and low[3] == alone[3]


def thue_morse(n, a="a", b="b"):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def test_words_that_any_polynomial_confuses(spark):
    """Words of 1,024 letters whose polynomial hashes modulo 2**64 are equal for every base are still two words."""
    same = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{same} {thue_morse(2048)}"), (2, f"{same} {thue_morse(2048, 'b', 'a')}"), (3, f"{thue_morse(2048)} b c d"), (4, f"{thue_morse(2048, 'b', 'a')} b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in window_dedup.cut_repeats(df).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0}
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 100).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_large_stars_and_nodes_are_spread(spark, monkeypatch):
    """With a tiny bound on what counts as large, all joins take their spread form and lose nothing."""
    from lumenfolio.llm import components as c

    for module in (c, near_dedup):
        monkeypatch.setattr(module, "LARGE_KEY", 3)
    rnd = random.Random(9)
    rows = []
    for i in range(240):
        w = [f"g{i % 3}w{j}" for j in range(80)]
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(80)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(300 + i, rows[0][1]) for i in range(30)]
    roots = linked({i: shingles(t) for i, t in rows}, 85)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 85).collect()
    assert {r.doc_id: r.component_id for r in got} == roots
