"""Matchers against brute force over all pairs, and rules that no driver row fires."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lumenfolio.functions import text as X
from lumenfolio.operators import contents, gates, joins, matching, page_pool, regions, sequence
from lumenfolio.plans import evidence_queries, matching_queries
from lumenfolio.plans.base import folder

BOOK = "page_id long, book_id string, scan_page int, printed_page int, page_type string, text string"


def words_of(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def made(spark, seed=1, n=60):
    """Pages and passages of common words and some rare ones, with titles and lines that only some pages hold."""
    rnd = random.Random(seed)
    common, rare = [f"the{i}" for i in range(12)], [f"rare{i}" for i in range(400)]
    items, pages = [], []
    for i in range(12):
        body = [" ".join(rnd.choices(common, k=4) + rnd.sample(rare, 5)) for _ in range(4)]
        items.append((i, f"title{i} words{i % 3}", "\n".join(body)))
    for p in range(n):
        lines = [" ".join(rnd.choices(common, k=6) + rnd.sample(rare, 3)) for _ in range(5)]
        item = items[rnd.randrange(12)]
        kind = rnd.randrange(6)
        if kind == 0:
            lines.insert(0, item[1])  # a heading alone
        elif kind == 1:
            lines.append("zz " + item[2].split("\n")[0] + " yy")  # the first line alone
        elif kind == 2:
            lines += item[2].split("\n")
        elif kind == 3:
            lines.append(item[2].split("\n")[-1])
        pages.append((p, f"b{p % 4}", p // 4, p if p % 5 else None, "normal_poem_page", "\n".join(lines)))
    frame = spark.createDataFrame(pages, BOOK)
    return items, pages, matching.prepared_passages(spark.createDataFrame(items, "item_id long, title string, text string"), "title", "text"), matching.prepared_pages(frame)


def test_candidate_pairs_lose_none(spark):
    items, pages, passages, prepared = made(spark)
    sets = lambda t: {w for w in words_of(t) if len(w) >= 3}
    for least in (1, 4, 9, 18, 40):
        want = {(i, p[0]): len(sets(b) & sets(p[5])) for i, _, b in items for p in pages if len(sets(b) & sets(p[5])) >= least}
        got = {(r.item_id, r.page_id): r.overlap for r in matching.candidate_pairs(passages, prepared, least).collect()}
        assert got == want


def test_scores_lose_no_heading_or_line(spark):
    """Pairs with next to no common tokens are found by a heading, or by a first or last line."""
    items, pages, passages, prepared = made(spark)
    want = {}
    for i, title, body in items:
        lines = [" ".join(words_of(x)) for x in body.split("\n")]
        tokens = {w for w in words_of(body) if len(w) >= 3}
        for p in pages:
            text, own = " ".join(words_of(p[5])), [" ".join(words_of(x)) for x in p[5].split("\n")]
            head = any(x == title or (x.split()[:2] == title.split() and len(x.split()) <= 4) for x in own)
            score = min(len(tokens & {w for w in text.split() if len(w) >= 3}), 40) * 0.4 + (12 if head else 2 if title in text else 0) + 8 * (lines[0] in text) + 8 * (lines[-1] in text) + (p[3] is not None)
            if score >= 10:
                want[i, p[0]] = round(score, 6)
    got = {(r.item_id, r.page_id): round(r.score, 6) for r in matching.score_pages(passages, prepared).collect()}
    assert got == want and len(got) > 20


def test_scores_make_no_pairs_by_common_words(spark, monkeypatch):
    """Pages aren't shuffled or joined with passages before a pair has its words or lines, and blocks of passages lose none."""
    _, _, passages, prepared = made(spark)
    for met in (matching.candidate_pairs(passages, prepared, 4), matching.score_pages(passages, prepared)):
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    whole = sorted(map(str, matching.score_pages(passages, prepared).collect()))
    monkeypatch.setattr(page_pool, "BLOCK_BYTES", 500)
    assert sorted(map(str, matching.score_pages(passages, prepared).collect())) == whole


def test_holders_of_short_lines(spark):
    pages = spark.createDataFrame([(1, "xx abcdefgh ijk yy"), (2, "abcdefghijk"), (3, "the two word lines"), (4, "abc")], "page_id long, match_text string")
    needles = spark.createDataFrame([(1, "abcdefgh"), (2, "two word"), (3, "abcdefgh ijk yy zz"), (4, "bc")], "item_id long, line string")
    got = {(r.item_id, r.page_id) for r in matching.holders(needles, pages).collect()}
    assert got == {(1, 1), (1, 2), (2, 3), (4, 1), (4, 2), (4, 4)}


def audit_input(spark, seed=3):
    """Twelve passages of four lines; each stands on one page with some letters changed and broken over two lines, among other pages."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghiklmnoprstu") for _ in range(rnd.randint(4, 9)))
    items = [(i, [" ".join(word() for _ in range(8)) for _ in range(4)]) for i in range(12)]
    pages = []
    for p in range(48):
        lines = [" ".join(word() for _ in range(9)) for _ in range(6)]
        if p < 12:
            for line in items[p][1]:
                w = [x if rnd.random() < 0.75 else x[:2] + "z" + x[3:] for x in line.split()]
                lines += [" ".join(w[:4]), " ".join(w[4:])] if rnd.random() < 0.5 else [" ".join(w)]
        pages.append((p, f"b{p % 3}", p // 3, p, "normal_poem_page", "\n".join(lines)))
    lines = spark.createDataFrame([(i, k, t) for i, ls in items for k, t in enumerate(ls)], "item_id long, line_index int, text string")
    whole = spark.createDataFrame([(i, "\n".join(ls)) for i, ls in items], "item_id long, text string")
    return items, pages, lines, whole, spark.createDataFrame(pages, BOOK)


def test_fuzzy_lines_against_all_pairs(spark):
    """The kernel over arrays finds what the definition of M7 finds in all pairs and regions."""
    items, pages, lines, _, frame = audit_input(spark)
    windows = matching.regions_of(frame)
    every = spark.createDataFrame([(i, p[0]) for i, _ in items for p in pages], "item_id long, page_id long")
    bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    score = matching.fuzzy_line_score(bare(F.col("line")), bare(F.col("text")))
    brute = every.join(lines.withColumnRenamed("text", "line"), "item_id").join(windows, "page_id").withColumn("s", F.when(F.contains("text", "line"), 1.0).otherwise(score))
    want = {(r.item_id, r.line_index, r.page_id): r.s for r in brute.where("s >= 0.62").groupBy("item_id", "line_index", "page_id").agg(F.max("s").alias("s")).collect()}
    found = regions.fuzzy_matches(every, regions.gathered_lines(lines), matching.page_regions(frame)).collect()
    got = {(r.item_id, r.line_index, r.page_id): r.score for r in found}
    assert got == pytest.approx(want) and len(want) >= 30 and len(got) == len(found)


def test_ordered_lines_against_all_pairs(spark):
    items, pages, lines, _, frame = audit_input(spark)
    windows = matching.regions_of(frame, 4, 700, 3)
    every = spark.createDataFrame([(i, p[0]) for i, _ in items for p in pages], "item_id long, page_id long")
    brute = every.join(lines.withColumnRenamed("text", "line"), "item_id").join(windows, "page_id").withColumn("s", matching.ordered_token_score(F.col("line"), F.col("text")))
    want = {(r.item_id, r.line_index, r.page_id): r.s for r in brute.where("s >= 0.78").groupBy("item_id", "line_index", "page_id").agg(F.max("s").alias("s")).collect()}
    gathered = regions.gathered_lines(lines)
    got = {(r.item_id, r.line_index, r.page_id): r.score for r in regions.ordered_matches(every, gathered, matching.page_regions(frame, 4, 700, 3)).collect()}
    assert got == pytest.approx(want) and want
    found = matching.audit_candidates(regions.fuzzy_matches(every, gathered, matching.page_regions(frame)), frame, 2)
    best = {r.item_id: r for r in matching.best_candidates(found.withColumn("score", F.col("total_score")), [F.col("line_matches").desc()]).collect()}
    for i in range(12):
        assert best[i].book_id == f"b{i % 3}" and best[i].start <= i // 3 <= best[i].end and best[i].ordered_run >= 2


SIGNS = regions.signature_table()
PAGE = "page_id long, book_id string, text string"


def hot_input(spark, n=520, seed=11):
    """Over 500 pages of a small vocabulary; one passage stands on half of them, others on a few, one nowhere."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeimnoprstu") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=30))) for i in range(9)] + [(9, ""), (10, "zzz qqq www")]
    pages = []
    for p in range(n):
        words = rnd.choices(vocabulary, k=60)
        if p % 2:
            words += items[0][1].split()
        if p % 40 == 3:
            words += items[1 + p // 40 % 8][1].split()[: rnd.randint(5, 30)]
        rnd.shuffle(words) if p % 7 == 0 else None
        pages.append((p, f"b{p % 4}", " ".join(words)))
    side = lambda t: t.withColumns({"plain": F.replace("text", F.lit(" "), F.lit("")), "signed": F.translate(F.replace("text", F.lit(" "), F.lit("")), *signs())})
    return items, pages, side(spark.createDataFrame(items, "item_id long, text string")), side(spark.createDataFrame(pages, PAGE)).repartition(5)


def signs():
    return "".join(map(chr, SIGNS)), "".join(map(chr, SIGNS.values()))


def pooled(items, pages, features, top, least_sum, allowed=None):
    """Every passage against every page."""
    out = set()
    made = {p: (features(t), features(t.translate(SIGNS))) for p, _, t in pages}
    for i, text in items:
        e0, c0 = features(text), features(text.translate(SIGNS))
        rows = []
        for p, book, _ in pages:
            e, c = len(e0 & made[p][0]), len(c0 & made[p][1])
            if e + c >= least_sum and (allowed is None or allowed.get(i) is None or book in allowed[i]):
                rows.append((-max(e, (e + c) / 2), -e, p, c))
        out |= {(i, p, -s, -e, c) for s, e, p, c in sorted(rows)[:top]}
    return out


@pytest.mark.parametrize("block", [1 << 22, 400])
def test_page_pool_against_all_pairs(spark, monkeypatch, block):
    """No page is lost to a common gram, in one block of passages or many, with ties and with allowed books."""
    monkeypatch.setattr(page_pool, "BLOCK_BYTES", block)
    items, pages, a, b = hot_input(spark)
    five = lambda t: set(regions.grams(t.replace(" ", ""), 5))
    got = {tuple(r) for r in page_pool.page_pool(a, b, page_pool.gram_features(5), 16, least_sum=15.0).select("item_id", "page_id", "score", "exact", "by_class").collect()}
    want = pooled(items, pages, five, 16, 15)
    assert got == want and len([x for x in want if x[0] == 0]) == 16 and len(want) > 100
    books = {0: ["b1"], 1: [], 2: None, 3: ["b0", "b3"]}
    limited = a.withColumn("allowed", F.expr("CASE item_id WHEN 0 THEN array('b1') WHEN 1 THEN array() WHEN 3 THEN array('b0', 'b3') END"))
    got = {tuple(r) for r in page_pool.page_pool(limited, b, page_pool.gram_features(5), 4, least_sum=15.0).select("item_id", "page_id", "score", "exact", "by_class").collect()}
    assert got == pooled(items, pages, five, 4, 15, books) and not any(x[0] == 1 for x in got)


def test_pool_of_tokens_and_its_bounds():
    """Shares of a passage's tokens; most pairs never need their common features once thresholds stand."""
    rnd = random.Random(2)
    vocabulary = [f"word{i}" for i in range(40)] + [f"rare{i}" for i in range(3000)]
    weights = [60] * 40 + [1] * 3000
    items = [(i, " ".join(rnd.choices(vocabulary, weights, k=40))) for i in range(30)]
    pages = [(p, "b", " ".join(rnd.choices(vocabulary, weights, k=120) + items[p % 30][1].split()[: 8 * (p % 5)])) for p in range(900)]
    features = page_pool.token_features()
    block = page_pool.Block.of([{"item_id": i, "plain": t, "signed": t.translate(SIGNS), "allowed": None} for i, t in items], features, 3, 0.02, 1.0)
    best = page_pool.Best(block)
    for p, book, t in pages:
        best.add(p, book, features(t), features(t.translate(SIGNS)))
    assert {(i, p, s, e, c) for i, p, s, e, c in best.rows()} == pooled(items, pages, lambda t: {w for w in t.split() if len(w) >= 3}, 3, 1)
    assert best.counted < 0.6 * len(items) * len(pages)
    assert page_pool.Best(page_pool.Block.of([], features, 3, 0.0, 1.0)).rows() == []


def vector_model(lines, windows, most=6, per_line=2, least=0.03, needed=3, gap=4):
    """M8 by dictionaries."""

    def vector(text):
        plain, out = text.replace(" ", ""), Counter()
        for name, t, base in (("exact", plain, 1.0), ("class", plain.translate(SIGNS), 0.5)):
            for n in (3, 5, 8):
                for g in set(regions.grams(t, n)):
                    out[zlib.crc32(f"{name}:{n}:{g}".encode()) % 32768] += base * n / 3
        return out, sum(w * w for w in out.values()) ** 0.5

    asked = lines if len(lines) <= most else [lines[i] for i in sorted({round(k * (len(lines) - 1) / (most - 1)) for k in range(most)})]
    made, hits, placed = [(vector(w[2]), w) for w in windows], [], []
    for index, text in asked:
        v, n = vector(text)
        ranked = []
        for k, ((u, m), (start, end, _)) in enumerate(made):
            cosine = sum(w * u[f] for f, w in v.items()) / (n * m) if n and m else 0.0
            if cosine >= least:
                ranked.append((-cosine, end - start, k))
        if ranked:
            ranked.sort()
            hits.append((index, -ranked[0][0]))
            placed += [(index, 0, "text", *made[k][1][:2]) for _, _, k in ranked[:per_line]]
    if len(hits) < min(needed, len(asked)) or not asked:
        return None
    run, best = 0, 0
    for i in range(max(k for k, _ in hits) + 1):
        run = run + 1 if i in {k for k, _ in hits} else 0
        best = max(best, run)
    needed = min(needed, len(asked))
    return matching.ordered_run(placed, gap), best, len(hits), sum(sorted((s for _, s in hits), reverse=True)[:needed]) / needed


def test_vector_pages_against_a_model(spark):
    """300 pairs of passages and pages: columns, and the best eight of each passage."""
    items, pages, lines, _, frame = audit_input(spark)
    rnd = random.Random(8)
    pairs = sorted({(i, rnd.randrange(48)) for i in range(12) for _ in range(45)} | {(i, i) for i in range(12)})[:320]
    frame = frame.where("page_id < 47").unionByName(spark.createDataFrame([(47, "b2", 15, 47, "normal_poem_page", "12 34")], BOOK))
    windows = {r.page_id: [(w.line_start, w.line_end, w.text) for w in r.regions] for r in matching.page_regions(frame).collect()}
    want = {}
    for i in range(12):
        rows = [(p, vector_model(list(enumerate(items[i][1])), windows[p])) for x, p in pairs if x == i]
        rows = sorted((r for r in rows if r[1]), key=lambda r: ([-v for v in r[1]], r[0]))[:8] or [(p, (None,) * 4) for x, p in pairs if x == i]
        want |= {(i, p): v for p, v in rows}
    got = {(r.item_id, r.page_id): (r.ordered_run, r.line_run, r.line_hits, r.vector_score) for r in regions.vector_pages(spark.createDataFrame(pairs, "item_id long, page_id long"), regions.gathered_lines(lines), matching.page_regions(frame)).collect()}
    assert got.keys() == want.keys() and len(pairs) >= 300
    for k, v in got.items():
        assert v == pytest.approx(want[k])


def test_hashes_of_windows():
    """CRC-32 of many windows at once, letters of one to four bytes, n-grams that don't fit 63 bits."""
    rnd = random.Random(3)
    for letters in ("ab c\u00e9\ud55c\U0001f600xyz", "".join(chr(0x4E00 + i) for i in range(400))):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(12)]
        for n, hashes, owner in regions.hashed_windows(texts, (1, 3, 8, 13), "exact"):
            want = sorted((zlib.crc32(f"exact:{n}:{g}".encode()) % 32768, i) for i, t in enumerate(texts) for g in set(regions.grams(t, n)))
            assert sorted(zip(hashes.tolist(), owner.tolist(), strict=True)) == want


def test_long_pages_go_in_blocks(monkeypatch):
    """Tables of few regions each give what one table gives."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeimnoprstu") for _ in range(5)) for _ in range(80)]
    stretches = [" ".join(rnd.choices(words, k=8)) for _ in range(30)]
    windows = [{"line_start": i, "line_end": j, "text": " ".join(stretches[i : j + 1])} for i in range(30) for j in range(i, min(30, i + 3))]
    told = lambda found: [(x.index, f.region, f.score) for x, f in found]
    results = []
    for block in (512, 7):
        monkeypatch.setattr(regions, "BLOCK_REGIONS", block)
        gram, token = regions.gram_line(3), regions.token_line
        lines = [[f(i, s, SIGNS) for i, s in enumerate(stretches[::3])] for f in (gram, token)]
        page = regions.Page(windows, gram, SIGNS)
        results.append((told(regions.fuzzy_lines(lines[0], page)), told(regions.ordered_lines(lines[1], regions.Page(windows, token, SIGNS))), regions.vector_score(lines[0], page, 6, 2, 0.03, 3, 4)))
    assert results[0][0] == results[1][0] and results[0][1] == results[1][1] and results[0][2] == pytest.approx(results[1][2])


def test_leaves_hold_every_word(spark):
    rows = [(1, "s", "\n".join(f"line {i} of words" for i in range(95))), (2, "s", " ".join(f"w{i}" for i in range(1500))), (3, None, ""), (4, "t", None), (None, "s", "x"), (5, "s", "one")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    pages = matching.leaves(docs)
    got = sorted((r.doc_id, r.part, r.text) for r in pages.collect())
    assert " ".join(t for d, _, t in got if d == 2).split() == [f"w{i}" for i in range(1500)] and [d for d, *_ in got].count(1) == 3
    places = {r.page_id: (r.book_id, r.scan_page) for r in matching.leaf_numbers(pages).collect()}
    assert [places[(d << 20) + k] for d, k, _ in got] == [("s", i + 1) for i in range(len(got))]


def test_runs_of_ordered_lines():
    at = lambda line, scan, start, end: (line, scan, "text", start, end)
    events = [at(0, 1, 0, 0), at(1, 1, 30, 31), at(2, 1, 2, 2), at(2, 2, 0, 0)]
    assert matching.ordered_run(events) == 2 and matching.loose_run(events) == 3 and matching.loose_run([]) == 0


def test_stretches_cut_long_lines(spark):
    text = "\n".join([" ".join(f"w{i}" for i in range(60)), "short line here", "", "12 34"])
    got = spark.createDataFrame([(text,)], "text string").select(matching.stretches(F.col("text")).alias("s")).first().s
    assert [s.line_index for s in got] == list(range(7)) and " ".join(s.text for s in got[:5]).split() == [f"w{i}" for i in range(60)]


def test_every_gate_fires(spark, sf):
    reasons = Counter(r.reason for r in evidence_queries.gate_reasons(spark, sf).collect())
    assert {f"eligible_{g.reason}" for g in (*gates.OVERRIDES, *gates.REVIEWED)} <= set(reasons)
    assert {"missing_printed_page", "unknown_candidate_book", "not_accepted", "eligible"} <= set(reasons)


def test_numbers_of_a_global_order(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(9), i) for i in range(500)]
    t = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = {(r.a, r.b): r.place for r in sequence.numbered(t, ["a", F.col("b").desc()], "place", folder(spark)).collect()}
    assert got == {x: i + 1 for i, x in enumerate(sorted(rows, key=lambda x: (x[0], -x[1])))}
    assert sequence.numbered(t.limit(0), ["a"], "place", folder(spark)).count() == 0


def test_best_surface_loses_none(spark):
    """Keys, length and edit-distance bounds leave every pair that reaches the least score."""
    rnd = random.Random(7)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}rd" for i in range(6) for j in range(5)]
    surface = [(i, "title" if i % 2 else "body_line", None if i % 2 else 1, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 5)))) for i in range(40)]
    entries = []
    for k in range(80):
        t = surface[rnd.randrange(40)][3]
        entries.append((k, rnd.choice([t, t + " more", t[:-1] + "x", t.replace("a", "b", 1), " ".join(rnd.choices(vocabulary, k=3))])))
    s = spark.createDataFrame(surface, "item_id long, basis string, line_index int, text string")
    e = spark.createDataFrame(entries, "entry_id long, entry_title string")
    brute = s.crossJoin(e).withColumn("score", matching.title_similarity(F.col("text"), F.col("entry_title")))
    want = {(r.item_id, r.entry_id): r.score for r in brute.where("score >= 0.82").collect()}
    got = {(r.item_id, r.entry_id): r.score for r in contents.best_surfaces(s, e).collect()}
    assert got == want and len(got) > 20


def test_nearest_by_blocks_of_matrices(spark):
    """Ties go to the smaller id, null vectors come last, and no pair is made as a row."""
    rnd = random.Random(4)
    rows = [(i, [float(rnd.randint(-2, 2)) for _ in range(3)] + [1.0]) for i in range(1500)]
    rows[7] = (7, None)
    t = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    q = t.where("vec_id % 100 = 0 OR vec_id = 7").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("norm").alias("q_norm"))
    found = joins.dense_topk(t, q, 5, 4)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.cosine is None, -round(r.cosine or 0, 9), r.vec_id)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    norm = lambda v: sum(x * x for x in v) ** 0.5
    for i, v in [r for r in rows if r[0] % 100 == 0]:
        near = sorted((-round(sum(a * b for a, b in zip(v, w)) / (norm(v) * norm(w)), 9), j) for j, w in rows if w and j != i)
        assert got[i] == [j for _, j in near[:5]]
    assert got[7] == [0, 1, 2, 3, 4]


def test_normal_text_is_worked_out_once(spark):
    t = spark.createDataFrame([("A b",)], "text string").select(X.words(X.normalize(F.col("text"))).alias("w"))
    assert t._jdf.queryExecution().optimizedPlan().toString().count("lower(") <= 1


def test_top_pages_by_words_make_no_pairs(spark, sf):
    assert "Join" not in matching_queries.overlap_topk(spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_phrase_scan_finds_the_windows_of_needles(spark):
    """pages' windows aren't exploded; what the scan finds is what all windows give."""
    texts = [(1, "The old man 12 sat by a the river in June"), (2, "by the river in june, AND the old man sat by"), (3, None), (4, ""), (5, "old man sat by the river x in 7 june and the old man sat by the river in june")]
    pages = spark.createDataFrame(texts, "page_id long, text string")
    needles = matching.phrase_windows(spark.createDataFrame([(9, "old man sat by the river in june"), (8, "and the old 1 man sat")], "item_id long, text string"), "item_id", "text")
    every = matching.phrase_windows(pages, "page_id", "text").select("page_id", "phrase").distinct()
    want = {tuple(r) for r in every.join(needles.select("phrase").distinct(), "phrase", "left_semi").select("page_id", "phrase").collect()}
    made = matching.phrase_pages(needles, pages, "text")
    got = [tuple(r) for r in made.collect()]
    assert len(want) > 10 and len(got) == len(set(got)) and set(got) == want
    assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_normal_lines_are_lines_normalised(spark):
    """A text is normalised once, not line by line, with the same lines."""
    texts = ["a​b 12 ১২\r\n\r\n  x--y \u0085 Σας ΑΣ\nΣ \x1c\x1d q\t r \x0b", "", None, "\n !! \n", "  İx é ", "one\ntwo   three\x0cfour\r"]
    t = spark.createDataFrame([(x,) for x in texts], "text string")
    old = F.filter(F.transform(X.lines(F.col("text")), lambda x: X.normalize(x)), lambda x: x != "")
    rows = t.select(old.alias("old"), X.normal_lines(F.col("text")).alias("new")).collect()
    assert all(r.old == r.new for r in rows) and rows[0].new == ["ab 12 12", "x y", "σας ας", "σ", "q r"]


@pytest.mark.parametrize("name", ["gestalt_suggestions", "substitution_pick"])
def test_suggestions_count_the_documents_once(spark, sf, name):
    """known tokens are written once; no later step reads the documents again."""
    plan = getattr(matching_queries, name)(spark, sf)._jdf.queryExecution().optimizedPlan()
    files = [str(plan.collectLeaves().apply(i).toString()) for i in range(plan.collectLeaves().size())]
    assert files and not any("doc_id" in f or "text#" in f for f in files)
