"""Sequence repair and ordered runs against fixtures and Python models."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lumenfolio.operators import matching as M
from lumenfolio.operators import sequence as S

PAGE = "book_id string, scan_page int, page_type string, value int, source string, footer string"


def repaired(spark, rows):
    df = spark.createDataFrame([("b", s, t, v, None, f) for s, t, v, f in rows], PAGE)
    return {r.scan_page: r for r in S.repair(df).collect()}


def pages(n, values, kinds=None, footers=None):
    return [(s, (kinds or {}).get(s, "normal_poem_page"), values.get(s), (footers or {}).get(s)) for s in range(1, n + 1)]


def test_gap_and_trailing(spark):
    got = repaired(spark, pages(6, {1: 11, 4: 14}))
    assert [got[s].printed_page for s in range(1, 7)] == [11, 12, 13, 14, 15, 16]
    assert [got[s].basis for s in range(1, 7)] == ["visible_ocr_candidate", "sequence_inferred", "sequence_inferred", "visible_ocr_candidate", "trailing_sequence_inferred", "trailing_sequence_inferred"]
    assert [got[s].confidence for s in (1, 2, 5)] == [0.8, 0.65, 0.55]


def test_offset_outliers(spark):
    values = {s: 10 + s for s in range(1, 8)} | {8: 98, 9: 99, 10: 100}
    got = repaired(spark, pages(10, values))
    assert [got[s].printed_page for s in (8, 9, 10)] == [18, 19, 20]
    assert got[9].basis == "sequence_offset_inferred" and got[9].confidence == 0.7
    assert "offset_outlier_printed_page_candidate" in got[9].flags


def test_footer_tail(spark):
    got = repaired(spark, pages(4, {1: 173}, footers={2: "* ১৭৪", 3: "১৭৫৬"}))
    assert [got[s].printed_page for s in range(1, 5)] == [173, 174, 175, 176]
    assert [got[s].basis for s in (2, 3, 4)] == ["footer_sequence_inferred", "footer_sequence_inferred", "trailing_sequence_inferred"]


def test_nonmonotonic(spark):
    got = repaired(spark, pages(3, {1: 5, 2: 3, 3: 7}))
    assert [got[s].printed_page for s in (1, 2, 3)] == [None, None, 7]
    assert "nonmonotonic_printed_page_candidate" in got[2].flags


def test_leading_window_without_trusted_page(spark):
    kinds = {1: "blank_or_near_blank", 2: "blank_or_near_blank"}
    got = repaired(spark, pages(4, {3: 11, 4: 12}, kinds))
    assert [got[s].printed_page for s in (1, 2)] == [None, None]
    got = repaired(spark, pages(4, {3: 11, 4: 12}, {1: "blank_or_near_blank"}))
    assert [got[s].printed_page for s in (1, 2)] == [9, 10]


def model(rows):
    """The rules of repair, one page after the other."""
    ok = {"normal_poem_page", "poem_or_text_page", "poem_start_or_short_page"}
    n, num, basis = len(rows), [None] * len(rows), ["missing"] * len(rows)
    cand = [(i, r[2]) for i, r in enumerate(rows) if r[1] in ok and r[2] is not None and 1 <= r[2] <= 500]
    has = {i for i, _ in cand}
    scans = {}
    for i, v in cand:
        scans.setdefault(v - rows[i][0], []).append(rows[i][0])
    good = {o for o, s in scans.items() if len(s) >= 3}
    if len(good) > 1:
        rank = sorted(good, key=lambda o: (-len(scans[o]), min(scans[o]) - max(scans[o]), abs(o), o))
        if len(scans[rank[0]]) >= 2 * len(scans[rank[1]]):
            good = {rank[0]}
    for k, (i, v) in enumerate(cand):
        if good:
            bad = v - rows[i][0] not in good
        else:
            bad = (k > 0 and v <= cand[k - 1][1]) or (k + 1 < len(cand) and v >= cand[k + 1][1])
        basis[i] = "suspect_visible_candidate" if bad else "visible_ocr_candidate"
        num[i] = None if bad else v
    anchors = [(i, num[i]) for i in range(n) if basis[i] == "visible_ocr_candidate"]
    for o in sorted(good):
        for i, v in anchors:
            if v - rows[i][0] == o:
                for step in (-1, 1):
                    j = i + step
                    while 0 <= j < n and rows[j][1] in ok and rows[j][0] + o >= 1:
                        if num[j] is None:
                            num[j], basis[j] = rows[j][0] + o, "sequence_offset_inferred"
                        j += step
    def fill(j, v, b):
        num[j], basis[j] = v, b
    if len(anchors) >= 2:
        for (i, v), (j, w) in zip(anchors, anchors[1:]):
            if j - i > 1 and w - v == j - i:
                for k in range(i + 1, j):
                    if rows[k][1] in ok and num[k] is None:
                        fill(k, v + k - i, "sequence_inferred")
        (i, v), (j, w) = anchors[:2]
        near = [k for k in (i - 1, i - 2) if k >= 0]
        if w - v == j - i and any(rows[k][1] in ok for k in near):
            for k in near:
                if rows[k][1] not in ok | {"blank_or_near_blank"} or num[k] is not None or k in has or v - (i - k) < 1:
                    break
                fill(k, v - (i - k), "leading_sequence_inferred")
        (i, v), (j, w) = anchors[-2:]
        if w - v == j - i:
            for k in range(j + 1, min(n, j + 3)):
                if rows[k][1] not in ok or num[k] is not None or k in has:
                    break
                fill(k, w + k - j, "trailing_sequence_inferred")
    return list(zip(num, basis))


@pytest.mark.parametrize("seed", range(3))
def test_repair_against_model(spark, seed):
    rnd = random.Random(seed)
    kinds = ["normal_poem_page"] * 6 + ["front_matter", "blank_or_near_blank"]
    books, rows = {}, []
    for b in range(40):
        n, shift = rnd.randint(1, 14), rnd.choice([2, 5])
        books[f"b{b}"] = [(s, rnd.choice(kinds), s + shift + rnd.choice([0, 0, 0, 0, 40, -1]) if rnd.random() < 0.5 else None, None) for s in range(1, n + 1)]
        rows += [(f"b{b}", s, t, v, None, f) for s, t, v, f in books[f"b{b}"]]
    rnd.shuffle(rows)
    got = {(r.book_id, r.scan_page): (r.printed_page, r.basis) for r in S.repair(spark.createDataFrame(rows, PAGE).repartition(3)).collect()}
    for b, x in books.items():
        assert [got[b, s] for s, *_ in x] == model(x), (b, x)


def test_runs(spark):
    v = spark.range(1).select(S.longest_integer_run(F.array(*map(F.lit, (1, 2, 2, 3, 7, 8)))).alias("a"), S.longest_true_run(F.array(*map(F.lit, (True, False, True, True)))).alias("b")).first()
    assert (v["a"], v["b"]) == (3, 2)
    g = spark.createDataFrame([("x", 1, s) for s in (3, 4, 5, 6, 7)], "k string, g int, scan_page int")
    assert S.page_windows(g, ["k", "g"], "scan_page", 4).count() == 14


def span_of(best: int, anchors: list[dict], weak: dict[int, dict], trusted: set[int]) -> dict:
    """A model of W15: the span around the best page: nearest anchor, its cluster of gaps of at most 2, a sparse
    refrain before the first title anchor cut off, then continuations both ways, page by page."""
    if not anchors:
        return {"start_scan": best, "end_scan": best, "basis": "best_page_no_line_anchor", "anchor_scans": [], "continuation_scans": [], "line_matches": 0, "exact_matches": 0}
    anchors = sorted(anchors, key=lambda a: a["scan_page"])
    scans = [a["scan_page"] for a in anchors]
    lo = hi = min(range(len(scans)), key=lambda i: (abs(scans[i] - best), scans[i]))
    while lo and scans[lo] - scans[lo - 1] <= 2:
        lo -= 1
    while hi + 1 < len(scans) and scans[hi + 1] - scans[hi] <= 2:
        hi += 1
    cluster = anchors[lo : hi + 1]
    titled = [a["scan_page"] for a in cluster if a["title_match"] and 0 in a["line_indexes"]]
    if titled:
        ahead = [a for a in cluster if a["scan_page"] < min(titled)]
        if ahead and all(a["matches"] <= 3 and not {0, 1} & set(a["line_indexes"]) for a in ahead):
            cluster = [a for a in cluster if a["scan_page"] >= min(titled)]
    seen = [i for a in cluster for i in a["line_indexes"]]
    edge = {-1: min(seen, default=None), 1: max(seen, default=None)}
    ends = {-1: cluster[0]["scan_page"], 1: cluster[-1]["scan_page"]}
    inside, more = {a["scan_page"] for a in cluster}, []
    for way in (-1, 1):
        while (at := ends[way] + way) not in inside and at in trusted and edge[way] is not None:
            found = weak.get(at, {"line_indexes": [], "exact_indexes": []})
            on = [i for i in found["line_indexes"] if (i - edge[way]) * way >= -1]
            if len(on) < 2 and not set(found["exact_indexes"]) & set(on):
                break
            more.append(at)
            ends[way], edge[way] = at, max(on) if way > 0 else min(on)
    return {"start_scan": ends[-1], "end_scan": ends[1], "basis": "line_anchor_cluster", "anchor_scans": [a["scan_page"] for a in cluster], "continuation_scans": sorted(more), "line_matches": sum(a["matches"] for a in cluster), "exact_matches": sum(a["exact"] for a in cluster)}


def test_span_clusters():
    a = lambda s, t=False, li=(5,), m=4: {"scan_page": s, "title_match": t, "line_indexes": list(li), "matches": m, "exact": 1}
    got = span_of(7, [a(5), a(7), a(10)], {}, set())
    assert got["anchor_scans"] == [5, 7]
    got = span_of(8, [a(6, li=(4,), m=2), a(8, True, (0, 1))], {9: {"line_indexes": [1, 2], "exact_indexes": []}}, {9})
    assert got["anchor_scans"] == [8] and got["continuation_scans"] == [9] and got["end_scan"] == 9
    assert span_of(3, [], {}, set())["basis"] == "best_page_no_line_anchor"


def test_spans_by_the_model(spark):
    """Random anchors and weak pages: islands, refrains ahead of a title, continuations both ways, no anchor at all."""
    rnd = random.Random(12)
    best, rows, want = [], [], {}
    for item in range(160):
        at = rnd.randint(1, 30)
        best.append((item, "b", at))
        anchors, weak = [], {}
        for scan in sorted(rnd.sample(range(1, 32), rnd.choice([0, 3, 8, 20]))):
            lines = sorted(rnd.sample(range(12), rnd.choice([1, 1, 2, 4])))
            exact = [i for i in lines if rnd.random() < 0.3]
            row = {"scan_page": scan, "title_match": rnd.random() < 0.3, "matches": len(lines), "exact": len(exact), "line_indexes": lines, "exact_indexes": exact, "is_anchor": rnd.random() < 0.4}
            rows.append((item, 1000 * item + scan, "b", scan, None, *[row[k] for k in ("title_match", "matches", "exact", "line_indexes", "exact_indexes", "is_anchor")]))
            if row["is_anchor"]:
                anchors.append(row)
            else:
                weak[scan] = row
        want[item] = span_of(at, anchors, weak, set(range(40)))
    anchored = spark.createDataFrame(rows, "item_id long, page_id long, book_id string, scan_page int, printed_page int, title_match boolean, matches long, exact long, line_indexes array<int>, exact_indexes array<int>, is_anchor boolean")
    got = {r.item_id: r.asDict() for r in M.spans(spark.createDataFrame(best, "item_id long, book_id string, scan_page int"), anchored).collect()}
    for item, span in want.items():
        assert {k: got[item][k] for k in span} == span and got[item]["anchor_count"] == len(span["anchor_scans"]) and got[item]["best_scan"] == best[item][2]
    assert sum(bool(s["continuation_scans"]) for s in want.values()) > 15 and sum(s["basis"] == "best_page_no_line_anchor" for s in want.values()) > 15



def test_ordered_run_is_greedy():
    e = lambda line, scan, start: (line, scan, "t", start, start)
    assert M.ordered_run([e(1, 1, 1), e(2, 1, 3), e(3, 1, 20), e(3, 2, 0)]) == 3
    assert M.ordered_run([e(1, 1, 1), e(3, 1, 2)]) == 1
    assert M.ordered_run([]) == 0


def test_no_frame_is_summed_anew_for_each_page(spark):
    """A frame that ends with the book and starts behind each page costs the square of a book's pages."""
    df = spark.createDataFrame([("b", s, t, v, None, f) for s, t, v, f in pages(3, {1: 1})], PAGE)
    plan = S.repair(df)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in plan and not re.search(r"rowframe, (?!unboundedpreceding)[^,]+, unboundedfollowing", plan)
