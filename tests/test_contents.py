"""Contents chain: similarity join against all pairs, entries from detected pages, all statuses."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lumenfolio.operators import contents

PAGE = "physical_book string, book_id string, scan_page int, page_type string, printed_page int, basis string, confidence double, text string"


def similarity(x, y):
    a, b = x.replace(" ", ""), y.replace(" ", "")
    if not a or not b:
        return 0.0
    v, w = set(x.split()), set(y.split())
    share = min(len(a), len(b)) / max(len(a), len(b))
    held = 0.9 + 0.1 * share if (a in b or b in a) and min(len(a), len(b)) >= 5 and share >= 0.72 else 0.0
    return round(max(SequenceMatcher(None, a, b).ratio(), 2 * len(v & w) / (len(v) + len(w)), held), 4)


def changed(rnd, text):
    words, n = text.split(), rnd.randrange(6)
    if n == 0:
        rnd.shuffle(words)
    if n == 1 and len(words) > 1:
        words.pop(rnd.randrange(len(words)))
    text = " ".join(words)
    for _ in range(rnd.randrange(4) if n > 1 else 0):
        i = rnd.randrange(len(text) + 1)
        text = text[:i] + rnd.choice(["", "a", "e", "zz", " "]) + text[i + rnd.randrange(2) :]
    return " ".join(text.split())


@pytest.mark.parametrize("least", [0.82, 0.9])
def test_no_pair_is_lost(spark, least):
    rnd = random.Random(int(least * 100))
    vocabulary = ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randint(1, 7))) for _ in range(40)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 5))) for _ in range(120)] + ["a", "ab", "abc", "abcd", "abcde", "", "aaaaaaaa", "the the the"]
    entries = [changed(rnd, rnd.choice(texts)) for _ in range(170)] + ["b", "ba", "acbd", "abcdef", "aaaaaaaaa", "the the"]
    a = spark.createDataFrame([(i, rnd.choice(["title", "body_line"]), i, t) for i, t in enumerate(texts)], "item_id int, basis string, line_index int, text string")
    b = spark.createDataFrame(list(enumerate(entries)), "entry_id int, entry_title string")
    got = {(r.item_id, r.entry_id): r.score for r in contents.best_surfaces(a, b, least).collect()}
    want = {(i, k): s for i, x in enumerate(texts) for k, y in enumerate(entries) if (s := similarity(x, y)) >= least}
    assert got == want and len(want) > 100


def test_entries_and_statuses(spark):
    rows = [
        ("p", "b1", 1, "front_matter", None, "missing", 0.0, "contents\nThe first morning song ... 11\nRivers of the north 12 Night birds sing 13"),
        ("p", "b1", 2, "front_matter", None, "missing", 0.0, "\n".join(f"winter evening number {'xyzwvutsr'[i]}{'abcdefghi'[i]}q ... {20 + i}" for i in range(9)) + "\nsolitary heron ... 399"),
        ("p", "b1", 3, "front_matter", None, "missing", 0.0, "a preface of some length without numbers"), ("p", "b1", 4, "front_matter", None, "missing", 0.0, "\n".join(f"not of these {i} ... {40 + i}" for i in range(9))),
        *[("p", "b1", 10 + i, "normal_poem_page", 10 + i, "offset", 0.9, "x") for i in range(1, 12)], ("p", "b2", 40, "unknown", 12, "missing", 0.1, "x"), ("p", "b2", 41, "normal_poem_page", 13, "offset", 0.2, "x"),
    ]
    entries = contents.contents_entries(spark.createDataFrame(rows, PAGE), "contents", "a-zA-Z")
    held = {r.entry_title: (r.page, r.verified, r.candidate_book, r.candidate_scan) for r in entries.collect()}
    assert held["the first morning song"] == (11, True, "b1", 21 - 10) and held["rivers of the north"] == (12, True, "b1", 12) and held["night birds sing"][1:] == (True, "b1", 13)
    assert sum("winter" in t for t in held) == 9 and not any("not of" in t for t in held) and not held[next(t for t in held if t.endswith("iq"))][1]
    items = [
        (1, "unknown", "the first morning song", "title"), (2, "unknown", "the first mornin song", "title"), (3, "Alpha", "rivers of the north", "title"), (4, "Beta", "rivers of the north", "title"), (5, "unknown", "night birds sing", "body_line"), (6, "Alpha", "night birds sing", "body_line"),
        (7, "unknown", next(t for t in held if t.endswith("iq")), "title"), (8, "unknown", "nothing of the kind", "title"), (9, "Alpha", "the frst mornin song", "title"), (10, "Alpha", "nigt birds sing", "body_line"), (11, "unknown", "solitary heron", "title"),
    ]
    frame = spark.createDataFrame(items, "item_id int, edition string, text string, basis string")
    audit = contents.contents_audit(frame.select("item_id", "edition", F.when(F.col("item_id").isin(3, 4), "rivers of the north").otherwise(F.concat(F.lit("own "), F.col("item_id").cast("string"))).alias("title")), frame.select("item_id", "basis", F.lit(None).cast("int").alias("line_index"), "text"), entries, spark.createDataFrame([("b1", "Alpha"), ("b2", "Beta")], "book_id string, canonical string"), "unknown")
    got = {r.item_id: r.status for r in audit.collect()}  # 7: entries whose page is known come first, whatever they score
    assert got == {1: "strong_toc_review", 2: "manual_toc_review", 3: "duplicate_title_conflict", 5: "weak_toc_line_review", 6: "strong_toc_line_review", 7: "weak_toc_review", 9: "manual_toc_review", 10: "manual_toc_line_review", 11: "needs_page_sequence"}
