"""Evidence, gates, joins, lexicon, audits, sources, sinks and streaming on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lumenfolio.operators import audits, evidence, gates, joins, lexicon, matching, pages, reports, views
from lumenfolio.sources import readers, writers

LEDGER = "id int, edition string, edition_book string, candidate_book string, printed_page_start int, printed_page_end int, status string, evidence array<string>, span_basis string, exact_count int, line_count int, runner_up_gap double, scan_status string, excluded boolean"


def test_factor_fixtures(spark):
    rows = [
        (1, "B1", "b1", "b1", 3, 4, "accepted_candidate", ["page_sequence_present", "title_match", "high_body_coverage"], "line_anchor_cluster", 3, 5, 5.0, "source_scan_supported", False),
        (2, "unknown", None, None, None, None, None, [], None, 0, 0, None, None, False),
    ]
    t = evidence.ledger(spark.createDataFrame(rows, LEDGER), "unknown")
    t = t.withColumn("blockers", evidence.blockers()).withColumn("action", evidence.next_action())
    one, two = sorted(t.collect(), key=lambda r: r.id)
    assert round(one.log_odds, 2) == 10.65 and round(one.posterior, 4) == 1.0
    assert round(two.log_odds, 2) == -6.4 and round(two.posterior, 4) == 0.0017 and two.action == "needs_better_text_extraction"
    last = max(evidence.stage_updates(t, "id").where("id = 1").collect(), key=lambda r: evidence.STAGES.index(r.stage))
    assert round(last.log_odds_after, 6) == round(one.log_odds, 6)


def test_span_status(spark):
    ev = F.array(F.lit("title_match"), F.lit("first_line_match"))
    s = lambda gap: matching.span_status(F.lit(30.0), ev, F.lit(2), F.lit(5), F.lit(3), F.lit(True), F.lit(gap).cast("double"))
    r = spark.range(1).select(s(3.9).alias("a"), s(4.0).alias("b"), s(None).alias("c")).first()
    assert (r.a, r.b, r.c) == ("ambiguous", "accepted_candidate", "accepted_candidate")


GATE = "id int, edition string, book_title string, candidate_book_id string, printed_page_start int, printed_page_end int, status string, evidence array<string>, span_basis string, score double, span_line_match_count int, span_exact_line_match_count int, span_anchor_count int, runner_up_gap double, is_alias boolean, has_marker boolean, has_reference boolean, outside_corpus boolean, pages_exist boolean, has_existing_source boolean"


def test_gates_and_plan(spark):
    base = ["B1", "B1", "b1", 3, 4, "needs_manual_review", ["page_sequence_present", "title_match"], "line_anchor_cluster", 18.0, 4, 1, 2, None, False, False, False, False, True, False]
    def row(i, **changes):
        names = [c.split()[0] for c in GATE.split(", ")][1:]
        return (i, *[changes.get(n, v) for n, v in zip(names, base, strict=True)])
    rows = [row(1), row(2, runner_up_gap=3.0), row(3, printed_page_end=None), row(4, edition="unknown", status="ambiguous", evidence=["body_token_overlap", "title_match"], score=19.0, span_line_match_count=7, span_exact_line_match_count=2), row(5, edition="unknown", status="ambiguous", evidence=["body_token_overlap", "title_match"], score=19.0, span_line_match_count=7, span_exact_line_match_count=2, runner_up_gap=2.0), row(6, status="accepted_candidate"), row(7, status="accepted_candidate", edition="B2"), row(8, pages_exist=False)]
    t = gates.dispatch(spark.createDataFrame(rows, GATE), "unknown", "b1")
    assert {r.id: r.reason for r in t.collect()} == {1: "eligible_known_review", 2: "not_accepted", 3: "missing_printed_page", 4: "not_accepted", 5: "eligible_unknown_ambiguous_line", 6: "eligible", 7: "known_collection_conflict", 8: "candidate_pages_not_in_corpus"}
    old = F.array(F.struct(F.lit("primary").alias("role"), F.lit("B1").alias("title_bn"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end")))
    t = t.withColumns({"book_year": F.lit(1950), "book_phase": F.lit("p"), "source_year": F.lit(None).cast("int"), "phase_id": F.lit(None).cast("string"), "book_sources": old})
    once = gates.apply_plan(t, "unknown")
    got = {r.id: r for r in once.collect()}
    assert [(s.title_bn, s.page_start, s.page_end) for s in got[1].book_sources] == [("B1", 3, 4)] and got[1].source_year is None
    assert got[5].edition == "B1" and got[5].source_year == 1950
    again = {r.id: (r.edition, r.book_sources) for r in gates.apply_plan(once, "unknown").collect()}
    assert again == {i: (r.edition, r.book_sources) for i, r in got.items()}


def test_exclusions(spark):
    rows = spark.createDataFrame([("f", "b", None, None), ("f", "b", 1, 2)], "filename string, candidate_book_id string, printed_page_start int, printed_page_end int")
    rules = spark.createDataFrame([("f", "b", None, None)], "filename string, candidate_book_id string, page_start int, page_end int")
    assert joins.excluded(rows, rules, "wildcard").count() == 0
    assert [r.printed_page_start for r in joins.excluded(rows, rules, "strict").collect()] == [1]
    assert joins.excluded(rows, rules, "single").count() == 2


def test_checked_join_and_allowed(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="thing is missing: 2"):
        joins.checked_join(a, b, "k", "thing").collect()
    t = spark.createDataFrame([("unknown", None), ("A", ["a"]), ("Z", None)], "e string, m array<string>")
    got = [r.v for r in t.select(joins.is_allowed(joins.allowed_books(F.col("e"), F.col("m"), "unknown"), F.lit("a")).alias("v")).collect()]
    assert got == [True, True, False]


def test_suggestions_and_substitutions(spark):
    known = spark.createDataFrame([("colour", 30, "colour", "clr"), ("color", 100, "color", "clr"), ("colours", 50, "colours", "clrs"), ("zebra", 9, "zebra", "zbr")], "token string, count long, key string, loose string")
    odd = spark.createDataFrame([("c0lour", 9, "colour", "clr")], "token string, count long, key string, loose string")
    got = lexicon.suggestions(odd, known).orderBy("rank").collect()
    assert [(r.token, r.score, r.basis) for r in got] == [("colour", 1.0, "ocr_equivalence"), ("color", 0.94, "loose_vowel_key")]  # colours has a ratio of 0.769
    pick = lexicon.substitutions(odd, lexicon.suggestions(odd, known)).collect()
    assert [(r.odd_token, r.replacement) for r in pick] == [("c0lour", "colour")]
    assert lexicon.substitutions(odd, lexicon.suggestions(odd, known), least_known=31).count() == 0


def test_logical_sections_first_rule_wins(spark):
    p = spark.createDataFrame([("x", s) for s in (4, 5, 9, 30)], "physical_book_id string, scan_page int")
    r = spark.createDataFrame([(2, "x", 5, 20, "second"), (1, "x", 5, 6, "first")], "rule_order int, physical_book_id string, start_scan int, end_scan int, book_id string")
    assert {x.scan_page: x.book_id for x in pages.logical_sections(p, r).collect()} == {4: "x", 5: "first", 9: "second", 30: "x"}


def test_views_and_reports(spark):
    kind = "array<struct<role:string,page_basis:string,page_start:int,page_end:int,publication_year:int>>"
    t = spark.createDataFrame([(1, [("primary", "printed_page", 1, 2, 1950)]), (2, [("primary", "scan_page", 1, 2, None)]), (3, None)], f"id int, s {kind}")
    assert sorted(r.id for r in views.gap_rows(t, "s").collect()) == [2, 3]
    md = reports.markdown(spark.createDataFrame([("a|b", 1)], "x string, y int"), "T")
    assert md.splitlines() == ["# T", "", "| x | y |", "| --- | --- |", "| a\\|b | 1 |"]
    assert reports.duplicates(spark.createDataFrame([(1,), (1,), (2,)], "k int"), "k").count() == 1
    with pytest.raises(TypeError, match="k: int instead of string"):
        reports.schema_errors(spark.createDataFrame([(1,)], "k int"), "k", {"k": "string"}, {})
    order = views.listing(spark.createDataFrame([(None, "খ"), (2, "ক"), (None, "ক"), (1, "গ")], "o int, t string"), "o", "t").collect()
    assert [(r.o, r.t) for r in order] == [(1, "গ"), (2, "ক"), (None, "ক"), (None, "খ")]


def test_citation_line_over_page_break(spark):
    c = spark.createDataFrame([(1, "b", 1, 2, "no such", "alpha beta gamma delta epsilon"), (2, "b", 9, 9, "x", "y"), (3, "q", 1, 1, "x", "y")], "citation_id int, book string, page_start int, page_end int, title string, body string")
    p = spark.createDataFrame([("b", "b", 1, 1, "alpha beta"), ("b", "b", 2, 2, "gamma delta epsilon")], "book_id string, canonical_book string, printed_page int, scan_page int, text string")
    t = audits.citation_evidence(c, p).withColumn("status", audits.citation_status(F.lit(False)))
    assert {r.citation_id: (r.status, r.line_matches) for r in t.collect()} == {1: ("supported", 1), 2: ("outside_corpus_range", 0), 3: ("missing_book_corpus", 0)}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n')
    assert sorted(r.x for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), "x int").collect()) == [1, 2]
    (tmp_path / "bad.jsonl").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl"), "x int").collect()
    (tmp_path / "p").mkdir()
    for n in ("b", "a"):
        (tmp_path / "p" / f"{n}.json").write_text(json.dumps({"id": n}))
    assert [r.filename for r in readers.record_directory(spark, str(tmp_path / "p"), "id string", 1).collect()] == ["a.json"]
    (tmp_path / "t.txt").write_text("one\x0ctwo")
    assert [(r.scan_page, r.text) for r in readers.form_feed_pages(spark, str(tmp_path / "t.txt")).orderBy("scan_page").collect()] == [(1, "one"), (2, "two")]
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    (tmp_path / "w.tsv").write_text(head + "5\t1\t1\t1\t1\t2\t30\t10\t10\t5\t90\tb\n5\t1\t1\t1\t1\t1\t10\t11\t10\t5\t-1\ta\n5\t1\t1\t1\t1\t3\t1\t1\t0\t5\t90\tgone\n")
    line = readers.word_lines(readers.word_boxes(spark, str(tmp_path / "w.tsv"))).first()
    assert (line.text, line.left, line.right, line.avg_conf) == ("a b", 10, 40, 90.0)
    (tmp_path / "s.json").write_text('{"substitutions": {"a": "b", "c": "c", "d": ""}}')
    assert readers.substitution_map(spark, str(tmp_path / "s.json")) == {"a": "b"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    writers.corpus(df, str(tmp_path / "c"))
    writers.corpus(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4
    writers.corpus(df, str(tmp_path / "c"), force=True)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    new = writers.upsert(df, spark.createDataFrame([(2, "z")], "k int, v string"), "k", str(tmp_path / "n"))
    assert sorted(new.collect()) == [(1, "a"), (2, "z")] and not (tmp_path / "n").exists()
    writers.replace_partition(df, str(tmp_path / "d"), "k")
    writers.replace_partition(spark.createDataFrame([(2, "y")], "k int, v string"), str(tmp_path / "d"), "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [(1, "a"), (2, "y")]
    writers.json_lines(spark.createDataFrame([(1, None)], "b int, a string"), str(tmp_path / "j"))
    assert "".join(f.read_text() for f in (tmp_path / "j").glob("*.json")) == '{"a":null,"b":1}\n'


def test_streaming_counts_match_batch(spark, tmp_path, sf):
    from lumenfolio.streaming import ingest

    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", "event_type")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.windowed_counts(ingest.page_stream(spark, str(tmp_path / "in"), "ts timestamp, event_type string"), "ts", "event_type")
    q = stream.writeStream.outputMode("update").format("memory").queryName("hourly").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.start, r.event_type): r.n for r in spark.table("hourly").collect()}
    assert got == {(r.start, r.event_type): r.n for r in ingest.windowed_counts(events, "ts", "event_type").collect()}


def test_shuffled_input_same_output(spark, sf):
    from lumenfolio.plans.matching_queries import corpus

    passages, docs = corpus(spark, sf)
    f = lambda p: sorted(map(str, matching.propose(passages, p).select("item_id", "book_id", "start_scan", "end_scan", "status", "score").collect()))
    assert f(docs) == f(docs.repartition(7).orderBy(F.rand(1)))


def test_guard_raises(spark):
    from lumenfolio.operators import imports

    rows = spark.createDataFrame([("a",), ("b",)], "o string")
    assert imports.guarded(rows, "o", ["a", "b"], []).count() == 2
    with pytest.raises(Exception, match="not allowed: b"):
        imports.guarded(rows, "o", ["a"], []).collect()
    with pytest.raises(Exception, match="excluded: a"):
        imports.guarded(rows, "o", ["a", "b"], ["a"]).collect()


def test_similar_pairs_lose_none(spark):
    """Bigrams and deletions against all pairs of tokens, of lengths from one letter up."""
    from difflib import SequenceMatcher

    rnd = random.Random(9)
    known = {"".join(rnd.choice("abeinorst") for _ in range(rnd.randint(1, 11))) for _ in range(700)}

    def misread(t):
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(t) + 1)
            t = t[:i] + rnd.choice(["", "a", "o", "x"]) + t[i + rnd.randrange(2) :]
        return t or "a"

    odd = {misread(t) for t in rnd.sample(sorted(known), 250)} | {"a", "ab", "aba"}
    want = {(a, b): SequenceMatcher(None, a, b).ratio() for a in odd for b in known if a[0] == b[0] and abs(len(a) - len(b)) <= 2}
    pairs = lexicon.similar_pairs(spark.createDataFrame([(t,) for t in sorted(odd)], "odd_token string"), spark.createDataFrame([(t,) for t in sorted(known)], "token string"))
    got = {(r.odd_token, r.token) for r in pairs.collect()}
    sure = {k for k, v in want.items() if v >= 0.78}
    assert sure <= got <= set(want) and len(sure) > 150
