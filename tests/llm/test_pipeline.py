"""Stages of the pipeline against brute force over rows."""

import random
from collections import defaultdict

import corpus_pipeline
from lumenfolio.llm import near_dedup

from test_dedup import linked, shingles

A, B, D, E = (" ".join(f"{x}{i}" for i in range(60)) for x in "abde")
ROW = "doc_id long, text string, n_chars long"


def survivors(rows, percent=80):
    """Of each group of linked rows the one with the smallest id (null ids last); rows without words stay."""
    sets = {i: shingles(t or "") for i, (_, t) in enumerate(rows)}
    roots, groups = linked(sets, percent), defaultdict(list)
    for i, root in roots.items():
        groups[root if sets[i] else ("none", i)].append(i)
    return [[rows[i] for i in g] for g in groups.values()]


def check(spark, rows):
    df = spark.createDataFrame([(k, t, len(t or "")) for k, t in rows], ROW).repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, df, "").collect()]
    groups = survivors(rows)
    assert len(got) == len(groups)
    for group in groups:
        least = min((k is None, k or 0) for k, _ in group)
        stays = [x for x in group if (x[0] is None, x[0] or 0) == least]
        found = [x for x in got if x in group]
        assert found and found[0] in stays
    return sorted(got, key=str)


def test_near_dedup_tells_rows_of_one_id_apart(spark):
    assert check(spark, [(5, A), (7, A), (7, B), (9, D), (9, E)]) == [(5, A), (7, B), (9, D), (9, E)]


def test_near_dedup_of_null_ids_and_repeats(spark):
    rows = [(None, A), (None, A), (3, A + " tail"), (None, B), (None, B), (4, None), (4, None), (None, ""), (6, D), (6, D), (6, D + " end")]
    got = check(spark, rows)
    assert (3, A + " tail") in got and [x for x in got if x[1] == B] == [(None, B)] and got.count((4, None)) == 2
    assert check(spark, []) == []


def test_near_dedup_of_random_rows(spark):
    rnd = random.Random(2)
    rows = []
    for _ in range(120):
        w = rnd.choice([A, B, D, E]).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 30])):
            w[rnd.randrange(60)] = f"x{rnd.randrange(9)}"
        rows.append((rnd.choice([None, *range(20)]), " ".join(w)))
    check(spark, rows)


def test_scratch_tables_are_deleted(spark, docs):
    import os

    from lumenfolio.llm.common import shared_dir

    near_dedup.near_duplicates(docs.limit(50), 85).count()
    place = f"{shared_dir(spark)}/lumenfolio"
    before = len(os.listdir(place))
    near_dedup.near_duplicates(docs.limit(50), 85).count()
    assert len(os.listdir(place)) <= before + 1


def test_suffix_stage_keeps_null_texts_and_columns(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 0), (3, A, 1), (4, A, 1)], ROW)
    from pyspark.sql import functions as F

    df = df.withColumn("row", F.lit("r")).withColumn("kept_text", F.lit("k"))
    got = {r.doc_id: r for r in corpus_pipeline.suffix_dedup_stage(spark, df, "").collect()}
    assert got[1].text is None and got[1].n_chars == 7 and got[2].text == "" and got[3].text == A and got[4].text == "" and got[4].n_chars == 0
    assert {(r.row, r.kept_text) for r in got.values()} == {("r", "k")}


def test_stages_bring_the_package_to_their_workers(spark, docs, sf):
    from lumenfolio.workers import ROOT

    env = spark.sparkContext.environment
    for _, stage in corpus_pipeline.STAGES:
        before = env.pop("PYTHONPATH", None)
        stage(spark, docs.limit(0), sf)
        assert ROOT in env.get("PYTHONPATH", "").split(":")
        env["PYTHONPATH"] = before or ROOT
