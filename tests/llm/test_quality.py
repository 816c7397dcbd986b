"""Licences, quality rules and the quality classifier."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfolio.llm import licenses, quality_gam, quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORDS.findall(text or "")
    n = len(w)
    c = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    covered = {j for i in range(n - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_base_counts(request, spark, which):
    df = request.getfixturevalue(which).select("doc_id", "text")
    got = quality_rules.judge(df, quality_rules.Verdict(None, 0.0)).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [base(r.text) for r in got]
    assert all(r.kept != r.base_failed for r in got)


def test_rules_keep_good_and_drop_junk(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_rules.judge(docs.select("doc_id", "text"), quality_rules.learn(docs, labels)).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    long = [k for k in truth if not got[k].base_failed]
    assert all(got[k].kept for k in long if truth[k]) and not any(got[k].kept for k in long if not truth[k])


def test_llr_against_model(spark):
    good, raw = ["a b c", "a b"], ["a b c", "x x x y", "a b"]
    frame = lambda t: spark.createDataFrame([(x,) for x in t], "text string")
    w = quality_rules.weights(quality_rules.counts(frame(good)), quality_rules.counts(frame(raw)))
    rows = frame(raw).select("text", quality_rules.score(F.col("text"), w).alias("s"), quality_rules.buckets(F.col("text")).alias("b")).collect()
    for r in rows:
        assert abs(r.s - np.mean([w[i] for i in r.b])) < 1e-9
    assert {r.text: r.s for r in rows}["a b"] > {r.text: r.s for r in rows}["x x x y"]
    assert [r.b for r in rows if r.text == "x x x y"][0].count(2 * quality_rules.BUCKETS) == 2


def xx(text, seed=42):
    """Spark's xxhash64 of strings: the hash of one is the next one's seed."""
    import xxhash

    return xxhash.xxh64_intdigest(text.encode(), seed)


def model_buckets(text):
    import regex

    n = quality_rules.BUCKETS
    t = regex.findall(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_ \t\n\x0b\f\r]+", text)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return [signed(xx(x)) % n for x in t] + [2 * n if a == b else n + signed(xx(b, xx(a))) % n for a, b in zip(t, t[1:])]


def test_buckets_against_model(spark, docs):
    extra = spark.createDataFrame([("a_b \u0301e -- [x]^`{|}~ 1,2 ...!!?? @@ \u00a0 é\u2019s \u2028 z",), ("",), (None,)], "text string")
    for r in docs.select("text").union(extra).select("text", quality_rules.buckets(F.col("text")).alias("b")).collect():
        assert r.b == model_buckets(r.text or "")


@pytest.mark.parametrize("k", [1, 2, 3, 5, 7, 8, 13])
def test_repeat_words_of_any_width(spark, k):
    rnd = random.Random(k)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(quality_rules.repeat_words(quality_rules.words_of(F.col("text")), k)).collect()]
    want = []
    for t in texts:
        w = t.split()
        seen = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        want.append(len({j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}) if len(w) > k else 0)
    assert got == want


def test_query_and_learned_verdict_agree(spark, sf, docs):
    """The query scores each document once; learn and judge come to the same verdicts."""
    verdict = quality_rules.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r.doc_id: (r.kept, round(r.llr_score, 9)) for r in quality_rules.judge(docs.select("doc_id", "text"), verdict).collect()}
    got = {r.doc_id: (r.kept, round(r.llr_score, 9)) for r in quality_rules.op7_quality_rules(spark, sf).collect()}
    assert got == want and any(k for k, _ in got.values()) and not all(k for k, _ in got.values())


def test_added_names_give_way(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    taken = docs.select("doc_id", "text").withColumns({c: F.lit("mine") for c in (*quality_rules.ADDED, "score", "row", "__words")})
    r = quality_rules.judge(taken, quality_rules.learn(docs, labels)).first()
    assert all(r[c] == "mine" for c in (*quality_rules.ADDED, "score", "row", "__words")) and r["kept_"] == (not r["base_failed_"])
    r = quality_gam.score(taken, quality_gam.learn(docs, labels)).select("score", "score_", "kept").first()
    assert r["score"] == r["kept"] == "mine" and 0 <= r["score_"] <= 1


def test_rules_without_trust_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    v = quality_rules.learn(docs, none)
    assert v.weights is None
    assert quality_rules.judge(empty.select("doc_id", "text"), v).count() == 0


def test_plan_is_native(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality_rules.judge(docs, quality_rules.learn(docs, labels))
    for df in (judged, quality_rules.op7_quality_rules(spark, sf), licenses.op1_licenses(spark, sf)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_gam_held_out(spark, sf, docs):
    got = {r.doc_id: r for r in quality_gam.op3_quality_gam(spark, sf).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [k for k in truth if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k in got)
    assert np.mean([got[k].predicted == truth[k] for k in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_classifier_stage_drops_bad_among_good(spark, sf, docs):
    """The stage's input has no labelled bad documents but those that may not be learned from."""
    import corpus_pipeline

    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    bad = [k for k, q in truth.items() if q == 0 and zlib.crc32(str(k).encode()) % 3 == 1]
    good = [k for k, q in truth.items() if q == 1]
    assert bad and good
    kept = {r.doc_id for r in corpus_pipeline.classifier_stage(spark, docs.where(F.col("doc_id").isin(bad + good)), sf).collect()}
    assert kept.isdisjoint(bad) and len(kept.intersection(good)) >= 0.95 * len(good)


def test_gam_learns_an_interaction():
    rnd = np.random.default_rng(0)
    x = rnd.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone, paired = quality_gam.fit(x, y, pairs=0), quality_gam.fit(x, y)
    assert np.mean((alone.score(x) > 0.5) == y) < 0.75 and np.mean((paired.score(x) > 0.5) == y) > 0.95
    assert {paired.pairs[0][0], paired.pairs[0][1]} == {0, 1}
    assert (paired.score(x) == quality_gam.fit(x, y).score(x)).all()


def test_gam_without_labels_or_with_one_class(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_gam.learn(odd, none)
    got = quality_gam.score(odd.select("doc_id", "text"), model).collect()
    assert len(got) == 15 and {r.score for r in got} == {0.5}
    one = quality_gam.learn(odd, spark.createDataFrame([(5, 1), (5, 0), (9, 1), (10, None)], "doc_id long, quality int"))
    assert one.score(np.zeros((1, len(quality_gam.FEATURES))))[0] > 0.5
    assert quality_gam.score(empty.select("doc_id", "text"), model).count() == 0


def test_licence_model_and_twin(spark):
    model = licenses.train()
    cases = [t for ts in licenses.TEMPLATES.values() for t in ts] + list(licenses.OTHERS) + ["", "the license", "Licensed under CC BY-NC 4.0. and more words of no meaning at all here"]
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", licenses.scan_paragraph(F.col("t"), model).alias("s")).collect()
    for r in rows:
        p = model.probabilities(licenses.tokens(r.t))
        assert abs(p[1:].max() - r.s.probability) < 1e-9
    found = {r.t: r.s for r in rows}
    for label, ts in licenses.TEMPLATES.items():
        for t in ts:
            assert found[t].family == label and found[t].probability >= model.threshold and found[t].similarity == 1.0, t
    for t in licenses.OTHERS:
        assert found[t].probability < model.threshold or found[t].similarity < licenses.MIN_SIMILARITY, t


def test_anchors_lose_no_paragraph():
    held = set(licenses.anchors())
    for ts in licenses.TEMPLATES.values():
        for t in ts:
            g = licenses.grams(licenses.tokens(t), (3,))
            assert sum(not held & set(x.split()) for x in g) < licenses.MIN_SIMILARITY * len(g)


def test_scan(spark, docs, odd, empty):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for r in docs.collect():
        want = sum(bool(re.search("licensed under|Released under|License", x)) for x in r.text.split("\n"))
        assert got[r.doc_id].n_license_paragraphs == want
    two = spark.createDataFrame([(1, "Released under the MIT License.\nx\nLicensed under CC BY-NC 4.0.")], "doc_id long, text string")
    assert licenses.scan(two).first()["families"] == "cc-by-nc,mit"
    assert [r.n_license_paragraphs for r in licenses.scan(odd).collect()] == [0] * 15 and licenses.scan(empty).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Nyone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
BSD = """Copyright 2020 A. Nyone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
"""
APACHE = """/*
 * Copyright 2020 A. Nyone
 *
 * Licensed under the Apache License,
 * Version 2.0 (the "License"); you may
 * not use this file except in compliance
 * with the License.
 */
"""


def test_scan_finds_wrapped_notices(spark):
    prose = "\n".join(f"Line {i} of the story goes on without an end in sight." for i in range(40))
    cases = [(MIT, "mit", 1), (BSD, "bsd", 1), (APACHE, "apache-2.0", 1), (MIT.replace("\n", "\r\n"), "mit", 1), (MIT + "\n" + BSD, "bsd,mit", 2)]
    cases += [(f"{prose}\n{MIT.split(chr(10) * 2)[2]}\n{prose}", "mit", 1), (f"Licensed under CC BY 4.0.\n{BSD.split(chr(10) * 2)[1]}\n{prose}", "bsd,cc-by", 2)]
    cases += [("This work is licensed under a Creative Commons Attribution-\nShareAlike 4.0 International License.", "cc-by-sa", 1), (prose, "", 0), ("\n" * 50_000 + BSD, "bsd", 1)]
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.families, r.n_license_paragraphs) for r in licenses.scan(rows).collect()}
    assert got == {i: (f, n) for i, (_, f, n) in enumerate(cases)}


def test_scan_finds_tags_and_marked_up_notices(spark):
    """Identifiers, short tags, the ISC grant, and words that underscores or other signs set off; not mere mentions."""
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."
    cases = [
        ("// SPDX-License-Identifier: MIT", "mit"), ("# SPDX-License-Identifier: Apache-2.0\nimport x", "apache-2.0"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0"), ("License: CC-BY-SA-3.0", "cc-by-sa"), ("text before\n\nLicense: MIT\n\nmore", "mit"),
        (isc, "isc"), ("_Released_ _under_ _the_ _MIT_ _License_.", "mit"), ("**Licensed under the BSD 3-Clause License.**", "bsd"),
        ("The license: mit students wrote a long text about it.", ""), ("MIT and ISC are names. A license is a text.", ""), ("\t\t\n \t", ""),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(rows).collect()}
    assert {i: r.families for i, r in got.items()} == {i: f for i, (_, f) in enumerate(cases)}
    assert got[len(cases) - 1].n_paragraphs == 0


def test_gam_scores_are_table_sums():
    """Vectorised bin additions against one row at a time."""
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 4))
    model = quality_gam.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float), rounds=20, pair_rounds=10, pairs=2)
    for row, got in zip(x[:60], model.score(x[:60])):
        bins = [sum(1 for e in edges if e <= v) for edges, v in zip(model.edges, row)]
        logit = model.intercept + sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[a[bins[i]], c[bins[j]]] for i, j, a, c, t in model.pairs)
        assert abs(got - 1 / (1 + np.exp(-logit))) < 1e-12


def test_gam_trees_take_the_best_cuts():
    """The first cut of a tree, and the quadrants of a pair, against every possible one."""
    rnd = np.random.default_rng(4)
    ridge = 4.0
    gain = lambda g, h: g * g / (h + ridge)
    for _ in range(40):
        g, h = rnd.normal(size=9), rnd.uniform(0.1, 2, 9)
        gains = [gain(g[:k].sum(), h[:k].sum()) + gain(g[k:].sum(), h[k:].sum()) for k in range(1, 9)]
        tree = quality_gam._tree(g, h, 2, ridge)
        k = 1 + int(np.argmax(gains))
        if max(gains) > gain(g.sum(), h.sum()) + 1e-9:
            assert np.allclose(tree, [g[:k].sum() / (h[:k].sum() + ridge)] * k + [g[k:].sum() / (h[k:].sum() + ridge)] * (9 - k))
        grid, weight = rnd.normal(size=(4, 5)), rnd.uniform(0.1, 2, (4, 5))
        best = max(sum(gain(grid[a, b].sum(), weight[a, b].sum()) for a in (slice(0, i), slice(i, None)) for b in (slice(0, j), slice(j, None))) for i in range(1, 4) for j in range(1, 5))
        found, values = quality_gam._quadrants(grid, weight, ridge)
        assert abs(found - best) < 1e-9 and len(np.unique(values.round(12))) <= 4


def test_scan_of_single_lines_against_brute_force(spark, docs):
    """Every line of the table, without the prefilter and one at a time: those that are a licence by the model and a template."""
    model = licenses.train()
    templates = {f: [licenses.grams(licenses.tokens(t), (3,)) for t in ts] for f, ts in licenses.TEMPLATES.items()}

    def family(line):
        words = licenses.tokens(line)
        if not words:
            return None
        p = model.probabilities(words)
        best = 1 + int(p[1:].argmax())
        own = set(licenses.grams(words, (3,)))
        share = max(sum(g in own for g in t) / len(t) for t in templates[licenses.LABELS[best]])
        return licenses.LABELS[best] if p[best] >= model.threshold and share >= licenses.MIN_SIMILARITY else None

    lines = sorted({x for r in docs.collect() for x in (r.text or "").split("\n") if len(x) < 400})
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.license for r in licenses.scan(rows).collect()}
    want = {i: family(x) for i, x in enumerate(lines)}
    assert got == want and sum(f is not None for f in want.values()) >= 3


def test_short_and_partial_notices(spark):
    """Common short wordings and single clauses of long licences; words of theirs in other sentences are none."""
    cases = [
        ("Distributed under the terms of the MIT license.", "mit"), ("The MIT License (MIT)", "mit"), ("This file is licensed under the GPL v2.", "gpl-2.0"), ("Distributed under the GNU GPL version 3 or later.", "gpl-3.0"), ("License: GPL-3.0", "gpl-3.0"),
        ("Apache License\n  Version 2.0, January 2004", "apache-2.0"), ("  * Redistributions of source code must retain the above copyright notice,\n    this list of conditions and the following disclaimer.", "bsd"),
        ("This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.", "gpl"),
        ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.', "mit"),
        ("The apache helicopter was seen over the hill.", ""), ("A license from MIT was granted to the company.", ""), ("The terms of the bsd were distributed.", ""), ("The mit license was a topic of the talk.", ""), ("He is licensed to drive under the law, version 2.", ""),
    ]
    rows = spark.createDataFrame([(i, f"Some words before it.\n\n{t}\n\nAnd some behind it.") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in licenses.scan(rows).collect()}
    assert [got[i] for i in range(len(cases))] == [f for _, f in cases]
