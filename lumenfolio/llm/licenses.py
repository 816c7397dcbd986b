"""Licence scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line, or, for a notice that is wrapped, a run of lines between
two that are blank or have no letter or digit. Runs of up to ``MOST_LINES``
lines and whole blocks are looked at; of runs of a family that overlap, the one
that holds most of a template counts (ties: the shortest). ``n_paragraphs``
counts lines. Its word 1-, 2- and 3-grams are sparse features of a
multinomial logistic regression over licence families and an ``unknown``
class. The model is trained here, on templates of each family, altered and
cut, and on paragraphs that only sound like licences. Its temperature and the
least probability for a family are calibrated on examples held out from the
training. A prediction counts only if enough of a template of that family is
found in the paragraph; a template of two words, as ``License: MIT``, is found
only where it is the whole paragraph.

All of it is DataFrame expressions: no Python runs on executors, and scoring
is row-local, without a shuffle. Words that every confirmable paragraph must
hold (worked out from the templates, see ``anchors``) let other paragraphs be
skipped without losing one.

Defined cases: a null or empty text has no paragraphs and no licence; null
doc_ids stay null; repeated rows are scanned once each; texts of any length
are scanned whole; of several licences the most probable one is ``license``
(ties: the first by name), and ``families`` has all; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, table
from .quality_rules import let

#: Usual notices of each family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, without warranties or conditions of any kind, either express or implied.",
        "This project is released under the Apache 2.0 license.",
        "Apache License, Version 2.0, January 2004",
        "Distributed under the terms of the Apache License, Version 2.0.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is released under the MIT License.",
        "Licensed under the MIT license, see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Distributed under the terms of the MIT license.",
        "The MIT License (MIT)",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under GPLv3.",
        "Distributed under the GNU GPL version 3 or later.",
        "This file is licensed under the GPL v3.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License.",
        "Distributed under the GNU GPL version 2.",
        "This file is licensed under the GPL v2.",
    ),
    "gpl": (
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Distributed under the terms of the BSD license.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0.",
    ),
}
#: Paragraphs that sound like licences and are none.
OTHERS = (
    "He renewed his driver's license and fishing license at the office.",
    "Permission to enter the building is granted by the front desk.",
    "The version of the software is 3 and was released under pressure.",
    "She works in the public library and is free on Monday, free of charge.",
    "The general public was not permitted to use the file.",
    "A license fee is required by law in this state.",
    "The apache helicopter was seen over the mountain.",
    "The institute in Massachusetts, MIT, published a study.",
    "Creative work and common sense are needed here.",
    "All rights reserved. Please see the terms of service of this site.",
    "The restaurant is licensed to sell wine until late at night.",
    "Source and binary are words of computing, with or without reason.",
    "This page is under construction, released as version 2.0 soon.",
    "Either express or local trains stop here without conditions.",
    "Terms and conditions of the warranty are in the manual.",
    "Licensed premises, licensed drivers and licensed dealers only.",
)
TEMPLATES["isc"] = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",)
#: Short names of each family, as tags and identifiers have them.
NAMES = {
    "apache-2.0": ("Apache-2.0",), "mit": ("MIT",), "gpl-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), "gpl-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"), "lgpl": ("LGPL-2.1-only", "LGPL-2.1-or-later"),
    "bsd": ("BSD-3-Clause", "BSD-2-Clause"), "mpl-2.0": ("MPL-2.0",), "cc-by": ("CC-BY-4.0",), "cc-by-sa": ("CC-BY-SA-4.0",), "cc-by-nc": ("CC-BY-NC-4.0",), "cc0": ("CC0-1.0",), "isc": ("ISC",),
}
for _family, _names in NAMES.items():
    TEMPLATES[_family] += tuple(f"SPDX-License-Identifier: {x}" for x in _names) + tuple(f"License: {x}" for x in _names)
UNKNOWN = "unknown"
LABELS = (UNKNOWN, *sorted(TEMPLATES))
SLOTS = 1 << 14
#: Training examples that must hold a feature.
MIN_SEEN = 5
#: Share of a template's word 3-grams that must be found.
MIN_SIMILARITY = 0.6
#: Most lines of a run; longer ones count if they are a whole block.
MOST_LINES = 16
TOKEN = r"[\p{L}\p{N}]+(?:\.[0-9]+)*"
_TOKEN = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def grams(words: list[str], sizes: tuple[int, ...] = (1, 2, 3)) -> list[str]:
    """Distinct n-grams of words, in order; a text shorter than 3 words is one 3-gram for ``sizes`` (3,)."""
    out = [" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)]
    return list(dict.fromkeys(out or ([" ".join(words)] if words else [])))


def slot(gram: str) -> int:
    return zlib.crc32(gram.encode()) % SLOTS


def draw(*key: object) -> float:
    """A number in [0, 1) that depends on the key alone."""
    return zlib.crc32(repr(key).encode()) / 2**32


def examples(per_template: int = 16) -> list[tuple[list[str], str]]:
    """Token lists and labels: templates whole, with lost and foreign words, cut, and inside other text."""
    filler = [w for x in OTHERS for w in tokens(x)]
    some = lambda n, *key: [filler[int(draw(*key, i) * len(filler))] for i in range(n)]
    out = []
    for label in LABELS[1:]:
        for a, template in enumerate(TEMPLATES[label]):
            words = tokens(template)
            for b in range(per_template):
                key = (label, a, b)
                loss = 0.12 * (b % 3)
                own = [w for i, w in enumerate(words) if draw(*key, "drop", i) >= loss]
                if b % 4 == 3:
                    own = own[: max(3, int(len(own) * (0.7 + 0.3 * draw(*key, "cut"))))]
                out.append((some(b % 5 * 6, *key, "before") + own + some(b % 7 * 5, *key, "after"), label))
    for a, text in enumerate(OTHERS):
        for b in range(per_template):
            key = (UNKNOWN, a, b)
            words = tokens(text) + some(b % 6 * 5, *key, "more")
            out.append(([w for i, w in enumerate(words) if draw(*key, i) >= 0.1 * (b % 3)], UNKNOWN))
    stray = sorted({w for ts in TEMPLATES.values() for t in ts for w in tokens(t)})
    for b in range(12 * per_template):  # words of templates in no order of theirs
        key = ("stray", b)
        words = [stray[int(draw(*key, i) * len(stray))] for i in range(2 + b % 12)] + some(b % 9 * 3, *key, "more")
        out.append((sorted(words, key=lambda w: draw(*key, w)), UNKNOWN))
    return out


@dataclass
class Model:
    """Slots with weights (row 0 is for all others), weights by row and label, biases, temperature and least probability."""

    rows: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, words: list[str]) -> np.ndarray:
        rows = self.rows[[slot(g) for g in grams(words)]] if words else np.zeros(0, int)
        z = (self.bias + self.weights[rows].sum(0)) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@lru_cache(1)
def train(steps: int = 150, rate: float = 1.0, ridge: float = 1e-3, most_wrong: float = 0.01) -> Model:
    """Fit, then calibrate on every fourth example, which the fit doesn't see."""
    data = examples()
    kept = [x for i, x in enumerate(data) if i % 4]
    held = [x for i, x in enumerate(data) if i % 4 == 0]
    seen = Counter(slot(g) for words, _ in kept for g in grams(words))
    used = sorted(s for s, n in seen.items() if n >= MIN_SEEN)
    rows = np.zeros(SLOTS, int)
    rows[used] = np.arange(1, len(used) + 1)

    def matrix(part: list) -> np.ndarray:
        x = np.zeros((len(part), len(used) + 1), np.float32)
        for i, (words, _) in enumerate(part):
            np.add.at(x[i], rows[[slot(g) for g in grams(words)]], 1)
        x[:, 0] = 0
        return x

    y = np.eye(len(LABELS), dtype=np.float32)[[LABELS.index(label) for _, label in kept]]
    share = 1 / np.maximum(1, y.sum(0))
    weight = (y @ share)[:, None]
    weight /= weight.mean()
    x = matrix(kept)
    w, b = np.zeros((x.shape[1], len(LABELS)), np.float32), np.zeros(len(LABELS), np.float32)
    for _ in range(steps):
        slope = weight * (_softmax(x @ w + b) - y) / len(x)
        w -= rate * (x.T @ slope + ridge * w)
        b -= rate * slope.sum(0)
    w, b = np.round(w.astype(float), 4), np.round(b.astype(float), 4)
    z = matrix(held) @ w + b
    truth = np.array([LABELS.index(label) for _, label in held])
    loss = {t: -np.log(_softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.arange(0.2, 3.01, 0.1).round(2)}
    temperature = float(min(loss, key=lambda t: (loss[t], t)))
    false = np.sort(_softmax(z / temperature)[truth == 0, 1:].max(1))
    threshold = float(max(0.5, round(false[int(np.ceil((1 - most_wrong) * len(false))) - 1], 4)))
    return Model(rows, w, b, temperature, min(threshold, 0.9))


@lru_cache(1)
def anchors() -> tuple[str, ...]:
    """Words one of which is in every paragraph that holds ``MIN_SIMILARITY`` of any template.

    Chosen until, in each template, fewer 3-grams than that are without one.
    """
    chosen: list[str] = []
    every = [grams(tokens(t), (3,)) for ts in TEMPLATES.values() for t in ts]
    common = {"the", "a", "of", "to", "in", "on", "is", "or", "and", "by", "this", "at", "any", "may", "not", "with", "can", "it", "has", "all", "as", "be", "for", "see", "that", "under", "you", "are", "found", "use"}
    while True:
        open_ = [(g, [x for x in g if not set(x.split()) & set(chosen)]) for g in every]
        open_ = [(g, rest) for g, rest in open_ if len(rest) >= MIN_SIMILARITY * len(g)]
        if not open_:
            return tuple(chosen)
        gain: dict[str, int] = {}
        for _, rest in open_:
            for word in {w for x in rest for w in x.split()}:
                if word not in common and len(word) > 1:
                    gain[word] = gain.get(word, 0) + sum(word in x.split() for x in rest)
        if not gain:
            raise ValueError("a template has no word to tell it by")
        chosen.append(min(gain, key=lambda w: (-gain[w], w)))


def _numbers(values: list, kind: str) -> Column:
    """An array literal, folded from one string."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def ngrams(t: Column, n: int) -> Column:
    join = lambda i: F.array_join(F.slice(t, i, n), " ")
    return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), join)).otherwise(F.array().cast("array<string>"))


def trigrams(t: Column) -> Column:
    """Word 3-grams, or all words of a shorter text as one, as ``grams`` makes them of a template."""
    return F.when(F.size(t) >= 3, ngrams(t, 3)).when(F.size(t) > 0, F.array(F.array_join(t, " "))).otherwise(F.array().cast("array<string>"))


def holds(text: Column, least: float) -> Column:
    """Whether a text has so large a share of the 3-grams of any template."""
    templates = [grams(tokens(t), (3,)) for ts in TEMPLATES.values() for t in ts]
    array = lambda x: F.array(*map(F.lit, x))
    known = array(sorted({g for x in templates for g in x}))
    share = lambda x, g: F.size(F.array_intersect(x, g)) / F.size(x)
    some = lambda g: F.exists(F.array(*map(array, templates)), lambda x: share(x, g) >= least)
    return let(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0), lambda t: let(F.array_intersect(known, trigrams(t)), lambda g: (F.size(g) > 0) & some(g)))


def runs(lines: Column, block: Column, pattern: str) -> Column:
    """struct(block, first, last, text) of the lines of a block that have an anchor, and of the runs of lines that may hold a notice.

    A block without ``MIN_SIMILARITY`` of a template has no such run. A line with
    all of a template is a notice by itself and no part of a run.
    """
    made = lambda first, last, text: F.struct(block.alias("block"), first.cast("int").alias("first"), last.cast("int").alias("last"), text.alias("text"))
    single = F.filter(F.transform(lines, lambda x, i: made(i, i, x)), lambda c: c["text"].rlike(pattern))
    joined = lambda part: F.when(~F.exists(part, lambda x: x.isNull()), F.array_join(part, "\n"))
    none = F.array().cast("array<struct<block:int,first:int,last:int,text:string>>")

    def several(part: Column) -> Column:
        n = F.size(part)
        some = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(F.sequence(F.lit(2), F.least(F.lit(MOST_LINES), n - i)), lambda k: made(i, i + k - 1, joined(F.slice(part, i + 1, k)))))
        whole = F.when(n > MOST_LINES, F.array(made(F.lit(0), n - 1, joined(part)))).otherwise(none)
        return F.filter(F.concat(F.flatten(some), whole), lambda c: c["text"].rlike(pattern) & holds(c["text"], MIN_SIMILARITY))

    part = F.transform(lines, lambda x: F.when(~(x.rlike(pattern) & holds(x, 1.0)), x))
    wrapped = let(part, lambda p: F.when(holds(F.array_join(p, "\n"), MIN_SIMILARITY), several(p)).otherwise(none))
    return F.concat(single, F.when((F.size(lines) > 1) & F.exists(lines, lambda x: x.rlike(pattern)), wrapped).otherwise(none))


def distinct_runs(found: Column) -> Column:
    """Of a family's runs that overlap the best, and none that lies within a better one of another family."""
    worth = lambda x: F.struct(-x["similarity"], x["last"] - x["first"], x["first"])
    meets = lambda x, y: (x["block"] == y["block"]) & (x["first"] <= y["last"]) & (y["first"] <= x["last"])
    within = lambda x, y: (x["block"] == y["block"]) & (y["first"] <= x["first"]) & (x["last"] <= y["last"])
    best = lambda f: F.filter(f, lambda x: ~F.exists(f, lambda y: (x["family"] == y["family"]) & meets(x, y) & (worth(y) < worth(x))))
    free = lambda f: F.filter(f, lambda x: ~F.exists(f, lambda y: (x["family"] != y["family"]) & within(x, y) & (y["similarity"] > x["similarity"])))
    return let(let(found, best), free)


def scan_paragraph(paragraph: Column, model: Model) -> Column:
    """struct(family, probability, similarity) of one paragraph."""
    k = len(LABELS)
    rows, flat = _numbers(model.rows.tolist(), "int"), _numbers(model.weights.ravel().tolist(), "double")
    templates = [(label, grams(tokens(t), (3,))) for label in LABELS[1:] for t in TEMPLATES[label]]

    def of_tokens(t: Column) -> Column:
        every = F.array_distinct(F.concat(*(ngrams(t, n) for n in (1, 2, 3))))
        add = lambda acc, g: F.zip_with(acc, F.slice(flat, F.get(rows, (F.crc32(g) % SLOTS).cast("int")) * k + 1, k), lambda a, b: a + b)
        logits = F.aggregate(every, F.array(*[F.lit(float(x)) for x in model.bias]), add)
        return let(F.transform(logits, lambda z: z / model.temperature), lambda z: of_logits(t, z))

    def of_logits(t: Column, z: Column) -> Column:
        top = F.array_max(F.slice(z, 2, k - 1))
        total = F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max(z)))
        family = F.element_at(F.array(*map(F.lit, LABELS[1:])), F.array_position(F.slice(z, 2, k - 1), top).cast("int"))
        made = F.struct(family.alias("family"), (F.exp(top - F.array_max(z)) / total).alias("probability"))
        return let(made, lambda m: let(F.array_distinct(trigrams(t)), lambda g: F.struct(m["family"].alias("family"), m["probability"].alias("probability"), similarity(m["family"], g, t).alias("similarity"))))

    def similarity(family: Column, g: Column, t: Column) -> Column:
        out = F.lit(0.0)
        for label in LABELS[1:]:
            shares = [F.size(F.array_intersect(g, F.array(*map(F.lit, x)))) / len(x) for name, x in templates if name == label]
            out = F.when(family == label, F.greatest(*shares) if len(shares) > 1 else shares[0]).otherwise(out)
        return out

    return let(F.regexp_extract_all(F.lower(paragraph), F.lit(TOKEN), 0), of_tokens)


RESULT = ("doc_id", "n_paragraphs", "n_license_paragraphs", "license", "confidence", "similarity", "families")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: paragraphs, licence paragraphs, and the licences found."""
    model = model or train()
    text = F.coalesce(F.col("text"), F.lit(""))
    pattern = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, sorted(anchors()))) + r")(?![\p{L}\p{N}])"  # as TOKEN cuts words
    filled = lambda x: x.rlike(f"[^{SPACE_CLASS}]")
    lines = F.filter(F.split(text, "\n"), filled)
    blocks = F.transform(F.split(text, r"\n[^\p{L}\p{N}]*\n"), lambda x: F.filter(F.split(x, "\n"), filled))
    likely = F.flatten(F.transform(blocks, lambda x, i: runs(x, i, pattern)))
    scanned = F.transform(likely, lambda c: let(scan_paragraph(c["text"], model), lambda s: F.struct(*[s[n].alias(n) for n in ("family", "probability", "similarity")], *[c[n].alias(n) for n in ("block", "first", "last")])))
    found = distinct_runs(F.filter(scanned, lambda s: (s["probability"] >= model.threshold) & (s["similarity"] >= MIN_SIMILARITY)))
    none = F.array().cast("array<struct<family:string,probability:double,similarity:double,block:int,first:int,last:int>>")
    rows = docs.select("doc_id", F.size(lines).cast("long").alias("n_paragraphs"), F.when(text.rlike(pattern), found).otherwise(none).alias("found"))
    best = F.array_max(F.transform("found", lambda s: F.struct(s["probability"].alias("p"), s["similarity"].alias("s"), s["family"].alias("f"))))
    rows = rows.withColumn("best", best)
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda s: s["family"]))), ",")
    return rows.select("doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_license_paragraphs"), F.col("best.f").alias("license"), F.col("best.p").alias("confidence"), F.col("best.s").alias("similarity"), families.alias("families"))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan all documents for licences."""
    return scan(table(spark, sf_dir, "documents"))
