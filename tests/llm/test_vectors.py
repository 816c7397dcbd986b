"""Product codes, the filter audit and the block join against brute force."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenfolio.llm import block_join, filter_audit, product_codes
from lumenfolio.llm.block_join import Quantised, best_of_tile
from lumenfolio.llm.common import Scratch
from lumenfolio.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
NAN, INF = float("nan"), float("inf")


def written(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_vectors(spark, tmp_path_factory):
    """Nulls in any place, non-finite, zero, short, long and huge vectors, repeated rows and ids, ties, clashing columns."""
    rnd = random.Random(2)
    vec = lambda n=8: [rnd.gauss(0, 1) for _ in range(n)]
    same = vec()
    rows = [(None, vec(), 1), (None, same, None), (1, None, 1), (2, [1.0, None] * 4, 1), (3, [NAN] * 8, 2), (4, [INF, 0.0], 2), (5, [0.0] * 8, None), (6, [], 3), (7, [-0.0] * 3, 3)]
    rows += [(8, same, 1), (8, same, 1), (9, same, None), (20, same, None), (20, vec(), 1), (40, vec(5), 2), (60, [x * 1e6 for x in vec()], 2), (80, [1e-40] * 8, 2), (100, vec(11), None)]
    rows += [(i, vec(), i % 3) for i in range(200, 540)]
    folder = str(tmp_path_factory.mktemp("vectors"))
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("key", "code", "part", "vector", "rank", "score")})
    written(df.repartition(5), folder, "embeddings")
    return folder, rows


def usable(rows, zero=True):
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))
    return [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows if good(v)]


def coded(rows):
    """Codes, errors, label errors and the digest by the definition, with Python's integers."""
    rows = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in usable(rows)]
    width = -(-max((len(v) for _, v, _ in rows), default=0) // 4) * 4
    rows = [(i, v + [0] * (width - len(v)), label) for i, v, label in rows]
    cut = lambda v: [v[p * width // 4 : (p + 1) * width // 4] for p in range(4)]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [x for x in r[1]]))[:256]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(4)]
    parts = [cut(v) for _, v, _ in rows]

    def best(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in book]
        return d.index(min(d)), min(d)

    for _ in range(4):
        for p in range(4):
            held = {}
            for x in parts:
                held.setdefault(best(x[p], books[p])[0], []).append(x[p])
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k], strict=True)] if k in held else b for k, b in enumerate(books[p])]
    found = [[best(x[p], books[p]) for p in range(4)] for x in parts]
    errors = [sum(d for _, d in f) for f in found]
    totals = {}
    for (_, _, label), e in zip(rows, errors, strict=True):
        totals[label] = totals.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    return sorted((-1 if r[0] is None else r[0], "".join(f"{k:02x}" for k, _ in f), e, totals[r[2]], digest) for r, f, e in zip(rows, found, errors, strict=True))


def test_product_codes_by_definition(spark, odd_vectors):
    """With vectors of one length first; then mixed lengths, in whose first entries the shorter may sort before."""
    folder, rows = odd_vectors
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in QUERIES["op11_product_codes"](spark, folder).collect())
    assert got == coded(rows)


@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 30), st.integers(1, 12), st.sampled_from([3, 1000, 2**26, 2**40]))
@settings(max_examples=60, deadline=None)
def test_partial_distances_find_the_nearest(seed, n, k, width, size):
    """Few different values make ties; large ones leave 64 bits."""
    rnd = random.Random(seed)
    x, book = ([[rnd.randint(-size, size) for _ in range(width)] for _ in range(m)] for m in (n, k))
    kind = np.int64 if product_codes.fits(size, width) else object
    entry, dist = product_codes.nearest(np.array(x, dtype=kind), np.array(book, dtype=kind))
    for r, e, d in zip(x, entry, dist, strict=True):
        every = [sum((a - b) ** 2 for a, b in zip(r, y, strict=True)) for y in book]
        assert d == min(every) and e == every.index(d)


def near(rows):
    """The 20 nearest of each query by all pairs of distinct rows."""
    rows = sorted({(i, tuple(v)) for i, v, _ in usable(rows, zero=False)}, key=repr)
    out = {}
    for i, v in rows:
        if i is not None and i % 20 == 0:
            for j, w in rows:
                if j != i:
                    s = 0.0
                    for a, b in zip(v, w, strict=False):
                        s += a * b
                    out.setdefault(i, []).append((-s, j is None, j or 0, j))
    return {(i, k, j, -s) for i, found in out.items() for k, (s, _, _, j) in enumerate(sorted(found, key=lambda f: f[:3])[:20], 1)}


def test_block_join_by_all_pairs(spark, odd_vectors):
    folder, rows = odd_vectors
    got = [tuple(r) for r in QUERIES["op13_block_join"](spark, folder).select("query_id", "rank", "vec_id", "score").collect()]
    want = near(rows)
    assert {g[:3] for g in got} == {w[:3] for w in want} and len(got) == len(want)
    assert sorted(g[3] for g in got) == pytest.approx(sorted(w[3] for w in want), rel=1e-12)


def test_tiles_of_any_grid_agree(spark, sf, monkeypatch):
    """Many small blocks on either side give what one gives."""
    t = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    want = sorted(map(tuple, block_join.nearest(t).collect()))
    monkeypatch.setattr(block_join, "QUERY_BYTES", 8 * 256)
    monkeypatch.setattr(block_join, "CANDIDATE_BYTES", 40 * 256)
    monkeypatch.setattr(block_join, "LEAST_ROWS", 16)
    assert sorted(map(tuple, block_join.nearest(t).collect())) == want and len(want) == 500


@given(st.integers(0, 10**6), st.sampled_from([1, 3, 64, 1100]), st.sampled_from([1e-30, 1.0, 1e30]))
@settings(max_examples=25, deadline=None)
def test_bounds_lose_no_neighbour(seed, width, size):
    rnd = np.random.default_rng(seed)
    q, c = rnd.normal(size=(5, width)) * size, rnd.normal(size=(90, width)) * size * 10.0 ** rnd.integers(-3, 3, (90, 1))
    c[40:44] = c[3]
    heaps, computed = best_of_tile(Quantised(q), list(range(5)), Quantised(c), [None, *range(100, 189)], 7)
    for h, row in zip(heaps, q, strict=True):
        scores = block_join.exact_scores(np.repeat(row[None], 90, 0), c)
        want = sorted(((s, -(1 << 63) if j == 0 else -(99 + j)) for j, s in enumerate(scores)), reverse=True)[:7]
        assert sorted(h, reverse=True) == want
    assert computed >= 35


def test_int8_tiles_leave_most_pairs_out(sf):
    """What the bounds let through is a small part of all pairs, and products of codes are exact."""
    import pyarrow.parquet as pq

    x = np.array(pq.read_table(f"{sf}/embeddings.parquet").column("embedding").to_pylist())
    heaps, computed = best_of_tile(Quantised(x[::20]), list(range(0, 500, 20)), Quantised(x), list(range(500)), 20)
    assert all(len(h) == 20 for h in heaps) and computed < 0.2 * 25 * 500
    a, b = Quantised(x[:50]), Quantised(x[50:90])
    assert (block_join.products(a, b) == a.codes.astype(int) @ b.codes.astype(int).T).all()


LABELS = "doc_id long, quality int, toxic int"


def audited(docs, labels):
    """The audit by the definition: every document goes through every order."""
    docs = [(i, t or "", s or "") for i, t, s in docs]
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    ids = {}
    for i, t, _ in docs:
        ids.setdefault(t, []).append(i)
    out, shapley = {}, {}
    for i, t, part in docs:
        w, smaller = [x for x in WORDS.findall(t)], [j for j in ids[t] if j is not None and (i is None or j < i)]
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": bool(smaller)}
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, "".join(order), step), [0] * 6)
                hit = fails[f] and not gone
                row[0] += not gone and not fails[f]
                row[1] += hit
                row[2] += fails[f] and gone
                row[3] += fails[f] and sum(fails.values()) == 1
                row[4] += hit and i in good
                row[5] += hit and i in toxic
                shapley[part, f] = shapley.get((part, f), 0) + hit
                gone = gone or fails[f]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


AUDITED = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("hot", [False, True])
def test_filter_audit_by_definition(spark, odd, sf, tmp_path, monkeypatch, hot):
    """Odd rows and the smallest table; ``hot``: copies of large texts meet a broadcast instead of being dealt."""
    from lumenfolio.llm import components

    if hot:
        monkeypatch.setattr(components, "LARGE_KEY", 1)
    docs = odd.drop("part").unionByName(spark.read.parquet(f"{sf}/documents.parquet"), allowMissingColumns=True).withColumn("part", F.lit("p"))
    labels = spark.createDataFrame([(None, 1, 1), (5, 1, None), (6, None, 1), (8, 1, 1), (8, 0, 0), (1, 1, 0), (10, 0, 1)], LABELS).unionByName(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic"))
    written(docs, tmp_path, "documents")
    written(labels.withColumn("good", F.lit("x")), tmp_path, "labels")
    got = sorted(tuple(r[c] for c in AUDITED) for r in QUERIES["op12_filter_audit"](spark, str(tmp_path)).collect())
    want = audited([(r.doc_id, r.text, r.source) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    assert got == want


def test_empty_tables(spark, empty, tmp_path):
    written(empty, tmp_path, "documents")
    written(spark.createDataFrame([], LABELS), tmp_path, "labels")
    written(spark.createDataFrame([], VECTORS), tmp_path, "embeddings")
    for name, columns in (("op11_product_codes", 5), ("op12_filter_audit", 10), ("op13_block_join", 4)):
        out = QUERIES[name](spark, str(tmp_path))
        assert out.count() == 0 and len(out.columns) == columns


def test_sql_agrees(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("op11_product_codes", "op12_filter_audit", "op13_block_join"):
        got = QUERIES[name](spark, sf)
        columns = sorted(got.columns)
        found = con.execute(ORACLES[name])
        names = [d[0] for d in found.description]
        want = sorted(tuple(r[names.index(c)] for c in columns) for r in found.fetchall())
        assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == want and want


def test_codes_of_a_task_survive_batches(spark):
    """Sums over many small batches and tasks are those of one."""
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    t = Scratch(spark).keep(spark.createDataFrame(rows, "vec_id long, vector array<double>"))
    want = product_codes.books_digest(product_codes.learn(t)[0])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert product_codes.books_digest(product_codes.learn(t.repartition(6))[0]) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_floats_fill_up():
    x = pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float32()))
    assert product_codes.floats(x, 3).tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]
    assert product_codes.whole(np.array([[-0.0001, 1e30]]), 4).tolist() == [[-1, 2**62, 0, 0]]
