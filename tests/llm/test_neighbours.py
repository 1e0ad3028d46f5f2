"""Neighbours against brute force: exact scores, order, and recall."""

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import neighbours, queries


def brute(ids, vectors, query, k=5):
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    at = np.flatnonzero(ids == query)[0]
    cosine = (vectors * vectors[at]).sum(axis=1) / (norms * norms[at])
    cosine[at] = -9
    order = np.lexsort((ids, -cosine))[: min(k, len(ids) - 1)]
    return ids[order].tolist(), cosine[order]


def recall(rows, ids, vectors, asked):
    hits = total = 0
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append(r)
    for q in asked:
        want, scores = brute(ids, vectors, q)
        got = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, len(want) + 1))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got) and len({r.vec_id for r in got}) == len(got)
        by = dict(zip(ids.tolist(), range(len(ids))))
        for r in got:
            a, b = vectors[by[q]], vectors[by[r.vec_id]]
            assert abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        hits += len(set(want) & {r.vec_id for r in got})
        total += len(want)
    return hits / total


def table_of(spark, path):
    rows = spark.read.parquet(path).collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    ids, vectors = table_of(spark, f"{sf}/embeddings.parquet")
    rows = queries.op7_collision_search(spark, sf).collect()
    asked = [i for i in ids.tolist() if i % 50 == 0]
    assert recall(rows, ids, vectors, asked) >= 0.95


def test_blocks_and_chunks(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    ids, vectors = table_of(spark, f"{sf}/embeddings.parquet")
    rows = neighbours.nearest(df, df.vec_id % 10 == 0, block=100, chunk=7).collect()
    assert recall(rows, ids, vectors, [i for i in ids.tolist() if i % 10 == 0]) >= 0.95


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [-1.0, 0.1]), (9, [-1.0, 0.1]), (None, [1.0, 0.0]), (50, [3.0, 0.0]), (10, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, query_id string, rank int")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.nearest(df, df.vec_id % 50 == 0, k=3).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 1.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 1.0)]
    assert len(neighbours.nearest(df, df.vec_id == 0, k=50).collect()) == 4
    assert neighbours.nearest(df.limit(0), df.vec_id % 50 == 0).count() == 0


def test_many_copies(spark):
    rng = np.random.default_rng(2)
    vectors = np.r_[np.tile(rng.standard_normal(16), (400, 1)), rng.standard_normal((200, 16))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, df.vec_id % 50 == 0, block=90).collect()
    assert recall(rows, np.arange(600), vectors, range(0, 600, 50)) >= 0.95


def test_very_small_and_large_components(spark):
    """Squares of these vanish or overflow; they take part all the same, and the search ends."""
    import random

    rnd = random.Random(8)
    data = [(i, [rnd.gauss(0, 1) * 10.0 ** (200 if i % 3 == 0 else -200 if i % 3 == 1 else 0) for _ in range(8)]) for i in range(90)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, block=25, chunk=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    units = {i: np.array(v) / np.abs(v).max() for i, v in data}
    units = {i: v / np.sqrt((v * v).sum()) for i, v in units.items()}
    for q in range(0, 90, 10):
        best = sorted(((-round(float(units[q] @ units[i]), 9), i) for i in units if i != q))[:5]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert len({i for _, i, _ in found} & {i for _, i in best}) >= 3
        assert all(abs(s - float(units[q] @ units[i])) < 1e-8 for _, i, s in found)
