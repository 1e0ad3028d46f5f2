"""Clustering against plain Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from plumbline.llm import centroids, queries

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("row", T.StringType()), T.StructField("place", T.StringType()), T.StructField("cluster", T.StringType())])


def plain(rows, k, rounds, length):
    kept = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    middle = [v for _, v in drawn]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min(range(len(middle)), key=lambda c: (far(v, middle[c]), c)) for _, v in kept]
    for _ in range(rounds):
        held = defaultdict(list)
        for c, (_, v) in zip(assign(), kept):
            held[c].append(v)
        middle = [tuple(sum(x) // len(held[c]) for x in zip(*held[c])) if c in held else middle[c] for c in range(len(middle))]
    inertia, out = defaultdict(int), []
    for c, (_, v) in zip(assign(), kept):
        inertia[c] += far(v, middle[c])
    for c, (i, v) in zip(assign(), kept):
        out.append((i, c, far(v, middle[c]), inertia[c], sum(inertia.values()), list(middle[c])))
    return sorted(map(str, out))


def check(spark, rows, k=5, rounds=3, length=4, **options):
    df = spark.createDataFrame([(i, v, "x", None, "y") for i, v in rows], VECTORS).repartition(3)
    got = centroids.cluster(df, k=k, rounds=rounds, length=length, **options).collect()
    assert sorted(str((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid)) for r in got) == plain(rows, k, rounds, length)


def test_awkward(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    rows += [(i, [0.25, -0.25, 0.5, 0.0]) for i in range(200, 400)] + [(7, [0.25, -0.25, 0.5, 0.0])] * 30  # copies, repeated ids
    rows += [(500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0, None, 0.0, 0.0]), (504, [1.0, float("nan"), 0.0, 0.0]), (505, [1.0, float("inf"), 0.0, 0.0]), (506, [0.0] * 4), (None, [0.1, 0.2, 0.3, 0.4]), (None, [-1.0] * 4)]
    check(spark, rows, block=16)
    check(spark, rows[:3])  # fewer vectors than centroids


def test_large_components_are_exact(spark):
    rnd = random.Random(6)
    check(spark, [(i, [rnd.uniform(-500_000, 500_000) for _ in range(4)]) for i in range(80)], block=8)
    with pytest.raises(Exception, match="would not fit a long"):
        check(spark, [(0, [1e300] * 4)])


def test_empty(spark):
    df = spark.createDataFrame([], VECTORS)
    assert centroids.cluster(df).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, [1.0], "", "", "")], VECTORS)).count() == 0


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2), (2, 1)])
def test_curve_goes_to_neighbours(dims, bits):
    side = 1 << bits
    cells = np.array(np.meshgrid(*[np.arange(side)] * dims)).reshape(dims, -1).T
    order = sorted(range(len(cells)), key=lambda i: centroids.hilbert(cells[i : i + 1], bits)[0].tobytes())
    assert len({centroids.hilbert(cells, bits)[i].tobytes() for i in range(len(cells))}) == len(cells)
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_boxes_leave_out_no_nearest():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        v, c = rnd.integers(-9, 9, (6, 3)), rnd.integers(-9, 9, (7, 3))
        may = centroids.candidates(v.min(axis=0), v.max(axis=0), c)
        assert set(centroids.nearest(v, c)[0]) <= set(may)
        low, high = centroids.bounds(v.min(axis=0), v.max(axis=0), c)
        far = ((v[:, None] - c) ** 2).sum(axis=2)
        assert (low <= far.min(axis=0)).all() and (far.max(axis=0) <= high).all()


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op12_hilbert_centroids(spark, sf).collect()
    want = {eval(x)[0]: eval(x) for x in plain(rows, 40, 5, 64)}
    assert len(got) == len(rows)
    for r in got:
        _, cluster, distance, inertia, whole, middle = want[r.vec_id]
        assert (r.cluster, r.distance, r.cluster_inertia, r.inertia) == (cluster, distance, inertia, whole)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle)).encode()).hexdigest()
