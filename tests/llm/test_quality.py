"""Features and updates against plain Python, and held-out accuracy."""

import math
import zlib

import numpy as np
import pyarrow as pa

from plumbline.llm import quality, queries
from plumbline.llm.cluster import text_bytes
from tests.llm.common import AWKWARD, documents, frame


def test_features_don_t_depend_on_neighbours():
    texts = [*AWKWARD, "Word word! 12 ab", "one", "x y"]
    grams, per = quality.features(*text_bytes(pa.array(texts, pa.string())))
    parts = np.split(grams, np.cumsum(per)[:-1])
    for text, part in zip(texts, parts):
        alone, _ = quality.features(*text_bytes(pa.array([text], pa.string())))
        assert alone.tolist() == part.tolist()
    assert per[-3:].tolist() == [15, 3, 6]


def plain_train(rows):
    size = (1 << quality.BITS) + 1
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for grams, label in rows:
            x = {size - 1: 1.0}
            for g in grams:
                x[g] = x.get(g, 0) + quality.SCALE / len(grams)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in range(size) if weight(i)}


def test_updates():
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 50, 30), int(rng.integers(0, 2))) for _ in range(40)]
    got, want = quality.train(rows), plain_train([(g.tolist(), y) for g, y in rows])
    assert set(np.flatnonzero(got)) == set(want)
    assert all(abs(got[i] - w) < 1e-9 for i, w in want.items())


def test_query_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op6_quality(spark, sf).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == documents(spark, sf).count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in rows.items())
    held = [(rows[d].predicted, y) for d, y in truth.items() if rows[d].held_out]
    bad, good = [p for p, y in held if y == 0], [p for p, y in held if y == 1]
    assert len(bad) > 50 and 1 - sum(bad) / len(bad) > 0.93 and sum(good) / len(good) > 0.97


def test_awkward(spark):
    df = frame(spark, AWKWARD)
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, None), (None, 1), (11, 0), (999, 1)], "doc_id long, quality int")
    weights = quality.learn(df, labels)
    rows = {r.doc_id: r.score for r in quality.classify(df, weights).collect()}
    bias = 1 / (1 + math.exp(-weights[-1]))
    assert len(rows) == len(AWKWARD) and all(abs(rows[i] - bias) < 1e-6 for i in range(4))
    assert quality.classify(df.limit(0), weights).count() == 0
    assert not quality.learn(df, labels.limit(0)).any()
