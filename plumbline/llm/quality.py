"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A word is a run of letters (any byte from 0x80 counts as one), of digits, or of other signs. The features are
words, pairs of words, and triples of word shapes (kind, case, length, and which of the three are equal), each
hashed to one of 2**``BITS`` weights. A text's features count by their share of the text, so a score is a sparse
dot product: the mean weight of the features times ``SCALE``, plus a bias, through the logistic function.

Learning takes at most ``SAMPLE_ROWS`` labelled rows, chosen by a hash of their id. They are dealt to
``SHARDS`` tasks, each of which goes over its rows ``EPOCHS`` times in a fixed order; the mean of their
weights is the model, a fixed number of bytes whatever the corpus. Every text is scored whole. Nothing but the
text enters a score. A null or empty text has no features: its score is the bias alone. Without labelled rows
all scores are 0.5. Several labels of one id count as the largest; rows without id or label teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, text_bytes

SAMPLE_ROWS, SHARDS, EPOCHS = 8_192, 4, 4
BITS, SCALE = 18, 24.0
#: Of the update: learning rate, its offset, and the weights of the absolute and squared penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.2

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
# Kinds of bytes: 0 blank, 1 letter, 2 digit, 3 other.
_KIND = np.full(256, 3, np.uint8)
_KIND[:33] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 1
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _ODD), ("down", _INVERSE)):
                _powers[name] = np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])
    return _powers["up"], _powers["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def features(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, text by text, and how many each text has."""
    signs = np.frombuffer(data, np.uint8)
    n, texts = len(signs), len(ends) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(texts, np.int64)
    kind = _KIND[signs]
    head = np.ones(n, bool)
    head[1:] = kind[1:] != kind[:-1]
    head[ends[:-1][ends[:-1] < n]] = True
    at = np.flatnonzero(head)
    stop = np.r_[at[1:], n]
    word = kind[at] > 0
    at, stop = at[word], stop[word]
    per = np.diff(np.searchsorted(at, ends))
    up, down = _power(n)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((signs.astype(np.uint64) + np.uint64(1)) * up[:n])]
        words = _mix((sums[stop] - sums[at]) * down[at] + (stop - at).astype(np.uint64))
        capitals = np.r_[0, np.cumsum(_UPPER[signs])]
        capital, length = capitals[stop] - capitals[at], stop - at
        case = np.where(capital == 0, 0, np.where(capital == length, 1, np.where((capital == 1) & (_UPPER[signs[at]] == 1), 2, 3)))
        # A run of other signs keeps its first byte in its shape.
        shape = kind[at].astype(np.uint64) * np.uint64(4096) + np.where(kind[at] == 3, signs[at], case).astype(np.uint64) * np.uint64(8) + np.minimum(length, 4).astype(np.uint64)
        count = len(at)
        owner = np.repeat(np.arange(texts), per)
        second, third = np.minimum(np.arange(count) + 1, max(count - 1, 0)), np.minimum(np.arange(count) + 2, max(count - 1, 0))
        # Behind a text's end stands a word of its own.
        none = np.uint64(7)
        in_two, in_three = owner[second] == owner, owner[third] == owner
        if count:
            in_two[-1] = in_three[-1] = False
            in_three[-2:] = False
        w2, w3 = np.where(in_two, words[second], none), np.where(in_three, words[third], none)
        s2, s3 = np.where(in_two, shape[second], none), np.where(in_three, shape[third], none)
        same = (words == w2).astype(np.uint64) + (words == w3).astype(np.uint64) * np.uint64(2) + (w2 == w3).astype(np.uint64) * np.uint64(4)
        pairs = _mix(words * np.uint64(31) + w2 * np.uint64(_ODD))
        shapes = _mix((shape << np.uint64(40)) + (s2 << np.uint64(20)) + s3 + same * np.uint64(0x51ED270B4F))
    grams = np.stack([words, pairs, shapes], axis=1).ravel() >> np.uint64(64 - BITS)
    return grams.astype(np.int64), 3 * per


def train(rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Weights, the bias last, from (feature numbers, label) in order, by per-coordinate updates with both penalties."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    prepared = []
    for grams, label in rows:
        at, counts = np.unique(grams, return_counts=True)
        prepared.append((np.r_[at, size - 1], np.r_[SCALE * counts / max(1, len(grams)), 1.0], label))

    def weights(at) -> np.ndarray:
        penalty = np.full(len(z[at]), L1)
        pull = z[at]
        w = -(pull - np.sign(pull) * penalty) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(pull) <= penalty, 0.0, w)

    for _ in range(EPOCHS):
        for at, x, label in prepared:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def scores(data: bytes, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    grams, per = features(data, ends)
    values = np.r_[0.0, np.cumsum(weights[grams])]
    stops = np.r_[0, np.cumsum(per)]
    mean = (values[stops[1:]] - values[stops[:-1]]) / np.maximum(per, 1)
    return 1 / (1 + np.exp(-np.clip(SCALE * mean + weights[-1], -35, 35)))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", doc_id: str = "doc_id") -> np.ndarray:
    """The weights from a bounded sample of the labelled rows."""
    spark = prepare(docs.sparkSession)
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("d")).agg(F.max(label).cast("int").alias("y"))
    order = F.xxhash64(F.lit(6), "d")
    chosen = known.select("d", "y", order.alias("h")).orderBy("h", "d").limit(SAMPLE_ROWS)
    # At most SAMPLE_ROWS rows of 20 bytes.
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).join(F.broadcast(chosen), "d").groupBy("d", "h", "y").agg(F.max("t").alias("t"))
    dealt = rows.withColumn("s", F.pmod("h", F.lit(SHARDS)).cast("int")).repartitionById(SHARDS, F.col("s")).sortWithinPartitions("h", "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            grams, per = features(*text_bytes(batch.column(1)))
            held += zip(np.split(grams, np.cumsum(per)[:-1]), batch.column(0).to_pylist())
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([train(held).astype("<f8").tobytes()], pa.binary()), pa.array([len(held)], pa.int64())], names=["w", "n"])

    found = dealt.select("y", "t").mapInArrow(run, T.StructType([T.StructField("w", T.BinaryType()), T.StructField("n", T.LongType())])).collect()
    total = np.zeros((1 << BITS) + 1)
    for row in sorted(found, key=lambda r: bytes(r.w)):
        total += np.frombuffer(row.w, "<f8") * row.n
    return total / max(1, sum(r.n for r in found))


def classify(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (double). A column of this name raises a ValueError."""
    prepare(docs.sparkSession)
    if "score" in {c.lower() for c in docs.columns}:
        raise ValueError("the input already has a column score")
    at, names = docs.columns.index(text), [*docs.columns, "score"]
    model = weights.astype("<f4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(model, "<f4").astype(np.float64)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(*text_bytes(batch.column(at)), w))], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
