"""Centroid clustering over zone maps in the order of a space-filling curve.

Vectors become integers, exact from there on. Each has a place on a Hilbert curve through all dimensions; vectors sorted
by it are cut into blocks of neighbours, stored once with the least and largest value of each dimension. A round hands the
centroids (k vectors, whatever the size of the table) to every task. The box of a block bounds its vectors' distances to
each centroid from below and above; a centroid whose lower bound is over another's upper bound is nearest to none of them.
What is left, the block's candidates, is compared with all its vectors, and a task sums up vectors and counts by cluster
before anything travels: k sums a task.

Distances are squared and exact: in doubles while all terms stay under 2**53, as 64-bit integers beyond. Components over
``LARGEST`` times the scale would need more than a long, and raise a ValueError.

A vector takes part if it has ``length`` components, none null or not finite. Its id may be missing, which is drawn like the
empty text, or repeat. Ties go to the smaller centroid; centroids drawn alike are two, and the second stays empty. Fewer
vectors than centroids: as many centroids as vectors. No vector: no rows. Other columns are ignored, whatever their names.
Copies of one vector, however many, are dealt by their ids too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, stored

LENGTH, K, ROUNDS, SCALE = 64, 40, 5, 256
#: Bits of each dimension in a vector's place on the curve.
BITS = 4
#: Vectors of a block.
BLOCK = 256
#: The largest integer component; the square of a distance between two vectors of 128 such is under 2**63.
LARGEST = 1 << 27
#: Up to here doubles are exact: (2 * 2**22)**2 * 64 = 2**52.
EXACT = 1 << 22

_LONG, _INT, _BYTES = T.LongType(), T.IntegerType(), T.BinaryType()


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of ``cells`` (numbers under 2**bits), as rows of bytes that sort alike."""
    axes = np.ascontiguousarray(cells.T.astype(np.uint32))
    dims = len(axes)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            on = (axes[i] & bit) != 0
            swap = np.where(on, low, (axes[0] ^ axes[i]) & low)  # invert the first axis' low bits, or exchange them
            axes[0] ^= swap
            if i:
                axes[i] ^= np.where(on, np.uint32(0), swap)
    for i in range(1, dims):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    axes ^= turn
    planes = [(axes >> np.uint32(level) & np.uint32(1)).T.astype(np.uint8) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


def bounds(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest squared distance that a vector in the box can have to each centroid."""
    under, over = low - centroids, centroids - high
    nearest = np.maximum(np.maximum(under, over), 0)
    farthest = np.maximum(np.abs(under), np.abs(over))
    return (nearest * nearest).sum(axis=1), (farthest * farthest).sum(axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that may be nearest to a vector in the box, ties included."""
    least, most = bounds(low, high, centroids)
    return np.flatnonzero(least <= most.min())


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the first of equals, and its squared distance. All are int64."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT and vectors.shape[1] <= LENGTH:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        table = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)
        best = table.argmin(axis=1)
        return best, table[np.arange(len(best)), best].astype(np.int64)
    best, least = np.zeros(len(vectors), np.int64), np.full(len(vectors), np.iinfo(np.int64).max)
    for i, centroid in enumerate(centroids):
        gap = vectors - centroid
        distance = (gap * gap).sum(axis=1)
        nearer = distance < least
        best[nearer], least[nearer] = i, distance[nearer]
    return best, least


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_PLACED = _schema(vec_id=_LONG, row=_LONG, place=_BYTES, v=_BYTES)
_BLOCK = _schema(ids=T.ArrayType(_LONG), vectors=_BYTES, low=_BYTES, high=_BYTES)
_SUMS = _schema(cluster=_INT, dim=_INT, total=_LONG)
_ASSIGNED = _schema(vec_id=_LONG, cluster=_INT, distance=_LONG)


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.floor(values * np.float64(scale))
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is over {LARGEST} / {scale}; squared distances would not fit a long")
    return out.astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """An array column whose rows are equally long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _placed(scale: int, bits: int, low: int, high: int):
    """Integers (32 bits each) and place on the curve; cells divide what lies between the least and largest component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = whole_numbers(_matrix(batch.column(2)), scale)
                places = hilbert((v - low) * (1 << bits) // (high - low + 1), bits)
                blobs = [pa.array([x.tobytes() for x in rows], pa.binary()) for rows in (places, v.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *blobs], names=_PLACED.names)

    return run


def _cut(length: int, block: int):
    """Sorted vectors in blocks, with their boxes."""

    def of(part: pa.Table) -> pa.RecordBatch:
        v = np.frombuffer(b"".join(part.column(3).to_pylist()), np.int32).reshape(-1, length)
        arrays = [pa.array([part.column(0).to_pylist()], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays + [pa.array([x.tobytes()], pa.binary()) for x in (v, v.min(axis=0), v.max(axis=0))], names=_BLOCK.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            while held.num_rows >= block:
                yield of(held.slice(0, block))
                held = held.slice(block)
        if held is not None and held.num_rows:
            yield of(held)

    return run


def _blocks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, cluster and distance, block by block."""
    for batch in batches:
        for i in range(batch.num_rows):
            v, low, high = (np.frombuffer(batch.column(c)[i].as_py(), np.int32).astype(np.int64) for c in (1, 2, 3))
            v = v.reshape(-1, centroids.shape[1])
            may = candidates(low, high, centroids)
            best, distance = nearest(v, centroids[may])
            yield batch.column(0)[i].values, v, may[best], distance


def _sums(centroids: np.ndarray):
    """Sum of each dimension and count (as dimension -1) of a task's vectors, by cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, v, cluster, _ in _blocks(batches, centroids):
            np.add.at(total, cluster, v)
            count += np.bincount(cluster, minlength=k)
        filled = np.flatnonzero(count)
        values = np.c_[count, total][filled]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(filled, dims + 1).astype(np.int32)), pa.array(np.tile(np.arange(-1, dims), len(filled)).astype(np.int32)), pa.array(values.ravel())], names=_SUMS.names
        )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _blocks(batches, centroids):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=_ASSIGNED.names)

    return run


def usable(vector: str, length: int) -> Column:
    """``length`` components, all finite."""
    return (F.size(vector) == length) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def zone_blocks(rows: DataFrame, length: int, scale: int, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``rows`` (vec_id, row, v as doubles) as stored blocks of neighbours with their boxes."""
    edge = rows.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    low, high = (int(x) for x in whole_numbers(np.array([edge["low"] or 0.0, edge["high"] or 0.0]), scale))
    by = ["place", "vec_id", "row"]
    placed_ = rows.mapInArrow(_placed(scale, bits, low, high), _PLACED).repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(placed_.mapInArrow(_cut(length, block), _BLOCK), "zones")


def cluster(table: DataFrame, k: int = K, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE, seed: int = 2, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster (int), distance (squared), cluster_inertia, inertia, centroid (array of bigint, final).

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>``.
    """
    spark = prepare(table.sparkSession)
    if not 1 <= length <= 128:
        raise ValueError("1 <= length <= 128")
    rows = table.select(table[vec_id].cast("bigint").alias("vec_id"), table[vector].cast("array<double>").alias("v")).where(usable("v", length))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("vec_id", "row", "v")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select("v", drawn.alias("drawn")).orderBy("drawn", "v").limit(k).collect()  # k vectors
    centroids = whole_numbers(np.array([r["v"] for r in first], np.float64).reshape(-1, length), scale)
    out = _schema(vec_id=_LONG, cluster=_INT, distance=_LONG, cluster_inertia=_LONG, inertia=_LONG, centroid=T.ArrayType(_LONG))
    if not len(centroids):
        return spark.createDataFrame([], out)
    blocks = zone_blocks(rows, length, scale, block=block)
    for _ in range(rounds):
        # At most k times length + 1 sums.
        sums = blocks.mapInArrow(_sums(centroids), _SUMS).groupBy("cluster", "dim").agg(F.sum("total").alias("total")).collect()
        total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for s in sums:
            if s["dim"] < 0:
                count[s["cluster"]] = s["total"]
            else:
                total[s["cluster"], s["dim"]] = s["total"]
        filled = count > 0
        centroids = centroids.copy()
        centroids[filled] = total[filled] // count[filled][:, None]  # rounds down
    assigned = stored(blocks.mapInArrow(_assigned(centroids), _ASSIGNED), "assigned")
    by = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows at most
    whole = sum(int(r["s"]) for r in by)
    known = spark.createDataFrame([(r["cluster"], int(r["s"]), whole, centroids[r["cluster"]].tolist()) for r in by], T.StructType([out["cluster"], out["cluster_inertia"], out["inertia"], out["centroid"]]))
    return assigned.join(F.broadcast(known), "cluster").select(*out.names)
