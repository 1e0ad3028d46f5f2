"""Approximate nearest neighbours by collision counting with query-centred windows.

Vectors are scaled to length 1, so the nearest by distance has the largest cosine. Every vector is projected
on ``projections`` random lines; a block of vectors keeps one sorted array per line. A query looks in each
array at the window around its own projection. The windows widen step by step (virtual rehashing: nothing is
hashed anew, each step adds the windows' new ends in the sorted arrays) and each vector counts the windows
that hold it. Vectors that reach the threshold are verified by their true cosine. A query ends in a block when
a vector nearer than its k-th best so far would have reached the threshold already, but for a chance
of 1 in 10 (``SURE`` standard deviations), or when the windows hold everything.

The index covers every row: blocks of bounded size, dealt by a hash of the id. A block stays in its task, where its index is
built once, and the queries come to it in chunks (of very many queries, several tasks have a copy of the block). Blocks return
their k best for each query; a ranking with a per-task limit joins them. Queries are a stated set against all rows, in blocks; nothing is broadcast or collected but
the number of vectors of each length. Measured recall is in the README.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id.
Vectors compare with those of their own length. Rows that repeat an id count once, with the smallest of their
vectors. Ties go to the smaller id. Fewer than k candidates: all of them. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, stored

PROJECTIONS = 96
#: Share of the windows that must hold a vector before it is verified.
THRESHOLD = 0.5
#: Each step widens the windows by this factor, from FIRST, in units of a projection's spread at distance 1.
GROWTH, FIRST = 1.6, 0.15
SURE = 1.3
BLOCK, CHUNK = 8_192, 512
#: Chunks of queries that come to one copy of a block.
GROUP = 32


def lines(length: int, projections: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, length])).standard_normal((projections, length))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that its largest component is between a half and one: squares of very small or large
    components neither vanish nor overflow, and a cosine has the same bits as without."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


class Index:
    """The sorted projections of a block of unit vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = 11):
        vectors = scaled(vectors)
        self.ids, self.vectors, self.unit = ids, vectors, unit(vectors)
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.lines = lines(vectors.shape[1], projections, seed)
        values = self.lines @ self.unit.T
        n = values.shape[1]
        order = np.argsort(values, axis=1, kind="stable")
        # All sorted arrays in one, each moved beyond the one before (a projection of a unit vector is at most its line's length).
        self.apart = 4 * np.sqrt((self.lines * self.lines).sum(axis=1).max()) * np.arange(projections)
        self.sorted = (np.take_along_axis(values, order, axis=1) + self.apart[:, None]).ravel()
        self.first = n * np.arange(projections)
        # Where each vector stands in each array: a window holds it if its place lies between the window's ends.
        self.place = np.empty((projections, n), np.uint16 if n < 65_536 else np.uint32)
        np.put_along_axis(self.place, order, np.broadcast_to(np.arange(n, dtype=self.place.dtype), order.shape), axis=1)
        self.per_width = self.reach(1.0)

    def reach(self, width: float) -> float:
        """The distance within which a vector has reached the threshold, surely enough."""
        m = len(self.lines)
        low, high = 0.0, 2.5
        for _ in range(30):
            mid = (low + high) / 2
            p = erf(width / max(mid, 1e-9) / sqrt(2))
            if p - SURE * sqrt(p * (1 - p) / m) >= THRESHOLD:
                low = mid
            else:
                high = mid
        return low

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the k best found, the query's own id left out."""
        query = scaled(query[None])[0]
        m, n = self.place.shape
        need = int(np.ceil(THRESHOLD * m))
        length = np.sqrt((query * query).sum())
        centre = self.lines @ (query / length) + self.apart
        found = self.ids == query_id  # never a candidate
        best, best_ids = np.zeros(0), np.zeros(0, np.int64)
        width = FIRST
        while True:
            low = np.clip(np.searchsorted(self.sorted, centre - width, "left") - self.first, 0, n)
            high = np.clip(np.searchsorted(self.sorted, centre + width, "right") - self.first, 0, n)
            kind = self.place.dtype
            if n and (high - low < n).any():
                inside = self.place - low.astype(kind)[:, None] < (high - low).astype(kind)[:, None]
                reached = np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8 if m < 256 else np.uint32) >= need
            else:
                reached = np.ones(n, bool)
            new = np.flatnonzero(reached & ~found)
            if len(new):
                found = found | reached
                cosine = (self.vectors[new] * query).sum(axis=1) / (self.norms[new] * length)
                best, best_ids = np.r_[best, cosine], np.r_[best_ids, self.ids[new]]
                top = np.lexsort((best_ids, -best))[:k]
                best, best_ids = best[top], best_ids[top]
            # A vector's reach is in proportion to the width.
            if found.all() or len(best) == k and sqrt(max(0.0, 2 - 2 * best[-1])) <= self.per_width * width:
                return best_ids, best
            width *= GROWTH


def _usable(vector: str) -> Column:
    """Not null, not zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(table: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", projections: int = PROJECTIONS, seed: int = 11, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score: the k nearest found of each row for which ``queries`` (a condition on vec_id) holds."""
    spark = prepare(table.sparkSession)
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable("v"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")).withColumn("d", F.size("v")), "vectors")
    sizes = {r.d: (-(-r.n // block), max(1, -(-r.q // chunk))) for r in rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).collect()}
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if not sizes:
        return spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    blocks_of = F.create_map(*[F.lit(x) for d in sorted(sizes) for x in (d, sizes[d][0])])
    chunks_of = F.create_map(*[F.lit(x) for d in sorted(sizes) for x in (d, sizes[d][1])])
    held = F.collect_list(F.struct("vec_id", "v")).alias("held")
    dealt = F.xxhash64(F.lit(seed), "vec_id")
    blocks = rows.withColumn("b", F.pmod(dealt, blocks_of[F.col("d")]).cast("int")).groupBy("d", "b").agg(held)
    asked = rows.where("asks").withColumn("c", F.pmod(dealt, chunks_of[F.col("d")]).cast("int")).groupBy("d", "c").agg(held)
    # A task has one block and the chunks of a group: its block comes first, then they pass by one after another.
    groups, first, tasks = {}, {}, 0
    for d in sorted(sizes):
        groups[d], first[d] = -(-sizes[d][1] // GROUP), tasks
        tasks += sizes[d][0] * groups[d]
    of = lambda numbers: F.create_map(*[F.lit(x) for d in sorted(numbers) for x in (d, numbers[d])])[F.col("d")]
    task = (of(first) + F.col("b") * of(groups) + F.col("g")).cast("int").alias("task")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    blocks = blocks.withColumn("g", each(of(groups))).select(task, F.lit(-1).alias("c"), "held")
    chunks = asked.withColumn("g", F.expr(f"c div {GROUP}")).withColumn("b", each(blocks_of[F.col("d")])).select(task, "c", "held")
    pairs = blocks.unionByName(chunks).repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "c")

    def arrays(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
        found = column[i].values
        ids = found.field("vec_id").to_numpy(zero_copy_only=False)
        vectors = found.field("v").flatten().to_numpy(zero_copy_only=False)
        return ids, vectors.reshape(len(ids), -1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held = None
        for batch in batches:
            for i, (task_, chunk) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if chunk < 0:
                    index, held = Index(*arrays(batch.column(2), i), projections, seed), task_
                if chunk < 0 or held != task_:  # a block without vectors has nothing to find
                    continue
                for query_id, query in zip(*arrays(batch.column(2), i)):
                    ids, scores = index.search(int(query_id), query, k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query_id)), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.mapInArrow(search, schema).withColumn("rank", F.row_number().over(order)).where(f"rank <= {int(k)}").select("query_id", "rank", "vec_id", "score")
