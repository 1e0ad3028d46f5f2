"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records by a seeded hash of their id and text into buckets that fit a task's memory.
Pass 2 puts each bucket in a fixed order, shuffles it by Fisher-Yates from a generator seeded with the
bucket's number, and writes it. The order of the buckets and of their records is the shuffled corpus;
record number p of it goes to shard p mod n, slot p div n, so that counts differ by one at most.

The number of buckets follows the bytes of the table; only one row per bucket is gathered to number the
buckets' records. The same seed and rows give the same shards on any cluster, and a lost task writes the
same rows again. Null text: size 1. Null ids are shuffled like others. Rows that are alike in id and text
share a bucket and are interchangeable. An empty table gives no rows. Other columns travel along, whatever their
names; those of the two new columns are ``into``, and raise a ValueError if the input has one of them already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import fresh, prepare, stored

#: Bytes of text that one bucket aims at.
BUCKET_BYTES = 24 << 20


def fisher_yates(n: int, seed: tuple[int, ...]) -> list[int]:
    """A uniform permutation of range(n)."""
    order = list(range(n))
    draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 0, -1)).tolist()
    for last, j in zip(range(n - 1, 0, -1), draws):
        order[last], order[j] = order[j], order[last]
    return order


def shard(
    docs: DataFrame, shards: int, seed: int = 7, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES,
    into: tuple[str, str] = ("shard", "slot"),
) -> DataFrame:
    """The rows of ``docs`` with their shard (int, from 0) and slot (long, gapless from 0 in each shard), named ``into``."""
    spark = prepare(docs.sparkSession)
    if {c.lower() for c in into} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has a column {into[0]} or {into[1]}")
    bucket_c, at_c, n_c, start_c, place_c = fresh([*docs.columns, *into], "__bucket", "__at", "__n", "__start", "__p")
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64).alias("s")).first()["s"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), docs[doc_id], docs[text]), F.lit(buckets)).cast("int")
    scattered = docs.withColumn(bucket_c, bucket).repartitionById(buckets, F.col(bucket_c))
    schema = T.StructType([*docs.schema.fields, T.StructField(bucket_c, T.IntegerType()), T.StructField(at_c, T.LongType())])
    id_at, text_at = docs.columns.index(doc_id), docs.columns.index(text)

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        numbers = table.column(table.num_columns - 1)
        for number in pc.unique(numbers).to_pylist():  # one, unless partitions were merged
            part = table if len(pc.unique(numbers)) == 1 else table.filter(pc.equal(numbers, number))
            # A fixed order first: by id, then by text where ids repeat.
            keys = pa.table({"id": part.column(id_at).combine_chunks(), "text": part.column(text_at).cast(pa.large_string()).combine_chunks()})
            order = pc.sort_indices(keys, [("id", "ascending"), ("text", "ascending")]).to_numpy()
            order = order[fisher_yates(len(order), (seed, number))]
            for i in range(0, len(order), 1024):
                rows = part.take(pa.array(order[i : i + 1024])).combine_chunks()
                at = pa.array(np.arange(i, i + rows.num_rows, dtype=np.int64))
                yield from rows.append_column(at_c, at).to_batches()

    written = stored(scattered.mapInArrow(shuffle, schema), "shuffled")
    counts = written.groupBy(bucket_c).agg(F.count(F.lit(1)).alias(n_c))
    before = F.coalesce(F.sum(n_c).over(Window.orderBy(bucket_c).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(bucket_c, before.alias(start_c))
    # One row per bucket, thus a few bytes for each 24 MB of text: small beside any task's share of them.
    numbered = written.join(F.broadcast(starts) if buckets <= 200_000 else starts, bucket_c).withColumn(place_c, F.col(start_c) + F.col(at_c))
    shard_of, slot_of = F.pmod(place_c, F.lit(shards)).cast("int"), F.call_function("div", F.col(place_c), F.lit(int(shards)))
    return numbered.select(*docs.columns, shard_of.alias(into[0]), slot_of.alias(into[1]))
