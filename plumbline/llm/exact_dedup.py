"""Exact deduplication by a cuckoo-filter index over digests.

A task over the input keeps an index of the digests it has met. A lookup that hits is verified against
the content kept in the digest's bucket, so neither a shared filter entry nor a shared digest alone ever
makes two texts equal. What a task has met leaves it as one row for each different text (digest, content,
count, best row): copies never travel, however many there are. These rows meet by digest, sorted, in a
second index that inserts the digests of one bucket after another and deletes those it has passed, so it
holds one bucket of content at a time. Each document row then takes the verdict of its digest by an
equi-join, which AQE splits where one digest has very many rows.

Texts are equal when identical after deleting space, tab, line feed, vertical tab, form feed and carriage
return. Of equal texts the row with the most code points stays, then the smallest id (a missing id
comes last), then the first row as stored. A null text counts as empty; all empty texts are equal to one
another. Rows that repeat an id are rows of their own. Other columns are ignored. Two different texts with
one SHA-256 would raise a ValueError; they never become one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, text_bytes

BLANKS = b" \t\n\x0b\x0c\r"
SLOTS, KICKS = 4, 200
#: A task hands on what it has met when its content reaches this many bytes.
CONTENT_BYTES = 48 << 20


class CuckooIndex:
    """A cuckoo filter with partial keys over live digests, their content in buckets beside it.

    ``content`` maps the first bytes of a digest to {digest: entry}; the filter is asked first.
    """

    def __init__(self, buckets: int = 1024):
        self.resize(buckets, ())
        self.content: dict[bytes, dict[bytes, list]] = {}
        self.live = 0

    def resize(self, buckets: int, digests) -> None:
        """A new table of ``buckets`` (a power of two), filled from the stored digests."""
        while True:
            self.mask = buckets - 1
            self.table = [0] * (buckets * SLOTS)
            if all(self._place(d) for d in digests):
                return
            buckets *= 2

    def _where(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        one = int.from_bytes(digest[:8], "little") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _place(self, digest: bytes) -> bool:
        mark, one, two = self._where(digest)
        table = self.table
        for bucket in (one, two):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not table[slot]:
                    table[slot] = mark
                    return True
        bucket = two
        for kick in range(KICKS):
            slot = bucket * SLOTS + (mark + kick) % SLOTS
            table[slot], mark = mark, table[slot]
            bucket = self._other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not table[free]:
                    table[free] = mark
                    return True
        return False

    def __contains__(self, digest: bytes) -> bool:
        """Maybe live (may be wrong) or surely not."""
        mark, one, two = self._where(digest)
        table = self.table
        return mark in table[one * SLOTS : one * SLOTS + SLOTS] or mark in table[two * SLOTS : two * SLOTS + SLOTS]

    def find(self, digest: bytes, content: bytes) -> list | None:
        """The entry of an equal text, verified on its content."""
        if digest not in self:
            return None
        entry = self.content.get(digest[:2], {}).get(digest)
        if entry is None:
            return None
        if entry[0] != content:
            raise ValueError("two different texts share a SHA-256")
        return entry

    def insert(self, digest: bytes, entry: list) -> None:
        """``entry`` begins with the content. The digest must not be live."""
        self.content.setdefault(digest[:2], {})[digest] = entry
        self.live += 1
        if self.live > 0.9 * len(self.table) or not self._place(digest):
            self.resize(2 * (self.mask + 1), (d for bucket in self.content.values() for d in bucket))

    def delete(self, digest: bytes) -> list | None:
        """Remove a live digest and return its entry; None if it isn't live."""
        bucket = self.content.get(digest[:2], {})
        if digest not in bucket:
            return None
        mark, one, two = self._where(digest)
        for slot in (*range(one * SLOTS, one * SLOTS + SLOTS), *range(two * SLOTS, two * SLOTS + SLOTS)):
            if self.table[slot] == mark:
                self.table[slot] = 0
                break
        self.live -= 1
        entry = bucket.pop(digest)
        if not bucket:
            del self.content[digest[:2]]
        return entry


# An entry: content, count, best row as (code points, -id or nothing, -row).
def _better(a: tuple, b: tuple) -> bool:
    return a > b


def _rank(points: int, doc_id: int | None, row: int) -> tuple:
    return (points, doc_id is not None, -(doc_id or 0), -row)


_MET = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("points", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("content", T.BinaryType()), T.StructField("n", T.LongType())]
)  # the best row of a text, and how many have it
_GROUP = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("keep_id", T.LongType()), T.StructField("keep_row", T.LongType()), T.StructField("group_size", T.LongType())])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with content and count for each different text this task has met."""
    index, held = CuckooIndex(), 0
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("points", pa.int64()), ("digest", pa.binary()), ("content", pa.binary()), ("n", pa.int64())])

    def met() -> Iterator[pa.RecordBatch]:
        entries = [(d, *e) for bucket in index.content.values() for d, e in bucket.items()]
        for i in range(0, len(entries), 512):
            part = entries[i : i + 512]
            best = [e[3] for e in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-b[2] if b[1] else None for b in best], pa.int64()), pa.array([-b[3] for b in best], pa.int64()), pa.array([b[0] for b in best], pa.int64()), pa.array([e[0] for e in part], pa.binary()), pa.array([e[1] for e in part], pa.binary()), pa.array([e[2] for e in part], pa.int64())],
                schema=schema,
            )

    for batch in batches:
        data, ends = text_bytes(batch.column(2))
        ids, rows, cuts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends.tolist()
        # Code points: bytes that don't continue one.
        heads = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
        points = np.diff(heads[ends]).tolist()
        for doc_id, row, count, start, end in zip(ids, rows, points, cuts, cuts[1:]):
            content = data[start:end].translate(None, BLANKS)
            digest = hashlib.sha256(content).digest()
            rank = _rank(count, doc_id, row)
            entry = index.find(digest, content)
            if entry is None:
                index.insert(digest, [content, 1, rank])
                held += len(content) + 200
            else:
                entry[1] += 1
                if _better(rank, entry[2]):
                    entry[2] = rank
        if held > CONTENT_BYTES:
            yield from met()
            index, held = CuckooIndex(), 0
    yield from met()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digest: insert those of a bucket, verify copies, delete a bucket once it is passed."""
    index, bucket = CuckooIndex(), None
    schema = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])

    def passed() -> pa.RecordBatch:
        out = [(d, index.delete(d)) for d in [d for kept in index.content.values() for d in kept]]
        best = [e[2] for _, e in out]
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in out], pa.binary()), pa.array([-b[2] if b[1] else None for b in best], pa.int64()), pa.array([-b[3] for b in best], pa.int64()), pa.array([e[1] for _, e in out], pa.int64())],
            schema=schema,
        )

    for batch in batches:
        for doc_id, row, points, digest, content, n in zip(*(c.to_pylist() for c in batch.columns)):
            if digest[:2] != bucket:
                if index.live:
                    yield passed()
                bucket = digest[:2]
            rank = _rank(points, doc_id, row)
            entry = index.find(digest, content)
            if entry is None:
                index.insert(digest, [content, n, rank])
            else:
                entry[1] += n
                if _better(rank, entry[2]):
                    entry[2] = rank
    if index.live:
        yield passed()


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None) -> DataFrame:
    """One row per document: doc_id, row, keep_id, group_size, kept, text_sha256 (of the normalised text).

    ``row`` names a column that numbers the rows; without it they are numbered as the scan yields them. The rows are
    read twice, so ``docs`` must yield the same both times, as a stored table does.
    """
    prepare(docs.sparkSession)
    number = docs[row] if row else F.monotonically_increasing_id()
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), number.alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    texts = rows.mapInArrow(_meet, _MET).repartition("digest").sortWithinPartitions("digest")
    groups = texts.mapInArrow(_settle, _GROUP)
    # A row's digest is cheaper to compute again than to keep beside the content.
    normal = F.col("text")
    for blank in BLANKS.decode():
        normal = F.replace(normal, F.lit(blank), F.lit(""))
    digests = rows.select("doc_id", "row", F.unhex(F.sha2(normal, 256)).alias("digest"))
    verdicts = digests.join(groups, "digest")
    return verdicts.select("doc_id", "row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
