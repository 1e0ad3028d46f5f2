"""Removal of lines that an earlier document has, suspects told by two Bloom filters.

A line's key is the line without blanks at its ends (space, tab, line feed, vertical tab, form feed, carriage return)
and with A-Z in lower case. A key of at least ``SHORTEST`` code points that stands in two documents or more loses its
lines in all but the document with the smallest id; there all of them stay, and shorter keys lose none.

Steps, and what travels:
1. Chunks (an Arrow batch of documents, compressed) are stored.
2. The hashes of a chunk's keys, each once, go to slices by hash. A slice's task has two Bloom filters: a hash that
   ``once`` holds already enters ``twice``, any other enters ``once``. What ``twice`` holds in the end is suspected, and
   each chunk hears which of its hashes that are. One filter for all hashes would grow with the corpus; a slice's grows
   with ``SLICE_BYTES``, and slices are as many as the corpus asks for.
3. Only suspected keys travel as text, one row for each in a chunk, with the smallest and largest id that has it there.
   They are grouped by the whole key, in each task first: those of two ids are repeats, the smallest id keeps its lines.
   A filter's false alarm ends here.
4. Each chunk hears the smallest ids of its repeats and drops their lines.

A hash that a filter has never met is never a repeat, so nothing is missed; no line is dropped on a hash alone. A line in
very many documents sends one hash and one row for each chunk, grouped in each task before they meet.

A null or empty text is one empty line. A missing id is larger than all others; rows of equal id are one document, so they
don't take lines from one another. A document that loses all lines has an empty text. Other columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, stored, text_bytes

BLANKS = b" \t\n\x0b\x0c\r"
#: Code points of a key that may be a repeat.
SHORTEST = 10
#: Bytes of text per slice of the hashes, on the corpus as a whole.
SLICE_BYTES = 64 << 20
#: Bits of each filter per hash of a slice; a hash sets four in one word.
BITS = 16

_MISSING = np.iinfo(np.int64).max
_LAST = np.uint64(1)
_LONG, _INT, _BYTES = T.LongType(), T.IntegerType(), T.BinaryType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_CHUNK = _schema(chunk=_LONG, n=_LONG, size=_LONG, text=_BYTES, ends=_BYTES, ids=_BYTES, rows=_BYTES)
_HASHES = _schema(chunk=_LONG, slice=_INT, hashes=_BYTES)
_TOLD = _schema(chunk=_LONG, hashes=_BYTES)
#: Of a chunk: a suspected key (number from 0), or, without a number, where the lines of such keys are and whose they are.
_SUSPECT = _schema(chunk=_LONG, number=_INT, key=_BYTES, low=_LONG, high=_LONG, lines=_BYTES, numbers=_BYTES)
_KEPT = _schema(doc_id=_LONG, row=_LONG, n_lines=_LONG, n_dropped=_LONG, kept=T.StringType())


def _batches(rows: Iterator[dict], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Batches of a few MB at most, but for a larger row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, size = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append({name: row.get(name) for name in arrow.names})
        size += 100 + sum(len(x) for x in row.values() if isinstance(x, bytes))
        if size > 4 << 20:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


class Bloom:
    """A filter of 64-bit words; a hash sets four bits of one word, so it is met with one look."""

    def __init__(self, hashes: int):
        self.words = np.zeros(max(1, -(-hashes * BITS // 64)), np.uint64)

    def bits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and bits of each hash."""
        mask = np.zeros(len(hashes), np.uint64)
        for shift in (1, 7, 13, 19):
            mask |= np.uint64(1) << (hashes >> np.uint64(shift) & np.uint64(63))
        return ((hashes >> np.uint64(25)) % np.uint64(len(self.words))).astype(np.int64), mask

    def add(self, word: np.ndarray, mask: np.ndarray) -> None:
        np.bitwise_or.at(self.words, word, mask)

    def holds(self, word: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self.words[word] & mask == mask


class Lines:
    """The lines of some texts: where each begins and ends, and whose it is."""

    def __init__(self, data: bytes, ends: np.ndarray):
        self.data = data
        breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        self.start = np.sort(np.r_[ends[:-1], breaks + 1])
        self.stop = np.sort(np.r_[ends[1:], breaks])
        before = np.searchsorted(breaks, ends)
        self.count = np.diff(before) + 1
        self.whose = np.repeat(np.arange(len(self.count)), self.count)

    def keys(self, shortest: int) -> tuple[np.ndarray, list[bytes]]:
        """The lines whose keys are long enough, and these keys."""
        data, which, keys = self.data.lower(), [], []  # of bytes, this lowers A-Z alone
        for i, (a, b) in enumerate(zip(self.start.tolist(), self.stop.tolist())):
            if b - a >= shortest:
                key = data[a:b].strip(BLANKS)
                if len(key) >= shortest and (len(key) >= 4 * shortest or key.isascii() or len(key.decode()) >= shortest):
                    which.append(i)
                    keys.append(key)
        return np.array(which, np.int64), keys


def hashes_of(keys: list[bytes]) -> np.ndarray:
    """64-bit hashes; the last bit is free for a mark."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)) & ~_LAST


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32

    def rows() -> Iterator[dict]:
        for chunk, batch in enumerate((b for b in batches if b.num_rows), first):
            data, ends = text_bytes(batch.column(2))
            ids = batch.column(0).fill_null(_MISSING).to_numpy()
            packed = pa.compress(data, "zstd", asbytes=True) if data else b""
            yield {"chunk": chunk, "n": len(ids), "size": len(data), "text": packed, "ends": ends.tobytes(), "ids": ids.tobytes(), "rows": batch.column(1).to_numpy().tobytes()}

    yield from _batches(rows(), _CHUNK)


def _unpacked(size: int, text: bytes, ends: bytes) -> Lines:
    return Lines(pa.decompress(text, size, "zstd", asbytes=True) if size else b"", np.frombuffer(ends, np.int64))


def _hashed(shortest: int, slices: int):
    """The hashes of a chunk's keys by slice; the last bit marks those that two ids of the chunk have."""

    def of(chunk: int, n: int, size: int, text: bytes, ends: bytes, ids: bytes) -> Iterator[dict]:
        lines = _unpacked(size, text, ends)
        which, keys = lines.keys(shortest)
        if not keys:
            return
        hashes, owner = hashes_of(keys), np.frombuffer(ids, np.int64)[lines.whose[which]]
        order = np.argsort(hashes)
        hashes, owner = hashes[order], owner[order]
        heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        twice = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
        hashes = hashes[heads] | twice.astype(np.uint64)
        slice_ = (hashes >> np.uint64(40)) % np.uint64(slices)
        order = np.argsort(slice_, kind="stable")
        hashes, slice_ = hashes[order], slice_[order]
        cuts = np.flatnonzero(np.r_[True, slice_[1:] != slice_[:-1]]).tolist() + [len(slice_)]
        for a, b in zip(cuts, cuts[1:]):
            yield {"chunk": chunk, "slice": int(slice_[a]), "hashes": hashes[a:b].tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((x for row in _rows(batches) for x in of(*row)), _HASHES)

    return run


def _suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of a slice: each chunk hears those that the filter of the twice seen holds."""
    held = [(chunk, np.frombuffer(blob, np.uint64)) for chunk, blob in _rows(batches)]
    if not held:
        return
    total = sum(len(h) for _, h in held)
    once, twice = Bloom(total), Bloom(total)
    for _, hashes in held:
        word, mask = once.bits(hashes)
        again = once.holds(word, mask) | (hashes & _LAST).astype(bool)
        twice.add(word[again], mask[again])
        once.add(word, mask)

    def rows() -> Iterator[dict]:
        for chunk, hashes in held:
            found = hashes[twice.holds(*twice.bits(hashes))]
            if len(found):
                yield {"chunk": chunk, "hashes": (found & ~_LAST).tobytes()}

    yield from _batches(rows(), _TOLD)


def _suspects(shortest: int):
    """The suspected keys of a chunk as text, and where their lines are."""

    def of(chunk: int, n: int, size: int, text: bytes, ends: bytes, ids: bytes, told: list[bytes]) -> Iterator[dict]:
        lines = _unpacked(size, text, ends)
        which, keys = lines.keys(shortest)
        told_ = np.sort(np.frombuffer(b"".join(told), np.uint64))
        hashes = hashes_of(keys)
        found = np.flatnonzero(told_[np.minimum(np.searchsorted(told_, hashes), len(told_) - 1)] == hashes)
        numbers: dict[bytes, int] = {}
        number = np.fromiter((numbers.setdefault(keys[i], len(numbers)) for i in found.tolist()), np.int64, len(found))
        owner = np.frombuffer(ids, np.int64)[lines.whose[which[found]]]
        low, high = np.full(len(numbers), _MISSING), np.full(len(numbers), np.iinfo(np.int64).min)
        np.minimum.at(low, number, owner)
        np.maximum.at(high, number, owner)
        yield {"chunk": chunk, "lines": which[found].tobytes(), "numbers": number.tobytes()}
        for key, i in numbers.items():
            yield {"chunk": chunk, "number": i, "key": key, "low": int(low[i]), "high": int(high[i])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((x for row in _rows(batches) for x in of(*row)), _SUSPECT)

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the lines whose key a smaller id has."""
    for n, size, text, ends, ids, rows, places, numbers, answers in _rows(batches):
        lines, owner = _unpacked(size, text, ends), np.frombuffer(ids, np.int64)
        dropped = np.zeros(len(lines.start), bool)
        if answers:
            at, number = np.frombuffer(places, np.int64), np.frombuffer(numbers, np.int64)
            least = np.full(int(number.max()) + 1, _MISSING)
            least[[a["number"] for a in answers]] = [a["least"] for a in answers]
            dropped[at] = least[number] < owner[lines.whose[at]]
        gone = np.bincount(lines.whose[dropped], minlength=n)
        stops, last = np.cumsum(lines.count), np.frombuffer(ends, np.int64).tolist()
        starts, ends_, kept = lines.start.tolist(), lines.stop.tolist(), []
        for i, (lost, stop) in enumerate(zip(gone.tolist(), stops.tolist())):
            if lost:
                stay = (np.flatnonzero(~dropped[stop - lines.count[i] : stop]) + stop - lines.count[i]).tolist()
                kept.append(b"\n".join([lines.data[starts[j] : ends_[j]] for j in stay]))
            else:
                kept.append(lines.data[last[i] : last[i + 1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner, mask=owner == _MISSING), pa.array(np.frombuffer(rows, np.int64)), pa.array(lines.count), pa.array(gone.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())], names=_KEPT.names
        )


def drop_repeats(docs: DataFrame, shortest: int = SHORTEST, text: str = "text", doc_id: str = "doc_id", row: str | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: doc_id, row, n_lines (before), n_dropped, kept (the text of the lines that stay, joined by line feeds).

    ``row`` names a column that numbers the rows; without it they are numbered as the scan yields them. An id that isn't a
    number ends in Spark's cast error.
    """
    prepare(docs.sparkSession)
    if shortest < 1:
        raise ValueError("shortest >= 1")
    size = docs.agg(F.sum(F.octet_length(docs[text])).alias("s")).first()["s"] or 0
    slices = max(1, -(-size // slice_bytes))
    number = docs[row] if row else F.monotonically_increasing_id()
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), number.alias("row"), docs[text].alias("text"))
    chunks = stored(rows.mapInArrow(_chunks, _CHUNK), "chunks")
    texts = chunks.select("chunk", "n", "size", "text", "ends", "ids")
    hashes = texts.mapInArrow(_hashed(shortest, slices), _HASHES).repartitionById(slices, F.col("slice")).select("chunk", "hashes")
    told = hashes.mapInArrow(_suspected, _TOLD).groupBy("chunk").agg(F.collect_list("hashes").alias("told"))
    suspects = stored(texts.join(told, "chunk").mapInArrow(_suspects(shortest), _SUSPECT), "suspects")
    keys = suspects.where("number is not null")
    repeats = keys.groupBy("key").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most")
    repeats = repeats.select(F.unhex(F.sha2("key", 256)).alias("digest"), "least")
    asks = keys.select("chunk", "number", "high", F.unhex(F.sha2("key", 256)).alias("digest"))
    answers = asks.join(repeats, "digest").where("high > least")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("number", "least")).alias("answers"))
    places = suspects.where("number is null").select("chunk", "lines", "numbers")
    whole = chunks.join(places, "chunk", "left").join(answers, "chunk", "left")
    return whole.select("n", "size", "text", "ends", "ids", "rows", "lines", "numbers", "answers").mapInArrow(_kept, _KEPT)
