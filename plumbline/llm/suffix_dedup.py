"""Removal of repeated passages over a collection's Burrows-Wheeler transform.

A byte goes when a string of ``width`` bytes covers it that also starts in a document with a smaller id;
overlaps count, and strings are judged on the input. Texts are UTF-8 bytes, matches never cross documents.

Each string of ``width`` bytes is keyed by the least hash of its ``GRAM``-byte grams. Equal strings have equal
keys, and neighbours mostly share theirs, so a document falls into runs: short strings of a few windows.
Keys found in one document only can't hold a match and go no further. The strings of shared keys meet in a
bucket by key, where ``column_bwt`` builds the transform and the common prefixes of the bucket's collection,
one symbol of each string per round; suffixes with a common prefix of ``width`` are one class, and the
smallest id in it goes back to where the strings came from.

Steps, and what travels:
1. Chunks (an Arrow batch of documents, compressed) are stored.
2. The keys they hold, 8 bytes each, meet by bucket; each chunk hears which of its keys another document shares.
3. Each chunk sends the different strings of these keys with their smallest id: copies within a chunk travel once.
4. Buckets answer with the smallest ids, run-length coded. Windows whose hash no other string has are answered at once; of the
   strings the rest, each piece once, enters a collection.
5. Each chunk marks what is covered and cuts it out.

A key that more than ``hot`` chunks share (a passage in very many documents, whose edges differ) is dealt by the
single windows instead, each to a bucket of its own hash. Row and bucket sizes are bounded by the chunk size
and by the bytes of the corpus; the driver sees one number, the corpus' size. Nothing is sampled or capped.

A null text is empty. A missing id is larger than all others; documents of equal id don't cover one another.
Other columns are ignored; an empty table gives no rows.
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

from plumbline.llm.cluster import binary_array, prepare, spans, stored, text_bytes
from plumbline.llm.column_bwt import least_owner

WIDTH, GRAM = 50, 20
#: Bytes of text per bucket, on the corpus as a whole.
BUCKET_BYTES = 16 << 20
HOT_CHUNKS = 1024
#: Strings of a bucket enter collections of about this many symbols.
COLLECTION = 1 << 20
#: Windows whose keys are made at once.
SLICE = 1 << 15
#: Windows that a run keeps; longer runs are cut.
RUN = 31

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_MISSING = np.iinfo(np.int64).max
_LAST = np.uint64(1)


def gram_hashes(signs: np.ndarray, size: int) -> np.ndarray:
    """A mixed 64-bit hash of each ``size`` bytes; doubling joins the hashes of neighbours."""
    part, length, power = signs + np.uint64(1), 1, _ODD
    whole, done, bits = None, 0, size
    with np.errstate(over="ignore"):
        while True:
            if bits & 1:
                if whole is None:
                    whole, done = part, length
                else:
                    n = len(whole) - length
                    whole = whole[:n] * power + part[done : done + n]
                    done += length
            bits >>= 1
            if not bits:
                break
            n = len(part) - length
            part = part[:n] * power + part[length:]
            power, length = power * power, 2 * length
        whole = whole ^ (whole >> np.uint64(29))
        whole *= _MIX
        whole ^= whole >> np.uint64(32)
    return whole


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    if reach < width:
        values = np.minimum(values[: -(width - reach)], values[width - reach :])
    return values


def window_keys(signs: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The least gram hash of each ``width`` bytes; some thousand at a time, which a core's cache holds."""
    out = np.empty(max(0, len(signs) - width + 1), np.uint64)
    for start in range(0, len(out), SLICE):
        part = signs[start : start + SLICE + width - 1].astype(np.uint64)
        out[start : start + SLICE] = least_of(gram_hashes(part, gram), width - gram + 1)
    return out


def runs(data: bytes, ends: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Key (last bit clear), first byte, windows and text of each run of windows with one key, RUN windows at most."""
    keys = window_keys(np.frombuffer(data, np.uint8), width, gram)
    n = len(keys)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A run begins where the key changes, where a text begins, and where no whole window is left of it.
    first = np.ones(n, bool)
    first[1:] = keys[1:] != keys[:-1]
    for edges in (ends[:-1], np.maximum(ends[1:] - width + 1, ends[:-1])):
        first[edges[edges < n]] = True
    start = np.flatnonzero(first)
    length = np.diff(np.r_[start, n])
    text = np.searchsorted(ends[1:], start, side="right")
    whole = start + width <= ends[np.minimum(text + 1, len(ends) - 1)]
    start, length = start[whole], length[whole]
    pieces = -(-length // RUN)
    number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(start, pieces) + number * RUN
    size = np.minimum(np.repeat(length, pieces) - number * RUN, RUN)
    return keys[begin] & ~_LAST, begin, size, np.searchsorted(ends[1:], begin, side="right")


def _pack(array: np.ndarray) -> bytes:
    return pa.compress(array.tobytes(), "zstd", asbytes=True) if len(array) else b""


def _unpack(blob: bytes, count: int, dtype) -> np.ndarray:
    size = count * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(blob, size, "zstd", asbytes=True) if count else b"", dtype)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _INT, _BYTES = T.LongType(), T.IntegerType(), T.BinaryType()
#: A chunk's documents.
_CHUNK = _schema(chunk=_LONG, n=_LONG, size=_LONG, text=_BYTES, ends=_BYTES, ids=_BYTES, rows=_BYTES)
#: The keys that a chunk has in a bucket, and those that another document shares.
_HELD = _schema(chunk=_LONG, bucket=_INT, keys=_BYTES)
_KEYS = _schema(chunk=_LONG, keys=_BYTES)
#: Of a chunk: where its strings stand (bucket null), or its different strings in a bucket.
_STRINGS = _schema(chunk=_LONG, bucket=_INT, n=_LONG, text=_LONG, at=_BYTES, sizes=_BYTES, strings=_BYTES, owners=_BYTES)
_ANSWER = _schema(chunk=_LONG, bucket=_INT, n=_LONG, n_strings=_LONG, counts=_BYTES, sizes=_BYTES, owners=_BYTES)


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


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bucket, and (bucket, from, to) in it."""
    order = np.argsort(bucket, kind="stable")
    sorted_ = bucket[order]
    cuts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]).tolist() + [len(sorted_)] if len(sorted_) else [0]
    return order, [(int(sorted_[a]), a, b) for a, b in zip(cuts, cuts[1:])]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32

    def rows() -> Iterator[dict]:
        for chunk, batch in enumerate((b for b in batches if b.num_rows), first):
            data, ends = text_bytes(batch.column(2))
            ids = batch.column(0).fill_null(_MISSING).to_numpy()
            yield {"chunk": chunk, "n": len(ids), "size": len(data), "text": pa.compress(data, "zstd", asbytes=True), "ends": _pack(ends), "ids": _pack(ids), "rows": _pack(batch.column(1).to_numpy())}

    yield from _batches(rows(), _CHUNK)


def _held(width: int, gram: int, buckets: int):
    """The different keys of a chunk, by bucket; the last bit marks those that two of its documents have."""

    def of(chunk: int, n: int, size: int, text: bytes, ends: bytes, ids: bytes) -> Iterator[dict]:
        data = pa.decompress(text, size, "zstd", asbytes=True)
        ids_ = _unpack(ids, n, np.int64)
        keys, _, _, whose = runs(data, _unpack(ends, n + 1, np.int64), width, gram)
        if not len(keys):
            return
        order = np.argsort(keys)
        keys, owner = keys[order], ids_[whose[order]]
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        shared = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
        keys = keys[heads] | shared.astype(np.uint64)
        order, parts = _by_bucket((keys >> _LAST) % np.uint64(buckets))
        keys = keys[order]
        for bucket, a, b in parts:
            yield {"chunk": chunk, "bucket": bucket, "keys": keys[a:b].tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((row for batch in batches for i in range(batch.num_rows) for row in of(*(c[i].as_py() for c in batch.columns))), _HELD)

    return run


def _shared(hot: int):
    """Keys of a bucket: tell each chunk which are shared; the last bit marks the hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, blobs = [], []
        for batch in batches:
            chunks += batch.column(0).to_pylist()
            blobs += batch.column(1).to_pylist()
        if not blobs:
            return
        keys = np.frombuffer(b"".join(blobs), np.uint64)
        whose = np.repeat(np.arange(len(blobs), dtype=np.uint32), [len(b) // 8 for b in blobs])
        del blobs
        order = np.argsort(keys)
        keys, whose = keys[order], whose[order]
        bare = keys & ~_LAST
        heads = np.flatnonzero(np.r_[True, bare[1:] != bare[:-1]])
        count = np.diff(np.r_[heads, len(bare)])
        stays = np.repeat((count > 1) | np.maximum.reduceat(keys & _LAST, heads).astype(bool), count)
        told = (bare | np.repeat(count > hot, count))[stays]
        order, parts = _by_bucket(whose[stays])
        told = told[order]
        yield from _batches(({"chunk": chunks[i], "keys": told[a:b].tobytes()} for i, a, b in parts), _KEYS)

    return run


def _strings(width: int, gram: int, buckets: int):
    """The different strings of a chunk's shared keys, by bucket, and where they stand."""

    def of(chunk: int, n: int, size: int, text: bytes, ends: bytes, ids: bytes, told: list[bytes]) -> Iterator[dict]:
        data = pa.decompress(text, size, "zstd", asbytes=True)
        owner = _unpack(ids, n, np.int64)
        keys, at, length, whose = runs(data, _unpack(ends, n + 1, np.int64), width, gram)
        told_keys = np.sort(np.frombuffer(b"".join(told), np.uint64))
        bare = told_keys & ~_LAST
        place = np.minimum(np.searchsorted(bare, keys), len(bare) - 1)
        found = np.flatnonzero(bare[place] == keys)
        hot = (told_keys[place[found]] & _LAST).astype(bool)
        # Runs of hot keys become single windows.
        pieces = np.where(hot, length[found], 1)
        run = np.repeat(found, pieces)
        begin = spans(at[found], pieces)
        single = np.repeat(hot, pieces)
        size_of = np.where(single, 1, length[run]) + width - 1
        cut = [data[a : a + s] for a, s in zip(begin.tolist(), size_of.tolist())]
        number: dict[bytes, int] = {}
        which = np.fromiter((number.setdefault(s, len(number)) for s in cut), np.int64, len(cut))
        texts = list(number)
        least = np.full(len(texts), _MISSING)
        np.minimum.at(least, which, owner[whose[run]])
        bucket = np.zeros(len(texts), np.uint64)
        bucket[which] = (keys[run] >> _LAST) % np.uint64(buckets)
        for i in np.unique(which[single]).tolist():
            bucket[i] = xxhash.xxh64_intdigest(texts[i]) % buckets
        order, parts = _by_bucket(bucket)
        new = np.empty(len(texts), np.int64)
        new[order] = np.arange(len(texts))
        yield {"chunk": chunk, "n": len(which), "text": len(texts), "at": _pack(begin), "sizes": _pack(whose[run].astype(np.uint32)), "strings": _pack(new[which].astype(np.uint32))}
        for number_, a, b in parts:
            mine = [texts[i] for i in order[a:b].tolist()]
            joined = b"".join(mine)
            yield {
                "chunk": chunk, "bucket": number_, "n": len(mine), "text": len(joined), "sizes": _pack(np.array([len(x) for x in mine], np.uint8)),
                "strings": pa.compress(joined, "zstd", asbytes=True), "owners": _pack(least[order[a:b]]),
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((row for batch in batches for i in range(batch.num_rows) for row in of(*(c[i].as_py() for c in batch.columns))), _STRINGS)

    return run


def _classes(width: int, gram: int):
    """Answer each chunk's strings with the smallest id of each window, as runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        senders, sent, number = [], [], {}
        least: list[int] = []
        for batch in batches:
            for chunk, bucket, n, size, sizes, strings, owners in zip(*(c.to_pylist() for c in batch.columns)):
                joined = pa.decompress(strings, size, "zstd", asbytes=True)
                to = np.cumsum(_unpack(sizes, n, np.uint8), dtype=np.int64)
                which = np.empty(n, np.uint32)
                a = 0
                for i, (b, owner) in enumerate(zip(to.tolist(), _unpack(owners, n, np.int64).tolist())):
                    j = number.setdefault(joined[a:b], len(least))
                    if j == len(least):
                        least.append(owner)
                    elif owner < least[j]:
                        least[j] = owner
                    which[i] = j
                    a = b
                senders.append((chunk, bucket))
                sent.append(which)
        if not sent:
            return
        texts, owner = list(number), np.array(least, np.int64)
        del number, least
        counts, sizes, owners = _answers(texts, owner, width, gram)
        first = np.cumsum(counts) - counts

        def rows() -> Iterator[dict]:
            for (chunk, bucket), which in zip(senders, sent):
                mine = counts[which]
                at = spans(first[which], mine)
                yield {"chunk": chunk, "bucket": bucket, "n": int(mine.sum()), "n_strings": len(which), "counts": _pack(mine.astype(np.uint8)), "sizes": _pack(sizes[at].astype(np.uint8)), "owners": _pack(owners[at])}

        yield from _batches(rows(), _ANSWER)

    return run


def _twice(joined: bytes, sizes: np.ndarray, width: int) -> np.ndarray:
    """For each window of each string, whether another string may have it: equal windows have equal hashes."""
    windows = sizes - width + 1
    whose = np.repeat(np.arange(len(sizes), dtype=np.uint64), windows)
    starts = spans(np.cumsum(sizes) - sizes, windows)
    signs, hashes = np.frombuffer(joined, np.uint8), np.empty(len(starts), np.uint64)
    for low in range(0, len(signs) - width + 1, SLICE):
        part = gram_hashes(signs[low : low + SLICE + width - 1].astype(np.uint64), width)
        i, j = np.searchsorted(starts, (low, low + len(part)))
        hashes[i:j] = part[starts[i:j] - low]
    # The upper bits of the hash above the string's number: neighbours of one hash and two numbers are found by one sort.
    bits = np.uint64(max(1, int(len(sizes)).bit_length()))
    hashes >>= bits
    pairs = np.sort(hashes << bits | whose)
    above = pairs >> bits
    shared = np.unique(above[1:][(above[1:] == above[:-1]) & (pairs[1:] != pairs[:-1])])
    return shared[np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)] == hashes if len(shared) else np.zeros(len(hashes), bool)


def _answers(texts: list[bytes], owner: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of equal least owners: how many each string has, windows of each, owner of each.

    A window whose hash no other string has is its own owner's. What is left of the strings, each piece once, enters collections,
    which are made of whole keys: the least gram of a piece's first window says which.
    """
    sizes = np.array([len(s) for s in texts], np.int64)
    windows = sizes - width + 1
    whose = np.repeat(np.arange(len(texts)), windows)
    flat = owner[whose]
    maybe = _twice(b"".join(texts), sizes, width)
    if maybe.any():
        # Pieces: runs of such windows within a string.
        edges = np.flatnonzero(np.r_[True, (whose[1:] != whose[:-1]) | (maybe[1:] != maybe[:-1]), True])
        first, stop = edges[:-1][maybe[edges[:-1]]], edges[1:][maybe[edges[:-1]]]
        text = whose[first]
        at = first - (np.cumsum(windows) - windows)[text]
        cut = [texts[t][a : a + n] for t, a, n in zip(text.tolist(), at.tolist(), (stop - first + width - 1).tolist())]
        number: dict[bytes, int] = {}
        which = np.fromiter((number.setdefault(s, len(number)) for s in cut), np.int64, len(cut))
        least = np.full(len(number), _MISSING)
        np.minimum.at(least, which, owner[text])
        found, begin = _least_windows(list(number), least, width, gram)
        flat[spans(first, stop - first)] = found[spans(begin[which], stop - first)]
    heads = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (whose[1:] != whose[:-1])])
    return np.bincount(whose[heads], minlength=len(texts)), np.diff(np.r_[heads, len(flat)]), flat[heads]


def _least_windows(texts: list[bytes], owner: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The least owner of each window, string by string, and where each string's begin."""
    parts = -(-sum(map(len, texts)) // COLLECTION)
    windows = np.array([len(s) - width + 1 for s in texts], np.int64)
    where = np.cumsum(windows) - windows
    if parts <= 1:
        return least_owner(texts, owner, width), where
    heads = b"".join(s[:width] for s in texts)
    key, _, _, _ = runs(heads, np.arange(0, len(heads) + 1, width), width, gram)
    flat = np.empty(int(windows.sum()), np.int64)
    order, cuts = _by_bucket((key >> np.uint64(20)) % np.uint64(parts))
    for _, a, b in cuts:
        mine = order[a:b]
        flat[spans(where[mine], windows[mine])] = least_owner([texts[i] for i in mine.tolist()], owner[mine], width)
    return flat, where


def _before(marks: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """How many marks stand before each stop."""
    return np.r_[np.int32(0), np.cumsum(marks, dtype=np.int32)][stops].astype(np.int64)


def _removed(width: int):
    fields = _schema(doc_id=_LONG, row=_LONG, n_bytes=_LONG, n_removed=_LONG, n_spans=_LONG, kept=_BYTES, kept_text=T.StringType())

    def of(n: int, size: int, text: bytes, ends: bytes, ids: bytes, rows: bytes, placed: int | None, at: bytes, texts: bytes, strings: bytes, answers: list) -> pa.RecordBatch:
        data = pa.decompress(text, size, "zstd", asbytes=True) if size else b""
        stops, owner = _unpack(ends, n + 1, np.int64), _unpack(ids, n, np.int64)
        change = np.zeros(size + 1, np.int32)
        if placed:
            answers = sorted(answers, key=lambda a: a["bucket"])
            known = [_unpack(a["owners"], a["n"], np.int64) for a in answers]
            sizes = np.concatenate([_unpack(a["sizes"], a["n"], np.uint8) for a in answers]).astype(np.int64)
            least = np.concatenate(known)
            counts = np.concatenate([_unpack(a["counts"], a["n_strings"], np.uint8) for a in answers]).astype(np.int64)
            begin = _unpack(at, placed, np.int64)
            whose = _unpack(texts, placed, np.uint32)
            which = _unpack(strings, placed, np.uint32)
            first = np.cumsum(counts) - counts
            before = np.cumsum(sizes) - sizes  # windows before each run, over all strings
            each = counts[which]
            run = spans(first[which], each)
            low = np.repeat(begin, each) + before[run] - np.repeat(before[first[which]], each)
            goes = least[run] < np.repeat(owner[whose], each)
            low, high = low[goes], (low + sizes[run] + width - 1)[goes]
            np.add.at(change, low, 1)
            np.subtract.at(change, high, 1)
        signs = np.frombuffer(data, np.uint8)
        gone = np.cumsum(change, dtype=np.int32, out=change)[:-1] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = stops[:-1][stops[:-1] < size]
        begins[inner] = gone[inner]  # a span ends with its document
        removed, spans_before = _before(gone, stops), _before(begins, stops)
        kept = signs[~gone]
        # As text: a code point that lost a byte goes whole.
        point = np.cumsum((signs & 0xC0) != 0x80, dtype=np.int32)
        hurt = np.zeros(int(point[-1]) + 1 if size else 1, bool)
        hurt[point[gone]] = True
        broken = hurt[point]
        kept_text = pa.Array.from_buffers(pa.string(), n, binary_array(signs[~broken], stops - _before(broken, stops)).buffers())
        missing = owner == _MISSING
        return pa.RecordBatch.from_arrays(
            [pa.array(owner, mask=missing), pa.array(_unpack(rows, n, np.int64)), pa.array(np.diff(stops)), pa.array(np.diff(removed)), pa.array(np.diff(spans_before)), binary_array(kept, stops - removed), kept_text],
            names=fields.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield of(*(c[i].as_py() for c in batch.columns))

    return run, fields


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id", row: str | None = None, hot: int = HOT_CHUNKS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, row, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary: the bytes that stay), kept_text (the whole code points among them)."""
    prepare(docs.sparkSession)
    if not 1 <= gram <= width <= 200:
        raise ValueError("1 <= gram <= width <= 200")
    size = docs.agg(F.sum(F.octet_length(text)).alias("s")).first()["s"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    number = docs[row] if row else F.monotonically_increasing_id()
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), number.alias("row"), docs[text].alias("text"))
    chunks = stored(rows.mapInArrow(_chunks, _CHUNK), "chunks")
    texts = chunks.select("chunk", "n", "size", "text", "ends", "ids")
    keys = texts.mapInArrow(_held(width, gram, buckets), _HELD).repartitionById(buckets, F.col("bucket")).select("chunk", "keys")
    told = keys.mapInArrow(_shared(hot), _KEYS).groupBy("chunk").agg(F.collect_list("keys").alias("told"))
    heard = texts.join(told, "chunk")
    strings = stored(heard.mapInArrow(_strings(width, gram, buckets), _STRINGS), "strings")
    sent = strings.where("bucket is not null").select("chunk", "bucket", "n", "text", "sizes", "strings", "owners").repartitionById(buckets, F.col("bucket"))
    answers = sent.mapInArrow(_classes(width, gram), _ANSWER).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "n_strings", "counts", "sizes", "owners")).alias("answers"))
    places = strings.where("bucket is null").select("chunk", F.col("n").alias("placed"), "at", F.col("sizes").alias("texts"), "strings")
    all_ = chunks.join(places, "chunk", "left").join(answers, "chunk", "left").drop("chunk")
    run, fields = _removed(width)
    return all_.mapInArrow(run, fields)
