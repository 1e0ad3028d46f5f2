"""Packing: concatenate all documents and cut every ``width`` ids.

Pass 1 tokenises each partition, numbers its ids from 0 and stores them. The partitions' totals, a row
each, become global offsets by a prefix sum. Pass 2 adds the offset and cuts each document at multiples of
the width, without a shuffle; a piece that doesn't fill a sequence is a boundary record, and ``sequences``
brings the pieces of a sequence together. Only the last sequence is short, so nothing else is padding.

The tokenizer never joins what white space parts, so each distinct word is encoded once per worker and cache; texts are
split into words, and these numbered, by Arrow kernels, and the merges of many words are done at once. That shortcut holds for
texts of Latin letters and the signs among them; any other text, and any with a special token's string, goes through the
tokenizer whole.

A null or empty text is its end id alone. Rows that repeat an id are documents of their own. An empty table
gives no pieces. The order is that of the stored table's partitions and rows, hence a lost task
cuts the same pieces again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import binary_array, prepare, spans, stored

#: The strings that the tokenizer file adds as special tokens.
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
#: Texts with more than this take the tokenizer itself: letters of later blocks (and U+0130) may be cased or composed otherwise,
#: and the separators from U+001C don't part words for it.
OTHER = r"[^\x00-\x1b\x20-\x{12f}\x{131}-\x{24f}\x{2010}-\x{2026}\x{20ac}]|" + "|".join(s.replace("|", r"\|") for s in SPECIAL)
#: Fixed value: the tokenizer file's own pattern for words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Letters, and signs of ASCII that may stand behind them.
SHAPE = r"^(?P<letters>\p{L}+)(?P<signs>[!-/:-@\[-`{-~]*)$"
#: Words that a worker remembers.
CACHE_WORDS = 500_000
#: Bytes of a part that is merged beside others; a longer one goes through the tokenizer.
LONG_WORD = 64
NONE = np.int32(1 << 30)
#: Words that are merged at once.
SOME = 8_192
#: Bytes of text whose words are split and numbered at once.
GROUP_BYTES = 8 << 20
#: Rows of partition totals that may be broadcast, 16 bytes each.
BROADCAST_PARTS = 200_000


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Merges:
    """Pair merging of many words at once: in each the pair of lowest rank, the leftmost first."""

    def __init__(self, vocabulary: dict[str, int], merges: list[list[str]]):
        signs = _byte_signs()
        self.inner = np.array([vocabulary[c] for c in signs], np.int64)
        self.final = np.array([vocabulary[c + "</w>"] for c in signs], np.int64)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, none of them empty, after one another, and how many each has; some thousand at a time, which a core's cache holds."""
        found = [self._some(words[i : i + SOME]) for i in range(0, len(words), SOME)]
        return np.concatenate([np.zeros(0, "<u4"), *(f[0] for f in found)]), np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])

    def _some(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        token, owner = self.inner[raw], np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        ends = np.cumsum(sizes) - 1
        token[ends] = self.final[raw[ends]]
        # Of each token: the rank of the pair that it begins.
        rank = np.full(len(token), NONE)
        rank[:-1] = self._ranks(token[:-1], token[1:])
        rank[ends] = NONE
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(token):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, first)
            count = np.diff(np.r_[first, len(token)])
            goes = np.repeat(least < NONE, count)
            if not goes.all():
                done.append((owner[~goes], token[~goes]))
                token, owner, rank = token[goes], owner[goes], rank[goes]
                least, count = least[least < NONE], count[least < NONE]
            hits = np.flatnonzero(rank == np.repeat(least, count))
            if not len(hits):
                break
            at = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            token[at] = self.merged[rank[at]]
            rank[at] = NONE
            stays = np.ones(len(token), bool)
            stays[at + 1] = False
            place = at - np.arange(len(at))
            token, owner, rank = token[stays], owner[stays], rank[stays]
            right = place[(place + 1 < len(token)) & (owner[np.minimum(place + 1, len(owner) - 1)] == owner[place])]
            rank[right] = self._ranks(token[right], token[right + 1])
            left = place[(place > 0) & (owner[place - 1] == owner[place])] - 1
            rank[left] = self._ranks(token[left], token[left + 1])
        whose = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int32)
        ids = np.concatenate([t for _, t in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(whose, kind="stable")
        return ids[order].astype("<u4"), np.bincount(whose, minlength=len(words))


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        with open(path) as f:
            model = json.load(f)["model"]
        self.merges = Merges(model["vocab"], model["merges"])
        self.clear()

    def clear(self) -> None:
        """Forget all words. Of word number i, ``flat`` has ``count[i]`` ids from ``start[i]``."""
        self.words, self.flat = pa.array([], pa.large_string()), np.zeros(0, "<u4")
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: pa.Array) -> None:
        """Encode words that aren't known, each different part of them once."""
        if not len(words):
            return
        # Most words are letters, or letters and signs behind them; the others are cut by the tokenizer's own pattern.
        shape = pc.extract_regex(words, SHAPE)
        odd = shape.is_null().to_numpy(zero_copy_only=False)
        cut = [WORDS.findall(w) for w in words.filter(pa.array(odd)).to_pylist()]
        letters, signs = (shape.field(i).filter(pa.array(~odd)) for i in (0, 1))
        count = np.empty(len(words), np.int64)
        count[odd] = [len(c) for c in cut]
        count[~odd] = 1 + pc.greater(pc.binary_length(signs), 0).cast(pa.int64()).to_numpy()
        first = np.cumsum(count) - count
        # Parts in the order of their words.
        at = np.empty(int(count.sum()), np.int64)
        two = count[~odd] == 2
        places = [first[~odd], first[~odd][two] + 1, spans(first[odd], count[odd])]
        at[np.concatenate(places)] = np.arange(len(at))
        listed = [letters, signs.filter(pa.array(two)), pa.array([x for c in cut for x in c], pa.large_string())]
        parts = pa.concat_arrays([x.cast(pa.large_string()) for x in listed]).dictionary_encode()
        which = parts.indices.to_numpy()[at]
        texts = [x.encode() for x in parts.dictionary.to_pylist()]
        short = [i for i, x in enumerate(texts) if len(x) <= LONG_WORD]
        ids, counts = self.merges([texts[i] for i in short])
        if len(short) < len(texts):  # a long one has too many rounds
            found: list = [None] * len(texts)
            for i, x in zip(short, np.split(ids, np.cumsum(counts)[:-1])):
                found[i] = x
            rest = [i for i, x in enumerate(found) if x is None]
            for i, x in zip(rest, self.whole([texts[i].decode() for i in rest])):
                found[i] = np.frombuffer(x, "<u4")
            ids, counts = np.concatenate(found), np.array([len(x) for x in found], np.int64)
        # The ids of a word are those of its parts, which stand anywhere.
        per_part = counts[which]
        total = np.diff(np.r_[0, np.cumsum(per_part)][np.r_[first, len(which)]])
        start = len(self.flat) + np.cumsum(total) - total
        self.flat = np.concatenate([self.flat, ids[spans((np.cumsum(counts) - counts)[which], per_part)]])
        self.start, self.count = np.r_[self.start, start], np.r_[self.count, total]
        self.words = pa.concat_arrays([self.words, words])

    def known(self, words: pa.Array) -> np.ndarray:
        """The numbers of some different words; new ones are learned."""
        if len(self.words) > CACHE_WORDS:
            self.clear()
        found = pc.index_in(words, value_set=self.words)
        self.learn(words.filter(found.is_null()))
        place = found.fill_null(-1).to_numpy().astype(np.int64)
        new = place < 0
        place[new] = np.arange(len(self.words) - new.sum(), len(self.words))
        return place

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, each with the end id behind it, and how many each has.

        Words are split and numbered by Arrow; each different word of the batch is looked up once, and its ids are gathered.
        """
        texts = texts.fill_null("")
        whole = pc.match_substring_regex(texts, OTHER).to_numpy(zero_copy_only=False)
        # A text that goes whole has no words here; its ids take the place of one.
        words = pc.utf8_split_whitespace(pc.utf8_lower(pc.if_else(pa.array(whole), "", texts)))
        flat, cuts = words.flatten().dictionary_encode(), words.offsets.to_numpy()
        places = self.known(flat.dictionary)[flat.indices.to_numpy()]
        start, count = self.start[places], self.count[places]
        ids = self.flat[spans(start, count)]
        stops = np.r_[0, np.cumsum(count)][cuts - cuts[0]]
        n = np.diff(stops)
        if whole.any():
            at = np.flatnonzero(whole).tolist()
            others = self.whole([texts[i].as_py() for i in at])
            pieces = np.split(ids, stops[1:-1])
            for i, found in zip(at, others):
                pieces[i] = np.frombuffer(found, "<u4")
                n[i] = len(pieces[i])
            ids = np.concatenate(pieces)
        return np.insert(ids, np.cumsum(n), np.uint32(end_id)), n + 1


@lru_cache(2)
def tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    return WordTokenizer(path)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches of about ``GROUP_BYTES`` together."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(1).nbytes
        if size >= GROUP_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def tokenized(docs: DataFrame, path: str, end_id: int = 1, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pass 1, stored: doc_id, ids (binary), n, part, and at: ids before the document in its partition."""
    prepare(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("part", T.LongType()), T.StructField("at", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, at = tokenizer(path), TaskContext.get().partitionId(), 0
        for group in _grouped(batches):
            ids, n = words.encode(pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in group]), end_id)
            doc = pa.concat_arrays([b.column(0) for b in group])
            ends = np.r_[0, np.cumsum(n)]
            yield pa.RecordBatch.from_arrays(
                [doc, binary_array(ids, 4 * ends), pa.array(n), pa.array(np.full(len(n), part)), pa.array(at + ends[:-1])], names=["doc_id", "ids", "n", "part", "at"]
            )
            at += int(ends[-1])

    return stored(docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema), "ids")


def pack(docs: DataFrame, path: str, width: int = 2048, end_id: int = 1, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary), boundary.

    ``start`` counts the document's ids before the piece, ``offset`` those of the sequence before it;
    ``boundary`` is false where the piece fills its sequence.
    """
    ids = tokenized(docs, path, end_id, text, doc_id)
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("part", before.alias("before"))
    parts = totals.count()
    placed = ids.join(F.broadcast(offsets) if parts <= BROADCAST_PARTS else offsets, "part").select("doc_id", "ids", "n", (F.col("before") + F.col("at")).alias("begin"))
    fields = [("doc_id", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()), ("ids", T.BinaryType()), ("boundary", T.BooleanType())]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, begin = (batch.column(i).to_numpy() for i in (2, 3))
            first, last = begin // width, (begin + n - 1) // width
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            sequence = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
            low = np.maximum(begin[row], sequence * width)
            high = np.minimum((begin + n)[row], (sequence + 1) * width)
            data = batch.column(1)
            ends = 4 * np.r_[0, np.cumsum(high - low)]
            base = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, data.offset * 4)
            flat = data.buffers()[2][int(base[0]) : int(base[-1])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), pa.array(low - begin[row]), pa.array(high - low), pa.array(n[row]), pa.array(sequence),
                    pa.array(low - sequence * width), binary_array(flat, ends), pa.array(high - low < width),
                ],
                names=[f[0] for f in fields],
            )

    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, width: int = 2048) -> DataFrame:
    """One row per sequence: sequence_id, length, ids (binary, unpadded), doc_ids, starts. A group has ``width`` ids at most."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    rows = pieces.groupBy("sequence_id").agg(joined.alias("p"))
    ids = F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return rows.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("length"), ids.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))

