"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

The split pattern is the public one for byte-level BPE (contractions, letters, numbers, other
signs, white space; see ``public_tokenizers.PATTERN``). It is a finite-state machine over classes of
code points once each sign knows what follows it. A transition function per position is composed
block by block (composition is associative), the blocks' functions are scanned, and a last pass with
known states marks where pieces begin. No regular expression runs.

Every text is a row of its own: no shuffle, no state between tasks, any task can be run again.
A null text is an empty text: no ids. An empty table gives an empty result. Other columns of the
input are ignored unless named in ``keep``.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.llm.cluster import binary_array, fresh, prepare, spans, text_bytes

# Classes of code points. The first five come from Unicode, the rest from what follows.
LETTER, NUMBER, SIGN, INNER, LAST_SPACE, LAST_OTHER, END_SPACE, SHORT, LONG = range(9)
RESET = 9  # added where a text begins
# States: after a finished piece, in letters, numbers, signs, white space, after a leading space, 1 or 2 letters left.
DONE, LETTERS, NUMBERS, SIGNS, SPACES, LEAD, ONE, TWO = range(8)
BLOCK = 64
#: Pieces up to this many bytes are merged together in arrays, longer ones with a heap.
SHORT_PIECE = 48
#: Pieces kept in a worker's cache before it starts anew.
CACHE_PIECES = 400_000
#: Bytes of text encoded at once, but for a longer text.
SLICE_BYTES = 2 << 20


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """next state and "a piece begins here", by class and state."""
    step = np.zeros((18, 8), np.uint8)
    begins = np.zeros((18, 8), bool)
    for state in range(8):
        for cls in range(9):
            if state in (ONE, TWO):  # the letters of a contraction
                step[cls, state], begins[cls, state] = (DONE if state == ONE else ONE), False
            elif cls in (LETTER, NUMBER, SIGN):
                run = {LETTER: LETTERS, NUMBER: NUMBERS, SIGN: SIGNS}[cls]
                step[cls, state], begins[cls, state] = run, state not in (run, LEAD)
            elif cls in (SHORT, LONG):  # an apostrophe with a contraction behind it counts only as a piece's first sign
                inside = state in (SIGNS, LEAD)
                step[cls, state], begins[cls, state] = (SIGNS if inside else ONE if cls == SHORT else TWO), not inside
            elif cls in (INNER, END_SPACE):
                step[cls, state], begins[cls, state] = SPACES, state != SPACES
            else:  # the last of a run of white space, with something behind it
                step[cls, state], begins[cls, state] = (LEAD if cls == LAST_SPACE else DONE), True
    step[RESET:], begins[RESET:] = step[:9, DONE][:, None], True
    return step, begins


STEP, BEGINS = _machine()


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, SIGN or INNER (white space) of each code point."""
    table = np.full(0x110000, SIGN, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    # The code points of the Unicode property White_Space.
    table[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = INNER
    return table


def piece_starts(points: np.ndarray, begins_text: np.ndarray) -> np.ndarray:
    """Mark the code points where a piece begins. ``begins_text`` marks where a text begins."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    base = code_point_classes()[points]
    cls = base.copy()
    after = np.zeros(n, np.uint32)  # the next code point of the same text, 0 where there is none
    after[:-1] = np.where(begins_text[1:], 0, points[1:])
    ends = np.ones(n, bool)
    ends[:-1] = begins_text[1:]
    # White space: does the run go on, end the text, or have something behind it?
    space = base == INNER
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~begins_text[1:]
    cls[last] = np.where(points[last] == 32, LAST_SPACE, LAST_OTHER)
    cls[space & ends] = END_SPACE
    # Apostrophes with a contraction behind them.
    at = np.flatnonzero(points == 39)
    if len(at):
        first = after[at]
        second = np.zeros(len(at), np.uint32)
        inside = at + 1 < n
        second[inside] = np.where(first[inside] > 0, after[np.minimum(at + 1, n - 1)[inside]], 0)
        short = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        long = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        cls[at[short]], cls[at[long]] = SHORT, LONG
    cls[begins_text] += RESET
    # The scan: compose the functions of each block, then those of the blocks, then walk with known states.
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, LETTER, np.uint8)
    grid[:n] = cls
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T).astype(np.int16) * 8
    flat, flags = STEP.ravel(), BEGINS.ravel()
    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for row in grid:
        whole = flat[row[:, None] + whole]
    reach = 1
    while reach < blocks:
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].copy(), axis=1)
        reach *= 2
    state = np.full(blocks, DONE, np.uint8)
    state[1:] = whole[:-1, DONE]
    out = np.empty((BLOCK, blocks), bool)
    for j, row in enumerate(grid):
        at = row + state
        out[j] = flags[at]
        state = flat[at]
    return out.T.ravel()[:n]


class Vocabulary:
    """Ranks, merges and a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.cache: dict[bytes, bytes] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def merge(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers: the lowest rank first, leftmost first."""
        out: list[bytes] = [b""] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > SHORT_PIECE or not len(self.keys):
                out[i] = self._merge_long(piece)
            else:
                rest.append(i)
        if not rest:
            return out
        sizes = np.array([len(pieces[i]) for i in rest])
        token = self.single[np.frombuffer(b"".join(pieces[i] for i in rest), np.uint8)]
        owner = np.repeat(np.arange(len(rest)), sizes)
        rank = np.full(len(token), NONE)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self.pair_ranks(token[inner], token[inner + 1])
        while len(token):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(token)])
            # Finished pieces leave.
            done = lowest == NONE
            if done.any():
                leaves = np.repeat(done, sizes)
                ids = token[leaves].astype("<u4").tobytes()
                at = 0
                for piece, size in zip(owner[first[done]].tolist(), (4 * sizes[done]).tolist()):
                    out[rest[piece]] = ids[at : at + size]
                    at += size
                stays = ~leaves
                token, owner, rank = token[stays], owner[stays], rank[stays]
                if not len(token):
                    break
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                lowest, sizes = lowest[~done], sizes[~done]
            hits = np.flatnonzero(rank == np.repeat(lowest, sizes))
            at = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]  # the leftmost of each piece
            token[at] = rank[at]
            stays = np.ones(len(token), bool)
            stays[at + 1] = False
            place = at - np.arange(len(at))  # one sign of each earlier piece is gone
            token, owner, rank = token[stays], owner[stays], rank[stays]
            for left in (place - 1, place):
                ok = (left >= 0) & (left + 1 < len(token))
                same = ok.copy()
                same[ok] = owner[left[ok]] == owner[left[ok] + 1]
                rank[left[same]] = self.pair_ranks(token[left[same]], token[left[same] + 1])
                alone = ok & ~same | (left == len(token) - 1)
                rank[left[alone]] = NONE
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """The same for one long piece: linked neighbours and a heap of pairs."""
        ranks, n = self.ranks, len(piece)
        ends = list(range(1, n + 1))  # of the part that begins here
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, right, end = heapq.heappop(heap)
            if not alive[left] or after[left] != right or right >= n or ends[right] != end:
                continue
            ends[left], after[left], alive[right] = end, after[right], False
            if after[left] < n:
                before[after[left]] = left
            for a, b in ((before[left], left), (left, after[left])):
                if a >= 0 and b < n and (r := ranks.get(piece[a : ends[b]])) is not None:
                    heapq.heappush(heap, (r, a, b, ends[b]))
        return b"".join(ranks[piece[i : ends[i]]].to_bytes(4, "little") for i in range(n) if alive[i])

    def encode(self, data: bytes, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of each text, byte offsets of all pieces, and how many pieces each text has."""
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        place = np.cumsum(width) - width  # of each code point, in bytes
        starts_text = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins_text = np.zeros(len(points), bool)
        begins_text[np.searchsorted(place, starts_text)] = True
        at = place[piece_starts(points, begins_text)]
        cuts = at.tolist() + [len(data)]
        pieces = [data[a:b] for a, b in pairwise(cuts)]
        cache = self.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        missing = list(set(pieces).difference(cache))
        for i in range(0, len(missing), 50_000):
            part = missing[i : i + 50_000]
            cache.update(zip(part, self.merge(part)))
        ids = list(map(cache.__getitem__, pieces))
        ends = np.searchsorted(at, offsets)
        return [b"".join(ids[a:b]) for a, b in pairwise(ends.tolist())], at, np.diff(ends)

    def decode(self, ids: np.ndarray, pieces: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``size`` bytes of all ids, and the place of each id in them with the end last.

        ``pieces`` are the byte offsets that encoding retained: the bytes of a piece lie at its offset, or it is a ValueError.
        """
        lengths = self.lengths[ids]
        at = np.r_[0, np.cumsum(lengths)]
        begins = np.zeros(size + 1, bool)
        begins[at[at <= size]] = True
        if at[-1] != size or len(pieces) and (pieces[0] != 0 or not begins[pieces].all()):
            raise ValueError("the ids don't decode to the pieces that were encoded")
        return self.flat[spans(self.starts[ids], lengths)], at


NONE = np.int64(1) << 62


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(read_ranks(path))


def encode_decode(docs: DataFrame, ranks_path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), offsets: bool = True) -> DataFrame:
    """Encode each text and decode it again.

    Returns the ``keep`` columns and ``ids`` (binary, little-endian unsigned 32-bit integers), ``decoded``
    (binary; the offsets of the pieces are checked on the way) and, with ``offsets``, ``piece_offsets`` (array of
    int: the byte where each piece begins).
    ``ranks_path`` must name a file that every executor has. Names of ``keep`` that clash with the new
    columns raise a ValueError.
    """
    prepare(docs.sparkSession)
    new = ["ids", "decoded", *["piece_offsets"] * offsets]
    twice = {c.lower() for c in keep} & set(new)
    if twice:
        raise ValueError(f"columns {sorted(twice)} would come twice")
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())] + [T.StructField("piece_offsets", T.ArrayType(T.IntegerType()))] * offsets)
    kept = list(keep)

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocab = vocabulary(ranks_path)
        data, ends = text_bytes(batch.column(len(kept)))
        ids, places, counts = vocab.encode(data, ends)
        sizes = np.array([len(x) for x in ids], np.int64)
        joined = b"".join(ids)
        decoded, at = vocab.decode(np.frombuffer(joined, "<u4").astype(np.int64), places, len(data))
        id_ends = np.r_[0, np.cumsum(sizes)]
        columns = [*(batch.column(i) for i in range(len(kept))), binary_array(joined, id_ends), binary_array(decoded, at[id_ends // 4])]
        if offsets:
            inside = places - np.repeat(ends[:-1], counts)
            columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(inside.astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, names=kept + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = text_bytes(batch.column(len(kept)))[1]
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1)
                yield encoded(batch.slice(start, stop - start))
                start = stop

    return docs.select(*kept, docs[text].alias(*fresh(kept, "__text"))).mapInArrow(run, schema)
