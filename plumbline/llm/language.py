"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text answers how far a text can go on
as a substring of the sample. A text is parsed into the longest such matches; the phrases it needs, times the
logarithm of the sample's length and over the text's length, estimate its cross entropy to the language in
bits per sign. The language that needs least wins.

All signs of a text count. So that arrays can step through many texts at once, parsing starts anew every
``LANE`` signs, which adds the same phrase for each language. Signs are lower-cased; what is no letter is
one class, letters that no sample has are another and always end a phrase. Each letter of the samples is a class
of its own, however many there are: transitions are kept sparsely.

Learning: ``SAMPLE_ROWS`` rows per language, chosen by a hash of their id, whose text is joined up to
``SAMPLE_CHARS`` signs; of a row of over ``SAMPLE_ROW_CHARS`` signs a piece of so many, at a place by a hash of
its id. These bounds are all that limits what is learned; every text is parsed whole. A null text or one without a letter gives ``und`` and
score 0; so does any text if no language was learned. Ties go to the first language by name. Rows that repeat
an id are rows of their own. Rows without an id or language teach nothing but are predicted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.byte_bpe import LETTER, code_point_classes
from plumbline.llm.cluster import prepare, text_bytes

SAMPLE_ROWS, SAMPLE_ROW_CHARS, SAMPLE_CHARS = 96, 8_192, 32_768
LANE = 256
#: Signs parsed at once.
SIGNS = 2 << 20

Samples = tuple[tuple[str, str], ...]


def suffix_automaton(signs: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``signs`` by state; 0 is the root."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for sign in signs:
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and sign not in nexts[at]:
            nexts[at][sign] = new
            at = link[at]
        if at >= 0:
            old = nexts[at][sign]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[old]))
                link.append(link[old])
                length.append(length[at] + 1)
                while at >= 0 and nexts[at].get(sign) == old:
                    nexts[at][sign] = copy
                    at = link[at]
                link[old] = link[new] = copy
        last = new
    return nexts


def displaced(nexts: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a sparse table laid over one another: a state is its row's offset, the root's is 0.

    At offset + sign stand the offset of the row that the place belongs to (-1: none) and the state it leads to.
    No two rows have one offset, so a place of another row never counts. Room is that of the transitions and
    one row, whatever the width.
    """
    offsets = [0] * len(nexts)
    rows = sorted(range(1, len(nexts)), key=lambda state: -len(nexts[state]))
    given, taken = 1, sum(1 << sign for sign in nexts[0])  # bits: offsets in use, places in use
    single = len(rows)
    for k, state in enumerate(rows):
        if len(nexts[state]) < 2:
            single = k
            break
        clash = given
        for sign in nexts[state]:
            clash |= taken >> sign
        free = ~clash & (clash + 1)  # the lowest offset at which nothing clashes
        offsets[state] = free.bit_length() - 1
        given |= free
        for sign in nexts[state]:
            taken |= free << sign
    # Rows of one transition, most of all, take the free places in turn.
    used = set(offsets)
    bits = bin(taken)[:1:-1]
    places = (at for at in count(width) if at >= len(bits) or bits[at] == "0")
    for state in rows[single:]:
        sign = next(iter(nexts[state]), 0)
        offset = next(places) - sign
        while offset in used:
            offset = next(places) - sign
        used.add(offset)
        offsets[state] = offset
    owner = np.full(max(offsets) + width, -1, np.int32)
    to = np.zeros(len(owner), np.int32)
    for offset, row in zip(offsets, nexts):
        for sign, state in row.items():
            owner[offset + sign] = offset
            to[offset + sign] = offsets[state]
    return owner, to


@lru_cache(1)
def lower_cased() -> dict[int, str]:
    """Of each letter its lower case, the first sign where that is several."""
    return {point: chr(point).lower()[0] for point in np.flatnonzero(code_point_classes() == LETTER).tolist()}


class Parser:
    """The automata of all languages, one after another in one array."""

    def __init__(self, samples: Samples):
        self.languages = [name for name, _ in samples]
        lower = lower_cased()
        letters = sorted({lower[point] for _, text in samples for point in set(map(ord, text)) if point in lower})
        # Classes 0 (no letter) and 1 (letter of no sample), then the letters of the samples.
        numbers = {c: i for i, c in enumerate(letters, 2)}
        self.width = len(letters) + 2
        self.classes = np.zeros(0x110000, np.min_scalar_type(self.width))
        self.classes[list(lower)] = [numbers.get(c, 1) for c in lower.values()]
        self.tables, self.costs = [], []
        for _, text in samples:
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            self.tables.append(displaced(suffix_automaton(self.classes[points].tolist()), self.width))
            self.costs.append(math.log2(max(2, len(points))))

    def phrases(self, signs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Phrases by language and text; ``signs`` are the classes of all texts, ``counts`` how many each has."""
        lanes = -(-counts // LANE)
        owner = np.repeat(np.arange(len(counts)), lanes)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = (np.cumsum(counts) - counts)[owner] + number * LANE
        size = np.minimum(counts[owner] - number * LANE, LANE)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        grid = np.ascontiguousarray(np.r_[signs, np.zeros(LANE, signs.dtype)][start[:, None] + np.arange(LANE)].T)
        active = np.searchsorted(-size, -np.arange(LANE), side="left")  # lanes longer than j
        out = np.zeros((len(self.languages), len(counts)))
        for k, (of, leads) in enumerate(self.tables):
            begin = np.where(of[: self.width] == 0, leads[: self.width], 0)  # the root's row
            state = np.zeros(len(owner), np.int32)
            ended = np.ones(len(owner), np.int32)  # the phrase that the lane's end cuts off
            for j in range(LANE):
                n = active[j]
                if not n:
                    break
                sign = grid[j, :n]
                at = state[:n] + sign
                fails = of[at] != state[:n]
                ended[:n] += fails
                state[:n] = np.where(fails, begin[sign], leads[at])
            out[k] = np.bincount(owner, ended, len(counts))
        return out

    def predict(self, data: bytes, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
        ends = heads[offsets]
        counts = np.diff(ends)
        signs = self.classes[points]
        letters = np.diff(np.r_[0, np.cumsum(signs > 0)][ends])
        rates = np.zeros((len(self.languages), len(counts)))
        cut = 0
        while cut < len(counts):  # some texts at a time
            to = max(cut + 1, int(np.searchsorted(ends, ends[cut] + SIGNS, side="right")) - 1)
            rates[:, cut:to] = self.phrases(signs[ends[cut] : ends[to]], counts[cut:to])
            cut = to
        rates *= np.array(self.costs)[:, None] / np.maximum(counts, 1)
        best = rates.argmin(axis=0)
        least = rates.min(axis=0)
        score = np.ones(len(counts))
        if len(self.languages) > 1:
            second = np.partition(rates, 1, axis=0)[1]
            score = 1 - least / np.maximum(second, 1e-12)
        named = [self.languages[b] if n else "und" for b, n in zip(best.tolist(), letters.tolist())]
        return named, np.where(letters > 0, np.clip(score, 0, 1), 0.0)


@lru_cache(2)
def parser(samples: Samples) -> Parser:
    """One per worker process."""
    return Parser(samples)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Samples:
    """A bounded sample of text per language, by name: all that the driver sees of the corpus."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & (F.length(text) > 0))
    rows = rows.select(F.col(doc_id).alias("d"), F.col(lang).alias("l"), F.xxhash64(F.lit(8), doc_id).alias("h"))
    order = Window.partitionBy("l").orderBy("h", "d")
    chosen = rows.withColumn("r", F.row_number().over(order)).where(f"r <= {SAMPLE_ROWS}").select("d", "l", "r")
    # SAMPLE_ROWS rows of a few bytes for each language.
    spare = F.greatest(F.length(text) - SAMPLE_ROW_CHARS, F.lit(0))
    piece = F.substring(text, (1 + F.pmod(F.xxhash64(F.lit(9), doc_id), spare + 1)).cast("int"), F.lit(SAMPLE_ROW_CHARS))
    texts = labelled.where(F.length(text) > 0).select(F.col(doc_id).alias("d"), F.col(lang).alias("l"), piece.alias("t"))
    found = texts.join(F.broadcast(chosen), ["d", "l"]).groupBy("l", "r").agg(F.min("t").alias("t")).collect()
    joined: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda x: (x.l, x.r)):
        joined.setdefault(row.l, []).append(row.t)
    return tuple((name, "\n".join(joined[name])[:SAMPLE_CHARS]) for name in sorted(joined))


def identify(docs: DataFrame, samples: Samples | Mapping[str, str], text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` with the language (string) and its score (double) under the names ``into``, which must be new."""
    prepare(docs.sparkSession)
    if set(into) & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has a column {into[0]} or {into[1]}")
    if isinstance(samples, Mapping):
        samples = tuple(sorted(samples.items()))
    at = docs.columns.index(text)
    names = [*docs.columns, *into]
    schema = T.StructType([*docs.schema.fields, T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if samples:
                found, score = parser(samples).predict(*text_bytes(batch.column(at)))
            else:
                found, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score)], names=names)

    return docs.mapInArrow(run, schema)
