"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: A-Z in lower case, words parted by space or tab to carriage return, four-word shingles with
repeats, XXH64 with seed 42; a bit is 1 if it is set in over half the hashes. Fewer words: one shingle of
all. No word, empty or null text: fingerprint zero.

Links: different fingerprints, a row each, are dealt by population count into tiles of bounded size; the
class sizes (65 numbers) are all that the driver sees. A pair of tiles whose counts differ by more than
the radius can't hold a link and is never formed. The others are compared whole, exclusive-or and bit count
over arrays, row blocks against sub-tiles whose half-word counts can still be near. What a pair of tiles
finds leaves it as a spanning forest, at most one link per fingerprint, never all pairs of a group.
Components come from ``components``. The work is quadratic in the different fingerprints, by the
method; pruning lowers its constant (README has figures).

Copies share a fingerprint and never travel past the first aggregation. A missing id takes part in its
component and is named by no one; a component of missing ids only has a missing component_id. Rows that
repeat an id are rows of their own. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, stored, text_bytes
from plumbline.llm.components import components

SEED, SHINGLE = 42, 4
#: Fingerprints that a tile aims at: 8 bytes each.
TILE = 32_768
#: Comparisons per array operation, so that they stay in a core's cache.
BLOCK = 32_768
#: Comparisons that a task aims at.
TASK_WORK = 500_000_000
#: Shingles whose bits are spread out at once.
SPREAD = 1 << 18

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def shingle_spans(data: bytes, offsets: np.ndarray, size: int = SHINGLE) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words parted by one space, start and end of each shingle in them, shingles per text."""
    signs = np.frombuffer(data.translate(_LOWER), np.uint8)
    n, texts = len(signs), len(offsets) - 1
    if not n:
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(texts, np.int64)
    word = ~_BLANK[signs]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    # Keep the words and the first blank behind each.
    keep = word.copy()
    keep[1:] |= word[:-1]
    place = np.cumsum(keep)
    starts, ends = place[first] - 1, place[last]
    clean = np.where(word, signs, 32)[keep].tobytes()
    per = np.diff(np.r_[0, np.cumsum(first)][offsets])
    begin = np.cumsum(per) - per
    counts = np.where(per >= size, per - size + 1, np.minimum(per, 1))
    owner = np.repeat(np.arange(texts), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[owner]
    to = at + np.minimum(per, size)[owner] - 1
    return clean, starts[at], ends[to], counts


def fingerprints(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text, unsigned."""
    clean, starts, ends, counts = shingle_spans(data, offsets)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(clean[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], "<u8")
    set_bits = np.zeros((len(counts), 64), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for i in range(0, len(hashes), SPREAD):
        bits = np.unpackbits(hashes[i : i + SPREAD].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        part = owner[i : i + SPREAD]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        set_bits[part[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    ones = 2 * set_bits > counts[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or within one, if ``same``), as two arrays of fingerprints."""
    half = np.uint64(0xFFFFFFFF)
    low_a, low_b = np.bitwise_count(a & half).astype(int), np.bitwise_count(b & half).astype(int)
    order_a, order_b = np.argsort(low_a, kind="stable"), np.argsort(low_b, kind="stable")
    a, b, low_a, low_b = a[order_a], b[order_b], low_a[order_a], low_b[order_b]
    high_a = np.bitwise_count(a >> np.uint64(32)).astype(int)
    high_b = np.bitwise_count(b >> np.uint64(32)).astype(int)
    nodes = a if same else np.r_[a, b]
    base = 0 if same else len(a)
    label = np.arange(len(nodes))
    for low in np.unique(low_a):
        rows = slice(*np.searchsorted(low_a, [low, low + 1]))
        highs = high_a[rows]
        for other in range(max(0, low - radius), low + radius + 1):
            if same and other < low:
                continue
            cols = slice(*np.searchsorted(low_b, [other, other + 1]))
            if cols.start == cols.stop:
                continue
            # The halves' counts together differ by more than the radius: no link between these sub-tiles.
            left = radius - abs(int(other) - int(low))
            if high_b[cols].min() - highs.max() > left or highs.min() - high_b[cols].max() > left:
                continue
            width = cols.stop - cols.start
            for i in range(rows.start, rows.stop, max(1, BLOCK // width)):
                block = a[i : min(rows.stop, i + max(1, BLOCK // width))]
                near = np.bitwise_count(block[:, None] ^ b[cols]) <= radius
                if not near.any():
                    continue
                x, y = np.nonzero(near)
                x, y = x + i, y + cols.start + base
                lx, ly = label[x], label[y]
                new = lx != ly
                if new.any():
                    label = _joined(label, x[new], lx[new], ly[new])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _joined(label: np.ndarray, rows: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Labels after joining the labels one[k] and two[k]; the pairs of a row come after one another."""
    root = np.arange(len(label))
    cuts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]).tolist() + [len(rows)]
    for start, end in zip(cuts, cuts[1:]):
        met = np.unique(np.r_[one[start], two[start:end]])
        while True:
            up = root[met]
            if (up == met).all():
                break
            met = np.unique(up)
        root[met] = met[0]
    while True:
        up = root[root]
        if (up == root).all():
            return root[label]
        root = up


def simhash(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", row: str | None = None) -> DataFrame:
    """doc_id, row, fingerprint (long, the bits as they are) of each row. ``row`` names a column that numbers the rows."""
    prepare(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = fingerprints(*text_bytes(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "row", "fingerprint"])

    number = docs[row] if row else F.monotonically_increasing_id()
    return docs.select(docs[doc_id].cast("bigint").alias("doc_id"), number.alias("row"), docs[text].alias("text")).mapInArrow(run, schema)


def links(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Links u, v that connect all fingerprints (column ``fingerprint``, each once) at ``radius`` or fewer differing bits."""
    counted = prints.select("fingerprint", F.bit_count("fingerprint").alias("p"))
    sizes = {r.p: r.n for r in counted.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    tiles_of = {p: -(-n // tile) for p, n in sizes.items()}
    if not sizes:
        return prints.sparkSession.createDataFrame([], "u long, v long")
    known = F.create_map(*[F.lit(x) for p in sorted(tiles_of) for x in (p, tiles_of[p])])
    dealt = counted.withColumn("k", F.pmod(F.xxhash64("fingerprint"), known[F.col("p")]).cast("int"))
    tiles = stored(dealt.groupBy("p", "k").agg(F.collect_list("fingerprint").alias("held")), "tiles")
    # Each tile meets itself, later tiles of its class, and all tiles of the next ``radius`` classes.
    later = F.filter(F.transform(F.sequence(F.lit(0), F.lit(radius)), lambda d: F.col("p") + d), lambda q: known[q].isNotNull())
    partners = tiles.select("p", "k", "held", F.explode(later).alias("q"))
    first = F.when(F.col("q") == F.col("p"), F.col("k")).otherwise(F.lit(0))
    partners = partners.select("p", "k", "held", "q", F.explode(F.sequence(first, known[F.col("q")] - 1)).alias("j"))
    others = tiles.select(F.col("p").alias("q"), F.col("k").alias("j"), F.col("held").alias("others"))
    pairs = partners.join(others, ["q", "j"]).select("held", "others", ((F.col("p") == F.col("q")) & (F.col("k") == F.col("j"))).alias("same"))
    # Pairs go round robin to as many tasks as the comparisons ask for; AQE would merge their few bytes into few tasks.
    work = sum(n * sizes.get(p + d, 0) for p, n in sizes.items() for d in range(radius + 1))
    pairs = pairs.repartition(prints.sparkSession.sparkContext.defaultParallelism + work // TASK_WORK)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (0, 1))
                u, v = tile_links(a, b, radius, batch.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return pairs.mapInArrow(compare, T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())]))


def near_groups(docs: DataFrame, radius: int = 4, text: str = "text", doc_id: str = "doc_id", row: str | None = None, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, row, fingerprint (long), component_id (its smallest id) and keep_row (the row of that id)."""
    rows = stored(simhash(docs, text, doc_id, row), "prints")
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    nodes = stored(rows.groupBy("fingerprint").agg(F.min(first).alias("least")), "nodes")
    roots = components(links(nodes.select("fingerprint"), radius, tile)).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("least").alias("of_all"))
    named = rooted.select("fingerprint", "root").join(least, "root")
    named = named.select("fingerprint", F.col("of_all.doc_id").alias("component_id"), F.col("of_all.row").alias("keep_row"))
    return rows.join(named, "fingerprint").select("doc_id", "row", "fingerprint", "component_id", "keep_row")
