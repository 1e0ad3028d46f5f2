"""Merkle manifest of a dataset: a root over all rows, and for each row the witness that leads from it to the root.

A row's leaf is the digest of its fields. The leaves of a group ascend by their order; every ``ARITY`` nodes in a row
become the digest of their digests, until one node is left, the group's subroot. The subroots, ordered by group, become
the root in the same way.

Witnesses grow as nodes are appended. A run of siblings that isn't complete is the partial witness of all that lies
below it: each sibling that completes extends it, for every leaf there at once, and when the run is complete its digest
is appended one level higher. A leaf's witness is what stands beside its own node in the run of each level. Appends are
aligned: a task streams the leaves of one block (``ARITY ** HEIGHT`` places of one group, from a multiple of that) and
hands on the block's root. The roots of blocks are further appends, dealt and streamed in the same way, layer by layer.
Then witnesses go down: what a block's root needs to reach the top extends the witness of every leaf of the block.

``grow`` takes the layers of an earlier manifest as well: new leaves, which come after the earlier ones of their group,
reopen one block of each layer at most, and no complete block is read again for its digest.

What travels is small rows: 32 bytes a digest. Texts are hashed where they are read. A group of any size is dealt by
blocks; the driver sees one number, the size of the largest group. Groups are read by their sorted place, so a lost
task streams the same leaves again.

Any field may be null; text may be empty or of any length. A missing group is a group of its own and the first. A missing
order is the first of its group; rows of equal order ascend by their leaves, so repeated rows have leaves of their own.
An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare, stored

ARITY, HEIGHT = 8, 3
BLOCK = ARITY**HEIGHT
SIZE = 32


def join(digests: bytes) -> bytes:
    """The node over some digests: the digest of their hexadecimal text."""
    return hashlib.sha256(digests.hex().encode()).digest()


class Appender:
    """Nodes of a block, appended from the left. The last run of a level is open until ``ARITY`` nodes are in it."""

    def __init__(self):
        self.levels = [bytearray()]

    def append(self, digest: bytes, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append(bytearray())
        here = self.levels[level]
        here += digest
        if len(here) % (ARITY * SIZE) == 0:
            self.append(join(here[-ARITY * SIZE :]), level + 1)

    def finish(self, alone: bool) -> bytes:
        """Close the open runs and return the root. A tree that stands alone ends with its first lone node; another is a
        part of a larger one, so its root is ``HEIGHT`` levels up, over runs of a single node too."""
        level = 0
        while level < HEIGHT and not (alone and len(self.levels[level]) == SIZE):
            here = self.levels[level]
            opened = len(here) % (ARITY * SIZE)
            if opened:
                self.append(join(here[-opened:]), level + 1)
            level += 1
        return bytes(self.levels[level])


def beside(levels: list[bytes], i: int) -> bytes:
    """The witness of node ``i`` within its block: level by level its place in the run, how many others, their digests."""
    out = bytearray()
    for nodes in levels[:-1]:
        run, place = divmod(i, ARITY)
        others = nodes[run * ARITY * SIZE : (run + 1) * ARITY * SIZE]
        others = others[: place * SIZE] + others[(place + 1) * SIZE :]
        out += bytes((place, len(others) // SIZE)) + others
        i = run
    return bytes(out)


def siblings(witness: bytes) -> bytes:
    """All digests of a witness, from the leaf's level on, left to right."""
    out, at = bytearray(), 0
    while at < len(witness):
        stop = at + 2 + SIZE * witness[at + 1]
        out += witness[at + 2 : stop]
        at = stop
    return bytes(out)


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    at = 0
    while at < len(witness):
        left, stop = at + 2 + SIZE * witness[at], at + 2 + SIZE * witness[at + 1]
        leaf = join(witness[at + 2 : left] + leaf + witness[left:stop])
        at = stop
    return leaf


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of a row (binary): each field as byte count, colon and value, or a dash where it is null."""
    values = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256))


_LONG, _BYTES = T.LongType(), T.BinaryType()
#: A node: group, place in its layer, digest; a leaf's id and what is claimed to be its digest.
_NODE = T.StructType([T.StructField("key", _BYTES), T.StructField("at", _LONG), T.StructField("digest", _BYTES), T.StructField("id", _LONG), T.StructField("claimed", _BYTES)])
_BLOCK = T.StructType(
    [T.StructField("key", _BYTES), T.StructField("block", _LONG), T.StructField("n", _LONG), T.StructField("root", _BYTES), T.StructField("levels", T.ArrayType(_BYTES)), T.StructField("ids", T.ArrayType(_LONG)), T.StructField("claimed", _BYTES)]
)
_TOLD = T.StructType([T.StructField("key", _BYTES), T.StructField("at", _LONG), T.StructField("witness", _BYTES), T.StructField("subroot", _BYTES), T.StructField("root", _BYTES)])
_PROOF = T.StructType(
    [T.StructField(c, _LONG) for c in ("id", "at")] + [T.StructField(c, _BYTES) for c in ("leaf", "subroot", "root", "witness", "proof", "folded")]
)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = _arrow(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their place among those of their group in this partition, and the partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        keys = batch.column(0)
        if not len(keys):
            continue
        codes = keys.dictionary_encode().indices.to_numpy()
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        places = np.arange(len(codes)) - np.repeat(first, np.diff(np.r_[first, len(codes)]))
        if keys[0].as_py() == last:
            places[: first[1] if len(first) > 1 else len(codes)] += seen
        last, seen = keys[-1].as_py(), int(places[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(codes), part, np.int64)), pa.array(places)], names=[*batch.schema.names, "part", "place"])


def placed(nodes: DataFrame, order: str, earlier: DataFrame | None = None) -> tuple[DataFrame, int]:
    """``nodes`` (key, digest and more) with ``at``, their place in their group by ``order`` and digest; and the size of the largest group.

    ``earlier`` has the nodes that groups have before these: key, n.
    """
    columns = ["key", *(c for c in nodes.columns if c != "key")]
    fields = T.StructType([*(nodes.schema[c] for c in columns), T.StructField("part", _LONG), T.StructField("place", _LONG)])
    by = [F.col("key"), F.col(order).asc_nulls_first(), F.col("digest")]
    rows = stored(nodes.select(*columns).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_numbered, fields), "leaves")
    counts = rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    if earlier is not None:
        counts = counts.unionByName(earlier.select("key", F.lit(-1).cast("bigint").alias("part"), "n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("before", before)
    most = starts.agg(F.max(F.col("before") + F.col("n")).alias("m")).first()["m"] or 0
    starts = starts.where("before > 0 and part >= 0").select("key", "part", "before")
    return rows.join(starts, ["key", "part"], "left").withColumn("at", F.coalesce("before", F.lit(0)) + F.col("place")).drop("part", "place", "before"), int(most)


def _appended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream sorted nodes; a block is handed on when the next begins."""
    held: tuple | None = None

    def done() -> tuple:
        key, block, tree, ids, claimed = held
        root = tree.finish(alone=block == 0)
        return key, block, len(ids), root, [bytes(x) for x in tree.levels], ids, b"".join(claimed)

    for batch in batches:
        out = []
        for key, at, digest, doc, claimed in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held[:2] != (key, at // BLOCK):
                if held:
                    out.append(done())
                held = (key, at // BLOCK, Appender(), [], [])
            held[2].append(digest)
            held[3].append(doc)
            held[4].append(claimed or b"")
        if out:
            yield _batch(out, _BLOCK)
    if held:
        yield _batch([done()], _BLOCK)


def _nodes(blocks: DataFrame) -> DataFrame:
    """The nodes that were appended to some blocks."""
    rows = blocks.select("key", "block", "levels", "ids", "claimed", F.explode(F.expr("sequence(0, cast(n as int) - 1)")).alias("i"))
    mine = f"substring({{}}, i * {SIZE} + 1, {SIZE})"
    return rows.select("key", F.expr(f"block * {BLOCK} + i").alias("at"), F.expr(mine.format("levels[0]")).alias("digest"), F.expr("ids[i]").alias("id"), F.expr(mine.format("claimed")).alias("claimed"))


def grow(nodes: DataFrame, most: int, layers: list[DataFrame] = ()) -> list[DataFrame]:
    """The blocks of each layer, up to one block of each group, after ``nodes`` are appended to ``layers``; ``most`` nodes of a group at most.

    Of the blocks there are, those that ``nodes`` reopen are streamed again, their complete runs included; others stay as they are.
    """
    out: list[DataFrame] = []
    while True:
        stays = None
        if len(out) < len(layers):
            blocks = layers[len(out)]
            touched = nodes.select("key", F.expr(f"at div {BLOCK}").alias("block")).distinct()
            stays = blocks.join(touched, ["key", "block"], "left_anti")
            reopened = _nodes(blocks.join(touched, ["key", "block"], "left_semi")).join(nodes, ["key", "at"], "left_anti")
            nodes = nodes.select(*_NODE.names).unionByName(reopened)
        dealt = nodes.select(*_NODE.names).repartition(F.col("key"), F.expr(f"at div {BLOCK}")).sortWithinPartitions("key", "at")
        new = dealt.mapInArrow(_appended, _BLOCK)
        out.append(stored(new if stays is None else new.unionByName(stays), "blocks"))
        most = -(-most // BLOCK)
        if most <= 1 and len(out) >= len(layers):
            return out
        # Blocks that stay have the roots they had; a layer that is new needs them all.
        changed = out[-1].join(touched, ["key", "block"], "left_semi") if len(out) < len(layers) else out[-1]
        nodes = changed.select("key", F.col("block").alias("at"), F.col("root").alias("digest"), F.lit(None).cast("bigint").alias("id"), F.lit(b"").alias("claimed"))


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node of a block: its witness, extended by that of the block's root."""
    for batch in batches:
        for key, block, n, levels, witness, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
            yield _batch([(key, block * BLOCK + i, beside(levels, i) + witness, subroot, root) for i in range(n)], _TOLD)


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of a block: its whole witness, and where its claimed digest leads to."""
    for batch in batches:
        for block, n, levels, witness, subroot, root, ids, claimed in zip(*(c.to_pylist() for c in batch.columns)):
            out, led, above = [], {}, siblings(witness)
            for i in range(n):
                mine = beside(levels, i)
                top = fold(claimed[i * SIZE : (i + 1) * SIZE], mine)
                if top not in led:  # the block's root, unless the claim is wrong
                    led[top] = fold(top, witness)
                digest = hashlib.sha256((siblings(mine) + above).hex().encode()).digest()
                out.append((ids[i], block * BLOCK + i, levels[0][i * SIZE : (i + 1) * SIZE], subroot, root, mine + witness, digest, led[top]))
            yield _batch(out, _PROOF)


def _down(layers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest layer's blocks with the witness of their roots. ``top``: key, witness, subroot, root of each group."""
    told = top.select("key", F.lit(0).cast("bigint").alias("block"), "witness", "subroot", "root")
    for blocks in layers[:0:-1]:
        rows = blocks.select("key", "block", "n", "levels").join(told, ["key", "block"])
        told = rows.select("key", "block", "n", "levels", "witness", "subroot", "root").mapInArrow(_opened, _TOLD).withColumnRenamed("at", "block")
    return layers[0].drop("root").join(told, ["key", "block"])


def leaves(table: DataFrame, fields: list[str], group: str, order: str, claimed: dict[str, Column] | None = None) -> DataFrame:
    """key, digest, id (the order, as bigint) and claimed: the digest with some fields replaced."""
    name = table[group].cast("string")
    key = F.coalesce(F.concat(F.lit(b"\x01"), F.encode(name, "UTF-8")), F.lit(b""))
    digest = leaf_digest([table[f] for f in fields])
    other = leaf_digest([(claimed or {}).get(f, table[f]) for f in fields]) if claimed else digest
    return table.select(key.alias("key"), digest.alias("digest"), table[order].cast("bigint").alias("id"), other.alias("claimed"))


def prove(layers: list[DataFrame]) -> DataFrame:
    """One row per leaf of the groups' layers: id, at (place in its group), leaf, subroot, root (binary digests), witness (for ``fold``),
    proof (the digest of the witness' digests), folded (the root that the claimed digest leads to)."""
    groups = layers[-1].select(F.lit(b"").alias("key"), F.col("root").alias("digest"), F.lit(None).cast("bigint").alias("id"), F.lit(b"").alias("claimed"), F.col("key").alias("name"))
    nodes, most = placed(groups, "name")
    over = grow(nodes, most)
    root = over[-1].select(F.lit(b"").alias("key"), F.lit(b"").alias("witness"), F.col("root").alias("subroot"), "root")
    told = _down(over, root).select("key", "block", "n", "levels", "witness", "subroot", "root").mapInArrow(_opened, _TOLD)
    top = nodes.select("at", F.col("name").alias("key"), F.col("digest").alias("subroot")).join(told.select("at", "witness", "root"), "at").drop("at")
    return _down(layers, top).select("block", "n", "levels", "witness", "subroot", "root", "ids", "claimed").mapInArrow(_proved, _PROOF)


def manifest(table: DataFrame, fields: list[str], group: str, order: str, claimed: dict[str, Column] | None = None) -> DataFrame:
    """``prove`` for all rows of a table; ``claimed`` replaces fields in what is verified, not in the tree."""
    prepare(table.sparkSession)
    nodes, most = placed(leaves(table, fields, group, order, claimed), "id")
    return prove(grow(nodes, most))


def extended(layers: list[DataFrame], table: DataFrame, fields: list[str], group: str, order: str) -> list[DataFrame]:
    """The layers after the rows of ``table`` were appended, each group's after those it has. Their order must be greater; a ValueError tells that it isn't."""
    prepare(table.sparkSession)
    new = leaves(table, fields, group, order)
    last = layers[0].select("key", F.array_max("ids").alias("last"))
    early = new.groupBy("key").agg(F.min("id").alias("first"), F.count_if(F.col("id").isNull()).alias("missing")).join(last.groupBy("key").agg(F.max("last").alias("last")), "key")
    if early.where("first <= last or missing > 0").limit(1).count():
        raise ValueError("appended rows come after those of their group")
    nodes, most = placed(new, "id", layers[0].groupBy("key").agg(F.sum("n").alias("n")))
    most = max(most, layers[0].groupBy("key").agg(F.sum("n").alias("n")).agg(F.max("n").alias("m")).first()["m"] or 0)
    return grow(nodes, most, layers)
