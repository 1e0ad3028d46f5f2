"""The manifest against a plain tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle, queries
from tests.llm.common import AWKWARD, documents, frame

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each node the runs on its way up with its place in them."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run, place = divmod(at[i], 8)
            path.append((nodes[8 * run : 8 * run + 8], place))
            at[i] = run
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows, tampered=lambda r: r):
    """One tuple per row: id, leaf, subroot, root, proof, folded root."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf([r[f] for f in FIELDS]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for (_, _, own, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            beside, here = "", leaf([tampered(r)[f] for f in FIELDS])
            for run, place in path + top:
                beside += "".join(run[:place] + run[place + 1 :])
                here = sha("".join(run[:place] + [here] + run[place + 1 :]))
            out.append((r["doc_id"], own, trees[g][0], root, sha(beside), here))
    return sorted(map(str, out))


def shown(proofs):
    return sorted(str((r.id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof.hex(), r.folded.hex())) for r in proofs.collect())


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_awkward(spark, monkeypatch):
    texts = [*AWKWARD, (None, "no id"), (None, None), (3, "an id again"), (3, "an id again"), *[f"row {i}" for i in range(700)]]
    df = frame(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") == 9, "").when(F.col("doc_id") < 40, F.concat(F.lit("é"), F.col("doc_id") % 12)).otherwise("zz"))
    df = df.withColumn("key", F.lit(1)).withColumn("at", F.lit(2)).withColumn("digest", F.lit("x"))
    assert shown(merkle.manifest(df, FIELDS, "lang", "doc_id")) == plain(dicts(df))


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 511, 512, 513, 1025])
def test_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("doc_id"), *[F.lit(None).cast("string").alias(f) for f in FIELDS[1:]])
    proofs = merkle.manifest(df, FIELDS, "lang", "doc_id")
    assert shown(proofs) == plain(dicts(df))
    assert all(merkle.fold(bytes(r.leaf), bytes(r.witness)) == bytes(r.root) for r in proofs.collect())


def test_three_layers(spark, monkeypatch):
    """Blocks of 8 leaves make small tables deep."""
    for name, value in (("HEIGHT", 1), ("BLOCK", 8)):
        monkeypatch.setattr(merkle, name, value)
    nodes = [hashlib.sha256(b"%d" % i).digest() for i in range(600)]
    layers, here, at = [], nodes, 0
    while at == 0 or len(here) > 1:
        trees = []
        for b in range(0, len(here), 8):
            tree_ = merkle.Appender()
            for x in here[b : b + 8]:
                tree_.append(x)
            trees.append((tree_.finish(alone=b == 0), [bytes(x) for x in tree_.levels]))
        layers.append(trees)
        here, at = [t[0] for t in trees], at + 1
    assert len(layers) == 4 and here[0].hex() == tree([x.hex() for x in nodes])[0]
    for i in (0, 9, 511, 512, 599):
        witness, place = b"", i
        for trees in layers:
            witness += merkle.beside(trees[place // 8][1], place % 8)
            place //= 8
        assert merkle.fold(nodes[i], witness) == here[0]


def test_appended_rows_extend_the_witnesses(spark):
    def table(a, b):
        ids = spark.range(a, b).select(F.col("id").alias("doc_id"))
        return ids.select("doc_id", F.lit("s").alias("source"), F.when(F.col("doc_id") < 40, "small").when(F.col("doc_id") >= 1500, "late").otherwise("zz").alias("lang"), F.col("doc_id").alias("n_chars"), F.col("doc_id").cast("string").alias("text"))

    def first(df):
        nodes, most = merkle.placed(merkle.leaves(df, FIELDS, "lang", "doc_id"), "id")
        return merkle.grow(nodes, most)

    layers = first(table(0, 500))
    for a, b in ((500, 560), (560, 1600)):
        layers = merkle.extended(layers, table(a, b), FIELDS, "lang", "doc_id")
        assert shown(merkle.prove(layers)) == plain(dicts(table(0, b)))
    with pytest.raises(ValueError):
        merkle.extended(layers, table(1599, 1601), FIELDS, "lang", "doc_id")


def test_empty(spark):
    assert merkle.manifest(frame(spark, ["a"]).limit(0), FIELDS, "lang", "doc_id").count() == 0


def test_query(spark, sf):
    lower = str.maketrans(queries.UPPER, queries.UPPER.lower())

    def tampered(r):
        wrong = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None
        return {**r, "text": r["text"].translate(lower)} if wrong else r

    rows = queries.op13_merkle_manifest(spark, sf).collect()
    got = sorted(str((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root)) for r in rows)
    assert got == plain(dicts(documents(spark, sf)), tampered)
    assert all(r.verified == (r.folded_root == r.root) for r in rows) and 0 < sum(not r.verified for r in rows) < len(rows)
