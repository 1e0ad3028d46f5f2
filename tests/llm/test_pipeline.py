"""The stages against plain Python, one after another."""

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from plumbline.llm import language
from tests.llm.common import AWKWARD, documents, frame
from tests.llm.test_simhash import brute as near
from tests.llm.test_simhash import fingerprint


def smallest(ids):
    return min(ids, key=lambda i: (i is None, i or 0))


def plain(rows, samples):
    """(id, text) of what each stage keeps, then the ids of the packed stream."""
    parser, out = language.Parser(samples), []
    kept = [(i, t) for i, t in rows if t and parser.predict(t.encode(), np.array([0, len(t.encode())]))[0] != ["und"]]
    out.append(kept)
    groups = defaultdict(list)
    for i, t in kept:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((i, t))
    kept = [min(g, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0)) for g in groups.values()]
    out.append(kept)
    prints = [fingerprint(t) for _, t in kept]
    root = near(prints)
    groups = defaultdict(list)
    for (i, t), p in zip(kept, prints):
        groups[root[p]].append((i, t))
    kept = [min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values()]
    out.append(kept)
    least = {}
    data = [(float("inf") if i is None else i, t.encode()) for i, t in kept]
    for i, t in data:
        for p in range(len(t) - 49):
            least[t[p : p + 50]] = min(i, least.get(t[p : p + 50], i))
    left = []
    for (i, t), (order, b) in zip(kept, data):
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < order:
                gone[p : p + 50] = b"\1" * 50
        if not all(gone) or not b:
            # A code point that lost a byte goes whole.
            at, text = 0, ""
            for c in t:
                n = len(c.encode())
                text += "" if any(gone[at : at + n]) else c
                at += n
            left.append((i, text))
    out.append(left)
    return out


def staged(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, None), name)
        out.append(docs)
    return out


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    samples = language.learn(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"))
    *stages, pieces = staged(spark, docs)
    for got, want in zip(stages, plain(rows, samples)):
        assert got.columns == docs.columns
        assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text)) for r in got.collect())
    last = stages[-1].collect()
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in last)
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(str((r.doc_id, hashlib.sha256(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()).hexdigest())) for r in last)
    stream = sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset))
    joined, got = b"", []
    for p in stream:
        assert p.start == len(joined) // 4 and p.sequence_id * 2048 + p.offset == sum(len(x.ids) // 4 for x in stream[: stream.index(p)]) or len(stream) > 300
        joined += bytes(p.ids)
        if len(joined) == 4 * p.doc_tokens:
            got.append(str((p.doc_id, hashlib.sha256(joined).hexdigest())))
            joined = b""
    assert sorted(got) == want and joined == b""
    return stages


def test_given_documents(spark, sf):
    stages = check(spark, documents(spark, sf))
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == stages[-1].count()


def test_awkward(spark):
    passage = "this passage of more than fifty bytes stands in several of the documents é"
    texts = [*AWKWARD, (None, "a text without an id and " + passage), (None, passage * 2), (4, "the id four again " + passage), "x " + passage[:60], "été " + passage, passage]
    check(spark, corpus_pipeline.stored(frame(spark, texts), "awkward"))


def test_empty(spark, sf):
    for docs in staged(spark, documents(spark, sf).limit(0)):
        assert docs.count() == 0
    docs = documents(spark, sf).limit(0).unionByName(frame(spark, [None, "", "12"]).select("doc_id", "text", "lang", "source", "n_chars"))
    assert staged(spark, corpus_pipeline.stored(docs, "letterless"))[0].count() == 0


def test_clashing_names(spark):
    extra = ["language", "Score", "row_", "kept", "removed", "__text", "lang_pred", "shard", "digest"]
    docs = frame(spark, ["the first text of some words", "the first text  of some words", "another text of other words", None])
    wide = corpus_pipeline.stored(docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)]), "clashing")
    *stages, pieces = staged(spark, wide)
    assert all(got.columns == wide.columns for got in stages) and pieces.count() > 0
    assert [tuple(r)[-len(extra) :] for r in stages[-1].collect()] == [tuple(range(len(extra)))] * 2
