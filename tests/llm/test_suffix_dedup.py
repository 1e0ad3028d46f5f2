"""The transform against sorted suffixes, and removal against plain search."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import column_bwt, queries, suffix_dedup
from plumbline.llm.cluster import stored
from tests.llm.common import AWKWARD, documents, frame, texts_of


def common_prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("on_disk", [False, True])
@pytest.mark.parametrize("wide", [False, True])
def test_transform_and_common_prefixes(on_disk, wide, monkeypatch):
    monkeypatch.setattr(column_bwt, "PIECE", 7)
    rnd = random.Random(6)
    for _ in range(60):
        alphabet = rnd.choice([b"ab", b"abc", bytes(range(30))])
        strings = list({bytes(rnd.choices(alphabet, k=rnd.randint(0, 14))) for _ in range(rnd.randint(1, 30))})
        text, ends = b"".join(strings), np.cumsum([len(s) for s in strings])
        end_of = {q: e for s, e in zip([0, *ends], ends) for q in range(s, e)}
        starts = {s for s, e in zip([0, *ends], ends) if s < e}
        with column_bwt.Columns(on_disk) as columns:
            transform = column_bwt.Transform(text, ends, columns, wide)
            place, entries = (np.array(x)[len(strings) :] for x in (transform.places(), transform.entries))
        got = [text[q : end_of[q]] for q in place]
        assert got == sorted(text[q:e] for q, e in end_of.items())
        assert (entries >> 8).tolist() == [common_prefix(a, b) for a, b in zip([b"", *got], got)]
        codes = {b: i for i, b in enumerate(sorted(set(text)), 1)}
        assert (entries & 255).tolist() == [0 if q in starts else codes[text[q - 1]] for q in place]


def brute(rows, width):
    """(removed, spans, kept) of each (id, text); a missing id is larger than all."""
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in texts:
        for p in range(len(t) - width + 1):
            least[t[p : p + width]] = min(i, least.get(t[p : p + width], i))
    out = []
    for i, t in texts:
        gone = [False] * (len(t) + 1)
        for p in range(len(t) - width + 1):
            if least[t[p : p + width]] < i:
                gone[p : p + width] = [True] * width
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(a and not b for a, b in zip(gone, gone[1:])), hashlib.sha256(kept).hexdigest()))
    return out


def removed(df, **options):
    return sorted((r.row, (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())) for r in suffix_dedup.remove_repeats(df, **options).collect())


def passages(seed, n):
    rnd = random.Random(seed)
    parts = ["".join(rnd.choices("abé ", k=rnd.randint(5, 60))) for _ in range(12)] + ["ab" * 60, "a" * 90]
    return ["".join(rnd.choice(parts) if rnd.random() < 0.6 else "".join(rnd.choices("abcdefgh é", k=rnd.randint(1, 80))) for _ in range(rnd.randint(0, 8))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"hot": 0, "bucket_bytes": 500}, {"bucket_bytes": 2000, "width": 20, "gram": 7}, {"width": 9, "gram": 9}])
def test_random_passages(spark, options, monkeypatch):
    texts = passages(1, 120) + [(None, "ab" * 50), (None, "ab" * 50), (7, "x" + "ab" * 50), *["hot copy with more than fifty bytes in it, and then some more"] * 40]
    df = stored(frame(spark, texts).withColumn("number", F.monotonically_increasing_id()), "numbered")
    rows = [(r.number, r.doc_id, r.text) for r in df.collect()]
    want = brute([(i, t) for _, i, t in rows], options.get("width", 50))
    assert removed(df, row="number", **options) == sorted((n, w) for (n, _, _), w in zip(rows, want))


def test_small_collections(spark, monkeypatch):
    rnd = random.Random(3)
    strings = sorted({t.encode()[i : i + 20 + rnd.randint(0, 9)] for t in passages(3, 30) for i in range(0, max(0, len(t.encode()) - 30), 3)})
    keyed = {}
    for s in strings:  # runs of one key, as the operator makes them
        key, at, size, _ = suffix_dedup.runs(s, np.array([0, len(s)]), 20, 7)
        keyed.update({s[a : a + n + 19]: None for a, n in zip(at.tolist(), size.tolist())})
    texts, owner = list(keyed), np.arange(len(keyed))[::-1].copy()
    whole = suffix_dedup._answers(texts, owner, 20, 7)
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 300)
    parts = suffix_dedup._answers(texts, owner, 20, 7)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_query(spark, sf):
    rows = sorted(texts_of(documents(spark, sf)).items())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_dedup(spark, sf).collect()}
    assert got == {i: w for (i, _), w in zip(rows, brute(rows, 50))}


def test_awkward(spark):
    df = frame(spark, AWKWARD)
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    want = brute(list(enumerate(AWKWARD)), 50)
    assert [(rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, hashlib.sha256(rows[i].kept).hexdigest()) for i in range(len(AWKWARD))] == want
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    assert suffix_dedup.remove_repeats(frame(spark, [None, "", "short"])).count() == 3
