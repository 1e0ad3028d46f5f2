"""Fingerprints and components against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from plumbline.llm import components, queries, simhash
from tests.llm.common import AWKWARD, documents, frame, texts_of


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        u, v = find(u), find(v)
        parent[max(u, v)] = min(u, v)
    return {x: find(x) for x in parent}


def brute(prints, radius=4):
    known = sorted(set(prints))
    return roots([(a, b) for i, a in enumerate(known) for b in known[i:] if (a ^ b).bit_count() <= radius])


def test_fingerprints():
    import pyarrow as pa

    from plumbline.llm.cluster import text_bytes

    rnd = random.Random(5)
    texts = [*AWKWARD, *["".join(rnd.choices(["A b", " ", "  ", "\t", "é", "Z", "\xa0", "word "], k=rnd.randint(0, 30))) for _ in range(500)]]
    got = simhash.fingerprints(*text_bytes(pa.array(texts, pa.string())))
    assert got.tolist() == [fingerprint(t) for t in texts]


def near_prints(seed, n):
    rnd = random.Random(seed)
    out = [0, 2**64 - 1]
    while len(out) < n:
        x = rnd.choice(out) if rnd.random() < 0.7 else rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 7)):
            x ^= 1 << rnd.randrange(64)
        out.append(x)
    return sorted(set(out))


def test_tile_links_connect_the_same():
    prints = near_prints(1, 900)
    a, b = np.array(prints[:400], np.uint64), np.array(prints[400:], np.uint64)
    for left, right, same in ((a, a, True), (a, b, False)):
        u, v = simhash.tile_links(left, right, 4, same)
        pairs = [(x, y) for x in left.tolist() for y in right.tolist() if (x ^ y).bit_count() <= 4]
        want, got = roots(pairs), roots(zip(u.tolist(), v.tolist()))
        assert {x: r for x, r in want.items() if Counter(want.values())[r] > 1} == got
        assert len(u) < len(left) + len(right)


@pytest.mark.parametrize("tile", [40, 100_000])
def test_components_of_prints(spark, tile):
    prints = near_prints(2, 700)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in prints], "fingerprint long")
    got = {r.node: r.root for r in components.components(simhash.links(df, 4, tile)).collect()}
    signed = lambda x: int(np.uint64(x).astype(np.int64))
    groups = {}
    for x, r in brute(prints).items():
        groups.setdefault(r, []).append(signed(x))
    assert got == {x: min(g) for g in groups.values() if len(g) > 1 for x in g if x != min(g)}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, x) for x in range(1001, 1400)] + [(5000, 5000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(1, 301), 0), **dict.fromkeys(range(1001, 1400), 1000)}


def test_query(spark, sf):
    texts = texts_of(documents(spark, sf))
    prints = {d: fingerprint(t) for d, t in texts.items()}
    by = brute(list(prints.values()))
    least = {}
    for d, p in prints.items():
        least[by[p]] = min(d, least.get(by[p], d))
    rows = queries.op3_simhash(spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{p:016x}", least[by[p]]) for d, p in prints.items()}


def test_awkward(spark):
    df = frame(spark, [*AWKWARD, (None, "a"), (None, "only here, with a few words more"), (2, "b"), (2, "b")])
    rows = simhash.near_groups(df).collect()
    assert len(rows) == df.count()
    zero = [r for r in rows if r.fingerprint == 0]
    assert len(zero) == 4 and {r.component_id for r in zero} == {0}
    assert {r.component_id for r in rows if r.doc_id is None} == {4, None}
    assert simhash.near_groups(df.limit(0)).count() == 0
