"""Line removal against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import line_dedup, queries
from tests.llm.common import AWKWARD, documents, frame

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, shortest=10):
    """(id, lines, dropped, text) of each row."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < shortest or len(holders[key(x)]) < 2 or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(map(str, out))


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = line_dedup.drop_repeats(df, **options).collect()
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in got) == plain(rows, options.get("shortest", 10))


@pytest.mark.parametrize("slice_bytes", [1 << 9, 1 << 26])
def test_awkward(spark, slice_bytes):
    line = "A line that STANDS in many documents é"
    texts = [
        *AWKWARD, line, f"  {line.lower()}\t", f"{line}\nown text of this one\n{line}\n", f"\n\n{line}\r\n{line}", "É" + line, "nine sign", "nine sign", "ten  signs", "TEN  SIGNS", "é" * 9, "é" * 9, "é" * 10, "é" * 10,
        (None, line), (None, "only the missing have this"), (None, "only the missing have this"), (4, "the same id twice\n" + line), (4, "the same id twice"), *[line] * 300,
    ]
    check(frame(spark, texts), slice_bytes=slice_bytes)


def test_random(spark):
    rnd = random.Random(5)
    lines = ["".join(rnd.choices("abAB é\t", k=rnd.randint(0, 5))) for _ in range(60)]
    check(frame(spark, ["\n".join(rnd.choices(lines, k=rnd.randint(0, 9))) for _ in range(400)]), shortest=3, slice_bytes=200)


def test_empty(spark):
    assert line_dedup.drop_repeats(frame(spark, ["a"]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.drop_repeats(frame(spark, ["a"]), shortest=0)


def test_filters_miss_nothing():
    rnd = np.random.default_rng(2)
    seen, new = rnd.integers(0, 1 << 63, 20_000, np.uint64), rnd.integers(0, 1 << 63, 20_000, np.uint64)
    bloom = line_dedup.Bloom(len(seen))
    bloom.add(*bloom.bits(seen))
    assert bloom.holds(*bloom.bits(seen)).all() and bloom.holds(*bloom.bits(new)).mean() < 0.02


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op11_line_dedup(spark, sf).collect()}
    kept = {r.doc_id: r for r in line_dedup.drop_repeats(documents(spark, sf)).collect()}
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in kept.values()) == plain(rows)
    assert got == {(i, r.n_lines, r.n_dropped, hashlib.sha256(r.kept.encode()).hexdigest()) for i, r in kept.items()}
    assert sum(r.n_dropped for r in kept.values()) > 0
