"""Encoding, exact deduplication, sharding and packing against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, exact_dedup, packing, queries, shuffle_shards
from tests.llm.common import AWKWARD, documents, frame, texts_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def reference_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def encoded(texts):
    import pyarrow as pa

    from plumbline.llm.cluster import text_bytes

    ids, _, _ = byte_bpe.vocabulary(RANKS).encode(*text_bytes(pa.array(texts, pa.string())))
    return [np.frombuffer(x, "<u4").tolist() for x in ids]


def test_bpe_matches_the_library_on_random_text():
    signs = ["a", "s", "t", "re", "ve", "ll", "'", "'", "  ", " ", "\n", "\t", "1", "23", "!", "é", "ß", "中", "😀", "Don't", "'S", "\x1c", "\x85", "٣", "Ⅷ", "́", "　"]
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(signs, k=rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 300 + "!" * 500 + " " * 700 + "x", "", "'", "  'll", "abcabc" * 30, *filter(None, AWKWARD)]
    reference = reference_encoding()
    assert encoded(texts) == [reference.encode_ordinary(x) for x in texts]


def test_bpe_classes_agree_for_every_code_point():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 61 == 0)]
    texts = [f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}!" for c in points]
    reference = reference_encoding()
    assert encoded(texts) == [reference.encode_ordinary(x) for x in texts]


def test_bpe_query(spark, sf):
    reference, texts = reference_encoding(), texts_of(documents(spark, sf))
    rows = queries.op1_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_awkward_rows_and_offsets(spark):
    df = frame(spark, AWKWARD)
    for r in byte_bpe.encode_decode(df, RANKS).collect():
        text = (AWKWARD[r.doc_id] or "").encode()
        assert bytes(r.decoded) == text
        cuts = [*r.piece_offsets, len(text)]
        assert b"".join(text[a:b] for a, b in zip(cuts, cuts[1:])) == text and len(set(cuts)) == len(cuts) or not text
    assert byte_bpe.encode_decode(df.limit(0), RANKS).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode_decode(df, RANKS, keep=("doc_id", "ids"))


def test_bpe_decoding_checks_the_offsets():
    vocab, text = byte_bpe.vocabulary(RANKS), "It's unbelievably 1,234  words é 😀".encode()
    (ids,), places, _ = vocab.encode(text, np.array([0, len(text)]))
    ids = np.frombuffer(ids, "<u4").astype(np.int64)
    decoded, at = vocab.decode(ids, places, len(text))
    assert decoded.tobytes() == text and set(places.tolist()) <= set(at.tolist())
    inside = next(i for i in range(len(text)) if i not in set(at.tolist()))
    for wrong in ((ids[:-1], places, len(text)), (ids, np.r_[places, inside], len(text)), (ids, places[1:], len(text)), (ids[::-1], places, len(text))):
        with pytest.raises(ValueError):
            vocab.decode(*wrong)
    assert vocab.decode(ids[:0], places[:0], 0)[0].tobytes() == b""


def equal_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups["".join((text or "").split(" ")).translate(dict.fromkeys(range(9, 14)))].append((doc_id, text or ""))
    return groups


def test_exact_dedup(spark):
    texts = [*AWKWARD, "a b", "a  b", "ab", (None, "ab"), (3, "a\tb"), (3, "a\tb"), *["hot copy"] * 300]
    df = frame(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = exact_dedup.exact_groups(df).collect()
    assert len(got) == len(rows) and exact_dedup.exact_groups(df.limit(0)).count() == 0
    by = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in equal_groups(rows).items()}
    kept = defaultdict(int)
    for r in got:
        group = by[r.text_sha256]
        assert r.group_size == len(group)
        assert r.keep_id == sorted(group, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0][0]
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_cuckoo_index_grows_and_forgets():
    index, digests = exact_dedup.CuckooIndex(4), [hashlib.sha256(b"%d" % i).digest() for i in range(3000)]
    for d in digests:
        index.insert(d, [d])
    assert index.mask > 3 and all(index.find(d, d) == [d] for d in digests)
    for d in digests[::2]:
        assert index.delete(d) == [d] and index.delete(d) is None
    assert all(index.find(d, d) is None for d in digests[::2]) and all(index.find(d, d) for d in digests[1::2])
    assert sum(d in index for d in digests[::2]) < 60
    with pytest.raises(ValueError):
        index.find(digests[1], b"another text")


@pytest.mark.parametrize("bucket_bytes", [1 << 10, 1 << 24])
def test_shards(spark, bucket_bytes):
    df = frame(spark, [*AWKWARD, (None, None), (4, "a"), (4, "a"), *["same"] * 40])
    rows = shuffle_shards.shard(df, 8, bucket_bytes=bucket_bytes).collect()
    assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str((r.doc_id, r.text)) for r in df.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = shuffle_shards.shard(df.repartition(2, "doc_id"), 8, bucket_bytes=bucket_bytes).collect()
    assert sorted(str((r.doc_id, r.text, r.shard, r.slot)) for r in rows) == sorted(str((r.doc_id, r.text, r.shard, r.slot)) for r in again)
    assert shuffle_shards.shard(df.limit(0), 8).count() == 0


def test_fisher_yates_is_uniform():
    seen = defaultdict(int)
    for i in range(6000):
        seen[tuple(shuffle_shards.fisher_yates(3, (1, i)))] += 1
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())


def test_shards_query(spark, sf):
    texts = texts_of(documents(spark, sf))
    rows = queries.op9_shuffle_shards(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_clashing_names(spark):
    names = ["__bucket", "__at", "__n", "__start", "__p", "__P_", "__text", "shard", "Slot"]
    df = frame(spark, AWKWARD).select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    with pytest.raises(ValueError, match="already"):
        shuffle_shards.shard(df, 3)
    dealt = shuffle_shards.shard(df, 3, into=("part", "place"))
    assert dealt.columns == [*df.columns, "part", "place"]
    rows = dealt.collect()
    assert sorted(str(tuple(r)[:-2]) for r in rows) == sorted(str(tuple(r)) for r in df.collect())
    assert sorted((r.place, r.part) for r in rows) == [divmod(i, 3) for i in range(len(rows))]
    kept = byte_bpe.encode_decode(df, RANKS, keep=["doc_id", *names])
    assert kept.columns[: len(names) + 1] == ["doc_id", *names]
    assert sorted(str((r.doc_id, bytes(r.decoded))) for r in kept.collect()) == sorted(str((r.doc_id, (r.text or "").encode())) for r in df.collect())
    with pytest.raises(ValueError, match="twice"):
        byte_bpe.encode_decode(df.withColumn("IDS", F.lit(1)), RANKS, keep=["IDS"])


def check_pieces(pieces, texts, width):
    import tokenizers

    tok = tokenizers.Tokenizer.from_file(WORDS)
    ids = {d: np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    fills, starts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert bytes(p.ids) == ids[p.doc_id][p.start : p.start + p.length].tobytes()
        fills[p.sequence_id].append((p.offset, p.length))
        starts[p.doc_id].append((p.start, p.length))
    for d, spans in starts.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == len(ids[d])
    assert starts.keys() == ids.keys()
    full = 0
    for spans in fills.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= width
        full += at == width
    assert full >= len(fills) - 1 and sorted(fills) == list(range(len(fills)))


def test_packing_words_agree_with_the_library_for_every_letter():
    """Words are split and lowered by Arrow where that is what the tokenizer does."""
    import pyarrow as pa

    points = [chr(c) for c in (*range(0x300), *range(0x2000, 0x2070), 0x20AC, 0x212B, 0x3000, 0x1F600)]
    texts = [t for c in points for t in (f"Ab{c}cD {c} {c}{c}e1{c}2", f" {c}x\n\n{c}'S don{c}t  ")] + [None, "", "<|endoftext|> a", "<|startoftext|>", "<| endoftext |>"]
    words = packing.WordTokenizer(WORDS)
    ids, n = words.encode(pa.array(texts, pa.large_string()), 1)
    want = [words.whole([t or ""])[0] + b"\1\0\0\0" for t in texts]
    assert ids.tobytes() == b"".join(want) and n.tolist() == [len(x) // 4 for x in want]


def test_packing_query(spark, sf):
    check_pieces(packing.pack(documents(spark, sf), WORDS).collect(), texts_of(documents(spark, sf)), 2048)


def test_packing_awkward(spark):
    texts = [*AWKWARD, "Σίσυφος ΟΔΟΣ", "<|endoftext|> x", "İstanbul été", "don't 'S  'll", "’s €12"]
    df = frame(spark, texts)
    pieces = packing.pack(df, WORDS, width=64)
    check_pieces(pieces.collect(), texts_of(df), 64)
    done = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4 * r.length for r in done) and sum(r.length < 64 for r in done) <= 1
    assert packing.pack(df.limit(0), WORDS).count() == 0
