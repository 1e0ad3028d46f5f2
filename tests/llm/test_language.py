"""Cross-parsing against a plain search, and held-out accuracy."""

import random

import numpy as np

from plumbline.llm import language, queries
from tests.llm.common import AWKWARD, documents, frame


def plain_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        # The sign that breaks a match begins the next phrase, unless the sample lacks it: then it ends this one.
        count += end <= len(text)
        at = end if text[end - 1 : end] not in sample else end - 1
    return count + 1


def test_parsing_is_longest_match():
    rnd = random.Random(4)
    samples = tuple((name, "".join(rnd.choices("abcd ", weights, k=900))) for name, weights in (("x", (5, 1, 1, 1, 2)), ("y", (1, 1, 4, 3, 2))))
    parser = language.Parser(samples)
    texts = ["".join(rnd.choices("abcd e", k=rnd.randint(1, language.LANE))) for _ in range(60)]
    signs = [parser.classes[np.frombuffer(t.encode("utf-32-le"), np.uint32)] for t in texts]
    got = parser.phrases(np.concatenate(signs), np.array([len(s) for s in signs]))
    for k, (_, sample) in enumerate(samples):
        known = parser.classes[np.frombuffer(sample.encode("utf-32-le"), np.uint32)].tobytes()
        assert got[k].tolist() == [plain_phrases(s.tobytes(), known) for s in signs]


def test_every_letter_of_the_samples_counts():
    rnd = random.Random(5)
    alphabets = {"cs": [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0x3B1, 0x3C2), *range(0x430, 0x450))], "hy": [chr(c) for c in range(0x561, 0x587)], "ka": [chr(c) for c in range(0x10D0, 0x10F1)], "zh": [chr(c) for c in range(0x4E00, 0x4F00)]}
    words = {name: [[rnd.choice(letters) for _ in range(2 + k % 5)] for k in range(60)] for name, letters in alphabets.items()}
    text = lambda name, n: " ".join("".join(words[name][k % 60]) for k in range(n))
    samples = tuple((name, text(name, 5000 if name == "cs" else 60)) for name in sorted(alphabets))
    parser = language.Parser(samples)
    letters = sorted({c for _, sample in samples for c in sample if c != " "})
    classes = [int(parser.classes[ord(c)]) for c in letters]
    assert len(letters) > 250 and len(set(classes)) == len(letters) and min(classes) == 2
    assert [int(parser.classes[ord(c)]) for c in " 7ก가"] == [0, 0, 1, 1]
    assert parser.classes[ord("A")] == parser.classes[ord("a")] and parser.classes[ord("Ա")] == parser.classes[ord("ա")]
    for name in alphabets:
        data = text(name, 40).encode()
        named, score = parser.predict(data, np.array([0, len(data)]))
        assert named == [name] and score[0] > 0.5


def test_long_texts_are_parsed_whole():
    samples = (("x", "abcabcabd" * 40), ("y", "ddcddcdda" * 40))
    parser = language.Parser(samples)
    long = "abcabcabd" * 2000 + "ddcddcdda" * 9000
    data = (long + "ab").encode()
    names, _ = parser.predict(data, np.array([0, len(long), len(data)]))
    assert names == ["y", "x"]


def test_query_accuracy(spark):
    rows = queries.op8_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in documents(spark, "/root/testdata/sf0.01").collect()}
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert len(rows) == len(truth) and len(held) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_long_rows_teach(spark):
    rnd = random.Random(6)
    long = ["".join(rnd.choices("abcde ", k=3 * language.SAMPLE_ROW_CHARS)) for _ in range(9)]
    rows = [*((i, t, "long") for i, t in enumerate(long)), *((i, "vwxyz zyx wv " * 9, "short") for i in range(20, 40))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = dict(language.learn(df))
    assert dict(language.learn(df.repartition(7))) == samples and set(samples) == {"long", "short"}
    pieces = samples["long"].split("\n")
    assert len(samples["long"]) == language.SAMPLE_CHARS and {len(p) for p in pieces[:-1]} == {language.SAMPLE_ROW_CHARS}
    places = [t.find(p) for p in pieces for t in long if p in t]
    assert len(places) == len(pieces) and len(set(places)) > 1 and max(places) <= 2 * language.SAMPLE_ROW_CHARS + (language.SAMPLE_ROW_CHARS - len(pieces[-1]))
    assert {r.lang_pred for r in language.identify(df.where("lang = 'long'"), samples).collect()} == {"long"}


def test_awkward(spark):
    df = frame(spark, [*AWKWARD, "12 34 !!", "ÉTÉ"])
    samples = language.learn(df)
    assert language.learn(df) == samples and [name for name, _ in samples] == ["en"]
    rows = {r.doc_id: r for r in language.identify(df, samples).collect()}
    und = {d for d, r in rows.items() if r.lang_pred == "und"}
    assert und == {0, 1, 2, 3, 10, 12} - {10} and all(rows[d].score == 0 for d in und)
    assert {r.lang_pred for r in language.identify(df, ()).collect()} == {"und"}
    assert language.identify(df.limit(0), samples).count() == 0 and language.learn(df.limit(0)) == ()
