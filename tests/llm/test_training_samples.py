"""What the language and quality models learn from, and how they weigh the parts of a text."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealerlake.llm import language_id, line_quality
from dealerlake.llm.common import whole_within


def test_whole_things_within_a_limit():
    assert whole_within([("a", 4), ("b", 9), ("c", 5), ("d", 1), ("e", 0)], 9) == ["a", "c", "e"]
    assert whole_within([], 9) == [] and whole_within([("a", 1)], 0) == []


def test_languages_are_learned_from_whole_texts(spark):
    long = " ".join(f"word{i}" for i in range(9000))
    rows = [(1, long, "en"), (2, "short one", "en"), (3, "short one", "en"), (4, "kort", "nl"), (5, None, "en"), (6, "", "en"), (7, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = lambda **limits: {(lang, text) for lang, _, text in language_id.sample(docs, F.lit(True), language_id.Training(**limits))}
    assert sample() == {("en", long), ("en", "short one"), ("nl", "kort")}
    assert sample(characters_per_language=len(long) - 1) == {("en", "short one"), ("nl", "kort")}  # passed over, not cut
    assert len(sample(documents_per_language=1)) == 2
    assert language_id.sample(docs.limit(0), F.lit(True)) == []


def test_language_sample_is_the_first_by_hash_over_all_ranges(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang").repartition(7)
    first = docs.select(F.xxhash64("text").alias("h")).orderBy("h").limit(40).collect()
    found = language_id.sample(docs, F.lit(True), language_id.Training(documents_per_language=40))
    assert [order for _, order, _ in found] == [r.h for r in first]


def test_pooled_chances_against_a_loop():
    net = language_id.ByteGRU(["a", "b", "c"], 4, 1).compact()
    texts = [b"some words, 12 numbers " * 11, b"", b"123 456", "\u00e9t\u00e9 2024".encode()]
    pooled = net.documents(texts, at_once=2)
    for text, found in zip(texts, pooled, strict=True):
        total, letters = np.zeros(3), 0
        for first in range(0, len(text), language_id.WINDOW):
            piece = text[first : first + language_id.WINDOW]
            chance = net.positions(np.array(list(piece), np.int16)[:, None])
            for byte, here in zip(piece, chance, strict=True):
                if byte >= 128 or chr(byte).isalpha():
                    total, letters = total + here[:, 0], letters + 1
        assert found == pytest.approx(total / max(letters, 1), abs=1e-5)


def test_quality_is_learned_from_whole_texts(spark):
    long = "\n".join(f"line {i} of a long text" for i in range(4000))
    rows = [(i, f"text {i}\nof two lines") for i in range(40)] + [(40, long), (2, "text"), (3, None), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(41)] + [(4, 1), (5, None), (99, 1)], "doc_id long, quality int")
    held = {r.doc_id for r in docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1).select("doc_id").collect()}
    found = line_quality.sample(docs, labels)
    assert {d for d, _, _ in found} == set(range(41)) - held - {3}
    texts = dict(r for r in rows if r[1] is not None and r != (2, "text"))
    assert all(text == texts[d] and quality == d % 2 for d, text, quality in found)
    assert 40 in held or 40 in {d for d, _, _ in line_quality.sample(docs, labels, line_quality.Training(characters=10**6))}
    small = line_quality.sample(docs, labels, line_quality.Training(characters=90))
    assert 0 < sum(len(t) for _, t, _ in small) <= 90 and all(t == texts[d] for d, t, _ in small)
    assert len(line_quality.sample(docs, labels, line_quality.Training(documents=5))) <= 5


def test_quality_score_against_all_paths():
    draw = np.random.default_rng(5)
    good = ["A sentence of plain words stands here, and another.", "It goes on for a while in the same way."]
    bad = ["$$ 11 || 22 || ##", "x x x x x x"]
    model = line_quality.fit([("\n".join(good * 3)).encode(), ("\n".join(bad * 3)).encode()], [1, 0], line_quality.Training(steps=15))
    texts = [b"", b"\n", *["\n".join(draw.permutation(good + bad + [""])).encode() for _ in range(6)]]
    for text, found in zip(texts, model.scores(texts), strict=True):
        features, lengths, lines = line_quality.line_features([text])
        unary, n = model.crf.unary(model.bins(features, lines)), len(lengths)
        assert n == text.count(b"\n") + 1 and lengths.tolist() == [len(x) for x in text.split(b"\n")]
        weight, good_lines = 0.0, np.zeros(n)
        for path in itertools.product(range(2), repeat=n):
            score = sum(unary[t, k] for t, k in enumerate(path)) + sum(model.crf.moves[a, b] for a, b in itertools.pairwise(path))
            weight += np.exp(score)
            good_lines += np.exp(score) * np.array(path)
        chance = good_lines / weight
        assert found == pytest.approx(sum(c * (size + 1) for c, size in zip(chance, lengths, strict=True)) / (lengths + 1).sum())
