"""Phrase mining against counting everything in plain Python."""

import collections
import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from dealerlake.llm import collocations  # noqa: E402
from dealerlake.llm.collocations import Mining  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, words[i : i + m]] += 1
    return f, n


def brute(rows, mining):
    f, n = counts(rows, mining.longest)
    f = {k: v for k, v in f.items() if v >= mining.threshold}
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        score, k, l, r = min((mining.factor * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        longer = [b for (other, q), b in f.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(100 * b >= mining.absorbed_percent * a for b in longer):
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    found = []
    for lang, held in out.items():
        for rank, (score, a, p, l, r) in enumerate(sorted(held)[: mining.top], 1):
            found.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(found)


def mined(frame, mining):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in collocations.collocations(frame, mining).select(*names).collect())


def prose(seed, docs=60, vocabulary=25):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Élan", "日本", "a-b", "\x00"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(draw.randrange(0, 12)):
            if draw.random() < 0.4:
                parts.append("The quick  brown\tfox jumps over")
            parts += draw.choices(words, k=draw.randrange(1, 9))
            parts.append(draw.choice([".", ",", "\n", " ", "!?", "\r\n", "; "]))
        rows.append((i, " ".join(parts), draw.choice(["en", "de", None, "und"]), None, 0))
    return rows


@pytest.mark.parametrize(
    "mining",
    [
        Mining(threshold=4, shards=3),
        Mining(threshold=3, shards=5, slice_bytes=200),
        Mining(threshold=7, shards=2, entries=16),  # nearly all phrases share entries
        Mining(threshold=4, shards=1, longest=3, top=5),
        Mining(threshold=3, shards=4, absorbed_percent=60),
    ],
)
def test_same_as_counting_everything(spark, mining):
    rows = prose(mining.shards)
    expected = brute(rows, mining)
    assert expected
    assert mined(spark.createDataFrame(rows, DOCS).repartition(6), mining) == expected


def test_frequent_phrases_have_exact_counts_whenever_they_were_activated(spark):
    rows = prose(9, docs=90)
    mining = Mining(threshold=5, shards=4, entries=64)
    phrases, sizes = collocations.frequent_phrases(spark.createDataFrame(rows, DOCS).repartition(8), mining)
    f, n = counts(rows)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == {k: v for k, v in f.items() if v >= 5}
    assert {r.lang: r.n for r in sizes.collect()} == {k: v for k, v in n.items() if v}


def test_odd_rows(spark):
    rows = [(1, None, "en", None, 0), (1, "", "en", None, 0), (None, " \t\n.,", "en", None, 0), (2, "x " * 40_000, None, None, 0), (3, "A b. a B, a b", "en", None, 1)]
    rows += [(4, "a b", "en", None, 1)] * 3 + [(5, "z" * 50_000 + " z", "", None, 1)] * 2
    extra = {"phrase": F.lit(1), "size": F.lit("s"), "_shard": F.lit(7), "times": F.lit(2), "k": F.lit(3)}
    mining = Mining(threshold=2, shards=3)
    assert mined(spark.createDataFrame(rows, DOCS).withColumns(extra), mining) == brute(rows, mining)


def test_long_texts_are_cut_at_piece_ends_only():
    text = b"a b\nc d e f g h i j\n\nk" * 20
    for limit in (1, 4, 30, 10_000):
        parts = list(collocations._cut(text, limit))
        assert b"\n".join(parts) == text
        assert limit < 30 or max(map(len, parts)) <= limit


def test_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect() == []


def test_products_beyond_64_bits(spark):
    mining = Mining(threshold=2, shards=1, factor=10**16)
    rows = [(1, "a b " * 200, "en", None, 0)]
    assert mined(spark.createDataFrame(rows, DOCS), mining) == brute(rows, mining)
