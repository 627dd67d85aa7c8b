"""Licence labels: the phrases against plain Python, the index on notices that were changed, and awkward tables."""

import random
import re
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from dealerlake.llm import licenses  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
APACHE = "Licensed under the Apache License, Version 2.0."
MIT = next(text for label, text, _ in licenses.NOTICES if label == "mit" and "granted" in text)


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [(i, label) for label, p in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    places = sorted(i for i, _ in found)
    return len(words), len(found), places[0] if places else None, places[-1] if places else None, ",".join(sorted({label for _, label in found}))


def scanned(spark, texts, **extra):
    rows = [(i, t, "en", None, None) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3).withColumns(extra)
    return {r.doc_id: r for r in licenses.scan_licenses(frame).collect()}


def filler(seed, words=200):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randrange(2, 8))) for _ in range(words))


ODD = [None, "", " \n", "cc by", "CC-BY", "cc\x00by", "cc bye", "ccby", "cc cc by by", "All rights reserved. all RIGHTS\treserved", "all rights", "général public license",
       "cc by general public license all rights reserved", "x" * 60_000, "cc by " * 20_000, "the of and " * 5_000, "İ cc by", "日本cc by", "cc. by", "c\u0130c by", "all r\u0130ghts reserved", "wor\u212a mit license"]


def test_phrases_on_odd_texts(spark):
    found = scanned(spark, ODD, hits=F.lit(1), words=F.lit("w"), row=F.lit(2), template=F.lit(3), label=F.lit(4))
    for i, text in enumerate(ODD):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text and text[:40]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_repeated_rows_and_ids(spark):
    rows = [(1, APACHE, None, None, None)] * 2 + [(1, "cc by", None, None, None), (None, "cc by", None, None, None), (None, None, None, None, None)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in found) == [(0, ""), (0, "cc-by"), (1, "apache-2.0"), (1, "apache-2.0"), (1, "cc-by")]


def test_empty(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []


def test_every_notice_is_found_in_a_text_and_nowhere_else(spark):
    notices = [f"{filler(i)}\n{text.upper() if i % 2 else text}\n{filler(i + 50)}" for i, (_, text, _) in enumerate(licenses.NOTICES)]
    clean = [filler(100 + i) for i in range(40)]
    found = scanned(spark, notices + clean)
    for i, (label, _, _) in enumerate(licenses.NOTICES):
        assert label in found[i].labels.split(",") and found[i].score > 0.99
        others = set(found[i].labels.split(",")) - {label}
        assert others <= {"gpl", "cc-by"}
    assert all(found[len(notices) + i].labels == "" and found[len(notices) + i].score == 0 for i in range(40))


def test_changed_notices(spark):
    words = MIT.split()
    dropped = " ".join(w for k, w in enumerate(words) if k not in (10, 20))
    added = " ".join([*words[:9], "very", "much", *words[9:]])
    shuffled = words[:]
    random.Random(1).shuffle(shuffled)
    no_key = MIT.replace("free of charge", "for money")
    half = " ".join(words[: len(words) // 3])
    far = filler(7, 600).split()
    for k, w in enumerate(words):
        far[k * 17] = w
    clean = [filler(300 + i) for i in range(30)]
    found = scanned(spark, [dropped, added, " ".join(shuffled), no_key, half, " ".join(far), *clean])
    assert [found[i].labels for i in range(6)] == ["mit", "mit", "", "", "", ""]


def test_more_than_one_licence_in_a_text(spark):
    text = "\n".join([filler(1), APACHE, filler(2), MIT, filler(3), "All rights reserved."])
    found = scanned(spark, [text, *[filler(500 + i) for i in range(20)]])
    assert found[0].labels == "apache-2.0,mit,reserved" and found[0].score == 1


def test_rare_words_are_counted_over_all_rows(spark):
    rows = [(i, "the license" if i % 4 else "the apache the", None, None, None) for i in range(100)]
    held = licenses.find_words(spark.createDataFrame(rows, DOCS).repartition(7), ["the", "license", "apache", "mozilla"])
    weight = licenses.weights(held, licenses.Scan())
    assert weight["the"] == 0 and weight["license"] < weight["apache"] < weight["mozilla"]


def test_same_as_sql_on_odd_texts(spark):
    rows = [(i % 9, t, "en", None, None) for i, t in enumerate([*ODD[:13], *ODD[14:], APACHE, MIT, *[text for _, text, _ in licenses.NOTICES], *[filler(i) for i in range(30)]])]
    frame = spark.createDataFrame(rows, DOCS)
    db = duckdb.connect()
    db.register("documents", frame.toArrow())
    found = db.execute(licenses.ORACLE_SQL)
    names = [d[0] for d in found.description]
    expected = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(r)) for r in licenses.scan_licenses(frame).select(*names).collect()) == expected


def test_no_python_workers(spark):
    plan = licenses.scan_licenses(spark.createDataFrame([(1, APACHE, None, None, None)], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|InArrow|InPandas|MapPartitions", plan)


@pytest.mark.parametrize("copies", [3000])
def test_many_copies_and_one_long_text(spark, copies):
    texts = [APACHE] * copies + [" ".join([filler(5, 3000), MIT] * 30)]
    found = scanned(spark, [*texts, *[filler(900 + i, 20) for i in range(copies)]])
    assert {found[i].labels for i in range(copies)} == {"apache-2.0"}
    assert found[copies].labels == "mit"
