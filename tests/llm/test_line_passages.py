"""Removal of passages: chunks by the rolling hash first, then pairs of lines in what they leave."""

from __future__ import annotations

import numpy as np

from dealerlake.llm import line_dedup
from dealerlake.llm.line_dedup import Chunking
from tests.llm.test_corpus import literal_dedup
from tests.llm.test_line_report import corpus, cut


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _chunks(text):
    """(first, last) filled line, counted from 1, of every chunk of several such lines or of one long line."""
    out, at = [], 0
    for chunk in cut(text):
        filled = [at + i for i, x in enumerate(chunk, 1) if x.strip(" ")]
        if len(filled) > 1 or (filled and chunk[0].count(" ") + 1 >= 30):
            out.append((filled[0], filled[-1]))
        at += len(chunk)
    return out


def test_units_are_the_chunks_of_the_rolling_hash_and_all_pairs(spark):
    rows = [(i, t) for i, t in corpus() if t is not None]
    found = line_dedup.passages(_frame(spark, rows)).collect()
    for doc, text in rows:
        own = [r for r in found if r.doc_id == doc]
        assert sorted((r.place, r.place + r.span) for r in own if r.digest is not None) == _chunks(text)
        filled = [i for i, x in enumerate(text.split("\n"), 1) if x.strip(" ")]
        pairs = sorted((p.place, p.place + p.span) for r in own for p in r.pairs)
        assert pairs == list(zip(filled, filled[1:], strict=False))


def test_whole_copies_go_by_chunks_and_their_pairs_are_not_looked_at_again(spark):
    draw = np.random.default_rng(3)
    line = lambda n: " ".join(f"w{v}" for v in draw.integers(0, 10**6, n))
    texts = ["\n".join(line(9) for _ in range(8)) for _ in range(20)]
    rows = [(c * 100 + i, t) for c in range(3) for i, t in enumerate(texts)]
    gone, pairs = line_dedup.split_repeats(line_dedup.passages(_frame(spark, rows)))
    removed = sorted((r.doc_id, r.place, r.place + r.span) for r in gone.collect())
    assert removed == sorted((i, a, b) for i, t in rows if i >= 100 for a, b in _chunks(t))
    left = {(r.doc_id, r.place) for r in pairs.select("doc_id", "place").collect()}
    assert left == {(i, k) for i, t in rows for k in range(1, 8) if i < 100 or not any(a <= k < b for a, b in _chunks(t))}
    out = line_dedup.dedup_lines(_frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in out) == sorted(r for r in rows if r[0] < 100)


def test_rows_left_are_those_of_pairs_alone(spark):
    rows = [(i, t) for i, t in corpus() if t is not None]
    out = line_dedup.dedup_lines(_frame(spark, rows)).collect()
    assert {r.doc_id: r.text for r in out} == literal_dedup(rows)


def test_units_of_the_report_carry_digests_and_no_texts(spark):
    rows = [(i, t) for i, t in corpus() if t is not None]
    units = line_dedup._units(_frame(spark, rows), Chunking())
    assert dict(units.dtypes) == {"doc_id": "bigint", "place": "int", "span": "int", "digest": "binary"}
    assert {len(r.digest) for r in units.collect()} == {32}
