"""The chunk report of line dedup against a plain loop, on odd texts, and what it is for: whole copies go."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from dealerlake.llm import line_dedup
from dealerlake.llm.line_dedup import Chunking


def cut(text, long_words=30):
    """Chunks as lists of lines."""
    lines = text.split("\n")
    code = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    alone = [x.count(" ") + 1 >= long_words for x in lines]
    chunks, held = [], []
    for i, line in enumerate(lines):
        held.append(line)
        rolled = i > 0 and (code[i - 1] * 31 + code[i]) % 2 == 0
        if i == len(lines) - 1 or alone[i] or alone[i + 1] or rolled:
            chunks.append(held)
            held = []
    return chunks


def literal_report(rows, long_words=30):
    first, out = {}, []
    for doc, text in sorted(rows):
        chunks, gone = cut(text or "", long_words), set()
        filled = [(i, sum(bool(x.strip(" ")) for x in c)) for i, c in enumerate(chunks)]
        filled = [(i, n > 1 or "\n".join(chunks[i]).count(" ") + 1 >= long_words) for i, n in filled if n]
        units = [(a, a) for a, alone in filled if alone]
        units += [(a, b) for (a, own), (b, after) in zip(filled, filled[1:], strict=False) if not (own and after) or b - a > 1]
        for a, b in sorted(units):
            unit = "\n".join(x for c in chunks[a : b + 1] for x in c)
            held_by, at = first.setdefault(unit, (doc, a))
            if held_by != doc or a - at > b - a:
                gone.update(range(a, b + 1))
        kept = "\n".join(x for i, c in enumerate(chunks) if i not in gone for x in c)
        lost = sum(len(chunks[i]) for i in gone)
        out.append((doc, sum(map(len, chunks)), lost, hashlib.sha256(kept.encode()).hexdigest()))
    return out


def reported(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in line_dedup.report(frame).collect())


def corpus():
    draw = np.random.default_rng(4)
    line = lambda n: " ".join(f"w{v}" for v in draw.integers(0, 10**6, n))
    pool = [line(n) for n in draw.integers(1, 40, 25)] + ["", " ", "  "]
    rows = [(i, "\n".join(draw.choice(pool, draw.integers(1, 14)))) for i in range(1, 120)]
    odd = ["", None, " ", "\n\n", "a", "a\na\na\na\na", "a b\n\nc\na b\n\nc\n", "é\r\nü", "\t\nx", "x " * 30]
    return rows + [(200 + i, t) for i, t in enumerate(odd)] + [(300 + i, t) for i, t in enumerate(odd)]


def test_report_against_a_plain_loop(spark):
    rows = corpus()
    assert reported(spark, rows) == literal_report(rows)


def test_sql_says_the_same_of_odd_texts(spark):
    rows = corpus()
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})  # noqa: F841  (read by the SQL)
    assert sorted(duckdb.sql(line_dedup.ORACLE_SQL).fetchall()) == reported(spark, rows)


@pytest.mark.parametrize("size", [2, 4, 9])
def test_whole_copies_of_short_lines_go(spark, size):
    draw = np.random.default_rng(size)
    line = lambda n: " ".join(f"w{v}" for v in draw.integers(0, 10**6, n))
    nothing = hashlib.sha256(b"").hexdigest()
    rows = []
    for i in range(1, 40):
        text = "\n\n".join(line(n) for n in draw.integers(3, 12, size))
        rows += [(i, text), (100 + i, text), (200 + i, "\n".join(line(6) for _ in range(size)))]
    for doc, n_lines, lost, kept in reported(spark, rows):
        assert (lost, kept == nothing) == ((n_lines, True) if 100 < doc < 200 else (0, False))


def test_the_inside_of_a_passage_goes_in_any_surroundings(spark):
    """All of a passage of eight lines but a chunk at each edge, at most; other lines stay."""
    draw = np.random.default_rng(11)
    line = lambda n: " ".join(f"w{v}" for v in draw.integers(0, 10**6, n))
    passage = [line(12) for _ in range(8)]
    inside = [len(c) for c in cut("\n".join(passage))]
    rows = [(i, "\n".join([*(line(7) for _ in range(1 + i % 5)), *passage, *(line(8) for _ in range(1 + i % 3))])) for i in range(1, 40)]
    for doc, _, lost, _ in reported(spark, rows):
        assert (lost == 0) if doc == 1 else (8 - inside[0] - inside[-1] - 1 <= lost <= 8)


def test_rows_of_one_id_and_of_none(spark):
    text = "a b\nc d\ne f"
    frame = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    rows = line_dedup.report(frame.selectExpr("*", "1 AS place", "2 AS chunk")).collect()
    whole = hashlib.sha256(text.encode()).hexdigest()
    assert {(r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in rows} == {(1, 3, 0, whole), (None, 3, 0, whole)} and len(rows) == 4


def test_every_removed_line_stays_somewhere(spark):
    rows = [(i, t) for i, t in corpus() if t]
    gone = {r["_id"]: set(r["_removed"]) for r in line_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept, lost = set(), set()
    for doc, text in rows:
        for place, chunk in enumerate(cut(text), 1):
            (lost if place in gone.get(doc, ()) else kept).update(chunk)
    assert lost and {x for x in lost if x.strip(" ")} <= kept


def test_chunks_of_the_report_are_the_plain_ones(spark):
    rows = [(i, t) for i, t in corpus() if t is not None]
    held = line_dedup.with_chunks(spark.createDataFrame(rows, "doc_id long, text string"), Chunking())
    ends = {r.doc_id: r["_ends"] for r in held.select("doc_id", "_ends").collect()}
    for doc, text in rows:
        assert ends[doc] == list(np.cumsum([len(c) for c in cut(text)]))
