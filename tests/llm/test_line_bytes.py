"""Units of the chunk report are the same by their bytes, not by their digests alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dealerlake.llm import line_dedup
from tests.llm.test_line_report import corpus, literal_report, reported


@pytest.mark.parametrize("digits", [0, 2])
def test_report_where_digests_clash(spark, monkeypatch, digits):
    """Digests of so few hexadecimal digits are shared by different texts, which are not repeats of each other."""
    unhex = F.unhex
    monkeypatch.setattr(F, "unhex", lambda x: unhex(F.substring(x, 1, digits)))
    rows = corpus()
    assert len({r.digest for r in line_dedup._units(spark.createDataFrame(rows, "doc_id long, text string"), line_dedup.Chunking()).collect()}) <= 16**digits
    assert reported(spark, rows) == literal_report(rows)


def test_rows_of_one_id_with_different_texts(spark):
    """Each row's own units count, at the place they stand in it."""
    first, second = "a b\nc d\ne f", "g h\ni j\nk l"
    rows = [(1, first), (1, second), (2, second), (3, first), (4, "m n\no p")]
    assert {(doc, n, lost) for doc, n, lost, _ in reported(spark, rows)} == {(1, 3, 0), (2, 3, 3), (3, 3, 3), (4, 2, 0)}
