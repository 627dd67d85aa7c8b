"""Batches of raw rows: staged once, written over when cut short, rows of no day set apart."""

from __future__ import annotations

from datetime import date
from itertools import count

import pytest

from dealerlake import schemas as S
from dealerlake.sinks import REJECTED
from dealerlake.warehouse import Warehouse

DAY, NEXT = date(2025, 8, 2), date(2025, 8, 3)

_names = count()


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"), database=f"staging_{next(_names)}", buckets=4)


def sale(vin, created):
    return (vin, "6", "VELOS", str(DAY), "390.000.000", created)


def frame(wh, *rows, table=S.STG_SALES):
    return wh.spark.createDataFrame(list(rows), table.struct)


def staged(wh, table=S.STG_SALES):
    return sorted(r[0] for r in wh.store.read(table).collect())


def test_a_batch_appended_twice_is_there_once(wh):
    rows = frame(wh, sale("a", f"{DAY} 10:00:00"), sale("b", f"{NEXT} 10:00:00"))
    first = wh.append_staging(S.STG_SALES, rows, batch="2025-08-02.1")
    again = wh.append_staging(S.STG_SALES, rows, batch="2025-08-02.1")
    assert (first.rows_written, first.notes) == (2, {REJECTED: 0})
    assert again == first
    assert staged(wh) == ["a", "b"]
    wh.append_staging(S.STG_SALES, rows)  # without an id it is another batch
    assert staged(wh) == ["a", "a", "b", "b"]


def test_a_batch_cut_short_is_written_over(wh, monkeypatch):
    rows = frame(wh, sale("a", f"{DAY} 10:00:00"), sale("b", f"{NEXT} 10:00:00"), sale("x", "soon"))
    with monkeypatch.context() as cut:
        cut.setattr(wh.store.records, "finish_batch", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.append_staging(S.STG_SALES, rows, batch="one")
    with monkeypatch.context() as cut:
        cut.setattr("pyspark.sql.DataFrameWriter.insertInto", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.append_staging(S.STG_SALES, rows, batch="two")
    other = frame(wh, sale("c", f"{DAY} 11:00:00"))
    wh.append_staging(S.STG_SALES, other, batch="three")
    for batch in ("one", "two"):
        assert wh.append_staging(S.STG_SALES, rows, batch=batch).notes == {REJECTED: 1}
    assert staged(wh) == ["a", "a", "b", "b", "c", "x", "x"]


def test_batches_are_known_to_a_later_session(wh):
    rows = frame(wh, sale("a", f"{DAY} 10:00:00"), sale("x", None))
    wh.append_staging(S.STG_SALES, rows, batch="one")
    later = Warehouse(wh.spark, wh.store.root, database=f"staging_{next(_names)}", buckets=4)
    later.append_staging(S.STG_SALES, rows, batch="one")
    assert staged(later) == ["a", "x"]
    assert [(r.vin, r.batch, r.reason) for r in later.staging_rejects(S.STG_SALES).collect()] == [("x", "one", "no creation time")]


def test_rows_of_no_day_hold_up_no_daily_load(wh):
    rows = frame(wh, sale("a", f"{DAY} 10:00:00"), sale("b", f"{NEXT} 10:00:00"), sale("x", "soon"), sale("y", None))
    assert wh.append_staging(S.STG_SALES, rows).notes == {REJECTED: 2}
    assert wh.load_txf_sales(DAY).rows_written == 1
    assert wh.load_txf_sales(NEXT).rows_written == 1
    assert sorted(r.vin for r in wh.table(S.TXF_SALES).collect()) == ["a", "b"]
    assert sorted((r.vin, r.reason) for r in wh.staging_rejects(S.STG_SALES).collect()) == [
        ("x", "unreadable creation time"),
        ("y", "no creation time"),
    ]


def test_a_time_that_cannot_be_read_fails_its_own_day_only(wh):
    wh.append_staging(S.STG_SALES, frame(wh, sale("a", f"{DAY} noon"), sale("b", f"{NEXT} 10:00:00")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        wh.load_txf_sales(DAY)
    assert wh.load_txf_sales(NEXT).rows_written == 1


def test_an_initial_load_meets_rejects_and_fails(wh):
    wh.append_staging(S.STG_SALES, frame(wh, sale("a", f"{DAY} 10:00:00"), sale("x", "soon")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        wh.load_txf_sales(DAY, initial_load=True)
    assert wh.table(S.TXF_SALES).count() == 0


def test_customers_of_a_known_batch_are_skipped(wh):
    rows = frame(wh, ("1", "Ann", None, "2025-03-01"), table=S.STG_CUSTOMERS)
    for _ in range(2):
        assert wh.append_staging(S.STG_CUSTOMERS, rows, batch="c1").rows_written == 1
    assert staged(wh, S.STG_CUSTOMERS) == ["1"]


def test_an_empty_batch_leaves_nothing_but_its_mark(wh):
    assert wh.append_staging(S.STG_SALES, frame(wh), batch="none").rows_written == 0
    assert staged(wh) == []
    assert wh.store.records.batch(S.STG_SALES.name, "none") == {REJECTED: 0, "rows": 0}


@pytest.mark.parametrize("batch", ["", "a/b", "..", "x'y"])
def test_a_batch_id_must_name_a_file(wh, batch):
    with pytest.raises(ValueError, match="batch id"):
        wh.append_staging(S.STG_SALES, frame(wh), batch=batch)
