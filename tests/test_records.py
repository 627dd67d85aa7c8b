"""Tables that outlive a session, loads seen whole or not at all, and two loads at once."""

import json
import subprocess
import sys
import warnings
from datetime import date, timedelta
from itertools import count
from pathlib import Path

import pytest
import seed

from dealerlake import schemas as S
from dealerlake.operators import LoadRejected
from dealerlake.sources import write_address_file
from dealerlake.warehouse import Warehouse

DAY = date(2025, 8, 2)
NEXT = DAY + timedelta(days=1)
REPO = Path(__file__).resolve().parent.parent
_names = count()


def opened(spark, root):
    """The warehouse as a session with a catalog of its own finds it."""
    return Warehouse(spark, str(root), database=f"records_{next(_names)}", buckets=4)


@pytest.fixture
def root(tmp_path):
    return tmp_path / "tables"


def sale(vin, day=DAY, created=None):
    return (vin, "6", "VELOS", str(day), "390.000.000", f"{created or day} 10:00:00.012")


def ticket(number, day=DAY):
    return (number, "v", "6", "VELOS", str(day), "PM", f"{day} 10:00:00")


def stage(wh, table, *rows):
    wh.append_staging(table, wh.spark.createDataFrame(list(rows), table.struct))


def restage(wh, table, day, *rows):
    """Replace the rows staged for one day."""
    path = f"{wh.store.root}/restaged-{next(_names)}"
    wh.spark.createDataFrame(list(rows), table.struct).write.parquet(path)
    wh.spark.sql(f"ALTER TABLE {wh.store.name(table)} PARTITION (created_date=DATE'{day}') SET LOCATION '{path}'")


def held(wh, table=S.TXF_SALES):
    key = table.key[0]
    return sorted((r[key], r.load_timestamp.date()) for r in wh.table(table).collect())


def run_folders(wh, table):
    return {p.name for p in Path(wh.store.root, table.name, "runs").glob("run=*")}


# --- reopening -------------------------------------------------------------------------------


def test_a_second_session_reads_and_goes_on_with_every_table(spark, root, tmp_path):
    first = opened(spark, root)
    for table, rows in ((S.STG_CUSTOMERS, seed.CUSTOMERS), (S.STG_SALES, seed.SALES), (S.STG_AFTER_SALES, seed.AFTER_SALES)):
        stage(first, table, *rows)
    address_rows = spark.createDataFrame(seed.ADDRESSES, ",".join(f"{c} string" for c in S.STG_CUSTOMER_ADDRESS.names[:6]))
    write_address_file(address_rows, str(tmp_path / "in"), DAY)
    first.ingest_stg_customer_address(str(tmp_path / "in"), DAY)
    first.load_txf_customers(DAY)
    first.load_txf_customer_address(DAY)
    first.load_txf_sales(DAY, initial_load=True)
    first.load_txf_after_sales(DAY, initial_load=True)
    first.load_mart_sales()
    first.load_mart_cust_service_prio()
    expected = {t.name: sorted(map(repr, first.table(t).collect())) for t in S.ALL_TABLES}
    first.store.drop_entries()

    second = opened(spark, root)
    assert {t.name: sorted(map(repr, second.table(t).collect())) for t in S.ALL_TABLES} == expected
    assert second.store.bucket_count(S.TXF_CUSTOMERS) == 4
    with pytest.raises(LoadRejected, match="already stored"):
        second.load_txf_sales(NEXT, initial_load=True)
    stage(second, S.STG_SALES, sale("new", NEXT))
    second.load_txf_sales(NEXT)
    assert len(held(second)) == len(seed.SALES) + 1
    by_catalog = spark.table(second.store.name(S.TXF_SALES))
    assert by_catalog.count() == len(seed.SALES) + 1
    assert by_catalog.filter(f"load_date = DATE'{NEXT}'").count() == 1


def test_a_session_of_another_process_reads_the_same_rows(spark, root):
    wh = opened(spark, root)
    stage(wh, S.STG_SALES, sale("a"), sale("old", date(2022, 5, 1), created=DAY))
    wh.load_txf_sales(DAY)
    code = f"""
import json
from pyspark.sql import SparkSession
from dealerlake import schemas as S
from dealerlake.warehouse import Warehouse
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
wh = Warehouse(spark, {str(root)!r})
print(json.dumps(sorted([r.vin, str(r.load_date), r.inv_bucket] for r in wh.store.read(S.TXF_SALES).collect())))
print(json.dumps(spark.sql("SELECT count(*) FROM dwh.txf_sales WHERE inv_bucket = 'p2025'").first()[0]))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, check=True, timeout=180)
    rows, counted = [json.loads(line) for line in out.stdout.splitlines()[-2:]]
    assert rows == [["a", str(DAY), "p2025"], ["old", str(DAY), "p2022"]] and counted == 1


def test_a_load_of_another_session_is_seen(spark, root):
    one, other = opened(spark, root), opened(spark, root)
    stage(one, S.STG_SALES, sale("a"))
    one.load_txf_sales(DAY)
    one.load_mart_sales()
    assert held(other) == [("a", DAY)]
    assert other.table(S.MART_SALES).count() == 1
    assert spark.table(other.store.name(S.MART_SALES)).count() == 1


def test_files_without_a_record_are_refused(spark, root):
    (root / "txf_sales" / "runs" / "run=1").mkdir(parents=True)
    with pytest.raises(ValueError, match="no record"):
        opened(spark, root)


def test_entries_left_half_changed_are_made_anew(spark, root):
    wh = opened(spark, root)
    stage(wh, S.STG_SALES, sale("a"), sale("b", date(2021, 1, 1), created=DAY))
    wh.load_txf_sales(DAY)
    name = wh.store.name(S.TXF_SALES)
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('record')")
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (load_date=DATE'{DAY}', inv_bucket='p2025')")
    Warehouse(spark, str(root), wh.store.database)
    assert spark.table(name).count() == 2


# --- one switch ------------------------------------------------------------------------------


class Cut(Exception):
    pass


def cut_after(wh, steps, monkeypatch):
    """Let ``steps`` statements and records through, then fail. The returned list holds what was let through."""
    done = []

    def step(function):
        def run(*args, **kwargs):
            if len(done) >= steps:
                raise Cut
            done.append(args)
            return function(*args, **kwargs)

        return run

    monkeypatch.setattr(wh.store, "_sql", step(wh.store._sql))
    monkeypatch.setattr(wh.store.records, "write", step(wh.store.records.write))
    return done


def prepared(spark, root, kind):
    """A warehouse before a load that touches several partitions, and the load."""
    wh = opened(spark, root)
    old = date(2022, 5, 1)
    stage(wh, S.STG_SALES, sale("a"), sale("b", old, created=DAY), sale("later", NEXT))
    if kind == "initial":
        return wh, lambda w: w.load_txf_sales(date(2025, 1, 1), initial_load=True)
    if kind == "daily":
        wh.load_txf_sales(NEXT)
        return wh, lambda w: w.load_txf_sales(DAY)
    wh.load_txf_sales(NEXT)
    wh.load_txf_sales(DAY)
    if kind == "repeated":
        restage(wh, S.STG_SALES, DAY, sale("c"), sale("d", date(2023, 5, 1), created=DAY))
        return wh, lambda w: w.load_txf_sales(DAY)
    restage(wh, S.STG_SALES, DAY, sale("e"))
    restage(wh, S.STG_SALES, NEXT, sale("f", old, created=NEXT))
    return wh, lambda w: w.load_txf_sales(DAY, initial_load=True)  # onto a stored date


@pytest.mark.parametrize("kind", ["initial", "daily", "repeated", "appended"])
def test_a_load_cut_short_anywhere_is_seen_whole_or_not_at_all(spark, tmp_path, kind, monkeypatch):
    wh, load = prepared(spark, tmp_path / "whole", kind)
    before = held(wh)
    load(wh)
    after = held(wh)
    assert before != after
    for steps in count():
        root = tmp_path / f"cut-{steps}"
        wh, load = prepared(spark, root, kind)
        with monkeypatch.context() as patch, warnings.catch_warnings():
            warnings.simplefilter("ignore")
            done = cut_after(wh, steps, patch)
            try:
                load(wh)
            except Cut:
                assert steps == 0 or held(wh) == before
        found = held(wh)
        assert found in (before, after)
        assert held(opened(spark, root)) == found
        try:
            load(wh)
        except LoadRejected as error:  # an initial load that had happened
            assert found == after and "already stored" in str(error)
        assert held(wh) == after == held(opened(spark, root))
        assert spark.table(wh.store.name(S.TXF_SALES)).count() == len(after)
        if len(done) < steps:
            break
    assert steps > 2


# --- two loads at once -----------------------------------------------------------------------


@pytest.mark.parametrize("table", [S.TXF_SALES, S.TXF_AFTER_SALES])
def test_the_second_of_two_fact_loads_is_refused(spark, root, table, monkeypatch):
    one, other = opened(spark, root), opened(spark, root)
    if table is S.TXF_SALES:
        stage(one, S.STG_SALES, sale("a"), sale("a", NEXT))  # both would bring the vehicle, on dates of their own
        load = lambda w, day: w.load_txf_sales(day)
    else:
        stage(one, S.STG_AFTER_SALES, ticket("T1"), ticket("T1", NEXT))
        load = lambda w, day: w.load_txf_after_sales(day)
    other = opened(spark, root)
    checked = one.store.require_valid

    def meanwhile(run):
        checked(run)
        load(other, NEXT)

    monkeypatch.setattr(one.store, "require_valid", meanwhile)
    with pytest.raises(LoadRejected, match="another load|already stored"):
        load(one, DAY)
    assert [day for _, day in held(one, table)] == [NEXT] == [day for _, day in held(opened(spark, root), table)]


def test_the_second_of_two_dimension_loads_is_refused_and_changes_nothing(spark, root, monkeypatch):
    one, other = opened(spark, root), opened(spark, root)
    stage(one, S.STG_CUSTOMERS, ("1", "Ann", None, "2025-03-01"))
    checked = one.store.require_valid

    def meanwhile(run):
        checked(run)
        other.load_txf_customers(NEXT)

    monkeypatch.setattr(one.store, "require_valid", meanwhile)
    with pytest.raises(LoadRejected, match="another load"):
        one.load_txf_customers(DAY)
    assert held(one, S.TXF_CUSTOMERS) == [("1", NEXT)]
    monkeypatch.undo()
    one.load_txf_customers(DAY)
    assert held(other, S.TXF_CUSTOMERS) == [("1", DAY)]


# --- clean-up --------------------------------------------------------------------------------


def test_vacuum_deletes_what_no_kept_version_holds(spark, root):
    wh = opened(spark, root)
    stage(wh, S.STG_SALES, sale("a"), sale("b", NEXT))
    for day in (DAY, NEXT, DAY, DAY):
        wh.load_txf_sales(day)
    stage(wh, S.STG_CUSTOMERS, ("1", "Ann", None, "2025-03-01"))
    for _ in range(3):
        wh.load_txf_customers(DAY)
    sales, customers = held(wh), held(wh, S.TXF_CUSTOMERS)
    assert wh.vacuum() == {t.name: 0 for t in S.ALL_TABLES if not t.raw}  # all of it is young
    assert len(run_folders(wh, S.TXF_SALES)) == 4
    gone = wh.vacuum(timedelta(0))
    assert (gone["txf_sales"], gone["txf_customers"]) == (2, 2)
    assert len(run_folders(wh, S.TXF_SALES)) == 2 and len(run_folders(wh, S.TXF_CUSTOMERS)) == 1
    assert (held(wh), held(wh, S.TXF_CUSTOMERS)) == (sales, customers)
    again = opened(spark, root)
    assert (held(again), held(again, S.TXF_CUSTOMERS)) == (sales, customers)
    again.load_txf_sales(DAY)
    assert [vin for vin, _ in held(wh)] == ["a", "b"]


def test_dropping_entries_keeps_files(spark, root):
    wh = opened(spark, root)
    stage(wh, S.STG_SALES, sale("a"))
    wh.load_txf_sales(DAY)
    rows = held(wh)
    wh.store.drop_entries()
    assert not spark.catalog.databaseExists(wh.store.database)
    assert held(opened(spark, root)) == rows
