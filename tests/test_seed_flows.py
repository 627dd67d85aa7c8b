"""All seven flows on the seed rows, from staging to the two marts."""

from datetime import date

import pytest
import seed

from dealerlake import schemas as S
from dealerlake.sources import write_address_file
from dealerlake.warehouse import Warehouse

DAY = date(2026, 3, 27)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("seed")
    wh = Warehouse(spark, str(root / "tables"), database="seed_flows")
    for table, rows in (
        (S.STG_CUSTOMERS, seed.CUSTOMERS),
        (S.STG_SALES, seed.SALES),
        (S.STG_AFTER_SALES, seed.AFTER_SALES),
    ):
        wh.append_staging(table, spark.createDataFrame(rows, table.struct))
    address_rows = spark.createDataFrame(seed.ADDRESSES, ",".join(f"{c} string" for c in S.STG_CUSTOMER_ADDRESS.names[:6]))
    write_address_file(address_rows, str(root / "in"), DAY)
    reports = {
        "stg_address": wh.ingest_stg_customer_address(str(root / "in"), DAY),
        "customers": wh.load_txf_customers(DAY),
        "addresses": wh.load_txf_customer_address(DAY),
        "sales": wh.load_txf_sales(DAY, initial_load=True),
        "after_sales": wh.load_txf_after_sales(DAY, initial_load=True),
        "mart_sales": wh.load_mart_sales(),
        "mart_service": wh.load_mart_cust_service_prio(),
    }
    return wh, reports


def test_birth_dates(loaded):
    wh, _ = loaded
    rows = wh.table(S.TXF_CUSTOMERS).select("id", "dob").collect()
    assert dict(map(tuple, rows)) == seed.BIRTH_DATES


def test_sales_mart(loaded):
    wh, _ = loaded
    assert {tuple(r)[:4] for r in wh.table(S.MART_SALES).collect()} == seed.SALES_MART


def test_service_mart(loaded):
    wh, _ = loaded
    assert {tuple(r)[:6] for r in wh.table(S.MART_CUST_SERVICE_PRIO).collect()} == seed.SERVICE_MART


def test_reports(loaded):
    _, reports = loaded
    assert {name: (r.rows_read, r.rows_written) for name, r in reports.items()} == {
        "stg_address": (4, 4),
        "customers": (6, 6),
        "addresses": (4, 4),
        "sales": (5, 5),
        "after_sales": (3, 3),
        "mart_sales": (5, 4),
        "mart_service": (3, 3),
    }
    assert reports["stg_address"].notes == {"malformed lines": 0}
    assert reports["customers"].notes == {"unreadable birth dates": 0}


def test_tables_have_their_declared_types(loaded):
    wh, _ = loaded
    for table in S.ALL_TABLES:
        assert wh.table(table).schema == table.struct


def test_sales_sit_under_load_date_and_bucket(loaded):
    wh, _ = loaded
    rows = wh.store.read(S.TXF_SALES).select("load_date", "inv_bucket").distinct().collect()
    assert {tuple(r) for r in rows} == {(DAY, "p2025")}
