"""Every registered query against its SQL, run by DuckDB on the same files."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from dealerlake import workload, workload_sql  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
QUERIES = workload.queries()
ORACLE = workload_sql.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted([repr(tuple(row[i] for i in order)) for row in rows])


def test_every_warehouse_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(names)
    actual = as_rows(frame.columns, frame.collect())
    assert actual == as_rows(names, expected.fetchall())
    assert actual


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.periode for r in rows] == sorted(r.periode for r in rows)
    assert {r["class"] for r in rows} == {None, "LOW", "MEDIUM", "HIGH"}


def test_mart_total_is_the_sum_of_its_sales(spark):
    mart = QUERIES["mart_sales"](spark, SF_DIR).agg({"total": "sum"}).first()[0]
    assert mart == QUERIES["txf_sales_initial"](spark, SF_DIR).agg({"price": "sum"}).first()[0]


def test_services_of_known_customers_are_all_counted(spark):
    mart = QUERIES["mart_cust_service_prio"](spark, SF_DIR).agg({"count_service": "sum"}).first()[0]
    services = QUERIES["txf_after_sales_initial"](spark, SF_DIR)
    assert mart == services.filter("CAST(customer_id AS INT) % 2 = 0").count()
