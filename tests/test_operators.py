"""Merging and checking, row by row."""

from datetime import date, datetime

import pytest

from dealerlake import schemas as S
from dealerlake.operators import (
    count_violations,
    dedupe_first_last,
    drop_loaded_on,
    duplicate_keys,
    key_violations,
    length_counts,
    null_counts,
    upsert,
)

DAY = date(2025, 8, 2)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_drop_loaded_on_keeps_rows_without_a_load_time(spark):
    target = spark.createDataFrame(
        [("a", datetime(2025, 8, 2, 0, 0)), ("b", datetime(2025, 8, 2, 23, 59, 59, 999999)),
         ("c", datetime(2025, 8, 3)), ("d", datetime(2025, 8, 1, 23, 59)), ("e", None)],
        "k string, load_timestamp timestamp_ntz",
    )
    assert [r.k for r in drop_loaded_on(target, DAY).orderBy("k").collect()] == ["c", "d", "e"]


def test_drop_loaded_on_uses_the_load_date_folder(spark):
    target = spark.createDataFrame(
        [("a", None, DAY), ("b", None, date(2025, 8, 3)), ("c", None, None)],
        "k string, load_timestamp timestamp_ntz, load_date date",
    )
    assert [r.k for r in drop_loaded_on(target, DAY).orderBy("k").collect()] == ["b", "c"]


def test_dedupe_takes_id_from_first_and_the_rest_from_last(spark):
    lines = spark.createDataFrame(
        [(3, "7", "12", None), (1, "7", "10", "old street"), (2, "7", "11", "street"), (9, "8", "13", "only")],
        "line int, customer_id string, id string, address string",
    )
    assert rows(dedupe_first_last(lines, "customer_id", "line", first=["id"])) == [
        ("7", "10", None),
        ("8", "13", "only"),
    ]


def test_upsert(spark):
    columns = "id string, k string, v string"
    target = spark.createDataFrame([("1", "a", "old"), ("2", "b", "stays"), (None, "c", "old")], columns)
    source = spark.createDataFrame([("9", "a", None), ("8", "n", "new"), ("7", "c", "new")], columns)
    assert rows(upsert(target, source, "k")) == [
        ("2", "b", "stays"), ("7", "c", "new"), ("8", "n", "new"), ("9", "a", None)
    ]
    assert rows(upsert(target, source, "k", insert_only=["id"])) == [
        ("1", "a", None), ("2", "b", "stays"), ("8", "n", "new"), (None, "c", "new")
    ]


def test_upsert_twice_changes_nothing(spark):
    columns = "id string, k string, v string"
    target = spark.createDataFrame([("1", "a", "old"), ("2", "b", "stays")], columns)
    source = spark.createDataFrame([("9", "a", None), ("8", "n", "new")], columns)
    once = upsert(target, source, "k", insert_only=["id"])
    assert rows(upsert(once, source, "k", insert_only=["id"])) == rows(once)


def test_upsert_matches_columns_by_name(spark):
    target = spark.createDataFrame([("a", "old")], "k string, v string")
    source = spark.createDataFrame([("new", "a")], "v string, k string")
    assert rows(upsert(target, source, "k")) == [("a", "new")]


def test_a_null_source_key_reaches_the_result_for_the_check_to_find(spark):
    target = spark.createDataFrame([("a", "old")], "k string, v string")
    source = spark.createDataFrame([(None, "lost")], "k string, v string")
    assert (None, "lost") in rows(upsert(target, source, "k"))


def test_length_and_null_counts(spark):
    services = spark.createDataFrame(
        [("T" * 10, "PM"), ("T" * 11, "PM"), (None, "service"), ("é" * 10, None)],
        "service_ticket string, service_type string",
    ).selectExpr("*", "'v' AS vin", "'c' AS customer_id", "'m' AS model")
    assert dict(rows(count_violations(services, length_counts(S.TXF_AFTER_SALES)))) == {
        "service_ticket longer than 10": 1,
        "vin longer than 50": 0,
        "customer_id longer than 255": 0,
        "model longer than 50": 0,
        "service_type longer than 5": 1,
    }
    assert rows(count_violations(services, null_counts(S.TXF_AFTER_SALES))) == [("service_ticket is null", 1)]


@pytest.mark.parametrize(
    "table, required",
    [
        (S.STG_CUSTOMER_ADDRESS, ["customer_id"]),
        (S.TXF_CUSTOMERS, ["id"]),
        (S.TXF_SALES, ["vin", "invoice_date"]),
        (S.MART_SALES, ["periode", "class", "model"]),
        (S.MART_CUST_SERVICE_PRIO, []),
    ],
)
def test_required_columns(table, required):
    assert table.required == required


def test_key_violations(spark):
    columns = "vin string, invoice_date date"
    other = date(2025, 8, 3)
    stored = spark.createDataFrame([("a", DAY), ("b", DAY), ("z", DAY)], columns)
    batch = spark.createDataFrame([("a", DAY), ("a", other), ("b", DAY), ("b", DAY), ("c", DAY), (None, DAY)], columns)
    assert rows(key_violations(stored, batch, ["vin", "invoice_date"])) == [
        ("a", DAY, 1, "already stored"),
        ("b", DAY, 2, "already stored"),
        ("b", DAY, 2, "repeated in batch"),
    ]
    assert rows(duplicate_keys(batch, ["vin", "invoice_date"])) == [("b", DAY, 2)]
