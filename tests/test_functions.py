"""Column expressions, at every branch and edge."""

import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dealerlake.functions import (
    invoice_bucket,
    moment,
    outside_price_classes,
    parse_birth_date,
    parse_price,
    price_class,
    service_priority,
    to_millis,
)


def apply(spark, expression, values, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_birth_dates(spark):
    cases = {
        "1998-08-04": date(1998, 8, 4),
        "1980/11/15": date(1980, 11, 15),
        "14/01/1995": date(1995, 1, 14),
        "1900-01-01": date(1900, 1, 1),
        "2024-02-29": date(2024, 2, 29),
        "2025-02-30": None,
        "30/02/2025": None,
        "2025/13/01": None,
        "x": None,
        "": None,
        "1998-8-4": None,
        "1998-08-04 10:00:00": None,
        "1998/08-04": None,
        "14-01-1995": None,
        None: None,
    }
    assert apply(spark, parse_birth_date, list(cases)) == list(cases.values())


def test_prices(spark):
    cases = {
        "350.000.000": Decimal("350000000.00000"),
        "1.50": Decimal("150.00000"),
        "7": Decimal("7.00000"),
        None: None,
    }
    assert apply(spark, parse_price, list(cases)) == list(cases.values())


@pytest.mark.parametrize("text", ["", "12,5 juta"])
def test_unreadable_price_fails(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, parse_price, [text])


def test_millis_round_half_up(spark):
    cases = {
        "2025-03-01 14:24:40.012600": datetime(2025, 3, 1, 14, 24, 40, 13000),
        "2025-03-01 14:24:40.0125": datetime(2025, 3, 1, 14, 24, 40, 13000),
        "2025-03-01 14:24:40.012499": datetime(2025, 3, 1, 14, 24, 40, 12000),
        "2025-12-31 23:59:59.9995": datetime(2026, 1, 1),
        "1969-12-31 23:59:59.1235": datetime(1969, 12, 31, 23, 59, 59, 124000),
        "2025-03-01": datetime(2025, 3, 1),
        None: None,
    }
    assert apply(spark, to_millis, list(cases)) == list(cases.values())


def test_millis_ignore_the_session_zone(spark):
    """02:30 on this day does not exist in Berlin, yet it is a valid zone-less time."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert apply(spark, to_millis, ["2025-03-30 02:30:00.0126"]) == [datetime(2025, 3, 30, 2, 30, 0, 13000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_constant_moments_ignore_the_machine_zone(spark, monkeypatch):
    monkeypatch.setenv("TZ", "Asia/Jakarta")
    time.tzset()
    try:
        text = spark.range(1).select(moment(datetime(2025, 9, 1, 8, 0, 0, 5)).cast("string").alias("t")).first().t
    finally:
        monkeypatch.undo()
        time.tzset()
    assert text == "2025-09-01 08:00:00.000005"


def test_price_classes(spark):
    cases = {
        "99999999": None,
        "100000000": "LOW",
        "250000000": "LOW",
        "250000000.5": None,
        "250000001": "MEDIUM",
        "400000000": "MEDIUM",
        "400000000.00001": "HIGH",
        "400000001": "HIGH",
        None: None,
    }
    values = [None if v is None else Decimal(v) for v in cases]
    assert apply(spark, price_class, values, "decimal(38,5)") == list(cases.values())
    assert apply(spark, outside_price_classes, values, "decimal(38,5)") == [c is None for c in cases.values()]


def test_service_priorities(spark):
    cases = {1: "LOW", 4: "LOW", 5: "MED", 10: "MED", 11: "HIGH"}
    assert apply(spark, service_priority, list(cases), "int") == list(cases.values())


def test_invoice_buckets(spark):
    cases = {
        date(1999, 5, 1): "p2022",
        date(2022, 12, 31): "p2022",
        date(2023, 1, 1): "p2023",
        date(2024, 12, 31): "p2024",
        date(2025, 1, 1): "p2025",
        date(2025, 12, 31): "p2025",
        date(2026, 1, 1): "pmax",
    }
    assert apply(spark, invoice_bucket, list(cases), "date") == list(cases.values())
