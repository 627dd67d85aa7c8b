"""Banding rules: price class, service priority and invoice-date bucket."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive price ranges per class; the open top class lies above the last of them.
PRICE_RANGES = (
    ("LOW", 100_000_000, 250_000_000),
    ("MEDIUM", 250_000_001, 400_000_000),
)
TOP_PRICE_CLASS = "HIGH"

# Yearly service counts; above the range is HIGH, below it is LOW.
MEDIUM_SERVICE_COUNTS = (5, 10)

# Bucket name and the first invoice date that is past it.
INVOICE_BUCKETS = (
    ("p2022", date(2023, 1, 1)),
    ("p2023", date(2024, 1, 1)),
    ("p2024", date(2025, 1, 1)),
    ("p2025", date(2026, 1, 1)),
)
LAST_INVOICE_BUCKET = "pmax"


def price_class(price: Column) -> Column:
    """LOW / MEDIUM / HIGH; NULL below the lowest range and in the gap between two ranges."""
    (name, low, high), *others = PRICE_RANGES
    band = F.when(price.between(low, high), name)
    for name, low, high in others:
        band = band.when(price.between(low, high), name)
    return band.when(price > high, TOP_PRICE_CLASS)


def outside_price_classes(price: Column) -> Column:
    """True exactly where ``price_class`` is NULL, as plain comparisons a Parquet scan can use to skip data."""
    uncovered = price.isNull() | (price < PRICE_RANGES[0][1])
    starts = [low for _, low, _ in PRICE_RANGES[1:]]
    for (_, _, high), next_low in zip(PRICE_RANGES, starts):
        uncovered |= (price > high) & (price < next_low)
    return uncovered


def service_priority(count: Column) -> Column:
    low, high = MEDIUM_SERVICE_COUNTS
    return F.when(count > high, "HIGH").when(count >= low, "MED").otherwise("LOW")


def invoice_bucket(day: Column) -> Column:
    """Name of the invoice-date range a sale is stored under."""
    (name, past), *later = INVOICE_BUCKETS
    bucket = F.when(day < F.lit(past), name)
    for name, past in later:
        bucket = bucket.when(day < F.lit(past), name)
    return bucket.otherwise(LAST_INVOICE_BUCKET)
