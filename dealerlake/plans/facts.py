"""Sales and service facts: append all of staging, or replace one day's load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.functions import moment, parse_price, to_millis
from dealerlake.operators import drop_loaded_on
from dealerlake.schemas import TXF_AFTER_SALES, TXF_SALES, Table
from dealerlake.sources.staging import created_on


def typed_sales(staged: DataFrame, load_ts: datetime) -> DataFrame:
    """Staged sales in the fact's types. Text that is no date, price or timestamp fails the load."""
    return staged.select(
        "vin",
        "customer_id",
        "model",
        F.col("invoice_date").cast("date").alias("invoice_date"),
        parse_price(F.col("price")).alias("price"),
        to_millis(F.col("created_at")).alias("created_at"),
        moment(load_ts).alias("load_timestamp"),
    )


def typed_after_sales(staged: DataFrame, load_ts: datetime) -> DataFrame:
    """Staged service tickets in the fact's types."""
    return staged.select(
        "service_ticket",
        "vin",
        "customer_id",
        "model",
        F.col("service_date").cast("date").alias("service_date"),
        "service_type",
        to_millis(F.col("created_at")).alias("created_at"),
        moment(load_ts).alias("load_timestamp"),
    )


def build_txf_sales(
    staged: DataFrame, target: DataFrame, run_date: date, initial_load: bool, load_ts: datetime
) -> DataFrame:
    """The sales fact after a load.

    Initial: everything staged is appended. Otherwise rows *loaded* on ``run_date``
    make way for the staged rows *created* on it.
    """
    return _after_load(TXF_SALES, typed_sales, staged, target, run_date, initial_load, load_ts)


def build_txf_after_sales(
    staged: DataFrame, target: DataFrame, run_date: date, initial_load: bool, load_ts: datetime
) -> DataFrame:
    """The service fact after a load; same rule as ``build_txf_sales``."""
    return _after_load(TXF_AFTER_SALES, typed_after_sales, staged, target, run_date, initial_load, load_ts)


def _after_load(
    table: Table, typed, staged: DataFrame, target: DataFrame, run_date: date, initial_load: bool, load_ts: datetime
) -> DataFrame:
    if not initial_load:
        staged = created_on(staged, run_date)
        target = drop_loaded_on(target, run_date)
    return target.select(*table.names).unionByName(typed(staged, load_ts))
