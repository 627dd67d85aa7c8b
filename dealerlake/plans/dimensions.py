"""Customer and address tables: every load upserts all staged rows on the key."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.functions import moment, parse_birth_date, to_millis
from dealerlake.operators import dedupe_first_last, drop_loaded_on, upsert
from dealerlake.schemas import STG_CUSTOMER_ADDRESS, TXF_CUSTOMER_ADDRESS, TXF_CUSTOMERS
from dealerlake.sources.address_files import FIELDS, LINE_ORDER


def build_stg_customer_address(lines: DataFrame, target: DataFrame, load_ts: datetime) -> DataFrame:
    """Staged addresses after applying a daily file line by line.

    Of several lines for one customer the first supplies the id of a new row and the
    last everything else; a customer already staged keeps its id.
    """
    rows = dedupe_first_last(lines.select(*FIELDS, LINE_ORDER), "customer_id", LINE_ORDER, first=["id"])
    stamped = rows.withColumn("load_timestamp", moment(load_ts).cast("timestamp"))
    return upsert(target.select(*STG_CUSTOMER_ADDRESS.names), stamped, key="customer_id", insert_only=["id"])


def build_txf_customers(staged: DataFrame, target: DataFrame, run_date: date, load_ts: datetime) -> DataFrame:
    """Customers with cleaned birth dates.

    Rows loaded on ``run_date`` go first, so one that left staging since disappears.
    Of several staged rows with one id the latest by ``created_at`` wins, ties by the
    remaining columns, so a rerun picks the same row.
    """
    typed = staged.select(
        "id",
        "name",
        parse_birth_date(F.col("dob")).alias("dob"),
        to_millis(F.col("created_at")).alias("created_at"),
    )
    rows = dedupe_first_last(typed.withColumn("rank", F.struct("created_at", "name", "dob")), "id", "rank")
    stamped = rows.withColumn("load_timestamp", moment(load_ts))
    return upsert(drop_loaded_on(target, run_date).select(*TXF_CUSTOMERS.names), stamped, key="id")


def build_txf_customer_address(
    staged: DataFrame, target: DataFrame, run_date: date, load_ts: datetime
) -> DataFrame:
    """Addresses, one per customer as in staging. A row that outlives the delete keeps its id."""
    stamped = staged.select(
        "id",
        "customer_id",
        "address",
        "city",
        "province",
        to_millis(F.col("created_at")).alias("created_at"),
        moment(load_ts).alias("load_timestamp"),
    )
    kept = drop_loaded_on(target, run_date).select(*TXF_CUSTOMER_ADDRESS.names)
    return upsert(kept, stamped, key="customer_id", insert_only=["id"])
