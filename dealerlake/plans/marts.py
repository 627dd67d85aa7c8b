"""The two reporting tables, both rebuilt in full from the typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.functions import outside_price_classes, price_class, service_priority


def mart_sales(sales: DataFrame) -> DataFrame:
    """Sum of prices per invoice month, price class and model.

    Sales outside every price range form the NULL class. Rows are grouped by the
    first day of the month, so the month is turned to text once per result row.
    """
    return (
        sales.groupBy(
            F.trunc("invoice_date", "month").alias("month"),
            price_class(F.col("price")).alias("class"),
            "model",
        )
        .agg(F.sum("price").alias("total"))
        .select(F.date_format("month", "yyyy-MM").alias("periode"), "class", "model", "total")
    )


def mart_sales_rejects(sales: DataFrame) -> DataFrame:
    """Sales without a price class, which keep the sales mart from being loaded."""
    return sales.filter(outside_price_classes(F.col("price")))


def mart_cust_service_prio(after_sales: DataFrame, customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Services per year, vehicle and customer, with the customer's name, address and priority.

    Counting comes first: map tasks reduce repeat services before anything moves, and
    the joins see one row per group. Services of unknown customers drop out; a customer
    without an address keeps a NULL one.
    """
    counts = after_sales.groupBy(F.year("service_date").alias("periode"), "vin", "customer_id").agg(
        F.count("*").cast("int").alias("count_service")
    )
    people = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    return (
        counts.join(people, "customer_id")
        .join(addresses.select("customer_id", "address"), "customer_id", "left")
        .select(
            "periode",
            "vin",
            "customer_name",
            "address",
            "count_service",
            service_priority(F.col("count_service")).alias("priority"),
        )
    )
