from dealerlake.plans.dimensions import build_stg_customer_address, build_txf_customer_address, build_txf_customers
from dealerlake.plans.facts import build_txf_after_sales, build_txf_sales, typed_after_sales, typed_sales
from dealerlake.plans.marts import mart_cust_service_prio, mart_sales, mart_sales_rejects

__all__ = [
    "build_stg_customer_address",
    "build_txf_after_sales",
    "build_txf_customer_address",
    "build_txf_customers",
    "build_txf_sales",
    "mart_cust_service_prio",
    "mart_sales",
    "mart_sales_rejects",
    "typed_after_sales",
    "typed_sales",
]
