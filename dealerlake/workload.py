"""The warehouse's operators run over the benchmark tables.

Those tables hold no car sales, so each staging table is derived from one of them
by projection: orders become sales, events become services, customers become
customers and addresses. Every query reads its tables whole. Where a join or an
upsert needs keys on one side only, the two sides number their customers
differently (every second, every third number) instead of leaving rows out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions import invoice_bucket, parse_birth_date, to_millis
from dealerlake.operators import (
    count_violations,
    dedupe_first_last,
    key_violations,
    length_counts,
    null_counts,
)
from dealerlake.plans import (
    build_stg_customer_address,
    build_txf_after_sales,
    build_txf_customer_address,
    build_txf_customers,
    build_txf_sales,
    mart_cust_service_prio,
    mart_sales,
    mart_sales_rejects,
    typed_sales,
)
from dealerlake.session import configure, scratch_dir
from dealerlake.sources import read_address_file, write_address_file
from dealerlake.warehouse import Warehouse

LOAD_TS = datetime(2025, 9, 1, 8, 0)
EARLIER_TS = datetime(2025, 8, 1, 8, 0)
RUN_DATE = LOAD_TS.date()
NEXT_DAY = date(2025, 9, 2)
SALES_DAY = date(1998, 2, 6)
SERVICE_DAY = date(2024, 1, 15)


# Stated rather than inferred: inferring costs a job per table before the query even starts.
_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_partkey bigint, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def staged_sales(spark: SparkSession, sf_dir: str, years_later: int = 0) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS vin",
        "CAST(o_custkey AS STRING) AS customer_id",
        "o_orderpriority AS model",
        f"CAST(add_months(o_orderdate, {12 * years_later}) AS STRING) AS invoice_date",
        "replace(format_number(CAST(round(o_totalprice * 1000) AS BIGINT), 0), ',', '.') AS price",
        "CAST(o_orderdate AS STRING) AS created_at",
    )


def staged_after_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS service_ticket",
        "event_type AS vin",
        "CAST(user_id AS STRING) AS customer_id",
        "event_type AS model",
        "CAST(CAST(ts AS DATE) AS STRING) AS service_date",
        "CASE event_id % 3 WHEN 0 THEN 'BP' WHEN 1 THEN 'PM' ELSE 'GR' END AS service_type",
        "CAST(ts AS STRING) AS created_at",
    )


def staged_customers(spark: SparkSession, sf_dir: str, number: str = "c_custkey") -> DataFrame:
    """Customers numbered by the expression ``number``.

    Birth dates in turn: three spellings, a day that does not exist, and none.
    """
    born = "date_add(DATE'1950-01-01', CAST(c_custkey % 20000 AS INT))"
    return _table(spark, sf_dir, "customer").selectExpr(
        f"CAST({number} AS STRING) AS id",
        "c_name AS name",
        f"""CASE c_custkey % 5 WHEN 0 THEN CAST({born} AS STRING)
                               WHEN 1 THEN date_format({born}, 'yyyy/MM/dd')
                               WHEN 2 THEN date_format({born}, 'dd/MM/yyyy')
                               WHEN 3 THEN '30/02/1990' END AS dob""",
        """CAST(TIMESTAMP_NTZ'2025-03-01 00:00:00'
                + make_dt_interval(0, 0, 0, c_custkey * CAST(1.0126 AS DECIMAL(8, 6))) AS STRING) AS created_at""",
    )


def addresses(spark: SparkSession, sf_dir: str, number: str) -> DataFrame:
    """One address line per customer row, for the customer numbered by the expression ``number``."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "concat('A', c_custkey) AS id",
            f"CAST({number} AS STRING) AS customer_id",
            r"""concat('"', n_name, '" \\ RT 1/RW 2, ', c_name) AS address""",
            "CASE WHEN c_acctbal >= 0 THEN n_name END AS city",
            "r_name AS province",
            "'2026-03-01 14:24:40.0125' AS created_at",
            "c_custkey",
        )
    )


def _nothing(spark: SparkSession, table: S.Table) -> DataFrame:
    """The table before its first load; Spark drops such a side from the plan."""
    columns = [f"CAST(NULL AS {c.dtype.simpleString()}) AS {c.name}" for c in table.columns]
    return spark.range(1).selectExpr(*columns).filter("false")


# Stored rows of one market segment were loaded on the run date, all others a month before.
_LOADED_AT = f"""CASE c_mktsegment WHEN 'BUILDING' THEN TIMESTAMP_NTZ'{LOAD_TS}'
                                   ELSE TIMESTAMP_NTZ'{EARLIER_TS}' END AS load_timestamp"""


def _initial_sales(spark: SparkSession, sf_dir: str, years_later: int = 0) -> DataFrame:
    staged = staged_sales(spark, sf_dir, years_later)
    return build_txf_sales(staged, _nothing(spark, S.TXF_SALES), RUN_DATE, True, LOAD_TS)


def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_sales(_initial_sales(spark, sf_dir))


def sales_mart_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_sales_rejects(_initial_sales(spark, sf_dir)).drop("load_timestamp")


def service_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    services = after_sales_initial(spark, sf_dir)
    nobody, nowhere = _nothing(spark, S.TXF_CUSTOMERS), _nothing(spark, S.TXF_CUSTOMER_ADDRESS)
    customers = build_txf_customers(staged_customers(spark, sf_dir, "c_custkey * 2"), nobody, RUN_DATE, LOAD_TS)
    places = build_txf_customer_address(addresses(spark, sf_dir, "c_custkey * 3"), nowhere, RUN_DATE, LOAD_TS)
    return mart_cust_service_prio(services, customers, places)


def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """A warehouse in ``folder``, under a database of its own."""
    buckets = spark.sparkContext.defaultParallelism  # one per core, so it grows with the cluster
    return Warehouse(spark, folder, database=f"dwh_{uuid.uuid4().hex}", buckets=buckets)


def service_mart_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mart by way of the daily flows: staged, loaded, checked and published as tables."""
    folder = scratch_dir(spark, "warehouse")
    warehouse = _warehouse(spark, folder)
    warehouse.append_staging(S.STG_CUSTOMERS, staged_customers(spark, sf_dir, "c_custkey * 2"))
    warehouse.append_staging(S.STG_AFTER_SALES, staged_after_sales(spark, sf_dir))
    write_address_file(addresses(spark, sf_dir, "c_custkey * 3"), f"{folder}/incoming", RUN_DATE)
    warehouse.ingest_stg_customer_address(f"{folder}/incoming", RUN_DATE)
    warehouse.load_txf_customers(RUN_DATE)
    warehouse.load_txf_customer_address(RUN_DATE)
    warehouse.load_txf_after_sales(RUN_DATE, initial_load=True)
    warehouse.load_mart_cust_service_prio()
    mart = warehouse.table(S.MART_CUST_SERVICE_PRIO).drop("load_timestamp")
    warehouse.store.drop_entries()  # the rows are read from files that stay
    return mart


def sales_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as stored, read by a second opening of the warehouse.

    All of them were loaded at once; then each vehicle was sold again two years later, which came
    by the load of one day, run twice.
    """
    folder = scratch_dir(spark, "warehouse")
    first = _warehouse(spark, folder)
    made = staged_sales(spark, sf_dir, years_later=25).withColumn("created_at", F.lit(f"{EARLIER_TS}"))
    first.append_staging(S.STG_SALES, made)
    first.load_txf_sales(RUN_DATE, initial_load=True, load_ts=LOAD_TS)
    later = staged_sales(spark, sf_dir, years_later=27).withColumn("created_at", F.lit(f"{NEXT_DAY} 06:30:00"))
    first.append_staging(S.STG_SALES, later)
    for _ in range(2):
        first.load_txf_sales(NEXT_DAY, load_ts=datetime.combine(NEXT_DAY, LOAD_TS.time()))
    first.store.drop_entries()
    second = _warehouse(spark, folder)
    sales = second.store.read(S.TXF_SALES)
    second.store.drop_entries()
    return sales


def after_sales_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services as stored after an initial load of all of them and a day loaded twice, under tickets of its own."""
    warehouse = _warehouse(spark, scratch_dir(spark, "warehouse"))
    staged = staged_after_sales(spark, sf_dir)
    warehouse.append_staging(S.STG_AFTER_SALES, staged)
    warehouse.load_txf_after_sales(RUN_DATE, initial_load=True, load_ts=LOAD_TS)
    again = staged.withColumns({"service_ticket": F.concat(F.lit("N"), "service_ticket"), "created_at": F.lit(f"{NEXT_DAY} 06:30:00")})
    warehouse.append_staging(S.STG_AFTER_SALES, again)
    for _ in range(2):
        warehouse.load_txf_after_sales(NEXT_DAY, load_ts=datetime.combine(NEXT_DAY, LOAD_TS.time()))
    services = warehouse.table(S.TXF_AFTER_SALES)
    warehouse.store.drop_entries()
    return services


def service_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose numbers are stored as service tickets, those of large orders brought twice."""
    warehouse = _warehouse(spark, scratch_dir(spark, "warehouse"))
    warehouse.append_staging(S.STG_AFTER_SALES, staged_after_sales(spark, sf_dir))
    warehouse.load_txf_after_sales(RUN_DATE, initial_load=True, load_ts=LOAD_TS)
    orders = _table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey * 3 AS STRING) AS service_ticket", "o_totalprice")
    batch = orders.unionByName(orders.filter("o_totalprice >= 100000")).select("service_ticket")
    found = warehouse.ticket_violations(batch)
    warehouse.store.drop_entries()
    return found


def sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _nothing(spark, S.TXF_SALES)
    return build_txf_sales(staged_sales(spark, sf_dir), target, SALES_DAY, False, LOAD_TS)


def sales_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales stored under the day they were made; one day's load is run again."""
    staged = staged_sales(spark, sf_dir)
    stored = typed_sales(staged, LOAD_TS).withColumn("load_timestamp", F.expr("created_at + INTERVAL '8' HOUR"))
    return build_txf_sales(staged, stored, SALES_DAY, False, datetime(1998, 2, 6, 9, 30))


def sales_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _initial_sales(spark, sf_dir, years_later=25)
        .groupBy(invoice_bucket(F.col("invoice_date")).alias("inv_bucket"))
        .agg(
            F.count("*").alias("sales"),
            F.min("invoice_date").alias("first_invoice"),
            F.max("invoice_date").alias("last_invoice"),
        )
    )


def after_sales_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _nothing(spark, S.TXF_AFTER_SALES)
    return build_txf_after_sales(staged_after_sales(spark, sf_dir), target, RUN_DATE, True, LOAD_TS)


def after_sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _nothing(spark, S.TXF_AFTER_SALES)
    return build_txf_after_sales(staged_after_sales(spark, sf_dir), target, SERVICE_DAY, False, LOAD_TS)


def customers_birth_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_customers(spark, sf_dir).select("id", "dob", parse_birth_date(F.col("dob")).alias("birth_date"))


def customers_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: every number. Staged: every second one, up to twice as far."""
    stored = _table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS id",
        "concat('former ', c_name) AS name",
        "DATE'1970-01-01' AS dob",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS created_at",
        _LOADED_AT,
    )
    return build_txf_customers(staged_customers(spark, sf_dir, "c_custkey * 2"), stored, RUN_DATE, LOAD_TS)


def _stored_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(
        "concat('S', c_custkey) AS id",
        "CAST(c_custkey * 2 AS STRING) AS customer_id",
        "c_name AS address",
        "'Bekasi' AS city",
        "'Jawa Barat' AS province",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS created_at",
        _LOADED_AT,
    )


def address_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: every second customer number. Staged: every third."""
    staged = addresses(spark, sf_dir, "c_custkey * 3")
    return build_txf_customer_address(staged, _stored_addresses(spark, sf_dir), RUN_DATE, LOAD_TS)


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily file with several lines for many customers, applied to stored addresses."""
    folder = scratch_dir(spark, "csv-ingest")
    write_address_file(addresses(spark, sf_dir, "c_custkey + c_nationkey").orderBy("c_custkey"), folder, RUN_DATE)
    stored = _stored_addresses(spark, sf_dir).withColumns(
        {"created_at": F.expr("CAST(created_at AS STRING)"), "load_timestamp": F.expr("CAST(load_timestamp AS TIMESTAMP)")}
    )
    merged = build_stg_customer_address(read_address_file(spark, folder, RUN_DATE), stored, LOAD_TS)
    return merged.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


def first_and_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS customer_id",
        "CAST(o_orderkey AS STRING) AS id",
        "o_orderpriority AS model",
        "nullif(o_orderstatus, 'P') AS status",
        "struct(o_orderdate, o_orderkey) AS position",
    )
    return dedupe_first_last(rows, "customer_id", "position", first=["id"])


def millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_after_sales(spark, sf_dir)
    return staged.select("service_ticket", to_millis(F.col("created_at")).alias("created_at"))


def sales_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders keyed by customer and day repeat some keys, and meet line items keyed by part and day."""
    batch = _table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS vin", "CAST(o_orderdate AS DATE) AS invoice_date"
    )
    stored = _table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_partkey AS STRING) AS vin", "CAST(l_shipdate AS DATE) AS invoice_date"
    )
    return key_violations(stored, batch, S.TXF_SALES.key)


def sales_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = typed_sales(staged_sales(spark, sf_dir), LOAD_TS)
    holed = sales.selectExpr(
        "CASE WHEN model <> '2-HIGH' THEN vin END AS vin",
        "CASE WHEN price >= 50000000 THEN invoice_date END AS invoice_date",
    )
    return count_violations(holed, null_counts(S.TXF_SALES))


def service_length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wordy = staged_after_sales(spark, sf_dir).withColumns(
        {"service_ticket": F.expr("concat_ws('-', 'T', service_ticket, vin)"), "service_type": F.col("vin")}
    )
    return count_violations(wordy, length_counts(S.TXF_AFTER_SALES))


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, rows left after deduplication and birth dates given up, for staged customers.

    Counted per customer first, so one scan and one pre-aggregated shuffle give every measure.
    """
    dob = F.col("dob")
    customers = (
        staged_customers(spark, sf_dir, "c_custkey + c_nationkey")
        .groupBy("id")
        .agg(
            F.count("*").alias("read"),
            F.count_if(dob.isNull()).alias("missing"),
            F.count_if(dob.isNotNull() & parse_birth_date(dob).isNull()).alias("unreadable"),
        )
    )
    totals = customers.agg(
        F.sum("read").alias("rows read"),
        F.count("*").alias("rows loaded"),
        F.sum("missing").alias("missing birth dates"),
        F.sum("unreadable").alias("unreadable birth dates"),
    )
    return totals.unpivot([], [F.col(f"`{c}`") for c in totals.columns], "measure", "amount")


def load_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reports of real loads say of an address file, customers, their addresses and all sales."""
    folder = scratch_dir(spark, "warehouse")
    warehouse = _warehouse(spark, folder)
    warehouse.append_staging(S.STG_CUSTOMERS, staged_customers(spark, sf_dir, "c_custkey + c_nationkey"))
    warehouse.append_staging(S.STG_SALES, staged_sales(spark, sf_dir))
    write_address_file(addresses(spark, sf_dir, "c_custkey + c_nationkey"), f"{folder}/incoming", RUN_DATE)
    reports = [
        warehouse.ingest_stg_customer_address(f"{folder}/incoming", RUN_DATE),
        warehouse.load_txf_customers(RUN_DATE),
        warehouse.load_txf_customer_address(RUN_DATE),
        warehouse.load_txf_sales(RUN_DATE, initial_load=True),
    ]
    warehouse.store.drop_entries()
    told = [(r.table, {"rows read": r.rows_read, "rows written": r.rows_written} | r.notes) for r in reports]
    amounts = [(table, measure, amount) for table, measures in told for measure, amount in measures.items()]
    return spark.createDataFrame(amounts, "table_name string, measure string, amount long")


_QUERIES = {
    "mart_sales": sales_mart,
    "mart_sales_rejects": sales_mart_rejects,
    "mart_cust_service_prio": service_mart,
    "mart_cust_service_prio_loaded": service_mart_loaded,
    "txf_sales_loaded": sales_loaded,
    "txf_sales_initial": _initial_sales,
    "txf_sales_incremental": sales_incremental,
    "txf_sales_rerun": sales_rerun,
    "sales_inv_bucket": sales_by_bucket,
    "txf_after_sales_rerun": after_sales_rerun,
    "txf_after_sales_initial": after_sales_initial,
    "txf_after_sales_incremental": after_sales_incremental,
    "txf_customers_dob": customers_birth_dates,
    "txf_customers_upsert": customers_upsert,
    "txf_address_upsert": address_upsert,
    "csv_ingest": csv_ingest,
    "dedupe_first_last": first_and_last_order,
    "ts_millis": millis,
    "pk_violations_sales": sales_key_violations,
    "pk_violations_after_sales": service_key_violations,
    "not_null_violations": sales_null_violations,
    "length_violations": service_length_violations,
    "load_report": load_report,
    "load_reports": load_reports,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def configured(query):
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {name: configured(query) for name, query in _QUERIES.items()}
