"""Fixed table definitions: columns, keys, length limits and physical layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 5)
NTZ = T.TimestampNTZType()


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    max_length: int | None = None
    required: bool = False


def text(name: str, max_length: int | None = None, required: bool = False) -> Column:
    return Column(name, T.StringType(), max_length, required)


@dataclass(frozen=True)
class Table:
    """``columns`` is what readers see; ``layout`` columns only place the files.

    Files are ``sorted_by`` the columns whose range a key check can skip files on, and hold Bloom
    filters of the ``probed`` ones, whose values lie anywhere.
    ``raw`` tables only ever grow, so their folder alone says what they hold; each row also keeps
    the batch it came in, and a file holds rows of one batch only.
    ``bucketed`` tables are hashed on their key into the number of buckets the
    warehouse was created with, so key joins between them need no shuffle.
    """

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    layout: tuple[Column, ...] = ()
    sorted_by: tuple[str, ...] = ()
    probed: tuple[str, ...] = ()
    bucketed: bool = False
    raw: bool = False

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        """Declared NOT NULL columns plus the key, in column order."""
        return [c.name for c in self.columns if c.required or c.name in self.key]

    @property
    def limits(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length is not None}

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype) for c in self.columns])


LOAD_DATE = Column("load_date", T.DateType())
CREATED_DATE = Column("created_date", T.DateType())
BATCH = Column("batch", T.StringType())

STG_CUSTOMERS = Table(
    "stg_customers_raw",
    (text("id"), text("name"), text("dob"), text("created_at")),
    raw=True,
)

STG_SALES = Table(
    "stg_sales_raw",
    (
        text("vin"),
        text("customer_id"),
        text("model"),
        text("invoice_date"),
        text("price"),
        text("created_at"),
    ),
    layout=(CREATED_DATE,),
    raw=True,
)

STG_AFTER_SALES = Table(
    "stg_after_sales_raw",
    (
        text("service_ticket"),
        text("vin"),
        text("customer_id"),
        text("model"),
        text("service_date"),
        text("service_type"),
        text("created_at"),
    ),
    layout=(CREATED_DATE,),
    raw=True,
)

STG_CUSTOMER_ADDRESS = Table(
    "stg_customer_address",
    (
        text("id", 255),
        text("customer_id", 255, required=True),
        text("address", 255),
        text("city", 50),
        text("province", 25),
        text("created_at", 50),
        Column("load_timestamp", T.TimestampType()),
    ),
    key=("customer_id",),
    bucketed=True,
)

TXF_CUSTOMERS = Table(
    "txf_customers",
    (
        text("id", 255, required=True),
        text("name", 255),
        Column("dob", T.DateType()),
        Column("created_at", NTZ),
        Column("load_timestamp", NTZ),
    ),
    key=("id",),
    bucketed=True,
)

TXF_CUSTOMER_ADDRESS = Table(
    "txf_customer_address",
    (
        text("id", 255),
        text("customer_id", 255, required=True),
        text("address", 255),
        text("city", 50),
        text("province", 25),
        Column("created_at", NTZ),
        Column("load_timestamp", NTZ),
    ),
    key=("customer_id",),
    bucketed=True,
)

TXF_SALES = Table(
    "txf_sales",
    (
        text("vin", 25, required=True),
        text("customer_id", 255),
        text("model", 50),
        Column("invoice_date", T.DateType(), required=True),
        Column("price", MONEY),
        Column("created_at", NTZ),
        Column("load_timestamp", NTZ),
    ),
    key=("vin", "invoice_date"),
    layout=(LOAD_DATE, text("inv_bucket")),
    sorted_by=("invoice_date",),
    probed=("vin",),
)

TXF_AFTER_SALES = Table(
    "txf_after_sales",
    (
        text("service_ticket", 10),
        text("vin", 50),
        text("customer_id", 255),
        text("model", 50),
        Column("service_date", T.DateType()),
        text("service_type", 5),
        Column("created_at", NTZ),
        Column("load_timestamp", NTZ),
    ),
    key=("service_ticket",),
    layout=(LOAD_DATE,),
    probed=("service_ticket",),
)

# The tickets of the days its record lists, apart from the services: a ticket may repeat at any date,
# and here stored tickets meet a batch without moving.
TICKETS = Table(
    "txf_after_sales_tickets",
    (text("service_ticket", 10), Column("loaded_on", T.DateType())),
    key=("service_ticket",),
    probed=("service_ticket",),
    bucketed=True,
)

MART_SALES = Table(
    "mart_sales_datamart",
    (
        text("periode", 7, required=True),
        text("class", 10),
        text("model", 50),
        Column("total", MONEY),
        Column("load_timestamp", NTZ),
    ),
    key=("periode", "class", "model"),
)

MART_CUST_SERVICE_PRIO = Table(
    "mart_cust_service_prio_datamart",
    (
        Column("periode", T.IntegerType()),
        text("vin", 50),
        text("customer_name", 255),
        text("address", 255),
        Column("count_service", T.IntegerType()),
        text("priority", 10),
        Column("load_timestamp", NTZ),
    ),
)

ALL_TABLES = (
    STG_CUSTOMERS,
    STG_SALES,
    STG_AFTER_SALES,
    STG_CUSTOMER_ADDRESS,
    TXF_CUSTOMERS,
    TXF_CUSTOMER_ADDRESS,
    TXF_SALES,
    TXF_AFTER_SALES,
    TICKETS,
    MART_SALES,
    MART_CUST_SERVICE_PRIO,
)
