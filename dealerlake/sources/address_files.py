"""The daily customer address file: header row, ``|@~`` between fields, UTF-8."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the file format.
DELIMITER = "|@~"
FIELDS = ("id", "customer_id", "address", "city", "province", "created_at")
FILE_NAME = "customer_address_{day:%Y%m%d}.csv"

MALFORMED = "malformed_line"
LINE_ORDER = "line_order"

_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in (*FIELDS, MALFORMED)])
_FORMAT = {
    "sep": DELIMITER,
    "header": "true",
    "encoding": "UTF-8",
    # Quote marks are ordinary text: with quoting on, a leading one would swallow delimiters.
    "quote": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}


def address_file_path(base_path: str, run_date: date) -> str:
    return f"{base_path.rstrip('/')}/{FILE_NAME.format(day=run_date)}"


def read_address_file(spark: SparkSession, base_path: str, run_date: date) -> DataFrame:
    """One row per line, all text, plus ``malformed_line`` and ``line_order``.

    Fields are taken by position; the header is skipped, not matched. An empty
    field is NULL. A line with too few or too many fields keeps its text in
    ``malformed_line``. A missing file raises when the frame is built.

    The file is split across tasks, so ``line_order`` names the split (file, offset)
    before the row number inside it; it compares in file order.
    """
    return (
        spark.read.schema(_SCHEMA)
        .options(**_FORMAT, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)
        .csv(address_file_path(base_path, run_date))
        .withColumn(
            LINE_ORDER,
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("row"),
            ),
        )
    )


def write_address_file(rows: DataFrame, base_path: str, run_date: date) -> str:
    """Write the daily file in the same format (a folder of part files) and return its path."""
    path = address_file_path(base_path, run_date)
    rows.select(*FIELDS).write.options(**_FORMAT).csv(path)
    return path
