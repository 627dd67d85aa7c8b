"""Raw staging tables: laying out appended rows, and picking out the rows of one day or of none."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.schemas import BATCH, CREATED_DATE, Table

REASON = "reason"


def laid_out(rows: DataFrame, table: Table, batch: str | None) -> DataFrame:
    """Raw rows with the batch they came in and, where the table is laid out so, the day of their ``created_at``.

    A daily load so prunes to one folder instead of parsing every row ever staged. Text that names no
    day gets none.
    """
    raw = rows.select(*table.names, F.lit(batch).cast("string").alias(BATCH.name))
    if CREATED_DATE in table.layout:
        raw = raw.withColumn(CREATED_DATE.name, F.col("created_at").try_cast("date"))
    return raw


def created_on(staged: DataFrame, run_date: date) -> DataFrame:
    """Rows whose ``created_at`` falls on ``run_date``.

    Where the table is laid out by ``created_date`` only that day's folder is read. Rows without a
    day belong to none, so they hold up no load; ``rejects`` lists them. Elsewhere the text itself is
    read, and text that names no day fails the load.
    """
    day = F.lit(run_date)
    if CREATED_DATE.name in staged.columns:
        return staged.filter(F.col(CREATED_DATE.name) == day)
    return staged.filter(F.to_date("created_at") == day)


def rejects(staged: DataFrame) -> DataFrame:
    """Rows of a table laid out by ``created_date`` that no daily load can take, with the reason."""
    reason = F.when(F.col("created_at").isNull(), "no creation time").otherwise("unreadable creation time")
    return staged.filter(F.col(CREATED_DATE.name).isNull()).withColumn(REASON, reason)
