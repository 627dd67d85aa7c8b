"""Counting rows: by a query of its own, or while they pass by."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


def tally(rows: DataFrame, flags: Mapping[str, Column] | None = None) -> dict[str, int]:
    """How many rows there are, and how many carry each flag.

    The result of a query, so a task that Spark runs again counts once. Of Parquet files it reads the flags'
    columns only, and without flags their footers only.
    """
    counts = [F.count(F.lit(1)).alias(ROWS), *[F.count_if(flag).alias(name) for name, flag in (flags or {}).items()]]
    return rows.agg(*counts).first().asDict()


def counting(rows: DataFrame, flags: Mapping[str, Column], *extra: Column) -> tuple[DataFrame, Observation]:
    """The same rows, which report their number, how many carry each flag and ``extra`` aggregates once computed.

    Exact where what follows is written by the same tasks; ahead of a shuffle, tasks run again after an
    executor is lost count twice: use ``tally`` there. Flags are evaluated as columns first: that is
    compiled code, while an observed aggregate interprets its expressions row by row.
    """
    seen = Observation()
    flagged = rows.select("*", *[flag.alias(name) for name, flag in flags.items()])
    counts = [F.count(F.lit(1)).alias(ROWS), *[F.count_if(F.col(f"`{name}`")).alias(name) for name in flags]]
    return flagged.observe(seen, *counts, *extra).select(*rows.columns), seen
