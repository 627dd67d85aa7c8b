"""Changing a table's rows: delete by load date, first/last dedupe, upsert.

Each operator is a function from frames to a frame; nothing is written here.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.schemas import LOAD_DATE


def drop_loaded_on(target: DataFrame, run_date: date) -> DataFrame:
    """Without the rows loaded on ``run_date``. Rows that have no load time stay."""
    if LOAD_DATE.name in target.columns:
        loaded = F.col(LOAD_DATE.name)
    else:
        loaded = F.to_date("load_timestamp")
    return target.filter(~loaded.eqNullSafe(F.lit(run_date)))


def dedupe_first_last(rows: DataFrame, key: str, order: str, first: Sequence[str] = ()) -> DataFrame:
    """One row per key: ``first`` columns from its earliest row, all others from its latest.

    The ``order`` column ranks the rows of a key and is left out of the result. This is
    an aggregate, not a window: map tasks already reduce a key to one row, so a key
    holding most of the input costs no more than any other.
    """
    columns = [c for c in rows.columns if c != order]
    last = [c for c in columns if c != key and c not in first]
    picked = rows.groupBy(key).agg(
        *[F.min_by(c, order).alias(c) for c in first],
        F.max_by(F.struct(*last), order).alias("latest"),
    )
    return picked.select(*[f"latest.{c}" if c in last else c for c in columns])


def upsert(target: DataFrame, source: DataFrame, key: str, insert_only: Sequence[str] = ()) -> DataFrame:
    """Target rows overwritten by the source row of the same key, plus the new keys.

    A NULL in the source overwrites too. ``insert_only`` columns of an existing row
    keep their value. Both sides hold a key at most once.
    """
    columns = target.columns
    # The key stays a plain column beside each row, so a bucketed target keeps its
    # partitioning and a deduplicated source the one its aggregate already has.
    old = target.select(F.col(key).alias("old_key"), F.struct(*columns).alias("old"))
    new = source.select(F.col(key).alias("new_key"), F.struct(*columns).alias("new"))
    merged = old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")

    def value(column: str) -> str:
        winner, other = ("old", "new") if column in insert_only else ("new", "old")
        return f"CASE WHEN {winner} IS NOT NULL THEN {winner}.{column} ELSE {other}.{column} END AS {column}"

    return merged.selectExpr(*[value(c) for c in columns])
