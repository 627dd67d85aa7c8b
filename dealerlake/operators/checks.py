"""Constraint checks: NOT NULL, text length and key uniqueness.

Parquet tables enforce none of these, so every load runs them before its
result becomes visible.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake.schemas import Table


class LoadRejected(Exception):
    """A load broke a constraint; the target was left as it was."""


def _nulls(table: Table) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNull() for c in table.required}


def _too_long(table: Table) -> dict[str, Column]:
    return {f"{c} longer than {limit}": F.char_length(c) > limit for c, limit in table.limits.items()}


def _counted(rules: dict[str, Column]) -> list[Column]:
    return [F.count_if(broken).alias(rule) for rule, broken in rules.items()]


def null_counts(table: Table) -> list[Column]:
    """One counting aggregate per required column, named ``<column> is null``."""
    return _counted(_nulls(table))


def length_counts(table: Table) -> list[Column]:
    """One counting aggregate per limited text column, named ``<column> longer than <n>``."""
    return _counted(_too_long(table))


def violation_counts(table: Table) -> list[Column]:
    """All row constraints of a table, fit for a single pass over the rows."""
    return null_counts(table) + length_counts(table)


def broken_row(table: Table) -> Column:
    """True where a row breaks any constraint, else false or NULL."""
    return reduce(or_, (_nulls(table) | _too_long(table)).values())


def count_violations(rows: DataFrame, counts: Sequence[Column]) -> DataFrame:
    """Counting aggregates as rows of (rule, violations), zero counts included."""
    wide = rows.agg(*counts)
    return wide.unpivot([], [F.col(f"`{c}`") for c in wide.columns], "rule", "violations")


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def key_violations(existing: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys the batch repeats or ``existing`` already holds; empty when the batch may be appended.

    ``copies`` counts the batch rows bringing the key, ``reason`` says which of the two it is.
    NULL keys are left to the NOT NULL check.

    Both parts start from the same counted keys, so the batch is shuffled once. The stored
    table is the streamed side of the join and the counted keys the side Spark may
    broadcast: a day's batch small enough for that leaves the stored table where it is, a
    larger one gets a merge join.
    """
    for column in key:
        batch = batch.filter(F.col(column).isNotNull())
    counted = batch.groupBy(*key).agg(F.count("*").alias("copies"))
    repeated = counted.filter("copies > 1").withColumn("reason", F.lit("repeated in batch"))
    stored = existing.select(*key).join(counted, list(key)).withColumn("reason", F.lit("already stored"))
    return repeated.unionByName(stored)
