"""Tables kept in a relational database, through Spark's own JDBC source.

The driver jar comes with the cluster (``spark.jars`` or ``spark.jars.packages``).
An unreachable database raises ``ConnectionError`` as soon as the frame is built,
because Spark asks it for the table's schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip; the usual driver default fetches or sends far fewer.
BATCH_ROWS = "10000"


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    small: bool = False,
    **options: str,
) -> DataFrame:
    """Read ``table`` by ``split_column``, its ``bounds`` and a number of ``partitions``, or ``small`` ones whole.

    Bounds only place the range borders, rows outside them are still read. A ``small``
    table comes through one connection and one task. MySQL heeds the fetch size only with
    ``useCursorFetch=true`` in the URL; without it a task buffers its whole range.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=BATCH_ROWS)
    if split_column is None and not small:
        raise ValueError(f"{table}: give split_column, bounds and partitions, or say that it is small")
    if split_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("split_column needs bounds and partitions")
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    try:
        return reader.options(**options).load()
    except Exception as error:
        raise ConnectionError(f"cannot read {table} from {url}") from error


def write_jdbc_table(
    rows: DataFrame,
    url: str,
    table: str,
    *,
    connections: int,
    mode: str = "append",
    **options: str,
) -> None:
    """Write to ``table``. ``overwrite`` empties it and keeps its definition.

    ``connections`` bounds how many tasks write at once. The rows are shuffled to that many
    tasks, so that what computes them keeps its own parallelism. MySQL sends batches as
    such only with ``rewriteBatchedStatements=true`` in the URL.
    """
    (
        rows.repartition(connections)
        .write.format("jdbc")
        .mode(mode)
        .options(url=url, dbtable=table, batchsize=BATCH_ROWS, truncate="true", numPartitions=str(connections))
        .options(**options)
        .save()
    )
