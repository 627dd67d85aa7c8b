"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.common import stored


def _star(edges: DataFrame, whole: bool) -> DataFrame:
    """Hang neighbours of each node on its smallest one: the larger neighbours, or node and smaller ones.

    Every input edge runs from its larger end a to its smaller end b.
    """
    if whole:
        pairs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    hung = pairs.join(least, "a")
    if whole:
        out = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that has an edge and is not the smallest of its component, and that smallest.

    ``edges`` has two columns of node numbers; self-edges and repeats are allowed. Each round is
    written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    x, y = edges.columns
    now = stored(
        edges.filter(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        now = stored(_star(_star(now, whole=True), whole=False), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now
        before = state
