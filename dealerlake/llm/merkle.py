"""Merkle manifest of a dataset: a tree of digests per key, and one over their roots.

Of each tree only the leaves and every few levels above them are stored. A proof needs the levels in
between too: for each aligned subtree, the nodes of the next stored level below it, the missing nodes
are made again from these in one task, the siblings on the way up are emitted and the nodes forgotten.
Storage and the size of what one task holds are bounded by the step between stored levels, not by the
rows: a tree of 10**12 leaves is five subtrees high at a step of eight.

A node is the SHA-256 of its children's digests as hex text; the last node of a level may be alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dealerlake.llm.common import record_batch, remainder, stored

STEP = 8  # levels from one stored level to the next: a subtree has 256 nodes at its foot
SUBTREES = 16  # so many subtrees' proofs are handed back to Spark at once


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """SHA-256, as bytes, of the values one after the other: ``-`` for NULL, else UTF-8 size, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def subtree(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` levels above them."""
    out = [list(nodes)]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def siblings(levels: Sequence[Sequence[str]], place: int) -> tuple[str, str]:
    """Siblings of one node of the lowest level on its way up, and the side of each: L, R, or - where there is none."""
    found, sides = [], []
    for nodes in levels[:-1]:
        other = place ^ 1
        if other < len(nodes):
            found.append(nodes[other])
        sides.append("-" if other >= len(nodes) else "L" if other < place else "R")
        place >>= 1
    return "".join(found), "".join(sides)


def folded(leaf: str, found: str, sides: str) -> str:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for side in sides:
        other = "" if side == "-" else found[at : at + 64]
        at += len(other)
        leaf = digest(other + leaf if side == "L" else leaf + other)
    return leaf


@dataclass(frozen=True)
class Forest:
    """Trees numbered in ``heights`` (tree, height); ``levels[k]`` holds (tree, n, node) of height ``k * step``.

    ``levels[0]`` may carry further columns. A tree's last stored node, its root, stands in the first
    level at or above its height and in ``roots`` (tree, node).
    """

    levels: list[DataFrame]
    heights: DataFrame
    roots: DataFrame
    step: int


@dataclass(frozen=True)
class Manifest:
    """``forest`` of the keys' trees, ``top`` of the one tree over their roots, ``root`` as hex text or None."""

    forest: Forest
    top: Forest
    root: str | None


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``, stored in ``order``, plus _at: a row's place among all, from 0. Equal rows follow their stored order.

    A range shuffle sorts them; only the rows of each partition are counted on the driver, one number
    a partition. The tie breaker cuts a value that fills much of the table into several partitions.
    """
    spark = rows.sparkSession
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    kept = stored(dealt.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part, within = F.shiftrightunsigned("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    counts = kept.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row a partition
    before = np.cumsum([0, *[c["count"] for c in counts]])
    offsets = spark.createDataFrame([(c["_part"], int(b)) for c, b in zip(counts, before, strict=False)], "_part long, _before long")
    return kept.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_at", F.col("_before") + within).drop("_part", "_before", "_row")


def _with_texts(frame: DataFrame, *names: str) -> StructType:
    return StructType([*frame.schema.fields, *[StructField(n, StringType()) for n in names]])


def _subtrees(nodes: DataFrame, heights: DataFrame, base: int, step: int, carried: Sequence[str] = ()) -> DataFrame:
    """(tree, block, climb, nodes): nodes of height ``base`` by aligned subtree, of trees that go on above it."""
    item = F.struct("n", "node", *carried)
    block = F.shiftright("n", step).alias("block")
    grouped = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(item)).alias("nodes"))  # 2**step at most
    climb = F.least(F.col("height") - base, F.lit(step)).alias("climb")
    return grouped.join(heights.filter(F.col("height") > base), "tree").select("tree", "block", climb, "nodes")


NODES = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The one node above each subtree."""
    for batch in batches:
        made = []
        for nodes, climb in zip(batch.column("nodes").to_pylist(), batch.column("climb").to_pylist(), strict=True):
            made.append(bytes.fromhex(subtree([n["node"].hex() for n in nodes], climb)[-1][0]))
        yield record_batch(NODES, [batch.column("tree"), batch.column("block"), made])


def grow(leaves: DataFrame, sizes: DataFrame, step: int = STEP) -> Forest:
    """The trees over ``leaves`` (tree, n from 0, node and more), of ``sizes`` (tree, leaves)."""
    height = F.when(F.col("leaves") > 1, F.length(F.bin(F.col("leaves") - 1))).otherwise(0)
    heights = sizes.select("tree", height.alias("height"))
    tallest = heights.agg(F.max("height")).first()[0] or 0
    levels, base = [leaves], 0
    while base < tallest:
        above = _subtrees(levels[-1], heights, base, step).mapInArrow(_tops, "tree long, n long, node binary")
        levels.append(stored(above, "nodes"))
        base += step
    roots = None
    for k, nodes in enumerate(levels):
        ended = heights.filter((F.col("height") <= k * step) & (F.col("height") > (k - 1) * step))
        part = nodes.select("tree", "node").join(ended, "tree", "left_semi")
        roots = part if roots is None else roots.union(part)
    return Forest(levels, heights, stored(roots, "roots"), step)


def build(rows: DataFrame, key: str, order: str, leaf: str, step: int = STEP) -> Manifest:
    """The manifest of ``rows``: one tree for each value of ``key``, its leaves by ``order``, then by digest.

    Keys ascend bytewise, NULL first and apart from the empty text; a NULL ``order`` comes first. Rows
    that repeat are leaves of their own. Further columns are carried with the leaves. No rows give no
    trees and no root.
    """
    ordered = placed(stored(rows, "leaves"), [key, order, leaf])
    keys = stored(ordered.groupBy(key).agg(F.min("_at").alias("_first"), F.count("*").alias("leaves")), "keys")
    keys = stored(placed(keys, ["_first"]).withColumnRenamed("_at", "tree").withColumnRenamed(key, "_key"), "trees")
    owned = ordered.join(keys.select("_key", "_first", "tree"), F.col(key).eqNullSafe(F.col("_key")))
    carried = [c for c in rows.columns if c != leaf]
    leaves = stored(owned.select("tree", (F.col("_at") - F.col("_first")).alias("n"), F.col(leaf).alias("node"), *carried), "leaves")
    forest = grow(leaves, keys, step)
    top = grow(forest.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("n"), "node"), keys.agg(F.count("*").alias("leaves")).select(F.lit(0).cast("long").alias("tree"), "leaves"), step)
    root = top.roots.first()
    return Manifest(forest, top, root.node.hex() if root else None)


def _ways(forest: Forest, above: DataFrame, wanted: Column | None = None) -> DataFrame:
    """(tree, n, siblings, sides) and what else the leaves hold, of each leaf: its way up, and ``above`` its root.

    Goes down from the highest stored level. Only subtrees over a wanted leaf are made again.
    """
    step, heights = forest.step, forest.heights
    needed = [forest.levels[0].filter(wanted) if wanted is not None else None]
    for _ in forest.levels[1:]:
        low = needed[-1]
        needed.append(low and low.select("tree", F.shiftright("n", step).alias("n")).distinct())
    ways = None
    for k in reversed(range(len(forest.levels))):
        # Trees that end between this level and the next higher stored one start from their root.
        ending = heights.filter((F.col("height") <= (k + 1) * step) & (F.col("height") > k * step))
        starts = ending.join(above, "tree").select("tree", F.lit(0).cast("long").alias("n"), "siblings", "sides")
        ways = starts if ways is None else ways.unionByName(starts)
        nodes = forest.levels[k]
        carried = [c for c in nodes.columns if c not in ("tree", "n", "node")]
        cells = _subtrees(nodes, heights, k * step, step, carried)
        if needed[k] is not None:
            blocks = needed[k].select("tree", F.shiftright("n", step).alias("block")).distinct()
            cells = cells.join(blocks, ["tree", "block"], "left_semi")
        cells = cells.join(ways.withColumnRenamed("n", "block"), ["tree", "block"])
        kinds = _with_texts(nodes.select("tree", "n", "node", *carried), "siblings", "sides")
        ways = cells.mapInArrow(_descend(carried), kinds)
        if k:
            ways = stored(ways.select("tree", "n", "siblings", "sides"), "ways")
    single = forest.levels[0].join(heights.filter("height = 0"), "tree", "left_semi").join(above, "tree")
    ways = ways.unionByName(single.select(ways.columns))
    return ways.filter(wanted) if wanted is not None else ways


def _descend(carried: Sequence[str]):
    """Function for mapInArrow: the way up of every node at a subtree's foot, its levels made again and dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SUBTREES):
                part = batch.slice(first, SUBTREES)
                trees, found, ways = [], [], []
                flat = part.column("nodes").flatten()
                hexes = [n.hex() for n in flat.field("node").to_pylist()]
                at = 0
                for size, climb, tree, over, sides in zip(
                    part.column("nodes").value_lengths().to_pylist(), *(part.column(c).to_pylist() for c in ("climb", "tree", "siblings", "sides")), strict=True
                ):
                    levels = subtree(hexes[at : at + size], climb)
                    for place in range(size):
                        near, side = siblings(levels, place)
                        found.append(near + over)
                        ways.append(side + sides)
                    trees += [tree] * size
                    at += size
                held = [flat.field(c) for c in ("n", "node", *carried)]
                names = ["tree", "n", "node", *carried, "siblings", "sides"]
                yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int64()), *held, pa.array(found, pa.string()), pa.array(ways, pa.string())], names)

    return run


def proofs(manifest: Manifest, wanted: Column | None = None) -> DataFrame:
    """Proof of every leaf, or of the ``wanted`` ones: tree, n, node, what the leaves carry, siblings, sides, subroot.

    ``siblings`` are the digests beside the way from the leaf over its tree's root to the root, hex
    texts one after the other; ``sides`` says for each level whether the sibling stands left or right
    (L, R) or there is none (-).
    """
    nothing = manifest.top.heights.select("tree", F.lit("").alias("siblings"), F.lit("").alias("sides"))
    trees = _ways(manifest.top, nothing).select(F.col("n").alias("tree"), "siblings", "sides")
    out = _ways(manifest.forest, stored(trees, "ways"), wanted)
    return out.join(manifest.forest.roots.withColumnRenamed("node", "subroot"), "tree")


def with_folded(found: DataFrame, leaf: str) -> DataFrame:
    """``found`` plus folded_root: what ``leaf`` (bytes), ``siblings`` and ``sides`` lead to, as hex text.

    Spark's own functions, so that no task needs a second Python worker beside the one that made the proofs.
    """
    start = F.struct(F.lower(F.hex(leaf)).alias("node"), F.lit(0).alias("used"))

    def step(done: Column, level: Column) -> Column:
        side = F.substring(F.col("sides"), level, F.lit(1))
        near = F.when(side == "-", "").otherwise(F.substring(F.col("siblings"), done["used"] * 64 + 1, F.lit(64)))
        pair = F.when(side == "L", F.concat(near, done["node"])).otherwise(F.concat(done["node"], near))
        return F.struct(F.sha2(pair, 256).alias("node"), (done["used"] + F.when(side == "-", 0).otherwise(1)).alias("used"))

    count = F.length("sides")
    levels = F.slice(F.sequence(F.lit(0), count), F.lit(2), count)  # from 1; none of a lone leaf
    return found.withColumn("folded_root", F.aggregate(levels, start, step)["node"])


def report(docs: DataFrame, step: int = STEP) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    A leaf covers doc_id, source, lang, n_chars and text; there is one tree for each lang. For each row
    with a doc_id whose crc32 is a multiple of 7 the proof is checked against a leaf with n_chars
    changed, for the others against the leaf itself. NULLs are values of their own; rows that repeat
    are leaves of their own; further columns are not read.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [(f.cast("decimal(20,0)") + 1) if k == 3 else f for k, f in enumerate(fields)]
    own = leaf_digest(*fields)
    claimed = F.when(remainder("doc_id", 7) == 0, leaf_digest(*changed)).otherwise(own)
    manifest = build(docs.select("doc_id", "lang", own.alias("leaf"), claimed.alias("claimed")), "lang", "doc_id", "leaf", step)
    found = proofs(manifest).select("doc_id", "node", "claimed", "subroot", "siblings", "sides")
    root = F.lit(manifest.root)
    return with_folded(found, "claimed").select(
        "doc_id", F.lower(F.hex("node")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), root.alias("root"),
        F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"),
    )


def _nibble_table() -> list[int]:
    """CRC-32 of the sixteen half bytes, for SQL without that function."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


ORACLE_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT,
      flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [(ascii(c) & 15)::BIGINT, (ascii(c) >> 4)::BIGINT]))),
    lambda crc, half: xor(crc >> 4, ({_nibble_table()}::BIGINT[])[(xor(crc, half) & 15) + 1])) AS crc
  FROM documents
), spelled AS (
  SELECT doc_id, lang, xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL AS changed, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS size,
    coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS other, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM keyed
), hashed AS (
  SELECT doc_id, lang, sha256(head || size || tail) AS leaf,
    CASE WHEN changed THEN sha256(head || other || tail) ELSE sha256(head || size || tail) END AS claimed
  FROM spelled
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n, count(*) OVER (PARTITION BY lang) AS m
  FROM hashed
), nodes(tree, lvl, n, m, h) AS (
  SELECT tree, 0::BIGINT, n, m, leaf FROM leaves
  UNION ALL
  SELECT tree, any_value(lvl) + 1, n // 2, any_value((m + 1) // 2), sha256(string_agg(h, '' ORDER BY n))
  FROM nodes WHERE m > 1 GROUP BY tree, n // 2
), tops(lvl, n, m, h) AS (
  SELECT 0::BIGINT, tree, count(*) OVER (), h FROM nodes WHERE m = 1
  UNION ALL
  SELECT any_value(lvl) + 1, n // 2, any_value((m + 1) // 2), sha256(string_agg(h, '' ORDER BY n)) FROM tops WHERE m > 1 GROUP BY n // 2
), ways AS (
  SELECT a.tree, a.n, own.lvl, CASE WHEN near.h IS NULL THEN '-' WHEN near.n < own.n THEN 'L' || near.h ELSE 'R' || near.h END AS near
  FROM leaves a JOIN nodes own ON own.tree = a.tree AND own.n = a.n >> own.lvl AND own.m > 1
  LEFT JOIN nodes near ON near.tree = own.tree AND near.lvl = own.lvl AND near.n = xor(own.n, 1)
  UNION ALL
  SELECT a.tree, a.n, own.lvl + 1000, CASE WHEN near.h IS NULL THEN '-' WHEN near.n < own.n THEN 'L' || near.h ELSE 'R' || near.h END
  FROM leaves a JOIN tops own ON own.n = a.tree >> own.lvl AND own.m > 1
  LEFT JOIN tops near ON near.lvl = own.lvl AND near.n = xor(own.n, 1)
), proofs AS (
  SELECT tree, n, string_agg(substr(near, 2), '' ORDER BY lvl) AS near, list(near ORDER BY lvl) AS steps FROM ways GROUP BY tree, n
), climbed AS (
  SELECT a.doc_id, a.leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.near, '')) AS proof_sha256,
    list_reduce(list_prepend(a.claimed, coalesce(p.steps, [])), lambda h, x: sha256(
      CASE x[1] WHEN 'L' THEN substr(x, 2) || h WHEN 'R' THEN h || substr(x, 2) ELSE h END)) AS folded_root
  FROM leaves a LEFT JOIN proofs p USING (tree, n)
  JOIN (SELECT tree, h FROM nodes WHERE m = 1) s USING (tree), (SELECT h FROM tops WHERE m = 1) r
)
SELECT *, folded_root = root AS verified FROM climbed
"""
