"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

A code's bits are the signs of a vector under rotations learned to lose little by taking signs
(iterative quantisation, several starts for more bits than dimensions). Codes are cut into substrings
and each substring is indexed. Two codes within r bits of each other have a substring, of m, within
r // m bits, so probing those finds every code within r. What is found is ranked by the cosine of the
original vectors. Queries for which the radius finds fewer than k are searched again with the full radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm.common import record_batch, stored

POPULATION = np.array([bin(v).count("1") for v in range(1 << 16)], np.uint8)


@dataclass(frozen=True)
class Search:
    """Code size, bounds of the sample that rotation and radius are learned on, and block sizes in rows."""

    k: int = 5
    substrings: int = 16  # of 16 bits each
    sample: int = 4096
    probes: int = 256  # sample rows whose neighbours set the radius
    share: float = 0.98  # of those neighbours within the radius
    rounds: int = 20
    block: int = 4096  # candidates multiplied with
    query_block: int = 2048  # so many queries
    seed: int = 5


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that large or tiny components neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Codes:
    """Learned projections and the search radius in bits."""

    mean: np.ndarray
    project: np.ndarray  # [dimension, bit]
    radius: int

    def of(self, units: np.ndarray) -> np.ndarray:
        """Codes as 16-bit substrings, [row, substring]."""
        return np.packbits((units - self.mean) @ self.project > 0, axis=1).view(np.uint16)


def learn(vectors: np.ndarray, search: Search) -> Codes:
    """Rotations by iterative quantisation; the radius that holds ``share`` of the sample's own neighbours."""
    units = unit(vectors)
    mean = units.mean(axis=0)
    centred, bits = units - mean, search.substrings * 16
    draw, parts, dim = np.random.default_rng(search.seed), [], units.shape[1]
    for _ in range(-(-bits // dim)):
        turn = np.linalg.qr(draw.normal(size=(dim, dim)))[0]
        for _ in range(search.rounds):
            left, _, right = np.linalg.svd(centred.T @ np.sign(centred @ turn))
            turn = left @ right
        parts.append(turn)
    codes = Codes(mean, np.concatenate(parts, axis=1)[:, :bits], bits)
    probes = min(search.probes, len(units))
    near = units[:probes] @ units.T
    near[np.arange(probes), np.arange(probes)] = -2
    found = np.argsort(-near, axis=1)[:, : search.k]
    words = codes.of(units)
    apart = POPULATION[words[:probes, None, :] ^ words[found]].sum(axis=2, dtype=np.int64)
    return Codes(codes.mean, codes.project, int(np.quantile(apart, search.share)) if len(units) > 1 else bits)


class MultiIndex:
    """One table per substring: its occurring values, and the number of each row's value among them."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.whole = np.ascontiguousarray(words).view(np.uint64)
        self.tables = [np.unique(column, return_inverse=True) for column in words.T]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        return self.pairs(code[None], radius)[1]

    def pairs(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(code, row) of every row whose code differs from one of ``codes`` in at most ``radius`` bits.

        Of each substring the values within the pigeonhole's share are probed for all codes at once.
        """
        each = radius // self.words.shape[1]
        seen = np.zeros((len(codes), len(self.words)), bool)
        for part, (values, number) in zip(codes.T, self.tables, strict=True):
            near = POPULATION[values ^ part[:, None]] <= each
            seen |= near[:, number]
        code, row = np.nonzero(seen)
        apart = np.bitwise_count(self.whole[row] ^ np.ascontiguousarray(codes).view(np.uint64)[code]).sum(axis=1, dtype=np.int64)
        close = apart <= radius
        return code[close], row[close]


PROBED = 64  # queries probed at once


def nearest(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, codes: Codes, radius: int, k: int):
    """(query, candidate, cosine) of up to k best candidates within the radius of each query, its own id apart."""
    units, asked = unit(vectors), unit(queries)
    own, every = codes.of(asked), codes.of(units)
    everywhere = radius >= 16 * every.shape[1]  # all codes lie within: nothing to probe
    index = None if everywhere else MultiIndex(every)
    out = []
    for first in range(0, len(asked), PROBED):
        part = slice(first, first + PROBED)
        if everywhere:
            rough = asked[part] @ units.T
            rough[query_ids[part, None] == ids] = -2
            least = np.partition(rough, -min(k, len(ids)), axis=1)[:, -min(k, len(ids)), None]
            query, row = np.nonzero((rough >= least - 1e-9) & (rough > -2))  # the exact measure decides
        else:
            query, row = index.pairs(own[part], radius)
        query += first
        other = query_ids[query] != ids[row]
        query, row = query[other], row[other]
        cosine = (units[row] * asked[query]).sum(axis=1)
        order = np.lexsort((ids[row], -cosine, query))
        query, row, cosine = query[order], row[order], cosine[order]
        starts = np.searchsorted(query, query)  # first place of each one's query
        best = np.arange(len(query)) - starts < k
        out += zip(query_ids[query[best]].tolist(), ids[row[best]].tolist(), cosine[best].tolist(), strict=True)
    return out


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _pass(vectors: DataFrame, queries: DataFrame, codes: Codes, radius: int, search: Search, rows: int, asked: int) -> DataFrame:
    """Best candidates of each query within the radius, from all blocks."""
    blocks, query_blocks = max(1, -(-rows // search.block)), max(1, -(-asked // search.query_block))
    dimension = len(codes.mean)

    def numbered(frame: DataFrame, own: str, count: int, other: str, others: int, role: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return frame.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int").alias(own), every.alias(other), F.lit(role).alias("role"))

    columns = ("block", "query_block", "role", "vec_id", "embedding")
    sides = numbered(vectors, "block", blocks, "query_block", query_blocks, 0).select(*columns)
    sides = sides.union(numbered(queries, "query_block", query_blocks, "block", blocks, 1).select(*columns))

    def search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def done() -> Iterator[pa.RecordBatch]:
            both = pa.Table.from_batches(held).combine_chunks()
            role = both.column("role").to_numpy()
            sides = []
            for k in (1, 0):
                part = both.filter(pa.array(role == k)).combine_chunks()
                sides += [_matrix(part.column("embedding").combine_chunks(), dimension), part.column("vec_id").to_numpy()]
            if len(sides[1]) and len(sides[3]):
                found = nearest(*sides, codes, radius, search.k)
                if found:
                    yield record_batch(FOUND, list(zip(*found, strict=True)))

        for batch in batches:
            keys = batch.column("block").to_numpy().astype(np.int64) * query_blocks + batch.column("query_block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), batch.num_rows]
            for first, end in zip(cuts[:-1], cuts[1:], strict=True):
                if end > first:
                    if now is not None and keys[first] != now:
                        yield from done()
                        held = []
                    now = keys[first]
                    held.append(batch.slice(first, end - first))
        if held:
            yield from done()

    dealt = sides.repartition("block", "query_block").sortWithinPartitions("block", "query_block")
    found = dealt.mapInArrow(search_blocks, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= search.k)


def usable(vectors: DataFrame) -> DataFrame:
    """One row per vec_id with a finite vector that is not zero, of the length most rows have.

    Of rows with one vec_id the smallest vector counts; of equally frequent lengths the longer one.
    """
    value = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = vectors.select("vec_id", value.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    length = clean.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    clean = clean.filter(F.size("embedding") == (length.n if length else 0))
    return clean.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def search_neighbours(vectors: DataFrame, is_query: Column, search: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id, score: up to k nearest of each query row among all other rows.

    Nearest first by cosine in double precision, ties to the smaller vec_id. Rotations and radius are
    learned on at most ``sample`` rows picked by a hash; every row is indexed.
    """
    clean = stored(usable(vectors), "vectors")
    queries = clean.filter(is_query)
    rows, asked = clean.count(), queries.count()
    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(search.sample).collect()
    if not sample or not asked:
        return clean.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = learn(np.array([r.embedding for r in sample]), search)
    found = stored(_pass(clean, queries, codes, codes.radius, search, rows, asked), "found")
    short = found.groupBy("query_id").count().filter(F.col("count") >= min(search.k, rows - 1))
    again = stored(queries.join(short, queries["vec_id"] == short["query_id"], "left_anti"), "again")
    left = again.count()
    if left:
        every = _pass(clean, again, codes, search.substrings * 16, search, rows, left)
        found = found.join(again.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*found.columns).union(every.select(*found.columns))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.least(F.greatest("score", F.lit(-1.0)), F.lit(1.0)).alias("score"))
