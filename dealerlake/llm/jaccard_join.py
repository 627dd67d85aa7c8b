"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

The overlap of two documents is the sum over n-grams of the product of their entries. It is not
formed for all pairs. Columns are dealt by hash into parts, more of them than half the number of n-grams
in which two linked documents of a size group can differ: in some part they then differ in one n-gram at
most. A part has four blocks and a key for each three of them, so linked documents have keys in common.
Pairs without one are below the size-derived bound and never formed. Documents of a size group
joined by common keys form clusters; the rows of a cluster are dealt into
tiles, and for each pair of tiles the product accumulates the overlap counts of their rows. Pairs
whose overlap is below the bound from their sizes are discarded, and of the rest only enough edges
to connect them leave the task.

Equal sets are one class first and take part once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm.common import byte_slices, record_batch, releasing, stored
from dealerlake.llm.components import components
from dealerlake.llm.shingles import U, mixed, shingle_sets

WAYS = 4  # blocks of a part of the columns
GROUPS = 120  # size groups; the last holds sets of 10**13 n-grams
KEY_PARTITIONS = 4  # times the session's shuffle partitions, for the keys: a document has some 600
KEY_BYTES = 5  # of a key that are sent; the partition it is sent to tells more of it
PACKED = 1 << 20  # keys of a task packed at once
ROUND = 2  # texts sent to tiles at once, as a multiple of the documents
SENT = 100_000  # texts that make no second round, however few documents there are
FILTER_BITS = 1 << 24  # of the bitmap that spares texts of unclustered documents a shuffle; 2 MB


@dataclass(frozen=True)
class Similarity:
    """Documents link when 100 * intersection >= percent * union of their sets of ``words``-word shingles."""

    words: int = 5
    percent: int = 80
    tile: int = 1024  # documents of a cluster multiplied at once; a text is sent once for each tile of its cluster
    entries: int = 500_000  # n-grams of such documents: of longer ones fewer make a tile

    def linked(self, overlap, a, b):
        return (100 + self.percent) * overlap >= self.percent * (a + b)

    def size_groups(self, most: int) -> list[int]:
        """First sizes of the groups, rising by about 1.3 up to beyond ``most``."""
        firsts = [1]
        while firsts[-1] <= most:
            firsts.append(max(firsts[-1] + 1, firsts[-1] * 13 // 10))
        return firsts

    def differ(self, end: int) -> int:
        """The most n-grams in which linked sets of fewer than ``end`` can differ."""
        return 2 * (end - 1) * (100 - self.percent) // (100 + self.percent)

    @staticmethod
    def crowded(differ: int) -> int:
        """How many of its keys, the ones most shared, a set can do without."""
        return -(-differ // 24)

    def parts(self, first: int, end: int) -> tuple[int, int]:
        """Column parts for sets of a size group, and how many of their keys may be empty.

        Linked sets differ in at most d n-grams, so of d // 2 + 1 + e parts at least 1 + e hold one
        difference or none, and each of those gives a key in common. At most ``spare`` of these are empty
        unless both sets have more empty keys. It is set so that few sets of the group's smallest size
        have more; sets that do give their empty keys too.
        """
        differ = self.differ(end)
        if differ == 0:
            return 0, 0
        fewest = differ // 2 + 1 + 2 * self.crowded(differ)
        least = first * self.percent / 100
        for spare in range(differ + 3):
            count = fewest + spare
            empty = WAYS * count * (1 - (WAYS - 1) / (WAYS * count)) ** least
            if empty + 2.5 * math.sqrt(empty) <= spare:
                return count, spare
        return fewest, 0  # sets so small that spare parts do not help


class BlockKeys:
    """Keys of a set's columns; sets with a key in common are candidates.

    Each part of the columns is cut into ``WAYS`` blocks and gives a key for the content of all its
    blocks but one, for each of them.
    """

    def __init__(self, similarity: Similarity):
        self.similarity = similarity
        self.firsts = [1, 2]
        self.known: dict[int, tuple[int, int]] = {}

    def groups_of(self, n: int) -> list[int]:
        """Size groups a set of ``n`` takes part in: its own, and those above that hold sets it can link with."""
        sim = self.similarity
        if n >= self.firsts[-2]:
            self.firsts = sim.size_groups(2 * n)
        group = int(np.searchsorted(self.firsts, n, side="right")) - 1
        groups = [group]
        # A linked set may be larger by 100 / percent and so lie in the next groups.
        while n * 100 // sim.percent >= self.firsts[groups[-1] + 1]:
            groups.append(groups[-1] + 1)
            if groups[-1] + 2 >= len(self.firsts):
                self.firsts = sim.size_groups(2 * self.firsts[-1])
        return groups

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys, and the size group of each."""
        sim, groups = self.similarity, self.groups_of(len(shingles))
        dealt, held = mixed(shingles, 1), mixed(shingles, 2)
        keys, at = [], []
        for g in groups:
            if g not in self.known:
                self.known[g] = sim.parts(self.firsts[g], self.firsts[g + 1])
            count, spare = self.known[g]
            if count == 0:  # only equal sets link, and those are one class already
                continue
            block = (dealt % U(WAYS * count)).astype(np.int64)
            content = np.zeros(WAYS * count, U)
            np.add.at(content, block, held)
            sizes = np.bincount(block, minlength=WAYS * count).reshape(count, WAYS)
            content = content.reshape(count, WAYS)
            rest = (content.sum(axis=1, dtype=U, keepdims=True) - content).ravel()
            filled = (sizes.sum(axis=1, keepdims=True) - sizes).ravel() > 0
            key = mixed(rest + mixed(np.arange(WAYS * count, dtype=U) + (U(g) << U(40)), 3))
            keys.append(key if len(key) - filled.sum() > spare else key[filled])
            at.append(np.full(len(keys[-1]), g, np.int32))
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(keys).view(np.int64), np.concatenate(at)


SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])


def _signatures(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """Per row: size of its set, and 128 bits that stand for the set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_slices(batch.column("text")):
                sets = shingle_sets(texts, similarity.words)
                sizes = np.array([len(s) for s in sets], np.int64)
                sums = [np.array([mixed(s, salt).sum(dtype=U) for s in sets], U).view(np.int64) for salt in (4, 5)]
                yield record_batch(SETS, [batch.column("doc_id").slice(first, len(texts)), sizes, *sums])

    return docs.select("doc_id", "text").mapInArrow(releasing(sign), "doc_id long, n long, s1 long, s2 long")


def packed_keys(key: np.ndarray, rep: np.ndarray, size_group: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """(part, number, packed) of the keys of each part: ``KEY_BYTES`` a key, then documents and size groups compressed.

    Documents are sent as steps from the one before, whose bytes are laid out by place, so that small steps shrink.
    """
    part = (key >> U(8 * KEY_BYTES)) % U(parts)
    order = np.argsort(part.astype(np.uint16 if parts < 1 << 16 else np.uint32), kind="stable")
    part, key, rep, size_group = part[order], key[order], rep[order], size_group[order].astype(np.uint8)
    firsts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    steps = np.diff(rep, prepend=0)
    steps[firsts] = rep[firsts]
    short = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    steps = steps.astype("<i8").view(np.uint8).reshape(-1, 8)
    for a, b in zip(firsts, [*firsts[1:], len(part)], strict=True):
        rest = steps[a:b].T.tobytes() + size_group[a:b].tobytes()
        yield int(part[a]), int(b - a), short[a:b].tobytes() + pa.compress(rest, "zstd", asbytes=True)


def _short_keys(part: int, number: int, packed: bytes) -> np.ndarray:
    """Keys as sent, with their part above them."""
    key = np.zeros((number, 8), np.uint8)
    key[:, :KEY_BYTES] = np.frombuffer(packed, np.uint8, KEY_BYTES * number).reshape(number, KEY_BYTES)
    return key.view("<u8").ravel().astype(U) + (U(part) << U(8 * KEY_BYTES))


def _holders(number: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document and size group of each of these keys."""
    rest = np.frombuffer(pa.decompress(packed[KEY_BYTES * number :], 9 * number, "zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(rest[: 8 * number].reshape(8, number).T).view("<i8").ravel()
    return np.cumsum(steps, dtype=np.int64), rest[8 * number :].astype(np.int32)


def repeated_keys(blocks: list[tuple[int, int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, rep, size_group) of the packed keys that occur more than once among ``blocks``, which hold their parts whole."""
    ordered = np.concatenate([_short_keys(*block) for block in blocks])
    ordered.sort()
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(repeated):
        return
    for part, number, packed in blocks:
        key = _short_keys(part, number, packed)
        hit = np.flatnonzero(repeated[np.minimum(np.searchsorted(repeated, key), len(repeated) - 1)] == key)
        if len(hit):
            rep, size_group = _holders(number, packed)
            yield key[hit].view(np.int64), rep[hit], size_group[hit]


def _keys(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """(key, rep, size_group) of the keys of the rows' sets that more than one row has.

    Nearly all keys have one row, and a set has about as many keys as n-grams. So they are sent packed to where
    equal ones meet, and only those that do become rows. Keys are shortened on the way; unlike ones that
    then meet make unlike documents candidates, which the product tells apart.
    """
    parts = KEY_PARTITIONS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("packed", pa.binary())])
    schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("size_group", pa.int32())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, number = BlockKeys(similarity), [], 0

        def done() -> pa.RecordBatch:
            held.sort(key=lambda h: h[0])
            rep = np.repeat(np.array([h[0] for h in held], np.int64), [len(h[1]) for h in held])
            columns = packed_keys(np.concatenate([h[1] for h in held]).view(U), rep, np.concatenate([h[2] for h in held]), parts)
            return record_batch(sent, list(zip(*columns, strict=True)))

        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for first, texts in byte_slices(batch.column("text")):
                for doc, shingles in zip(ids[first : first + len(texts)], shingle_sets(texts, similarity.words), strict=True):
                    found, at = keys.of(shingles) if len(shingles) else ((), ())
                    if len(found):
                        held.append((doc, found, at))
                        number += len(found)
                    if number >= PACKED:
                        yield done()
                        held, number = [], 0
        if held:
            yield done()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
        held, number = [], 0
        for found in repeated_keys(blocks) if blocks else ():
            held.append(found)
            number += len(found[0])
            if number >= PACKED // 8:
                yield record_batch(schema, [np.concatenate(c) for c in zip(*held, strict=True)])
                held, number = [], 0
        if held:
            yield record_batch(schema, [np.concatenate(c) for c in zip(*held, strict=True)])

    packed = docs.select("doc_id", "text").mapInArrow(releasing(pack), "part int, number int, packed binary")
    return packed.repartitionById(parts, "part").mapInArrow(releasing(unpack), "key long, rep long, size_group int")


def _node(rep: str, size_group: str) -> Column:
    """A number for a document in a size group. Two that share a number become one cluster, which loses no link."""
    return F.col(rep).bitwiseXOR(F.shiftleft(F.col(size_group).cast("long"), 56))


def _spared(similarity: Similarity) -> Column:
    """How many of its keys of a size group a set can do without."""
    ends = similarity.size_groups(10**13)[1:]
    known = [similarity.crowded(similarity.differ(end)) for end in ends[:GROUPS]]
    return F.element_at(F.lit(known).cast("array<long>"), F.col("size_group") + 1)


def _shared(keys: DataFrame, similarity: Similarity) -> DataFrame:
    """The keys that more than one row has, without those that a set can do without.

    They are sorted once and counted as they pass, in more partitions than the session's: a join with their
    counts would hold each of them three times in an executor's memory.
    """
    parts = KEY_PARTITIONS * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartition(parts, "key").withColumn("members", F.count("*").over(Window.partitionBy("key")))
    # Linked sets share more keys than both can do without, so each leaves out those most shared:
    # common passages then do not chain unlike documents together.
    crowd = Window.partitionBy("rep", "size_group").orderBy(F.desc("members"), "key")
    placed = dealt.filter("members > 1").withColumn("place", F.row_number().over(crowd))
    return placed.filter(F.col("place") > _spared(similarity)).select("key", "rep", "size_group")


def tile_links(rows: list[tuple[int, int, np.ndarray]], same: bool, similarity: Similarity) -> list[tuple[int, int]]:
    """Edges that connect linked documents of one tile, or of two, as far as they are linked across.

    Each row has its tile (0 or 1), document and sorted set. Row by row, the product adds up the
    columns' postings into overlap counts with all rows after it.
    """
    rows = sorted(rows, key=lambda r: r[0])
    docs, sizes = [r[1] for r in rows], np.array([len(r[2]) for r in rows])
    split = sum(r[0] == 0 for r in rows)
    columns = np.concatenate([r[2] for r in rows])
    # Numbers of rows and entries of two tiles fit 32 bits; what is done with goes, since this is a task's largest step.
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    order = np.argsort(columns, kind="stable").astype(np.int32)  # within a column, rows rise
    ranked, holder = columns[order], owner[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    del columns, owner, ranked
    opens = np.flatnonzero(fresh).astype(np.int32)
    ends = np.append(opens[1:], np.int32(len(order)))[np.cumsum(fresh, dtype=np.int32) - 1]  # end of the postings of each entry's column
    # Entry positions by row: where each (row, column) stands in its column's postings.
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    del order, fresh
    edge = np.cumsum([0, *sizes])
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for row in range(len(rows) if same else split):
        at = place[edge[row] : edge[row + 1]] + 1
        counts = ends[at - 1] - at
        total = int(counts.sum())
        if not total:
            continue
        shift = np.cumsum(counts) - counts
        others = holder[np.repeat(at - shift, counts) + np.arange(total)]
        overlap = np.bincount(others, minlength=len(rows))
        partners = np.flatnonzero((overlap > 0) & similarity.linked(overlap, sizes[row], sizes))
        for other in partners:
            if same or other >= split:
                a, b = root(row), root(int(other))
                if a != b:
                    parent[b] = a
                    found.append((docs[row], docs[int(other)]))
    return found


LINKS = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _tiles(members: DataFrame, similarity: Similarity) -> DataFrame:
    """(cluster, rep, tile, others) of the members (rep, cluster, size_group, n): a row meets tiles 0 to ``others`` - 1.

    Linked sets meet in the size group of the larger one, so smaller sets that only visit a group need not
    meet each other there. In a cluster of more than one tile they have tiles of their own, after the others.
    Clusters of visitors only find nothing and are left out.
    """
    firsts = F.lit(similarity.size_groups(10**13)[: GROUPS + 1]).cast("array<long>")
    # Of a repeated document the longest row counts: it visits only where all its rows do.
    own = (F.col("n") >= F.element_at(firsts, F.col("size_group") + 1)).alias("own")
    met = members.select("cluster", "rep", "n", own).groupBy("cluster", "rep").agg(F.max("n").alias("n"), F.max("own").alias("own"))

    def tiles(which: Column) -> Column:
        return F.ceil(F.greatest(F.count_if(which) / similarity.tile, F.sum(F.when(which, F.col("n")).otherwise(0)) / similarity.entries))

    sizes = met.groupBy("cluster").agg(tiles(F.lit(True)).alias("all"), tiles(F.col("own")).alias("owns"), tiles(~F.col("own")).alias("visits"))
    single = F.col("all") == 1
    dealt = met.join(sizes.filter("owns > 0"), "cluster").withColumn("hash", F.xxhash64("rep"))
    tile = F.when(single, 0).when(F.col("own"), F.pmod("hash", "owns")).otherwise(F.col("owns") + F.pmod("hash", "visits"))
    others = F.when(single, 1).when(F.col("own"), F.col("owns") + F.col("visits")).otherwise(F.col("owns"))
    return dealt.select("cluster", "rep", tile.cast("long").alias("tile"), others.cast("long").alias("others"))


def _product(tiles: DataFrame, similarity: Similarity) -> DataFrame:
    """Links within each pair of tiles. A task sees its tile pairs one after the other."""
    keys = ("low", "high", "cluster")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        now = None

        def done() -> pa.RecordBatch:
            texts = pa.array([text for _, _, text in held], pa.large_binary())
            sets = [x for _, part in byte_slices(texts) for x in shingle_sets(part, similarity.words)]
            rows = [(tile, doc, x) for (tile, doc, _), x in zip(held, sets, strict=True)]
            del texts, sets
            return record_batch(LINKS, list(zip(*tile_links(rows, now[0] == now[1], similarity), strict=True)) or [[], []])

        for batch in batches:
            heads = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            texts = batch.column("text").cast(pa.large_binary())
            for head, tile, doc, text in zip(heads, *(batch.column(c).to_pylist() for c in ("tile", "rep")), texts, strict=True):
                if head != now:
                    if len(held) > 1:
                        yield done()
                    held, now = [], head
                held.append((int(tile != head[0]), doc, text.as_py() or b""))
        if len(held) > 1:
            yield done()

    dealt = tiles.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(releasing(multiply), "x long, y long")


def _bit(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(FILTER_BITS)) + 1


def _bitmap(ids: DataFrame) -> dict[int, bytes]:
    """Bits of hashed ids, by bucket of 32,768 bits. Its size does not depend on the number of ids."""
    rows = (
        ids.select(_bit("rep").alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    return {r.bucket: bytes(r.bits) for r in rows}


def _texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents whose id may be among ``members``: certainly of all that are."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, part in _bitmap(members).items():
        first = (bucket - 1) * 4096  # buckets count from 1
        bits[first : first + 4096] |= np.frombuffer(part, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2 MB whatever the input
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("bit").to_numpy() - 1
            kept = batch.filter(pa.array(shared.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1))
            yield record_batch(schema, [kept.column("doc_id"), kept.column("text")])

    read = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", _bit("doc_id").alias("bit"))
    return read.mapInArrow(releasing(sift), "doc_id long, text string")


def _links(docs: DataFrame, placed: DataFrame, similarity: Similarity, most: int) -> DataFrame:
    """(x, y) over all pairs of tiles. At most some ``most`` texts are sent at once, the pairs of a round at a time.

    Texts of a cluster are sent once for each of its tiles, so they grow with its square; what a round
    has sent is off the disk before the next.
    """
    texts = _texts_of(docs, placed)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    tiles = (
        texts.join(placed, texts["doc_id"] == placed["rep"])
        .select("cluster", "rep", "tile", "text", other.alias("other"))
        .select("cluster", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "rep", "text")
    )
    rounds = -(-(placed.agg(F.sum("others")).first()[0] or 0) // max(1, most))
    if rounds <= 1:
        return _product(tiles, similarity)
    turn = F.pmod(F.xxhash64("cluster", "low", "high"), F.lit(rounds))
    return reduce(DataFrame.union, [stored(_product(tiles.filter(turn == r), similarity), "links") for r in range(rounds)])


def groups(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    The component is the smallest doc_id reachable by links, itself included. A NULL or wordless
    text has an empty set and links with nothing. Rows with the same doc_id are one document: what
    any of them links with, all do. A row with a NULL doc_id takes no part and keeps a NULL component.
    Sets are compared by 64-bit hashes of their shingles.
    """
    signed = stored(_signatures(docs, similarity), "signatures")
    filled = signed.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    sets = filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    class_ids = sets.select(F.col("n").alias("cn"), F.col("s1").alias("c1"), F.col("s2").alias("c2"), "rep")
    same_set = (F.col("n") == F.col("cn")) & (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2"))
    classed = stored(signed.join(class_ids, same_set, "left").select("doc_id", "n", "rep"), "classes")
    # A document whose rows all stand for another one's set adds nothing.
    copies = classed.groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least = most AND least != doc_id")
    copies = stored(copies.select(F.col("doc_id").alias("copy")), "copies")  # stored: Spark then knows its size
    distinct = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()).join(copies, F.col("doc_id") == F.col("copy"), "left_anti")
    shared = _shared(_keys(distinct, similarity), similarity)
    # Each size group has clusters of its own: a document takes part in those of all its groups.
    shared = stored(shared.withColumn("node", _node("rep", "size_group")), "keys")
    heads = shared.groupBy("key").agg(F.min("node").alias("head"))
    near = shared.join(heads, "key").filter("node != head").select("node", "head").distinct()
    clustered = components(near).select(F.col("a").alias("node"), F.col("b").alias("cluster"))
    clustered = clustered.union(clustered.select(F.col("cluster").alias("node"), "cluster").distinct())
    members = stored(shared.select("node", "rep", "size_group").distinct().join(clustered, "node").select("rep", "cluster", "size_group"), "clusters")

    lengths = classed.groupBy(F.col("doc_id").alias("rep")).agg(F.max("n").alias("n"))
    placed = stored(_tiles(members.join(lengths, "rep"), similarity), "tiles")
    linked = components(_links(docs, placed, similarity, max(SENT, ROUND * classed.count())))

    found = classed.join(linked, F.col("rep") == F.col("a"), "left")
    own = F.when(F.col("n") > 0, F.coalesce("b", "rep")).otherwise(F.col("doc_id"))
    out = found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    return out


def keep_one(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """The rows whose document is the smallest of its component, all columns as they were.

    Rows without a doc_id stay.
    """
    gone = groups(docs, similarity).filter("component_id < doc_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
