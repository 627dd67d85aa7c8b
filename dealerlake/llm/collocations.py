"""Phrases whose words keep company, mined by dynamic itemset counting.

Texts are written once as word numbers, in slices dealt to a few shards. The shards are scanned in a
cycle, one Spark job a shard. Words are counted in the first cycle. As soon as both subphrases of a longer phrase (all words but the last, all but the
first) have reached the threshold in what was scanned so far, the phrase is counted too, from the next
shard on, whatever lengths are being counted already, until it has met each shard once. Mining ends when
the phrase activated last has completed its cycle.

Which subphrases have reached the threshold, and after which scan, is handed to the tasks as a table of
fixed size over phrase hashes whose entries are written once. Phrases that share an entry may be
activated sooner than need be, which costs time only: the entries of its two subphrases fix the start of
a phrase's cycle, and each cycle is one whole pass over all shards. Counts are taken by the phrase's text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm.common import record_batch, stored
from dealerlake.llm.shingles import STEP, U, mixed
from dealerlake.session import scratch_dir

BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLDED = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" "
)  # A-Z to a-z, ends of pieces to one of them, blanks to one of them
EMPTY, BREAK = 0, 1  # numbers of what are no words: nothing between two blanks, the end of a piece


@dataclass(frozen=True)
class Mining:
    longest: int = 5  # words
    threshold: int = 100
    shards: int = 2
    entries: int = 1 << 24  # bytes of the table that tasks are given
    slice_bytes: int = 1 << 21  # of text numbered and counted at once
    top: int = 2000
    factor: int = 1000
    absorbed_percent: int = 100  # of a phrase's occurrences in one longer candidate


class _Numbers(dict):
    """Word -> number, given out as words come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


CODED = pa.schema([("lang", pa.string()), ("words", pa.string()), ("numbers", pa.binary()), ("n", pa.int64())])
CODED_DDL = "lang string, words string, numbers binary, n long"


def _coded(raws: Sequence[bytes], lang: str) -> pa.RecordBatch:
    """One row for some folded texts of one language: their distinct words, the number of the word at each place, how many there are.

    Numbers count from 2 and take two bytes where that suffices; 1 stands where a piece ends.
    """
    numbers = _Numbers({b"": EMPTY, b"\n": BREAK})
    tokens = b"\n".join(raws).replace(b"\n", b" \n ").split(b" ")
    places = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
    places = places[places != EMPTY].astype(np.uint16 if len(numbers) <= 1 << 16 else np.uint32)
    return record_batch(CODED, [[lang], [b" ".join(list(numbers)[2:]).decode()], [places.tobytes()], [int((places != BREAK).sum())]])


def _cut(text: bytes, limit: int) -> Iterator[bytes]:
    """A folded text in parts of about ``limit`` bytes. It is cut where pieces end; a longer piece stays whole."""
    start = 0
    while len(text) - start > limit:
        end = text.rfind(b"\n", start, start + limit)
        end = text.find(b"\n", start + limit) if end < 0 else end
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def _code(docs: DataFrame, slice_bytes: int) -> DataFrame:
    """The texts as rows of ``_coded``, each of about a slice of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
                for raw in _cut(text.as_py().translate(FOLDED), slice_bytes):
                    held.setdefault(lang, []).append(raw)
                    sizes[lang] = sizes.get(lang, 0) + len(raw) + 1
                    if sizes[lang] >= slice_bytes:
                        yield _coded(held.pop(lang), lang)
                        del sizes[lang]
            if sum(sizes.values()) >= 8 * slice_bytes:  # many languages
                yield from (_coded(raws, lang) for lang, raws in held.items())
                held, sizes = {}, {}
        yield from (_coded(raws, lang) for lang, raws in held.items())

    known = docs.filter("text IS NOT NULL").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return known.mapInArrow(run, CODED_DDL)


def _grouped(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct phrase of ``size`` words starting at ``at``, and how often it starts there.

    Word numbers are packed into one integer, which is replaced by its rank whenever it would overflow.
    """
    width = int(words.max()) + 1
    key, top = words[at], width
    for k in range(1, size):
        if top * width >= 2**62:
            distinct, key = np.unique(key, return_inverse=True)
            top = len(distinct)
        key, top = key * width + words[at + k], top * width
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    return first, times


COUNTS = pa.schema([("key", pa.string()), ("due", pa.int8()), ("times", pa.int64())])
COUNTS_DDL = "key string, due byte, times long"


def _codes(words: Sequence[str], lang: str) -> np.ndarray:
    """Hashes of words of a language."""
    found = np.fromiter((zlib.crc32(w.encode()) for w in words), U, len(words))
    return mixed(found + U(zlib.crc32(lang.encode()) << 32))


def _counted(lang: str, spelled: list[str], words: np.ndarray, reached: np.ndarray, scan: int, mining: Mining) -> Iterator[pa.RecordBatch]:
    """(key, due, times) of the phrases to be counted in this scan, of one row of ``_coded``.

    The key is the phrase, a tab and the language; due the last scan of the phrase's cycle.
    """
    texts = pa.array(["", "", *spelled])
    single = np.append(np.zeros(2, U), _codes(spelled, lang))
    last = U(len(reached) - 1)

    def rows(phrases: pa.Array, due: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        return record_batch(COUNTS, [pc.binary_join_element_wise(phrases, lang, "\t"), due, times])

    if scan <= mining.shards:
        times = np.bincount(words, minlength=len(texts))[2:]
        yield rows(texts.slice(2), np.full(len(spelled), mining.shards), times)
    if not reached.any():
        return
    hashes, state = single[words], reached[single & last][words].astype(np.int64)
    state[words == BREAK] = 0  # no phrase goes over it
    for size in range(2, mining.longest + 1):
        at = np.flatnonzero((state[:-1] > 0) & (state[1:] > 0))
        if not len(at):
            return
        since = np.maximum(state[at], state[at + 1])
        hashes[at] = mixed(hashes[at] * STEP + single[words[at + size - 1]], size)
        entry = (hashes[at] & last).astype(np.int64)
        due = since + mining.shards
        now = np.flatnonzero(due >= scan)
        if len(now):
            first, times = _grouped(words, at[now], size)
            first = now[first]
            parts = [texts.take(pa.array(words[at[first] + k])) for k in range(size)]
            yield rows(pc.binary_join_element_wise(*parts, " "), due[first], times)
        longer = np.zeros(len(state) - 1, np.int64)
        longer[at] = np.where(reached[entry] > 0, np.maximum(reached[entry], since), 0)  # never before its own start
        state = longer


def _scan(shard: DataFrame, reached, scan: int, mining: Mining) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, spelled, numbers in zip(*(batch.column(c) for c in ("lang", "words", "numbers")), strict=True):
                held = spelled.as_py().split(" ") if len(spelled.as_py()) else []
                raw = numbers.as_buffer()
                words = np.frombuffer(raw, np.uint16 if len(held) + 2 <= 1 << 16 else np.uint32).astype(np.int64)
                if len(held):
                    yield from _counted(lang.as_py(), held, words, reached.value, scan, mining)

    return shard.mapInArrow(run, COUNTS_DDL)


def _entries(phrases: DataFrame, entries: int) -> np.ndarray:
    """Which entries of the table the phrases (lang, phrase) stand at: one bit each, put together by Spark in bitmaps of 2**15 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                codes = _codes(phrase.split(" "), lang)
                value = codes[:1]
                for size in range(2, len(codes) + 1):
                    value = mixed(value * STEP + codes[size - 1 : size], size)
                found.append(int(value[0]) & (entries - 1))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["entry"])

    placed = phrases.select("lang", "phrase").mapInArrow(run, "entry long")
    rows = placed.groupBy(F.shiftright("entry", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("entry").bitwiseAND(32767)).alias("bits")).collect()
    found = np.zeros((-(-entries // 32768), 32768), bool)
    for row in rows:
        found[row.part] = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
    return found.ravel()[:entries]


def frequent_phrases(docs: DataFrame, mining: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to ``longest`` words that occur ``threshold`` times; (lang, n).

    Words are runs of characters other than blank and tab, phrases do not go over ``.,;:!?`` and line
    ends; A-Z count as a-z. A NULL lang is ``und``, a NULL text empty. Every row counts, repeated or not.
    """
    if mining.entries & (mining.entries - 1):
        raise ValueError("entries must be a power of two")
    spark = docs.sparkSession
    path = scratch_dir(spark, "shards")
    dealt = _code(docs, mining.slice_bytes).withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(mining.shards)).cast("int"))
    # Small row groups, since a row is a slice of text and a task reads a group at once.
    dealt.write.option("parquet.block.size", 8 * mining.slice_bytes).partitionBy("_shard").parquet(path)
    shards = spark.read.schema(f"{CODED_DDL}, _shard int").parquet(path)
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 0")
    if mining.longest * mining.shards > 120:
        raise ValueError("longest times shards must be at most 120")
    reached = np.zeros(mining.entries, np.uint8)
    phrase, lang = F.substring_index("key", "\t", 1), F.expr("substr(key, instr(key, '\t') + 1)")
    size = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1
    scan, finished, alive = 0, [], None
    while scan < mining.shards or scan < int(reached.max()) + mining.shards:
        scan += 1
        shared = spark.sparkContext.broadcast(reached)  # of fixed size
        counts = _scan(shards.filter(F.col("_shard") == (scan - 1) % mining.shards).select(*CODED.names), shared, scan, mining)
        if alive is not None:
            counts = counts.union(alive)
        totals = counts.groupBy("key").agg(F.max("due").alias("due"), F.sum("times").alias("times"))  # a phrase has one due scan
        totals = stored(totals.filter((F.col("due") > scan) | (F.col("times") >= mining.threshold)), "phrases")
        shared.unpersist()
        alive = totals.filter(F.col("due") > scan)
        enough = totals.filter(F.col("times") >= mining.threshold).select(phrase.alias("phrase"), lang.alias("lang"), "due", "times").withColumn("size", size)
        finished.append(enough.filter(F.col("due") == scan))
        new = _entries(enough.filter(F.col("size") < mining.longest), mining.entries) & (reached == 0)
        reached = np.where(new, scan, reached).astype(reached.dtype)
    kept = reduce(DataFrame.union, finished).select("lang", "phrase", "size", F.col("times").alias("f"))
    return stored(kept, "frequent"), stored(sizes, "sizes")


def collocations(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best ``top`` phrases of two words or more.

    A phrase of a occurrences is cut after its first k words into parts of l and r occurrences; its score
    is floor(factor * a * n / (l * r)) for the cut where that is least, of equal ones the first; it is at
    most factor * n / threshold, which must fit 63 bits. Phrases
    of which ``absorbed_percent`` of the occurrences lie in one longer frequent phrase are left out.
    See ``frequent_phrases`` for words, NULLs and repeats; without texts the result is empty.
    """
    phrases, sizes = frequent_phrases(docs, mining)
    several = phrases.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substr(phrase, length(left) + 2)"))
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(sizes, "lang")
    wide = "CAST({} AS DECIMAL(38, 0))".format  # products pass 64 bits
    score = F.expr(f"({wide('a')} * n * {mining.factor}) div ({wide('l')} * r)")
    least = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.max("a").alias("a"), F.max("n").alias("n"))

    # Every shorter run of words in a longer phrase, with the longer one's count.
    words = F.split("phrase", " ", -1)
    starts = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m), i -> array_join(slice(words, i + 1, m), ' '))))"
    )
    inner = several.filter("size > 2").withColumn("words", words).select("lang", F.explode(starts).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = least.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * mining.absorbed_percent))

    # Best of each part of a language first, so that no task ranks a whole one.
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    held = held.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= mining.top)
    ranked = held.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= mining.top).select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), spelled AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), sizes AS (
  SELECT lang, sum(len(words))::HUGEINT AS n FROM spelled GROUP BY lang
), starts AS (
  SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM spelled, range(1, 6) t(m) WHERE len(words) >= m
), phrases AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*)::HUGEINT AS f FROM starts GROUP BY ALL HAVING count(*) >= 100
), several AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM phrases WHERE m > 1
), cuts AS (
  SELECT lang, phrase, m, a, words, unnest(range(1, m)) AS k FROM several
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n, (1000 * c.a * n) // (l.f * r.f) AS score
  FROM cuts c JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ') JOIN sizes s ON s.lang = c.lang
), least AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), lengths AS (
  SELECT lang, a, m, words, unnest(range(2, m)) AS part FROM several
), inner_places AS (
  SELECT lang, a, words, part, unnest(range(1, m - part + 2)) AS i FROM lengths
), inside AS (
  SELECT lang, array_to_string(words[i:i + part - 1], ' ') AS phrase, max(a) AS longer FROM inner_places GROUP BY ALL
), held AS (
  SELECT c.* FROM least c LEFT JOIN inside i USING (lang, phrase) WHERE place = 1 AND (longer IS NULL OR 100 * longer < 100 * a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM held
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
