"""Line deduplication in DataFrame functions only: a report by content-defined chunks, and the removal of passages.

``report`` cuts a text after a line when a rolling hash over the hashes of this line and the one before it
says so; long lines stand alone. Its units are every chunk of several lines or of one long line, and every
two chunks that follow each other of which one is neither or that have blank chunks between them. Units
that repeat go but for the first place that holds them. As a whole copy is cut like its original, all of it
goes, however short its lines. The cut beside the first line of a passage depends on the line before,
and the one after its last line may be missing, so at the edges of a passage in other surroundings lines may stay.

``dedup_lines`` cuts the same chunks and removes every chunk of several lines or of one long line that an
earlier place holds. What the edges of a passage leave is found by an exact check of the rest: every two
lines that follow each other, blank lines between them included, over the cuts and inside the chunks that
stay. A passage of two lines or more that an earlier place holds consists of such pairs, so all its lines go,
wherever it stands and however short they are. Pairs inside a removed chunk need not be looked at, since each
stands at an earlier place too.

Repeats are found by SHA-256: only digests and places are written, grouped and joined. ``report`` then
compares the texts of the units whose digest repeats, so its units are the same if their bytes are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.common import stored


@dataclass(frozen=True)
class Chunking:
    """Cut where the rolling hash is a multiple of ``divisor``; lines of ``long_words`` words stand alone."""

    divisor: int = 2
    factor: int = 31
    long_words: int = 30


ORDINAL = 10**9  # above any number of chunks in a text


def with_chunks(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """``docs`` plus _lines and _ends, the number of the last line of each chunk, counted from 1."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    code = F.transform("_lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long"))
    alone = F.transform("_lines", lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1 >= chunking.long_words)

    def ends(i: Column) -> Column:
        rolled = F.get("_codes", i - 2) * chunking.factor + F.get("_codes", i - 1)
        cut = F.coalesce(rolled % chunking.divisor == 0, F.lit(False))
        return (i == F.size("_lines")) | F.get("_alone", i - 1) | F.get("_alone", i) | cut

    held = docs.withColumn("_lines", lines).withColumns({"_codes": code, "_alone": alone})
    return held.withColumn("_ends", F.filter(F.sequence(F.lit(1), F.size("_lines")), ends)).drop("_codes", "_alone")


def _start(j: Column) -> Column:
    return F.coalesce(F.get("_ends", j - 1), F.lit(0)) + 1


def _filled(line: Column) -> Column:
    return F.length(F.replace(line, F.lit(" "), F.lit(""))) > 0


def _digest(chunk: str | Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def _unit_texts(docs: DataFrame, chunking: Chunking, *more: str) -> DataFrame:
    """(doc_id, place, span, chunk) of every unit, and these columns of its row.

    ``place`` is the number of its first chunk, ``span`` how many more there are.
    """
    text = lambda first, last: F.array_join(F.slice("_lines", first, last - first + 1), "\n")

    def measured(end: Column, j: Column) -> Column:
        start = _start(j)
        lines = F.size(F.filter(F.slice("_lines", start, end - start + 1), _filled))
        words = F.length(text(start, end)) - F.length(F.replace(text(start, end), F.lit(" "), F.lit(""))) + 1
        alone = (lines > 1) | (words >= chunking.long_words)
        return F.struct(j.alias("place"), start.alias("start"), end.alias("end"), lines.alias("lines"), alone.alias("alone"))

    def paired(part: Column, k: Column) -> Column:
        after = F.get("_parts", k + 1)
        span, chunk = after["place"] - part["place"], text(part["start"], after["end"])
        needed = after.isNotNull() & (~(part["alone"] & after["alone"]) | (span > 1))  # else the two repeat by themselves
        return F.when(needed, F.struct(part["place"].alias("place"), span.alias("span"), chunk.alias("chunk")))

    def single(part: Column) -> Column:
        return F.struct(part["place"].alias("place"), F.lit(0).alias("span"), text(part["start"], part["end"]).alias("chunk"))

    cut = with_chunks(docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", *more), chunking)
    parts = F.filter(F.transform("_ends", measured), lambda p: p["lines"] > 0)
    held = cut.select("doc_id", *more, "_lines", parts.alias("_parts"))
    singles = F.transform(F.filter("_parts", lambda p: p["alone"]), single)
    pairs = F.filter(F.transform("_parts", paired), lambda u: u.isNotNull())
    return held.select("doc_id", *more, F.inline(F.concat(singles, pairs)))


def _units(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """(doc_id, place, span, digest) of every unit."""
    return _unit_texts(docs, chunking).select("doc_id", "place", "span", _digest("chunk").alias("digest"))


def _ordinal() -> Column:
    """Order of occurrences over all texts: by document, then place. Fixed length, so it aggregates without sorting."""
    return (F.col("doc_id").cast("decimal(20,0)") * F.lit(ORDINAL).cast("decimal(10,0)") + F.col("place")).cast("decimal(38,0)")


def _repeated(units: DataFrame) -> DataFrame:
    """(digest, first): the first place of every digest that occurs more than once."""
    counted = units.groupBy("digest").agg(F.count("*").alias("times"), F.min(_ordinal()).alias("first"))
    return stored(counted.filter("times > 1").select("digest", "first"), "repeated")


LATER = "_ordinal_here - first > span"  # neither the first place of its digest nor overlapping it


def _later(units: DataFrame) -> DataFrame:
    """(doc_id, place, span) of the stored units that neither are the first of their digest nor overlap it.

    ``span`` is how many places a unit takes beyond its own.
    """
    return units.withColumn("_ordinal_here", _ordinal()).join(_repeated(units), "digest").filter(LATER).select("doc_id", "place", "span")


def _later_texts(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """(doc_id, place, span) of the units of ``docs`` that neither are the first of their text nor overlap it.

    Texts are cut out again where a digest repeats, and grouped on their bytes with it, so each is sent once a task.
    """
    units = stored(_units(docs, chunking), "units")
    suspect = units.join(_repeated(units).select("digest"), "digest").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("digest").alias("_digests"))
    again = docs.select("doc_id", "text").join(suspect, docs["doc_id"] == suspect["_id"])
    texts = _unit_texts(again, chunking, "_digests").withColumn("digest", _digest("chunk")).filter(F.array_contains("_digests", F.col("digest")))
    firsts = stored(texts.groupBy("digest", "chunk").agg(F.count("*").alias("times"), F.min(_ordinal()).alias("first")), "texts")
    kinds = firsts.groupBy("digest").agg(F.count("*").alias("kinds"), F.max("first").alias("first"))

    def later(places: DataFrame, of: DataFrame, *keys: str) -> DataFrame:
        return places.withColumn("_ordinal_here", _ordinal()).join(of.select(*keys, "first"), [*keys]).filter(LATER).select("doc_id", "place", "span")

    found = later(units, kinds.filter("kinds = 1"), "digest")
    clashes = kinds.filter("kinds > 1").select("digest")
    if clashes.isEmpty():
        return found
    return found.union(later(texts.join(clashes, "digest"), firsts, "digest", "chunk"))  # different texts of one digest


def removals(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """(_id, _removed): places of the chunks to remove from each document that loses any."""
    return _places(_later_texts(docs, chunking))


def _places(later: DataFrame) -> DataFrame:
    places = later.select(F.col("doc_id").alias("_id"), F.explode(F.sequence("place", F.col("place") + F.col("span"))).alias("_place"))
    return places.groupBy("_id").agg(F.collect_set("_place").alias("_removed"))


def _kept(chunking: Chunking, docs: DataFrame) -> DataFrame:
    """``docs`` plus _lines, _lost (number of removed lines) and _text, the text that stays."""
    gone = removals(docs, chunking)
    found = with_chunks(docs.join(gone, docs["doc_id"] == gone["_id"], "left"), chunking)
    parts = F.transform("_ends", lambda end, j: F.struct(j.alias("place"), end.alias("end"), _start(j).alias("start")))
    lost = F.filter(parts, lambda p: F.array_contains("_removed", p["place"]))
    stay = F.filter(parts, lambda p: ~F.array_contains("_removed", p["place"]))
    whole = F.flatten(F.transform(stay, lambda p: F.slice("_lines", p["start"], p["end"] - p["start"] + 1)))
    count = F.aggregate(lost, F.lit(0), lambda total, p: total + p["end"] - p["start"] + 1)
    touched = F.col("_removed").isNotNull()
    done = F.struct(
        F.when(touched, count).otherwise(0).alias("_lost"),
        F.when(touched, F.array_join(whole, "\n")).otherwise(F.col("text")).alias("_text"),
    )
    # As a generator's output, so that a filter on it is not rewritten to compute the chunks over and over.
    return found.select("*", F.inline(F.array(done)))


def report(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 of every row.

    A NULL or empty text is one empty line and loses nothing; its digest is that of the empty text. A
    single short line alone in its text stays. Rows with the same doc_id are one document: the same places
    are removed from each of them, and equal units at one place do not remove each other. A repeat that
    overlaps the first place of its unit stays. Rows without a doc_id stay untouched and remove nothing.
    """
    return _kept(chunking, docs.select("doc_id", "text")).select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        F.col("_lost").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("_text", F.lit("")), 256).alias("kept_sha256"),
    )


def _split(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))


PASSAGES = "array<struct<place: int, span: int, digest: binary>>"


def passages(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """(doc_id, place, span, digest, pairs) of every chunk of several lines or of one long line, and one row a document without digest.

    ``place`` is the number of the first line, ``span`` how many more there are, from the first line that is
    not blank to the last. ``pairs`` (place, span, digest) holds every two lines that follow each other in
    the chunk, or over the cuts between chunks in the row without digest. Blank lines are no lines of
    their own; those between two others belong to the pair.
    """
    cut = with_chunks(docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text"), chunking)
    filled = lambda i: _filled(F.get("_lines", i - 1))
    parts = F.transform("_ends", lambda end, j: F.filter(F.sequence(_start(j), end), filled))
    held = cut.select("doc_id", "_lines", F.filter(parts, lambda p: F.size(p) > 0).alias("_parts"))

    def unit(first: Column, last: Column) -> tuple[Column, Column, Column]:
        text = F.array_join(F.slice("_lines", first, last - first + 1), "\n")
        return first.alias("place"), (last - first).alias("span"), F.unhex(F.sha2(text, 256)).alias("digest")

    def pairs(part: Column) -> Column:
        before = F.slice(part, 1, F.size(part) - 1)
        return F.transform(before, lambda i, k: F.struct(*unit(i, F.get(part, k + 1))))

    def whole(part: Column) -> Column:
        line = F.get("_lines", part[0] - 1)
        alone = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1 >= chunking.long_words
        of_chunk = F.struct(*unit(part[0], F.element_at(part, -1)), pairs(part).cast(PASSAGES).alias("pairs"))
        return F.when((F.size(part) > 1) | alone, of_chunk)

    def over_cut(part: Column, k: Column) -> Column:
        return F.struct(*unit(F.element_at(part, -1), F.get(F.get("_parts", k + 1), F.lit(0))))

    cuts = F.transform(F.slice("_parts", 1, F.greatest(F.size("_parts") - 1, F.lit(0))), over_cut)
    none = F.lit(None).cast("binary")
    between = F.struct(F.lit(0).alias("place"), F.lit(0).alias("span"), none.alias("digest"), cuts.cast(PASSAGES).alias("pairs"))
    chunks = F.filter(F.transform("_parts", whole), lambda u: u.isNotNull())
    return held.select("doc_id", F.inline(F.concat(chunks, F.array(between))))


def split_repeats(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``passages``: (doc_id, place, span) of the chunks that an earlier place holds, and of all pairs outside them, with digest."""
    chunks = units.filter("digest IS NOT NULL")
    found = chunks.withColumn("_ordinal_here", _ordinal()).join(_repeated(chunks), "digest", "left")
    gone = F.coalesce(F.expr(LATER), F.lit(False))
    # Pairs of a removed chunk are given up here.
    marked = stored(found.select("doc_id", "place", "span", gone.alias("gone"), F.when(~gone, F.col("pairs")).alias("pairs")), "marked")
    rest = marked.filter("NOT gone").select("doc_id", "pairs").union(units.filter("digest IS NULL").select("doc_id", "pairs"))
    return marked.filter("gone").select("doc_id", "place", "span"), rest.select("doc_id", F.inline("pairs"))


def repeated_lines(docs: DataFrame, long_words: int = Chunking.long_words) -> DataFrame:
    """(_id, _removed): numbers of the lines to remove from each document that loses any, counted from 1."""
    chunks, pairs = split_repeats(stored(passages(docs, Chunking(long_words=long_words)), "passages"))
    return _places(chunks.union(_later(pairs)))


def dedup_lines(docs: DataFrame, long_words: int = Chunking.long_words) -> DataFrame:
    """The rows without repeated passages. A row that loses every line that is not blank is gone.

    A passage is two lines or more, or one line of ``long_words`` words; it stays where it occurs
    first. A shorter line alone stays. Columns stay as they are; ``n_chars``, if there, follows the
    text. Rows with the same doc_id are one document, rows without a doc_id stay untouched.
    """
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))  # so that no name can clash
    gone = repeated_lines(docs, long_words)
    found = _split(packed.join(gone, packed["doc_id"] == gone["_id"], "left"))
    stay = F.array_except(F.sequence(F.lit(1), F.size("_lines")), "_removed")
    rest = F.array_join(F.transform(stay, lambda i: F.get("_lines", i - 1)), "\n")
    touched = F.col("_removed").isNotNull()
    done = F.struct(touched.alias("_touched"), F.when(touched, rest).otherwise(F.col("text")).alias("_text"))
    # As a generator's output, so that a filter on it is not rewritten to compute the lines over and over.
    kept = found.select("_row", F.inline(F.array(done))).filter(~F.col("_touched") | (F.length(F.trim(F.replace("_text", F.lit("\n"), F.lit("")))) > 0))
    columns = {name: F.col("_row")[name] for name in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in columns:
        size = F.when(F.col("_touched"), F.length("_text")).otherwise(columns["n_chars"])
        columns["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return kept.select(*[c.alias(n) for n, c in columns.items()])


ORACLE_SQL = """
WITH cut AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), marked AS (
  SELECT *,
    list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 7))::BIGINT) AS codes,
    list_transform(lines, lambda x: length(x) - length(replace(x, ' ', '')) + 1 >= 30) AS alone
  FROM cut
), ended AS (
  SELECT *, list_filter(range(1, len(lines) + 1), lambda i:
      i = len(lines) OR alone[i] OR coalesce(alone[i + 1], false)
      OR (i > 1 AND (codes[i - 1] * 31 + codes[i]) % 2 = 0)) AS ends
  FROM marked
), numbered AS (
  SELECT doc_id, lines, ends, unnest(range(1, len(ends) + 1)) AS place FROM ended
), parts AS (
  SELECT doc_id, lines, place, CASE WHEN place = 1 THEN 1 ELSE ends[place - 1] + 1 END AS lo, ends[place] AS hi FROM numbered
), chunks AS (
  SELECT *, hi - lo + 1 AS n, array_to_string(lines[lo:hi], chr(10)) AS chunk,
    len(list_filter(lines[lo:hi], lambda x: replace(x, ' ', '') <> '')) AS filled
  FROM parts
), measured AS (
  SELECT *, filled > 1 OR length(chunk) - length(replace(chunk, ' ', '')) + 1 >= 30 AS alone FROM chunks
), followed AS (
  SELECT *, lead(place) OVER w AS next_place, lead(hi) OVER w AS next_hi, lead(alone) OVER w AS next_alone
  FROM measured WHERE filled > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), units AS (
  SELECT doc_id, place, 0 AS span, chunk FROM followed WHERE alone
  UNION ALL
  SELECT doc_id, place, next_place - place, array_to_string(lines[lo:next_hi], chr(10))
  FROM followed WHERE next_place IS NOT NULL AND (NOT (alone AND next_alone) OR next_place - place > 1)
), ordered AS (
  SELECT *, doc_id::HUGEINT * 1000000000 + place AS here, min(doc_id::HUGEINT * 1000000000 + place) OVER (PARTITION BY chunk) AS first
  FROM units
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + span + 1)) AS place FROM ordered WHERE here - first > span
)
SELECT c.doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (g.place IS NOT NULL), 0)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(chunk, chr(10) ORDER BY c.place) FILTER (g.place IS NULL), '')) AS kept_sha256
FROM chunks c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.place = g.place GROUP BY c.doc_id
"""
