"""Licence notices in texts, by a positional index of each notice's rarest words. DataFrame functions only.

How rare a licence word is, is counted over all texts. Of each template the words of highest inverse
document frequency are indexed with their positions in it. A text's words are looked up there; every
posting says where the template would have to begin for the word to stand in its place. Words that agree
on that beginning, up to a few words put in or left out, add up their weights, and where these reach
most of what the template has, its key phrases are looked for in the text.

Three phrases give a label wherever they stand, without the index.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # around words of either case
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that label a text by themselves.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Fixed values: (label, wording of a usual notice, phrases it cannot do without).
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2.0", ["apache license", "2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2.0", ["apache org licenses"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ["binary forms"]),
    ("cc-by-nc-4.0", "licensed under cc by-nc 4.0", ["cc by nc", "4 0"]),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license",
     ["creative commons attribution sharealike"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option any later version",
     ["gnu general public license", "version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["with or without fee"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", ["hereby granted free of charge"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0", ["mozilla public license"]),
]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[str, ...], ...]


@dataclass(frozen=True)
class Scan:
    templates: tuple[Template, ...] = field(
        default=tuple(Template(label, tuple(words_of(text)), tuple(tuple(words_of(k)) for k in keys)) for label, text, keys in NOTICES)
    )
    rare: int = 6  # indexed words of a template
    drift: int = 3  # words put in or left out that still count as one place
    percent: int = 60  # of the weight of a template's indexed words


def find_words(docs: DataFrame, known: Sequence[str]) -> DataFrame:
    """(row, doc_id, n_words, hits), stored: the places of the ``known`` words in each text, by a row number of its own.

    Words are compared in lower case, of A-Z only: a letter from elsewhere whose small form is one of a-z takes more bytes.
    """
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), BETWEEN, -1), "")
    small = lambda w: F.when((F.lower(w)).isin(list(known)) & (F.octet_length(w) == F.length(F.lower(w))), F.lower(w))
    hits = F.transform("words", lambda w, i: F.struct(i.alias("pos"), small(w).alias("word")))
    held = docs.select("doc_id", words.alias("words"))
    held = held.select("doc_id", F.size("words").cast("long").alias("n_words"), F.filter(hits, lambda h: h["word"].isNotNull()).alias("hits"))
    return stored(held.withColumn("row", F.monotonically_increasing_id()), "hits")


def weights(rows: DataFrame, scan: Scan) -> dict[str, int]:
    """1000 * ln((rows + 1) / (rows with the word + 1)), rounded down, of every word of the templates.

    Counted over all rows; one number a template word comes to the driver.
    """
    known = {w for t in scan.templates for w in t.words}
    held = rows.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count()
    total, seen = rows.count(), {r.word: r["count"] for r in held.collect()}
    return {w: math.floor(1000 * math.log((total + 1) / (seen.get(w, 0) + 1))) for w in known}


@dataclass(frozen=True)
class Posting:
    word: str
    template: int
    at: int
    weight: int


def index(scan: Scan, weight: dict[str, int]) -> list[Posting]:
    """Places of each template's rarest words. As small as the templates, whatever the texts."""
    out = []
    for number, template in enumerate(scan.templates):
        rarest = sorted(set(template.words), key=lambda w: (-weight[w], w))[: scan.rare]
        out += [Posting(w, number, at, weight[w]) for at, w in enumerate(template.words) if w in rarest]
    return out


def _places(hits: str, phrase: Sequence[str]) -> Column:
    """Where the words stand one after the other. All of them are among the hits, so they follow each other there too."""

    def stands(hit: Column, i: Column) -> Column:
        out = hit["word"] == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            other = F.get(hits, i + k)
            out = out & F.coalesce((other["word"] == word) & (other["pos"] == hit["pos"] + k), F.lit(False))
        return out

    return F.transform(F.filter(hits, stands), lambda hit: hit["pos"])


def candidates(rows: DataFrame, postings: list[Posting], scan: Scan) -> DataFrame:
    """(row, template, share) of the templates that enough of their rare words place in a text.

    A word votes for every beginning up to ``drift`` words before the one it gives, and once for each.
    Postings are looked up only of templates of whose rare words a text holds enough anywhere.
    """
    rare = {(p.template, p.word): p.weight for p in postings}
    whole = {t: sum(w for (other, _), w in rare.items() if other == t) for t, _ in rare}
    held = lambda t: sum((F.when(F.array_contains("said", w), weight).otherwise(0) for (o, w), weight in rare.items() if o == t), F.lit(0))
    able = [F.when(held(t) * 100 >= whole[t] * scan.percent, F.lit(t)) for t in whole if whole[t]]
    if not able:
        return rows.select("row", F.lit(0).alias("template"), F.lit(0.0).alias("share")).limit(0)
    said = rows.filter(F.size("hits") > 0).withColumn("said", F.array_distinct("hits.word"))
    looked = said.select("row", "hits", F.explode(F.array_compact(F.array(*able))).alias("template")).select("row", "template", F.inline("hits"))
    table = rows.sparkSession.createDataFrame([(p.word, p.template, p.at, p.weight, whole[p.template]) for p in postings], "word string, template int, at int, weight int, whole int")
    looked = looked.join(F.broadcast(table), ["word", "template"])
    start = F.col("pos") - F.col("at")
    votes = looked.select("row", "template", "word", "weight", "whole", F.explode(F.sequence(start - scan.drift, start)).alias("start"))
    once = votes.groupBy("row", "template", "start", "word").agg(F.max("weight").alias("weight"), F.max("whole").alias("whole"))
    agreed = once.groupBy("row", "template", "start").agg(F.sum("weight").alias("weight"), F.max("whole").alias("whole"))
    best = agreed.groupBy("row", "template").agg(F.max("weight").alias("weight"), F.max("whole").alias("whole"))
    enough = best.filter(F.col("weight") * 100 >= F.col("whole") * scan.percent)
    return enough.select("row", "template", (F.col("weight") / F.col("whole")).alias("share"))


def scan_licenses(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Words are counted from 0; A-Z count as a-z. ``n_base``, ``first_word`` and ``last_word`` are of the
    three phrases; ``labels`` holds theirs and those of the templates. The score is 1 with one of the
    phrases, else the largest share of a template's weight that was found in place, else 0. A NULL or
    empty text has no words. Rows stay apart whatever their doc_id; further columns are not read.
    """
    phrases = {label: tuple(words_of(text)) for label, text in PHRASES.items()}
    spoken = {w for p in [*phrases.values(), *(key for t in scan.templates for key in t.keys)] for w in p}
    rows = find_words(docs, sorted(spoken | {w for t in scan.templates for w in t.words}))
    postings = index(scan, weights(rows, scan))
    found = candidates(rows, postings, scan)
    rows = rows.withColumn("hits", F.filter("hits", lambda h: h["word"].isin(sorted(spoken))))
    shares = found.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("template", "share"))).alias("shares"))  # one a template
    named = rows.join(shares, "row", "left")
    base = {label: _places("hits", phrase) for label, phrase in phrases.items()}
    named = named.withColumns({f"_{label}": places for label, places in base.items()})
    every = F.concat(*[F.col(f"`_{label}`") for label in base])
    base_labels = [F.when(F.size(F.col(f"`_{label}`")) > 0, F.lit(label)) for label in base]

    sure, scores = [], [F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.lit(0.0))]
    for number, template in enumerate(scan.templates):
        share = F.try_element_at("shares", F.lit(number))
        for key in template.keys:
            share = F.when(share.isNotNull() & (F.size(_places("hits", key)) > 0), share)
        sure.append(F.when(share.isNotNull(), F.lit(template.label)))
        scores.append(F.coalesce(share, F.lit(0.0)))
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")
    return named.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        listed(base_labels).alias("base_labels"), listed([*base_labels, *sure]).alias("labels"), F.greatest(*scores).alias("score"),
    )


def oracle(scan: Scan = Scan()) -> str:
    """The same rows in SQL."""
    places = ", ".join(f"({n}, {at}, '{w}')" for n, t in enumerate(scan.templates) for at, w in enumerate(t.words))
    names = ", ".join(f"({n}, '{t.label}')" for n, t in enumerate(scan.templates))
    keys = ", ".join(f"({n}, {k}, ' {' '.join(key)} ')" for n, t in enumerate(scan.templates) for k, key in enumerate(t.keys))
    base = ", ".join(f"('{label}', {len(words_of(p))}, {[*words_of(p)]})" for label, p in PHRASES.items())
    return f"""
WITH places(template, spot, word) AS (VALUES {places}), names(template, label) AS (VALUES {names}), keys(template, k, phrase) AS (VALUES {keys}),
base(label, size, phrase) AS (VALUES {base}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents
), spots AS (
  SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM texts
), spoken AS (
  SELECT r, i - 1 AS pos, words[i] AS word FROM spots
), known AS (SELECT DISTINCT word FROM places
), seen AS (
  SELECT word, count(DISTINCT r) AS df FROM spoken JOIN known USING (word) GROUP BY word
), weights AS (
  SELECT word, floor(1000 * ln(((SELECT count(*) FROM texts) + 1) / (coalesce(df, 0) + 1)))::BIGINT AS weight FROM known LEFT JOIN seen USING (word)
), ranked AS (
  SELECT template, word, weight, row_number() OVER (PARTITION BY template ORDER BY weight DESC, word) AS place
  FROM (SELECT DISTINCT template, word FROM places) JOIN weights USING (word)
), rarest AS (
  SELECT *, sum(weight) OVER (PARTITION BY template) AS whole FROM ranked WHERE place <= {scan.rare}
), votes AS (
  SELECT DISTINCT r, template, word, weight, whole, pos - spot - back AS start
  FROM spoken JOIN rarest USING (word) JOIN places USING (template, word), range(0, {scan.drift} + 1) t(back)
), agreed AS (
  SELECT r, template, start, sum(weight) AS weight, any_value(whole) AS whole FROM votes GROUP BY r, template, start
), best AS (
  SELECT r, template, max(weight) AS weight, any_value(whole) AS whole FROM agreed GROUP BY r, template
), sure AS (
  SELECT r, template, weight / whole AS share FROM best
  WHERE weight > 0 AND weight * 100 >= whole * {scan.percent} AND NOT EXISTS (
    SELECT 1 FROM keys JOIN texts t ON t.r = best.r
    WHERE keys.template = best.template AND NOT contains(' ' || array_to_string(t.words, ' ') || ' ', phrase))
), hits AS (
  SELECT r, i - 1 AS pos, label FROM spots, base WHERE words[i] = phrase[1] AND words[i:i + size - 1] = phrase
), based AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits GROUP BY r
), labelled AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT r, label FROM hits UNION SELECT r, label FROM sure JOIN names USING (template)) GROUP BY r
), scored AS (SELECT r, max(share) AS share FROM sure GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM texts LEFT JOIN based USING (r) LEFT JOIN labelled USING (r) LEFT JOIN scored USING (r)
"""


ORACLE_SQL = oracle()
