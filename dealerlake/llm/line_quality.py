"""Document quality from a conditional random field over lines.

Every line gets a chance of being good, given the features of itself and of its
neighbours; a document's score is the mean chance weighted by line length. Training
rows carry one label per document, which all their lines take on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.chain_crf import ChainCRF, Layout, marginals
from dealerlake.llm.common import byte_slices, record_batch, releasing, remainder, whole_within

BINS = 8
NEWLINE = 10


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and the optimiser's work."""

    documents: int = 4000
    characters: int = 12_000_000  # of whole texts together; one that does not fit is passed over
    steps: int = 100
    rate: float = 0.1
    decay: float = 0.002


def _kinds() -> np.ndarray:
    """The kind of each byte: lower, upper, digit, blank, sentence mark, other mark, beyond ASCII."""
    kind = np.full(256, 5)
    kind[ord("a") : ord("z") + 1] = 0
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[[9, 11, 12, 13, 32]] = 3
    kind[[ord(c) for c in ".,;:'\"-()"]] = 4
    kind[128:] = 6
    return kind


KIND = _kinds()
KINDS = 7
#: A random number for each byte; a word's sum of them tells whether it repeats the word before it.
MARK = np.random.default_rng(3).integers(0, 2**63, 256).astype(np.uint64)


def line_features(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features [line, feature] of all lines of all texts, line lengths in bytes, lines of each text.

    An empty text is one empty line.
    """
    joined = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    ends = np.flatnonzero(joined == NEWLINE)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    lengths = ends - starts
    kind = KIND[joined]
    kind[ends] = 3

    def count(where: np.ndarray) -> np.ndarray:
        summed = np.concatenate([[0], np.cumsum(where, dtype=np.int64)])
        return summed[ends] - summed[starts]

    whole = np.maximum(lengths, 1)
    shares = [count(kind == k) / whole for k in range(KINDS)]
    blank = kind == 3
    before = np.concatenate([[True], blank[:-1]])
    words = count(~blank & before)
    letter = (kind < 2) | (kind == 6)
    other = kind == 5
    glued = count(other & np.concatenate([[False], (letter | other)[:-1]]))
    alone = count(other & before & np.concatenate([blank[1:], [True]]))
    doubled = count((joined == np.concatenate([[0], joined[:-1]])) & ~blank)
    opening = np.flatnonzero(~blank & before)
    closing = np.flatnonzero(blank & ~before)
    summed = np.concatenate([[np.uint64(0)], np.cumsum(MARK[joined])])
    marks = summed[closing] - summed[opening]
    again = np.zeros(len(joined), bool)
    again[opening[1:]] = marks[1:] == marks[:-1]
    each = np.maximum(words, 1)
    features = np.column_stack(
        [*shares, np.log1p(lengths), lengths / each, glued / each, alone / each, doubled / whole, count(again) / each]
    )
    owner = np.cumsum([0, *[len(t) + 1 for t in texts]])
    lines = np.diff(np.searchsorted(ends, owner, side="left"))
    return features, lengths, lines


@dataclass(frozen=True)
class QualityModel:
    edges: np.ndarray  # [feature, BINS - 1]
    crf: ChainCRF

    def bins(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Bin numbers of each line and of the lines before and after it in its text; one more bin means "no line"."""
        own = np.column_stack([np.searchsorted(e, f, side="right") for e, f in zip(self.edges, features.T, strict=True)])
        first = np.zeros(len(own), bool)
        first[np.cumsum(lines) - lines] = True
        last = np.roll(first, -1)
        before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
        before[first], after[last] = BINS, BINS
        width = (BINS + 1) * np.arange(own.shape[1])
        block = (BINS + 1) * own.shape[1]
        return np.column_stack([own + width, before + width + block, after + width + 2 * block])

    def scores(self, texts: Sequence[bytes]) -> np.ndarray:
        """Mean chance of a good line, weighted by line length with its end, of each whole text."""
        if not texts:
            return np.zeros(0)
        features, lengths, lines = line_features(texts)
        chance, _, _ = marginals(self.crf.unary(self.bins(features, lines)), self.crf.moves, Layout.of(lines))
        at = np.cumsum(lines) - lines
        weight = lengths + 1.0
        return np.clip(np.add.reduceat(chance[:, 1] * weight, at) / np.add.reduceat(weight, at), 0, 1)


def fit(texts: Sequence[bytes], quality: Sequence[int], training: Training = Training()) -> QualityModel:
    parts = [line_features(part) for _, part in byte_slices(pa.array(texts, pa.large_binary()))]
    features, lines = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
    levels = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.array([np.quantile(np.unique(column), levels) for column in features.T])
    model = QualityModel(edges, ChainCRF(3 * (BINS + 1) * features.shape[1], 2))
    target = np.repeat(np.asarray(quality, np.int64), lines)
    model.crf.fit(model.bins(features, lines), target, lines, training.steps, training.rate, training.decay)
    return model


def sample(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> list[tuple[int, str, int]]:
    """(doc_id, text, quality) of at most ``documents`` labelled rows outside the held-out third, picked by a hash of the id.

    Rows without a text, an id or a label of 0 or 1 are not learned from. Of an id labelled more than
    once the smallest label counts, of repeated rows the longest text. Texts are taken whole, in the order of
    the hashes, as long as they fit ``characters``; no more reach the driver.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (remainder("doc_id", 3) != 1))
    picked = (
        usable.select("doc_id", "quality")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(training.documents)
    )
    texts = docs.select("doc_id", "text", F.length("text").alias("size")).filter(F.col("text").isNotNull())
    sized = (
        texts.join(F.broadcast(picked), "doc_id")  # ``documents`` rows of two numbers at most
        .groupBy("doc_id").agg(F.max("size").alias("size"), F.first("quality").alias("quality"))
        .select(F.struct("doc_id", "size", "quality").alias("key"), "size").orderBy(F.xxhash64("key.doc_id"), "key.doc_id")
        .collect()
    )
    taken = whole_within([(tuple(r.key), r.size) for r in sized], training.characters)
    if not taken:
        return []
    chosen = F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long, size int, quality int"))
    found = texts.join(chosen, ["doc_id", "size"]).groupBy("doc_id", "quality").agg(F.max("text").alias("text"))
    return sorted((r.doc_id, r.text, r.quality) for r in found.collect())


def train(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> QualityModel | None:
    """Fit on the whole texts of ``sample``; None without any."""
    rows = sample(docs, labels, training)
    if not rows:
        return None
    return fit([text.encode() for _, text, _ in rows], [quality for _, _, quality in rows], training)


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its text alone.

    A NULL text counts as empty, and an empty one as a single empty line. Without any labelled row
    every score is 0.5. Repeated rows stay repeated; a NULL doc_id is not held out. Further columns are not read.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_slices(batch.column("text")):
                values = model.scores(texts) if model else np.full(len(texts), 0.5)
                rows = batch.slice(first, len(texts))
                yield record_batch(OUT, [rows.column("doc_id"), rows.column("held_out"), values, (values >= 0.5).astype(np.int32)])

    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(releasing(predict), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """The rows whose text scores 0.5 or more, all columns as they were.

    A NULL text counts as empty, an empty one as a single empty line; without a model every row stays.
    """
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_slices(batch.column("text")):
                values = model.scores(texts) if model else np.full(len(texts), 0.5)
                yield batch.slice(first, len(texts)).filter(pa.array(values >= 0.5))

    return docs.mapInArrow(releasing(keep), schema)


def score_quality(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    return score(docs, train(docs, labels, training))
