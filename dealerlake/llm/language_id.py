"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions and gives every byte a
distribution over languages; a document's distribution is the mean over its letter
bytes. It is trained in numpy by backpropagation through time on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.llm.common import byte_slices, record_batch, remainder, whole_within

UNDETERMINED = "und"
WINDOW = 96  # bytes read at a time; the state starts afresh in each window
PAD = 256  # stands for "no byte": it leaves the state as it is
#: Which bytes can belong to a letter: A-Z, a-z and all bytes of characters beyond ASCII.
LETTER_BYTE = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)] + [False])


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the optimiser's work."""

    documents_per_language: int = 500
    characters_per_language: int = 1_500_000  # of whole texts; one that does not fit is passed over
    hidden: int = 8
    steps: int = 260
    batch: int = 96
    rate: float = 0.02
    seed: int = 7


class ByteGRU:
    """One gated recurrent layer per direction, and a softmax over both states at every position.

    Arrays hold units in rows and windows in columns, so that each gate is one block of memory.
    Input weights are a table by byte, since the input is one byte.
    """

    def __init__(self, languages: Sequence[str], hidden: int, seed: int):
        draw = np.random.default_rng(seed)
        self.languages, self.hidden = list(languages), hidden
        self.weights: dict[str, np.ndarray] = {}
        for way in ("ahead", "back"):
            self.weights[f"{way}_in"] = draw.normal(0, 0.3, (257, 3 * hidden))
            self.weights[f"{way}_state"] = draw.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden))
        self.weights["out"] = draw.normal(0, 0.3, (len(languages), 2 * hidden))
        self.weights["out_bias"] = np.zeros((len(languages), 1))

    def compact(self) -> ByteGRU:
        """The same network in single precision, for prediction.

        The first 2H rows are negated, as prediction needs the sigmoid of their sum as 1 / (1 + exp(-x)).
        """
        other = ByteGRU(self.languages, self.hidden, 0)
        other.weights = {k: np.ascontiguousarray(v, np.float32) for k, v in self.weights.items()}
        for way in ("ahead", "back"):
            other.weights[f"{way}_in"][:, : 2 * self.hidden] *= -1
            other.weights[f"{way}_in"][PAD] = 0
            other.weights[f"{way}_in"][PAD, : self.hidden] = 80  # update gate shut
            other.weights[f"{way}_in"] = np.ascontiguousarray(other.weights[f"{way}_in"].T)
            other.weights[f"{way}_state"][: 2 * self.hidden] *= -1
        return other

    # --- training, in double precision -------------------------------------------------

    def _run(self, way: str, steps: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each step, [step, unit, window], and what the backward pass needs."""
        h, inputs, state = self.hidden, self.weights[f"{way}_in"], self.weights[f"{way}_state"]
        now, states, kept = np.zeros((h, steps.shape[1])), [], []
        for codes in steps:
            fed, moved = inputs[codes].T, state @ now
            gates = 1 / (1 + np.exp(-np.clip(fed[: 2 * h] + moved[: 2 * h], -60, 60)))
            update, reset = gates[:h] * (codes != PAD), gates[h:]
            fresh = np.tanh(fed[2 * h :] + reset * moved[2 * h :])
            kept.append((codes, now, moved[2 * h :], update, reset, fresh))
            now = now + update * (fresh - now)
            states.append(now)
        return np.array(states), kept

    def _unrun(self, way: str, kept: list, wanted: np.ndarray, slopes: dict[str, np.ndarray]) -> None:
        """Backpropagation through time: ``wanted`` is the loss slope of each state."""
        h, state = self.hidden, self.weights[f"{way}_state"]
        into = slopes[f"{way}_in"] = np.zeros_like(self.weights[f"{way}_in"])
        onto = slopes[f"{way}_state"] = np.zeros_like(state)
        later = np.zeros(wanted.shape[1:])
        for (codes, before, moved, update, reset, fresh), here in zip(reversed(kept), wanted[::-1], strict=True):
            slope = here + later
            d_fresh = slope * update * (1 - fresh**2)
            d_update = slope * (fresh - before) * update * (1 - update)
            d_reset = d_fresh * moved * reset * (1 - reset)
            d_fed = np.concatenate([d_update, d_reset, d_fresh])
            d_moved = np.concatenate([d_update, d_reset, d_fresh * reset])
            np.add.at(into, codes, d_fed.T)
            onto += d_moved @ before.T
            later = slope * (1 - update) + state.T @ d_moved

    def loss(self, codes: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all labelled positions, and its slopes.

        ``codes`` is [step, window]; ``target`` the language number of each window, which
        every position of it is trained to give.
        """
        ahead, kept_ahead = self._run("ahead", codes)
        back, kept_back = self._run("back", codes[::-1])
        both = np.concatenate([ahead, back[::-1]], axis=1)
        logits = self.weights["out"] @ both + self.weights["out_bias"]
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        real = (codes != PAD)[:, None, :]
        count = max(1, real.sum())
        wanted = np.eye(len(self.languages))[:, target][None]
        loss = -(np.log(np.maximum(chance, 1e-300)) * wanted * real).sum() / count
        d_logits = (chance - wanted) * real / count
        slopes = {
            "out": np.einsum("tkb,thb->kh", d_logits, both),
            "out_bias": d_logits.sum(axis=(0, 2))[:, None],
        }
        d_both = self.weights["out"].T @ d_logits
        self._unrun("ahead", kept_ahead, d_both[:, : self.hidden], slopes)
        self._unrun("back", kept_back, d_both[::-1, self.hidden :], slopes)
        return loss, slopes

    def fit(self, codes: np.ndarray, owner: np.ndarray, target: np.ndarray, training: Training) -> ByteGRU:
        """Adam on random batches of windows, with the rate falling to zero.

        A batch draws documents, each as likely as another, and a window anywhere in each of them.
        ``owner`` is the document of each window, rising; ``target`` the language number of each window.
        """
        draw = np.random.default_rng(training.seed)
        _, first, each = np.unique(owner, return_index=True, return_counts=True)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, training.steps + 1):
            drawn = draw.integers(0, len(first), min(training.batch, codes.shape[1]))
            rows = first[drawn] + draw.integers(0, each[drawn])
            _, slopes = self.loss(codes[:, rows], target[rows])
            rate = training.rate * (1 - (step - 1) / training.steps)
            for k, slope in slopes.items():
                slope = np.clip(slope, -1, 1)
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.01 * (slope**2 - square[k])
                self.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self

    # --- prediction, on a compact() network ---------------------------------------------

    def _states(self, way: str, steps: np.ndarray) -> np.ndarray:
        h, inputs, state = self.hidden, self.weights[f"{way}_in"], self.weights[f"{way}_state"]
        out = np.empty((len(steps), h, steps.shape[1]), np.float32)
        now = np.zeros((h, steps.shape[1]), np.float32)
        fed = np.empty((3 * h, steps.shape[1]), np.float32)
        moved = np.empty_like(fed)
        for t, codes in enumerate(steps):
            np.take(inputs, codes, axis=1, out=fed, mode="clip")
            np.matmul(state, now, out=moved)
            gates = fed[: 2 * h]
            gates += moved[: 2 * h]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            fresh = moved[2 * h :]
            fresh *= gates[h:]
            fresh += fed[2 * h :]
            np.tanh(fresh, out=fresh)
            fresh -= now
            fresh *= gates[:h]
            now = np.add(now, fresh, out=out[t])
        return out

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Language distribution at every position, [step, language, window]."""
        h, out = self.hidden, self.weights["out"]
        logits = out[:, :h] @ self._states("ahead", codes)
        logits += out[:, h:] @ self._states("back", codes[::-1])[::-1]
        logits += self.weights["out_bias"]
        np.clip(logits, -60, 60, out=logits)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def documents(self, texts: Sequence[bytes], at_once: int = 1024) -> np.ndarray:
        """Mean distribution over the letter bytes of each whole text, [text, language]; zeros if it has none."""
        total = np.zeros((len(texts), len(self.languages)))
        codes, owner = windows(texts)
        letters = np.zeros(len(texts))
        for first in range(0, len(owner), at_once):
            part, whose = codes[:, first : first + at_once], owner[first : first + at_once]
            counts = LETTER_BYTE[part]
            pooled = (self.positions(part) * counts[:, None, :]).sum(axis=0)
            np.add.at(total, whose, pooled.T)
            np.add.at(letters, whose, counts.sum(axis=0))
        return total / np.maximum(letters, 1)[:, None]


def windows(texts: Sequence[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts as [position, window], padded at the end of each text; and each window's text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    each = -(-lengths // size)
    owner = np.repeat(np.arange(len(texts)), each)
    flat = np.full((int(each.sum()), size), PAD, np.int16)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    shift = np.concatenate([[0], np.cumsum(each * size - lengths)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    flat.reshape(-1)[np.arange(len(joined)) + np.repeat(shift, lengths)] = joined
    return np.ascontiguousarray(flat.T), owner


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter in Unicode's sense."""
    if text.isascii():
        return text.lower() != text.upper()
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


HASH_RANGES = 64  # a language's texts are ranked in that many tasks before they are ranked together


def sample(docs: DataFrame, usable: Column, training: Training = Training()) -> list[tuple[str, int, str]]:
    """(lang, hash, text) of at most ``documents_per_language`` distinct whole texts of each language.

    Texts are picked by their hash, so the same rows give the same sample wherever they lie, and copies
    count once. Only hashes and lengths are ranked, in ranges first, so a language holding most rows
    is no burden; then the texts picked, ``characters_per_language`` at most, reach the driver.
    """
    source = docs.filter(usable & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text", F.xxhash64("text").alias("order"))
    sized = source.groupBy("lang", "order").agg(F.max(F.length("text")).alias("size")).withColumn("range", F.pmod("order", F.lit(HASH_RANGES)))
    for ranked in (Window.partitionBy("lang", "range"), Window.partitionBy("lang")):
        place = F.row_number().over(ranked.orderBy("order"))
        sized = sized.withColumn("place", place).filter(F.col("place") <= training.documents_per_language)
    found: dict[str, list[tuple[int, int]]] = {}
    for lang, order, size in sorted(map(tuple, sized.select("lang", "order", "size").collect())):
        found.setdefault(lang, []).append((order, size))
    picked = [(lang, order) for lang, sizes in found.items() for order in whole_within(sizes, training.characters_per_language)]
    if not picked:
        return []
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked, "lang string, order long"))  # ``documents_per_language`` rows of each
    texts = source.join(chosen, ["lang", "order"]).groupBy("lang", "order").agg(F.min("text").alias("text"))
    return sorted(map(tuple, texts.collect()))


def train(docs: DataFrame, usable: Column, training: Training = Training()) -> ByteGRU | None:
    """Fit on all windows of the whole texts of ``sample``; None without any."""
    rows = sample(docs, usable, training)
    if not rows:
        return None
    languages = sorted({lang for lang, _, _ in rows})
    codes, owner = windows([text.encode() for _, _, text in rows])
    target = np.array([languages.index(lang) for lang, _, _ in rows])[owner]
    network = ByteGRU(languages, training.hidden, training.seed)
    return network.fit(codes, owner, target, training).compact()


PREDICTION = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


def label(texts: Sequence[bytes], network: ByteGRU | None) -> tuple[list[str], list[float]]:
    """Language and probability of each text."""
    if network is None:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    chances = network.documents(texts)
    best = chances.argmax(axis=1)
    known = [has_letter(t) for t in texts]
    names = [network.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known, strict=True)]
    scores = [min(1.0, float(row[b])) if ok else 0.0 for row, b, ok in zip(chances, best, known, strict=True)]
    return names, scores


def identify(docs: DataFrame, network: ByteGRU | None, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    A NULL text, an empty one and one without a letter are ``und`` with score 0, as is every text
    when no labelled row exists. Rows that repeat stay repeated; a NULL doc_id stays NULL and is
    not held out. Further columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *PREDICTION])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_slices(batch.column("text")):
                names, scores = label(texts, network)
                rows = batch.slice(first, len(texts))
                yield record_batch(schema, [rows.column("doc_id"), rows.column("held_out"), names, scores])

    read = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return read.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def detect_languages(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """Train on the rows outside the held-out quarter, then label every whole text."""
    held_out = remainder("doc_id", 4) == 2
    return identify(docs, train(docs, ~held_out, training), held_out)
