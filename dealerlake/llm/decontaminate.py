"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of every test item. A document is streamed through it word by
word while the length of the longest run ending here that occurs in some item is tracked. Wherever
that length reaches the window, the last words are a window of an item.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.common import byte_slices, record_batch, releasing, stored

# Fixed value: a word's characters, after A-Z became a-z; the same set in UTF-8.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())  # of bytes, lower() changes A-Z only


class SuffixAutomaton:
    """All runs of words of the items, and which items hold each window.

    An item of fewer words than ``window``, but not none, is one window as a whole.
    """

    def __init__(self, items: Iterable[tuple[str | None, Sequence[bytes]]], window: int):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(item, words) for item, words in items if words]
        for _, words in items:
            self._add(words)
        self.holders: dict[int, set[str]] = {}  # of the window that ends in this state
        own: dict[int, list[tuple[int, str | None]]] = {}  # short items that end in this state
        for item, words in items:
            state = 0
            for place, word in enumerate(words, 1):
                state = self.step[state][word]
                if place >= window:
                    state = self.cut(state, window)
                    self.holders.setdefault(state, set()).add(item)
            if len(words) < window:
                own.setdefault(self.cut(state, len(words)), []).append((len(words), item))
        # Short items ending wherever the state's own runs end: its own and those of its suffixes.
        self.shorts: list[tuple[tuple[int, str | None], ...]] = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            self.shorts[state] = (*own.get(state, ()), *self.shorts[self.link[state]])

    def cut(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of this state's runs."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _state(self, length: int, link: int, step: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, before: int, word: bytes) -> int:
        """The state for the runs of ``before`` followed by ``word``, parted from longer ones if need be."""
        to = self.step[before][word]
        if self.length[to] == self.length[before] + 1:
            return to
        twin = self._state(self.length[before] + 1, self.link[to], dict(self.step[to]))
        self.link[to] = twin
        while before >= 0 and self.step[before].get(word) == to:
            self.step[before][word] = twin
            before = self.link[before]
        return twin

    def _add(self, words: Sequence[bytes]) -> None:
        last = 0  # each item starts afresh, so no run reaches over two items
        for word in words:
            if word in self.step[last]:
                last = self._split(last, word)
                continue
            fresh, before = self._state(self.length[last] + 1, 0, {}), last
            while before >= 0 and word not in self.step[before]:
                self.step[before][word] = fresh
                before = self.link[before]
            if before >= 0:
                self.link[fresh] = self._split(before, word)
            last = fresh

    def stream(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Joined word ranges that lie inside occurrences of windows, and the items of those windows."""
        step, link, length, shorts, window = self.step, self.link, self.length, self.shorts, self.window
        ranges: list[tuple[int, int]] = []
        items: set[str | None] = set()
        state = size = 0
        for place, word in enumerate(words, 1):
            to = step[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = step[state].get(word)
            if to is None:
                size = 0
                continue
            state = to
            size += 1
            first = place
            if size >= window:
                items |= self.holders[self.cut(state, window)]
                first = place - window
            for short, item in shorts[state]:
                if short <= size:
                    items.add(item)
                    first = min(first, place - short)
            if first < place:
                while ranges and ranges[-1][1] >= first:
                    first = min(first, ranges.pop()[0])
                ranges.append((first, place))
        return ranges, items


@dataclass(frozen=True)
class Limits:
    """Spans of at least ``window`` item words are cut; a text covered beyond ``coverage`` goes as a whole."""

    window: int = 10
    coverage: float = 0.5
    #: Characters of test items per automaton. More items take several automata, one pass each.
    block_characters: int = 600_000


def _automata(benchmark: DataFrame, limits: Limits) -> Iterator[SuffixAutomaton]:
    """One automaton per block of distinct items: only one block at a time reaches the driver."""
    benchmark = benchmark.select("item_id", "text").distinct()  # repeats would land in one block
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // limits.block_characters))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        rows = benchmark.filter(block == number).select(F.col("item_id").cast("string"), "text").collect()
        yield SuffixAutomaton([(r[0], words_of((r[1] or "").encode())) for r in rows], limits.window)


def _joined(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


HITS = pa.schema([("hit_edges", pa.list_(pa.int32())), ("hit_items", pa.list_(pa.string()))])


def _with_hits(docs: DataFrame, benchmark: DataFrame, limits: Limits) -> DataFrame:
    """``docs`` plus hit_edges (starts and ends of hit word ranges, in turn) and hit_items."""
    names = docs.columns
    found = docs.withColumns({"hit_edges": F.array().cast("array<int>"), "hit_items": F.array().cast("array<string>")})
    schema = found.schema
    for number, automaton in enumerate(_automata(benchmark, limits)):
        if number:
            found = stored(found, "decontaminate")
        shared = docs.sparkSession.sparkContext.broadcast(automaton)  # of one block, so of bounded size

        def stream(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            machine = shared.value
            for batch in batches:
                for first, texts in byte_slices(batch.column("text")):
                    rows = batch.slice(first, len(texts))
                    edges, items = [], []
                    for text, old, before in zip(texts, rows.column("hit_edges").to_pylist(), rows.column("hit_items").to_pylist(), strict=True):
                        ranges, held = machine.stream(words_of(text))
                        ranges = _joined([*zip(old[::2], old[1::2], strict=True), *ranges])
                        edges.append([place for pair in ranges for place in pair])
                        items.append(sorted({*before, *(i for i in held if i is not None)}))
                    kept = [rows.column(n) for n in names]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(edges, HITS[0].type), pa.array(items, HITS[1].type)], names=[*names, *HITS.names])

        found = found.mapInArrow(releasing(stream), schema)
    return found


def report(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    A NULL or wordless text has no words and no hits; NULL or wordless items occur nowhere. An item
    without an id hits, but is not listed. Rows that repeat stay repeated, items listed twice count once.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
         ("items_sha256", pa.string()), ("contaminated", pa.bool_())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("hit_items").to_pylist()
            hits = [sum(e[1::2]) - sum(e[::2]) for e in batch.column("hit_edges").to_pylist()]
            counts = [len(words_of(t)) for _, texts in byte_slices(batch.column("text")) for t in texts]
            digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
            yield record_batch(schema, [batch.column("doc_id"), counts, hits, [len(i) for i in items], digests, [h > 0 for h in hits]])

    found = _with_hits(docs.select("doc_id", "text"), benchmark, limits)
    return found.mapInArrow(releasing(digest), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut_words(text: bytes, ranges: Sequence[tuple[int, int]]) -> bytes:
    """The text without the bytes from each range's first word to its last."""
    places = [m.span() for m in WORD.finditer(text.lower())]
    kept, at = [], 0
    for first, end in ranges:
        kept.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def remove_contamination(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows with hit spans cut out of their texts; rows covered beyond the limit are gone.

    Columns stay as they are; ``n_chars``, if there, follows the text. A NULL text stays NULL.
    """
    sizes_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    names = ["text" if name == "text" else f"c{place}" for place, name in enumerate(docs.columns)]  # none can clash
    size_name = None if sizes_at is None else names[sizes_at]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = batch.column("hit_edges").to_pylist()
            hit = [row for row, e in enumerate(edges) if e]
            columns = {n: batch.column(n) for n in names}
            keep = [True] * len(edges)
            if hit:
                texts = columns["text"].to_pylist()
                sizes = columns[size_name].to_pylist() if size_name else None
                for row in hit:
                    ranges = list(zip(edges[row][::2], edges[row][1::2], strict=True))
                    covered = sum(b - a for a, b in ranges)
                    whole = texts[row].encode()
                    keep[row] = covered <= limits.coverage * len(words_of(whole))
                    texts[row] = cut_words(whole, ranges).decode()
                    if sizes:
                        sizes[row] = len(texts[row])
                columns["text"] = pa.array(texts, columns["text"].type)
                if sizes:
                    columns[size_name] = pa.array(sizes, columns[size_name].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(pa.array(keep))

    renamed = docs.toDF(*names)
    return _with_hits(renamed, benchmark, limits).mapInArrow(releasing(cut), renamed.schema).toDF(*docs.columns)
