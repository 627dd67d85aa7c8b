"""What several of the operators share: reading tables, stored steps, batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import itertools
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.session import scratch_dir

Key = TypeVar("Key")
SLICE_BYTES = 1 << 19  # numpy works on some 50 times as much at once
BATCH_ROWS = "1000"  # texts handed to Python at once; Spark's own 10,000 rows of long texts weigh on an executor twice
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Sets the session's Arrow batch to ``BATCH_ROWS`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back.

    Cuts the lineage, so that a lost executor repeats one step only, and lets several
    later reads share one computation. What was shuffled for it goes when it is written, not when the
    driver happens to collect its garbage.
    """
    path, conf = scratch_dir(frame.sparkSession, label), frame.sparkSession.conf
    before = conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        frame.write.parquet(path)
    finally:
        conf.unset(SHUFFLES_GO) if before is None else conf.set(SHUFFLES_GO, before)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % divisor


def whole_within(sizes: Iterable[tuple[Key, int]], limit: int) -> list[Key]:
    """Keys, in the order given, of what is taken whole while all taken stays within ``limit``.

    What does not fit any more is passed over, smaller things after it are still taken.
    """
    taken, room = [], limit
    for key, size in sizes:
        if size <= room:
            taken.append(key)
            room -= size
    return taken


def byte_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of consecutive rows holding about ``limit`` bytes; NULL counts as empty.

    A row longer than the limit makes a slice of its own.
    """
    first, size, held = 0, 0, []
    for row, text in enumerate(texts.cast(pa.large_binary())):
        value = text.as_py() or b""
        if held and size + len(value) > limit:
            yield first, held
            first, size, held = row, 0, []
        held.append(value)
        size += len(value)
    if held:
        yield first, held


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function for mapInArrow, which hands freed memory back to the system when its task ends.

    Python workers wait for the next task, and what their allocators keep for themselves counts against
    the executor while later stages need it.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return wrapped


class Ranges:
    """Ranges of a text, end exclusive, asked for by others without meeting each of them."""

    def __init__(self, ranges: Sequence[tuple[int, int]]):
        ordered = sorted(ranges)
        self._starts = [a for a, _ in ordered]
        self._furthest = list(itertools.accumulate((b for _, b in ordered), max))
        self._joined: list[tuple[int, int]] = []
        for a, b in ordered:
            if self._joined and self._joined[-1][1] >= a:
                self._joined[-1] = (self._joined[-1][0], max(self._joined[-1][1], b))
            else:
                self._joined.append((a, b))

    def touch(self, a: int, b: int) -> bool:
        """Whether one of them shares a character with this range."""
        k = bisect_left(self._starts, b)
        return k > 0 and self._furthest[k - 1] > a

    def hold(self, a: int, b: int) -> bool:
        """Whether one of them holds all of this range."""
        k = bisect_right(self._starts, a)
        return k > 0 and self._furthest[k - 1] >= b

    def outside(self, a: int, b: int) -> list[tuple[int, int]]:
        """The parts of this range outside all of them."""
        parts, at = [], a
        k = bisect_right(self._joined, a, key=lambda r: r[1])
        while k < len(self._joined) and self._joined[k][0] < b:
            parts.append((at, self._joined[k][0]))
            at = self._joined[k][1]
            k += 1
        return [(x, y) for x, y in [*parts, (at, b)] if x < y]


def record_batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind.type) for c, kind in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)
