"""Small helpers for tasks that walk over texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from xxhash import xxh3_64_intdigest

#: A word is a run of [^\x20\x09-\x0D]; bytes.split() without arguments cuts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def lean(run: Callable) -> Callable:
    """A mapInArrow function after which its worker, which lives on, gives memory back to the system."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most `rows`: the session's default counts on short rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def portions(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of the column, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """Word -> 64-bit hash, filled on demand and emptied before it outgrows a task."""

    MOST = 100_000

    def __missing__(self, word: bytes) -> int:
        self[word] = got = xxh3_64_intdigest(word)
        return got

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.MOST:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finalizer)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words, from the words' hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = words[:count].copy()
    for j in range(1, n):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[j : j + count]
    return mixed(total)


def hashed(some: list[bytes], hashes: WordHashes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in one array, and where each text starts and the last ends."""
    words = [(t.lower() if lower else t).split() for t in some]
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=starts[1:])
    return hashes.of([x for w in words for x in w]), starts
