"""Words, scans and stages shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # a word: anything between ASCII blanks
SLICE_BYTES = 4 << 20  # text that one numpy step works on; longer texts form a slice of their own

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; equal rows agree."""
    return F.xxhash64(*[df[f"`{c}`"] for c in df.columns])


@dataclass
class Words:
    """Words of a run of texts that lie one behind the other in `data`."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # number of the first word of each text, and the number of words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a text column; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or not column.buffers()[2]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """A text column in runs of bounded text, so that memory does not follow the batch size."""
    size = np.cumsum([0, *(n or 0 for n in pa.compute.binary_length(column).to_pylist())])
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(size, size[at] + limit, side="right")) - 1)
        yield column.slice(at, to - at)
        at = to


def words_of(column: pa.Array, separator: np.ndarray = SEPARATOR) -> Words:
    """Words of a text column, A-Z lower-cased."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    inside = ~separator[data]
    cut = np.zeros(len(data) + 1, bool)  # a text begins here
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends[:-1] &= ~inside[1:] | cut[1:-1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of bounded text, so that memory does not follow the batch size."""
    for batch in batches:
        at = 0
        for piece in pieces(batch.column(text), limit):
            yield batch.slice(at, len(piece))
            at += len(piece)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher that spreads every input bit over 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of each word, from prefix sums over the bytes."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    n = len(w.data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n, "up"), out=total[1:])
    own = (total[w.end] - total[w.start]) * _power(_INVERSE, n, "down")[w.start]
    if n > 2 * SLICE_BYTES:  # a very long text: do not keep its powers
        _powers.clear()
    return mix(own + (w.end - w.start).astype(np.uint64))


def shingle_hashes(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, and the number of each run's first word.

    A text of fewer words, but not none, is one run of all its words.
    """
    counts = w.counts
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.repeat(w.first[:-1] - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
    length = np.minimum(k, np.repeat(counts, runs))
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        there = length > i
        step = mix(h[np.where(there, at + i, 0)] + np.uint64(i + 1)) if len(at) else out
        out = np.where(there, out * np.uint64(0xD6E8FEB86659FD93) + step, out)
    return mix(out), at


def code_points(data: np.ndarray, at: np.ndarray, begin: int) -> np.ndarray:
    """Byte positions as code points from `begin` on."""
    total = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return total[at] - total[begin]
