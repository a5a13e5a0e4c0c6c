"""Texts of an Arrow batch as bytes and words in numpy, a chunk of documents at a time.

The operators that leave the JVM work on whole chunks, never on single tokens: a chunk is the
concatenated UTF-8 of consecutive rows and the offsets of each, and a word is a start, an end and a
64-bit hash of its bytes.  Words are runs of bytes of a table, so upper case, separators and the word
alphabet are choices of the operator.  Null texts are empty.  No word crosses a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20
BATCH = "8m"  # of an Arrow batch: whole texts pass through several buffers on both sides, in every running task
BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = pow(int(BASE), -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def table(*spans: tuple[int, int], inverse: bool = False) -> np.ndarray:
    """Which of the 256 bytes lie in the spans (both ends included)."""
    inside = np.zeros(256, bool)
    for low, high in spans:
        inside[low:high + 1] = True
    return ~inside if inverse else inside


NOT_SPACE = table((0x20, 0x20), (0x09, 0x0D), inverse=True)
WORD = table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))  # after lower-casing: digits, letters, all above ASCII


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after telling its session to send rows to Python a few megabytes at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return df


class Chunk(NamedTuple):
    rows: slice
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Consecutive rows of a text column, about ``size`` bytes at a time and one row at least."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, ends, values = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield Chunk(slice(first, last), data[ends[first]:ends[last]], ends[first:last + 1] - ends[first])
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * _LAST
    x = (x ^ (x >> np.uint64(32))) * _LAST
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=2)
def _powers(bits: int, base: int) -> np.ndarray:
    powers = np.ones(1 << bits, np.uint64)
    for b in range(bits):
        powers[1 << b:2 << b] = powers[:1 << b] * np.uint64(pow(base, 1 << b, 1 << 64))
    return powers


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first powers of the hash base, or of its inverse, modulo 2^64."""
    return _powers(max(20, int(n).bit_length()), _BASE_INVERSE if inverse else int(BASE))


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each document, its first word's number; one more at the end
    total: np.ndarray  # running sum that the hashes are differences of

    def prefix(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word, apart from those of words; of longer words only, else 0."""
        end = np.minimum(self.start + size, self.end)
        hashes = mixed((self.total[end] - self.total[self.start]) * powers(len(self.total), True)[self.start] + np.uint64(size))
        return np.where(self.end - self.start > size, hashes, np.uint64(0))

    def document(self) -> np.ndarray:
        """The document of each word, by number in the chunk."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(chunk: Chunk, inside: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """The maximal runs of bytes that, folded, lie in ``inside``."""
    data, offsets = fold[chunk.data], chunk.offsets
    is_in = np.zeros(len(data) + 1, bool)
    is_in[:-1] = inside[data]
    begins = is_in.copy()
    begins[1:] &= ~is_in[:-1]
    begins[offsets] = is_in[offsets]  # a document's first byte follows nothing
    stops = is_in[:-1].copy()
    stops &= ~is_in[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    stops[last] = is_in[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[:len(data)], out=total[1:])
    hashes = mixed((total[end] - total[start]) * powers(len(data), True)[start])
    return Words(start, end, hashes, np.searchsorted(start, offsets), total)


def binary(column: np.ndarray) -> bytes:
    return np.ascontiguousarray(column).tobytes()


def word_hash(word: str) -> int:
    """The hash that ``words`` gives a word."""
    data = np.frombuffer(word.encode(), np.uint8).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        return int(mixed((data * powers(len(data))[:len(data)]).sum(dtype=np.uint64).reshape(1))[0])
