"""Text columns as byte arrays: slices of Arrow batches, words, hashes and n-gram windows, all in numpy.

Texts stay in the buffers in which Arrow delivers them. A slice holds whole texts, about ``limit`` bytes of them (one
longer text is a slice of its own), so that the work arrays stay in the cache and memory does not grow with the batch.
Hashes have 64 bits: two different strings are taken for the same with a probability of about 2**-54.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 20
#: Texts in a slice at most: tables of a row for each text stay small where texts are tiny.
ROWS = 4096
#: The same for tables of thousands of columns.
DENSE_ROWS = 512
_BASE = 0x9E3779B97F4A7C15


#: Bytes of an Arrow batch. With Spark's own limit a task holds several times 64 MB on either side of the socket.
ARROW_BYTES = 8 << 20


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to hand texts to Python in small batches, however long they are and however many rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


#: One value for each byte; capital ASCII letters have that of the small letter.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
#: ASCII letters and digits and every byte of a longer character.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * SLICE)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span; the same values give the same hash wherever they stand."""
    up, down = POWERS.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


_LIBC = ctypes.CDLL(None)


def give_back() -> None:
    """Returns freed memory to the system: a worker that waits for its next task then holds little."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE, most: int = ROWS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of each slice of a string column, of at most ``most`` texts; a null is an empty text."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, min(first + most, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    give_back()


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of true values; runs end where a text ends."""
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    begins = np.zeros(len(inside) + 1, bool)
    begins[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:-1]
    ends[:-1] &= ~inside[1:] | begins[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end of each word (``WORD_BYTES``; capital ASCII letters as small ones)."""
    starts, ends, owner = spans(WORD_BYTES[data], offsets)
    return span_hashes(FOLDED_VALUES[data], starts, ends), owner, starts, ends


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within one text, and the place of its first word."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * np.uint64(_BASE) + hashes[i : i + n]
    first = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix(total[first]), first


def kept_columns(df: DataFrame, keep: list[str] | None) -> list[Column]:
    """The columns that an operator hands on, under names that clash with none of its own."""
    return [F.col(c).alias(f"_kept{i}") for i, c in enumerate(keep or [])]


def kept_types(df: DataFrame) -> str:
    return "".join(f", {f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name.startswith("_kept"))


def with_kept(made: DataFrame, keep: list[str] | None) -> DataFrame:
    """The handed-on columns under their own names again; where one has the name of a result it gets ``kept_`` before it."""
    own = [c for c in made.columns if not c.startswith("_kept")]
    return made.select(*own, *(F.col(f"_kept{i}").alias(f"kept_{c}" if c in own else c) for i, c in enumerate(keep or [])))
