"""Words of a whole text column as arrays: positions and 64-bit hashes, a batch at a time.

A separator of both word rules is an ASCII byte, and no byte of a longer UTF-8
sequence is ASCII. So splitting bytes gives exactly the words that splitting
code points gives.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Texts are taken together up to this size; a longer text is taken alone.
SLICE_BYTES = 1 << 17

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32

#: Bytes of words under [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
_WORD_WEIGHTS = np.random.default_rng(20240502).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if len(_powers[0]) < size:
        for at, base in enumerate((_STEP, pow(_STEP, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all of its bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's bounds in them; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, bounds, data = column.buffers()
    if not len(column) or bounds is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most so many bytes, at least one row each."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word; no word crosses a row."""
    inside = is_word[data]
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(inside) + 1, bool)
    after[:-1] = inside
    after[bounds] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z folded, taken in stretches of bounded size."""
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE_BYTES, "right")))
        base, stop = starts[first], ends[last - 1]
        powers, inverses = _power_tables(int(stop - base) + 1)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[FOLD[data[base:stop]]] * powers[: stop - base], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        hashes[first:last] = (sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64) * _GOLDEN
        first = last
    return mixed(hashes)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter, not empty sequence is one run."""
    width = min(size, len(words))
    if not width:
        return np.empty(0, np.uint64)
    total = np.full(len(words) - width + 1, width, np.uint64) * _GOLDEN
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * _WORD_WEIGHTS[k % len(_WORD_WEIGHTS)]
    return mixed(total)


def row_words(column: pa.Array, is_word: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every row of a string column, in order."""
    data, bounds = column_bytes(column)
    for first, last in slices(bounds):
        part = data[bounds[first] : bounds[last]]
        limits = bounds[first : last + 1] - bounds[first]
        starts, ends = word_bounds(part, limits, is_word)
        hashes = word_hashes(part, starts, ends)
        cuts = np.searchsorted(starts, limits)
        for row in range(last - first):
            yield first + row, hashes[cuts[row] : cuts[row + 1]]


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def release_memory(collect: bool = True) -> None:
    """Give freed memory back: the worker lives on beside its executor.

    At the end of a task also what the tasks before it held, which only the collector finds, since their functions
    refer to one another; between batches of a task without that.
    """
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """At most so many rows in an Arrow batch of this session from now on, which bounds what a task holds of long texts.

    The setting counts when a job runs, not when a frame is described, so it stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
