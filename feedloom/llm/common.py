"""Helpers that the corpus operators share: tables, text buffers and rolling hashes in Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.tables import read_table, spread

#: ASCII white space that separates words: blank and \x09 to \x0D.
BLANKS = r"[\x20\x09-\x0D]+"
BASE = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The wanted columns of a whole table."""
    return read_table(spark, f"{sf_dir}/{name}.parquet").select(*columns)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The wanted columns of the whole ``documents`` table, dealt to all cores if the scan has fewer tasks."""
    return spread(table(spark, sf_dir, "documents", *columns), "doc_id")


def remainder(key: str | Column, divisor: int) -> Column:
    """``crc32`` of the id written as text, modulo ``divisor``."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % divisor


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array and the row limits in it; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    limits = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    limits = limits.astype(np.int64)
    data = column.buffers()[2]
    if data is None or limits[-1] == limits[0]:
        return np.zeros(0, np.uint8), limits - limits[0]
    return np.frombuffer(data, np.uint8)[limits[0] : limits[-1]], limits - limits[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """``data`` with A-Z in lower case, all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def word_limits(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows; a word never crosses a row limit."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[limits] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Hashes of arbitrary spans of one byte array, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers = np.empty(n + 1, np.uint64)
        powers[0] = 1
        powers[1:] = BASE
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.sums[1:])
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        powers[0] = 1
        powers[1:] = inverse
        np.cumprod(powers, out=powers)
        self.inverses = powers

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverses[starts]

    def prefixes(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``raw`` from the start of its span to every byte, for spans that follow one another without a gap."""
        out = self.sums[:-1] - np.repeat(self.sums[starts], sizes)
        out *= np.repeat(self.inverses[starts], sizes)
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.raw(starts, ends) + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of the window of ``width`` bytes that begins at each byte."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[width:] - self.sums[:n]) * self.inverses[:n])


def row_of(limits: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Row number of each position, where ``limits`` are the row limits; empty rows hold no position."""
    return np.searchsorted(limits, positions, side="right") - 1


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


T = TypeVar("T")


def once_per_worker(key: object, make: Callable[[], T]) -> T:
    """What ``make`` builds, kept for the later tasks of the same Python worker.

    Functions of this library travel to the executors by value, each task with globals of its own; only the
    interpreter itself outlives them. It keeps one thing: another key takes its place.
    """
    held = getattr(sys, "_feedloom_held", None)
    if held is None or held[0] != key:
        held = sys._feedloom_held = (key, make())  # type: ignore[attr-defined]
    return held[1]


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` that gives freed memory back to the system when its task ends.

    A Python worker stays for later stages; without this it would keep the largest batch's worth of memory
    while others run beside it.
    """

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library has no such call
                pass

    return run
