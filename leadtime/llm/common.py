"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of text that a task looks at together; a longer text is looked at alone.
SLICE_BYTES = 1 << 20


#: Rows of an Arrow batch: texts are long, and a batch lies in the memory of both the JVM and the Python worker.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod3(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as an empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 3


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, where, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text: the rows, their bytes and offsets."""
    data, offsets = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at), data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def byte_table(chars: bytes) -> np.ndarray:
    """256 flags: is the byte one of these?"""
    flags = np.zeros(256, bool)
    flags[np.frombuffer(chars, np.uint8)] = True
    return flags


IS_SPACE = byte_table(SPACES.encode())


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, which never cross rows, and the row of each."""
    n = len(is_word)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True  # an empty row marks where the next one starts
    head = is_word.copy()
    head[1:] &= ~is_word[:-1] | first[1:n]
    starts = np.flatnonzero(head)
    tail = is_word.copy()
    tail[:-1] &= ~is_word[1:] | first[1:n]
    ends = np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Fingerprints:
    """Polynomial prefix sums modulo 2**64 over a sequence: any substring's fingerprint in constant time.

    Items pass through ``mix64`` before they are weighted, and the sum is mixed with the length afterwards.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, items: np.ndarray, seed: int = 1) -> None:
        n = len(items)
        up, self._down = self._power(seed, n + 1)
        salt = np.uint64((seed * 0x2545F4914F6CDD1D + 0x1234567) & (2**64 - 1))
        if items.dtype == np.uint8:
            spread = mix64(np.arange(256, dtype=np.uint64) ^ salt)[items]
        else:
            spread = mix64(items.astype(np.uint64) ^ salt)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(spread * up[:n], out=self._sums[1:])

    @classmethod
    def _power(cls, seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(seed)
        if have is None or len(have[0]) < n:
            size = -(-n // (1 << 16)) << 16
            base = int(mix64(np.array([seed], np.uint64))[0]) | 5
            inverse = pow(base, -1, 2**64)
            up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
            with np.errstate(over="ignore"):
                np.cumprod(np.full(size - 1, base, np.uint64), out=up[1:])
                np.cumprod(np.full(size - 1, inverse, np.uint64), out=down[1:])
            if size <= 1 << 21:  # a worker keeps a few dozen megabytes at most
                cls._powers[seed] = (up, down)
            return up, down
        return have

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix64(raw ^ (np.asarray(ends - starts).astype(np.uint64) * _M1))


def segment_rows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segments of these lengths laid end to end: the segment of each item and its place inside."""
    lengths = np.asarray(lengths, np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else np.zeros(0, np.int64)
    return owner, np.arange(int(lengths.sum())) - starts[owner]
