"""Word and hash helpers over Arrow text columns, shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows with no doc_id are handled under this id, after all others, and lose it again in the result.
NO_ID = 2**63 - 1
# Text handled at once inside a task.
CHUNK_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")


def without_id(name: str = "doc_id") -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


def packed(docs: DataFrame) -> DataFrame:
    """``row, doc_key, text_key``: rows whole, whatever their columns are called, and what tells them apart."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), with_id().alias("doc_key"),
                       F.xxhash64("text").alias("text_key"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ARROW_BYTES, ARROW_BYTES_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession, limit: int = CHUNK_BYTES) -> None:
    """Let this session hand rows to Python in Arrow batches of about ``limit`` bytes, unless a size was set.

    A batch is held by the JVM and by Python at once, and 10,000 rows of text are many times what a task works on.
    """
    if spark.conf.get(ARROW_BYTES) == ARROW_BYTES_DEFAULT:
        spark.conf.set(ARROW_BYTES, str(limit))


@contextmanager
def batches_of(spark: SparkSession, limit: int = CHUNK_BYTES) -> Iterator[None]:
    """:func:`small_batches` for the jobs run inside; afterwards the session's size is what it was."""
    before = spark.conf.get(ARROW_BYTES)
    small_batches(spark, limit)
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def give_back() -> None:
    """Return freed memory to the system; a Python worker lives through many tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text, or a single longer row."""
    for batch in batches:
        ends = np.cumsum(np.diff(text_bytes(batch.column(column))[1]))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, nulls empty, and where each row begins in them."""
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def spaced_words() -> np.ndarray:
    """Byte table for words ``[^\\x20\\x09-\\x0D]+``: separators map to 0 in the second row."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each row (one more at the end)."""
    mask = inside[data]
    edge = np.zeros(len(mask) + 1, bool)
    edge[1:-1] = mask[1:] != mask[:-1]
    if len(mask):
        edge[0], edge[-1] = mask[0], mask[-1]
    cuts = bounds[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(mask))])
    both = cuts[mask[cuts] & mask[cuts - 1]]  # a word would run over the end of a row
    places = np.flatnonzero(edge)
    if len(both):
        places = np.sort(np.concatenate([places, both, both]), kind="stable")
    starts, ends = places[0::2], places[1::2]
    return starts, ends, np.searchsorted(starts, bounds)


_RANDOM = np.random.default_rng(20240229)
BYTE_CODES = [_RANDOM.integers(1, 2**64, 256, np.uint64) for _ in range(2)]
FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
INVERSES = [np.uint64(pow(int(f), -1, 2**64)) for f in FACTORS]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(factor: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(factor))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), factor, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 8 * CHUNK_BYTES:
            _powers[int(factor)] = known
    return known[:n]


def window_sums(codes: np.ndarray, k: int, family: int = 0) -> np.ndarray:
    """Polynomial hash of every ``k`` neighbouring codes; windows may run over row ends."""
    n = len(codes)
    if n < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * powers(FACTORS[family], n), out=total[1:])
    return mixed((total[k:] - total[:n - k + 1]) * powers(INVERSES[family], n - k + 1))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[family][data] * powers(FACTORS[family], len(data)), out=total[1:])
    sums = (total[ends] - total[starts]) * powers(INVERSES[family], len(data))[starts]
    return mixed(sums + (ends - starts).astype(np.uint64))


def span_array(starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """The words as an Arrow binary array."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1  # no two words begin, or end, at one place
    keep[ends] -= 1
    body = data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body.tobytes())])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts`` and are ``counts`` long, one after another."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)
