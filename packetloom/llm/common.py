"""What several operators share: byte-level word tables for Arrow batches, and checked joins.

The numpy parts see one slice of whole documents at a time (``SLICE_BYTES`` of text, or a single
longer document), so a task holds a slice and never its partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20
BROADCAST_BYTES = 32 << 20   # a join side is broadcast only when rows x width stay below this
SPACE = bytes([0x20, *range(0x09, 0x0E)])   # fixed values: [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_power = np.ones(1, np.uint64)
_unpower = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads the entropy of weak sums over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


EXACT = seeded(256, 11)
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]
FOLD_BYTES = np.arange(256, dtype=np.uint8)
FOLD_BYTES[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _unpower
    if len(_power) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        for_base, for_inverse = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        for_base[0] = for_inverse[0] = 1
        _power, _unpower = np.cumprod(for_base), np.cumprod(for_inverse)
    return _power, _unpower


LONG_RANGE = 512   # a sum modulo 2^64 cancels for patterns of 1024 bytes and more, so such ranges are digested


class Hasher:
    """Hashes of byte ranges of one buffer, from one running sum; equal bytes, equal hash.

    Ranges of over ``LONG_RANGE`` bytes get a digest of their own bytes instead of the sum.
    """

    def __init__(self, buf: np.ndarray, codes: np.ndarray = EXACT):
        self.buf, self.low = buf, FOLD_BYTES if codes is FOLDED else None
        self.power, unpower = _powers(len(buf))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(codes[buf] * unpower[: len(buf)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        own = (self.sums[end] - self.sums[start]) * self.power[end]
        out = mix(own + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        for i in np.flatnonzero(end - start > LONG_RANGE).tolist():
            part = self.buf[start[i]: end[i]]
            raw = (part if self.low is None else self.low[part]).tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        return out


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each row begins (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of whole rows with about ``limit`` bytes of text."""
    for batch in batches:
        _, offsets = flat(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def byte_set(separators: bytes) -> np.ndarray:
    """Which bytes belong to words, when ``separators`` part them."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


def words(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (in bytes) and row of each word; words never cross rows."""
    mask = inside[buf]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    first, last = offsets[:-1], offsets[1:] - 1
    first, last = first[first < len(buf)], last[last >= 0]
    begins[first] = mask[first]
    ends[last] = mask[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words, by its first word; rows are not looked at."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _GRAM + hashes[i: i + n]
    return mix(out + np.uint64(k))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from values in row order and the number of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def reduce_rows(op: np.ufunc, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``op`` over each row's run of values (0 for rows without any)."""
    out = np.zeros(len(counts), values.dtype)
    some = np.flatnonzero(counts)
    if len(some):
        starts = np.cumsum(counts) - counts
        out[some] = op.reduceat(values, starts[some])
    return out


def as_signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(begin, counts) + np.repeat(starts, counts)


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with more columns; a column of the same name is replaced."""
    named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | columns
    return pa.RecordBatch.from_arrays(list(named.values()), names=list(named))


def extended(df: DataFrame, **columns: str) -> str:
    """The DDL schema of ``df`` after ``append``."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields} | columns
    return ", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in kinds.items())


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many ``_`` in front as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def fits(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is small enough to broadcast: counted, not guessed."""
    return df.count() * row_bytes <= limit


def join_small(left: DataFrame, right: DataFrame, on: Column, how: str, row_bytes: int) -> DataFrame:
    """Join a large table with one that is often small: broadcast behind a count, else a shuffle
    join that AQE may split.  ``right`` should be a written table, as it is read twice."""
    return left.join(F.broadcast(right) if fits(right, row_bytes) else right, on, how)


def folded(text: Column) -> Column:
    """A-Z to lower case and nothing else."""
    return F.translate(text, UPPER, LOWER)


def trim() -> None:
    """Give freed memory back at the end of a task: workers live on, and their unused pages count as used."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):     # glibc only
        ctypes.CDLL(None).malloc_trim(0)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it
    wherever they run (the same as ``spark-submit --py-files``)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "packetloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted((root / "packetloom").rglob("*.py")):
            out.write(file, str(file.relative_to(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def mapped(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text",
           limit: int = SLICE_BYTES, after: Callable[[], None] | None = None) -> DataFrame:
    """Apply ``work`` to slices of whole rows; ``after`` runs at the end of each task, also of one that fails."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in slices(batches, text, limit):
                yield work(part)
        finally:
            if after:
                after()
            trim()
    return df.mapInArrow(run, schema)
