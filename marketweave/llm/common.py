"""Helpers shared by the operators of this subpackage: staged tables, Arrow text as numpy, 64-bit hashes."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.session import shared_dir

#: Bytes of text that a Python worker expands into arrays at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 19

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd and 5 modulo 8: its powers modulo 2**64 have a full cycle
_INVERSE = pow(_BASE, -1, 1 << 64)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written to the folder that all executors share, and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    path = shared_dir(df.sparkSession, "marketweave-llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Removes the folders of staged tables whose last reader has been written; other files that the frames read stay."""
    for df in frames:
        spark = df.sparkSession
        root = shared_dir(spark, "marketweave-llm")
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"{root.split('://')[-1].rstrip('/')}/" in folder:
                at = spark._jvm.org.apache.hadoop.fs.Path(folder)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def unused(columns: list[str], name: str) -> str:
    """``name``, made longer until no column bears it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``: the fixed split into learning and held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts have at most ``limit`` bytes, or one row."""
    ends = np.cumsum(text_lengths(batch.column(column)))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to
    _release()


def _release() -> None:
    """Gives memory that this worker has done with back to the system: workers live on from stage to stage, next to one another."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def large_text(column: pa.Array) -> pa.Array:
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def text_lengths(column: pa.Array) -> np.ndarray:
    return np.diff(text_bytes(column)[1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column as one array, and the offsets of its rows; null counts as empty."""
    column = large_text(column)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def seeds(count: int, salt: int) -> np.ndarray:
    """``count`` fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * _STEP + np.uint64(salt)) | np.uint64(1)


_BYTE = seeds(256, 11)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` or more. A process keeps them to itself: they must not travel with the functions that use them."""
    kept = sys.modules.setdefault("_marketweave_powers", types.ModuleType("_marketweave_powers"))
    if not hasattr(kept, "tables") or len(kept.tables[0]) < n:
        kept.tables = []
        for base in (_BASE, _INVERSE):
            factors = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
            factors[0] = 1
            kept.tables.append(np.cumprod(factors, dtype=np.uint64))
    return kept.tables


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``: differences of one running polynomial sum, whatever the spans' lengths."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _STEP)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def words(column: pa.Array, parts: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between the bytes that ``parts`` marks (ASCII white space), A-Z lowered: (hash, row, first byte, end byte) of each, in order; bytes count from the row's start."""
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~parts[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows_at = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[rows_at] = inside[rows_at]
    stops = begins.copy()  # a word ends before the next byte that is white space or begins a word
    stops |= ~inside
    starts = np.flatnonzero(begins)
    stop_at = np.flatnonzero(stops)
    ends = stop_at[np.searchsorted(stop_at, starts, "right")]
    row = np.searchsorted(offsets, starts, "right") - 1
    return span_hashes(data, starts, ends), row, starts - offsets[row], ends - offsets[row]


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct ``n``-word shingles of each row, sorted, as one array, and the bounds of the rows.

    A row of fewer words has one shingle, its whole sequence; a row without words has none.
    """
    hashed, row, _, _ = words(column)
    factors = seeds(n + 1, 23)
    rows = len(column)
    counts = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(counts)))
    if len(hashed) >= n:
        rolled = hashed[: len(hashed) - n + 1] * factors[0]
        for j in range(1, n):
            rolled = rolled + hashed[j : len(hashed) - n + 1 + j] * factors[j]
        rolled = mix(rolled)
    else:
        rolled = np.empty(0, np.uint64)
    out, bounds = [], np.zeros(rows + 1, np.int64)
    for i in range(rows):
        if counts[i] >= n:
            own = np.unique(rolled[first[i] : first[i + 1] - n + 1])
        elif counts[i]:
            own = hashed[first[i] : first[i + 1]]
            own = mix((own * factors[: len(own)]).sum(dtype=np.uint64, keepdims=True) + factors[n : n + 1] * np.uint64(len(own)))
        else:
            own = rolled[:0]
        out.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(out) if out else rolled[:0]), bounds
