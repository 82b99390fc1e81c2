"""Helpers shared by the corpus operators: byte views of Arrow text, vectorised
hashing inside tasks, and tables written once to the shared scratch folder.

Texts are handled as one contiguous UTF-8 buffer per Arrow batch with document
offsets (a null text is an empty one), so per-byte work is numpy, not Python.
"""

from __future__ import annotations

import ctypes
import inspect
import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flumen.session import scratch_path

BATCH_BYTES = 8 << 20    # of an Arrow batch
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

LOWER = np.arange(256, dtype=np.uint8)          # A-Z only, as the contracts ask
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)               # \x20 and \x09-\x0D
SPACE[[32, 9, 10, 11, 12, 13]] = True


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch that is sent to a worker hold more than ``BATCH_BYTES`` (or one
    row): a batch of long texts would else be as many times larger as its texts are. A
    smaller limit of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def arrow_udf(kind: str):
    """``functions.arrow_udf`` over batches of bounded size. It is declared not
    deterministic, though it is: else a filter on its result, asked for or inferred from
    a join, is pushed below it and runs it a second time, in a second worker. After each
    batch, memory that is free goes back to the system, as idle workers stay."""
    bounded_batches(SparkSession.active())

    def made(f):
        def run(*columns):
            out = f(*columns)
            released()
            return out
        run.__annotations__ = f.__annotations__
        run.__signature__ = inspect.signature(f)
        return F.arrow_udf(kind)(run).asNondeterministic()
    return made


def released() -> None:
    """Give free memory of Arrow and of the C library back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # the GNU library's
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of a polynomial hash may be compared."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base):
        a = np.full(n + 1, base, dtype=np.uint64)
        a[0] = 1
        return np.cumprod(a, dtype=np.uint64)
    return table(_BASE), table(_INVERSE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, up to ``n`` at least."""
    return _powers(1 << max(12, int(n).bit_length()))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``H[i]`` covers the first ``i`` bytes (or 64-bit codes); see :func:`span_hash`."""
    h = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((BYTE_CODES[data] if data.dtype == np.uint8 else data) * powers(len(data))[0][:len(data)], dtype=np.uint64, out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte string ``[start, end)``, wherever it stands."""
    inv = powers(len(h))[1]
    return mix((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the documents' offsets
    in it (``n + 1`` values). Null is empty; no bytes are copied where no null is."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=n + 1 + column.offset)[column.offset:].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def doc_of(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the document that holds each byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared scratch folder and read back:
    later jobs neither compute it again nor need the executors that made it."""
    path = scratch_path(df.sparkSession, label)
    out = df.write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id="doc_id", parts: int = 5):
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def unused(df: DataFrame, n: int) -> list[str]:
    """Names for n columns beside those of ``df``, whatever their names (in any case)."""
    taken = {c.lower() for c in df.columns}
    free = (f"__own_{i}" for i in itertools.count())
    return list(itertools.islice((c for c in free if c not in taken), n))


def replaced(df: DataFrame, **columns) -> DataFrame:
    """``df`` with the given columns at its end; columns of ``df`` whose names clash
    with theirs (in any case) give way."""
    taken = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in columns.items()])
