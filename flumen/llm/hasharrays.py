"""Sorted hash arrays in the shared folder: counted by Spark tasks, cut by hash range
into shards, memory-mapped by workers.

A task sends each shard one packed block (``planes``); the shard's task merges its
blocks and saves them under its own name. A file is written under another name and
renamed, so a task that runs again, or twice, replaces it whole. The shared folder must
be mounted where the workers run, as memory-mapping needs a file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import DataFrame

from flumen.llm.common import bounded_batches, released
from flumen.session import scratch_path


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so sorted keys come shard by shard."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """(shard, its slice) of sorted keys."""
    if len(keys):
        shard = shard_of(keys, shards)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(keys)]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(shard[a]), slice(a, b)


def planes(a: np.ndarray) -> bytes:
    """The array byte by byte of its elements: high bytes of sorted keys and of small
    counts then stand together, which the shuffle's compression removes."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()


def unplaned(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(first)
    return [keys[at], *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values)]


def save(path: str, array: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


@lru_cache(maxsize=65_536)
def mapped(path: str) -> np.ndarray | None:
    """The array in a file, memory-mapped once per worker; None where there is none."""
    if not os.path.exists(path):
        return None
    array = np.load(path, mmap_mode="r")
    return array if len(array) else None


def find(folder: str, name: str, keys: np.ndarray, shards: int) -> Iterator[tuple[slice, str, np.ndarray, np.ndarray]]:
    """For sorted keys, shard by shard: their slice, the shard's file stem, the
    position in its sorted keys, and whether the key is there."""
    for shard, part in by_shard(keys, shards):
        stem = f"{folder}/{name}-{shard}"
        sorted_keys = mapped(stem + ".key.npy")
        if sorted_keys is not None:
            at = np.minimum(np.searchsorted(sorted_keys, keys[part]), len(sorted_keys) - 1)
            yield part, stem, at, sorted_keys[at] == keys[part]


def mounted(spark, label: str) -> str:
    path = scratch_path(spark, label)
    scheme = urlparse(path).scheme
    if scheme not in ("", "file"):
        raise ValueError(f"the scratch folder {path} must be mounted as a file system where workers run")
    return urlparse(path).path


def dealt(rows: DataFrame, shards: int, merge, schema: str) -> list:
    """Deal blocks to their shards, merge and write each shard, return its figures
    (one short row per shard)."""
    bounded_batches(rows.sparkSession)

    def merged(batches):
        yield from merge(batches)
        released()
    return rows.repartition(shards, "shard").mapInArrow(merged, schema).collect()


def held(batches) -> dict[int, list[tuple]]:
    found: dict[int, list[tuple]] = {}
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        for shard, *blobs in zip(*columns):
            found.setdefault(shard, []).append(tuple(blobs))
    return found
