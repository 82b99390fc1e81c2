"""Hot keys: groupings that stay spread when one key holds a large share of the rows.

Combinable aggregates (count/sum/min/max/avg) already combine in each task before
the shuffle, so they are safe as they are. What is not safe is moving every row of a
key to one task; :func:`spread_by_key` cuts such a key into parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def spread_by_key(df: DataFrame, keys, by: str, target_rows: int = 2_000_000,
                  partitions: int | None = None) -> DataFrame:
    """Group-by-key-then-flatten without building lists: rows are clustered by
    ``(key, part)`` where ``part`` cuts each key into pieces of about
    ``target_rows`` rows (ranges of the unique column ``by``). Every key's rows
    sit together, and a hot key is split into ``count / target_rows`` tasks
    instead of one. Deterministic, so a retried task rebuilds the same split."""
    from flumen.operators.ordered import adaptive_bucket

    k = _keys(keys)
    parted = adaptive_bucket(df, k, by, target_rows, "__part")
    parts = [partitions] if partitions else []
    return parted.repartition(*parts, *k, "__part").sortWithinPartitions(*k, "__part").drop("__part")
