"""Windowed aggregates on streams: event-time windows with a watermark.

* append  -- a window is emitted once, when the watermark passes its end
  (the default "fire when the watermark passes" trigger);
* update  -- every micro-batch re-emits the windows it changed, with the
  running (accumulating) value; rows whose window already closed by more than
  the allowed lateness are dropped.

State per window lives in the state store (RocksDB by default in
:func:`flumen.session.build_session`) and is evicted once the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(keys):
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def windowed_count(stream: DataFrame, ts: str, size: str, lateness: str, keys=None,
                   aggs=None, slide: str | None = None) -> DataFrame:
    """Count (or ``aggs``) per event-time window (and key), watermarked."""
    aggs = aggs or [F.count(F.lit(1)).alias("count")]
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return stream.withWatermark(ts, lateness).groupBy(w.alias("window"), *_keys(keys)).agg(*aggs)


def session_count(stream: DataFrame, ts: str, gap: str, lateness: str, keys=None, aggs=None) -> DataFrame:
    aggs = aggs or [F.count(F.lit(1)).alias("count")]
    return (stream.withWatermark(ts, lateness)
            .groupBy(F.session_window(ts, gap).alias("window"), *_keys(keys)).agg(*aggs))
