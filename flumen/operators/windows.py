"""Event-time windows on batch data: fixed, sliding, session, global.

Windows are aligned to the epoch. The window is an ordinary struct column
(``start``, ``end``), so it can be grouped on, printed or filtered like any
other column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flumen.functions import dates
from flumen.operators import ordered, partials


def _keys(keys):
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _dur(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def fixed(df: DataFrame, ts: str, size_s: int, keys=None, aggs=None) -> DataFrame:
    """Tumbling windows of ``size_s`` seconds, optionally per key."""
    aggs = aggs or [F.count(F.lit(1)).alias("count")]
    return df.groupBy(F.window(ts, _dur(size_s)).alias("window"), *_keys(keys)).agg(*aggs)


def sliding(df: DataFrame, ts: str, size_s: int, period_s: int, keys=None, aggs: dict | None = None) -> DataFrame:
    """Hopping windows: each row counts in the windows of ``size_s`` seconds, one every
    ``period_s``, that hold it. ``aggs`` as in :mod:`flumen.operators.partials`.

    Rows are aggregated once, per slice: the common divisor of size and period, so that a
    window is a whole number of slices. Only slices are then copied into their windows
    and merged: a row of the shuffle is a slice and task, however many windows overlap."""
    aggs, k = aggs or partials.COUNT, _keys(keys)
    width = math.gcd(size_s, period_s)
    slices = (df.where(F.col(ts).isNotNull()).groupBy(F.unix_seconds(F.window(ts, _dur(width)).start).alias("__at"), *k)
              .agg(*partials.of_rows(aggs)))
    # the last window that holds a slice begins at the last multiple of the period before it
    last = F.col("__at") - F.pmod("__at", F.lit(period_s))
    first = F.col("__at") + F.lit(width - size_s)
    first = first + F.pmod(-first, F.lit(period_s))
    begins = F.when(first <= last, F.sequence(first, last, F.lit(period_s).cast("long")))
    each = slices.select("*", F.explode(begins).alias("__start"))
    window = F.struct(F.timestamp_seconds("__start").alias("start"), F.timestamp_seconds(F.col("__start") + F.lit(size_s)).alias("end"))
    out = each.groupBy("__start", *k).agg(*partials.of_parts(aggs))
    return out.select(window.alias("window"), *k, *aggs)


def global_window(df: DataFrame, keys=None, aggs=None) -> DataFrame:
    aggs = aggs or [F.count(F.lit(1)).alias("count")]
    k = _keys(keys)
    return df.groupBy(*k).agg(*aggs) if k else df.agg(*aggs)


def start_text(window_col: str = "window", fmt: str = dates.ISO_SECONDS) -> Column:
    """Window start printed as ``yyyy-MM-ddTHH:mm:ss`` in the session zone (UTC)."""
    return F.date_format(F.col(f"{window_col}.start"), fmt)


def sessions_builtin(df: DataFrame, ts: str, gap_s: int, keys=None, aggs=None) -> DataFrame:
    """Spark's own ``session_window``: a row within ``gap`` of the previous one
    extends the session; the session ends ``gap`` after its last row."""
    aggs = aggs or [F.count(F.lit(1)).alias("count")]
    return df.groupBy(*_keys(keys), F.session_window(ts, _dur(gap_s)).alias("window")).agg(*aggs)


def _session_pieces(df: DataFrame, ts: str, gap_s: int, k: list, parts: list[Column]) -> DataFrame:
    """Partial sessions of each key with their session's number: the rows of one stretch of
    time as long as the gap. No two of these are further apart than the gap, so they
    belong to one session whatever lies between; they are one hash aggregate, combined in
    each task before the shuffle. A key has a piece per gap of its time at most, however
    many rows: only pieces are put in order. Rows without a time are a piece of their own."""
    pieces = df.withColumn("__piece", _stretch(ts, gap_s)).groupBy(*k, "__piece").agg(
        F.min(ts).alias("__first"), F.max(ts).alias("__last"), *parts)
    w = Window.partitionBy(*k).orderBy("__piece")
    before = F.lag("__last").over(w)
    opens = F.coalesce(F.col("__first") > before + F.make_interval(secs=F.lit(gap_s)), F.lit(True))
    pieces = pieces.withColumn("__opens", opens.cast("int"))
    return pieces.withColumn("session", F.sum("__opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__opens")


def _stretch(ts: str, gap_s: int) -> Column:
    us, gap = F.unix_micros(F.col(ts)), F.lit(max(1, int(gap_s * 1_000_000)))
    return us - F.pmod(us, gap)


def session_ids(df: DataFrame, ts: str, gap_s: int, keys, name: str = "session") -> DataFrame:
    """Label each row with its session's number inside its key. A new session starts when
    ``ts - previous_ts > gap`` (rows exactly one gap apart stay together, as in
    ``session_window``); rows without a time are one session, the first. The pieces of
    :func:`_session_pieces` are joined back to the rows."""
    k = _keys(keys)
    pieces = _session_pieces(df, ts, gap_s, k, []).select(*k, "__piece", F.col("session").alias(name))
    return ordered.join_back(df.withColumn("__piece", _stretch(ts, gap_s)), pieces, [*k, "__piece"]).drop("__piece")


def sessions(df: DataFrame, ts: str, gap_s: int, keys, aggs: dict | None = None) -> DataFrame:
    """Session windows per key with a ``window`` struct like ``session_window``: start =
    first row, end = last row + gap. ``aggs`` as in :mod:`flumen.operators.partials`:
    partial sessions carry accumulators, only these are merged per session."""
    aggs, k = aggs or partials.COUNT, _keys(keys)
    pieces = _session_pieces(df, ts, gap_s, k, partials.of_rows(aggs))
    out = pieces.groupBy(*k, "session").agg(F.min("__first").alias("__s"), F.max("__last").alias("__e"), *partials.of_parts(aggs))
    window = F.struct(F.col("__s").alias("start"), (F.col("__e") + F.make_interval(secs=F.lit(gap_s))).alias("end"))
    return out.select(*k, *aggs, window.alias("window"))
