"""Early, on-time and late panes of event-time windows on a stream
(``transformWithState``: value state and event-time timers).

A window of a key fires

* early (optional): a pane opens with its first row and closes as soon as a row arrives
  ``early_s`` or more after that, by an arrival clock that is a column of the rows, or
  else by the time at which a micro-batch is processed;
* on time: once, when the watermark passes the window's end, if rows are left to fire;
* late: after every ``late_rows`` rows that come behind the on-time firing, and once more
  for the rest when the allowed lateness is over and the window is forgotten.

ACCUMULATING panes repeat what earlier ones held, DISCARDING ones do not. The watermark
here is the highest event time of earlier micro-batches. The engine's own watermark lags
``lateness`` behind it, so the on-time timer stands at the end less the lateness, and the
one that forgets the window at its end. Rows of a window that ends at or before the
engine's watermark are dropped.

Start such a query by :mod:`flumen.streaming.sinks`, or with RocksDB as the session's state
store, which ``transformWithState`` needs.

Scale. State per key and window is one small value, evicted by its timer. Counts
(``value=None``) are combined per window in each task, an Arrow batch at a time, before
the shuffle, as rows are alike there: a window with a third of all rows sends a row per
batch. Sums with early or late panes depend on the rows' order, so a key's rows of one
window and micro-batch meet in one task, 16 bytes each; admission control of the source
bounds a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from flumen.operators.panes import KEY_TEXT, DISCARDING

PANE = "pane long, timing string, pane_rows long, pane_value double"
ROW = ["__key", "__end", "__at", "__n", "__v"]
AT, COUNT, VALUE = 2, 3, 4          # the processor's frames come without these names
STATE = "fired boolean, pane long, rows long, total double, open_rows long, open_total double, since long"


class _Window:
    """One window of a key: rows and total of all that came, and of those not fired yet;
    ``since``: arrival of the first of these."""

    def __init__(self, accumulating: bool, held):
        self.accumulating = accumulating
        self.fired, self.pane, self.rows, self.total, self.open_rows, self.open_total, self.since = held or (False, 0, 0, 0.0, 0, 0.0, 0)
        self.panes = []

    def state(self) -> tuple:
        return self.fired, self.pane, self.rows, self.total, self.open_rows, self.open_total, self.since

    def add(self, rows: int, total: float) -> None:
        self.rows, self.total = self.rows + rows, self.total + total
        self.open_rows, self.open_total = self.open_rows + rows, self.open_total + total

    def fire(self, timing: str) -> None:
        """A pane, unless nothing came since the last one."""
        if self.open_rows:
            rows, total = (self.rows, self.total) if self.accumulating else (self.open_rows, self.open_total)
            self.panes.append((self.pane, timing, rows, total))
            self.pane, self.open_rows, self.open_total = self.pane + 1, 0, 0.0


class _Panes(StatefulProcessor):
    """``alike``: rows carry counts and no order."""

    def __init__(self, lateness_ms: int, accumulating: bool, late_rows: int, early_us: int | None, alike: bool, clocked: bool):
        self.lateness, self.accumulating, self.late_rows, self.early, self.alike = lateness_ms, accumulating, late_rows, early_us, alike
        self.clocked = clocked          # rows bring the time of their arrival

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("window", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end, engine = int(key[1]), timerValues.getCurrentWatermarkInMs()
        if engine > 0 and engine >= end:
            return
        held = self.held.get()
        w = _Window(self.accumulating, held)
        late = engine > 0 and engine + self.lateness >= end
        if late and not w.fired:
            w.fire("on_time")
            w.fired = True
        if held is None:
            self.handle.registerTimer(end if late else end - self.lateness)
        if self.alike:
            self._counts(w, rows, late)
        else:
            self._values(w, rows, late, timerValues.getCurrentProcessingTimeInMs() * 1000)
        self.held.update(w.state())
        yield from self._shown(key, w)

    def _counts(self, w: _Window, rows, late: bool) -> None:
        n = sum(int(r.iloc[:, COUNT].sum()) for r in rows)
        while late and n >= self.late_rows - w.open_rows:
            more = self.late_rows - w.open_rows
            w.add(more, float(more))
            w.fire("late")
            n -= more
        if n:
            w.add(n, float(n))

    def _values(self, w: _Window, rows, late: bool, now: int) -> None:
        at, v = zip(*[(r.iloc[:, AT].to_numpy(), r.iloc[:, VALUE].to_numpy()) for r in rows])
        at, v = np.concatenate(at), np.concatenate(v)
        order = np.argsort(at, kind="stable")
        at, v = at[order] if self.clocked else np.full(len(at), now), v[order]
        i = 0
        while i < len(at):
            if late:
                j = min(len(at), i + self.late_rows - w.open_rows)
            else:
                if not w.open_rows:
                    w.since = int(at[i])
                j = len(at) if self.early is None else i + int(np.searchsorted(at[i:], w.since + self.early, side="left"))
            if j > i:
                w.add(j - i, float(v[i:j].sum()))
            if late and w.open_rows >= self.late_rows:
                w.fire("late")
            elif not late and j < len(at):
                w.fire("early")
            i = j

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.held.get()
        if held is None:
            return
        w, end = _Window(self.accumulating, held), int(key[1])
        if not w.fired:
            w.fire("on_time")
            w.fired = True
        if timerValues.getCurrentWatermarkInMs() >= end:
            w.fire("late")
            self.held.clear()
        else:
            self.held.update(w.state())
            self.handle.registerTimer(end)
        yield from self._shown(key, w)

    def _shown(self, key, w: _Window) -> Iterator[pd.DataFrame]:
        if w.panes:
            pane, timing, rows, total = zip(*w.panes)
            yield pd.DataFrame({"__key": key[0], "__end": key[1], "pane": pane, "timing": timing, "pane_rows": rows, "pane_value": total})

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = pa.table(b).group_by(["__key", "__end"]).aggregate([("__n", "sum"), ("__at", "min")])
        t = t.select(["__key", "__end", "__at_min", "__n_sum"]).append_column("__v", t["__n_sum"].cast(pa.float64()))
        yield from t.rename_columns(ROW).combine_chunks().to_batches()


def window_panes(stream: DataFrame, ts: str, size: str, lateness_s: int, keys=(), value: str | None = None,
                 mode: str = DISCARDING, late_rows: int = 1, early_s: float | None = None,
                 arrival: str | None = None, only: Column | None = None) -> DataFrame:
    """Panes of fixed windows of ``size``: keys, ``window_start``, ``pane`` (from 0),
    ``timing`` (early, on_time, late), ``pane_rows``, ``pane_value`` (the sum of ``value``,
    or the count). ``arrival``: a timestamp or whole number of microseconds; without it
    rows arrive when they are processed, those of a micro-batch at once and in any order.
    ``only`` picks the rows that count; the watermark follows all of them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if early_s is not None and early_s <= 0:
        raise ValueError("early panes need a time above 0")
    kinds = dict(stream.dtypes)
    timed = stream.withWatermark(ts, f"{lateness_s} seconds")
    if only is not None:
        # only a filter that reads the event time stays above the watermark
        timed = timed.where(F.when(only, F.col(ts)).isNotNull())
    key = F.to_json(F.struct(*keys), KEY_TEXT) if keys else F.lit("{}")
    at = F.lit(0) if arrival is None else F.unix_micros(arrival) if kinds[arrival] == "timestamp" else F.col(arrival)
    v = F.lit(1.0) if value is None else F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    rows = timed.where(F.col(ts).isNotNull()).select(
        key.alias("__key"), F.unix_millis(F.window(ts, size).end).alias("__end"),
        at.cast("long").alias("__at"), F.lit(1).cast("long").alias("__n"), v.alias("__v"))
    alike = value is None and early_s is None
    if alike:
        rows = rows.mapInArrow(_combined, rows.schema)
    processor = _Panes(lateness_s * 1000, mode != DISCARDING, late_rows, None if early_s is None else max(1, int(early_s * 1_000_000)), alike, arrival is not None)
    fired = rows.groupBy("__key", "__end").transformWithStateInPandas(processor, f"__key string, __end long, {PANE}", "Append", "EventTime")
    start = F.timestamp_millis(F.col("__end") - F.lit(int(pd.Timedelta(size).total_seconds() * 1000)))
    pane = ["pane", "timing", "pane_rows", "pane_value"]
    if not keys:
        return fired.select(start.alias("window_start"), *pane)
    named = F.from_json("__key", T.StructType([stream.schema[c] for c in keys]), KEY_TEXT)
    return fired.select(named.alias("__key"), start.alias("window_start"), *pane).select("__key.*", "window_start", *pane)
