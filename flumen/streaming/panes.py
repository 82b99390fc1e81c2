"""Count-trigger panes on a stream (the stream form of
:func:`flumen.operators.panes.count_panes`).

Spark emits per micro-batch, not per key-and-count, so a per-key count trigger
is custom state: ``groupBy(keys).applyInPandasWithState`` keeps, per key, the
rows and sum of the open pane plus the running total. Each micro-batch's rows
of a key arrive as pandas batches (Arrow); the pane arithmetic is vectorised
with numpy, and only completed panes are emitted (append mode). State is
checkpointed with the query, so a restarted query resumes mid-pane.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

STATE = T.StructType([
    T.StructField("open_rows", T.LongType()),
    T.StructField("open_sum", T.DoubleType()),
    T.StructField("pane", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("done", T.BooleanType()),
])


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def count_panes_stream(stream: DataFrame, keys, arrival: str, value: str, n: int,
                       accumulating: bool = False, repeat: bool = True) -> DataFrame:
    """Emit ``keys, pane, pane_rows, pane_value`` each time a key has seen
    another ``n`` rows (in ``arrival`` order within each micro-batch)."""
    k = _keys(keys)
    key_fields = [stream.schema[c] for c in k]
    out_schema = T.StructType(key_fields + [
        T.StructField("pane", T.LongType()), T.StructField("pane_rows", T.LongType()),
        T.StructField("pane_value", T.DoubleType())])

    def step(key, pdfs, state):
        open_rows, open_sum, pane, total, done = state.get if state.exists else (0, 0.0, 0, 0.0, False)
        frames = [p[[arrival, value]] for p in pdfs]
        if done or not frames:
            return
        rows = pd.concat(frames).sort_values(arrival)
        v = rows[value].to_numpy(dtype="float64")
        pos = open_rows + np.arange(1, len(v) + 1)          # position inside the open pane chain
        run = total + np.cumsum(v)                           # running total after each row
        ends = np.nonzero(pos % n == 0)[0]                   # rows that complete a pane
        emitted = []
        prev_end_total = total - open_sum                    # running total before the open pane
        for j, e in enumerate(ends):
            pane_total = run[e] - prev_end_total
            prev_end_total = run[e]
            emitted.append((pane + j, (pane + j + 1) * n if accumulating else n,
                            run[e] if accumulating else pane_total))
            if not repeat:
                break
        pane += len(emitted)
        if emitted:
            last = ends[len(emitted) - 1]
            open_rows = len(v) - 1 - last
            open_sum = float(v[last + 1:].sum())
        else:
            open_rows += len(v)
            open_sum += float(v.sum())
        total = float(run[-1])
        done = done or (not repeat and pane >= 1)
        state.update((int(open_rows), float(open_sum), int(pane), total, bool(done)))
        if emitted:
            data = {c: [key[i]] * len(emitted) for i, c in enumerate(k)}
            data["pane"] = [e[0] for e in emitted]
            data["pane_rows"] = [e[1] for e in emitted]
            data["pane_value"] = [e[2] for e in emitted]
            yield pd.DataFrame(data)

    return stream.groupBy(*k).applyInPandasWithState(
        step, out_schema, STATE, "append", GroupStateTimeout.NoTimeout)


SEGMENT_STATE = T.StructType([
    T.StructField("open", T.BooleanType()),
    T.StructField("start_us", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("pane", T.LongType()),
])


def segment_panes_stream(stream: DataFrame, keys, arrival_ts: str, tie_break: str, value: str,
                         n: int | None = None, delay_s: float | None = None) -> DataFrame:
    """Stream form of :func:`flumen.operators.panes.segment_panes`:
    ``Repeatedly(AfterAny(AfterCount(n), AfterProcessingTime(delay)))``,
    DISCARDING, with ``arrival_ts`` as the clock.

    Per key the state holds the open pane (start, rows, sum, number). A pane
    closes when it has ``n`` rows, when a row arrives ``delay`` or more after
    it opened, or -- for a key that goes quiet -- when the watermark on
    ``arrival_ts`` passes ``start + delay`` (an event-time timeout). Emits
    ``keys, pane, pane_start, pane_rows, pane_value`` in append mode.
    """
    k = _keys(keys)
    delay_us = None if delay_s is None else int(delay_s * 1_000_000)
    key_fields = [stream.schema[c] for c in k]
    out_schema = T.StructType(key_fields + [
        T.StructField("pane", T.LongType()), T.StructField("pane_start", T.TimestampType()),
        T.StructField("pane_rows", T.LongType()), T.StructField("pane_value", T.DoubleType())])

    def emit(key, panes_):
        data = {c: [key[i]] * len(panes_) for i, c in enumerate(k)}
        data["pane"] = [p[0] for p in panes_]
        data["pane_start"] = pd.to_datetime([p[1] for p in panes_], unit="us", utc=True)
        data["pane_rows"] = [p[2] for p in panes_]
        data["pane_value"] = [p[3] for p in panes_]
        return pd.DataFrame(data)

    def step(key, pdfs, state):
        is_open, start, rows, total, pane = state.get if state.exists else (False, 0, 0, 0.0, 0)
        if state.hasTimedOut:
            if is_open:
                yield emit(key, [(pane, start, rows, total)])
            state.update((False, 0, 0, 0.0, pane + 1 if is_open else pane))
            return
        frames = [p[["__t", "__tb", "__v"]] for p in pdfs]
        if not frames:
            return
        batch = pd.concat(frames).sort_values(["__t", "__tb"])
        t = batch["__t"].to_numpy(dtype="int64")
        v = batch["__v"].to_numpy(dtype="float64")
        closed, i = [], 0
        if not is_open:
            is_open, start, rows, total = True, int(t[0]), 0, 0.0
        while i < len(t):
            j = len(t)
            if n is not None:
                j = min(j, i + (n - rows))
            if delay_us is not None:
                j = min(j, i + int(np.searchsorted(t[i:], start + delay_us, side="left")))
            rows += j - i
            total += float(v[i:j].sum())
            i = j
            if i < len(t):
                closed.append((pane, start, rows, total))
                pane, start, rows, total = pane + 1, int(t[i]), 0, 0.0
        if n is not None and rows >= n:          # full at the end of the batch
            closed.append((pane, start, rows, total))
            is_open, pane, rows, total = False, pane + 1, 0, 0.0
        state.update((is_open, int(start), int(rows), float(total), int(pane)))
        if is_open and delay_us is not None:
            state.setTimeoutTimestamp(int((start + delay_us) // 1000))
        if closed:
            yield emit(key, closed)

    base = stream.select(*k, F.col(arrival_ts).alias("__ts"), F.unix_micros(arrival_ts).alias("__t"),
                         F.col(tie_break).alias("__tb"), F.col(value).cast("double").alias("__v"))
    timeout = GroupStateTimeout.EventTimeTimeout if delay_us is not None else GroupStateTimeout.NoTimeout
    return (base.withWatermark("__ts", "0 seconds").groupBy(*k)
            .applyInPandasWithState(step, out_schema, SEGMENT_STATE, "append", timeout))
