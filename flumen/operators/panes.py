"""Trigger panes in batch form: which rows a trigger would emit together.

Spark's streaming output is per micro-batch, not per key-and-count, so
data-driven triggers are expressed here as deterministic row -> pane labels
over an *arrival order* (the order rows reached the pipeline):

* count trigger ``N`` -- pane = ``(position - 1) div N`` inside the key (only
  full panes fire); DISCARDING sums each pane, ACCUMULATING the running total
  up to the pane's last row; ``repeat=False`` keeps the first pane only.
* processing-time / "any of" triggers -- a pane opens with its first row and
  closes after ``N`` rows or once a row arrives ``delay`` or more after the
  opening row. Slices of the keys' rows in arrival order are worked on side by
  side and composed as functions of the pane that is open at their entry.

Positions and running totals of count triggers come from the two-step bucketed
scans in :mod:`flumen.operators.ordered`, so a hot key is split there, too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.operators import ordered
from flumen.session import materialize

DISCARDING = "discarding"
ACCUMULATING = "accumulating"


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def count_panes(df: DataFrame, keys, arrival: str, value: str, n: int,
                mode: str = DISCARDING, repeat: bool = True,
                target_rows: int | None = None) -> DataFrame:
    """Panes of a repeated (or one-shot) count trigger in a global window.

    Output: keys, ``pane`` (0-based), ``pane_rows``, ``pane_value``.
    ``arrival`` is an integer arrival position (unique within the key);
    each key's arrivals are cut into buckets (:func:`ordered.adaptive_bucket`).
    """
    k = _keys(keys)
    if not repeat:
        # only the first n rows of a key matter: the rank limit applies before the shuffle
        place = F.row_number().over(Window.partitionBy(*k).orderBy(arrival))
        first = df.select(*k, arrival, value).withColumn("__rn", place).where(F.col("__rn") <= n)
        grouped = first.groupBy(*k).agg(F.count(F.lit(1)).alias("pane_rows"), F.sum(value).alias("pane_value"))
        return grouped.where(F.col("pane_rows") == n).select(
            *k, F.lit(0).cast("bigint").alias("pane"), "pane_rows", "pane_value")
    b = "__arrival_bucket"
    x = ordered.adaptive_bucket(df.select(*k, arrival, value), k, arrival, target_rows, b)
    x = ordered.running_many(x, k, [arrival], b, {"__run": ("sum", value), "__rn": ("count", None)})
    x = x.withColumn("pane", F.floor((F.col("__rn") - 1) / n).cast("bigint"))
    if mode == ACCUMULATING:
        # the pane fires at its n-th row; the running total there is the pane
        ends = x.filter(F.col("__rn") % n == 0)
        return ends.select(*k, "pane", F.col("__rn").alias("pane_rows"),
                           F.col("__run").alias("pane_value"))
    grouped = x.groupBy(*k, "pane").agg(F.count(F.lit(1)).alias("pane_rows"),
                                         F.sum(value).alias("pane_value"))
    return grouped.filter(F.col("pane_rows") == n)


def _pane_base(df: DataFrame, k, arrival_ts: str, tie_break: str, value: str) -> DataFrame:
    return df.select(*k, F.unix_micros(arrival_ts).alias("__t"), F.col(tie_break).alias("__tb"),
                     F.col(value).cast("double").alias("__v"))


KEY_TEXT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _packed(df: DataFrame, k) -> DataFrame:
    """The keys as one text that is never NULL: pandas would turn a long column that
    holds a NULL into doubles, and take different keys for one."""
    return df.withColumn("__key", F.to_json(F.struct(*k), KEY_TEXT))


def _unpacked(panes: DataFrame, df: DataFrame, k) -> DataFrame:
    keys = F.from_json("__key", df.select(*k).schema, KEY_TEXT)
    return panes.withColumn("__key", keys).select("__key.*", *[c for c in panes.columns if c != "__key"])


#: Rows of a slice that its task holds at once.
HELD_ROWS = 50_000


def segment_panes(df: DataFrame, keys, arrival_ts: str, tie_break: str, value: str,
                  n: int | None = None, delay_s: float | None = None, slices: int | None = None,
                  held_rows: int = HELD_ROWS) -> DataFrame:
    """Panes of ``Repeatedly(AfterAny(AfterCount(n), AfterProcessingTime(delay)))``
    (either part may be None). Every pane fires: when full, when its delay has
    passed, or at the end of the input / window. Output: keys, ``pane``,
    ``pane_start``, ``pane_rows``, ``pane_value`` (DISCARDING sums).

    A pane depends on where the one before it closed. All rows are cut, by key and
    arrival, into slices of one range partitioning, so a key of any size is spread over
    slices, and every slice is worked on alike, whatever the count bound or the delay:

    1. within a slice each row points to the row that would open the next pane, had one
       opened with it. Keys that begin in the slice follow the pointers from their first
       row. The rest of a key that began in an earlier slice cannot know its first pane
       start yet: pointer doubling gives, for every row that may be it, the number of
       panes up to the slice's end and the pane still open there. Neighbouring rows with
       the same outcome are one piece, and chains meet soon, so a slice has few pieces.
    2. a slice is then a function of the pane that is open at its entry. At most one key
       crosses each border, so these functions are few; they are composed key by key, in
       slice order, which gives every slice's entry.
    3. slices that continue a key are labelled from their entries. Panes leave the
       slices as partial sums; only those that cross a border have several.

    Slices are as many as ``slices``, else as ``spark.sql.shuffle.partitions`` (AQE joins
    small ones). A task reads its slice in order and holds ``held_rows`` of it (and an Arrow
    batch) at once, whatever the slice's size: the pane that is open where it cuts goes on
    as known, and the head's pieces are led through the rows that follow. Rows without an
    arrival time belong to no pane. NULL is a key like any other.
    """
    k = _keys(keys)
    delay_us = None if delay_s is None else int(delay_s * 1_000_000)
    rows = _pane_base(_packed(df, k), ["__key"], arrival_ts, tie_break, value).where(F.col("__t").isNotNull())
    # one shuffle of the rows; what the slices give is written once, so that all readers see
    # the cuts of one sampling, a task that runs again too
    order = ["__key", "__t", "__tb"]
    cut = rows.repartitionByRange(slices, *order) if slices else rows.repartitionByRange(*order)
    slices = (cut.sortWithinPartitions(*order)
              .withColumn("__slice", F.spark_partition_id().cast("bigint"))
              .mapInPandas(lambda it: _slice(it, n, delay_us, held_rows), _OUT))
    out = materialize(slices, "pane-slices", "kind")
    panes, ended, pieces, heads = (out.where(F.col("kind") == kind) for kind in ("pane", "tail", "piece", "row"))
    # small tables, a row or a few per slice: the key that each slice ends with, and the
    # slices that begin with a key which an earlier one ends with
    tails = ended.selectExpr("__key", "__slice", *_AS_PIECE)
    began = tails.groupBy("__key").agg(F.min("__slice").alias("__began"))
    tails = tails.join(began, "__key").where("__slice = __began").drop("__began")
    goes_on = (pieces.select("__key", "__slice").distinct().join(began, "__key").where("__slice > __began")
               .select("__key", "__slice", F.lit(True).alias("__goes_on")))
    own = panes.join(goes_on, ["__key", "__slice"], "left").where(~F.coalesce(F.col("head") & F.col("__goes_on"), F.lit(False)))
    entries = (pieces.join(goes_on, ["__key", "__slice"]).select("__key", "__slice", *_PIECE).unionByName(tails)
               .groupBy("__key").applyInPandas(lambda pdf: _composed(pdf, n, delay_us), _ENTRY))
    rest = (heads.join(entries, ["__key", "__slice"])
            .select("__key", "__slice", F.col("t").alias("__t"), F.col("pane").alias("__nth"), F.col("value").alias("__v"), *_STATE)
            .repartition("__slice").sortWithinPartitions("__slice", "__nth"))
    more = rest.mapInPandas(lambda it: _rest_panes(it, n, delay_us), _PARTIAL)
    panes = own.select("__key", "pane", "t", "rows", "value").unionByName(more).groupBy("__key", "pane").agg(
        F.timestamp_micros(F.min("t")).alias("pane_start"), F.sum("rows").alias("pane_rows"), F.sum("value").alias("pane_value"))
    return _unpacked(panes, df, k)


_PARTIAL = "__key string, pane long, t long, rows long, value double"
#: What a slice gives: partial panes (head: of the key that it begins with), its tail (the
#: pane that is open at its end), the pieces of its head, and the rows of its head (pane:
#: the row's place), in case that key began earlier.
_OUT = ("kind string, __key string, __slice long, pane long, t long, rows long, value double, head boolean, "
        "last_row long, last_t long, panes long, exit_t long, exit_rows long, size long")
_PIECE = ["last_row", "last_t", "panes", "exit_t", "exit_rows", "size"]
#: The open pane at the end of a key's first slice, as a piece that any entry leads to.
_AS_PIECE = ["-1L AS last_row", "0L AS last_t", "pane + 1 AS panes", "t AS exit_t", "rows AS exit_rows", "0L AS size"]
_ENTRY = "__key string, __slice long, entry_t long, entry_rows long, entry_pane long"
_STATE = ["entry_t", "entry_rows", "entry_pane"]


def _next(t: np.ndarray, ends: np.ndarray, n: int | None, delay_us: int | None) -> np.ndarray:
    """For each row, the row that opens the next pane if one opens with it, or its key's
    end. ``t`` rises within a key; ``ends``: the end of each row's key."""
    at = np.arange(len(t))
    nxt = ends.copy()
    if n is not None:
        nxt = np.minimum(nxt, at + n)
    if delay_us is not None and len(t):
        # one search for all keys: times are laid out one key behind the other
        start = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1])))
        size = np.diff(np.append(start, len(t)))
        span = t[start + size - 1] - t[start] + delay_us + 1
        shift = np.repeat(np.concatenate(([0], np.cumsum(span)[:-1])) - t[start], size)
        line = t + shift
        nxt = np.minimum(nxt, np.maximum(np.searchsorted(line, line + delay_us, side="left"), at + 1))
    return nxt


def _key_ends(keys: np.ndarray) -> np.ndarray:
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(start, len(keys)))
    return np.repeat(start + size, size)


def _followed(nxt: np.ndarray, at: int) -> np.ndarray:
    """Pane starts from row ``at`` on; a key's end is where the next key's first pane opens."""
    out, step, size = [], nxt.tolist(), len(nxt)
    while at < size:
        out.append(at)
        at = step[at]
    return np.asarray(out, dtype=np.int64)


def _sums(t: np.ndarray, v: np.ndarray, starts: np.ndarray, number: np.ndarray) -> dict:
    """Panes that open at the given rows; ``number``: theirs within their key."""
    return {"pane": number, "t": t[starts], "rows": np.diff(np.append(starts, len(t))),
            "value": np.add.reduceat(v, starts) if len(starts) else v[:0]}


def _held(batches, rows: int):
    """The batches joined, about so many rows at a time."""
    held = []
    for pdf in batches:
        if len(pdf):
            held.append(pdf)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _carried(t, v, nxt, state: tuple, n, delay_us) -> tuple[dict, tuple]:
    """Rows of one key that follow an open pane (start, rows, number): their partial panes,
    and the pane that is open after them."""
    start, rows, pane = state
    first = len(t) if n is None else min(len(t), n - rows)
    if delay_us is not None:
        first = min(first, int(np.searchsorted(t, start + delay_us, side="left")))
    starts = _followed(nxt, first)
    if first:                                           # rows of the pane that is open
        starts = np.concatenate(([0], starts))
    out = _sums(t, v, starts, pane + np.arange(len(starts)) + (0 if first else 1))
    if first:
        out["t"][0] = start
    last = int(out["rows"][-1]) + (rows if first and len(starts) == 1 else 0)
    return out, (int(out["t"][-1]), last, int(out["pane"][-1]))


def _slice(batches, n, delay_us, held_rows):
    """One slice: panes of its keys as if all began in it, and its head as a function."""
    key = state = pieces = None
    in_head, place, where = True, 0, {}

    def given(kind: str, columns: dict) -> pd.DataFrame:
        return pd.DataFrame({"kind": kind, **where, **columns}).reindex(columns=[c.split()[0] for c in _OUT.split(", ")])

    for pdf in _held(batches, held_rows):
        keys, t, v = pdf["__key"].to_numpy(), pdf["__t"].to_numpy(), np.nan_to_num(pdf["__v"].to_numpy(dtype=np.float64))
        ends = _key_ends(keys)
        nxt = _next(t, ends, n, delay_us)
        where, size, begun = {"__slice": int(pdf["__slice"].iat[0])}, int(ends[0]), 0
        in_head = in_head and key in (None, keys[0])
        if in_head:
            pieces = _led(pieces, t[:size], nxt[:size], n, delay_us)
            yield given("row", {"__key": keys[:size], "pane": place + np.arange(size), "t": t[:size], "value": v[:size]})
            place += size
            head = keys[0]
        if key == keys[0]:
            begun = size
            out, state = _carried(t[:size], v[:size], nxt[:size], state, n, delay_us)
            yield given("pane", {"__key": key, **out, "head": in_head})
        if begun < len(t):
            starts = _followed(nxt, begun)
            of = ends[starts]
            begin = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            number = np.arange(len(starts)) - np.repeat(begin, np.diff(np.append(begin, len(starts))))
            out = _sums(t, v, starts, number)
            yield given("pane", {"__key": keys[starts], **out, "head": in_head & (of == size)})
            state = int(out["t"][-1]), int(out["rows"][-1]), int(number[-1])
        key, in_head = keys[-1], in_head and size == len(t)
    if key is not None:
        yield given("tail", {"__key": [key], "t": state[0], "rows": state[1], "pane": state[2]})
        yield given("piece", {"__key": head, "size": place, **{c: pieces[c] for c in _PIECE[:-1]}})


def _led(pieces: dict | None, t: np.ndarray, nxt: np.ndarray, n, delay_us) -> dict:
    """The first key's rows so far as a function of the row that opens its first pane there:
    panes that open up to the end, and the last one's start and rows. The pieces of the rows
    before are led through these, where pointer doubling gives every row's outcome."""
    size = len(t)
    row = np.arange(size)
    step = nxt < size
    pointer, panes = np.where(step, nxt, row), np.ones(size, dtype=np.int64)
    while step.any():
        panes += np.where(step, panes[pointer], 0)
        step, pointer = step & step[pointer], pointer[pointer]
    exit_t, exit_rows = t[pointer], size - pointer
    if pieces is None:
        none = row[:0]
        pieces = {c: none for c in _PIECE[:-1]} | {"first_t": int(t[0]), "seen": 0, "over": False}
    else:
        at = np.full(len(pieces["exit_t"]), size)
        if n is not None:
            at = np.minimum(at, n - pieces["exit_rows"])
        if delay_us is not None:
            at = np.minimum(at, np.searchsorted(t, pieces["exit_t"] + delay_us, side="left"))
        on, to = at < size, np.minimum(at, size - 1)
        pieces = pieces | {"panes": pieces["panes"] + np.where(on, panes[to], 0), "exit_t": np.where(on, exit_t[to], pieces["exit_t"]),
                           "exit_rows": np.where(on, exit_rows[to], pieces["exit_rows"] + size)}
    if not pieces["over"]:
        # any pane that is open at the border began before it, so it is over at the latest
        # where one that opens with the first row is; without a bound it is never
        last = 0 if n is None and delay_us is None else size
        if n is not None:
            last = min(last, n - pieces["seen"])
        if delay_us is not None:
            last = min(last, int(np.searchsorted(t, pieces["first_t"] + delay_us, side="left")))
        row = row[:last + 1]
        more = {"last_row": pieces["seen"] + row, "last_t": t[row], "panes": panes[row], "exit_t": exit_t[row], "exit_rows": exit_rows[row]}
        pieces = pieces | {c: np.concatenate((pieces[c], x)) for c, x in more.items()} | {"over": last < size}
    cut = np.ones(len(pieces["panes"]), dtype=bool)
    cut[:-1] = np.logical_or.reduce([pieces[c][1:] != pieces[c][:-1] for c in ("panes", "exit_t", "exit_rows")])
    return pieces | {c: pieces[c][cut] for c in _PIECE[:-1]} | {"seen": pieces["seen"] + size}


def _composed(pdf: pd.DataFrame, n, delay_us) -> pd.DataFrame:
    """A key's slices in order: the pane open at each one's entry (start, rows, number)."""
    pdf = pdf.sort_values(["__slice", "last_row"])
    out, t, rows, pane = [], 0, 0, -1
    for slot, g in pdf.groupby("__slice", sort=True):
        if g["last_row"].iat[0] < 0:                    # the key's first slice
            t, rows, pane = int(g["exit_t"].iat[0]), int(g["exit_rows"].iat[0]), int(g["panes"].iat[0]) - 1
            continue
        out.append((g["__key"].iat[0], slot, t, rows, pane))
        size = int(g["size"].iat[0])
        at = len(g)                                     # the piece that holds the first start
        if delay_us is not None:
            at = min(at, int(np.searchsorted(g["last_t"].to_numpy(), t + delay_us, side="left")))
        if n is not None:
            at = min(at, int(np.searchsorted(g["last_row"].to_numpy(), n - rows, side="left")))
        if at == len(g):                                # none: the pane stays open throughout
            rows += size
        else:
            t, rows, pane = int(g["exit_t"].iat[at]), int(g["exit_rows"].iat[at]), pane + int(g["panes"].iat[at])
    return pd.DataFrame(out, columns=["__key", "__slice", "entry_t", "entry_rows", "entry_pane"])


def _rest_panes(batches, n, delay_us):
    """Heads that continue a key, from their entries; batches cut them anywhere."""
    slot = state = None
    for pdf in batches:
        for at, rows in pdf.groupby("__slice", sort=False):
            if at != slot:
                slot, state = at, tuple(int(rows[c].iat[0]) for c in _STATE)
            t, v, size = rows["__t"].to_numpy(), rows["__v"].to_numpy(), len(rows)
            out, state = _carried(t, v, _next(t, np.full(size, size), n, delay_us), state, n, delay_us)
            yield pd.DataFrame({"__key": rows["__key"].iat[0], **out})


def first_pane(df: DataFrame, keys, arrival_ts: str, value: str, delay_s: float) -> DataFrame:
    """``AfterProcessingTime(delay)`` fired once: per key, the rows arriving
    less than ``delay`` after the key's first row. Needs no sequential pass:
    the first arrival is a partial ``min`` per key, then a filter and a grouped
    sum, so a hot key stays spread over tasks.
    Output: keys, ``pane`` (0), ``pane_start``, ``pane_rows``, ``pane_value``."""
    k = _keys(keys)
    firsts = df.groupBy(*k).agg(F.min(arrival_ts).alias("pane_start"))
    within = ordered.join_back(df.select(*k, arrival_ts, value), firsts, k).filter(
        F.col(arrival_ts) < F.col("pane_start") + F.make_interval(secs=F.lit(delay_s)))
    return within.groupBy(*k, "pane_start").agg(
        F.count(F.lit(1)).alias("pane_rows"), F.sum(value).alias("pane_value")
    ).select(*k, F.lit(0).cast("bigint").alias("pane"), "pane_start", "pane_rows", "pane_value")
