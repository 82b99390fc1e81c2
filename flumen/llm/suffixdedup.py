"""Removal of byte strings that repeat, by a logarithmic family of suffix arrays
(operator 1).

Removed is every byte that a string of ``length`` bytes covers which also starts
anywhere else in the corpus, the same document included; all strings are judged on the
input. Matches do not cross documents.

Sampling. Of the ``length - anchor + 1`` positions where an ``anchor``-byte prefix fits
into a window of ``length`` bytes, the one with the smallest fingerprint (of equals the
first) is the window's anchor. It depends on the window's bytes alone, so equal windows
have their anchor at the same place. A run of windows with one anchor is a *span*; a
suffix array lists one suffix per span, that from its anchor, in the order of the
fingerprint of its first ``anchor`` bytes. Suffixes that share these bytes are then
neighbours, as in a lexicographic array, and no string is moved to sort them. An entry
holds for one such prefix the number of suffixes and the least and greatest
fingerprint of their spans.

Family. Each batch of documents gets its array (level 0). It is merge-scanned with the
arrays of all existing levels; prefixes that are met again, in the batch or in a level,
are noted as long matches to look at. Then, as long as two levels have equal rank, they
are merged into one of the next rank; so there are at most log2(batches) + 1 levels.

Matches. Where all spans of a prefix are one and the same string, all their windows
repeat. Where they differ, equal spans are counted; a span that occurs once, and one
representative of each that occurs more often, send the fingerprints of their windows,
and windows that are met twice repeat. Fingerprints of strings count as equal on 96
bits or more together with those of their prefix.

Scale. Every step is a pass over the texts in which tasks count distinct entries and
send them, packed, to shards by hash range, so a prefix, line or passage that a third
of all documents hold is one entry per task. Arrays are files in the shared folder,
memory-mapped by workers; the texts themselves are never shuffled. The number of shards
is the session's ``spark.sql.shuffle.partitions``.

Units. ``unit="words"`` judges runs of ``length`` whole words (parted by ASCII white space,
whatever its amount) in the same way: a word is a 64-bit code, and what is removed goes
from the first byte of a run's first word to the last byte of its last.

Nulls: a null text is empty; a null id takes part like any other. Texts shorter than
``length`` stay whole. Texts are handled in pieces of bounded size. Repeated rows are
documents like any other: each repeats the other. An empty table has no matches and gives
an empty result. Only the id and the text are read; ``deduplicated`` keeps other columns,
whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import BYTE_CODES, SPACE, arrow_udf, doc_of, mix, powers, prefix_hash, span_hash, text_buffer
from flumen.llm.hasharrays import by_shard, dealt, find, held, mapped, mounted, planes, save, unplaned
from flumen.sources.tables import load

_FACTOR = np.uint64(0x9FB21C651E98DF25)
_LOW = np.uint64((1 << 22) - 1)
U32 = np.uint64(32)
STEP = 1 << 18                      # windows handled by one round of array operations, under 2 ** 22


@dataclass(frozen=True)
class Settings:
    length: int = 400               # 2 at least
    anchor: int = 200
    batches: int = 4
    unit: str = "bytes"             # or "words": of length and anchor


#: Passages of over 50 words; 400 bytes alone would leave most of 51 to 62 words.
PASSAGE = Settings(length=51, anchor=12, unit="words")


# ---- units of a text ---------------------------------------------------------------

def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code of each word, the documents' offsets in words, first byte, end) of a buffer."""
    blank = SPACE[data]
    apart = np.ones(len(data) + 1, dtype=bool)          # no word goes on from byte i - 1 to byte i
    apart[1:-1] = blank[:-1] | blank[1:]
    apart[offsets] = True
    first, end = np.flatnonzero(~blank & apart[:-1]), np.flatnonzero(~blank & apart[1:]) + 1
    code = np.zeros(len(first), dtype=np.uint64)
    for at in range(0, len(data), STEP):                # a word may go over several pieces
        stop = min(len(data), at + STEP)
        which = np.arange(np.searchsorted(end, at, side="right"), np.searchsorted(first, stop, side="left"))
        if len(which):
            low = np.maximum(first[which], at)
            size = np.minimum(end[which], stop) - low
            row = np.cumsum(size) - size
            byte = np.arange(size.sum()) + np.repeat(low - row, size)
            place = (byte - np.repeat(first[which], size) + 1).astype(np.uint64)
            code[which] += np.add.reduceat(mix(BYTE_CODES[data[byte]] + place * _FACTOR), row)
    return mix(code), np.searchsorted(first, offsets), first, end


def units(column: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The bytes or the words' codes of a text column, and the documents' offsets in them."""
    data, offsets = text_buffer(column)
    return (data, offsets) if s.unit == "bytes" else words_of(data, offsets)[:2]


# ---- spans of a text ---------------------------------------------------------------

def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``x[i:i + width]`` for every i, by doubling."""
    n, size = len(x) - width + 1, 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[width - size:width - size + n])


@dataclass
class Spans:
    """Spans of one piece of a buffer. first and last: their windows' starts in it."""
    at: int
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray             # fingerprint of the anchor's bytes
    print: np.ndarray           # fingerprint of the whole span
    hashes: np.ndarray          # prefix hashes of the piece


def _inside(offsets: np.ndarray, at: int, n: int, length: int) -> np.ndarray:
    """Which of n window starts from ``at`` on keep their window in one document."""
    low = np.clip(offsets[:-1] - at, 0, n)
    high = np.maximum(np.clip(offsets[1:] - length + 1 - at, 0, n), low)
    change = np.bincount(low, minlength=n + 1) - np.bincount(high, minlength=n + 1)
    return np.cumsum(change[:n], dtype=np.int32) > 0


def spans(data: np.ndarray, offsets: np.ndarray, s: Settings) -> Iterator[Spans]:
    inverse = powers(STEP + s.length)[1]
    for at in range(0, max(0, len(data) - s.length + 1), STEP):
        part = data[at:at + STEP + s.length - 1]
        n = len(part) - s.length + 1
        h = prefix_hash(part)
        order = h[s.anchor:] - h[:-s.anchor]
        order *= inverse[:len(order)]
        order ^= order >> U32
        order *= _FACTOR
        # the low bits give way to the position: of equal fingerprints the first wins
        order &= ~_LOW
        order |= np.arange(len(order), dtype=np.uint64)
        own = (sliding_min(order, s.length - s.anchor + 1)[:n] & _LOW).astype(np.int32)
        whole = _inside(offsets, at, n, s.length)
        # documents' windows never stand side by side: the last of one lies `length` before the next
        new = whole.copy()
        new[1:] &= (own[1:] != own[:-1]) | ~whole[:-1]
        end = whole.copy()
        end[:-1] &= (own[1:] != own[:-1]) | ~whole[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(end)
        if len(first):
            anchor = own[first].astype(np.int64)
            yield Spans(at, doc_of(offsets, first + at), first, last, mix(span_hash(h, anchor, anchor + s.anchor)),
                        span_hash(h, first, last + s.length), h)


def chunks(data: np.ndarray, offsets: np.ndarray, s: Settings, at_once: int = 8) -> Iterator[list[Spans]]:
    """Pieces in groups, so that a group's entries are looked up together."""
    found = []
    for p in spans(data, offsets, s):
        found.append(p)
        if len(found) == at_once:
            yield found
            found = []
    if found:
        yield found


def windows(p: Spans, which: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, row of ``which``, hash, check) of all windows of some spans."""
    size = p.last[which] - p.first[which] + 1
    row = np.repeat(np.arange(len(which)), size)
    start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + p.first[which][row]
    own = span_hash(p.hashes, start, start + s.length)
    key = p.key[which][row]
    return start, row, mix(key * _FACTOR + own), (mix(own + _FACTOR) ^ key) >> U32


# ---- entries of the arrays ---------------------------------------------------------

def gathered(key: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys with sums of n, least low and greatest high."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    if not len(at):
        return [key, n, low, high]
    return [key[at], np.add.reduceat(n[order], at), np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)]


def _save(stem: str, **columns: np.ndarray) -> None:
    for name in sorted(columns, key=lambda c: c == "key"):          # the keys last: they say that all is there
        save(f"{stem}.{name}.npy", np.ascontiguousarray(columns[name]))


def _load(stem: str, *names: str) -> list[np.ndarray] | None:
    if mapped(f"{stem}.key.npy") is None:
        return None
    return [np.asarray(mapped(f"{stem}.{n}.npy")) for n in names]


ENTRY = ("key", "n", "low", "high")


class Family:
    """The levels of one index: [(rank, number)], the newest last. Arrays are files
    ``level-<number>-<shard>``; ``met-<batch>-<shard>`` are the prefixes that a batch
    met again, with all that was known of them by then; ``met-<shard>`` is their sum."""

    def __init__(self, spark, settings: Settings = Settings()):
        self.settings, self.shards = settings, int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = mounted(spark, "suffixes")
        self.levels: list[tuple[int, int]] = []
        self.added, self.made = 0, 0

    def add(self, texts: DataFrame) -> int:
        """Index a batch, given as one text column, and scan it against the family;
        the number of prefixes met again."""
        s, shards, folder = self.settings, self.shards, self.folder
        levels, batch, number = list(self.levels), self.added, self.made
        # equal ranks from the newest level down are merged with the new array
        rank, merging = 0, []
        while len(merging) < len(levels) and levels[len(levels) - 1 - len(merging)][0] == rank:
            merging.append(levels[len(levels) - 1 - len(merging)][1])
            rank += 1

        def entries(batches):
            for b in batches:
                data, offsets = units(b.column(0), s)
                parts = [gathered(p.key, np.ones(len(p.key), dtype=np.int64), p.print, p.print) for p in spans(data, offsets, s)]
                if not parts:
                    continue
                key, n, low, high = gathered(*[np.concatenate([x[i] for x in parts]) for i in range(4)])
                rows = [(sh, planes(key[c]), planes(n[c].astype("<u4")), planes(low[c]), planes(low[c] ^ high[c])) for sh, c in by_shard(key, shards)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], type=pa.int32())] + [pa.array([r[i] for r in rows], type=pa.binary()) for i in range(1, 5)], names=["shard", "key", "n", "low", "apart"])

        def scan(batches):
            os.makedirs(folder, exist_ok=True)
            blocks = held(batches)
            for shard in blocks:
                join = lambda i, kind: np.concatenate([unplaned(x[i], kind) for x in blocks[shard]])
                low = join(2, "<u8")
                new = gathered(join(0, "<u8"), join(1, "<u4").astype(np.int64), low, low ^ join(3, "<u8"))
                known = [new]
                for _, level in levels:
                    old = _load(f"{folder}/level-{level}-{shard}", *ENTRY)
                    if old is not None:
                        # the scan of two sorted arrays: what the level holds of the batch's prefixes
                        at = np.minimum(np.searchsorted(old[0], new[0]), len(old[0]) - 1)
                        known.append([c[at[old[0][at] == new[0]]] for c in old])
                met = gathered(*[np.concatenate([k[i] for k in known]) for i in range(4)])
                again = met[1] >= 2
                _save(f"{folder}/met-{batch}-{shard}", **{c: v[again] for c, v in zip(ENTRY, met)})
                _save(f"{folder}/level-{number}-{shard}", **dict(zip(ENTRY, new)))
                yield pa.RecordBatch.from_arrays([pa.array([int(again.sum())])], names=["met"])

        got = dealt(texts.mapInArrow(entries, "shard int, key binary, n binary, low binary, apart binary"), shards, scan, "met long")
        self.added, self.made = batch + 1, number + 1
        self.levels.append((0, number))
        if merging:
            self._merge([number, *merging], rank, texts.sparkSession)
        return sum(r["met"] for r in got)

    def _merge(self, numbers: list[int], rank: int, spark) -> None:
        """One array of the next rank in place of several levels, shard by shard."""
        folder, number = self.folder, self.made

        def merge(batches):
            for b in batches:
                for shard in b.column(0).to_pylist():
                    parts = [p for p in (_load(f"{folder}/level-{x}-{shard}", *ENTRY) for x in numbers) if p is not None]
                    if parts:
                        _save(f"{folder}/level-{number}-{shard}", **dict(zip(ENTRY, gathered(*[np.concatenate([p[i] for p in parts]) for i in range(4)]))))
                    yield pa.RecordBatch.from_arrays([pa.array([shard])], names=["shard"])
        spark.range(0, self.shards, 1, self.shards).mapInArrow(merge, "shard long").count()
        self.made = number + 1
        self.levels = [x for x in self.levels if x[1] not in numbers] + [(rank, number)]

    def settle(self, spark) -> None:
        """Put what the scans met together, one array a shard."""
        folder, batches = self.folder, range(self.added)

        def merge(rows):
            for b in rows:
                for shard in b.column(0).to_pylist():
                    parts = [p for p in (_load(f"{folder}/met-{x}-{shard}", *ENTRY) for x in batches) if p is not None]
                    if parts:
                        key, n, low, high = [np.concatenate([p[i] for p in parts]) for i in range(4)]
                        # a scan's sums hold those of the scans before it: the greatest is the last
                        order = np.lexsort((n, key))
                        last = np.concatenate((key[order][1:] != key[order][:-1], [True]))
                        _, _, low, high = gathered(key, n, low, high)
                        _save(f"{folder}/met-{shard}", key=key[order][last], n=n[order][last], low=low, high=high)
                    yield pa.RecordBatch.from_arrays([pa.array([shard])], names=["shard"])
        spark.range(0, self.shards, 1, self.shards).mapInArrow(merge, "shard long").count()

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n, low, high) of sorted prefixes as the scans met them; n is 0 for those
        that occur once."""
        n, low, high = (np.zeros(len(keys), dtype=k) for k in (np.int64, np.uint64, np.uint64))
        for part, stem, at, there in find(self.folder, "met", keys, self.shards):
            for out, name in ((n, "n"), (low, "low"), (high, "high")):
                out[part] = np.where(there, mapped(f"{stem}.{name}.npy")[at], 0)
        return n, low, high


# ---- matches -----------------------------------------------------------------------

def _asked(parts: list[np.ndarray], look) -> list[list[np.ndarray]]:
    """``look`` asked once for the distinct sorted keys of several arrays; its answers
    for each of them, in their order."""
    found, back = np.unique(np.concatenate(parts), return_inverse=True)
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return list(zip(*[np.split(answer[back], cuts) for answer in look(found)]))


@dataclass
class Matches:
    """What the passes found, for looking spans and windows of texts up."""
    family: Family

    def spans(self, group: list[Spans]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per piece, of each span: whether its prefix repeats with this string alone,
        and whether it repeats with several."""
        return [((n >= 2) & (low == high), (n >= 2) & (low != high))
                for n, low, high in _asked([p.key for p in group], self.family.lookup)]

    def counts(self, group: list[Spans], which: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per piece: (occurrences, origin of the representative) of spans of mixed
        prefixes."""
        f = self.family

        def look(keys):
            n, origin = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.uint64)
            for part, stem, at, there in find(f.folder, "span", keys, f.shards):
                n[part] = np.where(there, mapped(stem + ".n.npy")[at], 0)
                origin[part] = np.where(there, mapped(stem + ".origin.npy")[at], 0)
            return n, origin
        return _asked([mix(p.key[w] * _FACTOR + p.print[w]) for p, w in zip(group, which)], look)

    def repeated(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Whether windows, given by hash and check, occur twice or more."""
        f = self.family

        def look(keys):
            check, many = np.zeros(len(keys), dtype=np.uint64), np.zeros(len(keys), dtype=bool)
            for part, stem, at, there in find(f.folder, "window", keys, f.shards):
                check[part] = mapped(stem + ".check.npy")[at]
                many[part] = there
            return check, many
        (check, many), = _asked([hashes], look)
        return many & (check == checks)

    def ranges(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal removed runs of a buffer of bytes, as sorted starts and ends; a run is
        cut where a document ends."""
        if self.family.settings.unit == "bytes":
            return joined(*self._runs(data, offsets), offsets)
        code, places, first, end = words_of(data, offsets)
        a, z = self._runs(code, places)
        return joined(first[a], end[z - 1], offsets)

    def _runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends in units, in any order; they may overlap."""
        s, starts, ends = self.family.settings, [], []
        for group in chunks(data, offsets, s):
            found = self.spans(group)
            which = [np.flatnonzero(mixed) for _, mixed in found]
            open_at, h, check = [], [], []
            for p, (sole, _), w, (n, _) in zip(group, found, which, self.counts(group, which)):
                whole = np.concatenate((np.flatnonzero(sole), w[n >= 2]))
                starts.append(p.first[whole] + p.at)
                ends.append(p.last[whole] + p.at + s.length)
                at, _, own, sign = windows(p, w[n < 2], s)
                open_at.append(at + p.at)
                h.append(own)
                check.append(sign)
            again = np.concatenate(open_at)[self.repeated(np.concatenate(h), np.concatenate(check))]
            starts.append(again)
            ends.append(again + s.length)
        if not starts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(starts), np.concatenate(ends)


def joined(start: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs that overlap or touch as one; a run is cut where a document ends."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(order) else end
    if not len(start):
        return start, end
    doc = doc_of(offsets, start)
    new = np.concatenate(([True], (start[1:] > end[:-1]) | (doc[1:] != doc[:-1])))
    return start[new], end[np.append(np.flatnonzero(new)[1:], len(start)) - 1]


def origin_of(p: Spans, which: np.ndarray, names: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a span stands, by its document's name: the least one is the representative."""
    doc = p.doc[which]
    return mix(names[doc] + (p.first[which] + p.at - offsets[doc]).astype(np.uint64) * _FACTOR)


def _identity(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def match(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> Matches:
    """Index all documents, batch by batch, and find the repeated windows."""
    family = Family(docs.sparkSession, settings)
    matches, shards, folder = Matches(family), family.shards, family.folder
    rows = docs.select(F.col(text_col).cast("string").alias("text"), _identity(id_col, text_col).alias("name"))
    for i in range(settings.batches):
        family.add(rows.where(F.pmod("name", F.lit(settings.batches)) == i).select("text"))
    family.settle(docs.sparkSession)

    def mixed_spans(batches):
        for b in batches:
            data, offsets = units(b.column(0), settings)
            names, parts = b.column(1).to_numpy().view(np.uint64), []
            for group in chunks(data, offsets, settings):
                for p, (_, mixed) in zip(group, matches.spans(group)):
                    w = np.flatnonzero(mixed)
                    origin = origin_of(p, w, names, offsets)
                    parts.append(gathered(mix(p.key[w] * _FACTOR + p.print[w]), np.ones(len(w), dtype=np.int64), origin, origin))
            if parts:
                key, n, origin, _ = gathered(*[np.concatenate([x[i] for x in parts]) for i in range(4)])
                out = [(sh, planes(key[c]), planes(n[c].astype("<u4")), planes(origin[c])) for sh, c in by_shard(key, shards)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], type=pa.int32())] + [pa.array([r[i] for r in out], type=pa.binary()) for i in range(1, 4)], names=["shard", "key", "n", "origin"])

    def write_spans(batches):
        os.makedirs(folder, exist_ok=True)
        for shard, blocks in held(batches).items():
            join = lambda i, kind: np.concatenate([unplaned(x[i], kind) for x in blocks])
            origin = join(2, "<u8")
            key, n, origin, _ = gathered(join(0, "<u8"), join(1, "<u4").astype(np.int64), origin, origin)
            _save(f"{folder}/span-{shard}", key=key, n=n, origin=origin)
            yield pa.RecordBatch.from_arrays([pa.array([len(key)])], names=["size"])

    dealt(rows.mapInArrow(mixed_spans, "shard int, key binary, n binary, origin binary"), shards, write_spans, "size long")

    def open_windows(batches):
        for b in batches:
            data, offsets = units(b.column(0), settings)
            names, parts = b.column(1).to_numpy().view(np.uint64), []
            for group in chunks(data, offsets, settings):
                which = [np.flatnonzero(mixed) for _, mixed in matches.spans(group)]
                for p, w, (n, chosen) in zip(group, which, matches.counts(group, which)):
                    asked = (n < 2) | (origin_of(p, w, names, offsets) == chosen)
                    _, row, h, check = windows(p, w[asked], settings)
                    # the representative speaks for all its copies
                    parts.append((h, check.astype("<u4"), np.where(n[asked] >= 2, 2, 1).astype(np.uint8)[row]))
            if parts:
                h, check, n = [np.concatenate([x[i] for x in parts]) for i in range(3)]
                order = np.argsort(h, kind="stable")
                h, check, n = h[order], check[order], n[order]
                out = [(sh, planes(h[c]), planes(check[c]), n[c].tobytes()) for sh, c in by_shard(h, shards)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], type=pa.int32())] + [pa.array([r[i] for r in out], type=pa.binary()) for i in range(1, 4)], names=["shard", "hash", "check", "n"])

    def write_windows(batches):
        os.makedirs(folder, exist_ok=True)
        for shard, blocks in held(batches).items():
            join = lambda i, kind: np.concatenate([unplaned(x[i], kind) for x in blocks])
            h, check, n = join(0, "<u8"), join(1, "<u4").astype(np.uint64), join(2, "|u1")
            order = np.lexsort((check, h))
            h, check, n = h[order], check[order], n[order].astype(np.int64)
            at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])))) if len(h) else np.zeros(0, dtype=np.int64)
            many = at[np.add.reduceat(n, at) >= 2] if len(at) else at
            _save(f"{folder}/window-{shard}", key=h[many], check=check[many])
            yield pa.RecordBatch.from_arrays([pa.array([len(many)])], names=["size"])

    dealt(rows.mapInArrow(open_windows, "shard int, hash binary, check binary, n binary"), shards, write_windows, "size long")
    return matches


# ---- results -----------------------------------------------------------------------

def _kept(column: pa.Array, *matches: Matches):
    """Per document: its bytes, its removed runs (of any of the matches) as (start, end)
    in it."""
    data, offsets = text_buffer(column)
    found = [m.ranges(data, offsets) for m in matches]
    start, end = joined(*map(np.concatenate, zip(*found)), offsets) if len(found) > 1 else found[0]
    doc = doc_of(offsets, start)
    edges = np.searchsorted(doc, np.arange(len(offsets)))
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        base = int(offsets[i])
        yield data[base:int(offsets[i + 1])], (start[a:b] - base).tolist(), (end[a:b] - base).tolist()


def digests(text: str | Column, matches: Matches) -> Column:
    """struct(n_bytes, n_removed, n_spans, kept_sha256) of a text column."""
    @arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def run(column: pa.Array) -> pa.Array:
        size, removed, runs, sha = [], [], [], []
        for raw, starts, ends in _kept(column, matches):
            h, at = hashlib.sha256(), 0
            for a, b in zip(starts, ends):
                h.update(raw[at:a])
                at = b
            h.update(raw[at:])
            size.append(len(raw))
            removed.append(sum(ends) - sum(starts))
            runs.append(len(starts))
            sha.append(h.hexdigest())
        return pa.StructArray.from_arrays([pa.array(size, type=pa.int64()), pa.array(removed, type=pa.int64()), pa.array(runs, type=pa.int64()), pa.array(sha, type=pa.string())],
                                          names=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run(text)


def covered(text: str | Column, matches: Matches) -> Column:
    """struct(n_bytes, n_runs): how much of a text column repeats, and in how many runs."""
    @arrow_udf("struct<n_bytes:bigint,n_runs:bigint>")
    def run(column: pa.Array) -> pa.Array:
        found = [(sum(ends) - sum(starts), len(starts)) for _, starts, ends in _kept(column, matches)]
        return pa.StructArray.from_arrays([pa.array([x[i] for x in found], type=pa.int64()) for i in (0, 1)], names=["n_bytes", "n_runs"])
    return run(text)


def kept_text(text: str | Column, *matches: Matches) -> Column:
    """The remaining text, without the runs of any of the matches. Runs are byte strings: of a character that is cut in two, the
    part that is left goes, too."""
    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for raw, starts, ends in _kept(column, *matches):
            # each kept part is decoded on its own, so that two halves do not join
            out.append("".join(raw[a:b].tobytes().decode("utf-8", errors="ignore") for a, b in zip([0, *ends], [*starts, len(raw)])))
        return pa.array(out, type=pa.string())
    return run(text)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), *more: Settings) -> DataFrame:
    """``docs`` with the repeated strings taken out of their texts (null: empty). Those of
    several settings are all judged on the input."""
    matches = [match(docs, id_col, text_col, s) for s in (settings, *more)]
    return docs.withColumn(text_col, kept_text(F.col(text_col), *matches))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: what is removed from every document, and the digest of what is kept; behind
    that, the bytes and the number of its runs of over 50 words that repeat, however few
    their bytes."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    matches, passages = match(docs), match(docs, settings=PASSAGE)
    found = docs.select("doc_id", digests(F.col("text"), matches).alias("d"), covered(F.col("text"), passages).alias("p"))
    return found.select("doc_id", "d.n_bytes", "d.n_removed", "d.n_spans", "d.kept_sha256",
                        F.col("p.n_bytes").alias("n_passage_bytes"), F.col("p.n_runs").alias("n_passages"))
