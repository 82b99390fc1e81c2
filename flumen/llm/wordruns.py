"""Periodic runs of words, found on a Re-Pair grammar (operator 11).

A run is a stretch of words with smallest period q (words q apart are identical) that no
neighbour extends keeping that period, at least ``copies`` periods and ``least`` words
long. All runs of a text are found, of every period, nested and overlapping ones too.

Grammar. Re-Pair replaces the pair of neighbouring symbols that occurs most often in its
text by a new nonterminal, until no pair occurs twice. Here a round replaces all pairs
that occur more often than those they overlap (ties: by a fixed hash), so independent pairs
go in one round, for all texts of a batch by the same array operations; the most frequent
pair of each text is always among them. What is left of a text, its start rule, becomes a
balanced tree of pairs.

Runs. A run lies across the boundary of the lowest node of the derivation that holds it
whole. One of its sides there has at least two periods, as four are asked for, so the
left side ends, or the right side begins, with a square of that period: squares of all
lengths are looked for at the boundary (by their words, then by fingerprints of both
halves) and extended to both sides within the node by binary search on fingerprints. A
nonterminal is treated once, at one of its occurrences; its runs are then translated to
all places where the derivation has it, going down only into rules that hold runs. Pieces
of a run that reach over a node's end are found whole further up: of the intervals of one
period only those stay that no other holds. An interval with several periods is a run of
the least.

Fingerprints are two polynomials modulo primes near 2^31, together 62 bits; words are
compared exactly. Work is O(n log n) a text for the tree, memory that of an Arrow batch
of bounded size, or of the longest text.

Nulls and empty texts have no words and no runs. Words are parted by ASCII white space
only. Very long texts are taken whole. Repeated rows are treated alike; ties for the
greatest run go to the smallest start, then the smallest period. An empty table gives an
empty table. Other columns are not read; ``with_runs`` replaces a column of the name it
adds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import SPACE, arrow_udf, mix, replaced, text_buffer
from flumen.sources.tables import load

COPIES, LEAST = 4, 6
PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
BASES = (1103515245, 1664525 * 613 % 2147483629)
STEP = 1 << 20                  # squares looked for in one round of array operations
EMPTY = np.zeros(0, dtype=np.int64)


# ---- words -------------------------------------------------------------------------

@dataclass
class Words:
    """Words of a batch of texts: number of each (equal words have equal numbers), its
    first byte and end in ``data``, and the texts' offsets in words."""
    code: np.ndarray
    first: np.ndarray
    end: np.ndarray
    offsets: np.ndarray
    data: np.ndarray

    def chosen(self, at: np.ndarray, offsets: np.ndarray) -> Words:
        """The words with the given numbers of place, as texts with these offsets."""
        return Words(self.code[at], self.first[at], self.end[at], offsets, self.data)


def words(column: pa.Array) -> Words:
    data, offsets = text_buffer(column)
    blank = SPACE[data]
    apart = np.ones(len(data) + 1, dtype=bool)          # no word goes on from byte i - 1 to byte i
    apart[1:-1] = blank[:-1] | blank[1:]
    apart[offsets] = True
    first, end = np.flatnonzero(~blank & apart[:-1]), np.flatnonzero(~blank & apart[1:]) + 1
    ends = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(end - first, out=ends[1:])
    raw = pa.py_buffer(np.ascontiguousarray(data[~blank]))
    shown = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), raw])
    code = shown.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(code, first, end, np.searchsorted(first, offsets), data)


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each range of the given size."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def joined(w: Words, keep: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The kept words of all texts, a blank after each, and the texts' offsets there."""
    first, size = w.first[keep], w.end[keep] - w.first[keep] + 1
    at = spread(first, size)
    ends = np.cumsum(size)
    out = w.data[np.minimum(at, max(0, len(w.data) - 1))] if len(w.data) else np.zeros(0, dtype=np.uint8)
    out[ends - 1] = 32
    counted = np.concatenate(([0], np.cumsum(keep)))[w.offsets]
    return memoryview(out), np.concatenate(([0], ends))[counted]


# ---- fingerprints ------------------------------------------------------------------

@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, ...]:
    out = []
    for p, base in zip(PRIMES, BASES):
        a, have, top = np.ones(n, dtype=np.uint64), 1, base
        while have < n:                 # a[have:2 * have] = a[:have] * base ** have
            a[have:2 * have] = a[:min(have, n - have)] * np.uint64(top) % p
            have, top = 2 * have, top * top % int(p)
        out.append(a)
    return tuple(out)


class Prints:
    """Tells equal stretches of a sequence of numbers in constant time."""

    def __init__(self, code: np.ndarray):
        self.powers = _powers(1 << max(12, len(code).bit_length()))
        x = mix(code.astype(np.uint64) + np.uint64(1))
        self.sums = []
        for p, power in zip(PRIMES, self.powers):
            h = np.zeros(len(code) + 1, dtype=np.uint64)
            np.cumsum(x % p * power[:len(code)] % p, out=h[1:])
            self.sums.append(h % p)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of this size from a and from b > a are equal."""
        out = np.ones(len(a), dtype=bool)
        for p, h, power in zip(PRIMES, self.sums, self.powers):
            out &= (h[a + size] + p - h[a]) % p * power[b - a] % p == (h[b + size] + p - h[b]) % p
        return out

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """For how many places, ``limit`` at most, the stretches from a and from b > a on are
        equal; ``back``: those that end before a and before b."""
        low, high = np.zeros(len(a), dtype=np.int64), limit.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            good = self.same(a - half, b - half, half) if back else self.same(a, b, half)
            low, high = np.where(good, half, low), np.where(good, high, half - 1)
        return low


# ---- grammar -----------------------------------------------------------------------

@dataclass
class Grammar:
    """Rules (left, right, words of each, place of one occurrence) numbered from ``base``;
    smaller numbers are words. The start rules' symbols with their places and texts."""
    base: int
    left: np.ndarray
    right: np.ndarray
    left_size: np.ndarray
    right_size: np.ndarray
    place: np.ndarray
    symbols: np.ndarray
    places: np.ndarray
    docs: np.ndarray


def re_pair(code: np.ndarray, offsets: np.ndarray) -> Grammar:
    """The texts' grammars. Texts share no rules: a pair counts in its own text."""
    n = len(code)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    # a symbol per word and text, so that equal pairs are pairs of one text
    symbol = np.unique(doc << 32 | code, return_inverse=True)[1].reshape(-1) if n else EMPTY
    base = int(symbol.max()) + 1 if n else 0
    size_of = np.ones(base, dtype=np.int64)
    place = np.arange(n)
    found, done, busy = [], [], symbol.copy()
    while len(busy) > 1:
        near = doc[1:] == doc[:-1]
        # of a symbol repeated, every other pair only: pairs must not overlap themselves
        twin = near & (busy[1:] == busy[:-1])
        since = np.arange(len(twin))
        start = np.maximum.accumulate(np.where(twin & ~np.concatenate(([False], twin[:-1])), since, -1))
        near &= ~(twin & ((since - start) % 2 == 1))
        # symbols that their text has once are in no pair twice
        many = np.bincount(busy, minlength=len(size_of)) > 1
        at = np.flatnonzero(near & many[busy[:-1]] & many[busy[1:]])
        pair, which, count = np.unique(busy[at] << 32 | busy[at + 1], return_inverse=True, return_counts=True)
        which = which.reshape(-1)
        rank = np.zeros(len(pair), dtype=np.int64)
        rank[np.lexsort((mix(pair.astype(np.uint64)), count))] = np.arange(1, len(pair) + 1)
        rank[count < 2] = 0
        prior = np.zeros(len(busy) + 1, dtype=np.int64)     # of the pair from i on, at i + 1
        prior[at + 1] = rank[which]
        mine = prior[at + 1]
        after = np.zeros(len(at), dtype=np.int64)
        inside = at + 2 < len(prior)
        after[inside] = prior[at[inside] + 2]
        take = (mine > 0) & (mine > prior[at]) & (mine > after)
        take &= (np.bincount(which[take], minlength=len(pair)) > 1)[which]
        if not take.any():
            break
        at, which = at[take], which[take]
        new, first, which = np.unique(which, return_index=True, return_inverse=True)
        left, right = pair[new] >> 32, pair[new] & 0xFFFFFFFF
        found.append((left, right, size_of[left], size_of[right], place[at[first]]))
        busy[at] = len(size_of) + which.reshape(-1)
        size_of = np.concatenate((size_of, size_of[left] + size_of[right]))
        stay = np.ones(len(busy), dtype=bool)
        stay[at + 1] = False
        # texts without a new rule are done
        active = np.zeros(len(offsets), dtype=bool)
        active[doc[at]] = True
        over = stay & ~active[doc]
        done.append((busy[over], place[over], doc[over]))
        stay &= active[doc]
        busy, place, doc = busy[stay], place[stay], doc[stay]
    done.append((busy, place, doc))
    symbols, places, docs = map(np.concatenate, zip(*done))
    order = np.argsort(places, kind="stable")
    rules = map(np.concatenate, zip(*found)) if found else [EMPTY] * 5
    return Grammar(base, *rules, symbols[order], places[order], docs[order])


def tree(g: Grammar, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, words of the left side, words of the right side) of the pairs of the balanced
    trees over the start rules; ``size``: words of each of their symbols."""
    out, place, doc = [], g.places, g.docs
    while True:
        # number within its text; pairs are (0, 1), (2, 3), ...
        start = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else EMPTY
        nth = np.arange(len(doc)) - np.repeat(start, np.diff(np.append(start, len(doc))))
        right = np.flatnonzero(nth % 2 == 1)
        if not len(right):
            return tuple(map(np.concatenate, zip(*out))) if out else (EMPTY, EMPTY, EMPTY)
        out.append((place[right - 1], size[right - 1], size[right]))
        size = size.copy()
        size[right - 1] += size[right]
        stay = nth % 2 == 0
        size, place, doc = size[stay], place[stay], doc[stay]


# ---- runs --------------------------------------------------------------------------

def _squares(code: np.ndarray, prints: Prints, at: np.ndarray, reach: np.ndarray, back: bool):
    """(number of the boundary, period) of the squares that end (back) or begin at the
    boundaries ``at``, of ``reach`` words at most for both halves."""
    boundary, period = [], []
    half = reach // 2
    ends = np.cumsum(half)
    cut = [0, *np.searchsorted(ends, np.arange(STEP, int(ends[-1]) if len(ends) else 0, STEP)).tolist(), len(at)]
    for a, b in zip(cut[:-1], cut[1:]):
        which = np.repeat(np.arange(a, b), half[a:b])
        q = spread(np.ones(b - a, dtype=np.int64), half[a:b])
        x = at[which]
        good = code[x - 1] == code[x - 1 - q] if back else code[x] == code[x + q]
        which, q, x = which[good], q[good], x[good]
        good = code[x - q] == code[x - 2 * q] if back else code[x + q - 1] == code[x + 2 * q - 1]
        which, q, x = which[good], q[good], x[good]
        good = prints.same(x - 2 * q, x - q, q) if back else prints.same(x, x + q, q)
        boundary.append(which[good])
        period.append(q[good])
    return np.concatenate(boundary), np.concatenate(period)


def crossing(code: np.ndarray, prints: Prints, place, left, right, copies: int, least: int):
    """Runs across the boundaries of nodes (place, words on the left, on the right), within
    their nodes: (number of the node, start, end, period)."""
    middle, end = place + left, place + left + right
    a, qa = _squares(code, prints, middle, left, True)
    b, qb = _squares(code, prints, middle, right, False)
    node, q = np.concatenate((a, b)), np.concatenate((qa, qb))
    x = np.concatenate((middle[a] - qa, middle[b]))
    stop = x + q + prints.common(x, x + q, end[node] - x - q)
    start = x - prints.common(x, x + q, x - place[node], back=True)
    long = stop - start >= np.maximum(least, copies * q)
    node, start, stop, q = node[long], start[long], stop[long], q[long]
    order = np.lexsort((q, stop, start, node))          # of one interval the least period
    node, start, stop, q = node[order], start[order], stop[order], q[order]
    new = np.ones(len(node), dtype=bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return node[new], start[new], stop[new], q[new]


def find_runs(code: np.ndarray, offsets: np.ndarray, copies: int = COPIES, least: int = LEAST):
    """(start, end, period) of all runs in a batch of texts, as places in ``code``, by start,
    then period. ``copies`` is 4 at least: then one side of a boundary holds a square."""
    if copies < 4:
        raise ValueError("runs of four periods or more only")
    g = re_pair(code, offsets)
    prints = Prints(code)
    rules = len(g.left)
    size = np.concatenate((np.ones(g.base, dtype=np.int64), g.left_size + g.right_size))
    # the start rules' own pairs stand where they are
    place, left, right = tree(g, size[g.symbols])
    _, start, stop, period = crossing(code, prints, place, left, right, copies, least)
    # a rule's runs, relative to its first word, and whether any rule below has some
    rule, low, high, q = crossing(code, prints, g.place, g.left_size, g.right_size, copies, least)
    low, high = low - g.place[rule], high - g.place[rule]
    edges = np.searchsorted(rule, np.arange(rules + 1))
    holds = np.zeros(g.base + rules, dtype=bool)
    holds[g.base + rule] = True
    more = holds[g.left] | holds[g.right] if rules else EMPTY.astype(bool)
    while (more & ~holds[g.base:]).any():
        holds[g.base:] |= more
        more = holds[g.left] | holds[g.right]
    # down the derivation, all occurrences of a depth at a time
    here, at = g.symbols, g.places
    while True:
        some = holds[here] if len(here) else EMPTY.astype(bool)
        here, at = here[some] - g.base, at[some]
        if not len(here):
            break
        n = edges[here + 1] - edges[here]
        which, base = spread(edges[here], n), np.repeat(at, n)
        start, stop, period = (np.concatenate((a, b)) for a, b in
                               ((start, low[which] + base), (stop, high[which] + base), (period, q[which])))
        here, at = np.concatenate((g.left[here], g.right[here])), np.concatenate((at, at + g.left_size[here]))
    # of one period, intervals that no other holds
    order = np.lexsort((-stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    reach = period * (len(code) + 1) + stop
    new = np.ones(len(start), dtype=bool)
    new[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    start, stop, period = start[new], stop[new], period[new]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def kept(n: int, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, stop, -1)
    return np.cumsum(change)[:n] == 0


# ---- columns -----------------------------------------------------------------------

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = (f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>")


def runs(text: str | Column, copies: int = COPIES, least: int = LEAST) -> Column:
    """struct(n_words, runs, collapsed): the runs of a text column by start and period, and
    the words that stay, joined by one blank, when every run is cut to its first period."""
    @arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        w = words(column)
        start, stop, period = find_runs(w.code, w.offsets, copies, least)
        doc = np.searchsorted(w.offsets, start, side="right") - 1
        shown, at = joined(w, kept(len(w.code), start, stop, period))
        found = pa.StructArray.from_arrays([pa.array(start - w.offsets[doc]), pa.array(stop - start), pa.array(period)], names=["start", "length", "period"])
        edges = pa.array(np.searchsorted(doc, np.arange(len(w.offsets))).astype(np.int32))
        texts = [bytes(shown[a:max(a, b - 1)]).decode("utf-8", errors="replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.StructArray.from_arrays([pa.array(np.diff(w.offsets)), pa.ListArray.from_arrays(edges, found), pa.array(texts, type=pa.string())],
                                          names=["n_words", "runs", "collapsed"])
    return run(text)


def with_runs(docs: DataFrame, text_col: str = "text", copies: int = COPIES, least: int = LEAST) -> DataFrame:
    """``docs`` with the column ``word_runs`` (see :func:`runs`); one of that name gives way."""
    return replaced(docs, word_runs=runs(F.col(f"`{text_col}`"), copies, least))


# ---- the registered query ----------------------------------------------------------

def looped(w: Words, h: np.ndarray) -> Words:
    """The words with a loop put into every text whose number h ends in 0: from word
    a = g mod n on, words repeat those from a on with period p, where g = h div 10 and
    p = 1 + (n - a) div (3 + g mod 8)."""
    n = np.diff(w.offsets)
    which = np.flatnonzero((h % 10 == 0) & (n > 0))
    if not len(which):
        return w
    g, n, base = h[which] // 10, n[which], w.offsets[which]
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(len(w.code))
    i = spread(np.zeros(len(n), dtype=np.int64), n - a)
    first = np.repeat(base + a, n - a)
    at[first + i] = first + i % np.repeat(p, n - a)
    return w.chosen(at, w.offsets)


DIGEST = ("struct<n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,"
          "runs_sha256:string,collapsed_sha256:string>")


def digests(text: str | Column, h: str | Column) -> Column:
    """The contract's columns of a text column and its rows' numbers h."""
    @arrow_udf(DIGEST)
    def run(column: pa.Array, numbers: pa.Array) -> pa.Array:
        w = looped(words(column), numbers.to_numpy(zero_copy_only=False).astype(np.int64))
        start, stop, period = find_runs(w.code, w.offsets)
        doc = np.searchsorted(w.offsets, start, side="right") - 1
        shown, at = joined(w, kept(len(w.code), start, stop, period))
        at = at.tolist()
        edges = np.searchsorted(doc, np.arange(len(w.offsets)))
        local, length = start - w.offsets[doc], stop - start
        rows, none = [], hashlib.sha256().hexdigest()
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            sha = hashlib.sha256(shown[at[i]:max(at[i], at[i + 1] - 1)]).hexdigest()
            if a == b:
                rows.append((0, None, None, None, None, none, sha))
                continue
            s, k, q = local[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist()
            top = max(range(b - a), key=lambda j: (k[j], -s[j], -q[j]))
            text = "".join([f"{x},{y},{z}\n" for x, y, z in zip(s, k, q)])
            rows.append((b - a, s[top], k[top], q[top], 1000 * k[top] // q[top], hashlib.sha256(text.encode()).hexdigest(), sha))
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        return pa.StructArray.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)],
                                          names=["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
    return run(text, h)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: runs of every document, a tenth of them with a loop put in by its id (a null id
    puts none)."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    found = docs.select("doc_id", digests(F.col("text"), h).alias("d"))
    return found.select("doc_id", "d.n_runs", "d.start", "d.length", "d.period", "d.exponent_milli", "d.runs_sha256", "d.collapsed_sha256")
