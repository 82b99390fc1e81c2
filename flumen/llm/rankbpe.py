"""Byte-level BPE with a hierarchical-bitmap rank queue, and its decoder (operator 13).

Encoding a pre-token: its bytes form a linked list of parts. Every adjacent pair whose
text has a rank puts the position of its left part into the bucket of that rank. A bitmap
of two levels over the ranks marks the buckets that are not empty (a word has about as many
bits as there are words); find-first-set in the top word, then in the word that it names,
gives the lowest rank, however many ranks lie between. The
leftmost position of its bucket is merged, and the two pairs that the new part forms are
queued. An entry is stale, and is skipped, when the pair at its position has another rank
by then or is gone. A pre-token of n bytes thus costs O(n) queue steps (and a logarithm
for order within a bucket), where a search of all pairs before each merge would cost n
squared: a run of a million equal letters is no special case.

A merge may make a pair of lower rank than its own, since ranks belong to texts rather
than to pairs; the queue then goes back to that rank. A pre-token that is itself a token
is that token, whatever its merges would give. Each match of ``pattern`` is encoded
separately; special tokens are not looked for. Decoding gathers bytes by an offset table.

The vocabulary is fixed-size and read by each worker from ``path``, the place of a ranks
file (base64 of a token's bytes, a blank, its rank, per line) on the worker.

Nulls and empty texts have no tokens, and decode to no bytes. Texts of any length are
taken whole, pre-token by pre-token. Repeated rows are encoded alike; of equal ranks the
leftmost pair is merged first. An empty table gives an empty table. Other columns are not
read; ``encoded`` replaces a column of the name it adds.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache, partial
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import arrow_udf, replaced
from flumen.sources.tables import load

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
MEMO_WORDS = 400_000            # pre-tokens in each of the two generations that a worker remembers
MEMO_CHARS = 64                 # longer ones are not remembered


class Memo:
    """Pre-token -> (its ids as decimal text with a blank before each, its ids as 32-bit
    integers). Of two generations the older goes when the younger is full, so words that
    are met again stay."""

    def __init__(self, encode):
        outer = self

        class Young(dict):
            def __missing__(self, word):
                return outer.missed(word)

        self.encode, self.young, self.old = encode, Young(), {}

    def missed(self, word: str) -> tuple[str, bytes]:
        entry = self.old.get(word)
        if entry is None:
            ids = self.encode(word.encode("utf-8"))
            entry = ("".join([f" {i}" for i in ids]), array("i", ids).tobytes())
        if len(word) <= MEMO_CHARS:
            if len(self.young) >= MEMO_WORDS:
                self.old = dict(self.young)
                self.young.clear()
            self.young[word] = entry
        return entry


class Codec:
    """Tables of one ranks file."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        size = 1 + max(self.ranks.values())
        self.shift = max(6, (size.bit_length() + 1) // 2)
        self.bits = [1 << i for i in range(1 << self.shift)]        # also more than the words
        self.marks = [0] * ((size >> self.shift) + 1)
        self.buckets: dict[int, int | list[int]] = {}
        self.pattern = regex.compile(pattern)
        self.memo = Memo(self.encode_word)
        texts = [b""] * size
        for text, i in self.ranks.items():
            texts[i] = text
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-token. The queue is kept in local names: this is the inner
        loop. ``buckets`` holds a rank's position or, where there are several, a heap of
        them; ``marks`` has a bit per rank in words of ``1 << shift`` bits, ``top`` a bit
        per word that is not zero. All are empty again at the end."""
        rank_of, buckets, marks, shift, bits = self.ranks.get, self.buckets, self.marks, self.shift, self.bits
        whole = rank_of(word)
        if whole is not None:
            return [whole]
        n, top, low = len(word), 0, len(bits) - 1
        make = list if n <= MEMO_CHARS else partial(array, "q")     # 8 bytes a place
        after = make(range(1, n + 2))               # start of the next part; n: none
        before = make(range(-1, n))
        pair = make([-1]) * (n + 1)                 # rank of the pair from here on; -1: none
        queued = []                                 # (rank, position) to be put into the queue
        for i in range(n - 1):
            rank = rank_of(word[i:i + 2])
            if rank is not None:
                pair[i] = rank
                held = buckets.get(rank)
                if held is None:
                    buckets[rank] = i
                    marks[rank >> shift] |= bits[rank & low]
                    top |= bits[rank >> shift]
                elif type(held) is int:
                    buckets[rank] = [held, i]
                else:
                    held.append(i)                  # in order, so a heap
        while top:
            at = (top & -top).bit_length() - 1      # find first set, level by level
            marked = marks[at]
            first = marked & -marked
            rank = at << shift | first.bit_length() - 1
            i = buckets[rank]
            if type(i) is int or len(i) == 1:
                if type(i) is not int:
                    i = i[0]
                del buckets[rank]
                marks[at] = marked = marked ^ first
                if not marked:
                    top ^= bits[at]
            else:
                i = heappop(i)
            if pair[i] != rank:
                continue                            # stale
            gone = after[i]
            after[i] = end = after[gone]
            pair[gone] = pair[i] = -1
            if end < n:
                before[end] = i
                new = rank_of(word[i:after[end]])
                if new is not None:
                    pair[i] = new
                    queued.append((new, i))
            left = before[i]
            if left >= 0:
                new = rank_of(word[left:end])
                if new is None:
                    pair[left] = -1
                else:
                    pair[left] = new
                    queued.append((new, left))
            for rank, i in queued:
                held = buckets.get(rank)
                if held is None:
                    buckets[rank] = i
                    marks[rank >> shift] |= bits[rank & low]
                    top |= bits[rank >> shift]
                elif type(held) is int:
                    buckets[rank] = [held, i] if held < i else [i, held]
                else:
                    heappush(held, i)
            queued.clear()
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i:after[i]]])
            i = after[i]
        return ids

    def _entries(self, text: str) -> list[tuple[str, bytes]]:
        return list(map(self.memo.young.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([x[1] for x in self._entries(text)]), dtype=np.int32)

    def encode_shown(self, text: str) -> tuple[np.ndarray, str]:
        """The ids, and the same as decimal text joined by one blank."""
        found = self._entries(text)
        return np.frombuffer(b"".join([x[1] for x in found]), dtype=np.int32), "".join([x[0] for x in found])[1:]

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.offsets[ids] - (ends - size), size)
        return self.blob[at].tobytes()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str = PATTERN) -> Codec:
    """One codec per worker process and file."""
    return Codec(path, pattern)


def encode(text: str | Column, path: str = RANKS) -> Column:
    """Token ids of a text column as array<int>; null gives an empty array."""
    @arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        c, raw, ends = codec(path), bytearray(), [0]
        for x in column:
            raw += c.encode(x.as_py() or "").tobytes()
            ends.append(len(raw) // 4)
        ids = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(raw)])
        return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), ids)
    return run(text)


def decode(ids: str | Column, path: str = RANKS) -> Column:
    """The bytes of an array<int> column of ids; null gives none. They need not be UTF-8:
    a token may end inside a character."""
    @arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([c.decode(np.array(x.as_py() or [], dtype=np.int64)) for x in column], type=pa.binary())
    return run(ids)


def digests(text: str | Column, path: str = RANKS) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256): each text is encoded, its ids are
    decoded, and both are hashed without leaving the task."""
    @arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def run(column: pa.Array) -> pa.Array:
        c = codec(path)
        n, a, b = [], [], []
        for x in column:
            ids, shown = c.encode_shown(x.as_py() or "")
            n.append(len(ids))
            a.append(hashlib.sha256(shown.encode()).hexdigest())
            b.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, type=pa.int64()), pa.array(a, type=pa.string()), pa.array(b, type=pa.string())],
                                          names=["n_tokens", "ids_sha256", "decoded_sha256"])
    return run(text)


def encoded(docs: DataFrame, text_col: str = "text", path: str = RANKS) -> DataFrame:
    """``docs`` with the column ``token_ids``; a column of that name gives way."""
    return replaced(docs, token_ids=encode(F.col(f"`{text_col}`"), path))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: digests of every document's ids and of their decoded bytes."""
    docs = load(spark, sf_dir, "documents").select("doc_id", digests(F.col("text")).alias("d"))
    return docs.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
