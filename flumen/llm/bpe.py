"""Exact BPE encoding by backtracking, and decoding by an offset table (operator 8).

Encoding a word: an Aho-Corasick automaton of all tokens gives the longest token at
a position; the token is taken if the pair it forms with the token before it is
compatible (merging the two tokens' text on its own yields just these two tokens),
else the next shorter token that is a prefix of it is tried, else the token before
is given up and its next shorter prefix is tried. Positions that failed once are not
tried again, so the work is linear in the word. The result is that of applying the
merges in rank order. Decoding gathers each token's bytes from one blob by an offset
table and never touches Python objects per token.

Texts are split as the tokenizer file says (byte-level pattern, added tokens whole).
The vocabulary is fixed-size and read by each worker from ``path``, the place of a
``tokenizer.json`` (byte-level BPE) on the worker.

Nulls and empty texts have no tokens. Texts of any length are encoded word by word;
a word without a break may be long, too. Repeated rows are encoded alike. An empty table
gives an empty result; a column that clashes with the result's gives way.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import arrow_udf, replaced
from flumen.sources.tables import load

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MEMO_WORDS = 150_000            # words whose ids a worker remembers; then it starts afresh
MEMO_PAIRS = 400_000            # pairs of the compatibility table; then it starts afresh
MEMO_BYTES = 64                 # longer words are not remembered


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on, in byte order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Tables of one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        alphabet = byte_alphabet()
        raw = {t: bytes(alphabet[c] for c in t) for t in model["vocab"]}
        self.id_of = {raw[t]: i for t, i in model["vocab"].items()}
        self._text = {i: t for t, i in self.id_of.items()}
        # rank: 0 for single bytes, then the merges in order; parts of each merged token
        self.merge = {}             # (left id, right id) -> (rank, id)
        self.rank, self.parts = {i: 0 for i in self.id_of.values()}, {}
        for n, m in enumerate(model["merges"], 1):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b = raw[left], raw[right]
            i = self.id_of[a + b]
            self.merge[(self.id_of[a], self.id_of[b])] = (n, i)
            if i not in self.parts:
                self.rank[i], self.parts[i] = n, (self.id_of[a], self.id_of[b])
        self.added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added_id = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # tokens that the merges rebuild from their own text; no others can come out
        self.compatible: dict[int, bool] = {}
        self.whole = {t: (i,) for t, i in self.id_of.items() if len(t) == 1}
        for i, (a, b) in self.parts.items():        # in rank order: parts come first
            left, right = self._text[a], self._text[b]
            if left in self.whole and right in self.whole and self._fits(a, b, self.rank[i]):
                self.whole[left + right] = (i,)
        # the longest proper prefix of a token that is a token
        self.shorter, self.length = {}, {i: len(t) for t, (i,) in self.whole.items()}
        self.automaton = ahocorasick.Automaton()
        for text, (i,) in self.whole.items():
            self.shorter[i] = next((self.whole[text[:n]][0] for n in range(len(text) - 1, 0, -1) if text[:n] in self.whole), None)
            self.automaton.add_word(text.decode("latin-1"), i)
        self.automaton.make_automaton()
        # decoding: one blob and offsets, for added tokens too
        size = 1 + max([*self.id_of.values(), *self.added_id.values()])
        texts = [b""] * size
        for text, i in [*self.id_of.items(), *((t.encode(), i) for t, i in self.added_id.items())]:
            texts[i] = text
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.memo: dict[str, tuple[str, bytes]] = {}

    def _fits(self, left: int, right: int, below: float = float("inf")) -> bool:
        """Whether no merge of rank under ``below`` joins anything across the border
        of two tokens while these are built up from their bytes. The later-built of
        the two is taken apart at the border until both sides are single bytes; a
        pair of parts exists in the rank interval in which both of them stand."""
        until_left = until_right = below
        while True:
            found = self.merge.get((left, right))
            if found is not None and found[0] < (until_left if until_left < until_right else until_right):
                return False
            a, b = self.rank[left], self.rank[right]
            if a == 0 and b == 0:
                return True
            if a > b:
                until_left, left = a, self.parts[left][1]
            else:
                # of equal ranks the left one was built first; and what stands on the
                # right is merged after an equal pair across the border
                until_right, right = b + 1, self.parts[right][0]

    def fits(self, left: int, right: int) -> bool:
        """The pair-compatibility table, filled as pairs are met."""
        pair = left << 32 | right
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) >= MEMO_PAIRS:
                self.compatible.clear()
            known = self.compatible[pair] = self._fits(left, right)
        return known

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        whole = self.whole.get(word)
        if whole is not None:
            return whole
        text, size = word.decode("latin-1"), len(word)
        longest, length, shorter, fits = self.automaton.iter_long, self.length, self.shorter, self.fits
        ahead, known = longest(text), self.compatible
        last = next(ahead)[1]
        ids, at = [last], length[last]
        for _, token in ahead:              # as long as the longest token fits
            fit = known.get(last << 32 | token)
            if not (fits(last, token) if fit is None else fit):
                break
            ids.append(token)
            at += length[token]
            last = token
        else:
            return tuple(ids)
        dead = bytearray(size + 1)          # positions from which nothing worked
        while True:
            end = at + length[token]
            if not dead[end] and (not ids or fits(ids[-1], token)):
                ids.append(token)
                at = end
                if at == size:
                    return tuple(ids)
                if ahead is None:
                    ahead = longest(text, at)
                token = next(ahead)[1]
                continue
            ahead = None                    # off the greedy path
            token = shorter[token]
            while token is None:
                dead[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]

    def _remember(self, word: str) -> tuple[str, bytes]:
        ids = self.encode_word(word.encode("utf-8"))
        entry = (",".join(map(str, ids)), array("i", ids).tobytes())
        if len(word) <= MEMO_BYTES:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = entry
        return entry

    def _words(self, text: str):
        """Word entries in order; added tokens stand for themselves."""
        pieces = [text]
        if any(t in text for t in self.added):
            pieces = regex.split("(" + "|".join(map(regex.escape, self.added)) + ")", text)
        memo, make = self.memo, self._remember
        for n, piece in enumerate(pieces):
            if n % 2:
                i = self.added_id[piece]
                yield (str(i), array("i", [i]).tobytes())
            else:
                for w in self.pattern.findall(piece):
                    yield memo.get(w) or make(w)

    def encode_raw(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        return b"".join([x[1] for x in self._words(text)])

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """The ids, and the same as decimal text joined by commas."""
        found = list(self._words(text))
        return np.frombuffer(b"".join([x[1] for x in found]), dtype="<i4"), ",".join([x[0] for x in found])

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        return self.blob[at].tobytes().decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def encode(text: str | Column, path: str = TOKENIZER) -> Column:
    """Token ids of a text column as array<int>; null gives an empty array."""
    @arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        c, raw, ends = codec(path), bytearray(), [0]
        for x in column:
            raw += c.encode_raw(x.as_py() or "")
            ends.append(len(raw) // 4)
        ids = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(raw)])
        return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), ids)
    return run(text)


def decode(ids: str | Column, path: str = TOKENIZER) -> Column:
    """Text of an array<int> column of ids; null gives an empty text."""
    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([c.decode(np.array(x.as_py() or [], dtype=np.int64)) for x in column], type=pa.string())
    return run(ids)


def digests(text: str | Column, path: str = TOKENIZER) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256): each text is encoded, its ids are
    decoded, and both sides are hashed without leaving the task."""
    @arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def run(column: pa.Array) -> pa.Array:
        c = codec(path)
        n, a, b = [], [], []
        for x in column:
            ids, shown = c.encode(x.as_py() or "")
            n.append(len(ids))
            a.append(hashlib.sha256(shown.encode()).hexdigest())
            b.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, type=pa.int64()), pa.array(a, type=pa.string()), pa.array(b, type=pa.string())],
                                          names=["n_tokens", "ids_sha256", "decoded_sha256"])
    return run(text)


def encoded(docs: DataFrame, text_col: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``docs`` with the column ``token_ids``; a column of that name gives way."""
    return replaced(docs, token_ids=encode(F.col(text_col), path))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: digests of every document's ids and of their decoded text."""
    docs = load(spark, sf_dir, "documents").select("doc_id", digests(F.col("text")).alias("d"))
    return docs.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
