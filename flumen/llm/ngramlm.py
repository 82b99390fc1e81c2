"""Language-model scoring: interpolated modified Kneser-Ney of any order (operator 9).

Words are runs of bytes other than white space, A-Z lower-cased; a text's last token
is its end, and the context of its first is begin marks. The model is counted in
Spark and stored as sorted hash arrays in the shared folder, cut by hash range into
shards that workers memory-map:

1. N-grams of the highest order. Each task counts its distinct n-grams as 64-bit hashes
   and sends each shard one packed block; a shard merges its blocks and writes the
   sorted hashes and their counts.
2. Each lower order, down to words. Tasks look the counts ``c`` of their own n-grams of
   the order above up again. Per occurrence, such an n-gram adds ``1 / c`` to the number
   of distinct contexts of its last words, and to its context (all but the last word) the
   same share of its own number and of its discount; so neither a frequent word nor a
   frequent context ever gathers its n-grams in one place. Shards sum the tasks' distinct
   entries and write the sorted table of that order.
3. Scoring. Tasks look n-grams of all orders up by binary search and sum each text's
   log10 probabilities.

What a shard holds is a share of the corpus's distinct pairs: the number of shards is
the session's ``spark.sql.shuffle.partitions``. The shared folder must be mounted
where the workers run, as memory-mapping needs a file. A file is written under another
name and renamed, so a task that runs again replaces it whole.

Nulls: a null text is empty (one token, its end); a null id counts as empty text in
the fold. Texts are handled in pieces of bounded size, cut at white space. Without any
training text every probability is 1 / (V + 1) = 1. Repeated rows count repeatedly. An
empty table gives an empty result. Columns of ``docs`` are read by name; those that clash
with the result's give way.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import LOWER, SPACE, arrow_udf, doc_of, fold, mix, prefix_hash, replaced, span_hash, text_buffer, unused
from flumen.llm.hasharrays import by_shard, dealt, find, held, mapped, mounted, planes, save, summed, unplaned
from flumen.sources.tables import load

BEGIN, END = np.uint64(1), np.uint64(2)     # word hashes are mixed; these two are marks
PIECE = 1 << 20
BLOCK = 2_000_000                           # entries that a task gathers before it sends them
_FACTOR = np.uint64(0x9FB21C651E98DF25)
ORDER = 2
#: Of an n-gram below the highest order: its occurrences and distinct contexts; as a
#: context: the numbers of its followers in all, and their discounts.
ROW = np.dtype([("key", "<u8"), ("count", "<i8"), ("contexts", "<i8"), ("total", "<i8"), ("mass", "<f8")])


# ---- tokens -----------------------------------------------------------------------

def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of the buffer that end at a document's end or before white space."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        if end < n:
            border = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            if border > at:
                end = border
            else:
                spaces = np.flatnonzero(SPACE[data[at:end]])
                if len(spaces) and spaces[-1] > 0:
                    end = at + int(spaces[-1])
                else:                           # a word longer than a piece stays whole
                    last = int(offsets[np.searchsorted(offsets, at, side="right")])
                    spaces = np.flatnonzero(SPACE[data[end:last]])
                    end = end + int(spaces[0]) if len(spaces) else last
        yield at, end
        at = end
    if not n:
        yield 0, 0


def tokens(column: pa.Array, back: int = 1) -> Iterator[tuple[np.ndarray, ...]]:
    """(document index, token, the token before it, ...) of a text column, with ``back``
    tokens before each, by pieces."""
    data, offsets = text_buffer(column)
    docs, ended, last = len(offsets) - 1, 0, np.full(back, BEGIN)     # last: the newest first
    for at, end in _cuts(data, offsets):
        part = LOWER[data[at:end]]
        word = ~SPACE[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        inner = offsets[(offsets >= at) & (offsets <= end)] - at
        edge[inner] = True
        edge[0] = edge[-1] = True
        before = np.concatenate(([False], word[:-1])) if len(part) else word
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.concatenate((word[1:], [False])) if len(part) else word
        stops = np.flatnonzero(word & (~after | edge[1:])) + 1
        doc = doc_of(offsets, starts + at)
        hashes = span_hash(prefix_hash(part), starts, stops)
        hashes[hashes <= END] += np.uint64(2)
        until = docs if end == len(data) else int(np.searchsorted(offsets[1:], end, side="right"))
        closing = np.arange(ended, until)
        # every document that ends here gets its end token after its words
        word_at = np.arange(len(doc)) + np.searchsorted(closing, doc, side="left")
        end_at = np.searchsorted(doc, closing, side="right") + np.arange(len(closing))
        size = len(doc) + len(closing)
        all_docs, token = np.empty(size, dtype=np.int64), np.empty(size, dtype=np.uint64)
        all_docs[word_at], all_docs[end_at] = doc, closing
        token[word_at], token[end_at] = hashes, END
        if size:
            fresh = np.concatenate(([False], all_docs[1:] != all_docs[:-1]))
            line, before = [token], token
            for i in range(back):
                older = np.empty(size, dtype=np.uint64)
                older[1:] = np.where(fresh[1:], BEGIN, before[:-1])
                older[0] = last[i]
                line.append(older)
                before = older
            yield (all_docs, *line)
            last = np.full(back, BEGIN) if token[-1] == END else np.array([x[-1] for x in line[:back]], dtype=np.uint64)
        ended = until


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """Of n-grams given by word, the newest first; of single words their own hashes."""
    out = words[-1]
    for w in words[-2::-1]:
        out = mix(out * _FACTOR + w)
    return out


# ---- learning ---------------------------------------------------------------------

def discounts(n: list[int]) -> np.ndarray:
    """D(0), D(1), D(2), D(3 and more) from how many counts are 1, 2, 3 and 4. Where
    one of these is 0 (a tiny corpus), half of each count is taken instead; so it is for
    a single discount that does not come out positive, as a context without discounted
    mass would leave nothing for words that it was not seen with."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(x, float(k)) if x > 0 else k / 2 for k, x in enumerate(d, 1))])


@dataclass
class Model:
    folder: str
    shards: int
    order: int
    cuts: dict[int, np.ndarray] = field(default_factory=dict)       # discounts of each order
    train_tokens: int = 0
    vocabulary: int = 0
    pairs: int = 0                              # distinct ones: the words' contexts in all
    spare: float = 1.0                          # share of the words' discounts

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted hashes of n-grams of the highest order, 0 where unknown."""
        out = np.zeros(len(keys), dtype=np.int64)
        for part, stem, at, there in find(self.folder, f"{self.order}-gram", keys, self.shards):
            out[part] = np.where(there, mapped(stem + ".count.npy")[at], 0)
        return out

    def rows(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Rows of a lower order's table for sorted hashes, zeros where unknown."""
        out = np.zeros(len(keys), dtype=ROW)
        for part, stem, at, there in find(self.folder, f"{order}-gram", keys, self.shards):
            found = mapped(stem + ".row.npy")[at]
            found[~there] = 0
            out[part] = found
        return out

    def numbers(self, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(occurrences, the number that is discounted) of sorted hashes of an order."""
        if order == self.order:
            c = self.counts(keys)
            return c, c
        rows = self.rows(order, keys)
        return rows["count"], rows["contexts"]

    def discounted(self, order: int, n: np.ndarray) -> np.ndarray:
        return np.maximum(n - self.cuts[order][np.minimum(n, 3)], 0)

    def score(self, column: pa.Array) -> dict[str, np.ndarray]:
        docs = len(column)
        out = {"n_tokens": np.zeros(docs, dtype=np.int64), "n_known": np.zeros(docs, dtype=np.int64),
               "base_score": np.zeros(docs), "score": np.zeros(docs)}
        below = self.train_tokens + 0.5 * (self.vocabulary + 1)
        for doc, *line in tokens(column, self.order - 1):
            # of each order below the highest, both the n-gram and the context of the next
            held = {}
            for k in range(1, self.order):
                keys, back = np.unique(np.concatenate((gram_hash(line[:k]), gram_hash(line[1:k + 1]))), return_inverse=True)
                found = self.rows(k, keys)[back]
                held[k] = found[:len(doc)], found[len(doc):]
            word = held[1][0]
            p = self.spare / (self.vocabulary + 1) + (self.discounted(1, word["contexts"]) / self.pairs if self.pairs else 0)
            for k in range(2, self.order + 1):
                if k == self.order:
                    keys, back = np.unique(gram_hash(line), return_inverse=True)
                    n = self.counts(keys)[back]
                else:
                    n = held[k][0]["contexts"]
                context = held[k - 1][1]
                total = np.maximum(context["total"], 1)
                p = np.where(context["total"] > 0, self.discounted(k, n) / total + context["mass"] / total * p, p)
            known = word["count"]
            for name, v in (("n_tokens", None), ("n_known", (known > 0).astype(float)), ("score", np.log10(p)),
                            ("base_score", np.log10((known + 0.5) / below))):
                out[name] += np.bincount(doc, weights=v, minlength=docs).astype(out[name].dtype)
        return out


_FEW = ["n1", "n2", "n3", "n4"]


def _few(n: np.ndarray) -> list[pa.Array]:
    found = np.bincount(np.minimum(n, 5), minlength=6)
    return [pa.array([int(found[i])]) for i in range(1, 5)]


def _summed_blocks(batches, entries, shards: int, names: list[str], kinds: list[str]):
    """Packed blocks per shard of the summed (keys, values...) that ``entries`` makes of
    each batch, about ``BLOCK`` of them at a time."""
    def block(parts):
        keys, *values = summed(*[np.concatenate(p) for p in zip(*parts)])
        found = [(s, planes(keys[part]), *(planes(v[part].astype(kind)) for v, kind in zip(values, kinds))) for s, part in by_shard(keys, shards)]
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], type=pa.int32())] + [pa.array([f[i] for f in found], type=pa.binary()) for i in range(1, len(names) + 2)],
                                          names=["shard", "keys", *names])
    parts, size = [], 0
    for b in batches:
        for part in entries(b.column(0)):
            parts.append(part)
            size += len(part[0])
            if size >= BLOCK:
                yield block(parts)
                parts, size = [], 0
    if parts:
        yield block(parts)


def learn(texts: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Count all rows of ``texts`` into a model of an order (2 or more) in the shared folder."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = texts.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = mounted(spark, "ngram")
    column = texts.select(F.col(text_col).cast("string").alias("text"))
    model = Model(folder, shards, order)

    def grams(batches):
        def entries(texts):
            for _, *line in tokens(texts, order - 1):
                yield np.unique(gram_hash(line), return_counts=True)
        return _summed_blocks(batches, entries, shards, ["counts"], ["<u4"])

    def write_grams(batches):
        os.makedirs(folder, exist_ok=True)
        for shard, blobs in held(batches).items():
            keys, n = summed(np.concatenate([unplaned(k, "<u8") for k, _ in blobs]), np.concatenate([unplaned(v, "<u4").astype(np.int64) for _, v in blobs]))
            save(f"{folder}/{order}-gram-{shard}.count.npy", n.astype("<u4") if n.max() < 1 << 32 else n)
            save(f"{folder}/{order}-gram-{shard}.key.npy", keys)
            yield pa.RecordBatch.from_arrays([pa.array([len(keys)]), *_few(n)], names=["size", *_FEW])

    figures = "size long, n1 long, n2 long, n3 long, n4 long"
    got = dealt(column.mapInArrow(grams, "shard int, keys binary, counts binary"), shards, write_grams, figures)
    model.cuts[order] = discounts([sum(r[n] for r in got) for n in _FEW])

    for k in range(order - 1, 0, -1):
        def lower(batches, k=k):
            def entries(texts):
                for _, *line in tokens(texts, k):
                    gram, at, n = np.unique(gram_hash(line), return_index=True, return_counts=True)
                    c, number = model.numbers(k + 1, gram)
                    share = n / c
                    # the last k words: occurrences and contexts; the first k: as a context
                    last, first = gram_hash([w[at] for w in line[:k]]), gram_hash([w[at] for w in line[1:]])
                    none = np.zeros(len(gram))
                    yield tuple(summed(np.concatenate((last, first)), np.concatenate((n, np.zeros(len(n), dtype=np.int64))), np.concatenate((share, none)),
                                       np.concatenate((none, share * number)), np.concatenate((none, share * model.cuts[k + 1][np.minimum(number, 3)]))))
            return _summed_blocks(batches, entries, shards, ["counts", "contexts", "totals", "mass"], ["<u4", "<f8", "<f8", "<f8"])

        def write_lower(batches, k=k):
            os.makedirs(folder, exist_ok=True)
            for shard, blobs in held(batches).items():
                join = lambda i, kind: np.concatenate([unplaned(b[i], kind) for b in blobs])
                keys, count, contexts, total, mass = summed(join(0, "<u8"), join(1, "<u4").astype(np.int64), *[join(i, "<f8") for i in (2, 3, 4)])
                rows = np.zeros(len(keys), dtype=ROW)
                rows["key"], rows["count"], rows["contexts"], rows["total"], rows["mass"] = keys, count, np.rint(contexts), np.rint(total), mass
                save(f"{folder}/{k}-gram-{shard}.row.npy", rows)
                save(f"{folder}/{k}-gram-{shard}.key.npy", keys)
                said = count > 0                    # begin marks alone are contexts only
                yield pa.RecordBatch.from_arrays([pa.array([int(said.sum())]), *_few(rows["contexts"][said]), pa.array([int(count.sum())]), pa.array([int(rows["contexts"].sum())])],
                                                 names=["size", *_FEW, "tokens", "contexts"])

        got = dealt(column.mapInArrow(lower, "shard int, keys binary, counts binary, contexts binary, totals binary, mass binary"), shards, write_lower,
                    figures + ", tokens long, contexts long")
        few = [sum(r[n] for r in got) for n in _FEW]
        model.cuts[k] = discounts(few)
        if k == 1:
            model.vocabulary, model.train_tokens = sum(r["size"] for r in got), sum(r["tokens"] for r in got)
            model.pairs = sum(r["contexts"] for r in got)
            if model.pairs:
                more = model.vocabulary - few[0] - few[1]
                model.spare = float(model.cuts[1][1:] @ [few[0], few[1], more]) / model.pairs
    return model


# ---- scoring ----------------------------------------------------------------------

def scores(text: str | Column, model: Model) -> Column:
    """struct(n_tokens, n_known, base_score, score) of a text column."""
    @arrow_udf("struct<n_tokens:bigint,n_known:bigint,base_score:double,score:double>")
    def run(column: pa.Array) -> pa.Array:
        found = model.score(column)
        return pa.StructArray.from_arrays([pa.array(v) for v in found.values()], names=list(found))
    return run(text)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score, score and perplexity; columns of
    these names give way."""
    s, = unused(docs, 1)
    marked = docs.withColumn(s, scores(F.col(text_col), model))
    return replaced(marked, **{c: F.col(f"{s}.{c}") for c in ("n_tokens", "n_known", "base_score", "score")},
                    perplexity=F.pow(F.lit(10.0), -F.col(f"{s}.score") / F.col(f"{s}.n_tokens"))).drop(s)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: every document's scores under the model of the training folds."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", (fold() == 1).alias("held_out"))
    model = learn(docs.where(~F.col("held_out")))
    return scored(docs, model).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
                                      "base_score", "score", "perplexity")
