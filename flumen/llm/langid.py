"""Language ID with language-bitmask n-gram filters (operator 10).

Learning: byte n-grams of the labelled texts (A-Z lower-cased) are counted per
language over all of them. An n-gram belongs to a language if its share of that
language's n-grams is at least ``min_share`` and at least ``min_ratio`` times its
share in the language where it is most usual; so a language has at most
``1 / min_share`` n-grams, however large the corpus, and a few foreign passages do
not add any. The n-grams that are kept are counted, and the filter has so many slots that
no language fills more than half of them. Each n-gram sets its languages' bits in ``hashes`` slots of one filter:
a row of the filter holds one slot's bits of all languages, so one look-up per hash,
ANDed, returns all languages that contain an n-gram.

Predicting: per language, the n-grams of the text whose mask has its bit are
counted. A language's filter answers falsely with probability ``fill ** hashes``;
the count is corrected for that, and the largest wins (ties: the smaller name). The
score is the winner's share of all corrected counts.

Only the filter goes through the driver: of ``1 / min_share`` n-grams a language it has
2 ^ 23 slots at most, whatever the input.

Nulls: a null text, or one without a letter, is ``und`` with score 0. A null label
teaches nothing; a null id counts as empty text in the fold. Where nothing could be
learned every text is ``und``. A text with letters but no known n-gram gets the
language with the most training n-grams, score 0. Repeated rows are judged alike. Texts
of any length are read whole. An empty table gives an empty result; columns that clash
with the result's give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import LOWER, arrow_udf, bounded_batches, doc_of, fold, mix, released, replaced, text_buffer, unused, written
from flumen.sources.tables import load

UNKNOWN = "und"
LEAST_LOG2 = 12                     # of a filter's slots
PIECE = 1 << 18                     # bytes handled by one round of array operations


@dataclass(frozen=True)
class Settings:
    n: int = 4                      # bytes of an n-gram, 8 at most
    slots_log2: int | None = None   # of the filter; None: as its n-grams need
    hashes: int = 3
    min_share: float = 1e-6
    min_ratio: float = 0.25


def pieces(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-grams as integers, document index of each), a piece of the buffer at a
    time; n-grams do not cross documents."""
    for at in range(0, max(0, len(data) - n + 1), PIECE):
        part = LOWER[data[at:at + PIECE + n - 1]].astype(np.uint64)
        size = len(part) - n + 1
        grams = np.zeros(size, dtype=np.uint64)
        for i in range(n):
            grams |= part[i:size + i] << np.uint64(8 * i)
        doc = doc_of(offsets, np.arange(at, at + size))
        inside = np.arange(at, at + size) + n <= offsets[doc + 1]
        yield grams[inside], doc[inside]


def slots_of(grams: np.ndarray, s: Settings) -> list[np.ndarray]:
    """The slot of each n-gram under each hash: disjoint bits of one mixed value,
    mixed again where these run out."""
    out, h, used = [], mix(grams + np.uint64(1)), 0
    for _ in range(s.hashes):
        if used + s.slots_log2 > 64:
            h, used = mix(h + np.uint64(1)), 0
        out.append((h >> np.uint64(used)) & np.uint64((1 << s.slots_log2) - 1))
        used += s.slots_log2
    return out


def gram_counts(labelled: DataFrame, text: str, lang: str, s: Settings) -> DataFrame:
    """(lang, gram, n): n-gram counts of every language; batches are counted in the
    task first, so what is shuffled is distinct n-grams."""
    def count(batches):
        for b in batches:
            langs = pc.dictionary_encode(b.column(1))
            codes, names = langs.indices.to_numpy(zero_copy_only=False), langs.dictionary.to_pylist()
            data, offsets = text_buffer(b.column(0))
            parts = [[np.unique(grams[codes[doc] == i], return_counts=True) for i in range(len(names))] for grams, doc in pieces(data, offsets, s.n)]
            for i, name in enumerate(names):
                if parts:
                    found, back = np.unique(np.concatenate([p[i][0] for p in parts]), return_inverse=True)
                    n = np.bincount(back, weights=np.concatenate([p[i][1] for p in parts]), minlength=len(found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), type=pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"])
            released()
    bounded_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string"))
    return (rows.mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class Model:
    """langs in order of name, and the filter: [slots, bytes] with a bit a language."""

    def __init__(self, langs: list[str], usual: int, table: np.ndarray, settings: Settings):
        self.langs, self.usual, self.table, self.settings = langs, usual, table, settings
        bits = np.unpackbits(table, axis=1, bitorder="little")[:, :len(langs)]
        self.false_rate = bits.mean(axis=0) ** settings.hashes if len(langs) else np.zeros(0)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """[n-grams, bytes]: the languages that contain each, all at once."""
        first, *rest = slots_of(grams, self.settings)
        out = self.table[first]
        for s in rest:
            out &= self.table[s]
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        data, offsets = text_buffer(column)
        docs, langs = len(offsets) - 1, len(self.langs)
        hits, total = np.zeros((docs, langs)), np.zeros(docs)
        for grams, doc in pieces(data, offsets, self.settings.n):
            masks = self.masks(grams)
            total += np.bincount(doc, minlength=docs)
            for i in range(langs):
                has = doc[(masks[:, i >> 3] >> np.uint8(i & 7)) & np.uint8(1) == 1]
                hits[:, i] += np.bincount(has, minlength=docs)
        true = np.maximum(0.0, hits - total[:, None] * self.false_rate) / np.maximum(1e-9, 1 - self.false_rate)
        best, sums = true.argmax(axis=1), true.sum(axis=1)
        best = np.where(sums > 0, best, self.usual)
        score = np.where(sums > 0, true.max(axis=1) / np.where(sums > 0, sums, 1), 0.0)
        return [self.langs[i] for i in best], score


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> Model:
    """The model of all rows of ``labelled`` whose label is not null."""
    s = settings
    counts = written(gram_counts(labelled, text, lang, s), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    width = max(1, -(-len(langs) // 8))
    table = np.zeros((1 << (s.slots_log2 or LEAST_LOG2), width), dtype=np.uint8)
    if langs:
        spark = labelled.sparkSession
        sizes = spark.createDataFrame([(k, float(totals[k]), i) for i, k in enumerate(langs)], "lang string, total double, bit int")
        share = counts.join(sizes, "lang").select("gram", "bit", (F.col("n") / F.col("total")).alias("share"))
        usual = share.groupBy("gram").agg(F.max("share").alias("most"))
        kept = share.join(usual, "gram").where((F.col("share") >= s.min_share) & (F.col("share") >= F.col("most") * s.min_ratio))
        kept = written(kept.select("gram", "bit"), "kept-grams")
        if s.slots_log2 is None:
            most = kept.groupBy("bit").count().agg(F.max("count")).first()[0] or 0
            s = replace(s, slots_log2=max(LEAST_LOG2, int(2 * s.hashes * most - 1).bit_length()))
            table = np.zeros((1 << s.slots_log2, width), dtype=np.uint8)

        def spread(batches):
            for b in batches:
                grams, bit = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
                for slot in slots_of(grams, s):
                    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array((bit >> 3).astype(np.int32)), pa.array(np.left_shift(1, bit & 7).astype(np.int32))], names=["slot", "byte", "bits"])
        rows = (kept.mapInArrow(spread, "slot int, byte int, bits int")
                .groupBy("slot", "byte").agg(F.expr("bit_or(bits)").alias("bits")).toArrow())
        slot, byte = rows["slot"].to_numpy(), rows["byte"].to_numpy()
        table[slot, byte] = rows["bits"].to_numpy().astype(np.uint8)
    s = s if s.slots_log2 else replace(s, slots_log2=LEAST_LOG2)
    return Model(langs, langs.index(max(langs, key=totals.get)) if langs else 0, table, s)


def predict(text: str | Column, spark, model: Model) -> Column:
    """struct(lang_pred, score) of a text column. The filter is sent to each executor
    once; its size is fixed by its settings."""
    column = F.col(text) if isinstance(text, str) else text
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("struct<lang_pred:string,score:double>")
    def run(texts: pa.Array) -> pa.Array:
        m = shared.value
        langs, score = m.predict(texts) if m.langs else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
        return pa.StructArray.from_arrays([pa.array(langs, type=pa.string()), pa.array(score)], names=["lang_pred", "score"])

    letter = F.coalesce(column.rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(letter, run(column)).otherwise(none)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of these names give way."""
    p, = unused(docs, 1)
    marked = docs.withColumn(p, predict(text_col, docs.sparkSession, model))
    return replaced(marked, lang_pred=F.col(f"{p}.lang_pred"), score=F.col(f"{p}.score")).drop(p)


def learn_fold(docs: DataFrame, parts: int = 5) -> Model:
    """The model of the documents outside the held-out fold (remainder 0)."""
    return learn(docs.where(fold("doc_id", parts) != 0))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the predicted language of every document."""
    docs = load(spark, sf_dir, "documents")
    model = learn_fold(docs)
    out = identify(docs.select("doc_id", "text", (fold() == 0).alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
