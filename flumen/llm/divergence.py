"""Divergence of sources by their term counts, on hash-consed segment trees (operator 12).

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps
the V terms that at least ``min_docs`` of its documents hold. A group is a (lang, source)
that occurs, be it without terms. It gives each kept term p = 1 + floor(10^9 (c + 2) /
(N + 2 V)), c its occurrences there, N the sum of c; the language as a whole does likewise.
Two such tables differ in a term by f = floor((p - q)^2 / (p + q)).

Counting. Each task counts terms per group an Arrow batch at a time, built-in sums merge
the counts before and after the shuffle: a source with a third of all rows sends no more
rows than its tasks have distinct terms.

Pairs of sources. The kept terms are dealt evenly over parts by a hash; within a part, in
the order of their number of documents, they are the leaves of a group's segment tree, whose
leaf is a count. Nodes are hash-consed level by level: equal subtrees, of whatever group,
are one node, so that stretches of rare terms that most groups lack are shared. All pairs
of the groups' roots are then walked down together; pairs of nodes that several stretches
have in common are kept once with their number, and so priced once. f depends on the two
counts alone, once N and V are known. A part's sums are added up by Spark.

Bounds. A task holds the counts of one part, a block of ``BLOCK`` leaves times groups at a
time; the parts are as many as the counted rows ask for (``PART_ROWS``). A task pairs about
``STRIP`` of a language's groups with all of them, so it holds as many sums as a strip has
rows in the result. Every part gets its language's list of groups. All arithmetic is in
64-bit integers with exact remainders, for counts up to 9 * 10^15.

Nulls: null text, lang and source are empty strings, and the empty string is a language or
source like any other. Texts of any length are taken whole. Repeated rows count each; equal
values rank by the item's UTF-8 bytes. An empty table gives an empty result. Extra columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flumen.llm.common import LOWER, bounded_batches, doc_of, released, text_buffer, written
from flumen.sources.tables import load

SCALE = 10 ** 9
BLOCK = 1 << 20                 # counts (terms x groups) in one array
PART_ROWS = 200_000             # counted rows dealt to a part, on average
PAIRS = 1 << 18                 # pairs of groups walked together
STRIP = 256                     # groups of a language that a task pairs with all others, on average

TERM = np.zeros(256, dtype=bool)        # ASCII letters and all bytes of non-ASCII characters
TERM[65:91] = TERM[97:123] = TERM[128:] = True


# ---- counting ----------------------------------------------------------------------

def _terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms of a batch of texts, and rows (text, number of term, count)."""
    data, offsets = text_buffer(column)
    mine = TERM[data]
    apart = np.ones(len(data) + 1, dtype=bool)
    apart[1:-1] = ~(mine[:-1] & mine[1:])
    apart[offsets] = True
    first, end = np.flatnonzero(mine & apart[:-1]), np.flatnonzero(mine & apart[1:]) + 1
    ends = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(end - first, out=ends[1:])
    raw = pa.py_buffer(np.ascontiguousarray(LOWER[data[mine]]))
    found = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(ends), raw]).dictionary_encode()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pair, n = np.unique(doc_of(offsets, first) << 32 | code, return_counts=True)
    return found.dictionary, np.stack((pair >> 32, pair & 0xFFFFFFFF, n))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, source = (batch.column(c).dictionary_encode() for c in (0, 1))
        terms, (doc, term, n) = _terms(batch.column(2))
        group = (lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(source.dictionary)
                 + source.indices.to_numpy(zero_copy_only=False))
        # a text may count for a term once; a text without terms still shows its group
        keys, which = np.unique(group[doc] * len(terms) + term, return_inverse=True)
        which = which.reshape(-1)
        out_group, out_term = (keys // len(terms), keys % len(terms)) if len(terms) else (keys, keys)
        bare = np.unique(group)
        out_group = np.concatenate((out_group, bare))
        out_term = pa.array(np.concatenate((out_term, np.zeros(len(bare), dtype=np.int64))),
                            mask=np.arange(len(out_group)) >= len(keys))
        pad = np.zeros(len(bare), dtype=np.int64)
        count = np.concatenate((np.bincount(which, weights=n, minlength=len(keys)).astype(np.int64), pad))
        docs = np.concatenate((np.bincount(which, minlength=len(keys)), pad))
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(out_group // max(1, len(source.dictionary)))),
             source.dictionary.take(pa.array(out_group % max(1, len(source.dictionary)))),
             terms.take(out_term).cast(pa.string()), pa.array(count), pa.array(docs)],
            names=["lang", "source", "term", "n", "docs"])
        released()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it); a row with a null term
    for every group."""
    bounded_batches(docs.sparkSession)
    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"), (text, "text"))])
    found = plain.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- prices ------------------------------------------------------------------------

def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * count / whole) by long division, three digits at a time."""
    out, rest = count // whole, count % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Trees:
    """Hash-consed segment trees over the columns of a matrix (groups x leaves, a power of
    two): ``roots`` per group; ``children`` (left, right) per level, from the top down;
    ``leaves``: the count of each leaf node."""

    def __init__(self, counts: np.ndarray):
        self.leaves, node = np.unique(counts, return_inverse=True)
        node = node.reshape(counts.shape)
        self.children = []
        while node.shape[1] > 1:
            pair, made = np.unique(node[:, ::2] << 32 | node[:, 1::2], return_inverse=True)
            node = made.reshape(node.shape[0], -1)
            self.children.insert(0, (pair >> 32, pair & 0xFFFFFFFF))
        self.roots = node[:, 0]


def pair_values(trees: Trees, a: np.ndarray, b: np.ndarray, whole: np.ndarray, real: int) -> np.ndarray:
    """The sum of f over the first ``real`` leaves, for each pair of groups (a, b);
    ``whole``: N + 2 V of each group."""
    which, x, y = np.arange(len(a)), trees.roots[a], trees.roots[b]
    often = np.ones(len(a), dtype=np.int64)
    for left, right in trees.children:
        which, often = np.concatenate((which, which)), np.concatenate((often, often))
        x, y = np.concatenate((left[x], right[x])), np.concatenate((left[y], right[y]))
        # equal pairs of nodes once, with their number
        order = np.lexsort((y, x, which))
        which, x, y, often = which[order], x[order], y[order], often[order]
        new = np.flatnonzero(np.concatenate(([True], (which[1:] != which[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
        which, x, y, often = which[new], x[new], y[new], np.add.reduceat(often, new)
    value = price(share(trees.leaves[x] + 2, whole[a[which]]), share(trees.leaves[y] + 2, whole[b[which]])) * often
    out = np.zeros(len(a), dtype=np.int64)
    np.add.at(out, which, value)
    spare = (1 << len(trees.children)) - real           # leaves behind the last term, all zero
    if spare:
        none = np.full(len(a), 2)
        out -= spare * price(share(none, whole[a]), share(none, whole[b]))
    return out


def _part_pairs(counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Of one part of a language's terms: the value of each pair of a group of the strip
    with a later one."""
    source = groups["source"].to_numpy(dtype=object)
    order = np.argsort(source)
    source = source[order]
    whole = (groups["total"] + 2 * groups["kept"]).to_numpy(dtype=np.int64)[order]
    m, mine = len(source), np.flatnonzero(groups["mine"].to_numpy(dtype=bool)[order])
    row = pd.Index(source).get_indexer(counts["source"])
    # terms by falling number of documents: those that few groups have stand together
    term, back = np.unique(counts["term"].to_numpy(dtype=object), return_inverse=True)
    docs = np.zeros(len(term), dtype=np.int64)
    docs[back] = counts["lang_docs"].to_numpy(dtype=np.int64)
    place = np.empty(len(term), dtype=np.int64)
    place[np.argsort(-docs, kind="stable")] = np.arange(len(term))
    column, n = place[back], counts["n"].to_numpy(dtype=np.int64)
    by = np.argsort(column, kind="stable")
    row, column, n = row[by], column[by], n[by]
    width = 1 << max(0, min((max(1, BLOCK // m)).bit_length(), len(term).bit_length()) - 1)
    total = np.zeros((len(mine), m), dtype=np.int64)
    for at in range(0, len(term), width):
        real = min(width, len(term) - at)
        low, high = np.searchsorted(column, (at, at + real))
        block = np.zeros((m, width), dtype=np.int64)
        block[row[low:high], column[low:high] - at] = n[low:high]
        trees = Trees(block)
        step = max(1, PAIRS // m)
        for first in range(0, len(mine), step):
            i, b = np.meshgrid(np.arange(first, min(len(mine), first + step)), np.arange(m), indexing="ij")
            i, b = i[mine[i] < b], b[mine[i] < b]
            if len(i):
                total[i, b] += pair_values(trees, mine[i], b, whole, real)
    i, b = np.nonzero(mine[:, None] < np.arange(m))
    return pd.DataFrame({"lang": groups["lang"].iloc[0], "a": source[mine[i]], "b": source[b], "value": total[i, b]})


# ---- the audit ---------------------------------------------------------------------

def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: in part ``pair`` every other source of the
    group's language with the sum of f over all kept terms; in part ``term`` the ``top``
    terms that the group has and that it gives more than its language does, with f. Ranks
    are by falling value, then by item."""
    spark = docs.sparkSession
    counts = written(term_counts(docs), "terms")
    of_term = Window.partitionBy("lang", "term")
    known = counts.where(F.col("term").isNotNull())
    known = known.withColumn("lang_docs", F.sum("docs").over(of_term)).withColumn("lang_n", F.sum("n").over(of_term))
    kept = written(known.where(F.col("lang_docs") >= min_docs).drop("docs"), "kept-terms")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # the V terms of a language: every term's rows share out one between them
    langs = (kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n"))
             .groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("kept")))
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    groups = (groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "lang_total", "kept")]))
    groups = written(groups, "groups")

    # part "term": within Spark's own decimals
    def p(count, total):
        return f"1 + cast({SCALE} as decimal(20,0)) * ({count} + 2) div ({total} + 2 * kept)"
    terms = (kept.join(groups, ["lang", "source"])
             .withColumn("p", F.expr(p("n", "total"))).withColumn("q", F.expr(p("lang_n", "lang_total"))).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    # part "pair"
    parts = max(1, -(-kept.count() // PART_ROWS), min(64, spark.sparkContext.defaultParallelism))
    part = F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")
    strips = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / STRIP).cast("int").alias("strips"))
    of_strip = F.explode(F.expr("sequence(0, strips - 1)")).alias("strip")
    dealt = (kept.join(strips, "lang")
             .select("lang", "source", "term", "n", "lang_docs", part.alias("slot"), of_strip))
    lists = (groups.join(strips, "lang")
             .select("lang", "source", "total", "kept", F.expr("pmod(xxhash64(source), strips)").alias("own"), of_strip)
             .select("lang", "source", "total", "kept", (F.col("own") == F.col("strip")).alias("mine"), "strip",
                     F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("slot")))
    task = ["lang", "slot", "strip"]
    values = dealt.groupBy(task).cogroup(lists.groupBy(task)).applyInPandas(_part_pairs, "lang string, a string, b string, value long")
    values = values.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = values.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                            F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"))
    pairs = both.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms)


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the audit of all documents."""
    return audit(load(spark, sf_dir, "documents").select("lang", "source", "text"))


#: Groups and terms crossed in full: every f on its own.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
ln AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (gn.total + 2 * v.v) AS p
      FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term),
q AS (SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(c.n) + 2)) // (any_value(ln.total) + 2 * any_value(v.v)) AS q
      FROM c JOIN ln USING (lang) JOIN v USING (lang) GROUP BY c.lang, c.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
      FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
