"""Benchmark decontamination: size-partitioned MinHash containment search, verified by
exact shingle containment (operator 2). DataFrame operations only.

A test item is short, a document long, so their Jaccard similarity says little; asked
is the share of the item's word shingles that the document contains. Items are
partitioned by size (powers of two of their number of distinct shingles). An item's
sketch is its smallest shingle hashes, as many as its partition needs: a document that
contains a share of ``threshold`` misses at most ``(1 - threshold) * size`` shingles,
so of one more than that it holds at least one. The search over all documents' shingle
hashes therefore loses no match. Candidates are verified on the shingles themselves.

Words are runs of letters and digits, lower-cased; in scripts that are written
without blanks every character is one. Shingles have five words. An item of fewer words
is one shingle of its own length; documents then give their runs of that many words, too,
so it is found wherever it stands. The documents' shingles are never shuffled while the items'
sketches, counted first, are few enough to be broadcast; beyond that the join shuffles.

Nulls: a null or wordless text contains nothing and is contained in nothing; null ids
are kept as they are. Repeated rows (equal id and text) give one result row. Texts of any
length are taken whole. Without documents or without items nothing is found and every
document is kept. Extra columns are kept by ``clean``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import unused, written
from flumen.sources.tables import load

WORDS, THRESHOLD = 5, 0.8
BROADCAST_ROWS = 1_000_000          # of a hash or id and a number; counted, not estimated


# Scripts that are written without blanks between words.
SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
_UNPARTED = "[" + "".join(rf"\p{{Is{s}}}" for s in SCRIPTS) + "]"


def words_of(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    # these scripts lie behind U+0DFF; other texts are spared the dearer pattern
    low = F.when(low.rlike(r"[^\x00-\u0DFF]"), F.regexp_replace(low, f"({_UNPARTED})", " $1 ")).otherwise(low)
    parts = F.split(low, r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def runs_of(words: Column, n: int, shape) -> Column:
    """``shape`` of each run of n words; none if there are fewer."""
    empty = F.array().cast("array<string>" if shape is joined else "array<bigint>")
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: shape(F.slice(words, i, n)))).otherwise(empty)


def shingles_of(words: Column, n: int, shape) -> Column:
    """``shape`` of each run of n words; of all words if there are fewer."""
    return (F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: shape(F.slice(words, i, n))))
            .when(F.size(words) > 0, F.array(shape(words))).otherwise(F.array().cast("array<string>") if shape is joined else F.array().cast("array<bigint>")))


def joined(words: Column) -> Column:
    return F.array_join(words, " ")


def sketch_size(n: Column, threshold: float) -> Column:
    """Hashes that an item of n shingles needs: one more than a document may miss of the
    largest item of its size partition."""
    largest = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double"))))
    return (F.floor(largest * F.lit(1 - threshold) + F.lit(1e-9)) + 1).cast("int")


def _all_runs(words: Column, lengths: list[int], shape) -> Column:
    runs = [runs_of(words, n, shape) for n in lengths]
    return runs[0] if len(runs) == 1 else F.concat(*runs)


def small(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once; marked for broadcast if its counted rows are few."""
    back = written(df, label)
    return F.broadcast(back) if back.count() <= BROADCAST_ROWS else back


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text",
              n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc, doc_id, item_id, n_shingles, n_found): every item of which a document
    contains a share of ``threshold`` or more. doc names the document's row by the hash
    of its id and text."""
    text = F.col(text_col)
    parts = written(items.select(F.xxhash64(F.col(item_id).cast("string"), text).alias("item"), F.col(item_id).alias("item_id"), words_of(text).alias("w"))
                    .dropDuplicates(["item"])
                    .select("item", "item_id", F.size("w").alias("words"), F.array_distinct(shingles_of(F.col("w"), n, joined)).alias("s"),
                            F.array_distinct(shingles_of(F.col("w"), n, F.xxhash64)).alias("h"))
                    .where("size(s) > 0"), "items")
    # runs as long as the items that are shorter than a shingle: few lengths, if any
    short = [r[0] for r in parts.where(F.col("words") < n).select("words").distinct().collect()]
    lengths = [n, *sorted(short)]
    sketch = small(parts.select("item", F.explode(F.slice(F.array_sort("h"), F.lit(1), sketch_size(F.size("h"), threshold))).alias("h")), "sketch")

    named = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id).cast("string"), text).alias("doc"), words_of(text).alias("w"))
    hashes = named.select("doc", F.explode(_all_runs(F.col("w"), lengths, F.xxhash64)).alias("h"))
    candidates = written(hashes.join(sketch, "h").select("doc", "item").distinct(), "candidates")

    asked = small(candidates.select("doc").distinct(), "asked")
    exact = small(parts.select("item", F.explode("s").alias("s")), "shingles")
    held = (named.join(asked, "doc", "left_semi").dropDuplicates(["doc"])
            .select("doc", "doc_id", F.explode(F.array_distinct(_all_runs(F.col("w"), lengths, joined))).alias("s")))
    found = held.join(exact, "s").groupBy("doc", "doc_id", "item").agg(F.count(F.lit(1)).alias("n_found"))
    sizes = parts.select("item", "item_id", F.size("s").cast("long").alias("n_shingles"))
    return (found.join(candidates, ["doc", "item"], "left_semi").join(sizes, "item")
            .where(F.col("n_found") >= F.col("n_shingles") * F.lit(threshold) - F.lit(1e-9))
            .select("doc", "doc_id", "item_id", "n_shingles", "n_found"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that contain no item."""
    found = contained(docs, items, doc_id=doc_id, text_col=text_col, **options).select("doc").distinct()
    doc, = unused(docs, 1)
    marked = docs.withColumn(doc, F.xxhash64(F.col(doc_id).cast("string"), F.col(text_col)))
    return marked.join(small(found.withColumnRenamed("doc", doc), "leaks"), doc, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op2: all pairs of a document and a benchmark item that it contains."""
    found = contained(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def _oracle_words(table: str, key: str) -> str:
    unparted = "[" + "".join(rf"\p{{{s}}}" for s in SCRIPTS) + "]"
    return (f"SELECT DISTINCT {key}, text, list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '({unparted})', ' \\1 ', 'g'), "
            f"'[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}")


_RUNS = "list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))"
ORACLE = f"""
WITH iw AS ({_oracle_words('benchmark', 'item_id')}), dw AS ({_oracle_words('documents', 'doc_id')}),
ik AS (SELECT *, least(len(w), {WORDS}) AS k FROM iw WHERE len(w) > 0),
lengths AS (SELECT {WORDS} AS k UNION SELECT k FROM ik),
i AS (SELECT DISTINCT item_id, text, unnest({_RUNS}) AS s FROM ik),
d AS (SELECT DISTINCT doc_id, text, unnest({_RUNS}) AS s FROM dw JOIN lengths ON len(w) >= k)
, n AS (SELECT item_id, text, count(*) AS n_shingles FROM i GROUP BY item_id, text),
f AS (SELECT d.doc_id, d.text AS t, i.item_id, i.text, count(*) AS n_found FROM d JOIN i ON d.s = i.s GROUP BY ALL)
SELECT doc_id, f.item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM f JOIN n ON f.item_id = n.item_id AND f.text = n.text
WHERE n_found >= {THRESHOLD} * n_shingles - 1e-9
"""
