"""User-function escape hatches, Arrow-batched (never row-at-a-time).

The built-in forms in :mod:`flumen.functions` are preferred; these exist for
logic a column expression cannot state, and double as a check that the
vectorised path gives the same answer as the built-in one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def series_map(fn: Callable[[pd.Series], pd.Series], return_type) -> Callable[..., Column]:
    """1 -> 1 row function over whole Arrow batches (``pandas_udf``)."""
    return F.pandas_udf(fn, return_type)


def flat_map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """1 -> 0..n row function: ``fn`` maps one pandas batch to any number of
    output rows (``mapInPandas``); batches stream, nothing is held per group."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = fn(pdf)
            if len(out):
                yield out
    return df.mapInPandas(run, schema)


def table_function(df: DataFrame, fn, by, order_by=(), **arguments) -> DataFrame:
    """1 -> 0..n rows by an Arrow table function (class with ``eval``, wrapped by
    ``arrow_udtf`` with its declared schema): ``df`` is its table argument, ``PARTITION BY``
    the columns ``by``, and ``arguments`` its keyword arguments, constants or columns."""
    rows = df.asTable().partitionBy(*([by] if isinstance(by, str) else by))
    if order_by:
        rows = rows.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return fn(rows, **{k: v if isinstance(v, Column) else F.lit(v) for k, v in arguments.items()})


def mean_udaf() -> Callable[..., Column]:
    """Mean as one grouped-aggregate ``pandas_udf`` (NaN on empty input).
    Spark hands each group to Python whole, so use it on bounded groups only;
    :func:`combine_mean` is the form for open-ended groups."""
    @F.pandas_udf(T.DoubleType())
    def mean(v: pd.Series) -> float:
        return float(v.sum() / len(v)) if len(v) else float("nan")
    return mean


def combine_mean(df: DataFrame, keys, value: str, name: str = "mean",
                 target_rows: int = 2_000_000) -> DataFrame:
    """A custom combine function with its four steps made explicit:

    * create/add -- each task builds the (sum, count) accumulators of the keys in
      one Arrow batch at a time, of ``target_rows`` rows at most; rows are neither
      shuffled nor grouped before it, so a hot key is as spread as its input;
    * merge -- built-in sums of the accumulators per key (partial + final);
    * extract -- ``sum / count``, NaN when the count is 0. NULL values do not count.
    """
    k = [keys] if isinstance(keys, str) else list(keys)
    rows = df.select(*k, F.col(value).cast("double").alias("__v"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__s", T.DoubleType()), T.StructField("__n", T.LongType())])

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, target_rows):
                part = pa.Table.from_batches([b.slice(at, target_rows)])
                acc = part.group_by(k, use_threads=False).aggregate([("__v", "sum"), ("__v", "count")])
                yield from acc.select([*k, "__v_sum", "__v_count"]).rename_columns([*k, "__s", "__n"]).to_batches()

    merged = rows.mapInArrow(accumulate, schema).groupBy(*k).agg(F.sum("__s").alias("__s"), F.sum("__n").alias("__n"))
    return merged.select(*k, F.when(F.col("__n") > 0, F.col("__s") / F.col("__n"))
                         .otherwise(F.lit(float("nan"))).alias(name))


# ---- helpers used by the registered checks ---------------------------------

def first_word_lower(s: pd.Series) -> pd.Series:
    """Example 1 -> 1 function: first blank-separated word of a line, lower-cased."""
    return s.str.split(" ", n=1).str[0].str.lower()


def nonblank_lines(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example 1 -> n function: (doc_id, line_no, line) for each non-blank line."""
    parts = pdf.assign(line=pdf["text"].str.split("\n")).explode("line")
    parts["line_no"] = parts.groupby(level=0).cumcount().astype("int64")
    parts = parts[parts["line"].str.strip(" ") != ""]
    return parts[["doc_id", "line_no", "line"]].reset_index(drop=True)


class SplitNames:
    """Example table function over rows (id, text), with two keyword arguments: every word
    of a text goes to ``Short_Names`` or, longer than ``cutoff_length``, to ``Long_Names``,
    and once more to ``Marked_Names`` if it starts with ``marker``."""

    def eval(self, rows: pa.RecordBatch, cutoff_length: pa.Array, marker: pa.Array) -> Iterator[pa.Table]:
        lists = pc.split_pattern(pc.fill_null(rows.column("text"), ""), " ")
        ids, words = pc.take(rows.column("id"), pc.list_parent_indices(lists)), pc.list_flatten(lists)
        some = pc.not_equal(words, "")
        ids, words = ids.filter(some), words.filter(some)
        short = pc.less_equal(pc.utf8_length(words), cutoff_length[0].as_py())
        yield pa.table({"id": ids, "tag": pc.if_else(short, "Short_Names", "Long_Names"), "word": words})
        marked = pc.starts_with(words, marker[0].as_py())
        ids, words = ids.filter(marked), words.filter(marked)
        yield pa.table({"id": ids, "tag": pa.repeat("Marked_Names", len(words)), "word": words})


def split_names():
    """:class:`SplitNames` as a table function."""
    return F.arrow_udtf(SplitNames, returnType="id long, tag string, word string")
