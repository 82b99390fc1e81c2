"""Fan-out, union and multi-output splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.functions.collections import json_keys_exact


def union_all(*dfs: DataFrame) -> DataFrame:
    """Flatten: UNION ALL by column name (no shuffle, duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def tag_first_match(df: DataFrame, rules: list[tuple[str, Column]], main: str = "main",
                    name: str = "tag") -> DataFrame:
    """Multi-output split: each row gets the tag of the first rule it matches,
    else ``main``. Every output is then a filter on the tag column, so one scan
    feeds all outputs and each row lands in exactly one."""
    expr = None
    for tag, cond in rules:
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    return df.withColumn(name, expr.otherwise(F.lit(main)) if expr is not None else F.lit(main))


def output(tagged: DataFrame, tag: str, name: str = "tag") -> DataFrame:
    return tagged.filter(F.col(name) == tag).drop(name)


def parse_outcome(df: DataFrame, text_col: str, schema: T.StructType,
                  parsed: str = "parsed", name: str = "outcome") -> DataFrame:
    """Strict JSON parse in one pass: ``outcome`` is ``parsed`` when the JSON
    object has exactly the schema's keys, else ``dead_letter`` (missing or
    extra keys, junk); ``parsed`` holds the record (NULL for dead letters) and
    the raw text is kept."""
    ok = json_keys_exact(text_col, schema)
    return (df.withColumn(name, F.when(ok, F.lit("parsed")).otherwise(F.lit("dead_letter")))
            .withColumn(parsed, F.when(ok, F.from_json(F.col(text_col), schema))))


def split_parsed(df: DataFrame, text_col: str, schema: T.StructType,
                 parsed: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, dead-letter rows) as two filters of one labelled frame."""
    labelled = parse_outcome(df, text_col, schema, parsed, "__outcome")
    good = labelled.filter(F.col("__outcome") == "parsed").drop("__outcome")
    bad = labelled.filter(F.col("__outcome") == "dead_letter").drop("__outcome", parsed)
    return good, bad


def flatten_branches(df: DataFrame, branches: dict, name: str = "branch") -> DataFrame:
    """Filtered branches of one input, flattened in one scan: a row comes out once for
    every branch whose condition holds, with the branch in column ``name``."""
    taken = F.filter(F.array(*[F.when(cond, F.lit(n)) for n, cond in branches.items()]), lambda x: x.isNotNull())
    return df.withColumn(name, F.explode(taken))
