"""Joins: co-group, dictionary look-up, exclusion list.

Physical strategy is left to Catalyst/AQE: no hints, and no job while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flumen.operators.ordered import join_back
from flumen.session import materialize


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def lookup(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Side-input style look-up. Spark broadcasts ``right`` if its size, as estimated or
    as measured at run time, is under the session's threshold, and shuffles else."""
    return left.join(right, on=on, how=how)


def lookup_nonzero(left: DataFrame, right: DataFrame, on, value: str) -> DataFrame:
    """``if d.get(k): ...`` -- inner join, and a looked-up 0 counts as missing."""
    return lookup(left, right, on).filter(F.col(value).isNotNull() & (F.col(value) != 0))


def exclude(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    """``x not in id_list`` as a left-anti join (NULL-safe, unlike ``NOT IN``)."""
    return df.join(ids, on=on, how="left_anti")


def cogroup_flat(sides: dict[str, DataFrame], key, value_cols: dict[str, list] | None = None) -> DataFrame:
    """Co-group in long form: one row per (key, tag, element).

    Each input keeps all its rows (duplicates included); an absent side simply
    contributes no rows for that key. Nothing is collected, so a key with
    millions of rows on one side stays spread over tasks. Columns:
    ``key..., tag, item``: the side's single value column as is, or the JSON
    text of its value columns when it has several.
    """
    k = _keys(key)
    parts = []
    for tag, df in sides.items():
        cols = (value_cols or {}).get(tag) or [c for c in df.columns if c not in k]
        item = F.col(cols[0]) if len(cols) == 1 else F.to_json(F.struct(*cols))
        parts.append(df.select(*k, F.lit(tag).alias("tag"), item.alias("item")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cogroup_with_sizes(sides: dict[str, DataFrame], key) -> DataFrame:
    """:func:`cogroup_flat` with the number of its key's elements on each side (``n_<tag>``).
    The flat form is written once, so every input is read once; the sizes are a partial
    aggregate of it. NULL is a key like any other."""
    k = _keys(key)
    flat = materialize(cogroup_flat(sides, k), "cogroup")
    sizes = flat.groupBy(*k).agg(*[F.count_if(F.col("tag") == t).alias(f"n_{t}") for t in sides])
    return join_back(flat, sizes, k)


def cogroup_sizes(sides: dict[str, DataFrame], key) -> DataFrame:
    """Per key of the full outer key set: number of elements on each side
    (0 when absent). Partial aggregation per side, then one full outer join of
    one-row-per-key tables."""
    k = _keys(key)
    out = None
    for tag, df in sides.items():
        cnt = df.groupBy(*k).agg(F.count(F.lit(1)).alias(f"n_{tag}"))
        out = cnt if out is None else out.join(cnt, on=k, how="full")
    return out.fillna(0, subset=[f"n_{t}" for t in sides])


def cogroup(sides: dict[str, DataFrame], key, value_cols: dict[str, list] | None = None) -> DataFrame:
    """Co-group in the nested shape: key + one sorted list per side (empty
    when absent). Meant for keys whose groups are known to be bounded; for
    open-ended groups use :func:`cogroup_flat` + :func:`cogroup_sizes`."""
    k = _keys(key)
    out = None
    for tag, df in sides.items():
        cols = (value_cols or {}).get(tag) or [c for c in df.columns if c not in k]
        lst = df.groupBy(*k).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(tag))
        out = lst if out is None else out.join(lst, on=k, how="full")
    for tag in sides:
        out = out.withColumn(tag, F.coalesce(F.col(tag), F.array()))
    return out
