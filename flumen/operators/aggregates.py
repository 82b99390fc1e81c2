"""Per-key and global aggregates.

Every aggregate here is a built-in with a partial (map-side) and a final step,
which is exactly the create/add/merge/extract contract of a combine function:
rows of one key are pre-combined inside each input partition before the
shuffle, so a hot key sends one partial row per partition, not all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def count_per_key(df: DataFrame, keys, name: str = "count") -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def sum_per_key(df: DataFrame, keys, value, name: str = "total") -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_keys(keys)).agg(F.sum(v).alias(name))


def stats_per_key(df: DataFrame, keys, value: str,
                  names=("page_views", "total_bytes", "max_bytes", "min_bytes")) -> DataFrame:
    """count, sum, max, min of one field per key (user traffic)."""
    v = F.col(value)
    n_count, n_sum, n_max, n_min = names
    return df.groupBy(*_keys(keys)).agg(
        F.count(F.lit(1)).alias(n_count),
        F.sum(v).alias(n_sum),
        F.max(v).alias(n_max),
        F.min(v).alias(n_min),
    )


def aggregate_fields(df: DataFrame, keys, fields: list[tuple[str, str, str]]) -> DataFrame:
    """``(column, fn, output_name)`` triples, fn in count/sum/min/max/avg."""
    fns = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "mean": F.avg}
    return df.groupBy(*_keys(keys)).agg(*[fns[fn](F.col(c)).alias(out) for c, fn, out in fields])


def having(df: DataFrame, cond: Column) -> DataFrame:
    """Filter on aggregated columns (SQL HAVING)."""
    return df.filter(cond)


def global_count(df: DataFrame, name: str = "count", by=None) -> DataFrame:
    """Count *without defaults*: grouped by ``by`` (e.g. a window column) so an
    empty input gives no row, unlike ``SELECT count(*)`` which gives 0."""
    if by is None:
        # a constant grouping key turns the global aggregate into a keyed one:
        # no input row -> no group -> no output row
        return df.groupBy(F.lit(0).alias("__g")).agg(F.count(F.lit(1)).alias(name)).drop("__g")
    return df.groupBy(*_keys(by)).agg(F.count(F.lit(1)).alias(name))


def mean_or_nan(df: DataFrame, value: str, name: str = "mean") -> DataFrame:
    """Global mean; NaN (not NULL) on empty input, like ``sum/count if count else nan``."""
    return df.agg(F.coalesce(F.avg(F.col(value)), F.lit(float("nan"))).alias(name))


def mean_per_key(df: DataFrame, keys, value, name: str = "mean") -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_keys(keys)).agg(F.avg(v).alias(name))


def top_n(df: DataFrame, n: int, by: str, tie_break) -> DataFrame:
    """Global top ``n`` by ``by`` (desc), ties broken by ``tie_break`` (asc).
    Planned as TakeOrderedAndProject: each partition keeps its own top ``n`` and
    only ``n x partitions`` rows reach the final merge -- no full sort."""
    tb = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in tb]).limit(n)


def composite(df: DataFrame, keys, value, min_total, fmt: str, name: str = "text") -> DataFrame:
    """A reusable unit: sum per key, keep ``total > min_total``, format as text."""
    summed = sum_per_key(df, keys, value, "total")
    return having(summed, F.col("total") > F.lit(min_total)).withColumn(
        name, F.format_string(fmt, *[F.col(k) for k in _keys(keys)], F.col("total"))
    )


def of_sets(df: DataFrame, sets: dict, *aggs: Column, name: str = "branch", key: str = "key") -> DataFrame:
    """Aggregates of one input by several columns in one scan and one shuffle (GROUPING
    SETS): rows of ``name`` (a key of ``sets``), ``key`` (the value of that set's column, as
    text) and ``aggs``. A NULL is a key like any other."""
    columns = list(dict.fromkeys(sets.values()))
    out = df.groupingSets([[c] for c in columns], *columns).agg(F.grouping_id().alias("__set"), *aggs)
    # a column's bit is 0 where it is grouped by, the first column's being the highest
    whole = (1 << len(columns)) - 1
    number = {c: whole - (1 << (len(columns) - 1 - i)) for i, c in enumerate(columns)}
    branch = F.filter(F.array(*[F.struct(F.lit(n).alias(name), F.lit(number[c]).cast("long").alias("set"), F.col(c).cast("string").alias(key))
                                for n, c in sets.items()]), lambda x: x["set"] == F.col("__set"))
    kept = [c for c in out.columns if c not in (*columns, "__set")]
    return out.select(F.explode(branch).alias("__b"), *kept).select(f"__b.{name}", f"__b.{key}", *kept)
