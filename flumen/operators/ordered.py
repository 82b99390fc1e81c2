"""Skew-safe ordered scans: running aggregates and "previous row" look-ups in
an order inside a key, computed in two steps so that a key holding a third of
all rows is still spread over many tasks.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task. Here the order column is cut into buckets (``bucket`` column chosen by
the caller, e.g. ``floor(arrival / width)``):

1. inside ``(key, bucket)`` a small window gives the local running value;
2. ``groupBy(key, bucket)`` gives one total per bucket (partial aggregation,
   map-side combined);
3. a window over that much smaller bucket table (``#buckets`` rows per key)
   gives the exclusive prefix per bucket;
4. a join on ``(key, bucket)`` adds the prefix to the local value.

Steps 1 and 4 are partitioned by ``(key, bucket)``; only step 3 is per key, and
it sees one row per bucket, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def join_back(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner join on ``keys`` in which a NULL key meets a NULL key: a per-key table
    made from ``left`` goes back to all of its rows."""
    k = _keys(keys)
    side = right.select(*[F.col(c).alias(f"__r_{c}") if c in k else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in k]
    return left.join(side, on=on, how="inner").drop(*[f"__r_{c}" for c in k])


_AGG = {"sum": F.sum, "count": F.sum, "max": F.max}


def running_many(
    df: DataFrame,
    keys,
    order: list,
    bucket: str,
    specs: dict[str, tuple[str, Column | str | None]],
    exclusive: bool = False,
) -> DataFrame:
    """Several running aggregates in one pass: ``specs`` maps an output name to
    ``(how, value)`` with ``how`` in sum/count/max.

    One window spec over ``(keys, bucket)`` computes every local value, one
    group-by computes every bucket total, one small window gives the bucket
    offsets and one join adds them back.
    """
    k = _keys(keys)
    vals, local_cols, tot_cols, off_cols = {}, [], [], []
    frame = Window.partitionBy(*k, bucket).orderBy(*order)
    frame = (frame.rowsBetween(Window.unboundedPreceding, -1) if exclusive
             else frame.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    prior = Window.partitionBy(*k).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = df
    for name, (how, value) in specs.items():
        v = F.lit(1) if how == "count" else (F.col(value) if isinstance(value, str) else value)
        base = base.withColumn(f"__{name}_v", v)
        vals[name] = how
    local = base.select("*", *[_AGG[h](f"__{n}_v").over(frame).alias(f"__{n}_local") for n, h in vals.items()])
    totals = base.groupBy(*k, bucket).agg(*[_AGG[h](f"__{n}_v").alias(f"__{n}_tot") for n, h in vals.items()])
    offsets = totals.select(*k, bucket, *[_AGG[h](f"__{n}_tot").over(prior).alias(f"__{n}_off")
                                          for n, h in vals.items()])
    out = join_back(local, offsets, [*k, bucket])
    for name, how in vals.items():
        off, loc = F.col(f"__{name}_off"), F.col(f"__{name}_local")
        combined = (F.greatest(off, loc) if how == "max"  # greatest skips NULLs
                    else F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0)))
        out = out.withColumn(name, combined).drop(f"__{name}_v", f"__{name}_local", f"__{name}_off")
    return out


def running(
    df: DataFrame,
    keys,
    order: list,
    bucket: str,
    value: Column | str | None,
    how: str = "sum",
    name: str = "running",
    exclusive: bool = False,
) -> DataFrame:
    """Running ``sum``/``max``/``count`` of ``value`` over ``order`` within ``keys``.

    ``order`` must be a total order inside each key (add a unique tie-break),
    and ``bucket`` must be monotone in it. ``exclusive`` leaves out the current
    row (NULL for the first row when nothing precedes it, for ``max``).
    """
    return running_many(df, keys, order, bucket, {name: (how, value)}, exclusive)


def previous(
    df: DataFrame,
    keys,
    order: list,
    bucket: str,
    value: str,
    name: str = "prev",
) -> DataFrame:
    """Value of ``value`` on the previous row (by the total order ``order``)
    within ``keys``; NULL on the first row. The first row of each bucket takes
    the last value of the nearest earlier non-empty bucket."""
    k = _keys(keys)
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*k, bucket).orderBy(*order)
    local = df.withColumn("__lag", F.lag(value).over(w))
    # last value of each bucket: a plain max when the value is the leading
    # order column (hash aggregate), else max_by over the whole order
    last_expr = F.max(value) if value == order[0] else F.max_by(value, F.struct(*order))
    last = df.groupBy(*k, bucket).agg(last_expr.alias("__last"))
    prior = Window.partitionBy(*k).orderBy(bucket)
    carry = last.select(*k, bucket, F.lag("__last").over(prior).alias("__carry"))
    out = join_back(local, carry, [*k, bucket])
    # a NULL lag means "first in its bucket" (the value column itself is never NULL here)
    return out.withColumn(name, F.coalesce(F.col("__lag"), F.col("__carry"))).drop("__lag", "__carry")


def row_number(df: DataFrame, keys, order: list, bucket: str, name: str = "rn") -> DataFrame:
    """1-based position inside ``keys`` by ``order`` (a total order)."""
    return running(df, keys, order, bucket, None, how="count", name=name)


def time_bucket(c, width_seconds: int) -> Column:
    """Bucket id of a timestamp: whole ``width_seconds`` since the epoch."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(F.unix_micros(col) / F.lit(width_seconds * 1_000_000)).cast("bigint")


def int_bucket(c, width: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col / F.lit(width)).cast("bigint")


def adaptive_bucket(df: DataFrame, keys, order, target_rows: int | None = None, name: str = "__bucket") -> DataFrame:
    """Add a bucket column monotone in ``order`` (a column or a list of them) inside
    each key.

    Rows are range-partitioned by (keys, order): Spark samples them and cuts the
    whole sequence in parts of about equal numbers of rows, whatever the spread of
    the values, and the part is the bucket. A cold key lies in one bucket, or in two
    if a cut falls into it; a key holding a third of all rows takes a third of them.
    Parts are as many as ``spark.sql.shuffle.partitions`` (AQE joins small ones);
    ``target_rows`` counts the rows first and makes parts of about that many.
    Rows that tie in ``order`` stay in one bucket, so end it with a unique column.
    The rows are written once, as the cuts are those of one sampling; every reader
    then sees the same buckets, a task that runs again too. NULL is a key like any
    other, and as an order value it comes first."""
    from flumen.session import materialize

    cols = [*_keys(keys), *(order if isinstance(order, list | tuple) else [order])]
    if target_rows is None:
        cut = df.repartitionByRange(*cols)
    else:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cut = df.repartitionByRange(max(least, -(-df.count() // target_rows)), *cols)
    return materialize(cut.withColumn(name, F.spark_partition_id().cast("bigint")), "buckets")
