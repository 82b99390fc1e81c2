"""File and table sinks.

Writes are distributed (one file per task) unless a single file is asked for;
that form is for bounded results (an aggregate, a top-n), since one file means
one writing task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.operators.sets import flatten_branches
from flumen.schemas import SchemaMismatch


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, cast to its types (a table sink's
    declared schema, enforced before the write)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_text(df: DataFrame, path: str, col: str | Column = "value", mode: str = "overwrite") -> None:
    """One text line per row, sharded as ``part-*`` files under ``path``."""
    c = F.col(col) if isinstance(col, str) else col
    df.select(c.cast("string").alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Exactly one CSV file (for bounded results only)."""
    df.coalesce(1).write.mode("overwrite").option("header", header).csv(path)


# Fixed value: timestamps in text files keep microseconds (Spark's default
# text format stops at milliseconds).
TIMESTAMP_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one object per row."""
    df.write.mode(mode).option("timestampFormat", TIMESTAMP_MICROS).json(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                schema: T.StructType | None = None, partition_by=None) -> None:
    """Parquet table at ``path``: ``overwrite`` replaces (create if missing),
    ``append`` adds files."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_text_branches(df: DataFrame, path: str, branches: dict, col: str = "value", name: str = "branch") -> dict[str, int]:
    """Several filtered copies of one input as text, in one pass: a row goes to the folder
    ``name=<branch>`` of every branch whose condition holds. Returns the rows that went to
    each, counted on the way by an observation of the same job."""
    seen = Observation("branches")
    counts = [F.count_if(cond).alias(n) for n, cond in branches.items()]
    out = flatten_branches(df.observe(seen, *counts), branches, name).select(F.col(col).cast("string").alias("value"), name)
    out.write.mode("overwrite").partitionBy(name).option("lineSep", "\n").text(path)
    return {n: int(seen.get[n]) for n in branches}


def save_named(df: DataFrame, table: str, schema: T.StructType, mode: str = "append", path: str | None = None) -> None:
    """A table of the session catalog with a declared schema. It is created if missing;
    ``overwrite`` replaces its rows, ``append`` adds to them. Rows are matched to the table's
    columns by name and cast to their types before anything is written; ``path`` is the place
    of a new table (else the warehouse's)."""
    spark = df.sparkSession
    out = conform(df, schema)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
    held = spark.table(table).schema
    if [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in schema]:
        raise SchemaMismatch(f"{table} has other columns: {held.simpleString()}")
    out.write.insertInto(table, overwrite=mode == "overwrite")


def write_day_partitioned(df: DataFrame, path: str, day: Column | None = None,
                          name: str = "ingest_date", mode: str = "append") -> None:
    """Append into day partitions (``name=yyyy-MM-dd`` folders). Without a day
    expression the load day is used. Rows are rebalanced by day: small days share a
    task, a busy day is split by its bytes (AQE); readers prune by ``name``."""
    day = day if day is not None else F.current_date()
    out = df.withColumn(name, F.date_format(day, "yyyy-MM-dd"))
    out.hint("rebalance", name).write.mode(mode).partitionBy(name).parquet(path)
