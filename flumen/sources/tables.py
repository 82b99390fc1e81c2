"""Loader for the parquet tables the library's recipes run on.

Only the columns a query selects are read (Catalyst prunes the scan), and
filters written on the returned DataFrame reach the parquet reader as
``PushedFilters``. ``TIMESTAMP_NTZ`` columns are cast to ``TIMESTAMP`` in the
UTC session zone because watermarks refuse NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.session import ensure_utc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; NTZ timestamps become UTC ``TIMESTAMP`` columns."""
    ensure_utc(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if not ntz:
        return df
    return df.select(
        *[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns]
    )


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose tables to ``spark.sql`` under their own names."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)
