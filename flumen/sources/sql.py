"""SQL as a source: queries over registered tables or over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flumen.sources.tables import register_views


def register_tables(spark: SparkSession, sf_dir: str, names) -> None:
    """Make tables queryable by name (a warehouse-style query source)."""
    register_views(spark, sf_dir, names)


def query(spark: SparkSession, text: str) -> DataFrame:
    """Run SQL text; an unknown table raises ``AnalysisException`` at once."""
    return spark.sql(text)


def sql_over(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL over DataFrames passed by name: ``FROM {PCOLLECTION}`` in the text
    refers to the ``PCOLLECTION=`` argument. Parsed into the same Catalyst plan
    as the DataFrame form -- no extra process, no materialisation."""
    return spark.sql(text, **frames)
