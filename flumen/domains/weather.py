"""Weather statistics: CSV record -> Fahrenheit -> low/high/total per place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flumen import schemas
from flumen.operators import rows
from flumen.sources.files import csv_typed


def parse(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """CSV text -> typed weather record (bad numbers raise)."""
    return csv_typed(lines, line_col, schemas.WEATHER)


def convert_units(records: DataFrame) -> DataFrame:
    """Both temperatures from Celsius to Fahrenheit."""
    return rows.to_fahrenheit(records, "low_temp", "high_temp")


def compute_statistics(records: DataFrame, key: str = "loc_id") -> DataFrame:
    """Per place: lowest low, highest high, total precipitation."""
    return records.groupBy(key).agg(F.min("low_temp").alias("record_low"),
                                    F.max("high_temp").alias("record_high"),
                                    F.sum("precip").alias("total_precip"))


def weather_stats(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """The whole composite: parse -> convert -> statistics."""
    return compute_statistics(convert_units(parse(lines, line_col)))


def as_json(stats: DataFrame) -> DataFrame:
    return stats.select(F.to_json(F.struct(*stats.columns)).alias("value"))
