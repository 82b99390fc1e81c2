"""Food-order cleaning: lower-case, strip ``?%&``, add the constant column,
split into named fields, day column for day-partitioned loading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flumen.functions import strings
from flumen.operators import rows


def clean(lines: DataFrame, names, line_col: str = "value", constant: str = "1",
          day_field: str | None = None, day_format: str = "yyyy-MM-dd") -> DataFrame:
    """``line.lower()`` -> remove ``[?%&]`` -> ``+ ',1'`` -> named string fields
    (``names`` includes the constant's name last) -> optional ``ingest_date``."""
    cleaned = lines.select(F.concat(strings.remove_chars(strings.lower(line_col)),
                                    F.lit("," + constant)).alias("__line"))
    out = rows.csv_to_struct(cleaned, "__line", names)
    if day_field:
        out = out.withColumn("ingest_date", F.date_format(F.to_date(day_field, day_format), "yyyy-MM-dd"))
    return out
