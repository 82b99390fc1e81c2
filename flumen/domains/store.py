"""Store sales: text lines -> typed records of some cities -> profit, store and event time,
ready to be windowed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flumen import schemas
from flumen.functions import strings
from flumen.operators import rows
from flumen.sources.files import csv_typed


def parse(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """CSV text, with blanks around it, -> typed sales record (bad numbers raise)."""
    return csv_typed(lines.select(strings.strip(line_col).alias("line")), "line", schemas.STORE_SALES)


def profits(lines: DataFrame, cities, line_col: str = "value") -> DataFrame:
    """``store_id``, ``ts`` and ``profit`` ((sell - buy) x pieces) of the sales in some cities."""
    sold = rows.where_in(parse(lines, line_col), "store_location", list(cities))
    out = rows.with_profit(sold, sell="sell_price", buy="buy_rate", pieces="number_of_pieces_sold")
    return out.select("store_id", F.timestamp_seconds("unix_timestamp").alias("ts"), "profit")
