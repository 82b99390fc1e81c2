"""Time recipes (UTC session). Built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats used by the records.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"     # event time cut to whole seconds
SQL_SECONDS = "yyyy-MM-dd HH:mm:ss"       # processing time / reformatted event time
DAY_MONTH_YEAR = "dd-MM-yyyy"             # bank payment and due dates


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_to_seconds(c, cut: int = 8) -> Column:
    """``'2019-06-19T16:06:45.123456Z'[:-8]`` -> timestamp of whole seconds.
    Dropping the last ``cut`` characters truncates (never rounds) the fraction."""
    col = _c(c)
    return F.to_timestamp(F.substr(col, F.lit(1), F.length(col) - cut), ISO_SECONDS)


def from_epoch_seconds(c) -> Column:
    """Epoch seconds (number or numeric text) -> timestamp."""
    return F.timestamp_seconds(_c(c).cast("long"))


def to_epoch_seconds(c) -> Column:
    return F.unix_timestamp(_c(c))


def as_text(c, fmt: str = SQL_SECONDS) -> Column:
    return F.date_format(_c(c), fmt)


def reformat(c, in_fmt: str | None = None, out_fmt: str = SQL_SECONDS) -> Column:
    """Parse a time text and print it again in another layout."""
    ts = F.to_timestamp(_c(c), in_fmt) if in_fmt else F.to_timestamp(_c(c))
    return F.date_format(ts, out_fmt)


def parse_dmy(c) -> Column:
    """``' 30-01-2018 '`` -> date (blanks around it are removed first)."""
    return F.to_date(F.btrim(_c(c), F.lit(" \t\r\n")), DAY_MONTH_YEAR)


def month_of(c) -> Column:
    return F.month(_c(c))
