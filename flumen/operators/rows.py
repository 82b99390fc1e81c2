"""Row mappings and filters: DataFrame -> DataFrame functions for ``df.transform``.

All are narrow transformations (no shuffle) built from column expressions, so
Catalyst fuses them into one codegen stage and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.functions import dates, numeric, strings

# Fixed value: user columns that must not leave the source system.
SENSITIVE_USER_COLUMNS = ("lat", "lng", "ip", "user_agent")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- projections ------------------------------------------------------------

def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_fields(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def drop_sensitive(df: DataFrame, sensitive=SENSITIVE_USER_COLUMNS, sort_columns: bool = True) -> DataFrame:
    """Analytics copy: sensitive columns removed, remaining columns in name order."""
    keep = [c for c in df.columns if c not in set(sensitive)]
    return df.select(*(sorted(keep) if sort_columns else keep))


def with_profit(df: DataFrame, sell: str, buy: str, pieces: str, name: str = "profit") -> DataFrame:
    """``(sell - buy) * pieces`` appended as a new column."""
    return df.withColumn(name, (_c(sell) - _c(buy)) * _c(pieces))


def with_processing_time(df: DataFrame, name: str = "processing_timestamp") -> DataFrame:
    """Wall-clock time as ``yyyy-MM-dd HH:mm:ss`` text (one value per query/micro-batch)."""
    return df.withColumn(name, F.date_format(F.current_timestamp(), dates.SQL_SECONDS))


def with_json(df: DataFrame, name: str = "json", cols=None) -> DataFrame:
    """Record -> JSON object text."""
    cols = cols or df.columns
    return df.withColumn(name, F.to_json(F.struct(*cols)))


def with_constant(df: DataFrame, name: str = "new_col", value="1") -> DataFrame:
    return df.withColumn(name, F.lit(value))


def csv_to_struct(df: DataFrame, line_col: str, names, sep: str = ",", keep_line: bool = False) -> DataFrame:
    """Positional CSV text -> named string columns (``from_csv`` would need a schema
    string; ``split`` keeps it literal). Extra fields are ignored; missing
    trailing fields are NULL."""
    parts = strings.split_fields(line_col, sep)
    cols = [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    extra = [F.col(line_col)] if keep_line else []
    return df.select(*[c for c in df.columns if c != line_col], *extra, *cols)


def to_fahrenheit(df: DataFrame, *cols: str) -> DataFrame:
    """Convert temperature columns from Celsius: ``x * 1.8 + 32``."""
    return df.withColumns({c: numeric.celsius_to_fahrenheit(c) for c in cols})


def with_key(df: DataFrame, name: str, parts, sep: str = ", ") -> DataFrame:
    """Display key ``a + sep + b``; the real key columns stay in place."""
    return df.withColumn(name, F.concat_ws(sep, *[_c(p) for p in parts]))


def format_text(fmt: str, *cols) -> Column:
    """``format_string`` with Java format specifiers."""
    return F.format_string(fmt, *[_c(c) for c in cols])


def flat_map(df: DataFrame, array_col: Column, name: str, keep=None, position: str | None = None) -> DataFrame:
    """One row in, zero or more rows out: explode an array expression.
    Empty arrays yield no rows (like a generator that yields nothing)."""
    keep = [c for c in (keep if keep is not None else df.columns)]
    if position:
        return df.select(*keep, F.posexplode(array_col).alias(position, name))
    return df.select(*keep, F.explode(array_col).alias(name))


def lines_of(df: DataFrame, text_col: str, keep=(), with_index: bool = True) -> DataFrame:
    """Each text -> its lines (line_no starts at 0)."""
    if with_index:
        return df.select(*keep, F.posexplode(strings.lines(text_col)).alias("line_no", "line"))
    return df.select(*keep, F.explode(strings.lines(text_col)).alias("line"))


# --- filters ----------------------------------------------------------------

def where_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.filter(_c(col).startswith(prefix))


def where_below(df: DataFrame, col: str, bound) -> DataFrame:
    return df.filter(_c(col) < F.lit(bound))


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(_c(col) == F.lit(value))


def where_in(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(_c(col).isin(list(values)))


def where_length_between(df: DataFrame, col: str, lower: int, upper: int | None = None) -> DataFrame:
    """``lower <= len(x) <= upper``; no upper bound by default."""
    n = F.length(_c(col))
    return df.filter(n >= lower if upper is None else n.between(lower, upper))


def where_stripped_equals(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.filter(strings.strip(col) == F.lit(value))


def where_even(df: DataFrame, col: str) -> DataFrame:
    """Even integers only; the column must be integral (checked before any job)."""
    dt = df.schema[col].dataType
    if not isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"where_even needs an integer column, {col!r} is {dt.simpleString()}")
    return df.filter(_c(col) % 2 == 0)


def where_limit(df: DataFrame, cond: Column, n: int, order_by) -> DataFrame:
    """``WHERE cond LIMIT n`` made deterministic by an explicit order key; the
    plan is TakeOrderedAndProject (a per-partition top-n, no full sort)."""
    return df.filter(cond).orderBy(*order_by).limit(n)
