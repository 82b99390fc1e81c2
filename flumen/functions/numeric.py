"""Math, cast and tier recipes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_product(a, b) -> Column:
    """``ln(a) * ln(b)`` (composite package score)."""
    return F.ln(_c(a)) * F.ln(_c(b))


def to_int(c, strict: bool = True) -> Column:
    """``int(text.strip())``: strict raises on bad text (ANSI cast), else NULL."""
    col = F.btrim(_c(c).cast("string"), F.lit(" \t\r\n"))
    return col.cast("bigint") if strict else col.try_cast("bigint")


def to_double(c, strict: bool = True) -> Column:
    col = F.btrim(_c(c).cast("string"), F.lit(" \t\r\n"))
    return col.cast("double") if strict else col.try_cast("double")


def celsius_to_fahrenheit(c) -> Column:
    return _c(c) * F.lit(1.8) + F.lit(32)


def tiers(c, bands, default=0) -> Column:
    """Score by inclusive ranges: ``bands`` = [(low, high, score), ...], high None
    = no upper bound; first match wins, else ``default``."""
    col = _c(c)
    expr = None
    for low, high, score in bands:
        cond = col >= low if high is None else col.between(low, high)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(default))


def steps(c, thresholds, default) -> Column:
    """Score by descending lower bounds: ``thresholds`` = [(min, score), ...]."""
    col = _c(c)
    expr = None
    for low, score in thresholds:
        expr = F.when(col >= low, F.lit(score)) if expr is None else expr.when(col >= low, F.lit(score))
    return expr.otherwise(F.lit(default))
