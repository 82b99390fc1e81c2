"""Registry of named recipes over the shared tables, each paired (where SQL can
state it) with an independent ANSI SQL oracle over the same tables.

A recipe is ``fn(spark, sf_dir) -> DataFrame``; it reads whole tables and
builds its plan from :mod:`flumen.operators`, :mod:`flumen.functions`,
:mod:`flumen.sources` and :mod:`flumen.streaming`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flumen.sources.tables import load


@dataclass(frozen=True)
class Recipe:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    note: str = ""


RECIPES: dict[str, Recipe] = {}


def recipe(key: str, oracle: str | None = None, note: str = ""):
    def deco(fn):
        if key in RECIPES:
            raise ValueError(f"duplicate recipe {key}")
        RECIPES[key] = Recipe(key, fn, oracle.strip() if oracle else None, note)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


# Output conventions shared with the oracles: times as text, doubles rounded
# (``+ 0.0`` turns a negative zero into zero), integers as BIGINT.
TS_SECONDS = "yyyy-MM-dd HH:mm:ss"
TS_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TS_SECONDS = "'%Y-%m-%d %H:%M:%S'"
SQL_TS_MICROS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts_text(c, fmt: str = TS_SECONDS) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)


def rnd(c, digits: int = 4) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def load_all() -> dict[str, Recipe]:
    """Import every plan module so their recipes register."""
    from flumen.plans import (  # noqa: F401
        aggs, domains, io_checks, joins_sets, rows, scalars, streams, triggers, windows,
    )
    return RECIPES
