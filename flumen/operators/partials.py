"""Aggregates that are built in parts and merged: ``{name: (how, column)}`` with ``how`` in
count, sum, min, max, mean (``column`` None: count rows). Windows that are made of smaller
pieces (slices, partial sessions) aggregate each piece once and merge the pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT = {"count": ("count", None)}

_PARTS = {"count": [(F.count, F.sum)], "sum": [(F.sum, F.sum)], "min": [(F.min, F.min)], "max": [(F.max, F.max)],
          "mean": [(F.sum, F.sum), (F.count, F.sum)]}


def _part(name: str, i: int) -> str:
    return f"__{name}_{i}"


def of_rows(aggs: dict) -> list[Column]:
    """Accumulators over rows."""
    out = []
    for name, (how, column) in aggs.items():
        c = F.lit(1) if column is None else F.col(column) if isinstance(column, str) else column
        out += [make(c).alias(_part(name, i)) for i, (make, _) in enumerate(_PARTS[how])]
    return out


def of_parts(aggs: dict) -> list[Column]:
    """The aggregates over rows of accumulators; a mean of nothing is NULL."""
    out = []
    for name, (how, _) in aggs.items():
        merged = [merge(_part(name, i)) for i, (_, merge) in enumerate(_PARTS[how])]
        out.append((merged[0] if how != "mean" else F.try_divide(merged[0], merged[1])).alias(name))
    return out


def names(aggs: dict) -> list[str]:
    """Columns of the accumulators."""
    return [_part(name, i) for name, (how, _) in aggs.items() for i in range(len(_PARTS[how]))]
