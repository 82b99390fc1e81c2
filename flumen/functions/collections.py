"""Array, map and JSON recipes (higher-order built-ins, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def longest_gap(months, first: int = 1, last: int = 12) -> Column:
    """Longest run of missing values in an array of month numbers, counting
    the gap before the first (``m0 - first``), after the last (``last - mN``)
    and between sorted neighbours (``m[i] - m[i-1] - 1``).

    One fold over the sorted array (accumulator: previous month, best gap),
    so the array expression is evaluated once. NULL for an empty array."""
    m = F.array_sort(_c(months))
    init = F.struct(F.lit(first - 1).alias("prev"), F.lit(None).cast("int").alias("best"))
    folded = F.aggregate(
        m, init,
        lambda acc, x: F.struct(x.alias("prev"), F.greatest(acc["best"], x - acc["prev"] - 1).alias("best")),
        lambda acc: F.when(acc["best"].isNotNull(), F.greatest(acc["best"], F.lit(last) - acc["prev"])),
    )
    return folded


def map_get(m, key, missing=None) -> Column:
    """``d.get(k)``; a missing key gives ``missing`` (falsy)."""
    v = F.try_element_at(_c(m), key if isinstance(key, Column) else F.lit(key))
    return v if missing is None else F.coalesce(v, F.lit(missing))


def parse_json(c, schema: T.StructType) -> Column:
    """Lenient parse (missing -> NULL, extra -> dropped)."""
    return F.from_json(_c(c), schema)


def json_keys_exact(c, schema: T.StructType) -> Column:
    """True when the JSON object has exactly the schema's field names (the
    strictness of ``Record(**json.loads(line))``); False for junk or other keys."""
    expected = F.array(*[F.lit(n) for n in sorted(schema.fieldNames())])
    keys = F.sort_array(F.json_object_keys(_c(c)))
    return F.coalesce(keys == expected, F.lit(False))


def to_json_all(*cols) -> Column:
    return F.to_json(F.struct(*cols)) if cols else F.to_json(F.struct("*"))
