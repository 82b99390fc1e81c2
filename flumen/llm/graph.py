"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flumen.llm.common import written


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, part) for every node of ``edges`` (a, b); part is the smallest node
    that can be reached. Nodes without an edge are not listed.

    Each round sends a node's larger neighbours to its smallest neighbour, then the
    smaller ones likewise, until every part is a star. Rounds grow with the
    logarithm of a part's size. The minima combine before the shuffle and are written
    before they are joined back, so that the join has an exchange on both sides and AQE
    can split a hot centre. Every round is written to the shared folder, which cuts the
    lineage."""
    e = written(edges.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"))
                .where("big <> small").distinct(), "star")
    before = None
    while (now := _signature(e)) != before:
        before = now
        both = e.select(F.col("big").alias("u"), F.col("small").alias("v")).union(e.select("small", "big"))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("big"), F.col("m").alias("small")).distinct())
        low = large.groupBy("big").agg(F.min("small").alias("m"))
        e = written(large.join(low, "big")
                    .select(F.inline(F.array(F.struct(F.col("big"), F.col("m").alias("small")),
                                             F.struct(F.col("small").alias("big"), F.col("m").alias("small")))))
                    .where("big <> small").distinct(), "star")
    return e.select(F.col("big").alias("node"), F.col("small").alias("part")).union(
        e.select("small", "small").distinct())
