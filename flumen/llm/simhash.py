"""SimHash near-dedup by multi-index hashing (operator 6).

A text's fingerprint has a bit set where more than half of its shingle hashes have
it. Two fingerprints within ``distance`` bits agree, up to ``distance // segments``
bits, in one of ``segments`` slices; so each slice has a table, every fingerprint
enumerates the Hamming ball of that radius in each slice, fetches what the tables
hold there and verifies the whole distance. Equal fingerprints are one node, and
only fingerprints of parts that are not linked yet are compared, in rising
distance, so a large group of near copies gives few links rather than all pairs.

Nulls: a null or blank text has fingerprint zero and links like any other. A null
id stays a row; it is never a component's id unless its whole component has none.
Repeated rows give repeated result rows. Texts of any length are counted whole. An empty
table gives an empty result. ``keep_one`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flumen.llm.common import arrow_udf, unused, written
from flumen.llm.graph import components
from flumen.sources.tables import load


BITS = 64
_LIMIT = 1 << 14            # shingles whose bits are counted at once


def fingerprint_of(text: bytes, words: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    stops = ends[words - 1:] if len(parts) >= words else ends[-1:]
    view, votes = memoryview(joined), np.zeros(BITS, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, _LIMIT):
        pairs = zip(starts[at:min(n, at + _LIMIT)].tolist(), stops[at:at + _LIMIT].tolist())
        h = np.array([hashed(view[a:b], 42) for a, b in pairs], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | Column, words: int = 4) -> Column:
    """Fingerprint of a text column as a long (its bits, in two's complement)."""
    @arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        out = [fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else b"", words) for x in column]
        return pa.array(np.array(out, dtype=np.uint64).view(np.int64))
    return run(text)


def _slices(segments: int) -> list[tuple[int, list[int]]]:
    """(mask, its bits) of each slice, as even as can be."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(sum(1 << b for b in range(a, z)), list(range(a, z))) for a, z in zip(cuts, cuts[1:])]


def _ball(bits: list[int], radius: int) -> list[int]:
    from itertools import combinations
    return [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(bits, r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(nodes: DataFrame, distance: int, segments: int) -> DataFrame:
    """Pairs (a, b) of fingerprints of different parts within ``distance`` bits.
    nodes: (fp, part). Each slice holds ``distance // segments`` errors at most in
    the slice that has fewest.

    Both sides hold a row of ``nodes`` several times, which Spark's estimate leaves out:
    where the file of ``nodes`` is under the broadcast threshold it would send one of
    them, all probes even, through the driver. So the join is asked to shuffle."""
    radius = distance // segments
    table, probes = [], []
    for i, (mask, bits) in enumerate(_slices(segments)):
        table.append(F.struct(F.lit(i).alias("slice"), F.lit(_signed(mask)).alias("mask")))
        probes += [F.struct(F.lit(i).alias("slice"), F.lit(_signed(mask)).alias("mask"), F.lit(_signed(x)).alias("flip"))
                   for x in _ball(bits, radius)]
    held = (nodes.select(F.col("fp").alias("b"), F.col("part").alias("pb"), F.inline(F.array(*table)))
            .select("b", "pb", "slice", F.col("b").bitwiseAND(F.col("mask")).alias("key")))
    asked = (nodes.select(F.col("fp").alias("a"), F.col("part").alias("pa"), F.inline(F.array(*probes)))
             .select("a", "pa", "slice", F.col("a").bitwiseXOR(F.col("flip")).bitwiseAND(F.col("mask")).alias("key")))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return asked.hint("merge").join(held, (asked["slice"] == held["slice"]) & (asked["key"] == held["key"])
                      & (F.col("a") < F.col("b")) & (F.col("pa") != F.col("pb")) & near).select("a", "b")


def parts_of(fps: DataFrame, distance: int, segments: int) -> DataFrame:
    """(fp, part) of every distinct fingerprint in ``fps``. Links within
    ``segments - 1`` bits need no enumeration (one slice agrees wholly) and contract
    the tight groups; the whole distance is then asked between different parts."""
    nodes = written(fps.select("fp").distinct().select("fp", F.col("fp").alias("part")), "fingerprints")
    for d in sorted({min(distance, segments - 1), distance}):
        found = components(links(nodes, d, segments)
                           .join(nodes.select(F.col("fp").alias("a"), F.col("part").alias("x")), "a")
                           .join(nodes.select(F.col("fp").alias("b"), F.col("part").alias("y")), "b")
                           .select(F.col("x").alias("a"), F.col("y").alias("b")))
        nodes = written(nodes.join(found, nodes["part"] == found["node"], "left")
                        .select("fp", F.coalesce(found["part"], nodes["part"]).alias("part")), "parts")
    return nodes


def _named(docs: DataFrame, id_col: str, text_col: str, words: int, distance: int, segments: int) -> DataFrame:
    """(id, fp, part, component_id) per row. part is the component's own key, a
    fingerprint of it; component_id is null where no row of it has an id, and two
    components share it where an id is repeated."""
    light = written(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash")
    parts = parts_of(light, distance, segments)
    least = light.groupBy("fp").agg(F.min("id").alias("id")).join(parts, "fp")
    # a part's smallest id goes to its fingerprints first, so the last join is on fp alone
    # written first: joined without an exchange of its own, it would keep AQE from
    # splitting the partition of a large part
    ids = written(least.groupBy("part").agg(F.min("id").alias("component_id")), "component-ids")
    named = parts.join(ids, "part").select(F.col("fp").alias("f"), "part", "component_id")
    return light.join(named, light["fp"] == named["f"]).select(F.col("id"), "fp", "part", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    distance: int = 4, segments: int = 3) -> DataFrame:
    """(id, fp, component_id) per row: component_id is the smallest id reachable over
    links of ``distance`` bits or fewer, the row's own included. Only the id and the
    eight bytes of the fingerprint are shuffled, never the text."""
    return _named(docs, id_col, text_col, words, distance, segments).select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
             distance: int = 4, segments: int = 3) -> DataFrame:
    """One whole row of each component: that with the smallest id (a null id comes
    last), of equal ids the smallest text. Components are told apart by their
    fingerprints, so null or repeated ids join none."""
    found = _named(docs, id_col, text_col, words, distance, segments)
    first = found.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("fp"))).alias("k"))
    own_fp, kept_id, kept_fp, place = unused(docs, 4)
    kept = first.select(F.col("k.id").alias(kept_id), F.col("k.fp").alias(kept_fp))
    marked = docs.withColumn(own_fp, fingerprint(F.col(text_col), words))
    one = marked.join(kept, marked[id_col].eqNullSafe(kept[kept_id]) & (marked[own_fp] == kept[kept_fp]))
    order = Window.partitionBy(kept_id, kept_fp).orderBy(F.col(text_col))
    return one.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the SimHash component of every document."""
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
