"""Approximate nearest neighbours by an inverted multi-index (operator 5).

Vectors are cut in two halves; each half has its own codebook of ``centroids``, fitted
by k-means on a bounded sample (the ``sample`` rows with the smallest hash of their id,
so every size is sampled alike). A row's cell is its pair of nearest centroids; every
row is indexed. A query walks the cells in the order of the inner product that their
entries may have with it: that of the centroids, and ``slack`` standard deviations of
what the entries' distance from their centroid adds to it. So cells of long vectors, wide
apart, come early, whatever their distance from the query. A heap holds the next pair of
each started row of centroids, and the walk ends when the cells it has met hold a
share of all rows (and ``least``, and more than ``k``). It gives the query its reach,
the bound of its last cell. The entries of all cells within reach are reranked by their
inner product in double precision.

The share is measured unless it is given: ``probes`` rows, those with the smallest hash of
their id, are compared with all rows, in blocks, and each of their true neighbours tells
how many entries the walk meets up to its cell; the share is what ``recall`` of them need.
So vectors in clusters have short walks, and random directions long ones.

Entries are dealt in blocks of equal size, in the order of their cells; a cell with a
third of all rows is spread over many blocks. Queries are dealt in chunks, in the order of
their cells, too, and a query goes only to the blocks that hold a cell within its reach,
a block only to the chunks with such a query. A task holds one block and one chunk,
computes inner products cell by cell for those queries that reach the cell, and gives
each query's best ``k`` of the block.

Vectors that are null, zero or hold a null or non-finite component take no part, nor do
rows with a null id or with another dimension than most of the sample. Of rows with
equal ids the smallest vector counts. Ties go to the smaller id. A query with fewer than
``k`` candidates gets them all. An empty table gives an empty result. Extra columns are
not read, whatever their names.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flumen.llm.common import arrow_udf, written
from flumen.sources.tables import load


@dataclass(frozen=True)
class Settings:
    centroids: int = 64             # per half
    sample: int = 20_000            # rows that the codebooks are fitted on, at most
    rounds: int = 12
    share: float | None = None      # of all rows: the entries that a query reranks; None: measured
    recall: float = 0.95            # of the probes' neighbours, for a measured share
    probes: int = 256
    least: int = 2000               # entries that it reranks in any case
    slack: float = 2.0              # standard deviations that a cell's bound allows for
    block: int = 4096               # entries of a task
    least_blocks: int = 8
    chunk: int = 4096               # queries of a task


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit(x: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """k-means; starts from rows evenly spread over the sample's order."""
    c = x[np.linspace(0, len(x) - 1, min(centroids, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        for j in range(len(c)):
            mine = near == j
            if mine.any():
                c[j] = x[mine].mean(axis=0)
    return c


def matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def distances(half: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances but for the vector's own square; the same for a vector wherever
    it stands in a batch."""
    return (centroids * centroids).sum(axis=1) - 2 * np.einsum("qd,kd->qk", half, centroids)


def spread(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Root mean square, per dimension, of the distance of each centroid's vectors from
    it; that of all vectors where it has none."""
    near = distances(x, centroids).argmin(axis=1)
    off = ((x - centroids[near]) ** 2).sum(axis=1) / max(1, x.shape[1])
    n = np.bincount(near, minlength=len(centroids))
    mean = np.bincount(near, weights=off, minlength=len(centroids)) / np.maximum(n, 1)
    return np.sqrt(np.where(n > 0, mean, off.mean()))


def bounds(half: np.ndarray, centroids: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """The inner product that a centroid's vectors may have with each query, negated: the
    best is the least. slack: what a query of length one is allowed for each centroid."""
    return -np.einsum("qd,kd->qk", half, centroids) - np.sqrt((half * half).sum(axis=1))[:, None] * slack


def reach(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, need: int) -> float:
    """Sum of the last cell of the walk that gathers ``need`` entries; one and two: the
    query's bounds of the centroids of its halves."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    x, y, held = one[a].tolist(), two[b].tolist(), sizes[np.ix_(a, b)].tolist()
    heap, got, last = [(x[0] + y[0], 0, 0)], 0, -np.inf
    while heap and got < need:
        last, i, j = heapq.heappop(heap)
        got += held[i][j]
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return last


class Index:
    """Codebooks, cell sizes and the table of entries (vec_id, vector, cell)."""

    def __init__(self, vectors: DataFrame, id_col: str, vector_col: str, settings: Settings):
        self.settings = s = settings
        clean = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
                 .where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector")))
        found = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(s.sample).toArrow()["vector"].to_pylist()
        self.width = width = int(np.bincount([len(v) for v in found]).argmax()) if found else 2
        half = self.half = width // 2
        x = np.array([v for v in found if len(v) == width], dtype=np.float64).reshape(-1, width)
        self.books = books = (fit(x[:, :half], s.centroids, s.rounds), fit(x[:, half:], s.centroids, s.rounds)) if len(x) else (np.zeros((1, half)), np.zeros((1, width - half)))
        parts = (x[:, :half], x[:, half:])
        self.slack = tuple(s.slack * spread(p, b) if len(x) else np.zeros(1) for p, b in zip(parts, books))
        count = len(books[1])

        @arrow_udf("int")
        def cell(column: pa.Array) -> pa.Array:
            v = matrix(column, width)
            return pa.array((distances(v[:, :half], books[0]).argmin(axis=1) * count + distances(v[:, half:], books[1]).argmin(axis=1)).astype(np.int32))
        self.entries = written(clean.where(F.size("vector") == width).withColumn("cell", cell("vector")), "multi-index")
        self.sizes = np.zeros((len(books[0]), count), dtype=np.int64)
        for r in self.entries.groupBy("cell").count().collect():        # centroids ** 2 rows at most
            self.sizes[divmod(r["cell"], count)] = r["count"]
        self.total = int(self.sizes.sum())
        self.blocks = max(s.least_blocks, -(-self.total // s.block))

    def share(self, k: int) -> float:
        """The share of all entries that a walk must meet for the asked recall."""
        s, width, half, books = self.settings, self.width, self.half, self.books
        if s.share is not None:
            return s.share
        found = self.entries.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(s.probes).toArrow()
        if not found.num_rows:
            return 1.0
        ids, q = found["vec_id"].to_numpy(), matrix(found["vector"], width)

        def near(batches):
            for b in batches:
                v, mine = matrix(b.column(1), width), b.column(0).to_numpy()
                score = np.where(ids[:, None] == mine[None, :], -np.inf, q @ v.T)
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                row = np.repeat(np.arange(len(q)), top.shape[1])
                at = top.ravel()
                good = score[row, at] > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(row[good].astype(np.int32)), b.column(2).take(pa.array(at[good])), pa.array(score[row, at][good])],
                                                 names=["probe", "cell", "score"])
        best = Window.partitionBy("probe").orderBy(F.desc("score"))
        rows = (self.entries.select("vec_id", "vector", "cell").mapInArrow(near, "probe int, cell int, score double")
                .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).select("probe", "cell").toArrow())
        probe, cell = rows["probe"].to_numpy(), rows["cell"].to_numpy()
        one, two = bounds(q[:, :half], books[0], self.slack[0]), bounds(q[:, half:], books[1], self.slack[1])
        need, sizes = [], self.sizes.ravel()
        for i in range(len(q)):
            bound = (one[i][:, None] + two[i][None, :]).ravel()
            order = np.argsort(bound, kind="stable")
            met = np.cumsum(sizes[order])
            upto = np.searchsorted(bound[order], bound[cell[probe == i]], side="right") - 1
            need.append(met[upto])
        need = np.concatenate(need)
        return float(np.quantile(need, s.recall, method="higher")) / self.total if len(need) else 1.0

    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) block of each cell's entries."""
        sizes, total = self.sizes.ravel(), max(1, self.total)
        start = np.cumsum(sizes) - sizes
        last = np.minimum((start + sizes) * self.blocks / total, self.blocks - 1).astype(np.int64)
        return np.minimum(start * self.blocks / total, self.blocks - 1).astype(np.int64), last

    def _part(self, parts: int) -> Column:
        """The part of a row: rows stand in the order of their cells, within a cell in
        that of a hash of their id, and are cut in equal parts."""
        sizes, start, total, blocks = self.sizes.ravel(), np.cumsum(self.sizes.ravel()) - self.sizes.ravel(), max(1, self.total), parts

        @arrow_udf("int")
        def run(cell: pa.Array, mixed: pa.Array) -> pa.Array:
            c = cell.to_numpy()
            part = (mixed.to_numpy().view(np.uint64) >> np.uint64(11)) * 2.0**-53
            return pa.array(np.minimum((start[c] + part * sizes[c]) * blocks / total, blocks - 1).astype(np.int32))
        return run("cell", F.xxhash64("vec_id"))

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, vec_id, score): the k best of each query's candidates but
        itself. queries: rows of ``entries``."""
        s, width, half, books, sizes = self.settings, self.width, self.half, self.books, self.sizes
        need = max(int(np.ceil(self.total * self.share(k))), s.least, k + 1)
        count, slack, blocks = len(books[1]), self.slack, self.blocks
        (low, high), filled = self._places(), np.flatnonzero(sizes.ravel())

        @arrow_udf("struct<reach:double,blocks:array<int>>")
        def far(column: pa.Array) -> pa.Array:
            v = matrix(column, width)
            one, two = bounds(v[:, :half], books[0], slack[0]), bounds(v[:, half:], books[1], slack[1])
            limit, found = [], []
            for a, b in zip(one, two):
                limit.append(reach(a, b, sizes, need))
                cells = filled[(a[:, None] + b[None, :]).ravel()[filled] <= limit[-1]]
                step = np.bincount(low[cells], minlength=blocks + 1) - np.bincount(high[cells] + 1, minlength=blocks + 1)
                found.append(np.flatnonzero(np.cumsum(step)[:blocks]))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)),
                                             pa.array(np.concatenate(found).astype(np.int32) if found else np.zeros(0, dtype=np.int32)))
            return pa.StructArray.from_arrays([pa.array(limit, type=pa.float64()), lists], names=["reach", "blocks"])

        chunks = max(1, -(-queries.count() // s.chunk))
        asked = written(queries.select("vec_id", "vector", far("vector").alias("f"), self._part(chunks).alias("chunk"))
                        .select("vec_id", "vector", F.col("f.reach").alias("reach"), "chunk", F.explode("f.blocks").alias("block")), "asked")
        wanted = asked.select(F.col("block").alias("block"), F.col("chunk").alias("chunk")).distinct()
        held = self.entries.select("vec_id", "vector", "cell", self._part(blocks).alias("block")).join(wanted, "block")

        def best(entries: pa.Table, chunk: pa.Table) -> pa.Table:
            out_q, out_v, out_s = [], [], []
            if entries.num_rows and chunk.num_rows:
                v, q = matrix(entries["vector"], width), matrix(chunk["vector"], width)
                ids, asking = entries["vec_id"].to_numpy(), chunk["vec_id"].to_numpy()
                one, two = bounds(q[:, :half], books[0], slack[0]), bounds(q[:, half:], books[1], slack[1])
                limit, cells = chunk["reach"].to_numpy(), entries["cell"].to_numpy()
                order = np.argsort(cells, kind="stable")
                edges = np.concatenate(([0], np.flatnonzero(np.diff(cells[order])) + 1, [len(order)]))
                near = np.full((len(q), len(v)), -np.inf)
                for a, b in zip(edges[:-1], edges[1:]):
                    mine = order[a:b]
                    i, j = divmod(int(cells[mine[0]]), count)
                    who = np.flatnonzero(one[:, i] + two[:, j] <= limit)
                    near[np.ix_(who, mine)] = q[who] @ v[mine].T
                near[asking[:, None] == ids[None, :]] = -np.inf
                if len(v) > k:
                    least = -np.partition(-near, k - 1, axis=1)[:, k - 1]
                    near[near < (least - 1e-9)[:, None]] = -np.inf
                row, at = np.nonzero(near > -np.inf)
                # each pair on its own, so that equal vectors have equal scores
                score = (q[row] * v[at]).sum(axis=1)
                order = np.lexsort((ids[at], -score, row))
                row, at, score = row[order], at[order], score[order]
                first = np.searchsorted(row, row)
                keep = np.arange(len(row)) - first < k
                out_q, out_v, out_s = asking[row[keep]], ids[at[keep]], score[keep]
            return pa.table({"query_id": pa.array(out_q, type=pa.int64()), "vec_id": pa.array(out_v, type=pa.int64()), "score": pa.array(out_s, type=pa.float64())})

        found = held.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(best, "query_id long, vec_id long, score double")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               settings: Settings = Settings()) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by ``every``."""
    index = Index(vectors, id_col, vector_col, settings)
    return index.search(index.entries.where(F.col("vec_id") % every == 0), k)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: the 20 nearest rows of each query vector."""
    return neighbours(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
