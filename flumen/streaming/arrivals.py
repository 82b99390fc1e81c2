"""A table as a stream of arrivals, for data whose arrival order is a column.

The arrivals are written in one job as a fixed number of slices, a file each, and read by
the ordinary file source under admission control: one file per micro-batch, until all are
read. A file is splittable, so the rows of a micro-batch are read in parallel. The source
takes files by modification time; after the job, the slices' times are set in slice order
(one call of the file system per slice, no data passes the driver).

What late data then means is fixed by the slices: in the micro-batch of slice b, the
watermark is the highest event time of the slices before b, less the lateness.

Where lateness is to be judged more often than there are micro-batches, the source says
how far event time had come when a row arrived (:func:`as_marked_stream`), a mark for
every so many arrivals; a micro-batch then holds many of them.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flumen.operators import ordered
from flumen.session import scratch_path

SLICES = 12
#: Marks that are ordered together in :func:`with_seen`.
MARKS_PER_GROUP = 1000


def slice_of(df: DataFrame, arrival: str, slices: int = SLICES) -> Column:
    """Number of the slice of an integer arrival position (0 up to its maximum): the
    positions' range in ``slices`` equal parts."""
    last = df.agg(F.max(arrival)).first()[0] or 0
    return F.expr(f"`{arrival}` * {slices}L div {last + 1}L")


def write_slices(df: DataFrame, number: Column, slices: int = SLICES, label: str = "arrivals") -> str:
    """Write ``df`` in one job as slices 0 to ``slices`` - 1; returns the folder."""
    path = scratch_path(df.sparkSession, label)
    numbered = df.withColumn("__slice", number.cast("int"))
    numbered.repartition(slices, "__slice").write.mode("overwrite").partitionBy("__slice").parquet(path)
    _set_order(df.sparkSession, path, slices)
    return path


def _set_order(spark: SparkSession, path: str, slices: int) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    first = int(time.time() * 1000) - 1000 * slices
    for k in range(slices):
        at = jvm.org.apache.hadoop.fs.Path(folder, f"__slice={k}")
        if not fs.exists(at):
            continue
        for status in fs.listStatus(at):
            fs.setTimes(status.getPath(), first + 1000 * k, -1)
            if fs.getFileStatus(status.getPath()).getModificationTime() != first + 1000 * k:
                raise OSError(f"the file system of {path} does not keep modification times, which order the slices")


def read_slices(spark: SparkSession, path: str, schema) -> DataFrame:
    """The slices as a stream, one per micro-batch (run it with ``availableNow``)."""
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 1).parquet(path))


def as_stream(df: DataFrame, arrival: str, slices: int = SLICES, label: str = "arrivals") -> DataFrame:
    """``df`` as a stream in slices of its arrival column (see the module)."""
    return read_slices(df.sparkSession, write_slices(df, slice_of(df, arrival, slices), slices, label), df.schema)


def with_mark(df: DataFrame, arrival: str, rows: int) -> DataFrame:
    """Add ``mark``, the number of the ``rows`` arrival positions that a row lies in."""
    return df.withColumn("mark", F.expr(f"(`{arrival}` - pmod(`{arrival}`, {rows})) div {rows}"))


def with_seen(marked: DataFrame, ts: str) -> DataFrame:
    """Add ``seen``, the highest event time of all earlier marks (NULL in the first). Rows
    without an arrival position never arrive. One row per mark is ordered, in groups."""
    tops = marked.where(F.col("mark").isNotNull()).groupBy("mark").agg(F.max(ts).alias("__top"))
    tops = tops.withColumn("__group", F.floor(F.col("mark") / MARKS_PER_GROUP))
    seen = ordered.running(tops, [], ["mark"], "__group", "__top", "max", "seen", exclusive=True)
    return marked.join(seen.select("mark", "seen"), "mark")


def as_marked_stream(df: DataFrame, arrival: str, ts: str, rows: int, slices: int = SLICES, label: str = "arrivals") -> DataFrame:
    """``df`` as a stream in slices of whole marks, each row with its ``mark`` and with what
    was ``seen`` before it. The engine's watermark is never ahead of what was seen."""
    marked = with_mark(df, arrival, rows)
    number = slice_of(marked, "mark", slices)
    seen = with_seen(marked, ts)
    return read_slices(df.sparkSession, write_slices(seen, number, slices, label), seen.schema)


def in_time(window_end: Column, lateness_ms: int) -> Column:
    """Whether a row's window was still kept when the row arrived, by what was ``seen``."""
    return F.col("seen").isNull() | (F.unix_millis(window_end) > F.unix_millis("seen") - lateness_ms)
