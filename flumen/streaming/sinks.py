"""Stream sinks and query runners.

Every query gets its own checkpoint folder under the shared scratch root, so a
restarted driver (or a lost executor) resumes from the last committed batch.
Queries keep their state in RocksDB, whatever the session's default is: panes of
:mod:`flumen.streaming.fired` need it. Update/complete outputs go through ``foreachBatch`` into folders named by
batch id, written with ``overwrite``: a batch that is re-run after a failure
replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flumen.session import scratch_path, state_store


def _writer(df: DataFrame, checkpoint: str, mode: str, available_now: bool, processing_time: str | None):
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w


def start_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                available_now: bool = True, processing_time: str | None = None,
                partition_by=None, state_partitions: int | None = None) -> StreamingQuery:
    """Append-mode file sink (exactly-once through the sink's commit log).
    ``state_partitions``: of a stateful query, for good, in place of the session's
    ``spark.sql.shuffle.partitions``; every micro-batch has a task for each."""
    w = _writer(df, checkpoint, "append", available_now, processing_time).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    with state_store(df.sparkSession, state_partitions):
        return w.start(path)


def start_batches(df: DataFrame, path: str, checkpoint: str, mode: str = "update",
                  available_now: bool = True, processing_time: str | None = None,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Each micro-batch's output lands in ``path/batch_id=N`` (idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    with state_store(df.sparkSession, state_partitions):
        return _writer(df, checkpoint, mode, available_now, processing_time).foreachBatch(write).start()


def start_text_per_batch(df: DataFrame, path: str, checkpoint: str, col: str = "value",
                         available_now: bool = True, processing_time: str | None = "120 seconds") -> StreamingQuery:
    """One folder of text files per micro-batch (dead-letter style): a file for each task
    that has rows, so that the scan and the parse before it stay parallel."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.col(col).cast("string")).write.mode("overwrite").text(
            f"{path}/batch_id={batch_id}")
    with state_store(df.sparkSession):
        return _writer(df, checkpoint, "append", available_now, processing_time).foreachBatch(write).start()


def start_fan_out(df: DataFrame, root: str, checkpoint: str, branches: dict,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """One stream, several outputs: each micro-batch is persisted once and
    every branch ``name -> fn(batch) -> DataFrame`` writes ``root/name/batch_id=N``
    (overwrite, so a re-run batch replaces its own files). One source read and
    one checkpoint serve all branches."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, fn in branches.items():
                fn(batch).write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    with state_store(df.sparkSession):
        return _writer(df, checkpoint, "append", available_now, processing_time).foreachBatch(write).start()


def start_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str,
                processing_time: str | None = None) -> StreamingQuery:
    """Message sink: rows with ``value`` (and optionally ``key``) bytes to a
    topic (needs the Kafka connector on the classpath)."""
    w = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    w = w.option("topic", topic).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    with state_store(messages.sparkSession):
        return w.start()


def run(query: StreamingQuery) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All per-batch outputs with their ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path)


def latest_per_key(updates: DataFrame, keys, batch_col: str = "batch_id") -> DataFrame:
    """Final value per key from update-mode output: the row of the highest
    batch id (a partial + final ``max_by``, no sort of the whole output)."""
    k = [keys] if isinstance(keys, str) else list(keys)
    vals = [c for c in updates.columns if c not in k and c != batch_col]
    last = updates.groupBy(*k).agg(F.max_by(F.struct(*vals), F.col(batch_col)).alias("__v"))
    return last.select(*k, "__v.*")


def checkpoint_for(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"ckpt-{label}")
