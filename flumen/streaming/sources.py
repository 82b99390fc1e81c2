"""Stream sources.

Production streams come from a broker (Kafka: ``value`` binary + ``timestamp``);
everything here only assumes a streaming DataFrame with a payload column, so
the same code runs on a file source in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """Unbounded read of the files that appear under ``path`` (``glob`` keeps
    only matching file names); ``max_files`` caps files per micro-batch."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message-stream source (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).load())


def as_messages(df: DataFrame, payload: Column, ts: str | None = None) -> DataFrame:
    """Rows -> message shape: ``value`` (UTF-8 bytes) and, when given, the
    transport ``timestamp``."""
    cols = [F.encode(payload, "UTF-8").alias("value")]
    if ts:
        cols.append(F.col(ts).alias("timestamp"))
    return df.select(*cols)


def parse_messages(messages: DataFrame, schema: T.StructType, keep=("timestamp",)) -> DataFrame:
    """``value`` bytes -> UTF-8 text -> JSON record (lenient: bad fields NULL)."""
    text = F.decode(F.col("value"), "UTF-8")
    kept = [c for c in keep if c in messages.columns]
    return messages.select(*kept, F.from_json(text, schema).alias("r")).select(*kept, "r.*")


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Use a record column (or message attribute) as event time, with the
    allowed lateness as the watermark delay."""
    return df.withWatermark(column, delay)
