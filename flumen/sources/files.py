"""File sources: text lines, CSV with header, typed CSV, strict JSON lines,
in-memory rows. Schemas are always given -- nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.functions.collections import json_keys_exact
from flumen.sources.sinks import TIMESTAMP_MICROS


def text_lines(spark: SparkSession, pattern: str, line_sep: str = "\n") -> DataFrame:
    """Every line of every file matching ``pattern`` (globs allowed) as ``value``.
    Files are split into byte ranges, so one big file still reads in parallel."""
    return spark.read.option("lineSep", line_sep).text(pattern)


def text_skip_header(spark: SparkSession, pattern: str) -> DataFrame:
    """Text lines with the first line of *each file* skipped (a header), as ``value``;
    all other lines come through unchanged, blank ones included. Files are read in splits,
    in parallel and once: a task gets a split's lines in order, so the header is the first
    line that it gets of a split at a file's start."""
    rows = spark.read.option("lineSep", "\n").text(pattern).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return rows.mapInArrow(_without_headers, "value string")


def _without_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        files, starts = b.column(1).dictionary_encode().indices.to_numpy(zero_copy_only=False), b.column(2).to_numpy()
        first = np.ones(b.num_rows, dtype=bool)
        first[1:] = (files[1:] != files[:-1]) | (starts[1:] != starts[:-1])
        first[0] = last != (b.column(1)[0].as_py(), starts[0])
        last = (b.column(1)[b.num_rows - 1].as_py(), starts[-1])
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(~(first & (starts == 0))))], names=["value"])


def csv_with_header(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """CSV whose first line per file is a header (skipped); typed by ``schema``."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(pattern))


def csv_typed(lines: DataFrame, line_col: str, schema: T.StructType) -> DataFrame:
    """CSV text column -> typed columns with ``from_csv`` (bad numbers raise)."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col(line_col), ddl, {"mode": "FAILFAST", "timestampFormat": TIMESTAMP_MICROS})
    return lines.select(parsed.alias("__r")).select("__r.*")


def json_lines(spark: SparkSession, pattern: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON objects, one per line. ``strict``: a malformed line fails the job
    and every object must carry exactly the schema's keys (a missing or extra
    key raises, like building a record from ``**json.loads(line)``)."""
    raw = spark.read.option("lineSep", "\n").text(pattern)
    if not strict:
        return raw.select(F.from_json("value", schema, {"timestampFormat": TIMESTAMP_MICROS}).alias("r")).select("r.*")
    ok = json_keys_exact("value", schema)
    checked = raw.select(
        F.when(ok, F.col("value"))
        .otherwise(F.raise_error(F.concat(F.lit("record does not match schema: "), F.col("value"))))
        .alias("value"))
    opts = {"mode": "FAILFAST", "timestampFormat": TIMESTAMP_MICROS}
    return checked.select(F.from_json("value", schema, opts).alias("r")).select("r.*")


def create(spark: SparkSession, rows, schema) -> DataFrame:
    """In-memory rows (small, fixed inputs such as a look-up list)."""
    return spark.createDataFrame(rows, schema)
