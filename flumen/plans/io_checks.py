"""Recipes: sources and sinks, each as a round trip through the shared scratch
folder (written by Spark, read back by Spark)."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen import schemas
from flumen.operators import rows
from flumen.plans.registry import TS_MICROS, recipe, rnd, table, ts_text
from flumen.session import scratch_path
from flumen.sources import files, sinks

_EVENT_COLS_ORACLE = """event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type,
       round(value, 4) + 0.0 AS value, props"""


def _events_out(df):
    return df.select("event_id", ts_text("ts", TS_MICROS).alias("ts"), "user_id", "event_type",
                     rnd("value").alias("value"), "props")


@recipe("src_text_lines", """
SELECT unnest(string_split(text, chr(10))) AS value FROM documents
""")
def src_text_lines(spark, sf):
    path = scratch_path(spark, "docs-text")
    sinks.write_text(table(spark, sf, "documents"), path, "text")
    return files.text_lines(spark, f"{path}/part-*")


@recipe("sink_raw_archive", """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents),
b AS (SELECT 'archive' AS branch, value FROM l UNION ALL SELECT 'kept', value FROM l WHERE starts_with(value, 'The'))
SELECT branch, value, count(*) OVER (PARTITION BY branch) AS observed FROM b
""")
def sink_raw_archive(spark, sf):
    """An unchanged copy and a filtered one, written in one pass, with the rows that the
    write itself counted."""
    src = scratch_path(spark, "raw-in")
    sinks.write_text(table(spark, sf, "documents"), src, "text")
    raw, out = files.text_lines(spark, f"{src}/part-*"), scratch_path(spark, "raw-branches")
    observed = sinks.write_text_branches(raw, out, {"archive": F.lit(True), "kept": F.col("value").startswith("The")})
    count = F.element_at(F.create_map(*[F.lit(x) for kv in observed.items() for x in kv]), F.col("branch"))
    back = spark.read.schema("value string, branch string").option("lineSep", "\n").text(out)
    return back.select("branch", "value", count.cast("long").alias("observed"))


_NATION = schemas.struct(("n_nationkey", T.LongType()), ("n_name", T.StringType()),
                         ("n_regionkey", T.LongType()))


@recipe("src_csv_header", """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation
""")
def src_csv_header(spark, sf):
    path = scratch_path(spark, "nation-csv")
    table(spark, sf, "nation").write.mode("overwrite").option("header", True).csv(path)
    return files.csv_with_header(spark, f"{path}/*.csv", _NATION)


_EVENT_JSON = schemas.struct(("event_id", T.LongType()), ("ts", T.TimestampType()), ("user_id", T.LongType()),
                             ("event_type", T.StringType()), ("value", T.DoubleType()),
                             ("props", T.StringType()))


@recipe("src_json_lines", f"SELECT {_EVENT_COLS_ORACLE} FROM events")
def src_json_lines(spark, sf):
    path = scratch_path(spark, "events-json")
    sinks.write_json(table(spark, sf, "events"), path)
    return _events_out(files.json_lines(spark, f"{path}/*.json", _EVENT_JSON, strict=True))


@recipe("sink_json", f"SELECT {_EVENT_COLS_ORACLE} FROM events")
def sink_json(spark, sf):
    path = scratch_path(spark, "sink-json")
    sinks.write_json(table(spark, sf, "events"), path)
    return _events_out(spark.read.schema(_EVENT_JSON).option("timestampFormat", sinks.TIMESTAMP_MICROS).json(path))


@recipe("src_csv_typed", f"SELECT {_EVENT_COLS_ORACLE} FROM events")
def src_csv_typed(spark, sf):
    """A text file of CSV lines (props quoted) -> typed records."""
    ev, path = table(spark, sf, "events"), scratch_path(spark, "events-csv")
    sinks.write_text(ev, path, F.to_csv(F.struct(*ev.columns), {"timestampFormat": sinks.TIMESTAMP_MICROS}))
    return _events_out(files.csv_typed(files.text_lines(spark, f"{path}/part-*"), "value", _EVENT_JSON))


@recipe("src_text_header", """
SELECT unnest(string_split(text, chr(10))) AS value FROM documents WHERE doc_id % 3 <> 0
""")
def src_text_header(spark, sf):
    """Text files that begin with a header line, one per file, read without it: documents
    as lines, dealt over as many files as a shuffle has partitions."""
    path = scratch_path(spark, "headed")
    docs = table(spark, sf, "documents").where("doc_id % 3 <> 0")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("file"), F.lit(1).alias("__place"), F.col("text").alias("value"))
    head = spark.range(n).select(F.col("id").alias("file"), F.lit(0).alias("__place"), F.lit("value;of;file").alias("value"))
    both = head.unionByName(rows).repartition(n, "file").sortWithinPartitions("file", "__place")
    both.drop("__place").write.mode("overwrite").partitionBy("file").option("lineSep", "\n").text(path)
    return files.text_skip_header(spark, path)


# Fixed value: an in-memory look-up list (event type -> weight), joined to data.
EVENT_WEIGHTS = [("view", 1), ("click", 2), ("signup", 5), ("purchase", 10), ("error", 0)]


@recipe("src_create", """
WITH w(event_type, weight) AS (VALUES ('view', 1), ('click', 2), ('signup', 5), ('purchase', 10), ('error', 0))
SELECT e.event_type, CAST(w.weight AS BIGINT) AS weight, COUNT(*) AS n, CAST(SUM(w.weight) AS BIGINT) AS score
FROM events e JOIN w USING (event_type) GROUP BY e.event_type, w.weight
""")
def src_create(spark, sf):
    weights = files.create(spark, EVENT_WEIGHTS, "event_type string, weight bigint")
    ev = table(spark, sf, "events").select("event_type")
    joined = ev.join(F.broadcast(weights), "event_type")  # fixed 5-row list
    return joined.groupBy("event_type", "weight").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("weight").alias("score"))


@recipe("sink_text", """
SELECT concat_ws(',', event_id, user_id, event_type) AS value FROM events
""")
def sink_text(spark, sf):
    path = scratch_path(spark, "sink-text")
    ev = table(spark, sf, "events")
    sinks.write_text(ev, path, F.concat_ws(",", "event_id", "user_id", "event_type"))
    return files.text_lines(spark, f"{path}/part-*")


@recipe("sink_single_csv", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY ALL
""")
def sink_single_csv(spark, sf):
    path = scratch_path(spark, "single-csv")
    summary = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))
    sinks.write_single_csv(summary, path)
    schema = "o_orderstatus string, o_orderpriority string, n bigint"
    return spark.read.schema(schema).option("header", True).csv(f"{path}/*.csv")


_ORDERS_OUT = schemas.struct(("o_orderkey", T.LongType()), ("o_custkey", T.LongType()),
                             ("o_orderstatus", T.StringType()), ("o_totalprice", T.DoubleType()))


@recipe("sink_table_overwrite", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) + 0.0 AS o_totalprice FROM orders
""")
def sink_table_overwrite(spark, sf):
    with _named(spark, "orders_replaced") as (name, path):
        o = table(spark, sf, "orders")
        sinks.save_named(o.where("o_orderstatus = 'P'"), name, _ORDERS_OUT, "overwrite", path)     # create
        sinks.save_named(o, name, _ORDERS_OUT, "overwrite")                                        # replace
        return spark.read.schema(_ORDERS_OUT).parquet(path).withColumn("o_totalprice", rnd("o_totalprice", 2))


@contextlib.contextmanager
def _named(spark, label: str):
    """A name of its own in the session's catalog, over a folder that outlives it."""
    path = scratch_path(spark, label)
    name = f"{label}_{path.rsplit('-', 1)[-1]}"
    try:
        yield name, path
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@recipe("sink_table_append", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) + 0.0 AS o_totalprice FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) + 0.0 AS o_totalprice FROM orders
""")
def sink_table_append(spark, sf):
    with _named(spark, "orders_appended") as (name, path):
        o = table(spark, sf, "orders")
        sinks.save_named(o, name, _ORDERS_OUT, path=path)       # create if missing
        sinks.save_named(o.select(*reversed(o.columns)), name, _ORDERS_OUT)
        return spark.read.schema(_ORDERS_OUT).parquet(path).withColumn("o_totalprice", rnd("o_totalprice", 2))


@recipe("sink_day_partitioned", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS ingest_date FROM events
""")
def sink_day_partitioned(spark, sf):
    path = scratch_path(spark, "day-part")
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    sinks.write_day_partitioned(ev, path, day=F.col("ts"))
    back = spark.read.option("basePath", path).parquet(path)
    return back.select("event_id", "user_id", "event_type", F.col("ingest_date").cast("string").alias("ingest_date"))


@recipe("schema_check", f"SELECT {_EVENT_COLS_ORACLE} FROM events")
def schema_check(spark, sf):
    ev = table(spark, sf, "events")
    return _events_out(schemas.expect_schema(ev, _EVENT_JSON, exact=True))
