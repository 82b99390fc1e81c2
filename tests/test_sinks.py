"""Sink properties the oracles cannot see: file counts, partition pruning,
overwrite vs append, header checks."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from flumen import schemas
from flumen.session import scratch_path
from flumen.sources import files, sinks

SF = "/root/testdata/sf0.001"


def test_single_csv_is_one_file(spark):
    path = scratch_path(spark, "t-single")
    df = spark.read.parquet(f"{SF}/orders.parquet").groupBy("o_orderstatus").count()
    sinks.write_single_csv(df, path)
    assert len(glob.glob(f"{path}/*.csv")) == 1


def test_day_partitions_are_pruned(spark):
    path = scratch_path(spark, "t-days")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.write_day_partitioned(ev.select("event_id", "ts"), path, day=F.col("ts"))
    back = spark.read.parquet(path).filter(F.col("ingest_date") == "2024-01-05")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    want = ev.filter(F.to_date("ts") == F.lit("2024-01-05").cast("date")).count()
    assert back.count() == want > 0


def test_overwrite_replaces_append_adds(spark):
    path = scratch_path(spark, "t-table")
    df = spark.range(10)
    sinks.write_table(df, path, "overwrite")
    sinks.write_table(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 10
    sinks.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 20


def test_csv_header_must_match_schema(spark):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([(1, "a")], "x long, y string").write.option("header", True).csv(path)
    right = spark.createDataFrame([], "x long, y string").schema
    ok = files.csv_with_header(spark, path, right)
    assert ok.collect()[0].x == 1
    wrong = spark.createDataFrame([], "y long, x string").schema
    with pytest.raises(Exception):
        files.csv_with_header(spark, path, wrong).collect()


def test_text_round_trip_keeps_lines(spark):
    path = scratch_path(spark, "t-text")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    sinks.write_text(docs, path, "text")
    lines = files.text_lines(spark, f"{path}/part-*").count()
    want = docs.select(F.explode(F.split("text", "\n"))).count()
    assert lines == want


def test_text_skip_header_per_file(spark, tmp_path):
    d = tmp_path / "t"
    d.mkdir()
    (d / "a.txt").write_text("HEADER a\n  one, \"x\"\ntwo\n")
    (d / "b.txt").write_text("HEADER b\nthree\n")
    got = sorted(r.value for r in files.text_skip_header(spark, str(d)).collect())
    assert got == ['  one, "x"', "three", "two"]


def test_named_table_is_created_replaced_appended(spark):
    name, path = f"named_{uuid.uuid4().hex[:8]}", scratch_path(spark, "named")
    schema = schemas.struct(("a", schemas.L), ("b", schemas.S))
    rows = lambda: sorted(map(tuple, spark.table(name).collect()))
    try:
        sinks.save_named(spark.createDataFrame([("x", "1")], "b string, a string"), name, schema, path=path)
        sinks.save_named(spark.createDataFrame([(2, "y", 0.5)], "a int, b string, c double"), name, schema)
        assert rows() == [(1, "x"), (2, "y")]
        sinks.save_named(spark.createDataFrame([(3, "z")], "a int, b string"), name, schema, "overwrite")
        assert rows() == [(3, "z")]
        with pytest.raises(schemas.SchemaMismatch):
            sinks.save_named(spark.createDataFrame([(3, "z")], "a int, c string"), name, schemas.struct(("a", schemas.L), ("c", schemas.S)))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_branches_count_what_they_write(spark):
    path = scratch_path(spark, "branches")
    df = spark.range(100).select(F.col("id").cast("string").alias("value"))
    seen = sinks.write_text_branches(df, path, {"all": F.lit(True), "few": F.col("value").startswith("9"), "none": F.lit(False)})
    assert seen == {"all": 100, "few": 11, "none": 0}
    back = spark.read.schema("value string, branch string").text(path).groupBy("branch").count().collect()
    assert {r.branch: r["count"] for r in back} == {"all": 100, "few": 11}


def test_header_line_of_each_file_is_skipped(spark, tmp_path):
    for n, lines in enumerate((["h1", "a", "", "a"], ["h2"], ["h1", "h1"], [])):
        (tmp_path / f"f{n}.txt").write_text("\n".join(lines) + ("\n" if lines else ""))
    (tmp_path / "big.txt").write_text("head\n" + "row\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = files.text_skip_header(spark, f"{tmp_path}/*.txt").groupBy("value").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.value: r["count"] for r in got} == {"a": 2, "": 1, "h1": 1, "row": 50_000}
