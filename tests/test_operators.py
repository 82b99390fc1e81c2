"""Skew-safe operators give the same answers as the plain (one-task-per-key)
forms, on data where one key holds a third of the rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flumen.operators import joins, ordered, panes, skew, udfs, windows


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)   # key 0 holds a third of the rows
        rows.append((i, key, 1_700_000_000 + i * 37 + rnd.randint(0, 30) * 60, float(rnd.randint(1, 100))))
    return spark.createDataFrame(rows, "id long, k long, t long, v double").withColumn(
        "ts", F.timestamp_seconds("t")).drop("t")


def test_running_sum_matches_window(spark, skewed):
    b = skewed.withColumn("b", ordered.int_bucket("id", 97))
    got = ordered.running(b, "k", ["id"], "b", "v", how="sum", name="run").select("id", "run")
    want = skewed.select("id", F.sum("v").over(Window.partitionBy("k").orderBy("id")).alias("run"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_running_max_exclusive_global(spark, skewed):
    b = skewed.withColumn("b", ordered.int_bucket("id", 97))
    got = ordered.running(b, [], ["id"], "b", "v", how="max", name="m", exclusive=True).select("id", "m")
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.select("id", F.max("v").over(w).alias("m"))
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)


def test_previous_matches_lag(spark, skewed):
    b = skewed.withColumn("b", ordered.time_bucket("ts", 3600))
    got = ordered.previous(b, "k", ["ts", "id"], "b", "id", name="p").select("id", "p")
    want = skewed.select("id", F.lag("id").over(Window.partitionBy("k").orderBy("ts", "id")).alias("p"))
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)


@pytest.mark.parametrize("gap", [1, 60, 600, 86_400])
def test_sessions_match_session_window(spark, skewed, gap):
    mine = windows.sessions(skewed, "ts", gap, "k", {"n": ("count", None), "s": ("sum", "v"), "lo": ("min", "v"), "m": ("mean", "v")})
    theirs = windows.sessions_builtin(skewed, "ts", gap, "k", aggs=[F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"),
                                                                     F.min("v").alias("lo"), F.avg("v").alias("m")])
    cols = ["k", F.col("window.start").alias("a"), F.col("window.end").alias("z"), "n", *[F.round(c, 6).alias(c) for c in ("s", "lo", "m")]]
    assert sorted(mine.select(*cols).collect()) == sorted(theirs.select(*cols).collect())


def test_rows_one_gap_apart_stay_together(spark):
    """Also before 1970 and across the borders of partial sessions."""
    s = [-1201, -600, 0, 600, 1200, 1801, 2400]
    rows = spark.createDataFrame([(1, x) for x in s], "k long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = [r.n for r in windows.sessions(rows, "ts", 600, "k", {"n": ("count", None)}).orderBy("window.start").collect()]
    assert got == [1, 4, 2]


@pytest.mark.parametrize("size,period", [(1800, 600), (3600, 3600), (1000, 300), (900, 600), (7, 5)])
def test_sliding_windows_match_window(spark, skewed, size, period):
    mine = windows.sliding(skewed, "ts", size, period, "k", {"n": ("count", None), "m": ("mean", "v")})
    theirs = skewed.groupBy(F.window("ts", f"{size} seconds", f"{period} seconds").alias("window"), "k").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"))
    cols = ["k", F.col("window.start").alias("a"), F.col("window.end").alias("z"), "n", F.round("m", 6).alias("m")]
    assert sorted(mine.select(*cols).collect()) == sorted(theirs.select(*cols).collect())


def test_adaptive_bucket_splits_hot_key(spark, skewed):
    b = ordered.adaptive_bucket(skewed, "k", F.col("id"), target_rows=100)
    per = {r.k: r.nb for r in b.groupBy("k").agg(F.countDistinct("__bucket").alias("nb")).collect()}
    assert per[0] >= 8          # the hot key (1,000 rows) is cut into many buckets
    assert max(v for k, v in per.items() if k != 0) <= 2


def test_spread_keeps_every_row(spark, skewed):
    out = skew.spread_by_key(skewed.select("k", "id"), "k", by="id", target_rows=50)
    assert sorted(out.collect()) == sorted(skewed.select("k", "id").collect())


@pytest.mark.parametrize("target", [25, 10_000])
def test_count_panes_match_row_number(spark, skewed, target):
    got = panes.count_panes(skewed, "k", "id", "v", 7, target_rows=target)
    w = Window.partitionBy("k").orderBy("id")
    rn = skewed.withColumn("rn", F.row_number().over(w)).withColumn("pane", F.floor((F.col("rn") - 1) / 7))
    want = (rn.groupBy("k", "pane").agg(F.count(F.lit(1)).alias("pane_rows"), F.sum("v").alias("pane_value"))
            .filter("pane_rows = 7"))
    assert sorted(got.collect()) == sorted(want.select("k", F.col("pane").cast("bigint"), "pane_rows", "pane_value").collect())


def test_lookup_nonzero(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    assert joins.lookup_nonzero(left, right, "k", "v").count() == 33


def test_exclude_is_null_safe(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    ids = spark.createDataFrame([(2,), (None,)], "id long")
    assert sorted(r.id for r in joins.exclude(df, ids, "id").collect() if r.id is not None) == [1]


def panes_by_hand(rows, n, delay_us):
    """rows: (key, t, tie-break, value); one pass per key."""
    out, by_key = [], {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    for k, mine in by_key.items():
        found = []
        for _, t, _, v in mine:
            if not found or (n and found[-1][1] >= n) or (delay_us and t >= found[-1][0] + delay_us):
                found.append([t, 0, 0.0])
            found[-1][1] += 1
            found[-1][2] += v
        out += [(k, i, t, m, round(v, 6)) for i, (t, m, v) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("slices", [1, 7, 60])
@pytest.mark.parametrize("n,delay", [(5, 1800), (None, 1800), (None, 100_000), (7, None), (1, 10), (5000, 40_000), (None, None)])
def test_segment_panes_equal_one_pass(spark, skewed, slices, n, delay):
    rows = [(r.k, r.t, r.id, r.v) for r in skewed.select("k", F.unix_micros("ts").alias("t"), "id", "v").collect()]
    got = panes.segment_panes(skewed, "k", "ts", "id", "v", n=n, delay_s=delay, slices=slices)
    got = got.select("k", "pane", F.unix_micros("pane_start").alias("t"), "pane_rows", "pane_value").collect()
    assert sorted((r.k, r.pane, r.t, r.pane_rows, round(r.pane_value, 6)) for r in got) == panes_by_hand(rows, n, delay and delay * 1_000_000)


@pytest.mark.parametrize("held,n,delay", [(40, 5, 1800), (700, None, 1800), (40, None, 100_000), (700, 5000, 40_000), (40, None, None)])
def test_segment_panes_with_few_rows_held(spark, skewed, held, n, delay):
    """A task cuts its slice anywhere; keys go on over the cuts, and over slices."""
    rows = [(r.k, r.t, r.id, r.v) for r in skewed.select("k", F.unix_micros("ts").alias("t"), "id", "v").collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        got = panes.segment_panes(skewed, "k", "ts", "id", "v", n=n, delay_s=delay, slices=3, held_rows=held)
        got = got.select("k", "pane", F.unix_micros("pane_start").alias("t"), "pane_rows", "pane_value").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.k, r.pane, r.t, r.pane_rows, round(r.pane_value, 6)) for r in got) == panes_by_hand(rows, n, delay and delay * 1_000_000)


def test_a_slice_is_never_held_whole():
    """Panes leave while the slice is read: no more than the rows to hold and a batch wait."""
    read = [0]

    def batches():
        for i in range(200):
            read[0] += 100
            at = 100 * i + np.arange(100)
            yield pd.DataFrame({"__key": [f"k{a // 30:06}" for a in at], "__t": at, "__tb": at, "__v": 1.0, "__slice": 0})

    given = 0
    for out in panes._slice(batches(), 4, None, 1000):
        given += out.loc[out["kind"] == "pane", "rows"].sum()
        assert read[0] - given <= 1000 + 100
    assert given == 20_000


def test_first_pane_matches_sequential(spark, skewed):
    seq = panes.segment_panes(skewed, "k", "ts", "id", "v", delay_s=1800).filter("pane = 0")
    first = panes.first_pane(skewed, "k", "ts", "v", 1800)
    cols = ["k", "pane", "pane_start", "pane_rows", "pane_value"]
    assert sorted(first.select(*cols).collect()) == sorted(seq.select(*cols).collect())


NULLS = "(NULL, 1, 0, 1.0), (NULL, 2, 60, 2.0), (NULL, 3, 9000, 4.0), (9007199254740992, 4, 0, 1.0), (9007199254740993, 5, 10, 1.0), (9007199254740993, 6, 20, 1.0)"


@pytest.fixture(scope="module")
def null_keys(spark):
    rows = spark.sql(f"SELECT * FROM VALUES {NULLS} AS t(k, id, s, v)")
    return rows.select(F.col("k").cast("long"), F.col("id").cast("long"), F.timestamp_seconds("s").alias("ts"), F.col("v").cast("double"))


def test_null_and_long_keys_keep_their_sessions(spark, null_keys):
    cols = ["k", F.col("window.start").alias("a"), F.col("window.end").alias("z"), "n"]
    key = lambda r: str(r)
    mine = windows.sessions(null_keys, "ts", 600, "k", {"n": ("count", None)}).select(*cols).collect()
    theirs = windows.sessions_builtin(null_keys, "ts", 600, "k", aggs=[F.count(F.lit(1)).alias("n")]).select(*cols).collect()
    assert sorted(mine, key=key) == sorted(theirs, key=key) and len(mine) == 4


def test_null_and_long_keys_keep_their_panes(spark, null_keys):
    big = 9007199254740992
    rows = lambda df: {(r.k, r.pane, r.pane_rows, r.pane_value) for r in df.collect()}
    assert rows(panes.count_panes(null_keys, "k", "id", "v", 2)) == {(None, 0, 2, 3.0), (big + 1, 0, 2, 2.0)}
    assert rows(panes.count_panes(null_keys, "k", "id", "v", 2, repeat=False)) == {(None, 0, 2, 3.0), (big + 1, 0, 2, 2.0)}
    assert rows(panes.first_pane(null_keys, "k", "ts", "v", 100)) == {(None, 0, 2, 3.0), (big, 0, 1, 1.0), (big + 1, 0, 2, 2.0)}
    want = {(None, 0, 2, 3.0), (None, 1, 1, 4.0), (big, 0, 1, 1.0), (big + 1, 0, 2, 2.0)}
    for slices in (None, 1, 6):
        assert rows(panes.segment_panes(null_keys, "k", "ts", "id", "v", n=5, delay_s=100, slices=slices)) == want


def test_null_keys_keep_their_mean(spark, null_keys):
    from flumen.operators import udfs
    for target in (1, 100):
        assert {r.k: r.mean for r in udfs.combine_mean(null_keys, "k", "v", target_rows=target).collect()}[None] == pytest.approx(7 / 3)


def test_null_order_values_keep_their_rows(spark, null_keys):
    held = null_keys.withColumn("id", F.when(F.col("id") != 2, F.col("id")))
    assert ordered.adaptive_bucket(held, "k", "id", target_rows=1).count() == held.count()


@pytest.mark.parametrize("shape", ["one far-off value", "95 % equal values", "one hot key"])
def test_buckets_stay_near_their_target(spark, shape):
    n, target = 20_000, 1000
    t = {"one far-off value": F.when(F.col("id") == 7, 10**15).otherwise(F.col("id")),
         "95 % equal values": F.when(F.col("id") % 20 == 0, F.col("id")).otherwise(5),
         "one hot key": F.col("id")}[shape]
    key = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1) if shape == "one hot key" else F.lit(1)
    rows = spark.range(n).select(key.alias("k"), t.alias("t"), "id")
    b = ordered.adaptive_bucket(rows, "k", ["t", "id"], target_rows=target)
    assert b.count() == n
    assert b.groupBy("__bucket").count().agg(F.max("count")).first()[0] <= 2 * target
    # buckets follow the order inside a key
    ends = b.groupBy("k", "__bucket").agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"))
    w = Window.partitionBy("k").orderBy("__bucket")
    assert ends.withColumn("before", F.lag("hi").over(w)).where("before >= lo").count() == 0


def test_sessions_without_a_time_are_one_session(spark):
    rows = spark.range(60).select(F.lit(1).alias("k"), "id", F.when(F.col("id") >= 30, F.timestamp_seconds(F.col("id") * 10)).alias("ts"))
    out = windows.session_ids(rows, "ts", 600, "k")
    got = out.groupBy("session").agg(F.count("ts").alias("timed"), F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.timed, r.n) for r in got) == [(0, 30), (30, 30)]


def test_combine_mean_ignores_nulls_and_keeps_keys(spark):
    rows = spark.sql("SELECT * FROM VALUES (1L, 2.0D), (1L, NULL), (1L, 4.0D), (2L, NULL), (NULL, 8.0D) AS t(k, v)")
    got = {r.k: r["mean"] for r in udfs.combine_mean(rows, "k", "v", target_rows=1).collect()}
    assert got[1] == 3.0 and got[None] == 8.0 and got[2] != got[2]


def test_sliding_windows_with_gaps_between(spark):
    """A period longer than the size: some rows are in no window."""
    rows = spark.range(0, 3000, 50).select(F.timestamp_seconds("id").alias("ts"), "id")
    got = windows.sliding(rows, "ts", 600, 900, None, {"n": ("count", None), "lo": ("min", "id")})
    got = sorted((r.window.start.timestamp(), r.n, r.lo) for r in got.collect())
    assert [(n, lo) for _, n, lo in got] == [(12, 0), (12, 900), (12, 1800), (6, 2700)]


def test_aggregates_of_sets_keep_nulls_and_names(spark):
    from flumen.operators import aggregates as agg
    rows = spark.createDataFrame([(1, "x"), (1, None), (None, "x"), (None, None)], "a long, b string")
    got = agg.of_sets(rows, {"per_a": "a", "per_b": "b", "again": "a"}, F.count(F.lit(1)).alias("n"))
    assert sorted((r.branch, r.key or "", r.n) for r in got.collect()) == [
        ("again", "", 2), ("again", "1", 2), ("per_a", "", 2), ("per_a", "1", 2), ("per_b", "", 2), ("per_b", "x", 2)]


def test_table_function_takes_keywords(spark):
    rows = spark.createDataFrame([(1, "ab  abcdef", "x"), (2, None, "x"), (3, "mm", None)], "id long, text string, k string")
    out = udfs.table_function(rows, udfs.split_names(), "k", cutoff_length=3, marker="a")
    assert sorted(map(tuple, out.collect())) == [(1, "Long_Names", "abcdef"), (1, "Marked_Names", "ab"), (1, "Marked_Names", "abcdef"),
                                                 (1, "Short_Names", "ab"), (3, "Short_Names", "mm")]
    wide = udfs.table_function(rows, udfs.split_names(), ["k", "id"], "id", cutoff_length=F.lit(9), marker="zz")
    assert {r.tag for r in wide.collect()} == {"Short_Names"}


def test_cogroup_with_sizes_counts_null_keys(spark):
    a = spark.createDataFrame([(1, "p"), (1, "p"), (None, "q")], "k long, v string")
    b = spark.createDataFrame([(None, "r"), (2, "s")], "k long, v string")
    got = joins.cogroup_with_sizes({"a": a, "b": b}, "k").collect()
    assert sorted((r.k or 0, r.tag, r.item, r.n_a, r.n_b) for r in got) == [
        (0, "a", "q", 1, 1), (0, "b", "r", 1, 1), (1, "a", "p", 2, 0), (1, "a", "p", 2, 0), (2, "b", "s", 0, 1)]
