"""Stream behaviour: the reference's taxi window and late-data cases, and the
stream form of the count trigger against its batch form."""

from pyspark.sql import functions as F

from flumen.domains import taxi
from flumen.operators import panes
from flumen.session import scratch_path
from flumen.streaming import arrivals, fired
from flumen.streaming import panes as spanes
from flumen.streaming import sinks as ss

SCHEMA = "ride_status string, s long, arrival_batch long"
HOUR = 3600         # time 0 of these cases: a watermark at the epoch means none


def _run_taxi(spark, rows, label):
    table = spark.createDataFrame(rows, SCHEMA)
    path = arrivals.write_slices(table, F.col("arrival_batch"), label=label)
    s = arrivals.read_slices(spark, path, table.drop("arrival_batch").schema)
    s = s.withColumn("ts", F.timestamp_seconds(F.col("s") + HOUR))
    counts = taxi.pickups_per_window(s, "ts")
    counts = counts.select((F.col("window_start").cast("long") - HOUR).alias("start"), "pane", "timing", F.col("pane_rows").alias("count"))
    out = scratch_path(spark, f"{label}-out")
    ss.run(ss.start_files(counts, out, ss.checkpoint_for(spark, label)))
    return spark.read.parquet(out)


def test_taxi_windows(spark):
    rows = [("pickup", 0, 0), ("pickup", 0, 0), ("pickup", 0, 0), ("pickup", 60, 0), ("pickup", 120, 1), ("enroute", 500, 2)]
    got = _run_taxi(spark, rows, "taxi-win").collect()
    assert sorted((r.start, r.timing, r["count"]) for r in got) == [(0, "on_time", 3), (60, "on_time", 1), (120, "on_time", 1)]


def test_taxi_late_data(spark):
    # The original test moves the watermark to 60 s, then to 300 s, with 60 s of allowed
    # lateness; rows that are no pickups do so here. The last row is too late.
    rows = [("pickup", 0, 0), ("pickup", 0, 0),
            ("enroute", 60, 1),
            ("pickup", 0, 2),
            ("enroute", 300, 3),
            ("pickup", 0, 4)]
    got = _run_taxi(spark, rows, "taxi-late").filter("start = 0").orderBy("pane").collect()
    assert [(r.timing, r["count"]) for r in got] == [("on_time", 2), ("late", 3)]


def _fire(spark, rows, label, **kw):
    """rows: (key, event time, arrival, value, slice); panes as (key, start, pane, timing, rows, value)."""
    table = spark.createDataFrame(rows, "k string, s long, at long, v double, b long")
    s = arrivals.read_slices(spark, arrivals.write_slices(table, F.col("b"), label=label), table.schema)
    s = s.withColumn("ts", F.timestamp_seconds(F.col("s") + HOUR)).withColumn("at", F.timestamp_seconds("at"))
    out = scratch_path(spark, f"{label}-out")
    ss.run(ss.start_files(fired.window_panes(s, "ts", "20 seconds", 100, "k", **kw), out, ss.checkpoint_for(spark, label)))
    got = spark.read.parquet(out).withColumn("start", F.col("window_start").cast("long") - HOUR)
    return sorted((r.k or "", r.start, r.pane, r.timing, r.pane_rows, r.pane_value) for r in got.collect())


def test_early_on_time_and_late_panes(spark):
    """A key with all three kinds; late panes of two rows, the rest when the window is forgotten."""
    early = [("a", 1, 0, 1.0, 0), ("a", 2, 3, 2.0, 0), ("a", 3, 5, 4.0, 0), ("a", 4, 11, 8.0, 1)]
    late = [("a", 19, 30 + i, float(10 ** i), 3) for i in range(5)]
    other = [(None, 25, 12, 1.0, 2), (None, 26, 13, 1.0, 2), ("z", 400, 90, 0.5, 4), ("z", 401, 91, 0.5, 5), ("a", 5, 99, 7.0, 5)]
    kw = {"value": "v", "early_s": 5, "arrival": "at", "late_rows": 2}
    want = [("a", 0, 0, "early", 2, 3.0), ("a", 0, 1, "early", 1, 4.0), ("a", 0, 2, "on_time", 1, 8.0),
            ("a", 0, 3, "late", 2, 11.0), ("a", 0, 4, "late", 2, 1100.0), ("a", 0, 5, "late", 1, 10000.0)]
    got = _fire(spark, early + late + other, "all-kinds", **kw)
    assert got == [("", 20, 0, "on_time", 2, 2.0), *want]
    total = [3.0, 7.0, 15.0, 26.0, 1126.0, 11126.0]
    got = _fire(spark, early + late + other, "all-kinds-acc", mode=panes.ACCUMULATING, **kw)
    assert [(r[2], r[3], r[5]) for r in got if r[0] == "a"] == [(w[2], w[3], t) for w, t in zip(want, total)]


def test_early_panes_by_processing_time(spark):
    """Without an arrival column the rows of a micro-batch arrive at once: with the shortest
    delay each micro-batch is a pane, closed by the key's next row or on time."""
    rows = [("a", 1, 0, 1.0, 0), ("a", 2, 0, 2.0, 0), ("b", 3, 0, 64.0, 0), ("a", 3, 0, 4.0, 1), ("a", 4, 0, 8.0, 2), ("z", 300, 0, 0.5, 3), ("z", 301, 0, 0.5, 4)]
    got = _fire(spark, rows, "by-clock", value="v", early_s=1e-6)
    assert got == [("a", 0, 0, "early", 2, 3.0), ("a", 0, 1, "early", 1, 4.0), ("a", 0, 2, "on_time", 1, 8.0), ("b", 0, 0, "on_time", 1, 64.0), ("z", 300, 0, "early", 1, 0.5)]


def test_late_counts_discarding(spark):
    rows = [("a", 1, 0, 0.0, 0)] * 3 + [("b", 30, 1, 0.0, 1)] + [("a", 2, 2, 0.0, 2)] * 4 + [("b", 31, 1, 0.0, 3), ("b", 300, 1, 0.0, 4), ("b", 301, 1, 0.0, 5)]
    got = _fire(spark, rows, "late-counts", late_rows=3)
    assert got == [("a", 0, 0, "on_time", 3, 3.0), ("a", 0, 1, "late", 3, 3.0), ("a", 0, 2, "late", 1, 1.0), ("b", 20, 0, "on_time", 2, 2.0)]


def test_too_late_is_judged_every_thousand_arrivals(spark, tmp_path):
    """24 days of 1,000 events each: a row that is 2,000 arrivals late is a day too late,
    unless lateness is judged less often than the events come. Some rows have no time."""
    import datetime as dt

    import duckdb

    import __spark_entry__ as E

    rows = spark.range(24_000).select(
        F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"), F.concat(F.lit("t"), F.col("id") % 3).alias("event_type"),
        F.when(F.col("id") % 101 != 5, F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 86_400_000)).cast("timestamp_ntz").alias("ts"),
        F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    rows.write.parquet(f"{tmp_path}/events.parquet")

    want, seen, top, slices = {}, None, None, {}
    for r in rows.collect():
        slices.setdefault((r.event_id + (2000 if r.event_id % 7 == 0 else 0)) // 1000, []).append(r)
    for b in sorted(slices):
        for r in slices[b]:
            start = r.ts and r.ts.replace(minute=0, second=0, microsecond=0)
            if start and (seen is None or start + dt.timedelta(hours=1) > seen - dt.timedelta(days=1)):
                want[str(start), r.event_type] = want.get((str(start), r.event_type), 0) + 1
            top = max(filter(None, (top, r.ts)))
        seen = top
    got = E.queries()["stream_drop_too_late"](spark, str(tmp_path)).collect()
    assert {(r.window_start, r.event_type): r["count"] for r in got} == want and len(got) == len(want)
    assert 0.8 * 24_000 < sum(want.values()) < 0.9 * 24_000
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS FROM read_parquet('{tmp_path}/events.parquet/*.parquet') WHERE ts IS NOT NULL")
    assert {r[:2]: r[2] for r in db.execute(E.oracle_sql()["stream_drop_too_late"]).fetchall()} == want


def test_slices_keep_their_order(spark):
    df = spark.range(1000).withColumn("arrival", 999 - F.col("id"))
    path = arrivals.write_slices(df, arrivals.slice_of(df, "arrival"))
    out = scratch_path(spark, "order-out")
    q = ss.start_batches(arrivals.read_slices(spark, path, df.schema), out, ss.checkpoint_for(spark, "order"), mode="append")
    ss.run(q)
    got = ss.read_batches(spark, out).groupBy("batch_id").agg(F.min("arrival").alias("a"), F.max("arrival").alias("z"), F.count("*").alias("n"))
    got = sorted((r.batch_id, r.a, r.z, r.n) for r in got.collect())
    assert [g[0] for g in got] == list(range(arrivals.SLICES)) and sum(g[3] for g in got) == 1000
    assert all(x[2] < y[1] for x, y in zip(got, got[1:]))


def test_count_panes_stream_equals_batch(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "value")
    p = spanes.count_panes_stream(arrivals.as_stream(ev, "event_id"), "user_id", "event_id", "value", 3, accumulating=True)
    out = scratch_path(spark, "panes-out")
    ss.run(ss.start_files(p, out, ss.checkpoint_for(spark, "panes")))
    got = sorted((r.user_id, r.pane, r.pane_rows, round(r.pane_value, 6)) for r in spark.read.parquet(out).collect())
    want = panes.count_panes(ev, "user_id", "event_id", "value", 3, mode=panes.ACCUMULATING).collect()
    assert got == sorted((r.user_id, r.pane, r.pane_rows, round(r.pane_value, 6)) for r in want)


def test_any_trigger_stream_equals_batch(spark):
    ev = (spark.read.parquet("/root/testdata/sf0.001/events.parquet")
          .select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value"))
    # two rows far in the future, for a key of their own and in the last two slices, move
    # the watermark past every open pane at the end of the input
    sentinel = spark.createDataFrame([(10**9, -1, None, 0.0), (10**9 + 1, -1, None, 0.0)], ev.schema).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_800_000_000)))
    number = F.when(F.col("user_id") == -1, F.col("event_id") - 10**9 + 10).otherwise(F.expr("event_id div 100"))
    path = arrivals.write_slices(ev.unionByName(sentinel), number)
    p = spanes.segment_panes_stream(arrivals.read_slices(spark, path, ev.schema), "user_id", "ts", "event_id", "value", n=5, delay_s=6 * 3600)
    out = scratch_path(spark, "any-out")
    ss.run(ss.start_files(p, out, ss.checkpoint_for(spark, "any")))
    got = sorted((r.user_id, r.pane, r.pane_start, r.pane_rows, round(r.pane_value, 6))
                 for r in spark.read.parquet(out).filter("user_id >= 0").collect())
    want = panes.segment_panes(ev, "user_id", "ts", "event_id", "value", n=5, delay_s=6 * 3600).collect()
    assert got == sorted((r.user_id, r.pane, r.pane_start, r.pane_rows, round(r.pane_value, 6)) for r in want)


def test_fan_out_two_branches(spark):
    from flumen.plans.streams import events_stream
    s = events_stream(spark, "/root/testdata/sf0.001").select("event_id", "event_type", "value")
    root = scratch_path(spark, "fan-out")
    q = ss.start_fan_out(s, root, ss.checkpoint_for(spark, "fan-out"), {
        "raw": lambda b: b,
        "clicks": lambda b: b.filter(F.col("event_type") == "click").drop("value"),
    })
    ss.run(q)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert spark.read.parquet(f"{root}/raw").count() == ev.count()
    assert spark.read.parquet(f"{root}/clicks").count() == ev.filter("event_type = 'click'").count()


def test_stream_sessions_equal_batch_sessions(spark):
    from flumen.operators import windows
    from flumen.plans.streams import events_stream
    from flumen.streaming import windowed

    sf = "/root/testdata/sf0.001"
    s = events_stream(spark, sf)
    agg = windowed.session_count(s, "ts", "25 minutes", "1 hour", keys="user_id")
    out = scratch_path(spark, "stream-sessions")
    ss.run(ss.start_files(agg, out, ss.checkpoint_for(spark, "stream-sessions")))
    got = sorted((r.user_id, r.window.start, r.window.end, r["count"]) for r in spark.read.parquet(out).collect())

    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    wm = ev.agg(F.max("ts")).first()[0]
    import datetime as dt
    batch = windows.sessions(ev, "ts", 25 * 60, "user_id").collect()
    want = sorted((r.user_id, r.window.start, r.window.end, r["count"]) for r in batch
                  if r.window.end <= wm - dt.timedelta(hours=1))
    assert got == want and len(got) > 0


def test_stream_sliding_windows_equal_batch(spark):
    import datetime as dt

    from flumen.operators import windows
    from flumen.plans.streams import events_stream
    from flumen.streaming import windowed

    sf = "/root/testdata/sf0.001"
    agg = windowed.windowed_count(events_stream(spark, sf), "ts", "30 minutes", "10 minutes", slide="10 minutes")
    out = scratch_path(spark, "stream-sliding")
    ss.run(ss.start_files(agg, out, ss.checkpoint_for(spark, "stream-sliding")))
    got = sorted((r.window.start, r["count"]) for r in spark.read.parquet(out).collect())

    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    wm = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    want = sorted((r.window.start, r["count"]) for r in windows.sliding(ev, "ts", 1800, 600).collect()
                  if r.window.end <= wm)
    assert got == want and len(got) > 0


def test_panes_on_a_session_with_another_state_store(spark):
    """The runners start queries with the store that they need, and put the setting back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    own, other = spark.conf.get(key), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, other)
    try:
        rows = [("pickup", 0, 0), ("enroute", 60, 1), ("pickup", 0, 2), ("enroute", 300, 3), ("enroute", 301, 4)]
        got = _run_taxi(spark, rows, "taxi-store").filter("start = 0").orderBy("pane").collect()
        assert [r["count"] for r in got] == [1, 2] and spark.conf.get(key) == other
    finally:
        spark.conf.set(key, own)
