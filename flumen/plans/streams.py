"""Recipes: Structured Streaming over the events table.

Each recipe starts a real streaming query (file source -> transformations ->
sink with a checkpoint in the shared scratch folder), runs it to completion
and returns the sink's contents read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flumen import schemas
from flumen.operators import panes, sets
from flumen.plans.joins_sets import corrupted
from flumen.plans.registry import TS_MICROS, recipe, rnd, table, ts_text
from flumen.plans.windows import TUMBLE_SQL
from flumen.session import ensure_utc, scratch_path
from flumen.sources.tables import table_path
from flumen.streaming import arrivals, fired, windowed
from flumen.streaming import sinks as ss
from flumen.streaming import sources as src

HOUR_FMT = "yyyy-MM-dd HH:mm:ss"


def events_stream(spark, sf, max_files=None):
    """The events table as an unbounded file stream (NTZ -> TIMESTAMP, UTC)."""
    ensure_utc(spark)
    schema = spark.read.parquet(table_path(sf, "events")).schema
    s = src.file_stream(spark, sf, schema, glob="events.parquet", max_files=max_files)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(spark, df, label, **kw):
    out = scratch_path(spark, f"{label}-out")
    # as many state partitions as cores: each costs a task in every micro-batch
    kw.setdefault("state_partitions", spark.sparkContext.defaultParallelism)
    ss.run(ss.start_files(df, out, ss.checkpoint_for(spark, label), **kw))
    return spark.read.parquet(out)


_EVENTS_ORACLE = """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
"""


@recipe("stream_source", _EVENTS_ORACLE)
def stream_source(spark, sf):
    s = events_stream(spark, sf).select("event_id", "user_id", "event_type", "ts")
    return _drain(spark, s, "stream-source").withColumn("ts", ts_text("ts", TS_MICROS))


@recipe("stream_event_time_attr", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, user_id, COUNT(*) AS count
FROM events GROUP BY date_trunc('day', ts), user_id
HAVING epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY) <= (SELECT epoch_ms(max(ts)) FROM events) - 3600000
""")
def stream_event_time_attr(spark, sf):
    s = events_stream(spark, sf)
    msgs = src.as_messages(s, F.to_json(F.struct("event_id", "user_id")), ts="ts")
    parsed = src.parse_messages(msgs, schemas.struct(("event_id", schemas.L), ("user_id", schemas.L)))
    timed = src.with_event_time(parsed, "timestamp", "1 hour")
    # the attribute is the event time: days per user close when it passes their end by an hour
    daily = timed.groupBy(F.window("timestamp", "1 day").alias("window"), "user_id").agg(F.count(F.lit(1)).alias("count"))
    out = _drain(spark, daily, "event-time-attr")
    return out.select(F.date_format("window.start", HOUR_FMT).alias("window_start"), "user_id", "count")


@recipe("stream_raw_append", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp,
       TRUE AS has_processing_time
FROM events
""")
def stream_raw_append(spark, sf):
    s = events_stream(spark, sf).select(
        "event_id", "user_id", "event_type", ts_text("ts", TS_MICROS).alias("event_timestamp"),
        F.date_format(F.current_timestamp(), HOUR_FMT).alias("processing_timestamp"))
    out = _drain(spark, s, "raw-append")
    return out.select("event_id", "user_id", "event_type", "event_timestamp",
                      F.col("processing_timestamp").isNotNull().alias("has_processing_time"))


@recipe("stream_replay", f"""
SELECT event_id, user_id, CAST(event_id * {arrivals.SLICES} // ((SELECT max(event_id) FROM events) + 1) AS BIGINT) AS micro_batch FROM events
""")
def stream_replay(spark, sf):
    """Rows in event_id order, a slice per micro-batch, each tagged with the one that
    delivered it."""
    s = arrivals.as_stream(table(spark, sf, "events").select("event_id", "user_id"), "event_id", label="replay")
    out = scratch_path(spark, "replay-out")
    ss.run(ss.start_batches(s, out, ss.checkpoint_for(spark, "replay"), mode="append"))
    return ss.read_batches(spark, out).select("event_id", "user_id", F.col("batch_id").cast("bigint").alias("micro_batch"))


def _window_oracle(where: str, keys: str, delay_ms: int, size: str = "hour") -> str:
    k = f", {keys}" if keys else ""
    return f"""
SELECT strftime(date_trunc('{size}', ts), '%Y-%m-%d %H:%M:%S') AS window_start{k}, COUNT(*) AS count
FROM events {where}
GROUP BY date_trunc('{size}', ts){k}
HAVING epoch_ms(date_trunc('{size}', ts) + INTERVAL 1 {size.upper()}) <= (SELECT epoch_ms(max(ts)) FROM events) - {delay_ms}
"""


@recipe("stream_filter", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS count
FROM events WHERE event_type = 'click'
GROUP BY date_trunc('hour', ts)
HAVING epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR)
       <= (SELECT epoch_ms(max(ts)) FROM events WHERE event_type = 'click') - 600000
""")
def stream_filter(spark, sf):
    """Filter before the window: click events per hour, watermark 10 min,
    append. The filter runs before the watermark (Catalyst pushes it there),
    so the watermark follows the click rows only."""
    s = events_stream(spark, sf).withWatermark("ts", "10 minutes").filter(F.col("event_type") == "click")
    agg = s.groupBy(F.window("ts", "1 hour").alias("window")).agg(F.count(F.lit(1)).alias("count"))
    out = _drain(spark, agg, "stream-filter")
    return out.select(F.date_format("window.start", HOUR_FMT).alias("window_start"), "count")


@recipe("stream_fixed_append", _window_oracle("", "event_type", 600_000))
def stream_fixed_append(spark, sf):
    """Hourly windows per type, one pane each when the watermark passes the end."""
    agg = windowed.windowed_count(events_stream(spark, sf), "ts", "1 hour", "10 minutes", keys="event_type")
    out = _drain(spark, agg, "fixed-append")
    return out.select(F.date_format("window.start", HOUR_FMT).alias("window_start"), "event_type", "count")


@recipe("stream_sliding", """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS count
FROM (SELECT event_type, ts, time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 10 MINUTE * k AS s FROM events, range(3) t(k))
GROUP BY s, event_type
HAVING epoch_ms(s + INTERVAL 30 MINUTE) <= (SELECT epoch_ms(max(ts)) FROM events) - 600000
""")
def stream_sliding(spark, sf):
    """Half-hour windows every ten minutes, one pane each when the watermark passes the end."""
    agg = windowed.windowed_count(events_stream(spark, sf), "ts", "30 minutes", "10 minutes", keys="event_type", slide="10 minutes")
    out = _drain(spark, agg, "stream-sliding")
    return out.select(F.date_format("window.start", HOUR_FMT).alias("window_start"), "event_type", "count")


@recipe("stream_session", """
WITH x AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
y AS (SELECT *, SUM(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM x)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
       strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end, COUNT(*) AS count
FROM y GROUP BY user_id, sid
HAVING epoch_ms(max(ts) + INTERVAL 6 HOUR) <= (SELECT epoch_ms(max(ts)) FROM events) - 3600000
""")
def stream_session(spark, sf):
    """Sessions per user, a gap of six hours, each emitted when the watermark passes its end."""
    agg = windowed.session_count(events_stream(spark, sf), "ts", "6 hours", "1 hour", keys="user_id")
    out = _drain(spark, agg, "stream-session")
    return out.select("user_id", ts_text("window.start", TS_MICROS).alias("window_start"),
                      ts_text("window.end", TS_MICROS).alias("window_end"), "count")


@recipe("stream_sql_tumble", """
SELECT COUNT(*) AS page_views, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS start_time
FROM events GROUP BY date_trunc('minute', ts)
HAVING epoch_ms(date_trunc('minute', ts) + INTERVAL 1 MINUTE) <= (SELECT epoch_ms(max(ts)) FROM events) - 60000
""")
def stream_sql_tumble(spark, sf):
    s = events_stream(spark, sf).withWatermark("ts", "1 minute")
    agg = spark.sql(TUMBLE_SQL, events=s)
    return _drain(spark, agg, "stream-sql-tumble")


# ---- late data: arrivals in slices, every 7th row delayed ---------------------

DELAY_ROWS = 2000


def delayed_arrivals(spark, sf):
    """events with an arrival position: ``event_id``, but 2,000 later for every 7th row."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    return ev.withColumn("arrival", F.col("event_id") + F.when(F.col("event_id") % 7 == 0, DELAY_ROWS).otherwise(0))


def _arrivals_sql(size: str, lateness_ms: int) -> str:
    """Rows with slice b and l, the highest event time of earlier slices; c: 0 on time, 1
    late, 2 too late for the window of the row, which ends at ``e``."""
    return f"""
a AS (SELECT *, event_id + CASE WHEN event_id % 7 = 0 THEN {DELAY_ROWS} ELSE 0 END AS arrival FROM events),
s AS (SELECT *, arrival * {arrivals.SLICES} // ((SELECT max(arrival) FROM a) + 1) AS b,
             date_trunc('{size}', ts) AS w, epoch_ms(date_trunc('{size}', ts) + INTERVAL 1 {size.upper()}) AS e FROM a),
m AS (SELECT b, max(epoch_ms(ts)) AS mx FROM s GROUP BY b),
seen AS (SELECT b, (SELECT max(x.mx) FROM m x WHERE x.b < m.b) AS l FROM m),
r AS (SELECT s.*, CASE WHEN l IS NULL OR l < e THEN 0 WHEN l - {lateness_ms} < e THEN 1 ELSE 2 END AS c
      FROM s JOIN seen USING (b)),
fin AS (SELECT max(mx) AS l FROM m)"""


@recipe("stream_late_accumulating", f"""
WITH {_arrivals_sql("hour", 5 * 86_400_000)},
n AS (SELECT w, e, count(*) FILTER (c = 0) AS early, count(*) FILTER (c = 1) AS late
      FROM r WHERE event_type = 'click' GROUP BY w, e),
p AS (SELECT w, 0 AS pane, 'on_time' AS timing, early AS pane_rows FROM n, fin WHERE early > 0 AND e <= fin.l
      UNION ALL
      SELECT w, i - 1 + CASE WHEN early > 0 THEN 1 ELSE 0 END, 'late', early + i FROM n, unnest(range(1, late + 1)) AS t(i))
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(pane AS BIGINT) AS pane, timing, CAST(pane_rows AS BIGINT) AS count FROM p
""")
def stream_late_accumulating(spark, sf):
    """Clicks per hour: one pane when the watermark passes the hour, then one per late row
    with the grown count, up to 5 days late. Every pane is kept."""
    s = arrivals.as_stream(delayed_arrivals(spark, sf), "arrival", label="late-acc")
    p = fired.window_panes(s, "ts", "1 hour", 5 * 86_400, mode=panes.ACCUMULATING, only=F.col("event_type") == "click")
    out = _drain(spark, p, "late-acc")
    return out.select(F.date_format("window_start", HOUR_FMT).alias("window_start"), "pane", "timing", F.col("pane_rows").alias("count"))


EARLY_ARRIVALS = 40
LATE_ROWS = 5


@recipe("stream_early_late", f"""
WITH RECURSIVE {_arrivals_sql("day", 6 * 86_400_000)},
o AS (SELECT event_type, w, e, arrival, value, row_number() OVER (PARTITION BY event_type, w ORDER BY arrival, event_id) AS i FROM r WHERE c = 0),
early AS (SELECT event_type, w, e, i, arrival AS start, value, 0 AS pane FROM o WHERE i = 1
      UNION ALL
      SELECT o.event_type, o.w, o.e, o.i, CASE WHEN o.arrival >= early.start + {EARLY_ARRIVALS} THEN o.arrival ELSE early.start END, o.value,
             early.pane + CASE WHEN o.arrival >= early.start + {EARLY_ARRIVALS} THEN 1 ELSE 0 END
      FROM early JOIN o ON o.event_type = early.event_type AND o.w = early.w AND o.i = early.i + 1),
last AS (SELECT event_type, w, max(pane) AS top FROM early GROUP BY event_type, w),
ahead AS (SELECT event_type, w, pane, CASE WHEN pane < top THEN 'early' ELSE 'on_time' END AS timing, count(*) AS n, sum(value) AS v
      FROM early JOIN last USING (event_type, w), fin WHERE pane < top OR e <= fin.l GROUP BY event_type, w, pane, top),
g AS (SELECT event_type, w, e, value, (row_number() OVER (PARTITION BY event_type, w ORDER BY arrival, event_id) - 1) // {LATE_ROWS} AS k FROM r WHERE c = 1),
behind AS (SELECT g.event_type, g.w, k + coalesce(max(last.top) + 1, 0) AS pane, 'late' AS timing, count(*) AS n, sum(g.value) AS v
      FROM fin, g LEFT JOIN last ON last.event_type = g.event_type AND last.w = g.w
      GROUP BY g.event_type, g.w, k HAVING count(*) = {LATE_ROWS} OR max(e) <= max(fin.l) - {6 * 86_400_000})
SELECT event_type, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(pane AS BIGINT) AS pane, timing, CAST(n AS BIGINT) AS pane_rows, round(v, 4) + 0.0 AS pane_value
FROM (SELECT * FROM ahead UNION ALL SELECT * FROM behind)
""")
def stream_early_late(spark, sf):
    """Daily windows per type, DISCARDING: early panes 40 arrivals after one opens, the
    rest on time, late panes of five rows, up to 6 days late."""
    s = arrivals.as_stream(delayed_arrivals(spark, sf), "arrival", label="early-late")
    # the arrival position serves as the clock, a second per arrival
    s = s.withColumn("at", F.timestamp_seconds("arrival"))
    p = fired.window_panes(s, "ts", "1 day", 6 * 86_400, "event_type", "value", late_rows=LATE_ROWS, early_s=EARLY_ARRIVALS, arrival="at")
    out = _drain(spark, p, "early-late")
    return out.select("event_type", F.date_format("window_start", HOUR_FMT).alias("window_start"), "pane", "timing", "pane_rows",
                      rnd("pane_value").alias("pane_value"))


ROWS_PER_BATCH = 1000


def _late_oracle(where: str, keys: str, lateness_ms: int) -> str:
    k = f", {keys}" if keys else ""
    return f"""
WITH a AS (SELECT *, (event_id + CASE WHEN event_id % 7 = 0 THEN {DELAY_ROWS} ELSE 0 END) // {ROWS_PER_BATCH} AS b
           FROM events),
bm AS (SELECT b, max(epoch_ms(ts)) AS mx FROM a GROUP BY b),
wm AS (SELECT b, (SELECT max(x.mx) FROM bm x WHERE x.b < bm.b) - {lateness_ms} AS wm FROM bm)
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start{k}, COUNT(*) AS count
FROM a JOIN wm USING (b)
WHERE ({where}) AND (wm.wm IS NULL OR epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) > wm.wm)
GROUP BY date_trunc('hour', ts){k}
"""


@recipe("stream_drop_too_late", _late_oracle("TRUE", "event_type", 86_400_000))
def stream_drop_too_late(spark, sf):
    """Allowed lateness 1 day, judged anew after every 1,000 arrivals: rows later than that
    are dropped; the last count of every window and type."""
    s = arrivals.as_marked_stream(delayed_arrivals(spark, sf), "arrival", "ts", ROWS_PER_BATCH, label="late-drop")
    s = s.where(arrivals.in_time(F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR"), 86_400_000))
    agg = windowed.windowed_count(s, "ts", "1 hour", "1 day", "event_type")
    agg = agg.select(F.date_format("window.start", HOUR_FMT).alias("window_start"), "event_type", "count")
    out = scratch_path(spark, "late-drop-out")
    ss.run(ss.start_batches(agg, out, ss.checkpoint_for(spark, "late-drop"), mode="update",
                            state_partitions=spark.sparkContext.defaultParallelism))
    return ss.latest_per_key(ss.read_batches(spark, out), ["window_start", "event_type"])


# ---- message and dead-letter sinks ---------------------------------------------

@recipe("stream_sink_messages", """
SELECT CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS message FROM events
""")
def stream_sink_messages(spark, sf):
    s = events_stream(spark, sf)
    msgs = src.as_messages(s, F.to_json(F.struct("event_id", "user_id", "event_type")))
    out = _drain(spark, msgs, "messages")  # a broker topic in production
    return out.select(F.decode("value", "UTF-8").alias("message"))


@recipe("stream_dead_letter", """
WITH c AS (
  SELECT CASE WHEN event_id % 10 <> 0 THEN props
              WHEN event_id % 30 = 0 THEN '{"k": 1, "x": ' || CAST(event_id AS VARCHAR) || '}'
              WHEN event_id % 30 = 10 THEN '{"j": 2}'
              ELSE 'not json' END AS value
  FROM events)
SELECT value FROM c
WHERE NOT coalesce(json_valid(value) AND json_keys(CASE WHEN json_valid(value) THEN value END) = ['k'], FALSE)
""")
def stream_dead_letter(spark, sf):
    """Rows that fail the strict parse go, unchanged, to text files, a folder per trigger
    interval (120 s in production; drained at once here)."""
    s = events_stream(spark, sf).select("event_id", "props")
    damaged = corrupted(s)
    _good, bad = sets.split_parsed(damaged, "props", schemas.PROPS)
    out = scratch_path(spark, "dead-letter")
    ss.run(ss.start_text_per_batch(bad.select(F.col("props").alias("value")), out,
                                   ss.checkpoint_for(spark, "dead-letter")))
    return spark.read.text(out).select("value")
