"""Recipes: event time and batch windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from flumen.functions import dates
from flumen.operators import windows
from flumen.plans.registry import TS_MICROS, recipe, rnd, table, ts_text
from flumen.sources import sql as sqlsrc

_ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


@recipe("time_from_iso", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS event_time FROM events
""")
def time_from_iso(spark, sf):
    ev = table(spark, sf, "events")
    iso = ev.select("event_id", F.date_format("ts", _ISO_MICROS_Z).alias("timestamp"))
    return iso.select("event_id", ts_text(dates.iso_to_seconds("timestamp")).alias("event_time"))


@recipe("time_from_epoch", """
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_s,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS event_time
FROM events
""")
def time_from_epoch(spark, sf):
    ev = table(spark, sf, "events").select("event_id", dates.to_epoch_seconds("ts").alias("epoch_s"))
    return ev.withColumn("event_time", ts_text(dates.from_epoch_seconds("epoch_s")))


@recipe("time_from_transport", """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp FROM events
""")
def time_from_transport(spark, sf):
    # the envelope's time (a message's publish time, here the record's ts)
    # copied into the payload as a plain column
    ev = table(spark, sf, "events")
    return ev.select("event_id", "user_id", ts_text("ts", TS_MICROS).alias("event_timestamp"))


_HOURLY_ORACLE = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       COUNT(*) AS count
FROM events GROUP BY date_trunc('hour', ts)
"""


def _window_cols(w="window", fmt="yyyy-MM-dd HH:mm:ss"):
    return [F.date_format(f"{w}.start", fmt).alias("window_start"),
            F.date_format(f"{w}.end", fmt).alias("window_end")]


@recipe("win_fixed_global", _HOURLY_ORACLE)
def win_fixed_global(spark, sf):
    out = windows.fixed(table(spark, sf, "events"), "ts", 3600)
    return out.select(*_window_cols(), "count")


@recipe("win_fixed_per_key", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       COUNT(*) AS count, round(SUM(value), 4) + 0.0 AS total
FROM events GROUP BY date_trunc('hour', ts), event_type
""")
def win_fixed_per_key(spark, sf):
    out = windows.fixed(table(spark, sf, "events"), "ts", 3600, keys="event_type",
                        aggs=[F.count(F.lit(1)).alias("count"), F.sum("value").alias("total")])
    return out.select(_window_cols()[0], "event_type", "count", rnd("total").alias("total"))


@recipe("win_sliding", """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, COUNT(*) AS count
FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 10 MINUTE * k AS s FROM events, range(3) t(k))
GROUP BY s
""")
def win_sliding(spark, sf):
    out = windows.sliding(table(spark, sf, "events"), "ts", 1800, 600)
    return out.select(*_window_cols(), "count")


_SESSION_ORACLE = """
WITH x AS (
  SELECT user_id, ts, event_id, value,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
y AS (
  SELECT *, SUM(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 25 MINUTE THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM x)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
       strftime(max(ts) + INTERVAL 25 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
       COUNT(*) AS count, round(SUM(value), 4) + 0.0 AS total
FROM y GROUP BY user_id, sid
"""


@recipe("win_session", _SESSION_ORACLE)
def win_session(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "ts", "value")
    out = windows.sessions(ev, "ts", 25 * 60, "user_id", {"count": ("count", None), "total": ("sum", "value")})
    return out.select("user_id", *_window_cols(fmt=TS_MICROS), "count", rnd("total").alias("total"))


@recipe("win_global", """
SELECT event_type, COUNT(*) AS count, round(SUM(value), 4) + 0.0 AS total FROM events GROUP BY event_type
""")
def win_global(spark, sf):
    out = windows.global_window(table(spark, sf, "events"), "event_type",
                                [F.count(F.lit(1)).alias("count"), F.sum("value").alias("total")])
    return out.withColumn("total", rnd("total"))


@recipe("win_start_text", """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') AS window_start, COUNT(*) AS page_views
FROM events GROUP BY date_trunc('minute', ts)
""")
def win_start_text(spark, sf):
    out = windows.fixed(table(spark, sf, "events"), "ts", 60, aggs=[F.count(F.lit(1)).alias("page_views")])
    return out.select(windows.start_text("window").alias("window_start"), "page_views")


TUMBLE_SQL = """
SELECT COUNT(*) AS page_views, CAST(window.start AS STRING) AS start_time
FROM {events}
GROUP BY window(ts, '1 minute')
"""


@recipe("sql_tumble", """
SELECT COUNT(*) AS page_views, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS start_time
FROM events GROUP BY date_trunc('minute', ts)
""")
def sql_tumble(spark, sf):
    return sqlsrc.sql_over(spark, TUMBLE_SQL, events=table(spark, sf, "events"))
