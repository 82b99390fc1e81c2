"""Recipes: trigger panes in batch form (arrival order = ``event_id``, arrival
time = ``ts``; keys = ``user_id``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flumen.operators import panes
from flumen.plans.registry import TS_MICROS, recipe, rnd, table, ts_text

_RN = """SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events"""


def _count_oracle(n: int, once: bool) -> str:
    where = f"WHERE (rn - 1) // {n} = 0" if once else ""
    return f"""
SELECT user_id, CAST((rn - 1) // {n} AS BIGINT) AS pane, COUNT(*) AS pane_rows,
       round(SUM(value), 4) + 0.0 AS pane_value
FROM ({_RN}) {where}
GROUP BY user_id, (rn - 1) // {n} HAVING COUNT(*) = {n}
"""


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


def _out(df):
    return df.withColumn("pane_value", rnd("pane_value"))


@recipe("trigger_count_once", _count_oracle(5, once=True))
def trigger_count_once(spark, sf):
    """AfterCount(5), fired once, global window, DISCARDING: first 5 rows per key."""
    return _out(panes.count_panes(_events(spark, sf), "user_id", "event_id", "value", 5, repeat=False))


@recipe("trigger_count_discarding", _count_oracle(10, once=False))
def trigger_count_discarding(spark, sf):
    """Repeatedly(AfterCount(10)), global window, DISCARDING."""
    return _out(panes.count_panes(_events(spark, sf), "user_id", "event_id", "value", 10))


@recipe("trigger_count_accumulating", """
SELECT user_id, CAST((rn - 1) // 10 AS BIGINT) AS pane, rn AS pane_rows, round(run, 4) + 0.0 AS pane_value
FROM (SELECT user_id, row_number() OVER w AS rn, SUM(value) OVER w AS run FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
WHERE rn % 10 = 0  -- a pane fires on its 10th row
""")
def trigger_count_accumulating(spark, sf):
    """Repeatedly(AfterCount(10)), global window, ACCUMULATING (running totals)."""
    return _out(panes.count_panes(_events(spark, sf), "user_id", "event_id", "value", 10,
                                  mode=panes.ACCUMULATING))


@recipe("trigger_processing_time", """
WITH f AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id)
SELECT user_id, CAST(0 AS BIGINT) AS pane, strftime(t0, '%Y-%m-%d %H:%M:%S.%f') AS pane_start,
       COUNT(*) AS pane_rows, round(SUM(value), 4) + 0.0 AS pane_value
FROM events JOIN f USING (user_id) WHERE ts < t0 + INTERVAL 6 HOUR GROUP BY user_id, t0
""")
def trigger_processing_time(spark, sf):
    """AfterProcessingTime(6 h), once: the rows arriving within 6 h of a key's first row."""
    p = panes.first_pane(_events(spark, sf), "user_id", "ts", "value", delay_s=6 * 3600)
    return _out(p.withColumn("pane_start", ts_text("pane_start", TS_MICROS)))


def _recursive(keys_sql: str, window_sql: str, count_limit: int | None, delay: str) -> str:
    """Sequential pane labelling as a recursive CTE (the independent oracle)."""
    cut = f"s.ts >= r.start + INTERVAL {delay}"
    if count_limit is not None:
        cut = f"(r.cnt >= {count_limit} OR {cut})"
    join_w = " AND s.w = r.w" if window_sql else ""
    w_sel = f"{window_sql} AS w," if window_sql else ""
    w_part = f", {window_sql}" if window_sql else ""
    w_col = "w," if window_sql else ""
    w_grp = ", r.w" if window_sql else ""
    w_out = "strftime(r.w, '%Y-%m-%d %H:%M:%S') AS window_start," if window_sql else ""
    return f"""
WITH RECURSIVE s AS (
  SELECT {keys_sql}, {w_sel} ts, value,
         row_number() OVER (PARTITION BY {keys_sql}{w_part} ORDER BY ts, event_id) AS rn FROM events),
r AS (
  SELECT {keys_sql}, {w_col} rn, ts AS start, 1 AS cnt, 0 AS pane FROM s WHERE rn = 1
  UNION ALL
  SELECT s.{keys_sql}, {"s.w," if window_sql else ""} s.rn,
         CASE WHEN {cut} THEN s.ts ELSE r.start END,
         CASE WHEN {cut} THEN 1 ELSE r.cnt + 1 END,
         CASE WHEN {cut} THEN r.pane + 1 ELSE r.pane END
  FROM r JOIN s ON s.{keys_sql} = r.{keys_sql}{join_w} AND s.rn = r.rn + 1)
SELECT r.{keys_sql}, {w_out} CAST(r.pane AS BIGINT) AS pane,
       strftime(min(s.ts), '%Y-%m-%d %H:%M:%S.%f') AS pane_start,
       COUNT(*) AS pane_rows, round(SUM(s.value), 4) + 0.0 AS pane_value
FROM r JOIN s ON s.{keys_sql} = r.{keys_sql}{join_w} AND s.rn = r.rn
GROUP BY r.{keys_sql}{w_grp}, r.pane
"""


@recipe("trigger_any", _recursive("user_id", "date_trunc('week', ts)", 5, "2 DAY"))
def trigger_any(spark, sf):
    """Weekly windows per key, Repeatedly(AfterAny(AfterCount(5), AfterProcessingTime(2 d))),
    DISCARDING."""
    ev = _events(spark, sf).withColumn("window_start", F.date_trunc("week", "ts"))
    return _windowed(panes.segment_panes(ev, ["user_id", "window_start"], "ts", "event_id", "value", n=5, delay_s=2 * 86400))


@recipe("trigger_early_late", _recursive("user_id", "date_trunc('day', ts)", None, "6 HOUR"))
def trigger_early_late(spark, sf):
    """Daily windows per key; early panes every 6 h of arrival time after a pane opens, the
    rest at the window's end (DISCARDING). Batch data is never late; for late panes see
    ``stream_early_late``."""
    ev = _events(spark, sf).withColumn("window_start", F.date_trunc("day", "ts"))
    return _windowed(panes.segment_panes(ev, ["user_id", "window_start"], "ts", "event_id", "value", delay_s=6 * 3600))


def _windowed(p):
    return _out(p.select("user_id", ts_text("window_start").alias("window_start"), "pane",
                         ts_text("pane_start", TS_MICROS).alias("pane_start"), "pane_rows", "pane_value"))
