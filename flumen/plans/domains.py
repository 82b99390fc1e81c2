"""Recipes: the reference's end-to-end domains re-aimed at the shared tables.

* packages -- page URLs stand in for Java names (``/`` for ``.``); a page
  "imports" its own URL path; junk-marker lines of its HTML stand in for
  FIXME/TODO lines.
* weather -- suppliers are places; discount x 100 and quantity are the low and
  high temperature (Celsius), tax the precipitation.
* food orders -- orders as text lines.
* bank -- line items are card statements (spent = price, limit = the order's
  largest line, cleared = price x (1 - 10 x discount)); orders are loans
  (priority 1/2 = medical, else personal; due 30 days after the order date,
  paid on the last ship date).
* store -- line items are sales: supplier = store, return flag = city.
* game -- line items are fights: supplier = player, return flag = weapon,
  quantity = battle time, tax/discount x 100 = ranks, line status = place.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flumen import schemas
from flumen.domains import bank, food, game, packages, store, weather
from flumen.operators import panes, sets, windows
from flumen.plans.registry import big, recipe, rnd, table
from flumen.plans.scalars import PREFIXES_SQL, url_path
from flumen.session import materialize, scratch_path
from flumen.sources import files, sinks

# ---- packages ---------------------------------------------------------------

# Fixed value for the re-aimed data: junk markers in page HTML.
PAGE_MARKERS = ("%%%", "$$$")

_POP_SQL = f"""
SELECT prefix AS package, COUNT(*) AS popularity FROM ({PREFIXES_SQL}) GROUP BY prefix
ORDER BY popularity DESC, package LIMIT 1000
"""
_HELP_SQL = f"""
SELECT prefix AS package, CAST(SUM(n) AS BIGINT) AS help
FROM ({PREFIXES_SQL}) p
JOIN (SELECT page_id, len(list_filter(string_split(html, chr(10)),
                          lambda l: contains(l, '%%%') OR contains(l, '$$$'))) AS n FROM pages) h USING (page_id)
GROUP BY prefix HAVING SUM(n) > 0
"""


def _pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", "html", url_path().alias("path"))


def _popular(spark, sf):
    return packages.popularity(packages.name_uses(_pages(spark, sf), F.col("path"), "/"))


def _help(spark, sf):
    """Sources whose last package line names them: the page's text behind a line for its
    site and one for its path."""
    line = F.concat(F.lit("package "), F.col("path"), F.lit(";"))
    site = F.concat(F.lit("package "), F.substring_index("path", "/", 1), F.lit("; "))
    pages = _pages(spark, sf).select(F.concat_ws("\n", site, line, "html").alias("source"))
    return packages.needs_help(pages, "source", markers=PAGE_MARKERS, sep="/")


@recipe("dom_popularity", _POP_SQL)
def dom_popularity(spark, sf):
    return _popular(spark, sf)


@recipe("dom_needs_help", _HELP_SQL)
def dom_needs_help(spark, sf):
    return _help(spark, sf).withColumn("help", big("help"))


@recipe("dom_composite_score", f"""
SELECT package, round(ln(help) * ln(popularity), 6) + 0.0 AS score
FROM ({_POP_SQL}) JOIN ({_HELP_SQL}) USING (package)
WHERE ln(help) * ln(popularity) > 0
""")
def dom_composite_score(spark, sf):
    out = packages.composite_score(_popular(spark, sf), _help(spark, sf))
    return out.withColumn("score", rnd("score", 6))


# ---- weather ----------------------------------------------------------------

@recipe("dom_weather", """
SELECT l_suppkey AS loc_id, round(MIN(l_discount * 100 * 1.8 + 32), 4) + 0.0 AS record_low,
       round(MAX(l_quantity * 1.8 + 32), 4) + 0.0 AS record_high, round(SUM(l_tax), 4) + 0.0 AS total_precip
FROM lineitem GROUP BY l_suppkey
""")
def dom_weather(spark, sf):
    """The whole case: a text file of CSV lines, parsed, converted, reduced per place,
    written as JSON lines."""
    li = table(spark, sf, "lineitem")
    lines = li.select(F.concat_ws(",", F.col("l_suppkey").cast("string"), F.lit("0.0"), F.lit("0.0"),
                                  F.date_format("l_shipdate", "yyyy-MM-dd"), (F.col("l_discount") * 100).cast("string"),
                                  F.col("l_quantity").cast("string"), F.col("l_tax").cast("string")).alias("value"))
    source, target = scratch_path(spark, "weather-in"), scratch_path(spark, "weather-out")
    sinks.write_text(lines, source)
    stats = weather.weather_stats(files.text_lines(spark, f"{source}/part-*"))
    sinks.write_text(weather.as_json(stats), target)
    out = files.json_lines(spark, f"{target}/part-*", schemas.struct(("loc_id", schemas.S), ("record_low", schemas.D),
                                                                     ("record_high", schemas.D), ("total_precip", schemas.D)))
    return out.select(big("loc_id").alias("loc_id"), *[rnd(c).alias(c) for c in ("record_low", "record_high", "total_precip")])


# ---- food orders ------------------------------------------------------------

FOOD_FIELDS = ["customer_id", "date", "order_id", "status", "priority", "amount", "new_col"]


@recipe("dom_food_orders", """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id, strftime(o_orderdate, '%Y-%m-%d') AS date,
       CAST(o_orderkey AS VARCHAR) AS order_id, lower(o_orderstatus) AS status, lower(o_orderpriority) AS priority,
       printf('%.2f', o_totalprice) AS amount, '1' AS new_col, strftime(o_orderdate, '%Y-%m-%d') AS ingest_date
FROM orders
""")
def dom_food_orders(spark, sf):
    o = table(spark, sf, "orders")
    lines = o.select(F.concat_ws(",", F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"),
                                 F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority",
                                 F.format_string("%.2f", "o_totalprice")).alias("value"))
    path = scratch_path(spark, "food-by-day")
    cleaned = food.clean(lines, FOOD_FIELDS, day_field="date")
    sinks.write_day_partitioned(cleaned, path, F.to_date("ingest_date"))
    return spark.read.schema(cleaned.schema).option("basePath", path).parquet(path)


# ---- bank -------------------------------------------------------------------

def statements(spark, sf):
    """Line items as card statements; the limit is the order's largest line (an order has a
    few lines, so its window is small)."""
    li = table(spark, sf, "lineitem")
    st = li.select(
        "l_orderkey", "l_shipdate",
        F.round("l_extendedprice").cast("bigint").alias("spent"),
        F.round(F.col("l_extendedprice") * (1 - 10 * F.col("l_discount"))).cast("bigint").alias("payment_cleared"))
    return st.withColumn("max_limit", F.max("spent").over(Window.partitionBy("l_orderkey")))


def cards(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                          F.col("o_custkey").alias("customer_id"))
    return statements(spark, sf).join(o, "l_orderkey")


def _as_loans(o):
    """Orders with the day they were paid on, as loan records."""
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(" Medical Loan "))
        .otherwise(F.lit("Personal Loan ")).alias("category"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "dd-MM-yyyy").alias("due_date"),
        F.round("o_totalprice").cast("bigint").alias("amount"),
        F.date_format("paid_on", "dd-MM-yyyy").alias("payment_date"))


def loans(spark, sf):
    paid = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("paid_on"))
    return _as_loans(table(spark, sf, "orders").join(paid, "o_orderkey"))


_CARD_SQL = """
SELECT customer_id,
       CAST(SUM(CAST(paid < spent * CAST(0.7 AS DOUBLE) AS INT)
                + CAST(spent = max_limit AND paid < spent AS INT)
                + CAST(spent = max_limit AND paid < spent * CAST(0.7 AS DOUBLE) AS INT)) AS BIGINT) AS points
FROM (SELECT *, max(spent) OVER (PARTITION BY l_orderkey) AS max_limit
      FROM (SELECT o_custkey AS customer_id, l_orderkey, CAST(round(l_extendedprice) AS BIGINT) AS spent,
                   CAST(round(l_extendedprice * (1 - 10 * l_discount)) AS BIGINT) AS paid
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
GROUP BY customer_id HAVING points > 0
"""

_LOANS_CTE = """
ship AS (SELECT l_orderkey, max(l_shipdate) AS paid_on FROM lineitem GROUP BY l_orderkey),
loans AS (SELECT o_custkey AS customer_id, o_orderpriority IN ('1-URGENT', '2-HIGH') AS medical,
                 CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS due, CAST(paid_on AS DATE) AS paid
          FROM orders JOIN ship ON o_orderkey = l_orderkey)
"""

_MEDICAL_SQL = f"""
WITH {_LOANS_CTE}
SELECT customer_id, CAST(SUM(CASE WHEN paid > due THEN 1 ELSE 0 END) AS BIGINT) AS missed, 'late' AS reason
FROM loans WHERE medical GROUP BY customer_id HAVING SUM(CASE WHEN paid > due THEN 1 ELSE 0 END) >= 3
"""

_PERSONAL_SQL = f"""
WITH {_LOANS_CTE},
pm AS (SELECT DISTINCT customer_id, month(paid) AS m FROM loans WHERE NOT medical),
g AS (SELECT customer_id, m, m - coalesce(lag(m) OVER (PARTITION BY customer_id ORDER BY m), 0) - 1 AS gap FROM pm),
s AS (SELECT customer_id, greatest(max(gap), 12 - max(m)) AS longest FROM g GROUP BY customer_id),
n AS (SELECT customer_id, count(*) AS n FROM loans WHERE NOT medical GROUP BY customer_id),
r AS (SELECT customer_id,
             CASE WHEN 12 - n > 4 THEN 12 - n WHEN longest > 2 THEN longest ELSE 0 END AS missed,
             CASE WHEN 12 - n > 4 THEN 'missed' WHEN longest > 2 THEN 'gap' END AS reason
      FROM n JOIN s USING (customer_id))
SELECT customer_id, CAST(missed AS BIGINT) AS missed, reason FROM r WHERE missed > 0
"""


@recipe("dom_card_defaulters", _CARD_SQL)
def dom_card_defaulters(spark, sf):
    return bank.card_points(cards(spark, sf))


@recipe("dom_medical_loan", _MEDICAL_SQL)
def dom_medical_loan(spark, sf):
    return bank.medical_defaulters(loans(spark, sf))


@recipe("dom_personal_loan", _PERSONAL_SQL)
def dom_personal_loan(spark, sf):
    return bank.personal_defaulters(loans(spark, sf))


@recipe("join_defaulters", f"""
WITH card AS ({_CARD_SQL}),
loan AS (SELECT * FROM ({_PERSONAL_SQL}) UNION ALL SELECT * FROM ({_MEDICAL_SQL})),
lg AS (SELECT customer_id, string_agg(reason || ':' || CAST(missed AS VARCHAR), ';' ORDER BY reason, missed) AS loan,
              COUNT(*) AS n_loan FROM loan GROUP BY customer_id)
SELECT coalesce(card.customer_id, lg.customer_id) AS customer_id,
       coalesce(CAST(card.points AS VARCHAR), '') AS card, coalesce(lg.loan, '') AS loan,
       CAST(CASE WHEN card.customer_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_card,
       coalesce(lg.n_loan, 0) AS n_loan
FROM card FULL OUTER JOIN lg ON card.customer_id = lg.customer_id
""")
def join_defaulters(spark, sf):
    # a row per order (points of its statements, the day it was paid on), written once:
    # both sides of the co-group are made of it, and each source is read once
    per_order = statements(spark, sf).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(bank.statement_points()).alias("points"), F.max("l_shipdate").alias("paid_on"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    per_order = materialize(o.join(per_order, "o_orderkey").drop("o_orderkey"), "per-order")
    card = bank.card_points(per_order.withColumnRenamed("o_custkey", "customer_id"), points=F.col("points"))
    return bank.both_defaulters(card, bank.loan_defaulters(_as_loans(per_order)))


# ---- game -------------------------------------------------------------------

BATTLE_GAP_S = 7 * 86_400


@recipe("dom_battle_points", """
WITH b AS (
  SELECT l_suppkey AS player, l_returnflag AS weapon, l_shipdate AS ts, l_orderkey * 8 + l_linenumber AS tie,
         (CASE WHEN l_quantity BETWEEN 10 AND 20 THEN 4 WHEN l_quantity BETWEEN 21 AND 30 THEN 3
               WHEN l_quantity BETWEEN 31 AND 40 THEN 2 WHEN l_quantity >= 41 THEN 1 ELSE 0 END)
         + (CASE WHEN r >= 6 THEN 3 WHEN r >= 3 THEN 2 ELSE 1 END)
         + (CASE WHEN l_linestatus <> 'F' THEN 3 ELSE 0 END) AS points
  FROM (SELECT *, CAST(round(l_tax * 100) AS BIGINT) - CAST(round(l_discount * 100) AS BIGINT) AS r FROM lineitem)),
x AS (SELECT *, lag(ts) OVER (PARTITION BY player, weapon ORDER BY ts, tie) AS prev FROM b),
y AS (SELECT *, SUM(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 7 DAY THEN 1 ELSE 0 END)
                OVER (PARTITION BY player, weapon ORDER BY ts, tie ROWS UNBOUNDED PRECEDING) AS sid FROM x)
SELECT player, weapon, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(max(ts) + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       COUNT(*) AS battles, round(avg(points), 4) + 0.0 AS mean_points
FROM y GROUP BY player, weapon, sid
""")
def dom_battle_points(spark, sf):
    li = table(spark, sf, "lineitem")
    fights = li.select(
        F.col("l_suppkey").alias("player"), F.col("l_returnflag").alias("weapon"), F.col("l_shipdate").alias("ts"),
        game.battle_points(F.col("l_quantity"), F.round(F.col("l_tax") * 100).cast("bigint"),
                           F.round(F.col("l_discount") * 100).cast("bigint"),
                           F.col("l_linestatus"), F.lit("F")).alias("points"))
    out = game.mean_points_per_session(fights, ["player", "weapon"], "ts", "points", BATTLE_GAP_S)
    return out.select("player", "weapon", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                      "battles", rnd("mean_points").alias("mean_points"))


@recipe("dom_game_scores", """
WITH b AS (SELECT 'player' AS board, CAST(user_id AS VARCHAR) AS name, event_id FROM events
           UNION ALL SELECT 'team', event_type, event_id FROM events),
n AS (SELECT board, name, row_number() OVER (PARTITION BY board, name ORDER BY event_id) AS score FROM b)
SELECT board, name, CAST(score // 10 - 1 AS BIGINT) AS pane, score FROM n WHERE score % 10 = 0
""")
def dom_game_scores(spark, sf):
    """Running scores of players and of their teams, a pane after every tenth event of each;
    one scan feeds both boards."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.lit(1).cast("bigint").alias("point"))
    both = sets.flatten_branches(ev, {"player": F.lit(True), "team": F.lit(True)}, "board")
    both = both.withColumn("name", F.when(F.col("board") == "player", F.col("user_id").cast("string")).otherwise(F.col("event_type")))
    out = panes.count_panes(both, ["board", "name"], "event_id", "point", 10, mode=panes.ACCUMULATING)
    return out.select("board", "name", "pane", big("pane_value").alias("score"))


# ---- store ------------------------------------------------------------------

# Fixed values for the re-aimed data: ship modes stand in for cities.
STORE_CITIES = ("A", "R")
_SALES_SQL = """
SELECT CAST(l_suppkey AS VARCHAR) AS store_id, CAST(epoch(l_shipdate) AS BIGINT) AS t,
       (CAST(floor(l_extendedprice) AS BIGINT) - CAST(floor(l_extendedprice * 0.5) AS BIGINT)) * CAST(l_quantity AS BIGINT) AS profit
FROM lineitem WHERE l_returnflag IN ('A', 'R')
"""


def _sales(spark, sf):
    """Line items as the lines of a sales file, padded as its lines are."""
    li = table(spark, sf, "lineitem")
    lines = li.select(F.concat(F.lit("  "), F.concat_ws(",", *[c.cast("string") for c in (
        F.col("l_suppkey"), F.col("l_returnflag"), F.col("l_partkey"), F.lit("x"), F.col("l_quantity").cast("long"),
        F.floor(F.col("l_extendedprice") * 0.5), F.floor("l_extendedprice"), F.unix_seconds(F.col("l_shipdate").cast("timestamp")))]), F.lit(" ")).alias("value"))
    path = scratch_path(spark, "store-sales")
    sinks.write_text(lines, path)
    return store.profits(files.text_lines(spark, f"{path}/part-*"), STORE_CITIES)


def _profit_out(df):
    return df.select("store_id", F.unix_seconds("window.start").alias("window_start"), F.unix_seconds("window.end").alias("window_end"), "profit")


_WEEK = 7 * 86_400


@recipe("dom_store_profit", f"""
SELECT store_id, t - t % {_WEEK} AS window_start, t - t % {_WEEK} + {_WEEK} AS window_end, CAST(SUM(profit) AS BIGINT) AS profit
FROM ({_SALES_SQL}) GROUP BY store_id, t - t % {_WEEK}
""")
def dom_store_profit(spark, sf):
    """Profit per store and fixed window, from text lines on."""
    return _profit_out(windows.fixed(_sales(spark, sf), "ts", _WEEK, "store_id", [F.sum("profit").alias("profit")]))


@recipe("dom_store_profit_sliding", f"""
SELECT store_id, s AS window_start, s + {2 * _WEEK} AS window_end, CAST(SUM(profit) AS BIGINT) AS profit
FROM (SELECT *, t - t % {_WEEK} - {_WEEK} * k AS s FROM ({_SALES_SQL}), range(2) r(k)) GROUP BY store_id, s
""")
def dom_store_profit_sliding(spark, sf):
    return _profit_out(windows.sliding(_sales(spark, sf), "ts", 2 * _WEEK, _WEEK, "store_id", {"profit": ("sum", "profit")}))


@recipe("dom_store_profit_sessions", f"""
WITH x AS (SELECT *, lag(t) OVER (PARTITION BY store_id ORDER BY t) AS prev FROM ({_SALES_SQL})),
y AS (SELECT *, SUM(CASE WHEN prev IS NULL OR t > prev + {_WEEK} THEN 1 ELSE 0 END) OVER (PARTITION BY store_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS sid FROM x)
SELECT store_id, min(t) AS window_start, max(t) + {_WEEK} AS window_end, CAST(SUM(profit) AS BIGINT) AS profit FROM y GROUP BY store_id, sid
""")
def dom_store_profit_sessions(spark, sf):
    return _profit_out(windows.sessions(_sales(spark, sf), "ts", _WEEK, "store_id", {"profit": ("sum", "profit")}))
