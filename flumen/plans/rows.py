"""Recipes: projections, row mappings and filters."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from flumen.functions import strings
from flumen.operators import rows
from flumen.operators.joins import exclude
from flumen.plans.registry import TS_MICROS, big, recipe, rnd, table, ts_text


@recipe("map_rename", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp, user_id, event_type
FROM events
""")
def map_rename(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    out = rows.rename(ev, {"ts": "event_timestamp"})
    return out.withColumn("event_timestamp", ts_text("event_timestamp", TS_MICROS))


@recipe("map_drop_field", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, round(value, 4) + 0.0 AS value
FROM events
""")
def map_drop_field(spark, sf):
    ev = rows.drop_fields(table(spark, sf, "events"), "props")
    return ev.withColumn("ts", ts_text("ts", TS_MICROS)).withColumn("value", rnd("value"))


@recipe("map_drop_sensitive", """
SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer
""")
def map_drop_sensitive(spark, sf):
    cust = table(spark, sf, "customer")
    out = rows.drop_sensitive(cust, sensitive=("c_name", "c_acctbal"))
    return out.withColumn("c_nationkey", big("c_nationkey"))


@recipe("map_profit", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       round((l_extendedprice - l_discount) * l_quantity, 4) + 0.0 AS profit
FROM lineitem
""")
def map_profit(spark, sf):
    li = table(spark, sf, "lineitem")
    out = rows.with_profit(li, sell="l_extendedprice", buy="l_discount", pieces="l_quantity")
    return out.select("l_orderkey", big("l_linenumber").alias("l_linenumber"), rnd("profit").alias("profit"))


@recipe("map_processing_time", """
SELECT event_id, user_id, TRUE AS formatted, TRUE AS is_now FROM events
""")
def map_processing_time(spark, sf):
    """The time of processing as text: in its format, and within an hour of the time at
    which the query is made."""
    ev = table(spark, sf, "events").select("event_id", "user_id")
    out = rows.with_processing_time(ev)
    made = out.columns[-1]
    at = F.to_timestamp(made, "yyyy-MM-dd HH:mm:ss")
    return out.select(
        "event_id", "user_id", F.col(made).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("formatted"),
        F.abs(F.unix_seconds(at) - F.lit(int(time.time()))).between(0, 3600).alias("is_now"))


@recipe("map_to_json", """
SELECT event_id, CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS json
FROM events
""")
def map_to_json(spark, sf):
    ev = table(spark, sf, "events")
    return rows.with_json(ev, "json", ["event_id", "user_id", "event_type"]).select("event_id", "json")


@recipe("map_constant", """
SELECT event_id, event_type, '1' AS new_col FROM events
""")
def map_constant(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return rows.with_constant(ev, "new_col", "1")


# orders as positional text lines, then split back into named fields
_ORDER_FIELDS = ["order_id", "customer_id", "status", "total", "order_date", "priority"]


@recipe("map_csv_to_struct", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderstatus AS status, printf('%.2f', o_totalprice) AS total,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderpriority AS priority
FROM orders
""")
def map_csv_to_struct(spark, sf):
    o = table(spark, sf, "orders")
    lines = o.select(F.concat_ws(
        ",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
        F.format_string("%.2f", "o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        "o_orderpriority").alias("line"))
    return rows.csv_to_struct(lines, "line", _ORDER_FIELDS)


@recipe("map_units", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       round(l_quantity * 1.8 + 32, 4) + 0.0 AS l_quantity, round(l_tax * 1.8 + 32, 4) + 0.0 AS l_tax
FROM lineitem
""")
def map_units(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    out = rows.to_fahrenheit(li, "l_quantity", "l_tax")
    return out.select("l_orderkey", big("l_linenumber").alias("l_linenumber"),
                      rnd("l_quantity").alias("l_quantity"), rnd("l_tax").alias("l_tax"))


@recipe("map_composite_key", """
SELECT c_custkey, c_mktsegment || ', ' || c_name AS key FROM customer
""")
def map_composite_key(spark, sf):
    c = table(spark, sf, "customer")
    return rows.with_key(c, "key", ["c_mktsegment", "c_name"]).select("c_custkey", "key")


@recipe("map_format", """
SELECT c_custkey, printf('%s, %d regular %s', c_name, c_nationkey, c_mktsegment) AS text FROM customer
""")
def map_format(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", rows.format_text("%s, %d regular %s", "c_name", "c_nationkey",
                                                  "c_mktsegment").alias("text"))


@recipe("flat_map", """
SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE contains(line, 'icense')
""")
def flat_map(spark, sf):
    d = table(spark, sf, "documents")
    licence_lines = F.filter(strings.lines("text"), lambda l: F.contains(l, F.lit("icense")))
    return rows.flat_map(d, licence_lines, "line", keep=["doc_id"])


@recipe("filter_prefix", """
SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE starts_with(line, 'The')
""")
def filter_prefix(spark, sf):
    lines = rows.lines_of(table(spark, sf, "documents"), "text", keep=["doc_id"], with_index=False)
    return rows.where_prefix(lines, "line", "The")


@recipe("filter_threshold", """
SELECT event_id, user_id, round(value, 4) + 0.0 AS value FROM events WHERE value < 120
""")
def filter_threshold(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    return rows.where_below(ev, "value", 120).withColumn("value", rnd("value"))


@recipe("filter_equals", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
""")
def filter_equals(spark, sf):
    o = table(spark, sf, "orders")
    return rows.where_equals(o, "o_orderstatus", "F").select("o_orderkey", "o_custkey", "o_orderpriority")


@recipe("filter_in", """
SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')
""")
def filter_in(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return rows.where_in(ev, "event_type", ["click", "purchase"])


@recipe("filter_length_not_in", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE length(c_mktsegment) >= 9
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey = c_custkey)
""")
def filter_length_not_in(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    urgent = (table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_custkey").alias("c_custkey")).distinct())
    return exclude(rows.where_length_between(c, "c_mktsegment", 9), urgent, "c_custkey")


@recipe("filter_trimmed", """
SELECT o_orderkey FROM orders WHERE trim(o_orderpriority, ' ' || chr(9) || chr(13) || chr(10)) = '1-URGENT'
""")
def filter_trimmed(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return rows.where_stripped_equals(o, "o_orderpriority", "1-URGENT").select("o_orderkey")


@recipe("filter_even_typed", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0
""")
def filter_even_typed(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rows.where_even(o, "o_orderkey")


@recipe("sql_where_limit", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_orderkey LIMIT 100
""")
def sql_where_limit(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return rows.where_limit(o, F.col("o_orderstatus") == "O", 100, [F.col("o_orderkey")])
