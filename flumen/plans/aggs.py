"""Recipes: aggregates, HAVING, top-n, hot keys, SQL aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from flumen.operators import aggregates as agg
from flumen.operators import ordered, sets, udfs
from flumen.plans.registry import big, recipe, rnd, table
from flumen.sources import sql as sqlsrc

USER_TRAFFIC_SQL = """
SELECT user_id, COUNT(*) AS page_views, SUM(value) AS total_bytes,
       MAX(value) AS max_bytes, MIN(value) AS min_bytes
FROM {events}
GROUP BY user_id
"""

USER_TRAFFIC_ORACLE = """
SELECT user_id, COUNT(*) AS page_views, round(SUM(value), 4) + 0.0 AS total_bytes,
       round(MAX(value), 4) + 0.0 AS max_bytes, round(MIN(value), 4) + 0.0 AS min_bytes
FROM events GROUP BY user_id
"""


def _round_traffic(df):
    return df.select("user_id", "page_views", rnd("total_bytes").alias("total_bytes"),
                     rnd("max_bytes").alias("max_bytes"), rnd("min_bytes").alias("min_bytes"))


@recipe("agg_user_traffic", USER_TRAFFIC_ORACLE)
def agg_user_traffic(spark, sf):
    ev = table(spark, sf, "events")
    return _round_traffic(agg.stats_per_key(ev, "user_id", "value"))


@recipe("sql_user_traffic", USER_TRAFFIC_ORACLE)
def sql_user_traffic(spark, sf):
    ev = table(spark, sf, "events")
    return _round_traffic(sqlsrc.sql_over(spark, USER_TRAFFIC_SQL, events=ev))


@recipe("sql_over_df", USER_TRAFFIC_ORACLE)
def sql_over_df(spark, sf):
    ev = table(spark, sf, "events")
    return _round_traffic(sqlsrc.sql_over(spark, USER_TRAFFIC_SQL.replace("{events}", "{PCOLLECTION}"),
                                          PCOLLECTION=ev))


@recipe("src_sql_query", USER_TRAFFIC_ORACLE)
def src_sql_query(spark, sf):
    sqlsrc.register_tables(spark, sf, ["events"])
    return _round_traffic(sqlsrc.query(spark, USER_TRAFFIC_SQL.replace("{events}", "events")))


@recipe("agg_count_per_key", """
SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, COUNT(*) AS count
FROM customer GROUP BY ALL
""")
def agg_count_per_key(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_nationkey", big("c_nationkey"))
    return agg.count_per_key(c, ["c_mktsegment", "c_nationkey"])


@recipe("agg_sum_per_key", """
SELECT l_suppkey, round(SUM(l_quantity), 4) + 0.0 AS total FROM lineitem GROUP BY l_suppkey
""")
def agg_sum_per_key(spark, sf):
    li = table(spark, sf, "lineitem")
    out = agg.sum_per_key(li, "l_suppkey", "l_quantity")
    return out.withColumn("total", rnd("total"))


@recipe("agg_min_max_sum", """
SELECT l_suppkey, round(MIN(l_discount), 4) + 0.0 AS min_discount,
       round(MAX(l_discount), 4) + 0.0 AS max_discount, round(SUM(l_discount), 4) + 0.0 AS sum_discount
FROM lineitem GROUP BY l_suppkey
""")
def agg_min_max_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    out = agg.aggregate_fields(li, "l_suppkey", [("l_discount", "min", "min_discount"),
                                                 ("l_discount", "max", "max_discount"),
                                                 ("l_discount", "sum", "sum_discount")])
    return out.select("l_suppkey", *[rnd(c).alias(c) for c in ("min_discount", "max_discount", "sum_discount")])


@recipe("agg_count_no_default", """
SELECT 'most' AS rows_of, COUNT(*) AS count FROM events WHERE value < 1000 HAVING COUNT(*) > 0
UNION ALL SELECT 'none', COUNT(*) FROM events WHERE value > 1000000 HAVING COUNT(*) > 0
UNION ALL SELECT 'hour ' || strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S'), COUNT(*) FROM events WHERE value > 50 GROUP BY 1
""")
def agg_count_no_default(spark, sf):
    """A count without a default: a row where there are rows, none (not 0) where there are
    none; over everything, and per window."""
    ev = table(spark, sf, "events")
    hour = F.concat(F.lit("hour "), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss"))
    parts = [agg.global_count(ev.where("value < 1000")).select(F.lit("most").alias("rows_of"), "count"),
             agg.global_count(ev.where("value > 1000000")).select(F.lit("none").alias("rows_of"), "count"),
             agg.global_count(ev.where("value > 50").withColumn("rows_of", hour), by="rows_of")]
    return sets.union_all(*parts)


@recipe("agg_mean_nan", """
SELECT 'all' AS rows_of, round(coalesce(avg(value), 'NaN'::DOUBLE), 4) + 0.0 AS mean FROM events
UNION ALL SELECT 'none', coalesce(avg(value), 'NaN'::DOUBLE) FROM events WHERE value < -1000000
""")
def agg_mean_nan(spark, sf):
    """A mean with a default: NaN where there are no rows."""
    ev = table(spark, sf, "events")
    means = {"all": agg.mean_or_nan(ev, "value"), "none": agg.mean_or_nan(ev.where("value < -1000000"), "value")}
    return sets.union_all(*[m.select(F.lit(n).alias("rows_of"), rnd("mean").alias("mean")) for n, m in means.items()])


@recipe("agg_mean_per_key", """
SELECT event_type, round(avg(value), 4) + 0.0 AS mean FROM events GROUP BY event_type
""")
def agg_mean_per_key(spark, sf):
    out = agg.mean_per_key(table(spark, sf, "events"), "event_type", "value")
    return out.withColumn("mean", rnd("mean"))


@recipe("udaf_mean", """
SELECT event_type, round(avg(value), 4) + 0.0 AS mean FROM events GROUP BY event_type
""")
def udaf_mean(spark, sf):
    """Custom combine (create/add/merge/extract) per event type: pandas
    accumulators over bounded parts, merged with built-in sums."""
    out = udfs.combine_mean(table(spark, sf, "events"), "event_type", "value")
    return out.withColumn("mean", rnd("mean"))


@recipe("agg_group_list", """
SELECT o_orderstatus, o_orderkey, COUNT(*) OVER (PARTITION BY o_orderstatus) AS group_size FROM orders
""")
def agg_group_list(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey")
    # grouped and flattened again, a row has its group's size: no list, no shuffle of the rows
    return ordered.join_back(o, agg.count_per_key(o, "o_orderstatus", "group_size"), "o_orderstatus")


@recipe("agg_group_then_sum", """
SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY l_partkey
""")
def agg_group_then_sum(spark, sf):
    out = agg.sum_per_key(table(spark, sf, "lineitem"), "l_partkey", "l_quantity")
    return out.withColumn("total", big("total"))


@recipe("agg_top_n", """
SELECT l_partkey, round(SUM(l_quantity), 4) + 0.0 AS total FROM lineitem GROUP BY l_partkey
ORDER BY SUM(l_quantity) DESC, l_partkey LIMIT 100
""")
def agg_top_n(spark, sf):
    sums = agg.sum_per_key(table(spark, sf, "lineitem"), "l_partkey", "l_quantity")
    return agg.top_n(sums, 100, "total", "l_partkey").withColumn("total", rnd("total"))


@recipe("agg_struct_key", """
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, round(SUM(c_acctbal), 4) + 0.0 AS total
FROM customer GROUP BY ALL
""")
def agg_struct_key(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_nationkey", big("c_nationkey"))
    out = agg.sum_per_key(c, ["c_nationkey", "c_mktsegment"], "c_acctbal")
    return out.withColumn("total", rnd("total"))


@recipe("having", """
SELECT l_orderkey, round(SUM(l_quantity), 4) + 0.0 AS total FROM lineitem
GROUP BY l_orderkey HAVING SUM(l_quantity) > 100
""")
def having(spark, sf):
    sums = agg.sum_per_key(table(spark, sf, "lineitem"), "l_orderkey", "l_quantity")
    return agg.having(sums, F.col("total") > 100).withColumn("total", rnd("total"))


@recipe("agg_composite", """
SELECT l_suppkey, COUNT(*) AS total, printf('%d, %d', l_suppkey, COUNT(*)) AS text
FROM lineitem GROUP BY l_suppkey HAVING COUNT(*) > 600
""")
def agg_composite(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("one", F.lit(1).cast("bigint"))
    return li.transform(lambda d: agg.composite(d, "l_suppkey", "one", 600, "%d, %d"))


@recipe("agg_hot_key", """
SELECT o_orderstatus, COUNT(*) AS n, round(SUM(o_totalprice), 2) + 0.0 AS total
FROM (SELECT o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F')
GROUP BY o_orderstatus
""")
def agg_hot_key(spark, sf):
    # a hot status combines in each task before the shuffle, so it needs no salt
    o = table(spark, sf, "orders").where(F.col("o_orderstatus").isNotNull())
    out = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return out.withColumn("total", rnd("total", 2))
