"""Recipes: joins, co-group, fan-out, unions and multi-output splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from flumen import schemas
from flumen.operators import aggregates as agg
from flumen.operators import joins, sets
from flumen.plans.registry import recipe, table


@recipe("join_cogroup", """
WITH sides AS (
  SELECT c_custkey AS custkey, 'customer' AS tag, c_name AS item FROM customer
  UNION ALL
  SELECT o_custkey AS custkey, 'orders' AS tag, concat_ws('|', o_orderkey, o_orderstatus) AS item FROM orders
), sizes AS (
  SELECT custkey, count(*) FILTER (WHERE tag = 'customer') AS n_customer,
         count(*) FILTER (WHERE tag = 'orders') AS n_orders
  FROM sides GROUP BY custkey
)
SELECT custkey, tag, item, n_customer, n_orders FROM sides JOIN sizes USING (custkey)
""")
def join_cogroup(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("o"))
    sides = {"customer": cust, "orders": orders}
    return joins.cogroup_with_sizes(sides, "custkey")


@recipe("join_broadcast_lookup", """
SELECT o_orderkey, o_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 0
""")
def join_broadcast_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    nation_of = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                    F.col("c_nationkey").cast("bigint").alias("c_nationkey"))
    return joins.lookup_nonzero(o, nation_of, "o_custkey", "c_nationkey")


@recipe("join_anti_list", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IS NOT NULL)
""")
def join_anti_list(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    debtors = (table(spark, sf, "customer").filter(F.col("c_acctbal") < 0)
               .select(F.col("c_custkey").alias("o_custkey")))
    return joins.exclude(o, debtors, "o_custkey")


@recipe("branch_two_aggs", """
SELECT 'per_user' AS branch, CAST(user_id AS VARCHAR) AS key, COUNT(*) AS count FROM events GROUP BY user_id
UNION ALL
SELECT 'per_type' AS branch, event_type AS key, COUNT(*) AS count FROM events GROUP BY event_type
""")
def branch_two_aggs(spark, sf):
    ev = table(spark, sf, "events")  # one source, one scan, two branches
    return agg.of_sets(ev, {"per_user": "user_id", "per_type": "event_type"}, F.count(F.lit(1)).alias("count"))


@recipe("union_all", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
""")
def union_all(spark, sf):
    """Two branches of one source flattened: one scan, a row once per branch that takes it."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sets.flatten_branches(o, {"final": F.col("o_orderstatus") == "F", "open": F.col("o_orderstatus") == "O"}).drop("branch")


_UNION_LIMIT_SQL = """
(SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 1000)
UNION ALL
(SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 10)
"""


@recipe("sql_union_all_limit", _UNION_LIMIT_SQL)
def sql_union_all_limit(spark, sf):
    from flumen.sources import sql as sqlsrc
    sqlsrc.register_tables(spark, sf, ["orders"])
    return sqlsrc.query(spark, _UNION_LIMIT_SQL)


@recipe("split_tagged", """
SELECT event_id, CASE WHEN value < 10 THEN 'small' WHEN value > 400 THEN 'large' ELSE 'main' END AS tag
FROM events
""")
def split_tagged(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    tagged = sets.tag_first_match(ev, [("small", F.col("value") < 10), ("large", F.col("value") > 400)])
    return tagged.select("event_id", "tag")  # each output is sets.output(tagged, name)


def corrupted(ev):
    """events with the props of every tenth row damaged: extra key, missing key, junk.
    For tables and streams."""
    r = F.col("event_id") % 30
    bad = (F.when(r == 0, F.concat(F.lit('{"k": 1, "x": '), F.col("event_id").cast("string"), F.lit("}")))
           .when(r == 10, F.lit('{"j": 2}'))
           .otherwise(F.lit("not json")))
    return ev.withColumn("props", F.when(F.col("event_id") % 10 == 0, bad).otherwise(F.col("props")))


@recipe("split_parse_dead_letter", """
WITH c AS (
  SELECT event_id,
         CASE WHEN event_id % 10 <> 0 THEN props
              WHEN event_id % 30 = 0 THEN '{"k": 1, "x": ' || CAST(event_id AS VARCHAR) || '}'
              WHEN event_id % 30 = 10 THEN '{"j": 2}'
              ELSE 'not json' END AS props
  FROM events),
p AS (SELECT event_id, props,
             coalesce(json_valid(props) AND json_keys(CASE WHEN json_valid(props) THEN props END) = ['k'],
                      FALSE) AS ok
      FROM c)
SELECT event_id, CASE WHEN ok THEN 'parsed' ELSE 'dead_letter' END AS outcome,
       CASE WHEN ok THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, props AS raw
FROM p
""")
def split_parse_dead_letter(spark, sf):
    labelled = sets.parse_outcome(corrupted(table(spark, sf, "events").select("event_id", "props")), "props", schemas.PROPS)
    return labelled.select("event_id", "outcome", F.col("parsed.k").alias("k"), F.col("props").alias("raw"))
