"""Recipes: scalar functions (strings, binary, dates, math, arrays, maps, JSON)
and the Arrow-batched user-function escape hatches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flumen.domains.game import BATTLE_TIME_TIERS
from flumen.functions import collections as coll
from flumen.functions import dates, numeric, strings
from flumen.operators import rows, udfs
from flumen.plans.registry import big, recipe, rnd, table

_LINES_SQL = """SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS BIGINT) AS line_no,
       unnest(string_split(text, chr(10))) AS line FROM documents"""


def doc_lines(spark, sf):
    out = rows.lines_of(table(spark, sf, "documents"), "text", keep=["doc_id"])
    return out.withColumn("line_no", big("line_no"))


@recipe("fn_split", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word,
       CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words
FROM part
""")
def fn_split(spark, sf):
    p = table(spark, sf, "part").withColumn("w", strings.split_fields("p_name", " "))
    return p.select("p_partkey", F.element_at("w", 1).alias("first_word"), F.element_at("w", -1).alias("last_word"),
                    F.size("w").cast("bigint").alias("n_words"))


@recipe("fn_trim", f"""
SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(13) || chr(10)) AS line FROM ({_LINES_SQL})
""")
def fn_trim(spark, sf):
    return doc_lines(spark, sf).withColumn("line", strings.strip("line"))


@recipe("fn_lower", "SELECT c_custkey, lower(c_name) AS name FROM customer")
def fn_lower(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", strings.lower("c_name").alias("name"))


@recipe("fn_regex_clean", "SELECT page_id, regexp_replace(url, '[?%&]', '', 'g') AS url FROM pages")
def fn_regex_clean(spark, sf):
    return table(spark, sf, "pages").select("page_id", strings.remove_chars("url").alias("url"))


@recipe("fn_contains", """
SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)),
       lambda l: contains(l, 'License') OR contains(l, 'licensed'))) AS BIGINT) AS marker_lines
FROM documents
""")
def fn_contains(spark, sf):
    d = table(spark, sf, "documents")
    marked = F.filter(strings.lines("text"), lambda l: strings.contains_any(l, ["License", "licensed"]))
    return d.select("doc_id", F.size(marked).cast("bigint").alias("marker_lines"))


@recipe("fn_between", f"""
SELECT doc_id, line_no, name FROM (
  SELECT doc_id, line_no,
         CASE WHEN strpos(line, 'under the ') > 0
                   AND strpos(substr(line, strpos(line, 'under the ') + 10), ',') > 1
              THEN trim(substr(substr(line, strpos(line, 'under the ') + 10), 1,
                               strpos(substr(line, strpos(line, 'under the ') + 10), ',') - 1),
                        ' ' || chr(9) || chr(13) || chr(10)) END AS name
  FROM ({_LINES_SQL}))
WHERE name IS NOT NULL
""")
def fn_between(spark, sf):
    lines = doc_lines(spark, sf)
    out = lines.select("doc_id", "line_no", strings.text_between("line", "under the ", ",").alias("name"))
    return out.filter(F.col("name").isNotNull())


def url_path(c="url"):
    """host + path of a URL: scheme, query, fragment and trailing '/' removed."""
    path = F.regexp_extract(F.col(c), r"^[a-z]+://([^?#]*)", 1)
    return F.regexp_replace(path, "/+$", "")


_URL_PATH_SQL = "rtrim(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/')"
PREFIXES_SQL = f"""
SELECT page_id, unnest(list_transform(range(1, len(string_split(p, '/')) + 1),
                                      lambda i: array_to_string(string_split(p, '/')[1:i], '/'))) AS prefix
FROM (SELECT page_id, {_URL_PATH_SQL} AS p FROM pages)
"""


@recipe("fn_prefixes", PREFIXES_SQL)
def fn_prefixes(spark, sf):
    p = table(spark, sf, "pages").select("page_id", url_path().alias("p"))
    return rows.flat_map(p, strings.prefixes("p", "/"), "prefix", keep=["page_id"])


@recipe("fn_lines", f"SELECT doc_id, line_no, line FROM ({_LINES_SQL})")
def fn_lines(spark, sf):
    return doc_lines(spark, sf)


@recipe("fn_concat_length", """
SELECT c_custkey, concat_ws(', ', c_name, c_mktsegment) AS label,
       CAST(length(concat_ws(', ', c_name, c_mktsegment)) AS BIGINT) AS label_len
FROM customer
""")
def fn_concat_length(spark, sf):
    c = table(spark, sf, "customer").withColumn("label", strings.concat_sep(", ", "c_name", "c_mktsegment"))
    return c.select("c_custkey", "label", F.length("label").cast("bigint").alias("label_len"))


@recipe("fn_utf8", """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, CAST(length(text) AS BIGINT) AS n_chars,
       decode(encode(text)) = text AS round_trip
FROM documents
""")
def fn_utf8(spark, sf):
    d = table(spark, sf, "documents").withColumn("b", strings.utf8_encode("text"))
    return d.select("doc_id", F.length("b").cast("bigint").alias("n_bytes"),
                    F.length("text").cast("bigint").alias("n_chars"),
                    (strings.utf8_decode("b") == F.col("text")).alias("round_trip"))


@recipe("fn_reformat_ts", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM events
""")
def fn_reformat_ts(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"))
    return ev.select("event_id", dates.reformat("iso", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"))


@recipe("fn_date_month", """
SELECT o_orderkey, CAST(month(o_orderdate) AS BIGINT) AS month, CAST(o_orderdate AS DATE) > DATE '1998-08-02' AS after_cutoff
FROM orders
""")
def fn_date_month(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", " dd-MM-yyyy ").alias("d"))
    parsed = o.withColumn("d", dates.parse_dmy("d"))
    return parsed.select("o_orderkey", big(dates.month_of("d")).alias("month"),
                         (F.col("d") > F.lit("1998-08-02").cast("date")).alias("after_cutoff"))


@recipe("fn_log_product", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       round(ln(l_quantity) * ln(l_extendedprice), 6) + 0.0 AS score
FROM lineitem
""")
def fn_log_product(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", big("l_linenumber").alias("l_linenumber"),
                     rnd(numeric.log_product("l_quantity", "l_extendedprice"), 6).alias("score"))


@recipe("fn_cast", """
SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k,
       round(CAST(CAST(value AS VARCHAR) AS DOUBLE), 4) + 0.0 AS value
FROM events
""")
def fn_cast(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", numeric.to_int(F.regexp_extract("props", r"(\d+)", 1)).alias("k"),
                     rnd(numeric.to_double(F.col("value").cast("string"))).alias("value"))




@recipe("fn_tiers", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_quantity BETWEEN 10 AND 20 THEN 4 WHEN l_quantity BETWEEN 21 AND 30 THEN 3
            WHEN l_quantity BETWEEN 31 AND 40 THEN 2 WHEN l_quantity >= 41 THEN 1 ELSE 0 END AS tier
FROM lineitem
""")
def fn_tiers(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", big("l_linenumber").alias("l_linenumber"),
                     numeric.tiers("l_quantity", BATTLE_TIME_TIERS).cast("int").alias("tier"))


ARRAY_GAPS_SQL = """
WITH m AS (SELECT DISTINCT o_custkey, month(o_orderdate) AS m FROM orders),
g AS (SELECT o_custkey, m, m - coalesce(lag(m) OVER (PARTITION BY o_custkey ORDER BY m), 0) - 1 AS gap FROM m),
s AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_months, greatest(max(gap), 12 - max(m)) AS longest_gap
      FROM g GROUP BY o_custkey)
SELECT o_custkey, n_orders, n_months, CAST(longest_gap AS BIGINT) AS longest_gap
FROM s JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) USING (o_custkey)
"""


def month_sets(orders, key="o_custkey", date_col="o_orderdate"):
    """Per key: row count and the set of months seen, as a 12-bit mask --
    a bounded, combinable aggregate (no per-key list is built)."""
    bit = F.pow(F.lit(2), F.month(date_col)).cast("int")
    return orders.groupBy(key).agg(F.count(F.lit(1)).alias("n_orders"), F.bit_or(bit).alias("mask"))


def months_from_mask(mask_col="mask"):
    return F.filter(F.sequence(F.lit(1), F.lit(12)),
                    lambda m: F.col(mask_col).bitwiseAND(F.pow(F.lit(2), m).cast("int")) != 0)


@recipe("fn_array_gaps", ARRAY_GAPS_SQL)
def fn_array_gaps(spark, sf):
    sets_ = month_sets(table(spark, sf, "orders")).withColumn("months", months_from_mask())
    return sets_.select("o_custkey", "n_orders", F.size("months").cast("bigint").alias("n_months"),
                        coll.longest_gap("months").cast("bigint").alias("longest_gap"))


@recipe("fn_map_get", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       coalesce(CAST(json_extract(props, '$.z') AS BIGINT), 0) AS z
FROM events
""")
def fn_map_get(spark, sf):
    ev = table(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,bigint>"))
    return ev.select("event_id", coll.map_get("m", "k").alias("k"), coll.map_get("m", "z", 0).alias("z"))


@recipe("fn_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(to_json({'k': CAST(json_extract(props, '$.k') AS BIGINT)}) AS VARCHAR) AS json
FROM events
""")
def fn_json(spark, sf):
    from flumen.schemas import PROPS
    ev = table(spark, sf, "events").withColumn("p", coll.parse_json("props", PROPS))
    return ev.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("json"))


@recipe("udf_map", f"""
SELECT doc_id, line_no, lower(split_part(line, ' ', 1)) AS first_word FROM ({_LINES_SQL})
""")
def udf_map(spark, sf):
    first_word = udfs.series_map(udfs.first_word_lower, T.StringType())
    return doc_lines(spark, sf).select("doc_id", "line_no", first_word("line").alias("first_word"))


@recipe("udtf_flat_map", f"""
SELECT doc_id, line_no, line FROM ({_LINES_SQL}) WHERE trim(line) <> ''
""")
def udtf_flat_map(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return udfs.flat_map_batches(d, udfs.nonblank_lines, "doc_id long, line_no long, line string")


@recipe("udtf_keywords", """
WITH w AS (SELECT p_partkey AS id, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT id, CASE WHEN length(word) <= 5 THEN 'Short_Names' ELSE 'Long_Names' END AS tag, word FROM w WHERE word <> ''
UNION ALL SELECT id, 'Marked_Names', word FROM w WHERE starts_with(word, 's')
""")
def udtf_keywords(spark, sf):
    """A one-to-many function with keyword arguments over partitions of its table."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"), "p_brand")
    return udfs.table_function(parts, udfs.split_names(), "p_brand", cutoff_length=5, marker="s")
