"""Library functions on small literal inputs: edge cases the table recipes
do not reach."""

import datetime as dt

from pyspark.sql import functions as F

from flumen import schemas
from flumen.functions import collections as coll
from flumen.functions import dates, numeric, strings
from flumen.operators import aggregates as agg
from flumen.operators import joins, rows, sets, skew


def test_global_count_has_no_default_row(spark):
    df = spark.range(5)
    assert agg.global_count(df.filter("id > 10")).count() == 0
    assert agg.global_count(df).first()["count"] == 5


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "k string, v long")
    assert [r.k for r in agg.top_n(df, 3, "v", "k").collect()] == ["c", "a", "b"]


def test_where_limit_is_deterministic(spark):
    df = spark.range(100).withColumn("even", F.col("id") % 2 == 0)
    got = [r.id for r in rows.where_limit(df, F.col("even"), 3, [F.col("id").desc()]).collect()]
    assert got == [98, 96, 94]


def test_tag_without_rules_is_main(spark):
    df = spark.range(3)
    assert {r.tag for r in sets.tag_first_match(df, []).collect()} == {"main"}


def test_csv_to_struct_positions(spark):
    df = spark.createDataFrame([("a,b,c,d",), ("x",)], "line string")
    out = {r.f1: r.f3 for r in rows.csv_to_struct(df, "line", ["f1", "f2", "f3"]).collect()}
    assert out == {"a": "c", "x": None}


def test_flat_map_with_position(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "")], "id long, text string")
    out = sorted(tuple(r) for r in rows.flat_map(df.drop("text"), strings.lines(F.lit("p\nq")), "line",
                                                 position="pos").collect())
    assert out == [(1, 0, "p"), (1, 1, "q"), (2, 0, "p"), (2, 1, "q")]
    empty = df.select("id", F.filter(strings.lines("text"), lambda l: l != "").alias("ls"))
    assert rows.flat_map(empty, F.col("ls"), "line", keep=["id"]).filter("id = 2").count() == 0


def test_drop_sensitive_sorts_columns(spark):
    users = spark.createDataFrame([], schemas.USERS)
    assert rows.drop_sensitive(users).columns == ["age_bracket", "id", "opted_into_marketing"]


def test_iso_time_is_truncated_to_seconds(spark):
    df = spark.createDataFrame([("2019-06-19T16:06:45.999999Z",)], "t string")
    assert df.select(dates.iso_to_seconds("t")).first()[0] == dt.datetime(2019, 6, 19, 16, 6, 45)


def test_longest_gap_edges(spark):
    df = spark.createDataFrame([([],), (list(range(1, 13)),), ([12],), ([3, 3, 9],)], "m array<int>")
    assert [r[0] for r in df.select(coll.longest_gap("m")).collect()] == [None, 0, 11, 5]


def test_map_get_default(spark):
    df = spark.createDataFrame([({"k": 1},)], "m map<string,bigint>")
    r = df.select(coll.map_get("m", "k").alias("k"), coll.map_get("m", "z", 0).alias("z")).first()
    assert (r.k, r.z) == (1, 0)


def test_strip_removes_the_whole_blank_set(spark):
    df = spark.createDataFrame([("\t x \r\n",)], "s string")
    r = df.select(strings.strip("s").alias("a"), F.trim("s").alias("b")).first()
    assert r.a == "x" and r.b != "x"


def test_tiers_and_steps(spark):
    df = spark.createDataFrame([(9,), (10,), (20,), (21,), (40,), (41,)], "t long")
    got = [r[0] for r in df.select(numeric.tiers("t", [(10, 20, 4), (21, 30, 3), (31, 40, 2), (41, None, 1)])).collect()]
    assert got == [0, 4, 4, 3, 2, 1]
    got = [r[0] for r in df.select(numeric.steps(F.col("t") - 10, [(6, 3), (3, 2)], 1)).collect()]
    assert got == [1, 1, 3, 3, 3, 3]


def test_cogroup_flat_multi_column_items_are_json(spark):
    a = spark.createDataFrame([(1, "x", 2)], "k long, s string, n long")
    b = spark.createDataFrame([(1, "y")], "k long, t string")
    items = {r.tag: r.item for r in joins.cogroup_flat({"a": a, "b": b}, "k").collect()}
    assert items == {"a": '{"s":"x","n":2}', "b": "y"}


def test_operators_on_empty_input(spark):
    from flumen.operators import panes, udfs, windows
    empty = spark.createDataFrame([], "id long, k long, ts timestamp, v double")
    assert windows.sessions(empty, "ts", 600, "k").count() == 0
    assert panes.count_panes(empty, "k", "id", "v", 3).count() == 0
    assert panes.segment_panes(empty, "k", "ts", "id", "v", n=3, delay_s=60).count() == 0
    assert panes.first_pane(empty, "k", "ts", "v", 60).count() == 0
    assert udfs.combine_mean(empty, "k", "v").count() == 0
    assert skew.spread_by_key(empty, "k", by="id").count() == 0
    assert joins.cogroup_sizes({"a": empty, "b": empty}, "k").count() == 0
    assert joins.cogroup({"a": empty.select("k", "v"), "b": empty.select("k", "id")}, "k").count() == 0


def test_nulls_in_keys_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, None), (1, 3.0)], "k long, v double")
    assert {r.k: r.mean for r in agg.mean_per_key(df, "k", "v").collect()} == {None: 1.5, 1: 3.0}


def test_entry_without_the_corpus_operators():
    """A module that they need is absent: the other queries stay."""
    import subprocess
    import sys

    from tests.conftest import ROOT
    code = ("import sys\n"
            "class Absent:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('ahocorasick', 'corpus_pipeline'):\n"
            "            raise ImportError(name)\n"
            "sys.meta_path.insert(0, Absent())\n"
            "import __spark_entry__ as E\n"
            "assert len(E.queries()) > 100 and not any(k.startswith('op1_') for k in E.queries())\n"
            "assert set(E.oracle_sql()) <= set(E.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
