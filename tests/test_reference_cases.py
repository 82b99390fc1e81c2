"""The reference's literal cases (its unit tests, goldens and inline examples),
re-run on the library's operators."""

import math

import pytest
from pyspark.sql import functions as F

from flumen import schemas
from flumen.domains import bank, food, game, packages, weather
from flumen.functions import strings
from flumen.operators import aggregates as agg
from flumen.operators import joins, rows, sets, udfs


def test_weather_parse(spark):
    lines = spark.createDataFrame([("x,0.0,0.0,2/2/2021,1.0,2.0,0.1",)], "value string")
    got = weather.parse(lines).collect()
    assert [tuple(r) for r in got] == [("x", 0.0, 0.0, "2/2/2021", 1.0, 2.0, 0.1)]


def test_weather_units(spark):
    recs = spark.createDataFrame([("x", 1.0, 2.0), ("y", -3.0, -1.0)], "loc_id string, low_temp double, high_temp double")
    got = {r.loc_id: (r.low_temp, r.high_temp) for r in weather.convert_units(recs).collect()}
    assert got["x"] == pytest.approx((33.8, 35.6))
    assert got["y"] == pytest.approx((26.6, 30.2))


def test_weather_statistics(spark):
    recs = spark.createDataFrame(
        [("x", 33.8, 35.6, 0.1), ("x", 41.6, 65.3, 0.2), ("x", 45.3, 52.6, 0.2),
         ("y", 12.8, 23.6, 0.1), ("y", 26.6, 30.2, 0.3)],
        "loc_id string, low_temp double, high_temp double, precip double")
    got = {r.loc_id: (r.record_low, r.record_high, r.total_precip)
           for r in weather.compute_statistics(recs).collect()}
    assert got["x"] == pytest.approx((33.8, 65.3, 0.5))
    assert got["y"] == pytest.approx((12.8, 30.2, 0.4))


def test_weather_end_to_end(spark):
    lines = spark.createDataFrame([("x,31.4,-39.2,2/2/21,4.0,7.5,0.1",), ("x,31.4,-39.2,2/2/21,3.5,6.0,0.3",),
                                   ("y,33.4,-49.2,2/2/21,12.5,17.5,0.5",)], "value string")
    got = {r.loc_id: (r.record_low, r.record_high, r.total_precip)
           for r in weather.weather_stats(lines).collect()}
    assert got["x"] == pytest.approx((38.3, 45.5, 0.4))
    assert got["y"] == pytest.approx((54.5, 63.5, 0.5))
    js = weather.as_json(weather.weather_stats(lines)).collect()
    assert all(r.value.startswith('{"loc_id":') for r in js)


def test_mean_combiner(spark):
    df = spark.createDataFrame([(float(v),) for v in (15, 5, 7, 7, 9, 23, 13, 5)], "v double")
    assert agg.mean_or_nan(df, "v").first()["mean"] == 10.5
    assert math.isnan(agg.mean_or_nan(df.filter("v < 0"), "v").first()["mean"])
    mean = udfs.mean_udaf()
    assert df.agg(mean("v").alias("m")).first().m == 10.5
    keyed = df.withColumn("k", F.lit("all"))
    assert udfs.combine_mean(keyed, "k", "v", target_rows=3).first()["mean"] == pytest.approx(10.5)


def test_package_prefixes(spark):
    df = spark.createDataFrame([("com.example.appname.library.widgetname",)], "n string")
    got = df.select(strings.prefixes("n")).first()[0]
    assert got == ["com", "com.example", "com.example.appname", "com.example.appname.library",
                   "com.example.appname.library.widgetname"]
    # a leading separator gives the whole name only
    assert spark.createDataFrame([(".a.b",)], "n string").select(strings.prefixes("n")).first()[0] == [".a.b"]


def test_package_scoring_on_sources(spark):
    files = spark.createDataFrame([
        ("package com.ex.app;\nimport com.ex.lib;\n// TODO fix\n// FIXME x",),
        ("package com.ex.lib;\nimport com.ex.lib;\nimport com.other;",),
        ("no package line\n// TODO",),
    ], "content string")
    pop = {r.package: r.popularity for r in packages.popularity(packages.package_uses(files, "content")).collect()}
    assert pop == {"com": 3, "com.ex": 2, "com.ex.lib": 2, "com.other": 1}
    help_ = {r.package: r.help for r in packages.needs_help(files, "content").collect()}
    assert help_ == {"com": 2, "com.ex": 2, "com.ex.app": 2}
    score = {r.package: r.score for r in packages.composite_score(
        packages.popularity(packages.package_uses(files, "content")), packages.needs_help(files, "content")).collect()}
    assert set(score) == {"com", "com.ex"}
    assert score["com"] == pytest.approx(math.log(2) * math.log(3))


def test_text_between_rules(spark):
    df = spark.createDataFrame([("import  a.b ;",), ("import a.b",), ("import ;",), ("important foo;",)], "l string")
    got = [r[0] for r in df.select(strings.text_between("l", "import", ";")).collect()]
    assert got == ["a.b", None, "", "ant foo"]


def test_store_profit(spark):
    df = spark.createDataFrame([(8, 39, 66)], "pieces long, buy long, sell long")
    assert rows.with_profit(df, "sell", "buy", "pieces").first().profit == 216


def test_card_points(spark):
    cards = spark.createDataFrame([("CT28383", 500, 490, 101)],
                                  "customer_id string, max_limit long, spent long, payment_cleared long")
    assert bank.card_points(cards).first().points == 1
    at_limit = spark.createDataFrame([("C", 500, 500, 100)], "customer_id string, max_limit long, spent long, payment_cleared long")
    assert bank.card_points(at_limit).first().points == 3


def test_personal_loan(spark):
    months = [1, 5, 6, 7, 8, 9, 10, 11, 12]
    loans = spark.createDataFrame([("CT68554", "Personal Loan", f"25-{m:02d}-2018") for m in months],
                                  "customer_id string, category string, payment_date string")
    r = bank.personal_defaulters(loans).first()
    assert (r.missed, r.reason) == (3, "gap")
    few = spark.createDataFrame([("C", " Personal Loan ", "01-01-2018")], "customer_id string, category string, payment_date string")
    assert bank.personal_defaulters(few).first().missed == 11


def test_medical_loan(spark):
    rows_ = [("C", "Medical Loan", "26-01-2018", "30-01-2018")] * 3 + [("C", "Medical Loan", "26-01-2018", "20-01-2018")]
    loans = spark.createDataFrame(rows_, "customer_id string, category string, due_date string, payment_date string")
    assert bank.medical_defaulters(loans).first().missed == 3


def test_battle_points(spark):
    df = spark.createDataFrame([(20, 6, 1, "MP_100", "MP_113")], "t long, a long, b long, p string, q string")
    assert df.select(game.battle_points(F.col("t"), F.col("a"), F.col("b"), F.col("p"), F.col("q"))).first()[0] == 9


def test_food_cleaning(spark):
    lines = spark.createDataFrame([("Chow M?ein:,A&B%",)], "value string")
    r = food.clean(lines, ["dish", "shop", "new_col"]).first()
    assert (r.dish, r.shop, r.new_col) == ("chow mein:", "ab", "1")


def test_cogroup_shape(spark):
    dept = spark.createDataFrame([("149633CM", "Marco", "1-01-2019"), ("149633CM", "Marco", "2-01-2019"),
                                  ("503996WI", "Edouard", "1-01-2019")], "id string, name string, date string")
    loc = spark.createDataFrame([("149633CM", "9876843261", "New York"), ("149633CM", "9204232778", "New York"),
                                 ("212539MU", "9995440673", "Denver")], "id string, phone string, city string")
    g = {r.id: r for r in joins.cogroup({"dep_data": dept, "loc_data": loc}, "id").collect()}
    assert set(g) == {"149633CM", "503996WI", "212539MU"}
    assert len(g["149633CM"].dep_data) == 2 and len(g["149633CM"].loc_data) == 2
    assert g["503996WI"].loc_data == [] and g["212539MU"].dep_data == []
    sizes = {r.id: (r.n_dep_data, r.n_loc_data) for r in joins.cogroup_sizes({"dep_data": dept, "loc_data": loc}, "id").collect()}
    assert sizes == {"149633CM": (2, 2), "503996WI": (1, 0), "212539MU": (0, 1)}
    flat = joins.cogroup_flat({"dep_data": dept, "loc_data": loc}, "id")
    assert flat.count() == 6


def test_composite_regular_employees(spark):
    att = spark.createDataFrame([("Accounts", "Marco")] * 31 + [("Accounts", "Ayumi")] * 30,
                                "dept string, name string").withColumn("one", F.lit(1))
    out = agg.composite(att, ["dept", "name"], "one", 30, "%s, %s, %d, Regular employee").collect()
    assert [r.text for r in out] == ["Accounts, Marco, 31, Regular employee"]


def test_tagged_split_first_match(spark):
    names = spark.createDataFrame([("Itoe",), ("Kyle",), ("Alexandra",)], "name string")
    tagged = sets.tag_first_match(names, [("short", F.length("name") <= 4),
                                          ("has_a", F.col("name").contains("a")),
                                          ("long", F.length("name") > 4)])
    got = {r.name: r.tag for r in tagged.collect()}
    assert got == {"Itoe": "short", "Kyle": "short", "Alexandra": "has_a"}
    assert sets.output(tagged, "main").count() == 0


def test_typed_filter_rejects_text(spark):
    df = spark.createDataFrame([("1",), ("2",)], "v string")
    with pytest.raises(TypeError):
        rows.where_even(df, "v")
    ints = spark.createDataFrame([(i,) for i in range(1, 7)], "v long")
    assert [r.v for r in rows.where_even(ints, "v").collect()] == [2, 4, 6]


def test_schema_check(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y long")
    assert schemas.expect_schema(df, schemas.struct(("x", schemas.S))) is df
    with pytest.raises(schemas.SchemaMismatch):
        schemas.expect_schema(df, schemas.struct(("x", schemas.S), ("y", schemas.S)))
    with pytest.raises(schemas.SchemaMismatch):
        schemas.expect_schema(df, schemas.struct(("x", schemas.S)), exact=True)


def test_strict_json_lines(spark, tmp_path):
    from flumen.sources import files
    good = tmp_path / "good"
    good.mkdir()
    (good / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    assert sorted(r.k for r in files.json_lines(spark, str(good), schemas.PROPS).collect()) == [1, 2]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.json").write_text('{"k": 1}\n{"k": 2, "extra": 3}\n')
    with pytest.raises(Exception):
        files.json_lines(spark, str(bad), schemas.PROPS).collect()
    lenient = files.json_lines(spark, str(bad), schemas.PROPS, strict=False).collect()
    assert sorted(r.k for r in lenient) == [1, 2]
