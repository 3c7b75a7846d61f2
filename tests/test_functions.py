import datetime as dt

from pyspark.sql import functions as F

from layerkit.functions.calendar import date_dimension
from layerkit.functions.geo import haversine_m, parse_wkt_point, wkt_point
from layerkit.functions.text import prompt_build, sentiment_tag
from layerkit.operators.policy import apply_mask, apply_row_policy, protected_view

D = dt.date


def test_sentiment_cases(spark):
    df = spark.createDataFrame([("Great bread",), ("excellent but bad service",), ("nice badge",), ("fine",), (None,)],
                               "t string")
    got = [r.s for r in df.select(sentiment_tag("t").alias("s")).collect()]
    assert got == ["positive", "negative", "negative", "neutral", None]


def test_prompt_contains_text(spark):
    r = spark.createDataFrame([("four lamps by Friday",)], "t string").select(prompt_build("t").alias("p")).first()
    assert r.p.endswith("Message:\nfour lamps by Friday")
    assert spark.range(1).select(prompt_build(F.lit("x"), "Say: ").alias("p")).first().p == "Say: x"


def test_date_dimension_2023_2024(spark):
    dim = date_dimension(spark, D(2023, 1, 1), 731)
    assert dim.count() == 731
    hol = {r.day for r in dim.filter("holiday_flg").filter(F.year("day") == 2023).collect()}
    assert hol == {D(2023, 1, 1), D(2023, 1, 2), D(2023, 1, 16), D(2023, 2, 20), D(2023, 5, 29), D(2023, 6, 19), D(2023, 7, 4),
                   D(2023, 9, 4), D(2023, 10, 9), D(2023, 11, 10), D(2023, 11, 11), D(2023, 11, 23), D(2023, 12, 25)}
    assert dim.filter("day between '2023-07-10' and '2023-07-14' and holiday_flg").count() == 0
    # 2022-01-01 is a Saturday: observed on Friday 2021-12-31
    assert date_dimension(spark, D(2021, 12, 31), 1).first().holiday_flg


def test_geo_point_and_distance(spark):
    df = spark.createDataFrame([(-84.19, 39.76), (-84.19, 40.76)], "lon double, lat double")
    df = df.select(wkt_point("lon", "lat").alias("w"))
    lon, lat = parse_wkt_point(F.col("w"))
    out = df.select("w", haversine_m(lon, lat, -84.19, 39.76).alias("m")).collect()
    assert out[0].w == "Point(-84.19 39.76)" and out[0].m == 0.0
    assert abs(out[1].m - 111195) < 5          # one degree of latitude
    bad = spark.createDataFrame([("nonsense",)], "w string").select(*parse_wkt_point(F.col("w"))).first()
    assert bad[0] is None


EMP = [(7, "Mona", "Harbour 12", "Lighting"), (21, "Teo", "Mill Lane 3", "Tools"), (35, "Ilse", "Quay 77", "Tools"),
       (49, "Rafi", "North Gate 1", "Garden"), (63, "Uma", "Old Road 8", "Lighting"), (77, "Per", "Hill 40", None)]
RULES = {"PLATFORM": None, "LIGHT_TEAM": ["Lighting"], "YARD_TEAM": ["Tools", "Garden"]}


def test_policies(spark):
    emp = spark.createDataFrame(EMP, "id int, name string, home_address string, department string")
    view = lambda roles: protected_view(emp, roles, row_rules=("department", RULES),
                                        masks={"home_address": {"PLATFORM"}})
    everyone = view({"PLATFORM"}).collect()
    assert len(everyone) == 6 and all(r.home_address != "***" for r in everyone)
    light = view({"LIGHT_TEAM"}).collect()
    assert sorted(r.id for r in light) == [7, 63] and {r.home_address for r in light} == {"***"}
    assert view({"YARD_TEAM"}).count() == 3 and view({"YARD_TEAM", "LIGHT_TEAM"}).count() == 5
    assert view({"VISITOR"}).count() == 0
    assert apply_row_policy(emp, "department", RULES, set()).count() == 0
    assert apply_mask(emp, "name", {"X"}, {"Y"}).filter("name = '***'").count() == 6


def test_row_policy_as_rules_table(spark):
    from layerkit.operators.policy import apply_row_policy_table
    emp = spark.createDataFrame(EMP, "id int, name string, home_address string, department string")
    rules = spark.createDataFrame([("PLATFORM", None), ("LIGHT_TEAM", "Lighting"), ("YARD_TEAM", "Tools"),
                                   ("YARD_TEAM", "Garden")], "role string, value string")
    assert apply_row_policy_table(emp, "department", rules, {"PLATFORM"}).count() == 6
    assert sorted(r.id for r in apply_row_policy_table(emp, "department", rules, {"YARD_TEAM"}).collect()) == [21, 35, 49]
    assert apply_row_policy_table(emp, "department", rules, {"OTHER"}).count() == 0


def test_is_holiday_country(spark):
    import pytest
    from layerkit.functions.calendar import is_holiday
    df = spark.createDataFrame([(D(2023, 7, 4),), (D(2023, 7, 5),)], "d date")
    assert [r.h for r in df.select(is_holiday("d", "US").alias("h")).collect()] == [True, False]
    with pytest.raises(ValueError):
        is_holiday("d", "FR")


def test_distance_of_antipodes_is_a_number(spark):
    import random
    rng = random.Random(5)
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(4000)]
    df = spark.createDataFrame([(a, b, a + 180 if a < 0 else a - 180, -b) for a, b in points], "a double, b double, c double, d double")
    far = df.select(haversine_m("a", "b", "c", "d").alias("m"))
    assert far.filter("isnan(m) or m < 20015000 or m > 20015200").count() == 0


def test_date_dimension_of_nothing_is_empty(spark):
    from layerkit.functions.calendar import date_dimension_for
    assert date_dimension_for(spark.createDataFrame([], "d date"), "d").count() == 0
    assert date_dimension_for(spark.createDataFrame([(None,)], "d date"), "d").count() == 0
