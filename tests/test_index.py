"""The index rules against published values and the edges of every band."""

import math

import pytest
from pyspark.sql import functions as F

from hazegrid.functions import index as aqi


def sub(spark, scale, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("i", aqi.sub_index("v", scale).alias("x")).orderBy("i").collect()
    return [r["x"] for r in rows]


def test_published_values(spark):
    assert sub(spark, aqi.PM2_5, [12.05, 35.45, 12.0, 12.1]) == [50, 100, 50, 51]
    assert sub(spark, aqi.PM2_5, [55.45, 150.45]) == [150, 200]
    assert sub(spark, aqi.PM10, [54.5, 154.5, 254.5, 604.0, 1262.51]) == [50, 100, 150, 500, 1158]
    assert sub(spark, aqi.O3, [107 / 1.96]) == [50]


@pytest.mark.parametrize("name", list(aqi.SCALES))
def test_both_ends_of_every_band(spark, name):
    scale = aqi.SCALES[name]
    step = 10.0 ** -scale.decimals
    lows = sub(spark, scale, [r[0] + step / 1000 for r in scale.rows])
    highs = sub(spark, scale, [r[1] + step / 1000 for r in scale.rows])
    assert lows == [r[2] for r in scale.rows]
    assert highs == [r[3] for r in scale.rows]
    # a value between two bands belongs to the lower one
    between = sub(spark, scale, [r[1] + step * 0.9 for r in scale.rows[:-1]])
    assert between == [r[3] for r in scale.rows[:-1]]


def test_missing_negative_and_beyond(spark):
    assert sub(spark, aqi.PM2_5, [None, math.nan, -3.0]) == [None, None, 0.0]
    low, high, i_low, i_high = aqi.O3.rows[-1]
    slope = (i_high - i_low) / (high - low)
    assert sub(spark, aqi.O3, [300.0]) == [round(slope * (300 - low) + i_low)]


def test_overall_and_dominant(spark):
    rows = [(34.72, 113.19, 180.07, 69.22), (None, None, None, None), (12.0, 54.0, None, None)]
    df = spark.createDataFrame(rows, "pm2_5 double, pm10 double, co double, o3 double")
    subs = aqi.sub_indices(pm2_5="pm2_5", pm10="pm10", co="co", o3="o3")
    named = df.select(*[c.alias(p) for p, c in subs.items()])
    found = named.select(aqi.overall(subs), aqi.dominant({p: p for p in subs})).collect()
    assert [tuple(r) for r in found] == [(99.0, "pm2_5"), (None, None), (50.0, "pm2_5")]


def test_unit_switches(spark):
    df = spark.createDataFrame([(4.4, 54.0)], "co double, o3 double")
    plain = aqi.sub_indices(co="co", o3="o3", co_in_ugm3=False, o3_in_ugm3=False)
    assert tuple(df.select(*plain.values()).first()) == (50.0, 50.0)


def test_categories(spark):
    values = [100.4, 150.5, None, -1.0, 50.0, 51.0, 300.6]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("i", aqi.category("v"), aqi.colour("v")).orderBy("i").collect()
    assert [r[1] for r in rows] == [
        "Moderate", "Unhealthy for Sensitive Groups", "Unknown", "Hazardous", "Good",
        "Moderate", "Hazardous"]
    assert rows[0][2] == "#ffff00" and rows[2][2] == "#888888"


def test_sql_functions(spark):
    aqi.register_sql(spark)
    row = spark.sql("select pm2_5_sub_index(12.05), o3_sub_index(107 / 1.96), "
                    "aqi_category(100.4), aqi_colour(20.0)").first()
    assert tuple(row) == (50.0, 50.0, "Moderate", "#00e400")


def test_index_is_the_largest_part(spark):
    df = spark.range(2000).select(
        *[(F.rand(i) * top).alias(p) for i, (p, top) in enumerate(
            {"pm2_5": 600, "pm10": 700, "co": 60000, "o3": 500}.items())])
    subs = aqi.sub_indices(pm2_5="pm2_5", pm10="pm10", co="co", o3="o3")
    named = df.select(*[c.alias(p) for p, c in subs.items()]).cache()
    each = named.select("*", aqi.overall(subs).alias("top"),
                        aqi.dominant({p: p for p in subs}).alias("who"))
    assert each.filter(" or ".join(f"{p} > top" for p in subs)).count() == 0
    chosen = "case who " + " ".join(f"when '{p}' then {p}" for p in subs) + " end"
    assert each.filter(f"not ({chosen} <=> top)").count() == 0


def test_labels_and_seasons_are_the_published_ones(spark):
    from hazegrid.functions.features import calendar
    from hazegrid.functions.labels import feature_label
    want = {"aqi": "AQI now", "aqi_lag_168h": "AQI 1 week ago", "pm2_5": "PM2.5",
            "aqi_vs_7d": "vs weekly average", "sqrt_hours_ahead": "hours ahead (sqrt)",
            "aqi_x_hours": "AQI now x lead time", "some_new_input": "some new input"}
    df = spark.createDataFrame([(k,) for k in want], "name string")
    got = {r[0]: r[1] for r in df.select("name", feature_label("name")).collect()}
    assert got == want
    months = spark.range(1, 13).selectExpr("make_timestamp(2021, id, 15, 0, 0, 0) as ts")
    seasons = [n for n in calendar() if n.startswith("season_")]
    rows = months.select(*[calendar()[n].alias(n) for n in seasons]).collect()
    names = [next(n for n in seasons if r[n]) for r in rows]
    assert names == ["season_winter"] * 2 + ["season_summer"] * 3 + ["season_monsoon"] * 4 \
        + ["season_post_monsoon"] * 2 + ["season_winter"]
