"""Edge rows of the feature recipe (bins, flags, dates, rounding)."""

import math

import pytest
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import features as FE
from demandspark.functions import scalar as X


def _one(spark, col_type, values, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {col_type}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_hour_bins(spark):
    got = _one(spark, "int", [0, 6, 7, 12, 13, 18, 19, 23, 25],
               lambda c: X.cut(c, S.HOUR_EDGES, S.TIME_OF_DAY_LABELS))
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", None]


def test_temperature_bins(spark):
    got = _one(spark, "double", [-1.0, 0.0, 0.1, 10.0, 10.1, 20.0, 20.1, None, float("nan")],
               lambda c: X.cut(c, S.TEMP_EDGES, S.TEMP_FEEL_LABELS))
    assert got == ["Very_Cold", "Very_Cold", "Cold", "Cold", "Mild", "Mild", "Warm", None, None]


def test_weekday_and_dates(spark):
    got = _one(spark, "string", ["04/12/2017", "09/12/2017", "1/2/2017", "2017-12-01"],
               lambda c: F.struct(X.parse_date(c).alias("d"), X.day_of_week(X.parse_date(c)).alias("w"),
                                  X.day_name(X.parse_date(c)).alias("n")))
    assert got[0]["w"] == 0 and got[0]["n"] == "Monday"
    assert got[1]["w"] == 5 and got[1]["n"] == "Saturday"
    assert str(got[2]["d"]) == "2017-02-01"
    assert got[3]["d"] is None  # tolerant parse rejects ISO text


def test_strict_date_raises(spark):
    df = spark.createDataFrame([("2017-12-01",)], "x string")
    with pytest.raises(Exception):
        df.select(X.parse_date("x", strict=True)).collect()


def test_extreme_weather_thresholds(spark):
    rows = [(5.0, 0.0, 0.0), (5.1, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 5.0), (0.0, 1.1, 0.0),
            (0.0, 0.0, float("nan")), (0.0, 0.0, float("inf"))]
    df = spark.createDataFrame(rows, "rainfall_mm double, snowfall_cm double, wind_speed double")
    df = df.withColumns({"holiday": F.lit("x"), "functioning_day": F.lit("Yes"), "season": F.lit("Winter")})
    got = [r[0] for r in df.select(FE.flag_columns()["extreme_weather"]).collect()]
    assert got == [0, 1, 0, 0, 1, 0, 1]


def test_clip_round_half_even(spark):
    got = _one(spark, "double", [-3.0, 2.5, 3.5, 0.4], X.clip_round)
    assert got == [0, 2, 4, 0]


def test_round_half_away_matches_duckdb(spark):
    import duckdb

    vals = [2.675, -2.675, 0.125, -0.125, 1.0000000005, 123456.123456789012, 1e20, -1e-12, 0.0]
    got = _one(spark, "double", vals, lambda c: X.round_half_away(c, 9))
    want = [duckdb.sql(f"SELECT round(CAST({v!r} AS DOUBLE), 9)").fetchall()[0][0] for v in vals]
    assert got == want


def test_recipe_invariants(spark):
    from demandspark.plans import views as V

    f = FE.feature_recipe(V.demand(spark, "/root/testdata/sf0.001"))
    sel = FE.features(f)
    assert sel.columns == S.FEATURES + [S.LABEL]
    assert len(S.FEATURES) == 40
    r = f.select(
        F.max(F.abs(F.col("hour_sin") ** 2 + F.col("hour_cos") ** 2 - 1)).alias("e"),
        F.min(sum(F.col(c) for c in S.ONE_HOT_FEATURES[:4])).alias("tod_min"),
        F.max(sum(F.col(c) for c in S.ONE_HOT_FEATURES[:4])).alias("tod_max"),
        F.min(sum(F.col(c) for c in S.ONE_HOT_FEATURES[4:])).alias("tf_min"),
    ).first()
    assert r["e"] < 1e-12 and r["tod_min"] == 1 and r["tod_max"] == 1 and r["tf_min"] == 1


def test_pad_missing_defaults(spark):
    df = spark.createDataFrame([(1,)], "hour int")
    out = FE.pad_missing(df, expected=["hour", "is_weekend"])
    row = out.first()
    assert row["time_of_day"] == "Morning" and row["temp_feel"] == "Mild" and row["is_weekend"] == 0
    assert math.isclose(1.0, 1.0)
