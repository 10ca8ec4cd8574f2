"""Metric edge cases and cross-checks."""

import math

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from demandspark.operators import evaluate as EV
from demandspark.operators import monitor as MO
from demandspark.operators import tuning as TU


def _df(spark, y, yhat):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, yhat)], "y double, yhat double")


def test_performance_fixture(spark):
    d = _df(spark, [95, 160, 85, 125], [100, 150, 80, 120])
    r = MO.performance(d, "y", "yhat").first()
    assert r["mae"] == 6.25
    assert math.isclose(r["rmse"], math.sqrt(175 / 4), rel_tol=1e-12)
    assert r["total_predictions"] == 4 and r["error"] is None


def test_performance_empty_gives_error_row(spark):
    d = spark.createDataFrame([], "y double, yhat double")
    r = MO.performance(d, "y", "yhat").first()
    assert r["total_predictions"] == 0 and r["error"]


def test_mape_all_zero_actuals(spark):
    d = _df(spark, [0, 0, 0], [1, 2, 3])
    assert d.agg(EV.mape_expr("y", "yhat")).first()[0] == 0.0


def test_mape_masks_zeros(spark):
    d = _df(spark, [0, 100, 200], [5, 110, 180])
    assert math.isclose(d.agg(EV.mape_expr("y", "yhat")).first()[0], 100 * (0.1 + 0.1) / 2)


def test_r2_constant_actuals(spark):
    d = _df(spark, [3, 3, 3], [1, 2, 3])
    assert d.agg(EV.r2_expr("y", "yhat")).first()[0] is None
    assert d.agg(EV.r2_expr("y", "yhat", nonfinite_to_zero=True)).first()[0] == 0.0


def test_metrics_match_spark_ml(spark):
    from demandspark.plans import views as V

    d = V.linear_pred(V.demand(spark, "/root/testdata/sf0.001")).withColumn("y", F.col("rented_bike_count").cast("double"))
    m = EV.regression_metrics(d, "y", "yhat").first()
    for name, key in (("rmse", "rmse"), ("mae", "mae"), ("r2", "r2")):
        ev = RegressionEvaluator(labelCol="y", predictionCol="yhat", metricName=name).evaluate(d)
        assert math.isclose(m[key], ev, rel_tol=1e-9), name


def test_model_table_overfit(spark):
    rows = [("m", "train", 1.0, 1.5), ("m", "train", 2.0, 2.5), ("m", "test", 1.0, 2.0), ("m", "test", 3.0, 1.0)]
    p = spark.createDataFrame(rows, "model_name string, split string, y double, yhat double")
    r = EV.model_table(p).first()
    assert math.isclose(r["train_rmse"], 0.5) and math.isclose(r["test_rmse"], math.sqrt(2.5))
    assert math.isclose(r["overfit_score"], 0.5 - math.sqrt(2.5))


def test_regression_lines_match_builtin_with_nulls(spark):
    from demandspark.operators import profile as P

    rows = [(float(i), float(2 * i + (i % 3)), None if i % 7 == 0 else float(i % 5), 4.0) for i in range(60)]
    rows[5] = (None, 1.0, 2.0, 4.0)
    df = spark.createDataFrame(rows, "y double, a double, b double, c double")
    got = {r["column"]: r for r in P.regression_lines(df, "y", ["a", "b", "c"]).collect()}
    for c in ("a", "b", "c"):
        want = df.agg(F.regr_slope("y", c).alias("s"), F.regr_intercept("y", c).alias("i"),
                      F.regr_r2("y", c).alias("r")).first()
        for k, w in (("slope", want["s"]), ("intercept", want["i"]), ("r2", want["r"])):
            g = got[c][k]
            assert (g is None and w is None) or math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-12), (c, k, g, w)


def test_two_searches_side_by_side(spark):
    """RMSE, R2 and winner of two sweeps against numpy; equal searches go to the first; constant actuals have no R2."""
    y = np.arange(20.0) ** 1.5
    df = spark.createDataFrame([(float(i), float(v)) for i, v in enumerate(y)], "x double, y double")
    grid, ranges = TU.seeded_draws({"a": [1, 2, 3]}, 3), TU.uniform_draws({"a": (3.0, 5.0)}, 6)
    assert ranges == TU.uniform_draws({"a": (3.0, 5.0)}, 6) and all(3 <= d["a"] <= 5 for d in ranges)
    sweep = [TU.sweep_trials(df, "y", "m", d, lambda p: F.col("x") * float(p["a"])) for d in (grid, ranges)]
    r = TU.compare_methods(*sweep, "grid", "range").first()
    best = [min(((y - d["a"] * np.arange(20)) ** 2).mean() for d in draws) for draws in (grid, ranges)]
    assert abs(r["rmse_grid"] - best[0] ** 0.5) < 1e-9 and abs(r["rmse_range"] - best[1] ** 0.5) < 1e-9
    assert abs(r["r2_gain"] - (best[0] - best[1]) / y.var()) < 1e-9
    assert r["winner"] == ("range" if best[1] < best[0] else "grid") and r["trials_range"] == 6
    assert TU.compare_methods(sweep[0], sweep[0], "p", "q").first()["winner"] == "p"
    flat = TU.sweep_trials(df.withColumn("y", F.lit(1.0)), "y", "m", grid, lambda p: F.col("x") * float(p["a"]))
    assert {t["r2"] for t in flat.collect()} == {None}
