"""NULL, NaN and infinite values in statistics; rows in = rows out of splits; drift rules and empty sides."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import cleaning as CL
from demandspark.operators import drift as DR
from demandspark.operators import models as M
from demandspark.operators import profile as P
from demandspark.operators import scaling as SC
from demandspark.operators import split as SP

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        a, b = float(rng.normal()), float(rng.normal())
        rows.append((i, None if i % 7 == 0 else NAN if i % 11 == 0 else INF if i % 13 == 0 else a, None if i % 5 == 0 else a + b))
    return spark.createDataFrame(rows, "id long, x double, y double")


def finite(values):
    return [v for v in values if v is not None and math.isfinite(v)]


def test_correlation_over_pairs_where_both_are_finite(odd):
    got = {(r.x, r.y): r["corr"] for r in P.correlation(odd, ["x", "y"]).collect()}
    both = [(r.x, r.y) for r in odd.collect() if len(finite([r.x, r.y])) == 2]
    assert got["x", "y"] == pytest.approx(np.corrcoef(*zip(*both, strict=True))[0, 1], abs=1e-12)


def test_histogram_ignores_what_is_not_finite(odd):
    counts = {r.bin: r["count"] for r in P.histogram(odd, ["x"], 10).collect()}
    values = finite([r.x for r in odd.collect()])
    assert counts == {i: n for i, n in enumerate(np.histogram(values, 10)[0]) if n}


def test_impute_and_scale(odd):
    values = finite([r.x for r in odd.collect()])
    got = CL.mean_impute(odd.where("x is null or isnan(x)"), ["y"]).where("y is null").count()
    assert got == 0
    filled = CL.mean_impute(odd, ["x"]).where("x is null or isnan(x)").count()
    assert filled == 0
    scaled = finite([r.x for r in SC.standard_scale(odd, ["x"]).collect()])
    assert np.mean(scaled) == pytest.approx(0, abs=1e-9) and np.std(scaled) == pytest.approx(1, abs=1e-9) and len(scaled) == len(values)


@pytest.mark.parametrize("target", ["x", "y"])
def test_splits_keep_every_row(odd, target):
    for out in (SP.stratified(odd, "id", target), SP.holdout(odd, "id", target)):
        assert out.count() == 300 and out.where("split is null").count() == 0
        assert out.select("id").distinct().count() == 300
    none = SP.stratified(odd, "id", target).where(f"{target} is null").groupBy("split").count().collect()
    assert {r.split for r in none} == {"train", "val", "test"}


def test_split_moves_no_row(odd):
    plan = SP.stratified(odd, "id", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_selection_equals_ranking(spark):
    df = spark.range(1, 5001).select((F.col("id") * F.col("id") % 7919 * 10 + F.col("id") % 3).alias("k")).distinct()
    keys = sorted(r.k for r in df.collect())
    n = len(keys)
    folds = {r.k: r.fold for r in SP.kfold(df, "k", 7).collect()}
    assert all(folds[k] == i * 7 // n for i, k in enumerate(keys))
    parts = {r.k: r.split for r in SP.ordered(df, "k", 0.3).collect()}
    assert all((parts[k] == "train") == (i < n * 7 // 10) for i, k in enumerate(keys))


def test_drift_rule_does_not_depend_on_size(spark):
    def verdict(n, method):
        ref = spark.range(n).select((F.col("id") / n).alias("v"))
        cur = spark.range(n).select((F.col("id") / n + 0.02).alias("v"))
        return DR.drift_table(ref, cur, ["v"], [], method=method).first().drifted

    assert verdict(1000, "magnitude") == verdict(1001, "magnitude") is False
    assert verdict(400, "p_value") == verdict(1001, "p_value") is False


def test_drift_against_nothing_gives_nulls(spark):
    ref = spark.range(50).select(F.col("id").cast("double").alias("v"), F.col("id").cast("string").alias("c"))
    for cur in (ref.limit(0), ref.select(F.lit(None).cast("double").alias("v"), F.lit(None).cast("string").alias("c"))):
        rows = {r.column: r for r in DR.drift_table(ref, cur, ["v"], ["c"]).collect()}
        assert rows["v"].statistic is None and not rows["v"].drifted and not rows["c"].drifted
        assert DR.drift_summary(DR.drift_table(ref, cur, ["v"], ["c"])).first().drifted_columns == 0


def test_draws_are_without_replacement():
    for grid in (M.GBT_GRID, M.RF_GRID, M.NET_GRID):
        draws = M.grid_draws(grid, 10)
        assert len(draws) == 10 and len({tuple(sorted(d.items())) for d in draws}) == 10
    assert len(M.grid_draws(M.RF_GRID, 1000)) == 12
    assert len(M.space_draws(M.GBT_SPACE, 20)) == 20


def small(spark, n=200):
    from demandspark import schema as S
    from demandspark.functions.features import feature_recipe
    from demandspark.plans import views as V

    return feature_recipe(V.demand(spark, "/root/testdata/sf0.001")).where(f"obs_id % 5 = 0").select("obs_id", S.LABEL, *S.FEATURES)


def test_searches_over_tree_spaces(spark):
    """The published spaces, with budgets cut for the test alone."""
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    rows = SP.kfold(small(spark), "obs_id", 2).persist()
    draws = [{**d, "maxIter": 2, "maxDepth": 3} for d in M.grid_draws(M.GBT_GRID, 2)]
    model, best, trials = M.random_search(rows, "fold", draws, GBTRegressor(seed=1), folds=2)
    assert best in draws and trials.count() == 2 and model.stages
    draws = [{**d, "numTrees": 2, "maxDepth": 3} for d in M.grid_draws(M.RF_GRID, 2)]
    best, trials = M.continuous_search(rows.where("fold = 0"), rows.where("fold = 1"), draws, RandomForestRegressor(seed=1))
    assert best in draws and trials.count() == 2
    rows.unpersist()


def test_a_search_whose_trials_all_fail_raises(spark):
    rows = small(spark)
    with pytest.raises(Exception, match="maxDepth|features"):
        M.continuous_search(rows, rows, [{"maxDepth": 99}, {"maxDepth": 98}])
