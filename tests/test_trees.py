"""Grown trees against Spark ML's learners, brute force and themselves in other block sizes."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.operators import models as M
from demandspark.operators import trees as TR

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 20, 3000), rng.normal(size=3000), rng.integers(0, 2, 3000)]).astype(float)
    y = np.round(50 * np.sin(x[:, 0]) + 20 * x[:, 1] * x[:, 2] + rng.normal(size=3000))
    rows = [(int(i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"id long, a double, b double, c double, {S.LABEL} double").persist()


def _mse(model, df):
    return model.transform(df).select(F.avg((F.col(S.LABEL) - F.col("prediction")) ** 2)).first()[0]


def _theirs(est, df):
    v = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    fitted = est.copy({est.labelCol: S.LABEL}).fit(v)
    return fitted, fitted.transform(v).select(F.avg((F.col(S.LABEL) - F.col("prediction")) ** 2)).first()[0]


@pytest.mark.parametrize("local", [20_000, 40])
@pytest.mark.parametrize("kind, params", [(DecisionTreeRegressor, {"maxDepth": 9}), (GBTRegressor, {"maxIter": 6, "maxDepth": 4, "stepSize": 0.1})])
def test_equals_spark_ml(data, monkeypatch, kind, params, local):
    """The same trees, whether nodes are split from sums over all rows or finished in tasks."""
    est = kind(seed=1, **params)
    monkeypatch.setattr(TR, "LOCAL", local)
    monkeypatch.setattr(TR, "SLOTS", 5)
    monkeypatch.setattr(TR, "REFRESH", 2)
    ours = M.train_all(data, {"m": (est, False)}, features=NAMES)["m"]
    assert isinstance(ours, TR.TreeModel)
    theirs, want = _theirs(est, data)
    assert _mse(ours, data) == pytest.approx(want, rel=1e-9)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-6)


@pytest.mark.parametrize("local", [20_000, 200])
def test_forest_is_as_good_as_spark_mls(data, monkeypatch, local):
    monkeypatch.setattr(TR, "LOCAL", local)
    est = RandomForestRegressor(numTrees=20, maxDepth=8, featureSubsetStrategy="all", seed=1)
    train, test = data.where("id % 3 <> 0"), data.where("id % 3 = 0")
    ours = M.train_all(train, {"m": (est, False)}, features=NAMES)["m"]
    theirs, _ = _theirs(est, train)
    want = theirs.transform(VectorAssembler(inputCols=NAMES, outputCol="features").transform(test))
    want = want.select(F.avg((F.col(S.LABEL) - F.col("prediction")) ** 2)).first()[0]
    assert _mse(ours, test) == pytest.approx(want, rel=0.05)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.03)
    assert len(ours.trees) == 20 and len({t.value.tobytes() for _, t in ours.trees}) == 20


def test_no_task_gets_a_large_node(data, monkeypatch):
    """Rows that a task finishes at once stay bounded, and are fewer the smaller the bound."""
    monkeypatch.setattr(TR, "LOCAL", 100)
    b = TR.Binned(data, NAMES, S.LABEL)
    try:
        g = {0: TR.Growing(3, 0.0, b.n)}
        TR._grow_top(b.blocks, b.starts, g, 9, 1, TR.LOCAL, lambda x, t: np.ones(len(x.y), int), lambda x: x.y)
    finally:
        b.close()
    assert max(n for n, f, d in zip(g[0].n, g[0].feature, g[0].depth) if f < 0 and d < 9) <= 100


def test_odd_rows(spark, data):
    est = {"m": (DecisionTreeRegressor(maxDepth=3), False)}
    with pytest.raises(Exception, match="impute or reject"):
        M.train_all(data.withColumn("a", F.when(F.col("id") != 5, F.col("a"))), est, features=NAMES)
    with pytest.raises(ValueError, match="no rows"):
        M.train_all(data.limit(0), est, features=NAMES)
    twice = data.where("id = 3").unionByName(data.where("id = 3"))
    one = M.train_all(twice, est, features=NAMES)["m"]
    assert _mse(one, twice) == 0 and not one.featureImportances.toArray().any()


def test_thresholds():
    assert TR.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert TR.thresholds(np.array([7.0, 7.0]), 32).tolist() == []
    many = TR.thresholds(np.arange(1000.0), 4)
    assert len(many) == 3 and np.allclose(many, [250, 500, 750], atol=2)
