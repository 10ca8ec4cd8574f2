"""Linear models from moments: against Spark ML, closed forms, optimality conditions and direct errors."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from demandspark.operators import linear as LI
from demandspark.operators import models as M

NAMES = ["a", "b", "c", "d", "e", "k"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(800, 5)) * [1, 10, 0.1, 1, 1] + [1000, 5, 0, 0, 0]
    x[:, 4] = x[:, 3] + 0.05 * rng.normal(size=800)  # nearly one column
    x = np.column_stack([x, np.full(800, 3.5)])  # a constant
    y = x @ [2.0, -1.0, 30.0, 4.0, 0.0, 1.0] + rng.normal(size=800)
    rows = [(int(i), int(i % 4), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, fold int, " + ", ".join(f"{n} double" for n in NAMES) + ", y double").persist(), x, y


def test_moments_add_up(data):
    df, x, y = data
    folds = LI.fold_moments(df, NAMES, "y", "fold")
    every = LI.total(folds)
    z = np.column_stack([x, y])
    assert every.n == 800 and np.allclose(every.mean, z.mean(0), rtol=1e-12)
    assert np.allclose(every.centred, (z - z.mean(0)).T @ (z - z.mean(0)), rtol=1e-9, atol=1e-8)
    part = every - folds[2]
    own = z[np.arange(800) % 4 != 2]
    assert part.n == 600 and np.allclose(part.centred, (own - own.mean(0)).T @ (own - own.mean(0)), rtol=1e-9, atol=1e-8)


def test_ridge_equals_the_closed_form_through_the_pipeline(spark, data, tmp_path):
    df, x, y = data
    fitted = LI.fit(LI.total(LI.fold_moments(df, NAMES, "y")), LI.LinearSpec("ridge", 25.0), NAMES)
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)  # population deviations
    w = np.linalg.solve(z.T @ z + 25.0 * np.eye(6), z.T @ (y - y.mean()))
    assert np.allclose(fitted.scaled, w, atol=1e-9)
    model = M.load_model(M.save_model(fitted.pipeline(), str(tmp_path / "m")))
    got = np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])
    assert np.allclose(got, y.mean() + z @ w, atol=1e-9)
    assert fitted.mse(LI.total(LI.fold_moments(df, NAMES, "y"))) == pytest.approx(np.mean((y - got) ** 2), rel=1e-9)


@pytest.mark.parametrize("alpha, l1_ratio", [(0.0, 0.0), (0.3, 1.0), (0.05, 1.0), (1.0, 0.5)])
def test_equals_spark_ml(data, alpha, l1_ratio):
    df, x, y = data
    spec = LI.LinearSpec("net", alpha, l1_ratio) if alpha else LI.LinearSpec("ols")
    ours = LI.fit(LI.total(LI.fold_moments(df, NAMES, "y")), spec, NAMES)
    # Spark's learner on scaled columns; it divides its ridge term by the label's sample deviation
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * float(np.std(y, ddof=1))
    z = df.select("id", "y", *[((F.col(n) - float(x[:, i].mean())) / float(x[:, i].std() or 1)).alias(n) for i, n in enumerate(NAMES)])
    z = VectorAssembler(inputCols=NAMES[:5], outputCol="features").transform(z)
    theirs = LinearRegression(labelCol="y", regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2) if alpha else 0.0, standardization=False, maxIter=5000, tol=1e-14).fit(z)
    got = np.array([r.prediction for r in ours.pipeline().transform(df).orderBy("id").collect()])
    want = np.array([r.prediction for r in theirs.transform(z).orderBy("id").collect()])
    near = 1e-5 if l1_ratio in (0.0, 1.0) else 1e-3  # Spark's iterations stop earlier in the mixed case
    assert np.sqrt(np.mean((got - want) ** 2)) < near * np.std(y)

    def objective(predicted, w):
        return np.mean((y - predicted) ** 2) / 2 + l1 * np.abs(w).sum() + alpha * (1 - l1_ratio) * (w * w).sum() / 2

    assert objective(got, ours.scaled) <= objective(want, theirs.coefficients.toArray()) + 1e-9


def test_optimality_where_columns_depend_on_each_other():
    rng = np.random.default_rng(1)
    for trial in range(30):
        x = rng.normal(size=(200, 6))
        group = rng.integers(0, 4, 200)
        x = np.column_stack([x, *(group == g for g in range(4)), x[:, 0] + x[:, 1]])  # one-hot columns add up to 1
        x = (x - x.mean(0)) / x.std(0)
        y = x @ rng.normal(size=11) + rng.normal(size=200)
        a, b = x.T @ x / 200, x.T @ (y - y.mean()) / 200
        for l1, l2 in ((0.0, 0.1), (0.001, 0.0), (0.1, 0.0), (0.01, 0.01), (10.0, 0.0), (0.0001, 0.00001)):
            w = LI.coordinate_descent(a, b, l1, l2)
            assert LI.violation(a, b, w, l1, l2) < 1e-9, (trial, l1, l2)


def test_cross_validation_from_moments_equals_fits(data):
    df, x, y = data
    spec = LI.LinearSpec("net", 0.2, 0.7)
    got = LI.cross_validated(LI.fold_moments(df, NAMES, "y", "fold"), spec, NAMES)
    for fold, mse in got.items():
        model = LI.fit(LI.total(LI.fold_moments(df.where(F.col("fold") != fold), NAMES, "y")), spec, NAMES).pipeline()
        want = model.transform(df.where(F.col("fold") == fold)).select(F.avg((F.col("y") - F.col("prediction")) ** 2).alias("v")).first().v
        assert mse == pytest.approx(want, rel=1e-8)


def test_odd_rows(spark, data):
    df, _, _ = data
    assert LI.fold_moments(df.limit(0), NAMES, "y") == {}
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(Exception, match="impute or reject"):
            LI.fold_moments(df.withColumn("a", F.when(F.col("id") == 5, F.lit(bad).cast("double")).otherwise(F.col("a"))), NAMES, "y")
