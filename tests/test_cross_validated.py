"""Every model is cross-validated, none is left out."""

import functools

from pyspark.sql import functions as F

from demandspark.operators import models as M
from demandspark.plans import q_ml as Q


def _orders(spark, to, n=400):
    spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") * 7 % 90).alias("o_custkey"), (F.col("id") * 131 % 9000 + 900.0).alias("o_totalprice"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id * 3 % 700))").alias("o_orderdate")).write.parquet(f"{to}/orders.parquet")
    return str(to)


def test_every_model_in_every_fold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "estimators", functools.partial(M.estimators, trees=3, rounds=3))
    rows = Q.eval_cv_fitted(spark, _orders(spark, tmp_path)).collect()
    assert {r["model_name"] for r in rows} == {*Q.LINEAR_MODELS, *M.TREES}
    assert {r["folds"] for r in rows} == {Q.CV_FOLDS} and all(r["cv_rmse_min"] > 0 for r in rows)
