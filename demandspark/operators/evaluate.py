"""Regression metrics as single-pass aggregates (partial + final agg)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions import scalar as X


def _e(y: str, yhat: str) -> Column:
    return F.col(y) - F.col(yhat)


def mae_expr(y: str, yhat: str) -> Column:
    return F.avg(F.abs(_e(y, yhat)))


def rmse_expr(y: str, yhat: str) -> Column:
    e = _e(y, yhat)
    return F.sqrt(F.avg(e * e))


def r2_expr(y: str, yhat: str, nonfinite_to_zero: bool = False) -> Column:
    """``1 - SSres/SStot``; NULL when the actuals are constant (or 0 with
    ``nonfinite_to_zero``)."""
    e = _e(y, yhat)
    r2 = F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.col(y)))
    return X.finite_or(r2, 0.0) if nonfinite_to_zero else r2


def mape_expr(y: str, yhat: str) -> Column:
    """Masked MAPE x100 over non-zero actuals; 0 when there are none."""
    yc = F.col(y)
    pct = F.when(yc != 0, F.abs(F.try_divide(_e(y, yhat), yc)))
    return F.coalesce(F.lit(100.0) * F.avg(pct), F.lit(0.0))


def regression_metrics(df: DataFrame, y: str, yhat: str, group_by: Sequence[str] = (),
                       mape: bool = True, nonfinite_to_zero: bool = False) -> DataFrame:
    """n, mae, rmse, r2 (+ mape) per group in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n"), mae_expr(y, yhat).alias("mae"),
            rmse_expr(y, yhat).alias("rmse"), r2_expr(y, yhat, nonfinite_to_zero).alias("r2")]
    if mape:
        aggs.append(mape_expr(y, yhat).alias("mape"))
    g = df.groupBy(*group_by) if group_by else df.groupBy()
    return g.agg(*aggs)


def model_table(preds: DataFrame, model: str = "model_name", split: str = "split",
                y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Long predictions (model, split, y, yhat) -> one row per model with
    train/test r2, rmse, mae, mape and the overfit score, in one aggregate."""
    aggs = []
    for s in ("train", "test"):
        m = F.col(split) == s
        ys = F.when(m, F.col(y))
        e = F.when(m, F.col(y) - F.col(yhat))
        n = F.count(ys)
        aggs += [
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(ys) * n)).alias(f"{s}_r2"),
            F.sqrt(F.avg(e * e)).alias(f"{s}_rmse"),
            F.avg(F.abs(e)).alias(f"{s}_mae"),
            F.coalesce(F.lit(100.0) * F.avg(F.when(m & (F.col(y) != 0),
                                                   F.abs(F.try_divide(F.col(y) - F.col(yhat), F.col(y))))),
                       F.lit(0.0)).alias(f"{s}_mape"),
        ]
    t = preds.groupBy(model).agg(*aggs)
    fin = {c: X.finite_or(c, 0.0) for c in t.columns if c != model}
    t = t.withColumns(fin)
    return t.withColumn("overfit_score", X.finite_or(F.col("train_rmse") - F.col("test_rmse"), 0.0))


def cv_summary(fold_metrics: DataFrame, model: str = "model_name", rmse: str = "rmse") -> DataFrame:
    """Per model: mean, population std, min and max of the fold RMSE."""
    return fold_metrics.groupBy(model).agg(
        F.avg(rmse).alias("cv_rmse_mean"), F.stddev_pop(rmse).alias("cv_rmse_std"),
        F.min(rmse).alias("cv_rmse_min"), F.max(rmse).alias("cv_rmse_max"),
        F.count(F.lit(1)).alias("folds"))
