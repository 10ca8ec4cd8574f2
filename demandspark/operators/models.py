"""Spark ML regressors, training, importances, storage and tuning.

Linear models are solved from moments (``linear``) and become Spark's
linear regression models. Trees, forests and boosted trees are grown from
binned rows (``trees``). The others are pipelines: VectorAssembler -> (StandardScaler when
the model is scale sensitive) -> regressor. Fits run on the cluster; the
driver only submits them (a thread pool runs several fits at once) and holds
the fitted models' parameters.
"""

from __future__ import annotations

import itertools
import logging
import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.operators import evaluate as EV
from demandspark.operators import linear as LI
from demandspark.operators import trees as TR

SEED = 42
LABEL_D = "label"
TREES = ("Decision Tree", "Random Forest", "Gradient Boosting", "Boosted Trees (sampled)")
# room for many nodes' histograms in one pass over the data; rows remember their node
TREE_WORK = {"maxMemoryInMB": 2048, "cacheNodeIds": True}


LINEAR_SPECS = {
    "Linear Regression": LI.LinearSpec("ols"),
    "Ridge Regression": LI.LinearSpec("ridge", 1.0),
    "Lasso Regression": LI.LinearSpec("net", 1.0, 1.0),
    "Elastic Net": LI.LinearSpec("net", 1.0, 0.5),
}


def estimators(trees: int = 100, rounds: int = 100) -> dict[str, tuple[object, bool]]:
    """name -> (estimator, scale_sensitive), parameters mapped from the
    original learners. Linear models are solved from moments (``linear``)."""
    return {
        **{name: (spec, True) for name, spec in LINEAR_SPECS.items()},
        "Decision Tree": (DecisionTreeRegressor(maxDepth=15, seed=SEED, **TREE_WORK), False),
        "Random Forest": (RandomForestRegressor(numTrees=trees, maxDepth=15, featureSubsetStrategy="all",
                                                seed=SEED, **TREE_WORK), False),
        "Gradient Boosting": (GBTRegressor(maxIter=rounds, maxDepth=6, stepSize=0.1, seed=SEED, **TREE_WORK), False),
        "Boosted Trees (sampled)": (GBTRegressor(maxIter=rounds, maxDepth=6, stepSize=0.1, subsamplingRate=0.8,
                                                 featureSubsetStrategy="0.8", seed=SEED, **TREE_WORK), False),
    }


def pipeline(estimator, scale: bool, features: Sequence[str] = S.FEATURES) -> Pipeline:
    raw = "raw_features" if scale else "features"
    # a NULL feature is an error: rows are imputed or rejected before, never dropped here
    stages = [VectorAssembler(inputCols=list(features), outputCol=raw, handleInvalid="error")]
    if scale:
        stages.append(StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True))
    estimator.setFeaturesCol("features").setLabelCol(LABEL_D)
    return Pipeline(stages=stages + [estimator])


def with_label(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.withColumn(LABEL_D, F.col(label).cast("double"))


def assembled(df: DataFrame, features: Sequence[str] = S.FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """label, raw feature vector and ``keep``: what fits read, assembled once."""
    rows = with_label(df)
    if "split" in df.columns and "split" not in keep:
        keep = [*keep, "split"]
    return VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="error").transform(rows).select(*keep, LABEL_D, "raw_features")


def train_all(train: DataFrame, models: dict[str, tuple[object, bool]], parallelism: int = 4,
              features: Sequence[str] = S.FEATURES) -> dict[str, PipelineModel]:
    """Fit every model. The linear ones share one scan for their moments, the trees
    one table of binned rows (``trees``), ``parallelism`` of them at a time; other learners are distributed Spark jobs,
    ``parallelism`` at a time, over the train rows' vectors, which are assembled and
    cached once."""
    specs = {name: est for name, (est, _) in models.items() if isinstance(est, LI.LinearSpec)}
    moments = LI.total(LI.fold_moments(train, features, S.LABEL)) if specs else None
    solved = {name: LI.fit(moments, spec, features).pipeline() for name, spec in specs.items()}
    grown = {name: est for name, (est, _) in models.items() if name not in solved and TR.grows(est)}
    if grown:
        data = TR.Binned(train, features, S.LABEL, max(est.getMaxBins() for est in grown.values()))
        try:
            # boosting is the longest: it starts first
            first = sorted(grown, key=lambda name: not isinstance(grown[name], GBTRegressor))
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                solved |= zip(first, pool.map(lambda name: TR.fit(data, grown[name]), first))
        finally:
            data.close()
    rest = {name: m for name, m in models.items() if name not in solved}
    if not rest:
        return {name: solved[name] for name in models}
    t = assembled(train, features).persist()
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="error")
    try:
        def fit(item):
            name, (est, scale) = item
            stages = [StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)] if scale else []
            est = est.copy({est.featuresCol: "features" if scale else "raw_features", est.labelCol: LABEL_D})
            fitted = Pipeline(stages=[*stages, est]).fit(t)
            return name, PipelineModel([assembler, *fitted.stages])
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = solved | dict(pool.map(fit, rest.items()))
            return {name: fitted[name] for name in models}
    finally:
        t.unpersist()


def predictions(models: dict[str, PipelineModel], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long predictions (model_name, keep..., yhat) of several models, in one
    pass over ``df``: the models' stages follow each other on the same rows."""
    rows = with_label(df).select(*dict.fromkeys([*keep, *S.FEATURES, LABEL_D]))
    entries = []
    for i, (name, m) in enumerate(models.items()):
        rows = m.transform(rows).withColumnRenamed("prediction", f"yhat_{i}").drop("raw_features", "features")
        entries.append(F.struct(F.lit(name).alias("model_name"), F.col(f"yhat_{i}").alias("yhat")))
    return rows.select(*keep, F.inline(F.array(*entries))).select("model_name", *keep, "yhat")


def results_table(models: dict[str, PipelineModel], split_df: DataFrame, split: str = "split") -> DataFrame:
    long = predictions(models, split_df, [split, S.LABEL])
    t = EV.model_table(long, "model_name", split, S.LABEL, "yhat")
    return t.withColumn("run_id", F.concat(F.lit("run-"), F.lower(F.translate("model_name", " -", "__"))))


def importances(spark, model: PipelineModel, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """(feature, importance, rank) of a fitted model: one row per feature (of
    linear models the size of the scaled features' coefficients)."""
    return all_importances(spark, {"": model}, features).drop("model_name")


def all_importances(spark, models: dict[str, PipelineModel], features: Sequence[str] = S.FEATURES) -> DataFrame:
    """(model_name, feature, importance, rank); bounded by models x features."""
    rows = []
    for name, model in models.items():
        last, linear = model.stages[-1], getattr(model, "linear", None)
        imp = getattr(last, "featureImportances", None)
        vals = imp.toArray() if imp is not None else np.abs(linear.scaled) if linear is not None else [0.0] * len(features)
        ranked = sorted(zip(features, map(float, vals)), key=lambda x: (-x[1], x[0]))
        rows += [(name, f, v, i) for i, (f, v) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "model_name string, feature string, importance double, rank int")


def save_model(model: PipelineModel, uri: str) -> str:
    model.write().overwrite().save(uri)
    return uri


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)


# --- tuning with Spark ML fits ----------------------------------------------------------

# Search grids and spaces of the boosted-tree learners, mapped
# to GBTRegressor (n_estimators->maxIter, max_depth->maxDepth,
# learning_rate->stepSize, subsample->subsamplingRate,
# colsample_bytree->featureSubsetStrategy; L1/L2 terms have no counterpart).
GBT_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 6],
    "stepSize": [0.1, 0.2],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
}
# The same for the forests: numTrees, maxDepth, minInstancesPerNode.
RF_GRID = {
    "numTrees": [100, 200],
    "maxDepth": [10, 20, 30],
    "minInstancesPerNode": [1, 2],
}
# Elastic net: strength and mixing.
NET_GRID = {
    "alpha": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0],
    "l1_ratio": [0.0, 0.25, 0.5, 0.75, 1.0],
}
NET_SPACE = {
    "alpha": ("loguniform", (1e-3, 1e2)),
    "l1_ratio": ("uniform", (0.0, 1.0)),
}
GBT_SPACE = {
    "maxIter": ("choice", [100, 200, 300, 500, 800]),
    "maxDepth": ("choice", [3, 4, 5, 6, 7, 8, 9]),
    "stepSize": ("loguniform", (0.01, 0.3)),
    "subsamplingRate": ("uniform", (0.6, 1.0)),
    "featureSubsetStrategy": ("uniform", (0.6, 1.0)),
    "minInfoGain": ("uniform", (0.0, 0.5)),
}


def grid_draws(grid: dict[str, list], n: int, seed: int = SEED) -> list[dict]:
    """``n`` different settings of the grid (all of them, if it has fewer)."""
    keys = sorted(grid)
    every = [dict(zip(keys, values)) for values in itertools.product(*(grid[k] for k in keys))]
    return random.Random(seed).sample(every, min(n, len(every)))


def space_draws(space: dict[str, tuple], n: int, seed: int = SEED) -> list[dict]:
    """Seeded draws from choice / uniform / log-uniform spaces."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        d = {}
        for k in sorted(space):
            kind, arg = space[k]
            if kind == "choice":
                d[k] = rng.choice(arg)
            elif kind == "uniform":
                d[k] = rng.uniform(*arg)
            else:
                lo, hi = arg
                d[k] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        if isinstance(d.get("featureSubsetStrategy"), float):
            d["featureSubsetStrategy"] = f"{d['featureSubsetStrategy']:.3f}"
        out.append(d)
    return out


def _apply(est, params: dict):
    return est.copy({est.getParam(k): v for k, v in params.items()})


def random_search(train: DataFrame, fold_col: str, draws: list[dict], base=None, folds: int = 3,
                  parallelism: int = 4, scale: bool = False):
    """k-fold search over ``draws`` (folds 0 .. ``folds`` - 1 in ``fold_col``), best by
    MSE; returns (best PipelineModel refit on all train rows, its params, trials)."""
    base = base or GBTRegressor(seed=SEED, **TREE_WORK)
    rows = with_label(train).select(fold_col, LABEL_D, *S.FEATURES).persist()
    try:
        cv = CrossValidator(estimator=pipeline(base, scale=scale), estimatorParamMaps=[{base.getParam(k): v for k, v in d.items()} for d in draws],
                            evaluator=RegressionEvaluator(metricName="mse"), foldCol=fold_col, numFolds=folds, parallelism=parallelism, seed=SEED)
        m = cv.fit(rows)
    finally:
        rows.unpersist()
    trials = _trials(train, draws, m.avgMetrics)
    best = min(range(len(draws)), key=lambda i: m.avgMetrics[i])
    return m.bestModel, draws[best], trials


def _trials(df: DataFrame, draws: list[dict], losses: Sequence[float]) -> DataFrame:
    rows = [(i + 1, {k: str(x) for k, x in d.items()}, float(loss)) for i, (d, loss) in enumerate(zip(draws, losses))]
    return df.sparkSession.createDataFrame(rows, "trial int, params map<string,string>, loss double")


def net_random_search(train: DataFrame, fold_col: str, draws: list[dict], features: Sequence[str] = S.FEATURES):
    """k-fold search of the elastic net from one scan for the folds' moments, best by
    the folds' mean MSE; returns (best model on all train rows, its params, trials)."""
    folds = LI.fold_moments(train, features, S.LABEL, fold_col)
    losses = []
    for d in draws:
        own = LI.cross_validated(folds, LI.LinearSpec("net", **d), features)
        losses.append(sum(own.values()) / len(own))
    best = draws[min(range(len(draws)), key=lambda i: losses[i])]
    return LI.fit(LI.total(folds), LI.LinearSpec("net", **best), features).pipeline(), best, _trials(train, draws, losses)


def net_continuous_search(df: DataFrame, t: LI.Moments, v: LI.Moments, draws: list[dict], patience: int | None = None, features: Sequence[str] = S.FEATURES):
    """The elastic net's draws fitted on the moments ``t`` and scored on those of a
    validation set ``v`` (RMSE), without another scan; stops when ``patience`` trials
    bring no gain. Returns (best params, trials)."""
    losses: list[float] = []
    for d in draws:
        losses.append(math.sqrt(LI.fit(t, LI.LinearSpec("net", **d), features).mse(v)))
        if patience and len(losses) - 1 - min(range(len(losses)), key=lambda j: losses[j]) >= patience:
            break
    best = min(range(len(losses)), key=lambda j: losses[j])
    return draws[best], _trials(df, draws, losses)


def continuous_search(train: DataFrame, val: DataFrame, draws: list[dict], base=None,
                      patience: int | None = None, batch: int = 4, scale: bool = False):
    """Trials scored on a fixed validation set (RMSE), run in batches of
    ``batch`` parallel fits; stops when ``patience`` trials bring no gain.
    A fit that fails scores +inf and is logged; if all fail, the last error
    is raised. Returns (best params, trials)."""
    base = base or GBTRegressor(seed=SEED, **TREE_WORK)
    t, v = assembled(train).persist(), assembled(val).persist()
    ev = RegressionEvaluator(metricName="rmse", labelCol=LABEL_D)
    stages = [StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)] if scale else []
    column = "features" if scale else "raw_features"
    losses: list[float] = []
    errors: list[Exception] = []

    def run(d):
        try:
            est = _apply(base, d)
            m = Pipeline(stages=[*stages, est.copy({est.featuresCol: column, est.labelCol: LABEL_D})]).fit(t)
            return ev.evaluate(m.transform(v))
        except Exception as e:  # a trial's setting may be impossible
            logging.getLogger(__name__).warning("trial %s failed: %s", d, e)
            errors.append(e)
            return float("inf")
    try:
        with ThreadPoolExecutor(max_workers=batch) as pool:
            for i in range(0, len(draws), batch):
                losses += list(pool.map(run, draws[i:i + batch]))
                if patience:
                    best_at = min(range(len(losses)), key=lambda j: losses[j])
                    if len(losses) - 1 - best_at >= patience:
                        break
    finally:
        t.unpersist()
        v.unpersist()
    if errors and not any(map(math.isfinite, losses)):
        raise errors[-1]
    best = min(range(len(losses)), key=lambda j: losses[j])
    return draws[best], _trials(train, draws, losses)


def compare_searches(train: DataFrame, val: DataFrame, found: dict[str, tuple[dict, float]], base=None, scale: bool = False) -> DataFrame:
    """``found``: method -> (best params, seconds of its search). Refits each (an elastic net without ``base``) on
    ``train`` and sets RMSE and R2 on ``val``, the gain over the first method and
    the ratio of the times beside each other: one row per method."""
    models = train_all(train, {name: (_apply(base, params) if base else LI.LinearSpec("net", **params), scale) for name, (params, _) in found.items()}, parallelism=len(found))
    long = predictions(models, val, [S.LABEL])
    m = long.groupBy("model_name").agg(EV.rmse_expr(S.LABEL, "yhat").alias("rmse"), EV.r2_expr(S.LABEL, "yhat").alias("r2"))
    first = next(iter(found))
    base_row = m.where(F.col("model_name") == first).select(F.struct("rmse", "r2").alias("b")).scalar()
    seconds = F.coalesce(*[F.when(F.col("model_name") == n, F.lit(float(t))) for n, (_, t) in found.items()])
    return m.withColumn("b", base_row).select(
        F.col("model_name").alias("method"), "rmse", "r2", seconds.alias("seconds"), (F.col("b.rmse") - F.col("rmse")).alias("rmse_gain"),
        (F.col("r2") - F.col("b.r2")).alias("r2_gain"), (seconds / F.lit(max(float(found[first][1]), 1e-9))).alias("time_ratio"))


def cross_validated(df: DataFrame, fold_col: str, folds: int, models: dict[str, tuple[object, bool]], parallelism: int = 4) -> DataFrame:
    """(model_name, fold, rmse): each fold's rows predicted by models fitted on the
    others; linear models come from one scan for the folds' moments."""
    specs = {name: est for name, (est, _) in models.items() if isinstance(est, LI.LinearSpec)}
    rest = {name: m for name, m in models.items() if name not in specs}
    moments = LI.fold_moments(df, S.FEATURES, S.LABEL, fold_col) if specs else {}
    rows = [(name, f, math.sqrt(mse)) for name, spec in specs.items() for f, mse in LI.cross_validated(moments, spec, S.FEATURES).items()]
    out = df.sparkSession.createDataFrame(rows, f"model_name string, fold {dict(df.dtypes)[fold_col]}, rmse double")
    every = range(folds) if rest else ()
    with ThreadPoolExecutor(max_workers=2) as pool:  # two folds at a time, as each keeps its rows
        fits = [*pool.map(lambda fold: train_all(df.where(F.col(fold_col) != fold), rest, parallelism), every)]
    for fold, fitted in zip(every, fits):
        long = predictions(fitted, df.where(F.col(fold_col) == fold), [fold_col, S.LABEL])
        out = out.unionByName(long.groupBy("model_name", F.col(fold_col).alias("fold")).agg(EV.rmse_expr(S.LABEL, "yhat").alias("rmse")))
    return out
