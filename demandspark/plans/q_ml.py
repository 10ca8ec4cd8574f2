"""Registered queries: Spark ML regressors, importances, model storage and
tuning runs (§2.10, §2.12); scoring with a fitted model (§2.14) and the
monitoring workflow (§2.13).

The linear models have SQL twins that solve the same equations
(``linear_sql``); the trees' results have none (the driver checks rows
only). Every fit has its full size (100 trees, 100 rounds); nothing is
kept between queries.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark import schema as S
from demandspark.functions import scalar as X
from demandspark.functions.features import feature_recipe
from demandspark.operators import cleaning as CL
from demandspark.operators import drift as DR
from demandspark.operators import evaluate as EV
from demandspark.operators import linear as LI
from demandspark.operators import models as M
from demandspark.operators import monitor as MO
from demandspark.operators import scoring as SCO
from demandspark.operators import split as SP
from demandspark.plans import linear_sql as LS
from demandspark.plans import run_views as RV
from demandspark.plans import views as V
from demandspark.plans.common import round_doubles
from demandspark.plans.q_io import _write_raw_csv
from demandspark.plans.registry import register
from demandspark.session import scratch_path
from demandspark.sources import readers as RD
from demandspark.sources import sinks as SK

LINEAR = "Linear Regression"
LINEAR_MODELS = (LINEAR, "Ridge Regression", "Lasso Regression", "Elastic Net")
TUNED = "Elastic Net (tuned)"
DRAWS, FOLDS, CV_FOLDS, EVALUATIONS, PATIENCE = 10, 3, 5, 20, 30


def _written(df, name):
    """The table written once to the shared folder (removed when the application ends): its columns are
    expressions over others, and every pass and filter on them would work them out anew."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def _split(spark, sf_dir):
    s = feature_recipe(_written(RV.split_demand(spark, sf_dir), "split"))
    return _written(s.select("obs_id", "split", S.LABEL, *S.FEATURES), "features")


def _fitted(spark, sf_dir, names, parallelism=4):
    """(fitted models by name, the split table)."""
    s = _split(spark, sf_dir)
    if all(k in M.LINEAR_SPECS for k in names):
        moments = _moments(s)["train"]
        return {k: LI.fit(moments, M.LINEAR_SPECS[k], S.FEATURES).pipeline() for k in names}, s
    every = M.estimators()
    return M.train_all(s.where(F.col("split") == "train"), {k: every[k] for k in names}, parallelism), s


def _moments(s):
    """The moments of each part of the split from one scan. A filter on the split
    would be pushed below the columns that it hangs on and repeat them."""
    parts = ["train", "val", "test"]
    numbered = s.withColumn("part", F.array_position(F.array(*map(F.lit, parts)), F.col("split")) - 1)
    return {parts[k]: m for k, m in LI.fold_moments(numbered, S.FEATURES, S.LABEL, "part").items()}


def _one(name):
    def build(spark, sf_dir):
        models, s = _fitted(spark, sf_dir, [name])
        t = M.results_table(models, s)
        return round_doubles(t) if name in LINEAR_MODELS else t
    return build


for _key, _name in [("ml_linear", "Linear Regression"), ("ml_ridge", "Ridge Regression"),
                    ("ml_lasso", "Lasso Regression"), ("ml_elastic_net", "Elastic Net")]:
    register(_key, LS.results_sql(_name, M.LINEAR_SPECS[_name]))(_one(_name))
for _key, _name in [("ml_decision_tree", "Decision Tree"), ("ml_random_forest", "Random Forest"),
                    ("ml_gbt", "Gradient Boosting"), ("ml_gbt_sampled", "Boosted Trees (sampled)")]:
    register(_key)(_one(_name))


@register("ml_train_all")
def ml_train_all(spark, sf_dir):
    models, s = _fitted(spark, sf_dir, [*LINEAR_MODELS, *M.TREES])
    return M.results_table(models, s.where(F.col("split") != "val"))


@register("ml_importance")
def ml_importance(spark, sf_dir):
    """Importances of every tree model."""
    return M.all_importances(spark, _fitted(spark, sf_dir, M.TREES)[0])


@register("topk_importance")
def topk_importance(spark, sf_dir):
    return M.all_importances(spark, _fitted(spark, sf_dir, ["Random Forest"])[0]).where(F.col("rank") <= 15)


@register("sink_importance_csv")
def sink_importance_csv(spark, sf_dir):
    table = M.all_importances(spark, _fitted(spark, sf_dir, ["Random Forest", "Decision Tree", *LINEAR_MODELS])[0])
    path = SK.write_csv(table, scratch_path(spark, "importance"))
    return spark.read.option("header", True).csv(path)


@register("ml_model_store")
def ml_model_store(spark, sf_dir):
    """Fit (scaler inside the pipeline), save, load, score the test rows."""
    models, s = _fitted(spark, sf_dir, [LINEAR])
    uri = M.save_model(models[LINEAR], scratch_path(spark, "model"))
    loaded = M.load_model(uri)
    test = M.with_label(s.where(F.col("split") == "test"))
    return loaded.transform(test).select("obs_id", S.LABEL, F.col("prediction").alias("yhat"))


@register("score_file")
def score_file(spark, sf_dir):
    """CSV in -> CSV out with a stored, fitted model: the input columns and the prediction."""
    models, _ = _fitted(spark, sf_dir, [LINEAR])
    loaded = M.load_model(M.save_model(models[LINEAR], scratch_path(spark, "model")))
    src = _write_raw_csv(spark, sf_dir)
    schema = T.StructType([T.StructField("obs_id", T.LongType()), *S.RAW_CSV_SCHEMA.fields])
    req = RD.read_demand_csv(spark, src, schema=schema).drop(S.LABEL)
    s = SCO.score_batch(req, SCO.model_predictor(loaded), keep=req.columns).drop("index")
    out = SK.write_csv(s, scratch_path(spark, "scored"))
    return spark.read.option("header", True).csv(out)


def _random_search(train):
    """Settings of the elastic net, drawn without replacement, over contiguous folds of the train rows."""
    return M.net_random_search(SP.kfold(train, "obs_id", FOLDS), "fold", M.grid_draws(M.NET_GRID, DRAWS))


def _trials(t):
    return t.select("trial", *[F.col("params")[k].cast("double").alias(k) for k in ("alpha", "l1_ratio")], "loss")


@register("tune_random_search", LS.random_search_sql(M.grid_draws(M.NET_GRID, DRAWS), FOLDS))
def tune_random_search(spark, sf_dir):
    """10 draws x 3 folds, best by MSE (one decimal: the SQL twin's sweeps creep where
    a lasso's penalty is tiny and columns depend on each other)."""
    _, best, trials = _random_search(_split(spark, sf_dir).where(F.col("split") == "train"))
    t = _trials(trials).withColumns({f"best_{k}": F.lit(float(v)) for k, v in best.items()})
    return round_doubles(t.withColumn("loss", X.round_half_away("loss", 1)))


def _continuous_search(s):
    parts = _moments(s)
    return M.net_continuous_search(s, parts["train"], parts["val"], M.space_draws(M.NET_SPACE, EVALUATIONS), PATIENCE)


@register("tune_continuous", LS.continuous_search_sql(M.space_draws(M.NET_SPACE, EVALUATIONS)))
def tune_continuous(spark, sf_dir):
    """20 draws of the elastic net's strength (log-uniform) and mixing
    (uniform), scored on the validation split, stopping after 30 idle trials."""
    return round_doubles(_trials(_continuous_search(_split(spark, sf_dir))[1]))


@register("tune_compare_fitted")
def tune_compare_fitted(spark, sf_dir):
    """Both searches, their winners refit and set beside each other on the validation rows."""
    s = _split(spark, sf_dir)
    train, found = s.where(F.col("split") == "train"), {}
    for name, search in (("random", lambda: _random_search(train)[1]), ("continuous", lambda: _continuous_search(s)[0])):
        began = time.time()
        best = search()
        found[name] = (best, time.time() - began)
    return M.compare_searches(train, s.where(F.col("split") == "val"), found)


@register("eval_cv_fitted")
def eval_cv_fitted(spark, sf_dir):
    """Cross-validated RMSE of every model, linear, tree, forest and boosted, over
    five contiguous folds of all rows."""
    return _cross_validated(spark, sf_dir, [*LINEAR_MODELS, *M.TREES])


def _cross_validated(spark, sf_dir, names):
    rows = feature_recipe(V.demand(spark, sf_dir)).select("obs_id", S.LABEL, *S.FEATURES)
    f = SP.kfold(_written(rows, "features"), "obs_id", CV_FOLDS)
    every = M.estimators()
    return EV.cv_summary(M.cross_validated(f, "fold", CV_FOLDS, {k: every[k] for k in names}))


@register("eval_cv_linear", LS.cross_validated_sql(M.LINEAR_SPECS, CV_FOLDS))
def eval_cv_linear(spark, sf_dir):
    """The linear models alone, from one scan."""
    return round_doubles(_cross_validated(spark, sf_dir, LINEAR_MODELS))


@register("tune_retrain_eval", LS.results_sql(TUNED, None, LS.best_of_random(M.grid_draws(M.NET_GRID, DRAWS), FOLDS)))
def tune_retrain_eval(spark, sf_dir):
    """Refit the random-search winner on train, evaluate train and test."""
    s = _split(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    model, _, _ = _random_search(train)
    return round_doubles(M.results_table({TUNED: model}, s))


@register("mon_workflow")
def mon_workflow(spark, sf_dir):
    """Clean -> score with a fitted model -> drift / quality / performance -> alerts -> report."""
    ref, cur = V.reference_current(spark, sf_dir, base=V.demand_dirty(spark, sf_dir))
    num = [f.name for f in S.FACT_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)]
    # rows, and then their features, are read by every check
    ref, cur = (_written(CL.mean_impute(CL.inf_to_null(_written(CL.drop_duplicates(x), "distinct"), num), num), "cleaned") for x in (ref, cur))
    train, current = (_written(feature_recipe(x), "features") for x in (ref, cur))
    models = M.train_all(train, {LINEAR: M.estimators()[LINEAR]}, parallelism=1)
    scored = SCO.model_predictor(models[LINEAR])(current)
    summary = DR.drift_summary(DR.drift_table(train, current, S.NUMERIC_FEATURES + [S.LABEL], S.MONITOR_CATEGORICAL))
    q = MO.quality(cur)
    perf = MO.performance(scored, S.LABEL, "yhat")
    alerts = MO.alerts(summary, q, perf)
    base = scratch_path(spark, "monitoring")
    SK.write_report(MO.attach(summary, perf), base, "workflow")
    return alerts.unionByName(spark.read.json(base).select(
        F.lit("report").alias("type"), F.lit("info").alias("severity"),
        F.format_string("drift_score=%.4f r2=%.4f", "drift_score", "r2_score").alias("message"),
        F.current_timestamp().alias("timestamp")))


KNN_K = 5


def _embeddings_split(spark, sf_dir):
    e = V.table(spark, sf_dir, "embeddings")
    return SP.holdout(e, "vec_id", "label", 0.2)


def _knn_sql() -> str:
    h = "md5(CAST(vec_id AS VARCHAR) || '|42')"
    bins = " + ".join(f"CAST(label > mn + {i}*((mx - mn)/CAST(5 AS DOUBLE)) AS INTEGER)" for i in range(1, 5))
    return f"""WITH s1 AS (SELECT e.*, {bins} AS s FROM embeddings e,
  (SELECT min(label) AS mn, max(label) AS mx FROM embeddings)),
r1 AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY {h}, vec_id) AS rk, count(*) OVER (PARTITION BY s) AS n FROM s1),
sp AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, rk <= round(n * 0.2) AS is_test FROM r1),
pairs AS (SELECT q.vec_id AS qid, r.vec_id AS rid, r.label AS y, list_distance(q.v, r.v) AS d
  FROM sp q JOIN sp r ON q.is_test AND NOT r.is_test),
top AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, rid) AS rn FROM pairs)
SELECT qid AS vec_id, round(avg(y), 6) AS prediction, count(*) AS neighbours FROM top WHERE rn <= {KNN_K} GROUP BY qid"""


@register("ml_knn", _knn_sql())
def ml_knn(spark, sf_dir):
    """Exact k-NN regression (k=5) of test embeddings on train embeddings
    over Voronoi cells (brute force only in the SQL oracle)."""
    from demandspark.operators.knn import knn_regress

    s = _embeddings_split(spark, sf_dir)
    out = knn_regress(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"), k=KNN_K)
    return round_doubles(out)
