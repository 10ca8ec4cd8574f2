"""Registered queries: split, scaling, windows, evaluation, tuning tables,
joins and run tables (§2.8, §2.9, §2.11, §2.12 tables, §2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import scalar as X
from demandspark.operators import evaluate as EV
from demandspark.operators import filters as FL
from demandspark.operators import profile as P
from demandspark.operators import runs as RU
from demandspark.operators import scaling as SC
from demandspark.operators import split as SP
from demandspark.operators import tuning as TU
from demandspark.operators import windows as W
from demandspark.plans import run_views as RV
from demandspark.plans import sql as Q
from demandspark.plans import views as V
from demandspark.plans.common import round_doubles
from demandspark.plans.registry import register

D = Q.with_ctes


# --- §2.9 split -------------------------------------------------------------------

@register("split_stratified", D(Q.DEMAND, RV.SPLIT, body="SELECT obs_id, split FROM split"))
def split_stratified(spark, sf_dir):
    return RV.split_demand(spark, sf_dir).select("obs_id", "split")


@register("split_holdout", D(Q.DEMAND, RV.SPLIT, body=
    "SELECT obs_id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM t1"))
def split_holdout(spark, sf_dir):
    return SP.holdout(V.demand(spark, sf_dir), "obs_id", S.LABEL).select("obs_id", "split")


@register("split_ordered", D(Q.DEMAND, body=
    "SELECT obs_id, CASE WHEN row_number() OVER (ORDER BY obs_id) <= floor((SELECT count(*) FROM demand) * 0.8) "
    "THEN 'train' ELSE 'test' END AS split FROM demand"))
def split_ordered(spark, sf_dir):
    return SP.ordered(V.demand(spark, sf_dir), "obs_id", 0.2).select("obs_id", "split")


@register("split_kfold", D(Q.DEMAND, body=
    "SELECT obs_id, CAST(floor((row_number() OVER (ORDER BY obs_id) - 1) * 3 / (SELECT count(*) FROM demand)) "
    "AS INTEGER) AS fold FROM demand"))
def split_kfold(spark, sf_dir):
    return SP.kfold(V.demand(spark, sf_dir), "obs_id", 3).select("obs_id", "fold")


_SCALE = ["temperature_c", "humidity", "wind_speed"]


@register("scale_standard", D(Q.DEMAND, RV.SPLIT, body="SELECT obs_id, split, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM split WHERE split = 'train')) / (SELECT CASE WHEN stddev_pop({c}) = 0 "
    f"THEN 1 ELSE stddev_pop({c}) END FROM split WHERE split = 'train'), 9) AS {c}" for c in _SCALE)
    + " FROM split"))
def scale_standard(spark, sf_dir):
    s = RV.split_demand(spark, sf_dir).select("obs_id", "split", *_SCALE)
    return round_doubles(SC.standard_scale(s, _SCALE, F.col("split") == "train"), 9)


@register("agg_target_range", D(Q.DEMAND, RV.SPLIT, body=
    "SELECT split, min(rented_bike_count) AS min, max(rented_bike_count) AS max, count(*) AS n "
    "FROM split GROUP BY split"))
def agg_target_range(spark, sf_dir):
    return P.target_range(RV.split_demand(spark, sf_dir), "split", S.LABEL)


# --- §2.11 evaluation ----------------------------------------------------------------

_OVERALL_SQL = f"""SELECT count(*) AS n, round(avg(abs(rented_bike_count - ({Q.LINEAR}))), 6) AS mae,
 round(sqrt(avg(power(rented_bike_count - ({Q.LINEAR}), 2))), 6) AS rmse,
 round(1 - sum(power(rented_bike_count - ({Q.LINEAR}), 2)) / (var_pop(rented_bike_count) * count(*)), 6) AS r2
 FROM demand"""


@register("eval_rmse_mae_r2", D(Q.DEMAND, body=_OVERALL_SQL))
def eval_rmse_mae_r2(spark, sf_dir):
    d = V.linear_pred(V.demand(spark, sf_dir))
    return round_doubles(EV.regression_metrics(d, S.LABEL, "yhat", mape=False))


@register("eval_mape", D(Q.DEMAND, body=f"""SELECT functioning_day,
 round(COALESCE(100 * avg(CASE WHEN rented_bike_count <> 0 THEN
   abs((rented_bike_count - ({Q.LINEAR})) / rented_bike_count) END), 0), 6) AS mape FROM demand GROUP BY functioning_day"""))
def eval_mape(spark, sf_dir):
    """Per functioning flag: the non-functioning rows are all zero, so
    their masked MAPE is the 0 fallback."""
    d = V.linear_pred(V.demand(spark, sf_dir))
    return round_doubles(d.groupBy("functioning_day").agg(EV.mape_expr(S.LABEL, "yhat").alias("mape")))


_RES_COLS = [f.name for f in S.MODEL_RESULTS_SCHEMA.fields]


def _round_sql(cols, src, places=6):
    return "SELECT " + ", ".join(f"round({c}, {places}) AS {c}" if c not in ("model_name", "run_id") else c
                                 for c in cols) + f" FROM {src}"


@register("eval_model_table", D(Q.DEMAND, RV.RESULTS, body=_round_sql(_RES_COLS, "results")))
def eval_model_table(spark, sf_dir):
    return round_doubles(RV.model_results(spark, sf_dir).select(*_RES_COLS))


@register("eval_overfit", D(Q.DEMAND, RV.RESULTS, body=_round_sql(
    ["model_name", "train_rmse", "test_rmse", "overfit_score"], "results")))
def eval_overfit(spark, sf_dir):
    return round_doubles(RV.model_results(spark, sf_dir).select("model_name", "train_rmse", "test_rmse",
                                                                "overfit_score"))


@register("eval_residuals", D(Q.DEMAND, RV.SPLIT, body=
    f"SELECT obs_id, rented_bike_count AS actual, round({Q.LINEAR}, 9) AS predicted, "
    f"round(rented_bike_count - ({Q.LINEAR}), 9) AS residual FROM split WHERE split = 'test'"))
def eval_residuals(spark, sf_dir):
    s = V.linear_pred(RV.split_demand(spark, sf_dir)).where(F.col("split") == "test")
    return round_doubles(s.select("obs_id", F.col(S.LABEL).alias("actual"), F.col("yhat").alias("predicted"),
                                  (F.col(S.LABEL) - F.col("yhat")).alias("residual")), 9)


def _cv_sql(k: int = 3) -> str:
    return f"""folds AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY obs_id) - 1) * {k} /
  (SELECT count(*) FROM demand)) AS INTEGER) AS fold FROM demand),
fcl AS ({RV.candidate_long_sql('folds', ['fold', 'rented_bike_count'])}),
fm AS (SELECT model_name, fold, sqrt(avg((rented_bike_count - yhat) * (rented_bike_count - yhat))) AS rmse
  FROM fcl GROUP BY model_name, fold)
SELECT model_name, round(avg(rmse), 6) AS cv_rmse_mean, round(stddev_pop(rmse), 6) AS cv_rmse_std,
 round(min(rmse), 6) AS cv_rmse_min, round(max(rmse), 6) AS cv_rmse_max, count(*) AS folds FROM fm GROUP BY model_name"""


@register("eval_cv_summary", D(Q.DEMAND, body="SELECT 1").replace("\nSELECT 1", ",\n" + _cv_sql()))
def eval_cv_summary(spark, sf_dir):
    f = SP.kfold(V.demand(spark, sf_dir), "obs_id", 3)
    long = RV.candidate_long(f, ["fold", S.LABEL])
    fm = long.groupBy("model_name", "fold").agg(EV.rmse_expr(S.LABEL, "yhat").alias("rmse"))
    return round_doubles(EV.cv_summary(fm))


# --- §2.9 windows / top-k over results ---------------------------------------------------

@register("win_rankings", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT model_name, round(test_r2, 6) AS test_r2, row_number() OVER (ORDER BY test_r2 DESC, model_name) AS rank "
    "FROM results"))
def win_rankings(spark, sf_dir):
    r = W.rank_desc(RV.model_results(spark, sf_dir), "test_r2", "model_name")
    return round_doubles(r.select("model_name", "test_r2", F.col("rank").cast("bigint").alias("rank")))


@register("topk_models", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT model_name, round(test_r2, 6) AS test_r2 FROM results ORDER BY test_r2 DESC, model_name LIMIT 3"))
def topk_models(spark, sf_dir):
    return round_doubles(W.top_k(RV.model_results(spark, sf_dir), "test_r2", "model_name", 3)
                         .select("model_name", "test_r2"))


@register("topk_argmax", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT model_name, run_id, round(test_r2, 6) AS test_r2 FROM results ORDER BY test_r2 DESC, model_name LIMIT 1"))
def topk_argmax(spark, sf_dir):
    return round_doubles(W.argmax(RV.model_results(spark, sf_dir), "test_r2", "model_name",
                                  ["model_name", "run_id", "test_r2"]))


@register("lim_head", D(Q.DEMAND, body=
    f"SELECT obs_id, rented_bike_count AS actual, {Q.LINEAR} AS predicted FROM demand ORDER BY obs_id LIMIT 100"))
def lim_head(spark, sf_dir):
    d = V.linear_pred(V.demand(spark, sf_dir))
    return W.head(d, "obs_id", 100).select("obs_id", F.col(S.LABEL).alias("actual"),
                                          F.col("yhat").alias("predicted"))


@register("agg_summary_stats", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT round(avg(test_r2), 6) AS avg_r2, round(max(test_r2), 6) AS best_r2, round(avg(test_rmse), 6) AS avg_rmse, "
    "count(*) AS models FROM results"))
def agg_summary_stats(spark, sf_dir):
    return round_doubles(P.summary_stats(RV.model_results(spark, sf_dir)))


# --- tuning tables (§2.12) ----------------------------------------------------------------

# The sweep grid of the closed-form predictor family.
SWEEP_SPACE = {"temp_coef": [10, 12, 14, 15, 16, 18], "hour_coef": [20, 22, 24, 25, 26, 28],
               "intercept": [200, 225, 250, 275, 300]}
SWEEP_TRIALS = 30
PATIENCE = 10


def _draws():
    return TU.seeded_draws(SWEEP_SPACE, SWEEP_TRIALS, 42)


def _pred(p):
    return (F.lit(float(p["temp_coef"])) * F.col("temperature_c")
            + F.lit(float(p["hour_coef"])) * (18 - F.abs(F.col("hour") - 18))) + F.lit(float(p["intercept"]))


def _trials(spark, sf_dir):
    return TU.sweep_trials(V.demand(spark, sf_dir), S.LABEL, "linear_family", _draws(), _pred)


def _trials_sql(name: str = "trials", draws: list[dict] | None = None) -> str:
    parts = []
    for i, p in enumerate(draws or _draws()):
        yhat = RV._yhat_sql(float(p["temp_coef"]), float(p["hour_coef"]), float(p["intercept"]))
        parts.append(f"SELECT 'linear_family' AS model_name, {i + 1} AS trial, {p['temp_coef']} AS temp_coef, "
                     f"{p['hour_coef']} AS hour_coef, {p['intercept']} AS intercept, "
                     f"avg((rented_bike_count - ({yhat})) * (rented_bike_count - ({yhat}))) AS loss FROM demand")
    return f"{name} AS (" + "\nUNION ALL\n".join(parts) + ")"


def _flat_trials(t):
    return t.select("model_name", "trial",
                    *[F.col("params")[k].cast("int").alias(k) for k in ("temp_coef", "hour_coef", "intercept")],
                    "loss", *[c for c in t.columns if c == "best_so_far"])


@register("tune_trials_table", D(Q.DEMAND, _trials_sql(), body=
    "SELECT model_name, trial, temp_coef, hour_coef, intercept, round(loss, 6) AS loss, "
    "round(min(loss) OVER (PARTITION BY model_name ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) "
    "AS best_so_far FROM trials"))
def tune_trials_table(spark, sf_dir):
    return round_doubles(_flat_trials(TU.convergence(_trials(spark, sf_dir))))


@register("win_running_best", D(Q.DEMAND, _trials_sql(), body=
    "SELECT model_name, trial, round(min(loss) OVER (PARTITION BY model_name ORDER BY trial "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS best_so_far FROM trials"))
def win_running_best(spark, sf_dir):
    t = W.running_min(_trials(spark, sf_dir), ["model_name"], "trial", "loss", "best_so_far")
    return round_doubles(t.select("model_name", "trial", "best_so_far"))


@register("tune_early_stop", D(Q.DEMAND, _trials_sql(), f"""imp AS (SELECT *, min(loss) OVER (PARTITION BY model_name
  ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM trials),
li AS (SELECT *, max(CASE WHEN prev IS NULL OR loss < prev THEN trial END) OVER (PARTITION BY model_name ORDER BY trial
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM imp),
st AS (SELECT model_name, COALESCE(min(CASE WHEN trial - last_imp >= {PATIENCE} THEN trial END), max(trial)) AS stop_trial
  FROM li GROUP BY model_name)""", body=
    "SELECT li.model_name, first(stop_trial) AS stop_trial, round(min(loss), 6) AS best_loss, count(*) AS trials_run "
    "FROM li JOIN st USING (model_name) WHERE trial <= stop_trial GROUP BY li.model_name"))
def tune_early_stop(spark, sf_dir):
    return round_doubles(TU.early_stop(_trials(spark, sf_dir), PATIENCE))


UNIFORM_SPACE = {"temp_coef": (10.0, 18.0), "hour_coef": (20.0, 28.0), "intercept": (200.0, 300.0)}


def _uniform():
    return TU.uniform_draws(UNIFORM_SPACE, SWEEP_TRIALS, 42)


@register("tune_compare", D(Q.DEMAND, _trials_sql(), _trials_sql("uniform", _uniform()), """
sp AS (SELECT var_pop(rented_bike_count) AS v FROM demand),
ba AS (SELECT model_name, min(loss) AS a, count(*) AS trials_random FROM trials GROUP BY model_name),
bb AS (SELECT model_name, min(loss) AS b, count(*) AS trials_continuous FROM uniform GROUP BY model_name)""",
    body="SELECT model_name, round(sqrt(a), 6) AS rmse_random, round(sqrt(b), 6) AS rmse_continuous, "
    "round(1 - a / v, 6) AS r2_random, round(1 - b / v, 6) AS r2_continuous, trials_random, trials_continuous, "
    "round(sqrt(a) - sqrt(b), 6) AS improvement, round((1 - b / v) - (1 - a / v), 6) AS r2_gain, "
    "round(sqrt(b) / sqrt(a), 6) AS ratio, CASE WHEN sqrt(b) < sqrt(a) THEN 'continuous' ELSE 'random' END AS winner "
    "FROM ba JOIN bb USING (model_name), sp"))
def tune_compare(spark, sf_dir):
    """A search over a grid beside one over ranges, of the same length
    (``tune_compare_fitted`` sets two fitted searches beside each other, with their times)."""
    ranges = TU.sweep_trials(V.demand(spark, sf_dir), S.LABEL, "linear_family", _uniform(), _pred)
    return round_doubles(TU.compare_methods(_trials(spark, sf_dir), ranges, "random", "continuous"))


# --- §2.8 joins and §2.14 run tables -----------------------------------------------------

_RUN_CTES = (Q.DEMAND, RV.RUNS)


@register("proj_flatten_maps", D(*_RUN_CTES, body=
    "SELECT run_id, model_type AS model, round(COALESCE(test_r2, 0), 6) AS test_r2, "
    "round(COALESCE(test_rmse, CAST('inf' AS DOUBLE)), 6) AS test_rmse, tuned FROM runs"))
def proj_flatten_maps(spark, sf_dir):
    r = RV.runs(spark, sf_dir)
    from demandspark.operators.projection import flatten_maps
    f = flatten_maps(r, {"model": ("params", "model_type", "Unknown"), "test_r2": ("metrics", "test_r2", 0.0),
                         "test_rmse": ("metrics", "test_rmse", float("inf")), "tuned": ("tags", "tuned", "false")})
    return round_doubles(f.select("run_id", "model", "test_r2", "test_rmse", "tuned"))


@register("flt_has_key", D(*_RUN_CTES, body="SELECT run_id FROM runs WHERE test_r2 IS NOT NULL"))
def flt_has_key(spark, sf_dir):
    return FL.has_key(RV.runs(spark, sf_dir), "metrics", "test_r2").select("run_id")


@register("run_leaderboard", D(*_RUN_CTES, body=
    "SELECT run_id, model_type AS model, round(test_r2, 6) AS test_r2, "
    "round(COALESCE(test_rmse, CAST('inf' AS DOUBLE)), 6) AS test_rmse, "
    "round(COALESCE(test_mae, CAST('inf' AS DOUBLE)), 6) AS test_mae, CAST(0 AS DOUBLE) AS overfitting_score, "
    "CAST(start_time AS VARCHAR) AS start_time, "
    "row_number() OVER (ORDER BY test_r2 DESC, run_id) AS rank FROM runs WHERE test_r2 IS NOT NULL"))
def run_leaderboard(spark, sf_dir):
    lb = RU.leaderboard(RV.runs(spark, sf_dir))
    return round_doubles(lb.withColumns({"start_time": F.date_format("start_time", "yyyy-MM-dd HH:mm:ss"),
                                         "rank": F.col("rank").cast("bigint")}))


_VER_CTES = (Q.DEMAND, RV.RUNS, RV.VERSIONS)


@register("flt_name_contains", D(*_VER_CTES, body=
    "SELECT name, version FROM versions_s WHERE lower(name) LIKE '%tuned%'"))
def flt_name_contains(spark, sf_dir):
    return FL.name_contains(RV.model_versions(spark, sf_dir), "name", "TUNED").select("name", "version")


@register("win_latest_version", D(*_VER_CTES, body=
    "SELECT name, version, run_id, stage FROM versions_s WHERE stage = 'Production'"))
def win_latest_version(spark, sf_dir):
    v = RV.model_versions(spark, sf_dir).select("name", "version", "run_id", "stage")
    return W.latest_per(v, ["name"], "version")


@register("join_version_runs", D(*_VER_CTES, body=
    "SELECT v.name, v.version, v.run_id, round(r.test_r2, 6) AS test_r2 FROM versions_s v JOIN runs r USING (run_id)"))
def join_version_runs(spark, sf_dir):
    r = RV.runs(spark, sf_dir)
    j = RU.version_runs(RV.model_versions(spark, sf_dir, r), r)
    return round_doubles(j.select("name", "version", "run_id", X.map_get("run_metrics", "test_r2").alias("test_r2")))


@register("run_champion", D(Q.DEMAND, RV.RESULTS, RV.RUNS, RV.VERSIONS, """cand AS (
  SELECT model_name, run_id, test_r2 AS r2, 'current' AS source, 0 AS pri FROM results
  UNION ALL
  SELECT v.name, v.run_id, COALESCE(r.test_r2, 0), 'registry', 1 FROM versions_s v JOIN runs r USING (run_id)
  WHERE lower(v.name) LIKE '%tuned%')""", body=
    "SELECT model_name, run_id, round(r2, 6) AS r2, source FROM cand ORDER BY r2 DESC, pri, model_name, run_id LIMIT 1"))
def run_champion(spark, sf_dir):
    r = RV.runs(spark, sf_dir)
    c = RU.champion(RV.model_results(spark, sf_dir), RV.model_versions(spark, sf_dir, r), r)
    return round_doubles(c)


@register("run_summary", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT count(*) AS models, round(max(test_r2), 6) AS best_r2, round(avg(test_r2), 6) AS avg_r2, "
    "round(avg(test_rmse), 6) AS avg_rmse, string_agg(model_name, ',' ORDER BY test_r2 DESC, model_name) AS ranking "
    "FROM results"))
def run_summary(spark, sf_dir):
    return round_doubles(RU.summary(RV.model_results(spark, sf_dir)))


@register("flt_in_group", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT model_name, round(test_r2, 6) AS test_r2 FROM results WHERE model_name IN ("
    + ", ".join(f"'{m}'" for m in S.TUNABLE) + ")"))
def flt_in_group(spark, sf_dir):
    return round_doubles(FL.in_group(RV.model_results(spark, sf_dir), "model_name", S.TUNABLE)
                         .select("model_name", "test_r2"))


_ART_CTES = (Q.DEMAND, RV.RUNS, RV.VERSIONS, RV.ARTIFACTS)


def _art(spark, sf_dir):
    v = RV.model_versions(spark, sf_dir)
    return v, RV.recorded_artifacts(v), RV.store_listing(v)


@register("join_missing_artifacts", D(*_ART_CTES, body=
    "SELECT name, version, key FROM recorded WHERE key NOT IN (SELECT key FROM listing)"))
def join_missing_artifacts(spark, sf_dir):
    _, rec, lst = _art(spark, sf_dir)
    return RU.missing_artifacts(rec, lst)


@register("join_artifact_reconcile", D(*_ART_CTES, """rec AS (SELECT r.name, r.version,
  bool_and(l.key IS NOT NULL) AS all_present FROM recorded r LEFT JOIN (SELECT DISTINCT key FROM listing) l USING (key)
  GROUP BY r.name, r.version)""", body=
    "SELECT v.name, v.version, CASE WHEN rec.all_present IS NULL THEN 'missing_in_registry' WHEN rec.all_present "
    "THEN 'synced' ELSE 'missing_in_store' END AS status FROM versions_s v LEFT JOIN rec USING (name, version) "
    "WHERE v.stage = 'Production'"))
def join_artifact_reconcile(spark, sf_dir):
    v, rec, lst = _art(spark, sf_dir)
    latest = W.latest_per(v.select("name", "version"), ["name"], "version")
    return RU.reconcile(latest, rec, lst)


@register("agg_artifact_rollup", D(*_ART_CTES, body=
    "SELECT string_split(key, '/')[2] AS model_dir, count(*) AS files, bool_or(key LIKE '%model.pkl') AS has_model, "
    "bool_or(key LIKE '%scaler.pkl') AS has_scaler FROM listing GROUP BY model_dir"))
def agg_artifact_rollup(spark, sf_dir):
    _, _, lst = _art(spark, sf_dir)
    return RU.artifact_rollup(lst)


@register("run_completeness", D(Q.DEMAND, RV.RESULTS, RV.RUNS, RV.VERSIONS, RV.ARTIFACTS, """best AS (
  SELECT model_name FROM results ORDER BY test_r2 DESC, model_name LIMIT 1),
exp AS (SELECT model_name, 'models/' || lower(translate(model_name, ' -', '__')) || '/model.pkl' AS model_path,
  'models/' || lower(translate(model_name, ' -', '__')) || '/scaler.pkl' AS scaler_path FROM best)""", body=
    "SELECT model_name, model_path, scaler_path, model_path IN (SELECT key FROM listing) AS model_exists, "
    "scaler_path IN (SELECT key FROM listing) AS scaler_exists, model_path IN (SELECT key FROM listing) AS can_load "
    "FROM exp"))
def run_completeness(spark, sf_dir):
    _, _, lst = _art(spark, sf_dir)
    best = RU.best_model(RV.model_results(spark, sf_dir))
    return RU.completeness(RU.expected_paths(best), lst)


@register("join_stats_broadcast", D(Q.DEMAND, body=
    "SELECT obs_id, round(temperature_c - (SELECT avg(temperature_c) FROM demand), 9) AS temp_centered, "
    "round((humidity - (SELECT min(humidity) FROM demand)) / ((SELECT max(humidity) FROM demand) - "
    "(SELECT min(humidity) FROM demand)), 9) AS humidity_minmax FROM demand"))
def join_stats_broadcast(spark, sf_dir):
    d = V.demand(spark, sf_dir)
    d, st = P.with_stats(d, {"m": F.avg("temperature_c"), "mn": F.min("humidity"), "mx": F.max("humidity")})
    return round_doubles(d.select("obs_id", (F.col("temperature_c") - st["m"]).alias("temp_centered"),
                                  ((F.col("humidity") - st["mn"]) / (st["mx"] - st["mn"])).alias("humidity_minmax")), 9)
