"""Run tables: leaderboard, champion, summaries and artifact checks.

Inputs are tables (``runs``, ``model_versions``, artifact listings), so
every check is a join or an aggregate instead of a per-item client call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions import scalar as X
from demandspark.operators.filters import has_key
from demandspark.operators.windows import argmax


def leaderboard(runs: DataFrame, metric: str = "test_r2") -> DataFrame:
    """Runs that carry ``metric``, flattened with defaults, best first.

    ``rank`` is a window over the runs table (one row per run: metadata,
    not fact rows)."""
    r = has_key(runs, "metrics", metric)
    flat = r.select(
        "run_id",
        X.map_get("params", "model_type", "Unknown").alias("model"),
        X.map_get("metrics", metric, 0.0).alias(metric),
        X.map_get("metrics", "test_rmse", float("inf")).alias("test_rmse"),
        X.map_get("metrics", "test_mae", float("inf")).alias("test_mae"),
        X.map_get("metrics", "overfitting_score", 0.0).alias("overfitting_score"),
        "start_time")
    w = Window.orderBy(F.col(metric).desc(), F.col("run_id"))
    return flat.withColumn("rank", F.row_number().over(w))


def version_runs(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Each model version with its run's metrics (equi-join on run_id)."""
    return versions.join(runs.select("run_id", F.col("metrics").alias("run_metrics")), "run_id", "inner")


def champion(results: DataFrame, versions: DataFrame, runs: DataFrame,
             name: str = "model_name", metric: str = "test_r2") -> DataFrame:
    """Best current result, replaced by a registered *tuned* version only
    when strictly better (ties keep the current one)."""
    cur = results.select(F.col(name).alias("model_name"), "run_id", F.col(metric).alias("r2"),
                         F.lit("current").alias("source"), F.lit(0).alias("pri"))
    tuned = version_runs(versions.where(F.lower("name").contains("tuned")), runs).select(
        F.col("name").alias("model_name"), "run_id",
        F.coalesce(X.map_get("run_metrics", metric), X.map_get("run_metrics", "test_r2_score"),
                   F.lit(0.0)).alias("r2"),
        F.lit("registry").alias("source"), F.lit(1).alias("pri"))
    both = cur.unionByName(tuned)
    best = both.agg(F.min_by(F.struct("model_name", "run_id", "r2", "source"),
                             F.struct(-F.col("r2"), F.col("pri"), F.col("model_name"), F.col("run_id"))).alias("b"))
    return best.select("b.*")


def summary(results: DataFrame, name: str = "model_name") -> DataFrame:
    """Count, best and mean R², mean RMSE and the ranking (names, best first)."""
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("test_r2")).alias("k"), F.col(name).alias("n"))))
    return results.agg(
        F.count(F.lit(1)).alias("models"), F.max("test_r2").alias("best_r2"),
        F.avg("test_r2").alias("avg_r2"), F.avg("test_rmse").alias("avg_rmse"),
        F.array_join(F.transform(ranked, lambda s: s["n"]), ",").alias("ranking"))


def best_model(results: DataFrame, name: str = "model_name") -> DataFrame:
    return argmax(results, "test_r2", name)


def expected_paths(best: DataFrame, name: str = "model_name", prefix: str = "models") -> DataFrame:
    s = X.slug(F.col(name))
    return best.select(F.col(name).alias("model_name"),
                       F.concat_ws("/", F.lit(prefix), s, F.lit("model.pkl")).alias("model_path"),
                       F.concat_ws("/", F.lit(prefix), s, F.lit("scaler.pkl")).alias("scaler_path"))


def completeness(expected: DataFrame, listing: DataFrame, key: str = "key") -> DataFrame:
    """Model and scaler present in the store; loadable when the model is."""
    keys = listing.select(F.col(key).alias("__k")).distinct()
    m = expected.join(keys.withColumn("__m", F.lit(True)), F.col("model_path") == F.col("__k"), "left").drop("__k")
    s = m.join(keys.withColumn("__s", F.lit(True)), F.col("scaler_path") == F.col("__k"), "left").drop("__k")
    return s.select("model_name", "model_path", "scaler_path",
                    F.coalesce("__m", F.lit(False)).alias("model_exists"),
                    F.coalesce("__s", F.lit(False)).alias("scaler_exists"),
                    F.coalesce("__m", F.lit(False)).alias("can_load"))


def missing_artifacts(recorded: DataFrame, listing: DataFrame, key: str = "key") -> DataFrame:
    """Recorded artifact keys that the store does not hold (anti-join)."""
    return recorded.join(listing.select(F.col(key).alias(key)), key, "left_anti")


def reconcile(latest: DataFrame, recorded: DataFrame, listing: DataFrame, key: str = "key") -> DataFrame:
    """Per latest version: ``synced`` when every recorded artifact is in the
    store, ``missing_in_store`` otherwise, ``missing_in_registry`` when it
    records none. Returns one row per model with its status."""
    present = listing.select(F.col(key)).distinct().withColumn("__p", F.lit(True))
    rec = recorded.join(present, key, "left").groupBy("name", "version").agg(
        F.bool_and(F.coalesce("__p", F.lit(False))).alias("all_present"))
    j = latest.select("name", "version").join(rec, ["name", "version"], "left")
    status = (F.when(F.col("all_present").isNull(), "missing_in_registry")
              .when(F.col("all_present"), "synced").otherwise("missing_in_store"))
    return j.select("name", "version", status.alias("status"))


def artifact_rollup(listing: DataFrame, key: str = "key") -> DataFrame:
    """Per model directory: file count, has a model file, has a scaler."""
    parts = F.split(F.col(key), "/")
    d = listing.withColumn("model_dir", F.element_at(parts, 2))
    return d.groupBy("model_dir").agg(
        F.count(F.lit(1)).alias("files"),
        F.bool_or(F.col(key).endswith("model.pkl")).alias("has_model"),
        F.bool_or(F.col(key).endswith("scaler.pkl")).alias("has_scaler"))
