"""Tuning: trial tables, convergence, early stopping and method comparison.

Two kinds of search live here:

* ``sweep_trials`` scores a list of parameter draws of a closed-form
  predictor in ONE aggregate (one expression per trial, one scan, no
  join), giving an exact trials table that SQL can check;
* ``random_search`` / ``continuous_search`` (in ``models``) run Spark ML
  fits per draw via ``CrossValidator`` / ``TrainValidationSplit``.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.operators.windows import running_min


def seeded_draws(space: dict[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` parameter draws from a grid (choice per parameter), seeded."""
    rng = random.Random(seed)
    keys = sorted(space)
    return [{k: rng.choice(list(space[k])) for k in keys} for _ in range(n)]


def uniform_draws(space: dict[str, tuple[float, float]], n: int, seed: int = 42) -> list[dict]:
    """``n`` seeded parameter draws, each uniform in its range (three decimals)."""
    rng = random.Random(seed)
    return [{k: round(rng.uniform(*space[k]), 3) for k in sorted(space)} for _ in range(n)]


def sweep_trials(df: DataFrame, y: str, model_name: str, draws: list[dict],
                 predict: Callable[[dict], Column]) -> DataFrame:
    """Trials table (model_name, trial, params, loss=MSE, r2) for ``draws`` of
    a closed-form predictor, all scored in a single aggregate. ``r2`` is NULL
    where the actuals are constant."""
    aggs = [F.var_pop(y).alias("spread")]
    for i, p in enumerate(draws):
        e = F.col(y) - predict(p)
        aggs.append(F.avg(e * e).alias(f"t{i}"))
    one = df.agg(*aggs)
    rows = []
    for i, p in enumerate(draws):
        params = F.create_map(*[x for k in sorted(p) for x in (F.lit(k), F.lit(str(p[k])))])
        rows.append(F.struct(F.lit(model_name).alias("model_name"), F.lit(i + 1).alias("trial"),
                             params.alias("params"), F.col(f"t{i}").alias("loss"),
                             (1 - F.try_divide(F.col(f"t{i}"), "spread")).alias("r2")))
    return one.select(F.inline(F.array(*rows)))


def convergence(trials: DataFrame) -> DataFrame:
    """Adds ``best_so_far``: running minimum of the loss per model."""
    return running_min(trials, ["model_name"], "trial", "loss", "best_so_far")


def early_stop(trials: DataFrame, patience: int) -> DataFrame:
    """Per model: the trial at which a search that stops after
    ``patience`` trials without a strict improvement ends, and its best
    loss. Trials tables are small (one row per fit)."""
    w = Window.partitionBy("model_name").orderBy("trial")
    prev_best = F.min("loss").over(w.rowsBetween(Window.unboundedPreceding, -1))
    t = trials.withColumn("improved", prev_best.isNull() | (F.col("loss") < prev_best))
    t = t.withColumn("last_imp", F.max(F.when(F.col("improved"), F.col("trial"))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    t = t.withColumn("stop", (F.col("trial") - F.col("last_imp")) >= patience)
    stop_at = t.groupBy("model_name").agg(
        F.coalesce(F.min(F.when(F.col("stop"), F.col("trial"))), F.max("trial")).alias("stop_trial"))
    kept = t.join(stop_at, "model_name").where(F.col("trial") <= F.col("stop_trial"))
    return kept.groupBy("model_name").agg(F.first("stop_trial").alias("stop_trial"),
                                          F.min("loss").alias("best_loss"),
                                          F.count(F.lit(1)).alias("trials_run"))


def compare_methods(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """The trials of two searches beside each other, per model: best RMSE and
    its R2, the second's gain in both, the RMSE ratio and the winner (lower
    RMSE, ties -> first)."""
    def best(t: DataFrame, name: str) -> DataFrame:
        return t.groupBy("model_name").agg(F.sqrt(F.min("loss")).alias(f"rmse_{name}"),
                                           F.min_by("r2", "loss").alias(f"r2_{name}"),
                                           F.count(F.lit(1)).alias(f"trials_{name}"))
    j = best(a, name_a).join(best(b, name_b), "model_name")
    ra, rb = F.col(f"rmse_{name_a}"), F.col(f"rmse_{name_b}")
    return j.select("model_name", ra, rb, f"r2_{name_a}", f"r2_{name_b}", f"trials_{name_a}", f"trials_{name_b}",
                    (ra - rb).alias("improvement"), (F.col(f"r2_{name_b}") - F.col(f"r2_{name_a}")).alias("r2_gain"),
                    F.try_divide(rb, ra).alias("ratio"), F.when(rb < ra, F.lit(name_b)).otherwise(F.lit(name_a)).alias("winner"))
