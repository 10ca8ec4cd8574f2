"""Validated batch scoring with a reject branch.

The per-request loop with try/except becomes one partition-parallel
projection: every row is validated and scored, and rows failing
validation are masked into the reject form (NULL prediction, confidence
0, reasons). The same function serves batch files and streams.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import features as FE
from demandspark.functions import scalar as X
from demandspark.operators import filters as FL

Predictor = Callable[[DataFrame], DataFrame]  # adds column "yhat"


def linear_predictor(temp: float = 15.0, hour: float = 25.0, intercept: float = 250.0) -> Predictor:
    """A closed-form predictor (exact SQL twin), e.g. for tests and oracles."""
    def predict(df: DataFrame) -> DataFrame:
        return df.withColumn("yhat", (F.lit(temp) * F.col("temperature_c")
                                      + F.lit(hour) * (18 - F.abs(F.col("hour") - 18))) + F.lit(intercept))
    return predict


def model_predictor(model, prediction_col: str = "prediction") -> Predictor:
    """Wrap a fitted ``PipelineModel`` (assembler [+ scaler] + regressor).

    The assemblers are switched to keep invalid values (NaN) so rejected
    rows flow through in the same pass and are masked afterwards."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    stages = []
    for st in model.stages:
        if isinstance(st, VectorAssembler):
            st = st.copy({st.handleInvalid: "keep"})
        stages.append(st)
    scoring_model = PipelineModel(stages)

    def predict(df: DataFrame) -> DataFrame:
        out = scoring_model.transform(FE.features(df, label=None,
                                                  keep=[c for c in df.columns if c not in S.FEATURES]))
        return out.withColumnRenamed(prediction_col, "yhat")
    return predict


def score_batch(requests: DataFrame, predictor: Predictor, index: str = "obs_id",
                date_format: str = "d/M/yyyy", confidence: float = S.CONFIDENCE,
                keep: Sequence[str] = ()) -> DataFrame:
    """(``keep`` as requested..., index, prediction bigint, confidence, status, error) per request.

    One pass: every row is validated, featurised and scored, and the
    final projection masks rows that failed validation (NULL prediction,
    confidence 0, status ``error`` with the reasons). No union, so the
    requests are read once."""
    # the request's own values ride along, untouched by padding and features
    v = FL.validate(requests.withColumn("__request", F.struct(*keep)) if keep else requests)
    parsed = X.parse_date("date", date_format)
    bad_date = F.col("date").isNotNull() & parsed.isNull()
    v = v.withColumn("reasons", F.when(bad_date, F.array_append("reasons", F.lit("invalid date")))
                     .otherwise(F.col("reasons")))
    v = v.withColumn("valid", F.size("reasons") == 0)
    feats = FE.pad_missing(FE.feature_recipe(v, date_format=date_format))
    ok = F.col("valid")
    return predictor(feats).select(
        *[F.col("__request")[c].alias(c) for c in keep],
        F.col(index).alias("index"),
        F.when(ok, X.clip_round("yhat")).alias("prediction"),
        F.when(ok, F.lit(float(confidence))).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(ok, F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.array_join("reasons", "; ")).alias("error"))


def score_totals(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("total_requests"),
                      F.count_if(F.col("status") == "success").alias("successful_predictions"))
