"""Registered queries: sources (§2.1), sinks (§2.2) and scoring (§2.14).

Sink checks write data derived from the tables to a fresh folder under
the shared checkpoint directory and read it back; source checks read
files written the same way.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark import schema as S
from demandspark.operators import runs as RU
from demandspark.operators import scoring as SCO
from demandspark.plans import run_views as RV
from demandspark.plans import sql as Q
from demandspark.plans import q_model as QMOD
from demandspark.plans import q_monitor as QM
from demandspark.plans import views as V
from demandspark.plans.common import round_doubles
from demandspark.plans.registry import register
from demandspark.session import scratch_path
from demandspark.sources import readers as RD
from demandspark.sources import sinks as SK

D = Q.with_ctes
RAW = {v: k for k, v in S.RENAME_MAP.items()}
FACT = [f.name for f in S.FACT_SCHEMA.fields]
OBS = T.StructField("obs_id", T.LongType())


def _write_raw_csv(spark, sf_dir) -> str:
    """The demand table as the original CSV export: raw headers, Latin-1."""
    d = V.demand(spark, sf_dir).select("obs_id", *[F.col(c).alias(f"{RAW[c]} ") for c in FACT])
    return SK.write_csv(d, scratch_path(spark, "raw_csv"), encoding="ISO-8859-1")


# --- §2.1 sources -------------------------------------------------------------------

@register("src_demand_csv", D(Q.DEMAND, body="SELECT * FROM demand"))
def src_demand_csv(spark, sf_dir):
    path = _write_raw_csv(spark, sf_dir)
    schema = T.StructType([OBS, *S.RAW_CSV_SCHEMA.fields])
    return RD.read_demand_csv(spark, path, schema=schema).select(*V.DEMAND_COLS)


@register("src_first_available", D(Q.DEMAND, body="SELECT * FROM demand"))
def src_first_available(spark, sf_dir):
    path = _write_raw_csv(spark, sf_dir)
    missing = scratch_path(spark, "absent")
    schema = T.StructType([OBS, *S.RAW_CSV_SCHEMA.fields])
    return RD.read_demand_csv(spark, [missing, path], schema=schema).select(*V.DEMAND_COLS)


_INFERRED = ", ".join(f"CAST({c} AS INTEGER) AS {c}" if c in ("obs_id", "hour", "rented_bike_count") else c
                      for c in V.DEMAND_COLS)


@register("src_snapshot_csv", D(Q.DEMAND, Q.REF_CUR, body=f"SELECT {_INFERRED} FROM reference"))
def src_snapshot_csv(spark, sf_dir):
    ref, _ = V.reference_current(spark, sf_dir)
    path = SK.write_csv(ref, scratch_path(spark, "snapshot"))
    return RD.read_snapshot_csv(spark, path)


@register("src_records", D(Q.DEMAND, Q.REQUESTS_BAD, body="SELECT * FROM requests_bad"))
def src_records(spark, sf_dir):
    path = SK.write_json(V.requests_bad(spark, sf_dir), scratch_path(spark, "records"))
    schema = T.StructType([OBS, *S.REQUEST_SCHEMA.fields])
    return RD.read_records(spark, path, schema)


@register("src_records_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def src_records_props(spark, sf_dir):
    e = RD.parse_records(V.table(spark, sf_dir, "events"), "props", "k bigint")
    return e.select("event_id", F.col("record.k").alias("k"))


def _results(spark, sf_dir):
    return RV.model_results(spark, sf_dir)


_BEST = ("SELECT model_name, 'models/' || lower(translate(model_name, ' -', '__')) || '/model.pkl' AS model_path, "
         "'models/' || lower(translate(model_name, ' -', '__')) || '/scaler.pkl' AS scaler_path{} "
         "FROM results ORDER BY results.test_r2 DESC, model_name LIMIT 1")


@register("src_json_marker", D(Q.DEMAND, RV.RESULTS, body=_BEST.format(
    ", round(test_r2, 6) AS test_r2, round(test_rmse, 6) AS test_rmse, run_id")))
def src_json_marker(spark, sf_dir):
    best = RU.best_model(_results(spark, sf_dir))
    marker = RU.expected_paths(best).join(best.select("model_name", "test_r2", "test_rmse", "run_id"), "model_name")
    path = SK.write_best_marker(marker, scratch_path(spark, "best_marker"))
    return round_doubles(RD.read_json_marker(spark, path))


@register("src_artifact_listing")
def src_artifact_listing(spark, sf_dir):
    """Files of a written model-results folder, partitioned per model."""
    base = scratch_path(spark, "store")
    _results(spark, sf_dir).withColumn("model_dir", F.regexp_replace(F.lower("model_name"), "[^a-z]+", "_")) \
        .write.partitionBy("model_dir").json(base)
    return RD.artifact_listing(spark, base)


# --- §2.2 sinks (write, read back) -----------------------------------------------------

def _reason_parts():
    parts = []
    for n, (lo, hi) in S.REQUEST_LIMITS.items():
        nan = f" OR isnan({n})" if n in ("temperature_c", "humidity", "wind_speed", "visibility_10m", "dew_point_c",
                                         "solar_radiation", "rainfall_mm", "snowfall_cm") else ""
        parts.append(f"CASE WHEN {n} IS NULL{nan} THEN 'missing {n}' END")
        if lo is not None:
            parts.append(f"CASE WHEN {n} < {lo} THEN '{n} below {lo}' END")
        if hi is not None:
            parts.append(f"CASE WHEN {n} > {hi} THEN '{n} above {hi}' END")
    parts.append("CASE WHEN date IS NOT NULL AND try_strptime(date, '%d/%m/%Y') IS NULL THEN 'invalid date' END")
    return parts


SCORED = f"""{Q.REQUESTS_BAD},
val AS (SELECT *, concat_ws('; ', {', '.join(_reason_parts())}) AS reasons FROM requests_bad),
scored AS (SELECT obs_id AS "index",
  CASE WHEN reasons = '' THEN CAST(greatest(0, roundbankers({Q.LINEAR}, 0)) AS BIGINT) END AS prediction,
  CASE WHEN reasons = '' THEN CAST(0.85 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS confidence,
  CASE WHEN reasons = '' THEN 'success' ELSE 'error' END AS status,
  CASE WHEN reasons = '' THEN NULL ELSE reasons END AS error FROM val)"""


def _scored(spark, sf_dir):
    return SCO.score_batch(V.requests_bad(spark, sf_dir), SCO.linear_predictor())


@register("score_batch", D(Q.DEMAND, SCORED, body="SELECT * FROM scored"))
def score_batch(spark, sf_dir):
    return _scored(spark, sf_dir)


@register("score_totals", D(Q.DEMAND, SCORED, body=
    "SELECT count(*) AS total_requests, CAST(count_if(status = 'success') AS BIGINT) AS successful_predictions FROM scored"))
def score_totals(spark, sf_dir):
    return SCO.score_totals(_scored(spark, sf_dir))


_PRED_SCHEMA = T.StructType([OBS, *S.REQUEST_SCHEMA.fields, T.StructField("predicted_bike_count", T.LongType())])


@register("sink_predictions_csv", D(Q.DEMAND, SCORED, body=
    "SELECT r.*, s.prediction AS predicted_bike_count FROM requests_bad r JOIN scored s ON r.obs_id = s.\"index\""))
def sink_predictions_csv(spark, sf_dir):
    req = V.requests_bad(spark, sf_dir)
    s = SCO.score_batch(req, SCO.linear_predictor(), keep=req.columns)
    path = SK.write_csv(s.select(*req.columns, F.col("prediction").alias("predicted_bike_count")), scratch_path(spark, "predictions"))
    return spark.read.option("header", True).schema(_PRED_SCHEMA).csv(path)


_RES_SCHEMA = S.MODEL_RESULTS_SCHEMA


@register("sink_results_csv", D(Q.DEMAND, RV.RESULTS, body="SELECT " + ", ".join(
    f"round({f.name}, 6) AS {f.name}" if f.dataType == T.DoubleType() else f.name for f in _RES_SCHEMA.fields)
    + " FROM results"))
def sink_results_csv(spark, sf_dir):
    base = scratch_path(spark, "results")
    stamp = SK.write_results(_results(spark, sf_dir).select(*_RES_SCHEMA.fieldNames()), base)
    back = spark.read.option("header", True).schema(_RES_SCHEMA).csv(f"{base}/training_results/run_ts={stamp}")
    return round_doubles(back)


@register("sink_summary_json", D(Q.DEMAND, RV.RESULTS, body=
    "SELECT count(*) AS total_models_trained, (SELECT model_name FROM results ORDER BY test_r2 DESC, model_name "
    "LIMIT 1) AS best_model, "
    "round(max(test_r2), 6) AS best_r2_score, string_agg(model_name, ',' ORDER BY test_r2 DESC, model_name) AS ranking "
    "FROM results"))
def sink_summary_json(spark, sf_dir):
    r = _results(spark, sf_dir)
    ranks = F.sort_array(F.collect_list(F.struct((-F.col("test_r2")).alias("k"), F.col("model_name"),
                                                 F.col("test_r2"), F.col("test_rmse"))))
    summary = r.agg(F.count(F.lit(1)).alias("total_models_trained"),
                    F.min_by("model_name", F.struct(-F.col("test_r2"), F.col("model_name"))).alias("best_model"),
                    F.max("test_r2").alias("best_r2_score"),
                    F.transform(ranks, lambda s: s.dropFields("k")).alias("model_rankings"))
    path = SK.write_json(summary, scratch_path(spark, "summary"))
    back = spark.read.json(path)
    return round_doubles(back.select("total_models_trained", "best_model", "best_r2_score",
                                     F.array_join(F.transform("model_rankings", lambda s: s["model_name"]), ",")
                                     .alias("ranking")))


@register("sink_best_marker", D(Q.DEMAND, RV.RESULTS, body=_BEST.format("")))
def sink_best_marker(spark, sf_dir):
    best = RU.best_model(_results(spark, sf_dir))
    path = scratch_path(spark, "marker")
    SK.write_best_marker(RU.expected_paths(best), path)
    SK.write_best_marker(RU.expected_paths(best), path)  # overwritten, not appended
    return RD.read_json_marker(spark, path)


@register("sink_report_json", D(*QM.PAIR, QM.DRIFT_SQL, body="SELECT \"column\", kind, drifted, 'drift' AS \"check\", "
                                     "'2024-01-31' AS report_date FROM dt"))
def sink_report_json(spark, sf_dir):
    base = scratch_path(spark, "reports")
    SK.write_report(QM._drift(spark, sf_dir).select("column", "kind", "drifted"), base, "drift", "2024-01-31")
    back = spark.read.json(base)
    return back.select("column", "kind", "drifted", "check", F.col("report_date").cast("string").alias("report_date"))


@register("sink_trials_csv", D(Q.DEMAND, QMOD._trials_sql(), body="SELECT model_name, trial, temp_coef, hour_coef, intercept, round(loss, 6) AS loss FROM trials"))
def sink_trials_csv(spark, sf_dir):
    path = SK.write_csv(QMOD._flat_trials(QMOD._trials(spark, sf_dir)), scratch_path(spark, "trials"))
    schema = "model_name string, trial int, temp_coef int, hour_coef int, intercept int, loss double"
    return round_doubles(spark.read.option("header", True).schema(schema).csv(path))


@register("sink_snapshot_csv", D(Q.DEMAND, Q.REF_CUR, body="SELECT * FROM current"))
def sink_snapshot_csv(spark, sf_dir):
    _, cur = V.reference_current(spark, sf_dir)
    path = SK.write_csv(cur, scratch_path(spark, "current"))
    schema = T.StructType([OBS, *S.FACT_SCHEMA.fields])
    back = spark.read.option("header", True).schema(T.StructType(
        [schema[c] for c in V.DEMAND_COLS])).csv(path)
    return back

