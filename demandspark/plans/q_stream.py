"""Registered queries: streaming jobs (§2.15), run with ``availableNow``
into file sinks under the shared checkpoint folder, then read back.

Append mode emits closed windows only: with a one-hour watermark the
last day of ``events`` never closes, so the oracles keep windows whose
end is at most ``max(ts) - 1 hour``.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark import schema as S
from demandspark.functions.features import feature_recipe
from demandspark.operators import scoring as SCO
from demandspark.plans import q_io as QIO
from demandspark.plans import sql as Q
from demandspark.plans import views as V
from demandspark.plans.common import round_doubles
from demandspark.plans.registry import register
from demandspark.session import scratch_path
from demandspark.sources import sinks as SK
from demandspark.streaming import jobs as J

D = Q.with_ctes


def _events_glob(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events*.parquet"


def _run_to_table(spark, stream, name):
    out, ck = scratch_path(spark, f"{name}_out"), scratch_path(spark, f"{name}_ck")
    J.run_available(stream, ck, out)
    return spark.read.parquet(out)


def _window_out(df):
    return round_doubles(df.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                                   "rows", "null_values", "null_props", "avg_value"))


_Q_AGGS = ("count(*) AS rows, CAST(count_if(value IS NULL OR isnan(value)) AS BIGINT) AS null_values, "
           "CAST(count_if(props IS NULL) AS BIGINT) AS null_props, round(avg(value), 6) AS avg_value")


@register("st_quality_tumbling", f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, {_Q_AGGS}
FROM events GROUP BY date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def st_quality_tumbling(spark, sf_dir):
    s = J.quality_tumbling(J.events_stream(spark, _events_glob(sf_dir)))
    return _window_out(_run_to_table(spark, s, "tumbling"))


@register("st_quality_sliding", f"""WITH w AS (SELECT date_trunc('day', ts) - k * INTERVAL 1 DAY AS ws, value, props
  FROM events, range(0, 30) t(k))
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, {_Q_AGGS} FROM w GROUP BY ws
HAVING ws + INTERVAL 30 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def st_quality_sliding(spark, sf_dir):
    s = J.quality_sliding(J.events_stream(spark, _events_glob(sf_dir)))
    return _window_out(_run_to_table(spark, s, "sliding"))


@register("st_dedup", "SELECT DISTINCT event_id, user_id, event_type FROM events")
def st_dedup(spark, sf_dir):
    """Every event arrives twice (two sources over the same files)."""
    a = J.events_stream(spark, _events_glob(sf_dir))
    b = J.events_stream(spark, _events_glob(sf_dir))
    s = J.dedup(a.unionByName(b)).select("event_id", "user_id", "event_type")
    return _run_to_table(spark, s, "dedup")


_REQ_SCHEMA = T.StructType([T.StructField("obs_id", T.LongType()), *S.REQUEST_SCHEMA.fields])


def _request_files(spark, sf_dir, name, parts=4, base=None):
    """Requests written as several JSON files (micro-batches of a stream)."""
    df = base if base is not None else V.requests_bad(spark, sf_dir)
    return SK.write_json(df.repartition(parts, "obs_id"), scratch_path(spark, name))


@register("st_score", D(Q.DEMAND, QIO.SCORED, body="SELECT * FROM scored"))
def st_score(spark, sf_dir):
    src = _request_files(spark, sf_dir, "requests")
    ok, bad, ck = (scratch_path(spark, n) for n in ("accepted", "rejected", "score_ck"))
    J.score_stream(J.records_stream(spark, src, _REQ_SCHEMA, max_files=1), SCO.linear_predictor(), ok, bad, ck)
    return spark.read.parquet(ok).unionByName(spark.read.parquet(bad)).drop("batch_id")


@register("st_monitor_batch")
def st_monitor_batch(spark, sf_dir):
    ref, cur = V.reference_current(spark, sf_dir, shifted=True)
    src = _request_files(spark, sf_dir, "current", base=cur)
    schema = T.StructType([T.StructField("obs_id", T.LongType()), *S.FACT_SCHEMA.fields])
    stream = feature_recipe(J.records_stream(spark, src, schema, max_files=1))
    report, ck = scratch_path(spark, "batch_reports"), scratch_path(spark, "monitor_ck")
    J.monitor_batches(stream, feature_recipe(ref), S.NUMERIC_FEATURES + [S.LABEL], S.MONITOR_CATEGORICAL,
                      report, ck)
    return spark.read.json(report)


@register("st_performance", """WITH a AS (SELECT event_id, ts + (event_id % 90) * INTERVAL 1 MINUTE AS actual_ts, value * 1.1 AS y
  FROM events WHERE event_type <> 'error'),
j AS (SELECT e.ts, e.value AS yhat, a.y, a.event_id IS NOT NULL AS matched FROM events e LEFT JOIN a
  ON e.event_id = a.event_id AND a.actual_ts >= e.ts AND a.actual_ts <= e.ts + INTERVAL 1 HOUR),
w AS (SELECT least(max(ts), (SELECT max(actual_ts) FROM a)) - INTERVAL 1 HOUR AS passed FROM events)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, CAST(count_if(matched) AS BIGINT) AS n,
 CAST(count_if(NOT matched) AS BIGINT) AS unmatched, round(avg(abs(y - yhat)), 6) AS mae,
 round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse
FROM j GROUP BY date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT passed FROM w) - INTERVAL 1 HOUR""")
def st_performance(spark, sf_dir):
    """Predictions = event values. Actuals come up to 89 minutes later, so
    some miss the bound of an hour, and errors have none at all."""
    ev = J.events_stream(spark, _events_glob(sf_dir))
    preds = ev.select("event_id", "ts", F.col("value").alias("yhat"))
    late = F.make_dt_interval(mins=(F.col("event_id") % 90).cast("int"))
    acts = J.events_stream(spark, _events_glob(sf_dir)).where("event_type <> 'error'").select(
        "event_id", (F.col("ts") + late).alias("actual_ts"), (F.col("value") * 1.1).alias("y"))
    out = _run_to_table(spark, J.performance_stream(preds, acts, "event_id", "ts", "actual_ts"), "performance")
    return round_doubles(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))
