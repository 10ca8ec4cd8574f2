"""Registered queries: monitoring (§2.13) and the tagged union (§2.8).

Reference = even ``obs_id`` of ``demand``, current = odd ones with
temperature + 5 and humidity - 10 (the shifted pair); both go through
the feature recipe, so derived columns drift with their inputs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import scalar as X
from demandspark.functions.features import feature_recipe
from demandspark.operators import drift as DR
from demandspark.operators import monitor as MO
from demandspark.plans import sql as Q
from demandspark.plans import views as V
from demandspark.plans.common import round_doubles
from demandspark.plans.registry import register

D = Q.with_ctes
NUM = S.NUMERIC_FEATURES + [S.LABEL]
CAT = S.MONITOR_CATEGORICAL


def _pair(spark, sf_dir, shifted=True):
    ref, cur = V.reference_current(spark, sf_dir, shifted=shifted)
    return feature_recipe(ref), feature_recipe(cur)


PAIR = (Q.DEMAND, Q.REF_CUR_SHIFTED, Q.feat_cte("reference", "fr"), Q.feat_cte("current", "fc"))


def _union_sql(cols, dtype):
    sel = ", ".join(f"CAST({c} AS {dtype}) AS {c}" for c in cols)
    return (f"SELECT 'reference' AS ds, {sel} FROM fr UNION ALL SELECT 'current' AS ds, {sel} FROM fc")


def _counts_sql(name, cols, dtype, src=None):
    src = src or _union_sql(cols, dtype)
    on = ", ".join(cols)
    nan = " AND NOT isnan(value)" if dtype == "DOUBLE" else ""
    return (f"{name} AS (SELECT \"column\", value, count_if(ds = 'reference') AS n_ref, "
            f"count_if(ds = 'current') AS n_cur FROM (UNPIVOT ({src}) ON {on} INTO NAME \"column\" VALUE value) "
            f"WHERE value IS NOT NULL{nan} GROUP BY \"column\", value)")


def _ks_sql() -> str:
    sd = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, stddev_samp(CAST({c} AS DOUBLE)) AS sd FROM fr" for c in NUM)
    return f"""{_counts_sql('nc', NUM, 'DOUBLE')},
cum AS (SELECT *, sum(n_ref) OVER w AS cr, sum(n_cur) OVER w AS cc, lead(value) OVER w2 AS nv,
  sum(n_ref) OVER (PARTITION BY "column") AS nr, sum(n_cur) OVER (PARTITION BY "column") AS ncur FROM nc
  WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w2 AS (PARTITION BY "column" ORDER BY value)),
ks0 AS (SELECT "column", max(abs(cr / nr - cc / ncur)) AS statistic,
  sum(COALESCE(abs(cr / nr - cc / ncur) * (nv - value), 0)) AS wass, first(nr) AS n_ref, first(ncur) AS n_cur
  FROM cum GROUP BY "column"),
sds AS ({sd}),
ks AS (SELECT k.*, sqrt(n_ref * n_cur / (n_ref + n_cur)) * statistic AS lam,
  wass / CASE WHEN sds.sd = 0 THEN 1 ELSE sds.sd END AS wasserstein_norm FROM ks0 k JOIN sds ON k."column" = sds.col),
ksp AS (SELECT *, CASE WHEN lam < 0.2 THEN CAST(1 AS DOUBLE) ELSE least(greatest(2 * (SELECT sum(
  CASE WHEN t.k % 2 = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END * exp(CAST(-2 AS DOUBLE) * t.k * t.k * lam * lam))
  FROM range(1, {DR.KS_TERMS + 1}) t(k)), 0), 1) END AS p_value FROM ks)"""


def _chi_sql() -> str:
    return f"""{_counts_sql('cc', CAT, 'VARCHAR')},
ct AS (SELECT *, sum(n_ref) OVER (PARTITION BY "column") AS nr, sum(n_cur) OVER (PARTITION BY "column") AS ncur FROM cc),
chi AS (SELECT "column", sum(power(n_ref - (n_ref + n_cur) * nr / (nr + ncur), 2) / ((n_ref + n_cur) * nr / (nr + ncur))
  + power(n_cur - (n_ref + n_cur) * ncur / (nr + ncur), 2) / ((n_ref + n_cur) * ncur / (nr + ncur))) AS statistic,
  count(*) - 1 AS dof, first(nr) AS n_ref FROM ct GROUP BY "column")"""


def _mag_sql(bins: int = 10) -> str:
    stats = ", ".join(f"min(CAST({c} AS DOUBLE)) AS {c}__mn, max(CAST({c} AS DOUBLE)) AS {c}__mx" for c in NUM)
    b = ", ".join(
        f"CAST(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN NULL WHEN {c}__mx = {c}__mn THEN 0 ELSE "
        f"least(CAST(floor((CAST({c} AS DOUBLE) - {c}__mn) / ({c}__mx - {c}__mn) * CAST({bins} AS DOUBLE)) AS INTEGER), "
        f"{bins - 1}) END AS VARCHAR) AS {c}" for c in NUM)
    return f"""nu AS ({_union_sql(NUM, 'DOUBLE')}),
nst AS (SELECT {stats} FROM nu),
nb AS (SELECT ds, {b} FROM nu, nst),
{_counts_sql('bc', NUM, 'VARCHAR', 'SELECT * FROM nb')},
{_counts_sql('cc2', CAT, 'VARCHAR')},
allc AS (SELECT * FROM bc UNION ALL SELECT * FROM cc2),
sh AS (SELECT "column", value, n_ref / sum(n_ref) OVER (PARTITION BY "column") AS p,
  n_cur / sum(n_cur) OVER (PARTITION BY "column") AS q FROM allc),
mag AS (SELECT "column", sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END))) AS js_distance,
  sum((greatest(q, {DR.FLOOR}) - greatest(p, {DR.FLOOR})) * ln(greatest(q, {DR.FLOOR}) / greatest(p, {DR.FLOOR}))) AS psi
  FROM sh GROUP BY "column")"""


DRIFT_SQL = f"""{_ks_sql()},
{_chi_sql()},
{_mag_sql()},
dt AS (
  SELECT k."column", 'numeric' AS kind, statistic, p_value, wasserstein_norm, js_distance, psi,
    COALESCE(wasserstein_norm >= 0.1, false) AS drifted
  FROM ksp k LEFT JOIN mag USING ("column")
  UNION ALL
  SELECT c."column", 'categorical', statistic, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), js_distance, psi,
    COALESCE(js_distance >= 0.1, false) FROM chi c LEFT JOIN mag USING ("column"))"""


def _drift(spark, sf_dir, shifted=True):
    ref, cur = _pair(spark, sf_dir, shifted)
    return DR.drift_table(ref, cur, NUM, CAT)


@register("union_tagged", D(Q.DEMAND, Q.REF_CUR_SHIFTED, body=
    "SELECT obs_id, 'reference' AS dataset, temperature_c FROM reference "
    "UNION ALL SELECT obs_id, 'current' AS dataset, temperature_c FROM current"))
def union_tagged(spark, sf_dir):
    ref, cur = V.reference_current(spark, sf_dir, shifted=True)
    return DR.tagged_union(ref.select("obs_id", "temperature_c"), cur.select("obs_id", "temperature_c")) \
        .select("obs_id", "dataset", "temperature_c")


@register("mon_prepare", D(Q.DEMAND, Q.DEMAND_DIRTY, body=
    "SELECT CASE WHEN obs_id % 2 = 0 THEN 'reference' ELSE 'current' END AS dataset, obs_id, COALESCE(temperature_c, 0) AS temperature_c, COALESCE(humidity, 0) AS humidity, "
    "CASE WHEN isnan(wind_speed) OR isinf(wind_speed) THEN 0 ELSE wind_speed END AS wind_speed, "
    "hour, rented_bike_count FROM demand_dirty"))
def mon_prepare(spark, sf_dir):
    ref, cur = V.reference_current(spark, sf_dir, base=V.demand_dirty(spark, sf_dir))
    p = DR.tagged_union(MO.prepare(ref), MO.prepare(cur))
    return p.select("dataset", "obs_id", "temperature_c", "humidity", "wind_speed", "hour", S.LABEL)


@register("mon_drift_numeric", D(*PAIR, _ks_sql(), body=
    "SELECT \"column\", round(statistic, 9) AS statistic, round(p_value, 9) AS p_value, "
    "round(wasserstein_norm, 9) AS wasserstein_norm, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur FROM ksp"))
def mon_drift_numeric(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    r = DR.numeric_drift(ref, cur, NUM)
    return round_doubles(r.select("column", "statistic", "p_value", "wasserstein_norm", "n_ref", "n_cur"), 9)


@register("mon_drift_categorical", D(*PAIR, _chi_sql(), body=
    "SELECT \"column\", round(statistic, 9) AS statistic, dof FROM chi"))
def mon_drift_categorical(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    r = DR.categorical_drift(ref, cur, CAT)
    return round_doubles(r.select("column", "statistic", "dof"), 9)


# P(a, x) as a sum of x^(a+n) e^-x / Gamma(a+n+1)
@register("mon_drift_categorical_p", D(*PAIR, _chi_sql(), body=
    "SELECT \"column\", round(statistic, 6) AS statistic, dof, CASE WHEN dof = 0 THEN NULL WHEN statistic = 0 THEN CAST(1 AS DOUBLE) "
    "ELSE round(greatest(0, 1 - list_sum(list_transform(range(0, 20000), lambda n: exp((dof / CAST(2 AS DOUBLE) + n) * ln(statistic / 2) - statistic / 2 "
    "- lgamma(dof / CAST(2 AS DOUBLE) + n + 1))))), 9) END AS p_value FROM chi"))
def mon_drift_categorical_p(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    t = DR.chi_square_p_values(ref, cur, CAT).select("column", X.round_half_away("statistic", 6).alias("statistic"), "dof", "p_value")
    return t.withColumn("p_value", X.round_half_away("p_value", 9))


@register("mon_drift_magnitude", D(*PAIR, _mag_sql(), body=
    "SELECT \"column\", round(js_distance, 9) AS js_distance, round(psi, 9) AS psi FROM mag"))
def mon_drift_magnitude(spark, sf_dir):
    ref, cur = _pair(spark, sf_dir)
    return round_doubles(DR.binned_magnitudes(ref, cur, NUM, CAT), 9)


@register("mon_drift_table", D(*PAIR, DRIFT_SQL, body=
    "SELECT \"column\", kind, round(statistic, 9) AS statistic, round(p_value, 9) AS p_value, "
    "round(wasserstein_norm, 9) AS wasserstein_norm, round(js_distance, 9) AS js_distance, round(psi, 9) AS psi, "
    "drifted FROM dt"))
def mon_drift_table(spark, sf_dir):
    return round_doubles(_drift(spark, sf_dir), 9)


_SUMMARY_SQL = ("SELECT count_if(drifted) / count(*) >= 0.5 AS drift_detected, "
                "round(count_if(drifted) / count(*), 9) AS drift_score, CAST(count_if(drifted) AS BIGINT) AS drifted_columns, "
                "count(*) AS total_columns FROM dt")


@register("mon_drift_summary", D(*PAIR, DRIFT_SQL, body=_SUMMARY_SQL))
def mon_drift_summary(spark, sf_dir):
    return round_doubles(DR.drift_summary(_drift(spark, sf_dir)), 9)


@register("mon_quality", D(Q.DEMAND, Q.DEMAND_DIRTY, body=
    "SELECT (SELECT count(*) FROM demand_dirty) AS total_rows, CAST(("
    + " + ".join(f"count_if({c} IS NULL" + (f" OR isnan({c})" if c in S.NUMERIC_FEATURES else "") + ")"
                 for c in V.DEMAND_COLS)
    + ") AS BIGINT) AS missing_total, (SELECT CAST(COALESCE(sum(cnt - 1), 0) AS BIGINT) FROM (SELECT count(*) AS cnt "
    "FROM demand_dirty GROUP BY " + ", ".join(V.DEMAND_COLS) + ")) AS duplicate_rows FROM demand_dirty"))
def mon_quality(spark, sf_dir):
    q = MO.quality(V.demand_dirty(spark, sf_dir))
    return q.select("total_rows", "missing_total", "duplicate_rows")


def _col_summary_sql(cols):
    parts = []
    for ds, src in (("reference", "reference"), ("current", "current")):
        for c in cols:
            x = f"CAST({c} AS DOUBLE)"
            parts.append(
                f"SELECT '{ds}' AS dataset, '{c}' AS \"column\", count({c}) AS count, round(avg({x}), 6) AS mean, "
                f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS q25, "
                f"round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75, "
                f"round(max({x}), 6) AS max FROM {src}")
    return "\nUNION ALL\n".join(parts)


_SUMCOLS = ["hour", "rented_bike_count", "temperature_c", "humidity", "wind_speed", "visibility_10m",
            "dew_point_c", "solar_radiation", "rainfall_mm", "snowfall_cm"]


@register("mon_column_summary", D(Q.DEMAND, Q.REF_CUR_SHIFTED, body=_col_summary_sql(_SUMCOLS)))
def mon_column_summary(spark, sf_dir):
    ref, cur = V.reference_current(spark, sf_dir, shifted=True)
    s = MO.column_summary(ref, cur, _SUMCOLS)
    return round_doubles(s.select("dataset", "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


_PERF_SQL = (f"SELECT round(avg(abs(rented_bike_count - ({Q.LINEAR}))), 6) AS mae, "
             f"round(sqrt(avg(power(rented_bike_count - ({Q.LINEAR}), 2))), 6) AS rmse, "
             f"round(1 - sum(power(rented_bike_count - ({Q.LINEAR}), 2)) / (var_pop(rented_bike_count) * count(*)), 6) "
             f"AS r2_score, count(*) AS total_predictions, CAST(NULL AS VARCHAR) AS error FROM current")


@register("mon_performance", D(Q.DEMAND, Q.REF_CUR_SHIFTED, body=_PERF_SQL))
def mon_performance(spark, sf_dir):
    _, cur = V.reference_current(spark, sf_dir, shifted=True)
    return round_doubles(MO.performance(V.linear_pred(cur), S.LABEL, "yhat"))


_ALERTS_SQL = f"""summ AS (SELECT count_if(drifted) / count(*) >= 0.5 AS drift_detected,
  count_if(drifted) / count(*) AS drift_score FROM dt),
perf AS (SELECT 1 - sum(power(rented_bike_count - ({Q.LINEAR}), 2)) / (var_pop(rented_bike_count) * count(*))
  AS r2_score FROM current),
qual AS (SELECT count(*) AS total_rows FROM current)
SELECT 'data_drift' AS type, 'high' AS severity, printf('Data drift detected with score: %.4f', drift_score) AS message
  FROM summ WHERE drift_detected
UNION ALL SELECT 'data_quality', 'medium', printf('Low data volume: %d rows', total_rows) FROM qual WHERE total_rows < 100
UNION ALL SELECT 'model_performance', 'high', printf('Low model performance: R² = %.4f', r2_score) FROM perf
  WHERE r2_score < 0.7"""


@register("mon_alerts", D(*PAIR, DRIFT_SQL, body="SELECT 1").replace("\nSELECT 1", ",\n" + _ALERTS_SQL))
def mon_alerts(spark, sf_dir):
    ref, cur = V.reference_current(spark, sf_dir, shifted=True)
    fr, fc = feature_recipe(ref), feature_recipe(cur)
    summary = DR.drift_summary(DR.drift_table(fr, fc, NUM, CAT))
    q = MO.quality(cur)
    perf = MO.performance(V.linear_pred(cur), S.LABEL, "yhat")
    return MO.alerts(summary, q, perf, with_time=False)


@register("mon_status", D(*PAIR, DRIFT_SQL, body="SELECT 1").replace("\nSELECT 1", f""",
summ AS ({_SUMMARY_SQL}),
miss AS (SELECT CAST(({' + '.join(f"count_if({c} IS NULL)" for c in V.DEMAND_COLS)}) AS BIGINT) AS missing_total FROM current)
SELECT CASE WHEN drift_detected OR missing_total > 0 THEN 'warning' ELSE 'healthy' END AS status,
  concat_ws('; ', CASE WHEN drift_detected THEN 'Data drift detected!' END,
    CASE WHEN missing_total > 0 THEN printf('Found %d missing values', missing_total) END) AS alerts
FROM summ, miss"""))
def mon_status(spark, sf_dir):
    ref, cur = V.reference_current(spark, sf_dir, shifted=True)
    summary = DR.drift_summary(DR.drift_table(feature_recipe(ref), feature_recipe(cur), NUM, CAT))
    st = MO.status(summary, MO.quality(cur))
    return st.select("status", F.array_join("alerts", "; ").alias("alerts"))
