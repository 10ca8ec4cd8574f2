"""Result, run, version and artifact tables derived from ``demand``.

A fixed family of named linear predictors stands in for fitted models so
every run table has an exact SQL twin: results come from scoring the
whole table (stratified split), runs from scoring each year of it, so
their work grows with the data. Versions, recorded artifacts and the
store listing follow from the runs by fixed rules (newest version is in
production; the store keeps the three newest versions plus a current
copy of the production model).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import scalar as X
from demandspark.operators import evaluate as EV
from demandspark.operators import split as SP
from demandspark.plans import views as V

# Stand-in models (name, temperature coef, hour-shape coef, intercept).
CANDIDATES = [
    ("Linear Regression", 15.0, 25.0, 250.0),
    ("Ridge Regression", 14.0, 25.0, 260.0),
    ("Lasso Regression", 15.0, 25.0, 250.0),
    ("Elastic Net", 12.0, 22.0, 300.0),
    ("Random Forest", 16.0, 26.0, 230.0),
    ("Gradient Boosting", 15.0, 24.0, 255.0),
    ("Random Forest (tuned)", 15.0, 25.0, 245.0),
    ("Gradient Boosting (tuned)", 15.0, 24.0, 255.0),
]
KEEP_VERSIONS = 3


def _yhat(a: float, b: float, c: float):
    return (F.lit(a) * F.col("temperature_c") + F.lit(b) * (18 - F.abs(F.col("hour") - 18))) + F.lit(c)


def _yhat_sql(a: float, b: float, c: float) -> str:
    return (f"(CAST({a!r} AS DOUBLE) * temperature_c + CAST({b!r} AS DOUBLE) * (18 - abs(hour - 18))) "
            f"+ CAST({c!r} AS DOUBLE)")


def candidate_long(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (input row, candidate): an in-stage Generate, no join;
    the aggregate after it combines map-side to one row per candidate."""
    arr = F.array(*[F.struct(F.lit(n).alias("model_name"), _yhat(a, b, c).alias("yhat"))
                    for n, a, b, c in CANDIDATES])
    return df.select(*keep, F.inline(arr))


def candidate_long_sql(src: str, keep: list[str]) -> str:
    k = ", ".join(keep)
    return "\nUNION ALL\n".join(f"SELECT {k}, '{n}' AS model_name, {_yhat_sql(a, b, c)} AS yhat FROM {src}"
                                for n, a, b, c in CANDIDATES)


def split_demand(spark, sf_dir) -> DataFrame:
    return SP.stratified(V.demand(spark, sf_dir), "obs_id", S.LABEL)


def _bin_sql(col: str, n: int = 5) -> str:
    return " + ".join(f"CAST({col} > mn + {i}*((mx - mn)/CAST({n} AS DOUBLE)) AS INTEGER)" for i in range(1, n))


def _h(key: str = "obs_id", seed: int = 42) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|{seed}')"


SPLIT = f"""s1 AS (SELECT demand.*, {_bin_sql('rented_bike_count')} AS s1 FROM demand,
  (SELECT min(rented_bike_count) AS mn, max(rented_bike_count) AS mx FROM demand)),
r1 AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY {_h()}, obs_id) AS rk,
  count(*) OVER (PARTITION BY s1) AS n FROM s1),
t1 AS (SELECT * EXCLUDE (rk, n), rk <= round(n * 0.2) AS is_test FROM r1),
rest AS (SELECT * EXCLUDE (s1, is_test) FROM t1 WHERE NOT is_test),
s2 AS (SELECT rest.*, {_bin_sql('rented_bike_count')} AS s2 FROM rest,
  (SELECT min(rented_bike_count) AS mn, max(rented_bike_count) AS mx FROM rest)),
r2 AS (SELECT *, row_number() OVER (PARTITION BY s2 ORDER BY {_h()}, obs_id) AS rk,
  count(*) OVER (PARTITION BY s2) AS n FROM s2),
split AS (SELECT * EXCLUDE (rk, n, s2), CASE WHEN rk <= round(n * 0.25) THEN 'val' ELSE 'train' END AS split FROM r2
  UNION ALL SELECT * EXCLUDE (s1, is_test), 'test' AS split FROM t1 WHERE is_test)"""


METRIC_PLACES = 9


def _stable(df: DataFrame, cols) -> DataFrame:
    """Metrics rounded to 9 places: sums of doubles differ in the last bits
    with the merge order of partial aggregates, and candidates with equal
    coefficients must tie exactly so rankings break ties by name."""
    return df.withColumns({c: X.round_half_away(c, METRIC_PLACES) for c in cols})


def model_results(spark, sf_dir) -> DataFrame:
    long = candidate_long(split_demand(spark, sf_dir), ["split", S.LABEL])
    t = EV.model_table(long, "model_name", "split", S.LABEL, "yhat")
    t = _stable(t, [c for c in t.columns if c != "model_name"])
    return t.withColumn("run_id", F.concat(F.lit("run-"), X.slug("model_name")))


def _metric_sql(s: str) -> str:
    e = f"CASE WHEN split = '{s}' THEN rented_bike_count - yhat END"
    y = f"CASE WHEN split = '{s}' THEN rented_bike_count END"
    fin = "CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN 0 ELSE {x} END"
    r2 = f"1 - sum(({e})*({e})) / (var_pop({y}) * count({y}))"
    rmse = f"sqrt(avg(({e})*({e})))"
    mae = f"avg(abs({e}))"
    mape = (f"COALESCE(100 * avg(CASE WHEN split = '{s}' AND rented_bike_count <> 0 THEN "
            f"abs((rented_bike_count - yhat) / rented_bike_count) END), 0)")
    return ", ".join(f"{fin.format(x=v)} AS {s}_{k}" for k, v in
                     (("r2", r2), ("rmse", rmse), ("mae", mae), ("mape", mape)))


RESULTS = f"""{SPLIT},
cl AS ({candidate_long_sql('split', ['split', 'rented_bike_count'])}),
mt AS (SELECT model_name, {_metric_sql('train')}, {_metric_sql('test')} FROM cl GROUP BY model_name),
results AS (SELECT model_name, {', '.join(f"round({s_}_{m_}, 9) AS {s_}_{m_}" for s_ in ("train", "test")
  for m_ in ("r2", "rmse", "mae", "mape"))},
  round(CASE WHEN isnan(train_rmse - test_rmse) OR isinf(train_rmse - test_rmse) THEN 0
  ELSE train_rmse - test_rmse END, 9) AS overfit_score,
  'run-' || lower(translate(model_name, ' -', '__')) AS run_id FROM mt)"""


def _year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year(X.parse_date("date")))


def runs(spark, sf_dir) -> DataFrame:
    """One run per (candidate, year): metrics map (finite values only),
    params and tags maps; the schema of ``schema.RUNS_SCHEMA``."""
    long = candidate_long(_year(V.demand(spark, sf_dir)), ["year", S.LABEL])
    m = _stable(EV.regression_metrics(long, S.LABEL, "yhat", group_by=["model_name", "year"]),
                ["r2", "rmse", "mae", "mape"])
    params = {n: (a, b, c) for n, a, b, c in CANDIDATES}
    coef = {k: F.coalesce(*[F.when(F.col("model_name") == n, F.lit(str(v[i]))) for n, v in params.items()])
            for i, k in enumerate(("temp_coef", "hour_coef", "intercept"))}
    metrics = F.map_filter(F.create_map(
        F.lit("test_r2"), F.col("r2"), F.lit("test_rmse"), F.col("rmse"), F.lit("test_mae"), F.col("mae"),
        F.lit("test_mape"), F.col("mape")), lambda k, v: X.is_finite(v))
    tuned = F.lower("model_name").contains("tuned")
    return m.select(
        F.concat(X.slug("model_name"), F.lit("-"), F.col("year").cast("string")).alias("run_id"),
        F.col("model_name").alias("model_type"),
        F.make_timestamp(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("start_time"),
        F.create_map(F.lit("model_type"), F.col("model_name"), F.lit("temp_coef"), coef["temp_coef"],
                     F.lit("hour_coef"), coef["hour_coef"], F.lit("intercept"), coef["intercept"]).alias("params"),
        metrics.alias("metrics"),
        F.create_map(F.lit("tuned"), F.when(tuned, "true").otherwise("false"),
                     F.lit("year"), F.col("year").cast("string")).alias("tags"))


RUNS = f"""yr AS (SELECT CAST(year(CAST(strptime(date, '%d/%m/%Y') AS DATE)) AS INTEGER) AS year,
  rented_bike_count, temperature_c, hour FROM demand),
ycl AS ({candidate_long_sql('yr', ['year', 'rented_bike_count'])}),
rm AS (SELECT model_name, year,
  1 - sum((rented_bike_count - yhat)*(rented_bike_count - yhat)) / (var_pop(rented_bike_count) * count(rented_bike_count)) AS r2,
  sqrt(avg((rented_bike_count - yhat)*(rented_bike_count - yhat))) AS rmse, avg(abs(rented_bike_count - yhat)) AS mae,
  COALESCE(100 * avg(CASE WHEN rented_bike_count <> 0 THEN abs((rented_bike_count - yhat) / rented_bike_count) END), 0) AS mape
  FROM ycl GROUP BY model_name, year),
runs AS (SELECT lower(translate(model_name, ' -', '__')) || '-' || CAST(year AS VARCHAR) AS run_id,
  model_name AS model_type, year, CAST(make_timestamp(year, 1, 1, 0, 0, 0) AS TIMESTAMP) AS start_time,
  CASE WHEN isfinite(r2) THEN round(r2, 9) END AS test_r2, CASE WHEN isfinite(rmse) THEN round(rmse, 9) END AS test_rmse,
  CASE WHEN isfinite(mae) THEN round(mae, 9) END AS test_mae, CASE WHEN isfinite(mape) THEN round(mape, 9) END AS test_mape,
  CASE WHEN lower(model_name) LIKE '%tuned%' THEN 'true' ELSE 'false' END AS tuned FROM rm)"""


def model_versions(spark, sf_dir, runs_df: DataFrame | None = None) -> DataFrame:
    """Registered versions: one per run, numbered by year within the model.
    The window partitions by model name; each group holds one row per
    year of data (metadata, not fact rows)."""
    r = runs_df if runs_df is not None else runs(spark, sf_dir)
    w = Window.partitionBy("name").orderBy("start_time")
    v = r.select(F.col("model_type").alias("name"), "run_id", "tags", "start_time").withColumn(
        "version", F.row_number().over(w).cast("int"))
    latest = F.max("version").over(Window.partitionBy("name"))
    return v.select("name", "version", "run_id",
                    F.when(F.col("version") == latest, "Production").otherwise("Archived").alias("stage"),
                    "tags")


VERSIONS = """versions AS (SELECT model_type AS name, CAST(row_number() OVER (PARTITION BY model_type ORDER BY start_time) AS INTEGER)
  AS version, run_id, tuned FROM runs),
versions_s AS (SELECT *, CASE WHEN version = max(version) OVER (PARTITION BY name) THEN 'Production' ELSE 'Archived' END
  AS stage FROM versions)"""


def recorded_artifacts(versions: DataFrame) -> DataFrame:
    """Artifact keys each version records: the model, plus the scaler for
    scale-sensitive models."""
    s = X.slug("name")
    base = F.concat(F.lit("models/"), s, F.lit("/v"), F.col("version").cast("string"), F.lit("/"))
    files = F.when(X.in_set("name", S.SCALE_SENSITIVE), F.array(F.lit("model.pkl"), F.lit("scaler.pkl"))) \
        .otherwise(F.array(F.lit("model.pkl")))
    return versions.select("name", "version", F.explode(files).alias("file"), base.alias("base")).select(
        "name", "version", F.concat("base", "file").alias("key"))


def store_listing(versions: DataFrame) -> DataFrame:
    """What the artifact store holds: the newest ``KEEP_VERSIONS`` versions
    of each model plus a current copy of the production version."""
    rec = recorded_artifacts(versions)
    maxv = versions.groupBy("name").agg(F.max("version").alias("maxv"))
    kept = rec.join(maxv, "name").where(F.col("version") > F.col("maxv") - KEEP_VERSIONS)
    cur = kept.where(F.col("version") == F.col("maxv")).select(
        F.concat(F.lit("models/"), X.slug("name"), F.lit("/"), F.element_at(F.split("key", "/"), -1)).alias("key"))
    return kept.select("key").unionByName(cur)


ARTIFACTS = f"""recorded AS (
  SELECT name, version, 'models/' || lower(translate(name, ' -', '__')) || '/v' || CAST(version AS VARCHAR) || '/model.pkl' AS key
  FROM versions_s
  UNION ALL
  SELECT name, version, 'models/' || lower(translate(name, ' -', '__')) || '/v' || CAST(version AS VARCHAR) || '/scaler.pkl'
  FROM versions_s WHERE name IN ({', '.join("'" + n + "'" for n in S.SCALE_SENSITIVE)})),
kept AS (SELECT r.*, m.maxv FROM recorded r JOIN (SELECT name, max(version) AS maxv FROM versions_s GROUP BY name) m
  USING (name) WHERE version > maxv - {KEEP_VERSIONS}),
listing AS (SELECT key FROM kept UNION ALL
  SELECT 'models/' || lower(translate(name, ' -', '__')) || '/' || string_split(key, '/')[-1] AS key
  FROM kept WHERE version = maxv)"""
