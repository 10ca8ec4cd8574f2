"""Registered queries: projections, filters and scalar functions (§2.3-2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import features as FE
from demandspark.functions import scalar as X
from demandspark.operators import filters as FL
from demandspark.operators import profile as P
from demandspark.operators import projection as PR
from demandspark.plans import sql as Q
from demandspark.plans import views as V
from demandspark.plans.common import feat, round_doubles
from demandspark.plans.registry import register

D = Q.with_ctes
FACT = [f.name for f in S.FACT_SCHEMA.fields]
RAW = {v: k for k, v in S.RENAME_MAP.items()}


def _raw_demand(spark, sf_dir, pad=True):
    d = V.demand(spark, sf_dir)
    return d.select("obs_id", *[F.col(c).alias(f" {RAW[c]} " if pad else RAW[c]) for c in FACT])


# --- §2.3 projections --------------------------------------------------------

@register("proj_trim_names", D(Q.DEMAND, body="SELECT obs_id, " + ", ".join(
    f'{c} AS "{RAW[c]}"' for c in FACT) + " FROM demand"))
def proj_trim_names(spark, sf_dir):
    return PR.trim_names(_raw_demand(spark, sf_dir))


@register("proj_rename", D(Q.DEMAND, body="SELECT * FROM demand"))
def proj_rename(spark, sf_dir):
    return PR.rename(PR.trim_names(_raw_demand(spark, sf_dir)), S.RENAME_MAP)


@register("proj_select_dtypes", D(Q.DEMAND, body=
    "SELECT obs_id, hour, rented_bike_count, temperature_c, humidity, wind_speed, visibility_10m, "
    "dew_point_c, solar_radiation, rainfall_mm, snowfall_cm FROM demand"))
def proj_select_dtypes(spark, sf_dir):
    return PR.select_dtypes(V.demand(spark, sf_dir), "numeric")


@register("proj_drop_exclude", D(Q.DEMAND, body=
    "SELECT obs_id, hour, temperature_c, humidity, wind_speed, visibility_10m, "
    "dew_point_c, solar_radiation, rainfall_mm, snowfall_cm FROM demand"))
def proj_drop_exclude(spark, sf_dir):
    return PR.drop_exclude(V.demand(spark, sf_dir), exclude=[S.LABEL], keep=["obs_id"])


_CYC = ["hour_sin", "hour_cos", "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"]


def _round_cyc(df):
    """Round only the transcendental columns; every other double is the
    same IEEE operation sequence in both engines."""
    return df.withColumns({c: X.round_half_away(c, 9) for c in _CYC if c in df.columns})


def _feature_sql(cols: list[str], src: str = "feat") -> str:
    out = []
    for c in cols:
        if c in _CYC:  # libm sin/cos may differ in the last bit between engines
            out.append(f"round({c}, 9) AS {c}")
        elif c == "date":
            out.append("CAST(date AS VARCHAR) AS date")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {src}"


@register("proj_features", D(Q.DEMAND, Q.FEAT, body=_feature_sql(["obs_id"] + S.FEATURES + [S.LABEL])))
def proj_features(spark, sf_dir):
    return _round_cyc(FE.features(feat(spark, sf_dir), keep=["obs_id"]))


# Requests arrive without the two categorical columns: defaults fill them.
@register("proj_pad_missing", D(Q.DEMAND, Q.FEAT, body=_feature_sql(
    ["obs_id"] + S.NUMERIC_FEATURES + S.BINARY_FEATURES).replace(" FROM feat", ", "
    "0 AS time_of_day_Night, 1 AS time_of_day_Morning, 0 AS time_of_day_Afternoon, 0 AS time_of_day_Evening, "
    "0 AS temp_feel_Very_Cold, 0 AS temp_feel_Cold, 1 AS temp_feel_Mild, 0 AS temp_feel_Warm FROM feat")))
def proj_pad_missing(spark, sf_dir):
    req = V.demand(spark, sf_dir).drop(S.LABEL)
    f = FE.feature_recipe(req, one_hot=False).drop("time_of_day", "temp_feel")
    f = FE.pad_missing(f, expected=S.NUMERIC_FEATURES + S.BINARY_FEATURES)
    oh = {**FE.one_hot_columns("time_of_day", S.TIME_OF_DAY_LABELS),
          **FE.one_hot_columns("temp_feel", S.TEMP_FEEL_LABELS)}
    return _round_cyc(FE.features(f.withColumns(oh), label=None, keep=["obs_id"]))


@register("proj_assemble")
def proj_assemble(spark, sf_dir):
    f = FE.features(feat(spark, sf_dir), keep=["obs_id"])
    # every row stays: a NULL feature would be an error here, never a dropped row
    return PR.assemble(f, S.FEATURES, handle_invalid="error").select("obs_id", "features", S.LABEL)


_SEASON_METRICS_SQL = f"""SELECT season, count(*) AS n,
 round(avg(abs(rented_bike_count - ({Q.LINEAR}))), 3) AS mae,
 round(sqrt(avg(power(rented_bike_count - ({Q.LINEAR}), 2))), 3) AS rmse,
 round(1 - sum(power(rented_bike_count - ({Q.LINEAR}), 2)) / (var_pop(rented_bike_count) * count(*)), 4) AS r2
 FROM demand GROUP BY season"""


@register("proj_round", D(Q.DEMAND, body=_SEASON_METRICS_SQL))
def proj_round(spark, sf_dir):
    from demandspark.operators import evaluate as EV

    m = EV.regression_metrics(V.linear_pred(V.demand(spark, sf_dir)), S.LABEL, "yhat",
                              group_by=["season"], mape=False)
    m = PR.round_metrics(m.select("season", "n", "mae", "rmse", "r2"), 3, ["mae", "rmse"])
    return PR.round_metrics(m, 4, ["r2"])


# --- §2.4 filters -------------------------------------------------------------

@register("flt_in_set", D(Q.DEMAND, Q.FEAT, body="SELECT obs_id, is_weekend, is_rush_hour FROM feat"))
def flt_in_set(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", "is_weekend", "is_rush_hour")


@register("flt_threshold", D(Q.DEMAND, Q.FEAT, body="SELECT obs_id, has_rain, has_snow FROM feat"))
def flt_threshold(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", "has_rain", "has_snow")


@register("flt_equality", D(Q.DEMAND, Q.FEAT, body=
    "SELECT obs_id, is_holiday, is_functioning, is_spring, is_summer, is_autumn, is_winter FROM feat"))
def flt_equality(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", "is_holiday", "is_functioning", "is_spring",
                                      "is_summer", "is_autumn", "is_winter")


@register("flt_compound", D(Q.DEMAND, Q.DEMAND_DIRTY, Q.feat_cte("demand_dirty", "feat"), body=
    "SELECT obs_id, extreme_weather, has_rain FROM feat"))
def flt_compound(spark, sf_dir):
    return FE.feature_recipe(V.demand_dirty(spark, sf_dir)).select("obs_id", "extreme_weather", "has_rain")


@register("flt_nonzero_mask", D(Q.DEMAND, body=f"""SELECT season,
 round(COALESCE(100 * avg(CASE WHEN rented_bike_count <> 0 THEN
   abs((rented_bike_count - ({Q.LINEAR})) / rented_bike_count) END), 0), 6) AS mape,
 count(*) FILTER (WHERE rented_bike_count <> 0) AS n_nonzero FROM demand GROUP BY season"""))
def flt_nonzero_mask(spark, sf_dir):
    from demandspark.operators import evaluate as EV

    d = V.linear_pred(V.demand(spark, sf_dir))
    nz = F.col(S.LABEL) != 0
    return round_doubles(d.groupBy("season").agg(
        EV.mape_expr(S.LABEL, "yhat").alias("mape"),
        F.count_if(nz).alias("n_nonzero")))


def _validate_sql(src: str) -> str:
    parts = []
    for name, (lo, hi) in S.REQUEST_LIMITS.items():
        miss = f"{name} IS NULL" + (" OR isnan(" + name + ")" if name in (
            "temperature_c", "humidity", "wind_speed", "visibility_10m", "dew_point_c",
            "solar_radiation", "rainfall_mm", "snowfall_cm") else "")
        parts.append(f"CASE WHEN {miss} THEN 'missing {name}' END")
        if lo is not None:
            parts.append(f"CASE WHEN {name} < {lo} THEN '{name} below {lo}' END")
        if hi is not None:
            parts.append(f"CASE WHEN {name} > {hi} THEN '{name} above {hi}' END")
    txt = "concat_ws(';', " + ", ".join(parts) + ")"
    return f"SELECT obs_id, {txt} = '' AS valid, {txt} AS reasons FROM {src}"


@register("flt_validate_range", D(Q.DEMAND, Q.REQUESTS_BAD, body=_validate_sql("requests_bad")))
def flt_validate_range(spark, sf_dir):
    v = FL.validate(V.requests_bad(spark, sf_dir))
    return v.select("obs_id", "valid", F.array_join("reasons", ";").alias("reasons"))


@register("flt_finite", D(Q.DEMAND, Q.DEMAND_DIRTY, body=
    "SELECT obs_id, CASE WHEN wind_speed IS NULL OR isnan(wind_speed) OR isinf(wind_speed) THEN 0 "
    "ELSE wind_speed END AS wind_speed, "
    "NOT (wind_speed IS NULL OR isnan(wind_speed) OR isinf(wind_speed)) AS finite FROM demand_dirty"))
def flt_finite(spark, sf_dir):
    d = V.demand_dirty(spark, sf_dir)
    return d.select("obs_id", X.finite_or("wind_speed").alias("wind_speed"),
                    X.is_finite("wind_speed").alias("finite"))


# --- §2.5 scalar functions ------------------------------------------------------

@register("fn_parse_date", D(Q.DEMAND, body=
    "SELECT obs_id, date AS date_text, CAST(CAST(try_strptime(date, '%d/%m/%Y') AS DATE) AS VARCHAR) AS date "
    "FROM demand"))
def fn_parse_date(spark, sf_dir):
    d = V.demand(spark, sf_dir)
    return d.select("obs_id", F.col("date").alias("date_text"), X.parse_date("date").cast("string").alias("date"))


@register("fn_calendar", D(Q.DEMAND, Q.FEAT, body="SELECT obs_id, year, month, day FROM feat"))
def fn_calendar(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", "year", "month", "day")


@register("fn_day_of_week", D(Q.DEMAND, Q.FEAT, body=
    "SELECT obs_id, CAST(date AS VARCHAR) AS date, day_of_week FROM feat"))
def fn_day_of_week(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", F.col("date").cast("string").alias("date"), "day_of_week")


@register("fn_day_name", D(Q.DEMAND, Q.FEAT, body="SELECT obs_id, day_name FROM feat"))
def fn_day_name(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", "day_name")


@register("fn_cyclical", D(Q.DEMAND, Q.FEAT, body=_feature_sql(["obs_id"] + _CYC)))
def fn_cyclical(spark, sf_dir):
    return round_doubles(feat(spark, sf_dir).select("obs_id", *_CYC), 9)


@register("fn_cut_edges", D(Q.DEMAND, Q.FEAT, body="SELECT obs_id, hour, time_of_day FROM feat"))
def fn_cut_edges(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", "hour", "time_of_day")


@register("fn_cut_inf", D(Q.DEMAND, Q.DEMAND_DIRTY, Q.feat_cte("demand_dirty", "feat"), body=
    "SELECT obs_id, temperature_c, temp_feel FROM feat"))
def fn_cut_inf(spark, sf_dir):
    return FE.feature_recipe(V.demand_dirty(spark, sf_dir)).select("obs_id", "temperature_c", "temp_feel")


def _ew_sql(value: str, src: str, n: int) -> str:
    terms = " + ".join(f"CAST({value} > mn + {i}*((mx - mn)/CAST({n} AS DOUBLE)) AS INTEGER)"
                       for i in range(1, n))
    return f"SELECT obs_id, {value}, {terms} AS bin FROM {src}, (SELECT min({value}) AS mn, max({value}) AS mx FROM {src})"


@register("fn_cut_equal_width", D(Q.DEMAND, body=_ew_sql("rented_bike_count", "demand", 5)))
def fn_cut_equal_width(spark, sf_dir):
    d = V.demand(spark, sf_dir).select("obs_id", S.LABEL)
    return P.equal_width_bins(d, S.LABEL, 5, out="bin")


@register("fn_one_hot", D(Q.DEMAND, Q.FEAT, body="SELECT obs_id, " + ", ".join(S.ONE_HOT_FEATURES) + " FROM feat"))
def fn_one_hot(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", *S.ONE_HOT_FEATURES)


_INTER = ["temp_humidity_interaction", "wind_rain_interaction", "temp_solar_interaction"]


@register("fn_interaction", D(Q.DEMAND, Q.FEAT, body=_feature_sql(["obs_id"] + _INTER)))
def fn_interaction(spark, sf_dir):
    return feat(spark, sf_dir).select("obs_id", *_INTER)


_RECIPE_COLS = (["obs_id", "date", "day", "day_name", "time_of_day", "temp_feel", "season", "holiday",
                 "functioning_day", S.LABEL] + [c for c in S.FEATURES if c not in ("temperature_c",)]
                + ["temperature_c"])


@register("fn_feature_recipe", D(Q.DEMAND, Q.FEAT, body=_feature_sql(_RECIPE_COLS)))
def fn_feature_recipe(spark, sf_dir):
    f = feat(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    return _round_cyc(f.select(*_RECIPE_COLS))


@register("fn_clip_round", D(Q.DEMAND, body=
    f"SELECT obs_id, CAST(greatest(0, roundbankers(({Q.LINEAR}) - 400, 0)) AS BIGINT) AS prediction "
    "FROM demand"))
def fn_clip_round(spark, sf_dir):
    d = V.demand(spark, sf_dir)
    return V.linear_pred(d).select("obs_id", X.clip_round(F.col("yhat") - 400).alias("prediction"))


@register("fn_error_terms", D(Q.DEMAND, body=f"""SELECT obs_id,
 round(rented_bike_count - ({Q.LINEAR}), 9) AS residual,
 round(abs(rented_bike_count - ({Q.LINEAR})), 9) AS abs_error,
 round(power(rented_bike_count - ({Q.LINEAR}), 2), 9) AS sq_error,
 round(abs((rented_bike_count - ({Q.LINEAR})) / NULLIF(rented_bike_count, 0)) * 100, 9) AS pct_error
 FROM demand"""))
def fn_error_terms(spark, sf_dir):
    d = V.linear_pred(V.demand(spark, sf_dir))
    return round_doubles(d.select("obs_id", *[v.alias(k) for k, v in X.error_terms(S.LABEL, "yhat").items()]), 9)


@register("fn_slug", D(Q.DEMAND, body=
    "SELECT obs_id, lower(translate(season || ' ' || holiday || '-' || functioning_day, ' -', '__')) AS slug "
    "FROM demand"))
def fn_slug(spark, sf_dir):
    d = V.demand(spark, sf_dir)
    return d.select("obs_id", X.slug(F.concat_ws("", "season", F.lit(" "), "holiday", F.lit("-"),
                                                "functioning_day")).alias("slug"))


@register("fn_path_leaf", D(Q.DEMAND, body=
    "SELECT obs_id, string_split(regexp_replace('models/' || lower(season) || '/' || CAST(hour AS VARCHAR) || '//', "
    "'/+$', ''), '/')[-1] AS leaf FROM demand"))
def fn_path_leaf(spark, sf_dir):
    d = V.demand(spark, sf_dir)
    p = F.concat(F.lit("models/"), F.lower("season"), F.lit("/"), F.col("hour").cast("string"), F.lit("//"))
    return d.select("obs_id", X.path_leaf(p).alias("leaf"))


@register("fn_timestamp_text", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS tag, "
          "strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def fn_timestamp_text(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    return e.select("event_id", X.timestamp_text("ts").alias("tag"),
                    X.timestamp_text("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@register("fn_map_get", "SELECT event_id, COALESCE(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k, "
          "COALESCE(CAST(json_extract(props, '$.missing') AS BIGINT), -1) AS missing FROM events")
def fn_map_get(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    m = F.from_json("props", "map<string,bigint>")
    return e.select("event_id", X.map_get(m, "k", 0).alias("k"), X.map_get(m, "missing", -1).alias("missing"))


@register("fn_alert_message", D(Q.DEMAND, body=f"""SELECT season,
 printf('Low model performance: R² = %.4f', round(1 - sum(power(rented_bike_count - ({Q.LINEAR}), 2))
   / (var_pop(rented_bike_count) * count(*)), 9)) AS message FROM demand GROUP BY season"""))
def fn_alert_message(spark, sf_dir):
    from demandspark.operators import evaluate as EV

    m = EV.regression_metrics(V.linear_pred(V.demand(spark, sf_dir)), S.LABEL, "yhat",
                              group_by=["season"], mape=False)
    return m.select("season", X.alert_message("Low model performance: R² = %.4f",
                                              F.round("r2", 9)).alias("message"))
