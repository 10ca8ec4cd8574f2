"""Registered queries: profiles and aggregates (§2.7) and cleaning (§2.6)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import scalar as X
from demandspark.operators import cleaning as CL
from demandspark.operators import profile as P
from demandspark.plans import sql as Q
from demandspark.plans import views as V
from demandspark.plans.common import feat, round_doubles
from demandspark.plans.registry import register

D = Q.with_ctes
NUM = ["hour", "rented_bike_count", "temperature_c", "humidity", "wind_speed", "visibility_10m",
       "dew_point_c", "solar_radiation", "rainfall_mm", "snowfall_cm"]
TXT = ["date", "season", "holiday", "functioning_day"]
FACT = [f.name for f in S.FACT_SCHEMA.fields]


def _describe_sql(src: str) -> str:
    parts = []
    for c in NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50, "
            f"round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM {src}")
    for c in TXT:
        parts.append(
            f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM {src}) AS count, "
            f"(SELECT count(DISTINCT {c}) FROM {src}) AS \"unique\", v AS top, n AS freq, "
            + ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
            + f" FROM (SELECT {c} AS v, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
              f"ORDER BY n DESC, v LIMIT 1)")
    return "\nUNION ALL\n".join(parts)


_FLOATS = [c for c in NUM if c not in ("hour", "rented_bike_count")]
# the dirty table with NULL for what is not finite
FINITE_DIRTY = "fin AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in _FLOATS) + ") FROM demand_dirty)"


@register("agg_describe", D(Q.DEMAND, Q.DEMAND_DIRTY, FINITE_DIRTY, body=_describe_sql("fin")))
def agg_describe(spark, sf_dir):
    return round_doubles(P.describe(V.demand_dirty(spark, sf_dir), NUM + TXT))


_SPARK_TYPES = {"obs_id": "bigint", "date": "string", "hour": "int", "rented_bike_count": "bigint",
                "season": "string", "holiday": "string", "functioning_day": "string"}


@register("agg_schema_info", D(Q.DEMAND, Q.DEMAND_DIRTY, body="\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{_SPARK_TYPES.get(c, 'double')}' AS dtype, "
    f"count({c}) AS non_null, (SELECT count(*) FROM demand_dirty) AS rows FROM demand_dirty"
    for i, c in enumerate(V.DEMAND_COLS))))
def agg_schema_info(spark, sf_dir):
    return P.schema_info(V.demand_dirty(spark, sf_dir))


def _null_sql() -> str:
    parts = []
    for c in V.DEMAND_COLS:
        nan = f" OR isnan({c})" if _SPARK_TYPES.get(c, "double") == "double" else ""
        parts.append(f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL{nan}) AS BIGINT) AS missing FROM demand_dirty")
    return "\nUNION ALL\n".join(parts)


@register("agg_null_counts", D(Q.DEMAND, Q.DEMAND_DIRTY, body=_null_sql()))
def agg_null_counts(spark, sf_dir):
    return P.null_counts(V.demand_dirty(spark, sf_dir))


@register("agg_duplicate_rows", D(Q.DEMAND, Q.DEMAND_DIRTY, body=
    "SELECT CAST(COALESCE(sum(cnt - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS cnt FROM demand_dirty GROUP BY ALL_COLS)".replace(
        "ALL_COLS", ", ".join(["obs_id"] + FACT))))
def agg_duplicate_rows(spark, sf_dir):
    return P.duplicate_rows(V.demand_dirty(spark, sf_dir))


@register("agg_value_counts", D(Q.DEMAND, Q.DEMAND_DIRTY, body="\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM demand_dirty GROUP BY {c}"
    for c in ("season", "holiday", "functioning_day"))))
def agg_value_counts(spark, sf_dir):
    return P.value_counts(V.demand_dirty(spark, sf_dir), ["season", "holiday", "functioning_day"])


def _mean_sql(keys: list[str], extra: str = "") -> str:
    k = ", ".join(keys)
    return (f"SELECT {k}{extra}, round(avg(rented_bike_count), 6) AS avg_count, count(*) AS n "
            f"FROM feat GROUP BY {k}")


def _mean(by, order=None):
    def build(spark, sf_dir):
        f = feat(spark, sf_dir)
        g = f.groupBy(*by).agg(X.round_half_away(F.avg(S.LABEL), 6).alias("avg_count"), F.count(F.lit(1)).alias("n"))
        if order:
            g = g.withColumn(order[0], order[1])
        return g
    return build


register("agg_mean_by_day_name", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["day_name", "day_of_week"])))(
    _mean(["day_name", "day_of_week"]))
register("agg_mean_by_month", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["month"])))(_mean(["month"]))
register("agg_mean_by_day", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["day"])))(_mean(["day"]))
register("agg_mean_by_year", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["year"])))(_mean(["year"]))
register("agg_mean_by_weekend", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["is_weekend"])))(_mean(["is_weekend"]))
register("agg_mean_by_hour", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["hour"])))(_mean(["hour"]))
register("agg_mean_hour_day", D(Q.DEMAND, Q.FEAT, body=_mean_sql(["hour", "day_name"])))(
    _mean(["hour", "day_name"]))


@register("agg_mean_hour_season", D(Q.DEMAND, body=
    "SELECT hour, season, round(avg(rented_bike_count), 6) AS avg_count, count(*) AS n "
    "FROM demand GROUP BY hour, season"))
def agg_mean_hour_season(spark, sf_dir):
    """The minimum slice: recipe columns feed a two-key group mean; the
    unused recipe columns are pruned by Catalyst."""
    return P.group_mean(feat(spark, sf_dir), ["hour", "season"], S.LABEL, places=6)


_SETS = [["day_name"], ["month"], ["day"], ["year"], ["is_weekend"], ["hour"], ["hour", "day_name"],
         ["hour", "season"]]


def _gs_sql() -> str:
    keys = ["day_name", "month", "day", "year", "is_weekend", "hour", "season"]
    sets = ", ".join("(" + ", ".join(s) + ")" for s in _SETS)
    return (f"SELECT {', '.join(keys)}, CAST(grouping({', '.join(keys)}) AS BIGINT) AS gid, "
            f"round(avg(rented_bike_count), 6) AS avg_count, count(*) AS n FROM feat "
            f"GROUP BY GROUPING SETS ({sets})")


@register("agg_mean_grouping_sets", D(Q.DEMAND, Q.FEAT, body=_gs_sql()))
def agg_mean_grouping_sets(spark, sf_dir):
    g = P.grouping_set_means(feat(spark, sf_dir), _SETS, S.LABEL)
    return g.withColumn("avg_count", X.round_half_away("avg_count", 6))


FINITE = "({x} IS NOT NULL AND NOT isnan({x}) AND NOT isinf({x}))"


def _hist_sql(cols, src, bins, value_expr=None) -> str:
    parts = []
    for c in cols:
        x = value_expr or f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", b AS bin, round(mn + b * ((mx - mn) / CAST({bins} AS DOUBLE)), 9) AS lo, "
            f"round(mn + (b + 1) * ((mx - mn) / CAST({bins} AS DOUBLE)), 9) AS hi, count(*) AS count FROM ("
            f"SELECT mn, mx, CASE WHEN mx = mn THEN 0 ELSE CAST(least(floor(({x} - mn) / (mx - mn) * "
            f"CAST({bins} AS DOUBLE)), {bins - 1}) AS INTEGER) END AS b FROM {src}, "
            f"(SELECT min({x}) AS mn, max({x}) AS mx FROM {src} WHERE {FINITE.format(x=x)}) WHERE {FINITE.format(x=x)}) "
            f"GROUP BY b, mn, mx")
    return "\nUNION ALL\n".join(parts)


@register("agg_histogram", D(Q.DEMAND, Q.DEMAND_DIRTY, body=_hist_sql(NUM, "demand_dirty", 10)))
def agg_histogram(spark, sf_dir):
    return round_doubles(P.histogram(V.demand_dirty(spark, sf_dir), NUM, 10), 9)


def _density_sql(cols, bins, grid) -> str:
    h = _hist_sql(cols, "demand_dirty", bins).replace("round(", "(").replace(", 9) AS lo", ") AS lo").replace(
        ", 9) AS hi", ") AS hi")
    st = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, stddev_samp(CAST({c} AS DOUBLE)) AS sd, count({c}) AS nn "
                             f"FROM demand_dirty WHERE {FINITE.format(x=f'CAST({c} AS DOUBLE)')}" for c in cols)
    return f""", hist AS ({h}),
st AS ({st}),
hb AS (SELECT h.*, min(lo) OVER (PARTITION BY h."column") AS g_lo, max(hi) OVER (PARTITION BY h."column") AS g_hi,
       (lo + hi) / 2 AS center, 1.06 * st.sd * pow(CAST(st.nn AS DOUBLE), -0.2) AS bw, st.nn
       FROM hist h JOIN st ON h."column" = st.col),
g AS (SELECT *, g_lo + g * (g_hi - g_lo) / CAST({grid - 1} AS DOUBLE) AS x FROM hb, range(0, {grid}) t(g))
SELECT "column", CAST(g AS INTEGER) AS g, round(max(x), 9) AS x,
 round(sum(count * exp(-0.5 * ((x - center) / bw) * ((x - center) / bw)) / (nn * bw * {math.sqrt(2 * math.pi)!r})), 10) AS density
FROM g GROUP BY "column", g"""


@register("agg_density", D(Q.DEMAND, Q.DEMAND_DIRTY, body="SELECT 1").replace("\nSELECT 1", _density_sql(NUM, 50, 40)))
def agg_density(spark, sf_dir):
    d = P.density(V.demand_dirty(spark, sf_dir), NUM, bins=50, grid=40)
    return d.select("column", "g", X.round_half_away("x", 9).alias("x"), X.round_half_away("density", 10).alias("density"))


CORR = ["rented_bike_count", "hour", "temperature_c", "humidity", "wind_speed", "visibility_10m",
        "dew_point_c", "solar_radiation", "rainfall_mm", "snowfall_cm"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(CORR):
        for b in CORR[i:]:
            x, y = (f"CAST({c} AS DOUBLE)" for c in (a, b))
            src = f"round(corr({x}, {y}), 9) AS corr FROM demand_dirty WHERE {FINITE.format(x=x)} AND {FINITE.format(x=y)}"
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {src}")
            if a != b:
                parts.append(f"SELECT '{b}' AS x, '{a}' AS y, {src}")
    return "\nUNION ALL\n".join(parts)


@register("agg_correlation", D(Q.DEMAND, Q.DEMAND_DIRTY, body=_corr_sql()))
def agg_correlation(spark, sf_dir):
    return round_doubles(P.correlation(V.demand_dirty(spark, sf_dir), CORR), 9)


REG = [c for c in CORR if c != "rented_bike_count"]


@register("agg_regression_line", D(Q.DEMAND, Q.DEMAND_DIRTY, FINITE_DIRTY, body="\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(regr_slope(CAST(rented_bike_count AS DOUBLE), CAST({c} AS DOUBLE)), 9) AS slope, "
    f"round(regr_intercept(CAST(rented_bike_count AS DOUBLE), CAST({c} AS DOUBLE)), 9) AS intercept, "
    f"round(regr_r2(CAST(rented_bike_count AS DOUBLE), CAST({c} AS DOUBLE)), 9) AS r2 FROM fin" for c in REG)))
def agg_regression_line(spark, sf_dir):
    return round_doubles(P.regression_lines(V.demand_dirty(spark, sf_dir), S.LABEL, REG), 9)


@register("agg_error_by_range", D(Q.DEMAND, Q.DEMAND_DIRTY, FINITE_DIRTY, f"told AS (SELECT * FROM fin WHERE {Q.LINEAR} IS NOT NULL)", body=f"""SELECT bin, round(avg(abs(rented_bike_count - ({Q.LINEAR}))), 6)
 AS mean_abs_error, count(*) AS n FROM (
 SELECT *, {' + '.join(f'CAST(rented_bike_count > mn + {i}*((mx - mn)/CAST(10 AS DOUBLE)) AS INTEGER)' for i in range(1, 10))}
 AS bin FROM told, (SELECT min(rented_bike_count) AS mn, max(rented_bike_count) AS mx FROM told)) GROUP BY bin"""))
def agg_error_by_range(spark, sf_dir):
    d = V.linear_pred(V.demand_dirty(spark, sf_dir))
    return round_doubles(P.error_by_range(d, S.LABEL, "yhat", 10))


@register("agg_residual_hist", D(Q.DEMAND, f"resid AS (SELECT rented_bike_count - ({Q.LINEAR}) AS residual FROM demand)",
                                 body=_hist_sql(["residual"], "resid", 50)))
def agg_residual_hist(spark, sf_dir):
    d = V.linear_pred(V.demand(spark, sf_dir))
    r = d.select((F.col(S.LABEL) - F.col("yhat")).alias("residual"))
    return round_doubles(P.histogram(r, ["residual"], 50), 9)


# --- §2.6 cleaning ---------------------------------------------------------------

_CLEAN_COLS = ["obs_id", "temperature_c", "humidity", "wind_speed"]


@register("cln_drop_duplicates", D(Q.DEMAND, Q.DEMAND_DIRTY, body=
    "SELECT DISTINCT * FROM demand_dirty"))
def cln_drop_duplicates(spark, sf_dir):
    return CL.drop_duplicates(V.demand_dirty(spark, sf_dir))


@register("cln_inf_to_null", D(Q.DEMAND, Q.DEMAND_DIRTY, FINITE_DIRTY, body="SELECT obs_id, " + ", ".join(_FLOATS) + " FROM fin"))
def cln_inf_to_null(spark, sf_dir):
    return CL.inf_to_null(V.demand_dirty(spark, sf_dir).select("obs_id", *_FLOATS), _FLOATS)


@register("cln_zero_fill", D(Q.DEMAND, Q.DEMAND_DIRTY, body=
    "SELECT obs_id, COALESCE(temperature_c, 0) AS temperature_c, COALESCE(humidity, 0) AS humidity, "
    "CASE WHEN isinf(wind_speed) OR isnan(wind_speed) THEN 0 ELSE wind_speed END AS wind_speed FROM demand_dirty"))
def cln_zero_fill(spark, sf_dir):
    d = V.demand_dirty(spark, sf_dir).select(*_CLEAN_COLS)
    return CL.zero_fill(CL.inf_to_null(d, ["wind_speed"]), ["temperature_c", "humidity", "wind_speed"])


def _impute_sql() -> str:
    mean = {c: f"(SELECT avg(CAST({c} AS DOUBLE)) FROM dd WHERE {FINITE.format(x=f'CAST({c} AS DOUBLE)')})" for c in NUM}
    known = {c: f"CASE WHEN {FINITE.format(x=c)} THEN {c} END" if c in _FLOATS else f"CAST({c} AS DOUBLE)" for c in NUM}
    return "SELECT obs_id, " + ", ".join(f"round(COALESCE({known[c]}, {mean[c]}), 9) AS {c}" for c in NUM) + " FROM dd"


@register("cln_mean_impute", D(Q.DEMAND, Q.DEMAND_DIRTY, "dd AS (SELECT DISTINCT * FROM demand_dirty)", body=_impute_sql()))
def cln_mean_impute(spark, sf_dir):
    d = CL.drop_duplicates(V.demand_dirty(spark, sf_dir))
    d = CL.inf_to_null(d.select("obs_id", *[F.col(c).cast("double").alias(c) for c in NUM]), NUM)
    return round_doubles(CL.mean_impute(d, NUM), 9)
