"""DuckDB twins of the input views, used by the oracle SQL of each query.

Each oracle is ``WITH demand AS (...), ... SELECT ...`` over the raw
tables the checker registers (``orders`` etc.).
"""

from __future__ import annotations

DEMAND = """demand AS (
 SELECT o_orderkey AS obs_id, strftime(o_orderdate,'%d/%m/%Y') AS date, CAST(o_orderkey % 24 AS INT) AS hour,
 CASE WHEN o_orderkey % 30 = 0 THEN 0 ELSE greatest(0, CAST(floor(
   15*((o_custkey*37 % 575 - 178)/CAST(10 AS DOUBLE)) + 25*(18-abs((o_orderkey % 24)-18))
   + o_totalprice/CAST(1000 AS DOUBLE)) AS BIGINT)) END AS rented_bike_count,
 (o_custkey*37 % 575 - 178)/CAST(10 AS DOUBLE) AS temperature_c,
 CAST(o_custkey*13 % 99 AS DOUBLE) AS humidity,
 (o_orderkey*7 % 75)/CAST(10 AS DOUBLE) AS wind_speed,
 CAST(27 + o_orderkey*31 % 1974 AS DOUBLE) AS visibility_10m,
 (o_custkey*41 % 579 - 306)/CAST(10 AS DOUBLE) AS dew_point_c,
 (o_orderkey*17 % 353)/CAST(100 AS DOUBLE) AS solar_radiation,
 greatest(0, o_orderkey*11 % 400 - 330)/CAST(10 AS DOUBLE) AS rainfall_mm,
 greatest(0, o_custkey*19 % 400 - 380)/CAST(10 AS DOUBLE) AS snowfall_cm,
 CASE WHEN month(o_orderdate) IN (12,1,2) THEN 'Winter' WHEN month(o_orderdate) <= 5 THEN 'Spring'
      WHEN month(o_orderdate) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
 CASE WHEN o_orderkey % 20 = 0 THEN 'Holiday' ELSE 'No Holiday' END AS holiday,
 CASE WHEN o_orderkey % 30 = 0 THEN 'No' ELSE 'Yes' END AS functioning_day
 FROM orders)"""


def _gt(c: str, v) -> str:
    return f"CAST(COALESCE({c} > {v} AND NOT isnan({c}), false) AS INTEGER)"


def _eq(c: str, v: str) -> str:
    return f"CAST({c} IS NOT DISTINCT FROM '{v}' AS INTEGER)"


def _cyc(c: str, p: int) -> str:
    x = f"2*pi()*{c}/CAST({p} AS DOUBLE)"
    return f"sin({x}) AS {c}_sin, cos({x}) AS {c}_cos"


# Feature recipe over a view ``src`` with the fact columns (+ extra columns).
def feat_cte(src: str = "demand", name: str = "feat") -> str:
    return f"""{name}_d AS (
 SELECT * EXCLUDE (date), CAST(try_strptime(date, '%d/%m/%Y') AS DATE) AS date FROM {src}),
{name}_c AS (
 SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  dayname(date) AS day_name FROM {name}_d),
{name}_f AS (
 SELECT *,
  CAST(COALESCE(day_of_week IN (5, 6), false) AS INTEGER) AS is_weekend,
  {_cyc('hour', 24)}, {_cyc('month', 12)}, {_cyc('day_of_week', 7)},
  CASE WHEN hour >= 0 AND hour <= 6 THEN 'Night' WHEN hour > 6 AND hour <= 12 THEN 'Morning'
       WHEN hour > 12 AND hour <= 18 THEN 'Afternoon' WHEN hour > 18 AND hour <= 24 THEN 'Evening' END AS time_of_day,
  CAST(COALESCE(hour IN (7, 8, 9, 17, 18, 19), false) AS INTEGER) AS is_rush_hour,
  CASE WHEN isnan(temperature_c) THEN NULL WHEN temperature_c <= 0 THEN 'Very_Cold'
       WHEN temperature_c <= 10 THEN 'Cold' WHEN temperature_c <= 20 THEN 'Mild'
       WHEN temperature_c > 20 THEN 'Warm' END AS temp_feel,
  temperature_c * humidity / CAST(100 AS DOUBLE) AS temp_humidity_interaction,
  wind_speed * rainfall_mm AS wind_rain_interaction,
  temperature_c * solar_radiation AS temp_solar_interaction,
  {_gt('rainfall_mm', 0)} AS has_rain, {_gt('snowfall_cm', 0)} AS has_snow,
  {_eq('holiday', 'Holiday')} AS is_holiday, {_eq('functioning_day', 'Yes')} AS is_functioning,
  {_eq('season', 'Spring')} AS is_spring, {_eq('season', 'Summer')} AS is_summer,
  {_eq('season', 'Autumn')} AS is_autumn, {_eq('season', 'Winter')} AS is_winter,
  CAST(COALESCE(rainfall_mm > 5 AND NOT isnan(rainfall_mm), false)
    OR COALESCE(snowfall_cm > 1 AND NOT isnan(snowfall_cm), false)
    OR COALESCE(wind_speed > 5 AND NOT isnan(wind_speed), false) AS INTEGER) AS extreme_weather
 FROM {name}_c),
{name} AS (
 SELECT *,
  {_eq('time_of_day', 'Night')} AS time_of_day_Night, {_eq('time_of_day', 'Morning')} AS time_of_day_Morning,
  {_eq('time_of_day', 'Afternoon')} AS time_of_day_Afternoon, {_eq('time_of_day', 'Evening')} AS time_of_day_Evening,
  {_eq('temp_feel', 'Very_Cold')} AS temp_feel_Very_Cold, {_eq('temp_feel', 'Cold')} AS temp_feel_Cold,
  {_eq('temp_feel', 'Mild')} AS temp_feel_Mild, {_eq('temp_feel', 'Warm')} AS temp_feel_Warm
 FROM {name}_f)"""


FEAT = feat_cte()

DEMAND_DIRTY = """dirty1 AS (
 SELECT * REPLACE (
  CASE WHEN obs_id % 17 = 0 THEN NULL ELSE temperature_c END AS temperature_c,
  CASE WHEN obs_id % 23 = 0 THEN NULL ELSE humidity END AS humidity,
  CASE WHEN obs_id % 29 = 0 THEN CAST('nan' AS DOUBLE) WHEN obs_id % 31 = 0 THEN CAST('inf' AS DOUBLE)
       ELSE wind_speed END AS wind_speed)
 FROM demand),
demand_dirty AS (SELECT * FROM dirty1 UNION ALL SELECT * FROM dirty1 WHERE obs_id % 50 = 0)"""

REF_CUR = """reference AS (SELECT * FROM demand WHERE obs_id % 2 = 0),
current AS (SELECT * FROM demand WHERE obs_id % 2 = 1)"""

REF_CUR_SHIFTED = """reference AS (SELECT * FROM demand WHERE obs_id % 2 = 0),
current AS (SELECT * REPLACE (temperature_c + 5 AS temperature_c, humidity - 10 AS humidity)
            FROM demand WHERE obs_id % 2 = 1)"""

REQUESTS_BAD = """requests_bad AS (
 SELECT * EXCLUDE (rented_bike_count) REPLACE (
  CASE WHEN obs_id % 40 = 0 THEN 24 ELSE hour END AS hour,
  CASE WHEN obs_id % 41 = 0 THEN CAST(101 AS DOUBLE) ELSE humidity END AS humidity,
  CASE WHEN obs_id % 42 = 0 THEN CAST(-1 AS DOUBLE) ELSE wind_speed END AS wind_speed,
  CASE WHEN obs_id % 43 = 0 THEN NULL ELSE season END AS season)
 FROM demand)"""

LINEAR = "15*temperature_c + 25*(18-abs(hour-18)) + 250"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
