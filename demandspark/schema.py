"""Schemas, column roles and the fixed values results depend on."""

from __future__ import annotations


from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for equal results)
# ---------------------------------------------------------------------------

# Raw CSV header -> column name.
RENAME_MAP = {
    "Date": "date",
    "Rented Bike Count": "rented_bike_count",
    "Hour": "hour",
    "Temperature(°C)": "temperature_c",
    "Humidity(%)": "humidity",
    "Wind speed (m/s)": "wind_speed",
    "Visibility (10m)": "visibility_10m",
    "Dew point temperature(°C)": "dew_point_c",
    "Solar Radiation (MJ/m2)": "solar_radiation",
    "Rainfall(mm)": "rainfall_mm",
    "Snowfall (cm)": "snowfall_cm",
    "Seasons": "season",
    "Holiday": "holiday",
    "Functioning Day": "functioning_day",
}

NUMERIC_FEATURES = [
    "hour", "temperature_c", "humidity", "wind_speed", "visibility_10m",
    "dew_point_c", "solar_radiation", "rainfall_mm", "snowfall_cm",
    "year", "month", "day_of_week", "hour_sin", "hour_cos",
    "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos",
    "temp_humidity_interaction", "wind_rain_interaction", "temp_solar_interaction",
]

BINARY_FEATURES = [
    "is_weekend", "is_rush_hour", "has_rain", "has_snow",
    "is_holiday", "is_functioning", "is_spring", "is_summer",
    "is_autumn", "is_winter", "extreme_weather",
]

TIME_OF_DAY_LABELS = ["Night", "Morning", "Afternoon", "Evening"]
TEMP_FEEL_LABELS = ["Very_Cold", "Cold", "Mild", "Warm"]
HOUR_EDGES = [0, 6, 12, 18, 24]
TEMP_EDGES = [float("-inf"), 0, 10, 20, float("inf")]
WEEKEND_DAYS = [5, 6]
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
SEASONS = ["Spring", "Summer", "Autumn", "Winter"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Defaults used when a request carries no category at all.
CATEGORY_DEFAULTS = {"time_of_day": "Morning", "temp_feel": "Mild"}
# Thresholds of the extreme-weather flag.
EXTREME_RAIN_MM = 5
EXTREME_SNOW_CM = 1
EXTREME_WIND = 5

ONE_HOT_FEATURES = [f"time_of_day_{v}" for v in TIME_OF_DAY_LABELS] + [
    f"temp_feel_{v}" for v in TEMP_FEEL_LABELS
]
FEATURES = NUMERIC_FEATURES + BINARY_FEATURES + ONE_HOT_FEATURES
LABEL = "rented_bike_count"

# Monitoring column roles.
MONITOR_CATEGORICAL = [
    "season", "holiday", "functioning_day", "time_of_day", "temp_feel",
    "is_weekend", "is_rush_hour", "has_rain", "has_snow", "is_holiday",
    "is_functioning", "is_spring", "is_summer", "is_autumn", "is_winter",
    "extreme_weather",
]

# Request validation: required fields and inclusive limits (None = open).
REQUEST_LIMITS = {
    "date": (None, None),
    "hour": (0, 23),
    "temperature_c": (None, None),
    "humidity": (0, 100),
    "wind_speed": (0, None),
    "visibility_10m": (0, None),
    "dew_point_c": (None, None),
    "solar_radiation": (0, None),
    "rainfall_mm": (0, None),
    "snowfall_cm": (0, None),
    "season": (None, None),
    "holiday": (None, None),
    "functioning_day": (None, None),
}
CONFIDENCE = 0.85

# Monitoring defaults.
DRIFT_P_THRESHOLD = 0.05
DRIFT_MAGNITUDE = 0.1
DRIFT_SHARE_THRESHOLD = 0.5
MIN_ROWS = 100
MIN_R2 = 0.7
MONITOR_WINDOW = "30 days"

# Models whose inputs are standardised first; models that may be tuned.
SCALE_SENSITIVE = ["Linear Regression", "Ridge Regression", "Lasso Regression",
                   "Elastic Net", "KNN"]
TUNABLE = ["Random Forest", "Gradient Boosting", "Boosted Trees (sampled)"]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

FACT_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("rented_bike_count", T.LongType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("temperature_c", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("visibility_10m", T.DoubleType()),
    T.StructField("dew_point_c", T.DoubleType()),
    T.StructField("solar_radiation", T.DoubleType()),
    T.StructField("rainfall_mm", T.DoubleType()),
    T.StructField("snowfall_cm", T.DoubleType()),
    T.StructField("season", T.StringType()),
    T.StructField("holiday", T.StringType()),
    T.StructField("functioning_day", T.StringType()),
])

REQUEST_SCHEMA = T.StructType([f for f in FACT_SCHEMA.fields if f.name != LABEL])

RAW_CSV_SCHEMA = T.StructType([
    T.StructField(raw, FACT_SCHEMA[name].dataType) for raw, name in RENAME_MAP.items()
])

MODEL_RESULTS_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    *[T.StructField(f"{s}_{m}", T.DoubleType())
      for s in ("train", "test") for m in ("r2", "rmse", "mae", "mape")],
    T.StructField("overfit_score", T.DoubleType()),
    T.StructField("run_id", T.StringType()),
])

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
