"""Input views over the given tables.

``demand`` maps the ``orders`` table onto the 14-column hourly fact schema
(one row per order; the derivation is the published fixture definition).
The derived views inject the nulls, NaN, infinities, duplicates and bad
requests the clean driver tables lack. Every view is a lazy projection
of a table scan, so filters and column pruning reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


DEMAND_COLS = ["obs_id", "date", "hour", "rented_bike_count", "temperature_c", "humidity", "wind_speed",
               "visibility_10m", "dew_point_c", "solar_radiation", "rainfall_mm", "snowfall_cm", "season",
               "holiday", "functioning_day"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d10(x: Column) -> Column:
    return x / F.lit(10.0)


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    temp = _d10(c * 37 % 575 - 178)
    hour = k % 24
    count = F.greatest(F.lit(0), F.floor(
        15 * temp + 25 * (18 - F.abs(hour - 18)) + F.col("o_totalprice") / F.lit(1000.0)
    ).cast("bigint"))
    m = F.month("o_orderdate")
    return o.select(
        k.alias("obs_id"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
        hour.cast("int").alias("hour"),
        F.when(k % 30 == 0, F.lit(0).cast("bigint")).otherwise(count).alias("rented_bike_count"),
        temp.alias("temperature_c"),
        (c * 13 % 99).cast("double").alias("humidity"),
        _d10(k * 7 % 75).alias("wind_speed"),
        (27 + k * 31 % 1974).cast("double").alias("visibility_10m"),
        _d10(c * 41 % 579 - 306).alias("dew_point_c"),
        ((k * 17 % 353) / F.lit(100.0)).alias("solar_radiation"),
        _d10(F.greatest(F.lit(0), k * 11 % 400 - 330)).alias("rainfall_mm"),
        _d10(F.greatest(F.lit(0), c * 19 % 400 - 380)).alias("snowfall_cm"),
        F.when(m.isin(12, 1, 2), "Winter").when(m <= 5, "Spring")
         .when(m <= 8, "Summer").otherwise("Autumn").alias("season"),
        F.when(k % 20 == 0, "Holiday").otherwise("No Holiday").alias("holiday"),
        F.when(k % 30 == 0, "No").otherwise("Yes").alias("functioning_day"),
    )


def demand_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``demand`` with NULL, NaN, +inf and a duplicate of every 50th row."""
    d = demand(spark, sf_dir)
    k = F.col("obs_id")
    dirty = d.withColumns({
        "temperature_c": F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("temperature_c")),
        "humidity": F.when(k % 23 == 0, F.lit(None).cast("double")).otherwise(F.col("humidity")),
        "wind_speed": F.when(k % 29 == 0, F.lit(float("nan")))
                       .when(k % 31 == 0, F.lit(float("inf"))).otherwise(F.col("wind_speed")),
    })
    return dirty.unionByName(dirty.where(k % 50 == 0))


def reference_current(spark: SparkSession, sf_dir: str, shifted: bool = False,
                      base: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Even obs_id = reference, odd = current; ``shifted`` moves current."""
    d = base if base is not None else demand(spark, sf_dir)
    ref = d.where(F.col("obs_id") % 2 == 0)
    cur = d.where(F.col("obs_id") % 2 == 1)
    if shifted:
        cur = cur.withColumns({"temperature_c": F.col("temperature_c") + 5,
                               "humidity": F.col("humidity") - 10})
    return ref, cur


def requests_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests (no label) with out-of-range or missing fields."""
    d = demand(spark, sf_dir)
    k = F.col("obs_id")
    return d.drop("rented_bike_count").withColumns({
        "hour": F.when(k % 40 == 0, F.lit(24)).otherwise(F.col("hour")),
        "humidity": F.when(k % 41 == 0, F.lit(101.0)).otherwise(F.col("humidity")),
        "wind_speed": F.when(k % 42 == 0, F.lit(-1.0)).otherwise(F.col("wind_speed")),
        "season": F.when(k % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("season")),
    })


def linear_pred(df: DataFrame, out: str = "yhat") -> DataFrame:
    """A fixed linear predictor with an exact SQL twin (no fitted model)."""
    return df.withColumn(out, 15 * F.col("temperature_c")
                         + 25 * (18 - F.abs(F.col("hour") - 18)) + 250)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` cast to ``timestamp`` (watermarks need it)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
