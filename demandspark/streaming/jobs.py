"""Structured Streaming jobs: scoring, per-batch monitoring, windowed
quality, late actuals and de-duplication.

Sources are file streams (any Hadoop URI / glob); sinks are file sinks
with checkpoints in the shared folder, so a restarted job resumes from
its offsets and state. ``run_available`` drives a job with the
``availableNow`` trigger (process what is there, then stop).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark import schema as S
from demandspark.operators import drift as DR
from demandspark.operators import monitor as MO
from demandspark.operators import scoring as SCO

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def events_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Event files as a stream; ``ts`` cast to ``timestamp`` (watermarks
    need it; the cast uses the session time zone)."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def records_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def run_available(stream: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "parquet",
                  mode: str = "append", foreach_batch: Callable[[DataFrame, int], None] | None = None) -> None:
    """Run a query with ``availableNow`` and wait for it to finish."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", path).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _quality_aggs(value: str, props: str):
    return [F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(value).isNull() | F.isnan(value)).alias("null_values"),
            F.count_if(F.col(props).isNull()).alias("null_props"),
            F.avg(value).alias("avg_value")]


def quality_tumbling(events: DataFrame, ts: str = "ts", size: str = "1 day", delay: str = "1 hour",
                     value: str = "value", props: str = "props") -> DataFrame:
    """Rows and nulls per tumbling window; late rows past the watermark
    are dropped; append mode emits each window once, when it closes."""
    return (events.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"))
            .agg(*_quality_aggs(value, props))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "rows", "null_values", "null_props", "avg_value"))


def quality_sliding(events: DataFrame, ts: str = "ts", size: str = S.MONITOR_WINDOW, slide: str = "1 day",
                    delay: str = "1 hour", value: str = "value", props: str = "props") -> DataFrame:
    """The monitoring window (30 days) sliding by a day."""
    return (events.withWatermark(ts, delay).groupBy(F.window(ts, size, slide).alias("w"))
            .agg(*_quality_aggs(value, props))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "rows", "null_values", "null_props", "avg_value"))


def dedup(events: DataFrame, keys: Sequence[str] = ("event_id",), ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop repeated records: state per key lives until the watermark
    passes the first copy's event time plus ``delay``."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def score_stream(requests: DataFrame, predictor: SCO.Predictor, accepted_path: str, rejected_path: str,
                 checkpoint: str, index: str = "obs_id") -> None:
    """Score a record stream; successes and rejects go to two sinks (one
    micro-batch is written to both in ``foreachBatch``). A batch's rows are one
    partition, ``batch_id``, which a replayed batch overwrites."""
    scored = SCO.score_batch(requests, predictor, index=index)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        batch.where(F.col("status") == "success").write.mode("overwrite").parquet(f"{accepted_path}/batch_id={epoch}")
        batch.where(F.col("status") != "success").write.mode("overwrite").parquet(f"{rejected_path}/batch_id={epoch}")
        batch.unpersist()
    run_available(scored, checkpoint, foreach_batch=write)


def monitor_batches(current: DataFrame, reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    report_path: str, checkpoint: str) -> None:
    """Per micro-batch: drift against the static reference and quality of
    the batch, in the report sink's partition ``batch_id``, which a replayed
    batch overwrites. The reference is counted once, when the stream starts;
    its counts are written beside the checkpoint."""
    state = DR.ReferenceState(reference, numeric, categorical, f"{checkpoint}-reference")

    def check(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        summary = DR.drift_summary(state.drift_table(batch))
        q = MO.quality(batch).select("total_rows", "missing_total", "duplicate_rows")
        MO.attach(summary, q).write.mode("overwrite").json(f"{report_path}/batch_id={epoch}")
        batch.unpersist()
    run_available(current, checkpoint, foreach_batch=check)


def performance_stream(predictions: DataFrame, actuals: DataFrame, key: str, pred_ts: str, actual_ts: str,
                       bound: str = "1 hour", delay: str = "1 hour", size: str = "1 day") -> DataFrame:
    """MAE / RMSE per window when actuals arrive after the predictions, and
    the predictions that none reached.

    A left-outer stream-stream join on the key within ``bound``: both sides
    are watermarked, so join state is purged, and a prediction whose time is
    over leaves with the watermark as ``unmatched``. A window closes when the
    watermark has passed its end by ``bound``, so it holds all its unmatched
    ones. ``n`` counts the matched pairs. Errors are over the pairs with both
    values (NULL where there is none); a prediction without a key matches
    nothing.
    """
    p = predictions.withWatermark(pred_ts, delay).alias("p")
    a = actuals.withWatermark(actual_ts, delay).alias("a")
    cond = ((F.col(f"p.{key}") == F.col(f"a.{key}"))
            & (F.col(f"a.{actual_ts}") >= F.col(f"p.{pred_ts}"))
            & (F.col(f"a.{actual_ts}") <= F.col(f"p.{pred_ts}") + F.expr(f"INTERVAL {bound}")))
    j = p.join(a, cond, "left_outer").select(F.col(f"p.{pred_ts}").alias("ts"), F.col("p.yhat").alias("yhat"),
                                             F.col("a.y").alias("y"), F.col(f"a.{key}").isNotNull().alias("matched"))
    e = F.col("y") - F.col("yhat")
    # ``ts`` keeps the predictions' watermark through the join
    return (j.groupBy(F.window("ts", size).alias("w"))
            .agg(F.count_if("matched").alias("n"), F.count_if(~F.col("matched")).alias("unmatched"),
                 F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))
            .select(F.col("w.start").alias("window_start"), "n", "unmatched", "mae", "rmse"))
