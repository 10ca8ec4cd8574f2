"""Sinks: CSV and JSON outputs, partitioned report folders, markers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _maps_to_json(df: DataFrame) -> DataFrame:
    """CSV holds no maps/arrays/structs: encode them as JSON text."""
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)) else F.col(f.name)
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              encoding: str | None = None) -> str:
    w = _maps_to_json(df).write.mode(mode).option("header", header)
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)
    return path


def run_stamp(ts: _dt.datetime | None = None) -> str:
    return (ts or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_results(results: DataFrame, base: str, stamp: str | None = None,
                  comparison: DataFrame | None = None) -> str:
    """Results (and optional comparison) under ``base/<name>/run_ts=<stamp>``."""
    s = stamp or run_stamp()
    write_csv(results, f"{base.rstrip('/')}/training_results/run_ts={s}")
    if comparison is not None:
        write_csv(comparison, f"{base.rstrip('/')}/model_comparison/run_ts={s}")
    return s


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_best_marker(best: DataFrame, path: str) -> str:
    """The best-model marker, overwritten each run (one small document)."""
    return write_json(best.coalesce(1), path, "overwrite")


def write_report(report: DataFrame, base: str, check: str, report_date: str | None = None) -> str:
    """Append a monitoring report under ``check=<check>/report_date=<day>``
    so readers prune by check and day."""
    day = report_date or _dt.date.today().isoformat()
    (report.withColumn("check", F.lit(check)).withColumn("report_date", F.lit(day))
     .write.mode("append").partitionBy("check", "report_date").json(base))
    return base
