"""Monitoring checks: preparation, quality, performance, alerts, status.

Each check returns a small result table; alerts read the one-row
results as scalar subqueries (no joins), so a report is a single plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.operators import cleaning as CL
from demandspark.operators import drift as DR
from demandspark.operators import evaluate as EV
from demandspark.operators import profile as P
from demandspark.operators.projection import numeric_columns


def attach(base: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Add the columns of one-row result tables to ``base``: one scalar
    subquery per table, its columns packed in a struct (no join)."""
    out = base
    for i, t in enumerate(one_row):
        packed = t.select(F.struct(*t.columns).alias("row")).scalar()
        out = out.withColumn(f"__row{i}", packed).select("*", *[F.col(f"__row{i}")[c].alias(c) for c in t.columns]).drop(f"__row{i}")
    return out


def prepare(df: DataFrame, numeric: Sequence[str] | None = None) -> DataFrame:
    """+-inf/NaN -> NULL -> 0 on numeric columns (the monitor's input rule)."""
    cols = list(numeric or [c for c in numeric_columns(df)
                            if dict(df.dtypes)[c] in ("double", "float")])
    dbl = [c for c in cols if dict(df.dtypes)[c] in ("double", "float")]
    return CL.zero_fill(CL.inf_to_null(df, dbl), cols)


def quality(df: DataFrame, zero_fill_first: bool = False) -> DataFrame:
    """One row: total rows, missing values per column (map) and in total,
    duplicate rows. Raw nulls are counted unless ``zero_fill_first``
    reproduces the original order (fill, then count)."""
    src = prepare(df) if zero_fill_first else df
    nulls = P.null_counts(src)
    m = nulls.agg(F.map_from_entries(F.collect_list(F.struct("column", "missing"))).alias("missing_values"),
                  F.sum("missing").alias("missing_total"))
    rows = src.agg(F.count(F.lit(1)).alias("total_rows"))
    dup = P.duplicate_rows(src)
    return attach(rows, m, dup)


def column_summary(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric profile of each side, tagged with the dataset: both sides and all
    columns in the same scans."""
    u = DR.tagged_union(reference.select(*cols), current.select(*cols))
    values = {(side, c): F.when(F.col(DR.TAG) == side, P.finite(c)) for side in (DR.REF, DR.CUR) for c in cols}
    found = P.numeric_profiles(u, values)
    rows = [(side, c, *(r[k] for k in P.NUMERIC_PROFILE)) for (side, c), r in found.items()]
    return u.sparkSession.createDataFrame(rows, "dataset string, column string, count long, " + ", ".join(f"{k} double" for k in P.NUMERIC_PROFILE[1:]))


def performance(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """mae, rmse, r2_score, total_predictions; an empty input gives an
    error row instead of NULL metrics."""
    m = EV.regression_metrics(df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()), y, yhat, mape=False)
    return m.select(F.col("mae"), F.col("rmse"), F.col("r2").alias("r2_score"),
                    F.col("n").alias("total_predictions"),
                    F.when(F.col("n") == 0, F.lit("Predictions or actuals not provided")).alias("error"))


def _alert(kind: str, severity: str, cond: Column, message: Column) -> Column:
    return F.when(cond, F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"),
                                 message.alias("message")))


def alerts(drift_summary: DataFrame, quality_t: DataFrame, perf: DataFrame | None = None,
           min_rows: int = S.MIN_ROWS, min_r2: float = S.MIN_R2, with_time: bool = True) -> DataFrame:
    """Drift -> high; fewer than ``min_rows`` rows -> medium; R² below
    ``min_r2`` -> high. One row per alert."""
    one = attach(drift_summary, quality_t.select("total_rows"))
    items = [
        _alert("data_drift", "high", F.col("drift_detected"),
               F.format_string("Data drift detected with score: %.4f", F.col("drift_score"))),
        _alert("data_quality", "medium", F.col("total_rows") < min_rows,
               F.format_string("Low data volume: %d rows", F.col("total_rows"))),
    ]
    if perf is not None:
        one = attach(one, perf.select("r2_score"))
        items.append(_alert("model_performance", "high", F.col("r2_score") < min_r2,
                            F.format_string("Low model performance: R² = %.4f", F.col("r2_score"))))
    out = one.select(F.explode(F.array_compact(F.array(*items))).alias("a")).select("a.*")
    return out.withColumn("timestamp", F.current_timestamp()) if with_time else out


def status(drift_summary: DataFrame, quality_t: DataFrame) -> DataFrame:
    """healthy / warning with the alert texts of the monitoring run."""
    one = attach(drift_summary.select("drift_detected"), quality_t.select("missing_total"))
    msgs = F.array_compact(F.array(
        F.when(F.col("drift_detected"), F.lit("Data drift detected!")),
        F.when(F.col("missing_total") > 0, F.format_string("Found %d missing values", F.col("missing_total")))))
    return one.select(F.when(F.size(msgs) > 0, "warning").otherwise("healthy").alias("status"),
                      msgs.alias("alerts"))
