"""Window, ranking and top-k operators over result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_min(df: DataFrame, part: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Running minimum (best loss so far) per partition in ``order``."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.min(value).over(w))


def rank_desc(df: DataFrame, value: str, tie: str, out: str = "rank", part: Sequence[str] = ()) -> DataFrame:
    """``row_number`` by ``value`` desc, ties by ``tie`` asc."""
    w = Window.partitionBy(*part).orderBy(F.col(value).desc_nulls_last(), F.col(tie))
    return df.withColumn(out, F.row_number().over(w))


def latest_per(df: DataFrame, part: Sequence[str], version: str) -> DataFrame:
    """Newest row per partition: one ``max_by`` aggregate (partial
    aggregation, no sort of whole groups)."""
    others = [c for c in df.columns if c not in part]
    return df.groupBy(*part).agg(F.max_by(F.struct(*others), F.col(version)).alias("__r")).select(
        *part, "__r.*")


def top_k(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    """Top ``k`` rows by ``value`` desc (TakeOrderedAndProject)."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(tie)).limit(k)


def argmax(df: DataFrame, value: str, tie: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The single best row: ``max_by(struct, struct(value, -tie))``; ties
    go to the smallest ``tie`` value. Partial aggregation, one row out."""
    cols = list(cols or df.columns)
    # min_by on (-value, tie) = highest value, then smallest tie; NULL
    # values are skipped by the filter so they never win.
    best = df.where(F.col(value).isNotNull()).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]),
                 F.struct((-F.col(value)).alias("v"), F.col(tie).alias("t"))).alias("__b"))
    return best.select("__b.*")


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows in key order (a key makes ``head`` deterministic)."""
    return df.orderBy(key).limit(n)
