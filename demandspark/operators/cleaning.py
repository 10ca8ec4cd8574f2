"""Cleaning: duplicates, infinities, zero fill and mean imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.profile import finite, with_stats


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row (or subset) distinct; one hash aggregate with map-side
    combine, so heavily repeated rows collapse before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def inf_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """+-inf and NaN -> NULL (Spark keeps NULL and NaN apart; pandas has one)."""
    inf = F.lit(float("inf"))
    return df.withColumns({c: F.when((F.abs(F.col(c)) == inf) | F.isnan(c), F.lit(None))
                              .otherwise(F.col(c)) for c in cols})


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def mean_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL and NaN -> mean of the column's finite values. The means are one
    scalar subquery (a single partial/final aggregate), applied row-wise
    without a join."""
    d, means = with_stats(df, {c: F.avg(finite(c)) for c in cols})
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in cols}
    return d.withColumns({c: F.coalesce(known[c], means[c]) for c in cols}).drop("__st")
