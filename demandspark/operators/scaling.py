"""Standard scaling fitted on one split and applied to all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.profile import finite, with_stats


def standard_scale(df: DataFrame, cols: Sequence[str], fit_where=None, suffix: str = "") -> DataFrame:
    """``(x - mean) / std_pop`` with statistics of the rows matching
    ``fit_where`` (e.g. the train split) and are finite; a zero deviation scales by 1.
    The 2k statistics are one scalar subquery -- no join, no collect."""
    fit = df.where(fit_where) if fit_where is not None else df
    stats = {}
    for c in cols:
        stats[f"{c}__m"] = F.avg(finite(c))
        stats[f"{c}__s"] = F.stddev_pop(finite(c))
    df, st = with_stats(df, stats, source=fit)
    out = {}
    for c in cols:
        s = st[f"{c}__s"]
        out[f"{c}{suffix}"] = (F.col(c) - st[f"{c}__m"]) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return df.withColumns(out).drop("__st")
