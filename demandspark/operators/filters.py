"""Filters, predicates and the request validator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark import schema as S
from demandspark.functions import scalar as X


def validate(df: DataFrame, limits: Mapping[str, tuple] | None = None,
             reasons_col: str = "reasons") -> DataFrame:
    """Adds ``reasons`` (array<string>) and ``valid`` (boolean)."""
    limits = dict(S.REQUEST_LIMITS if limits is None else limits)
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    exprs = []
    for name, (lo, hi) in limits.items():
        if name not in df.columns:
            exprs.append(F.lit(f"missing {name}"))
            continue
        c = F.col(name)
        missing = (c.isNull() | F.isnan(c)) if name in numeric else c.isNull()
        exprs.append(F.when(missing, F.lit(f"missing {name}")))
        if lo is not None:
            exprs.append(F.when(c < F.lit(lo), F.lit(f"{name} below {lo}")))
        if hi is not None:
            exprs.append(F.when(c > F.lit(hi), F.lit(f"{name} above {hi}")))
    out = df.withColumn(reasons_col, F.array_compact(F.array(*exprs)))
    return out.withColumn("valid", F.size(reasons_col) == 0)


def has_key(df: DataFrame, map_col: str, key: str) -> DataFrame:
    return df.where(F.map_contains_key(map_col, F.lit(key)))


def name_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.where(F.lower(F.col(col)).contains(needle.lower()))


def in_group(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.where(X.in_set(col, list(values)))
