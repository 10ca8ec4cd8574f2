"""Projections and schema operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions import scalar as X

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def select_dtypes(df: DataFrame, kind: str = "numeric", keep: Iterable[str] = ()) -> DataFrame:
    cols = numeric_columns(df) if kind == "numeric" else string_columns(df)
    extra = [c for c in keep if c not in cols]
    return df.select(*extra, *cols)


def drop_exclude(df: DataFrame, exclude: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Numeric columns minus an exclusion list (e.g. the target)."""
    cols = numeric_columns(df, exclude=set(exclude) | set(keep))
    return df.select(*keep, *cols)


def assemble(df: DataFrame, features: list[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def round_metrics(df: DataFrame, places: int = 4, columns: Iterable[str] | None = None) -> DataFrame:
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.round(F.col(c), places).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def flatten_maps(df: DataFrame, spec: Mapping[str, tuple[str, str, object]]) -> DataFrame:
    """``spec[out] = (map_column, key, default)`` -> scalar columns."""
    return df.withColumns({out: X.map_get(m, k, d) for out, (m, k, d) in spec.items()})
