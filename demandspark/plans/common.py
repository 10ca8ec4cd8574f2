"""Helpers shared by registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.features import feature_recipe
from demandspark.functions.scalar import round_half_away
from demandspark.plans import views


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round double columns so last-bit summation-order noise does not
    change a value hash (the oracle rounds the same way)."""
    return df.select(*[round_half_away(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def feat(spark, sf_dir) -> DataFrame:
    return feature_recipe(views.demand(spark, sf_dir))
