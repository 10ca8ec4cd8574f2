"""Registered queries: key -> (Spark builder, optional DuckDB oracle SQL).

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the
given tables. Modules under ``demandspark.plans`` register on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    import importlib
    import pkgutil

    import demandspark.plans as pkg

    for m in pkgutil.iter_modules(pkg.__path__):
        if m.name.startswith("q_"):
            importlib.import_module(f"demandspark.plans.{m.name}")


def queries() -> dict[str, Builder]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
