"""Registry of query plans with their SQL oracles.

``QUERIES[key] = (fn, sql)`` where ``fn(spark, sf_dir) -> DataFrame`` and
``sql`` is DuckDB SQL over the driver tables, or None for checks that SQL
cannot express (model fitting, streaming).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillsense.functions.exprs import round6

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = (fn, sql)
        return fn

    return deco


def round_doubles(df: DataFrame, decimals: dict[str, int] | None = None) -> DataFrame:
    """Round every DOUBLE output column of a check to 6 decimals, or to those
    declared for it (value-hash stability across engines); see ``round6``."""
    exprs = {
        f.name: round6(f.name, (decimals or {}).get(f.name, 6))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(exprs) if exprs else df


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # importing the modules fills the registry
    from tillsense.plans import q_core, q_io, q_models, q_quality, q_stream  # noqa: F401

    return QUERIES
