"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads whole tables (or Spark-derived data from them).  Floating
outputs are rounded so the DuckDB oracle can compare value hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    """Register a query under ``name``."""
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def r4(c) -> F.Column:
    """Round to 4 digits (a column or a column name)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 4)
