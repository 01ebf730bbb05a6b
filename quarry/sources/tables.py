"""Parquet table access for the driver's fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one table; naming ``cols`` prunes the Parquet ReadSchema to them."""
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (for SQL-string operators)."""
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
