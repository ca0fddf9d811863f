"""Readers for the driver's parquet tables (one file per table under sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver table names.
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Expose driver tables as temp views for spark.sql users."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
