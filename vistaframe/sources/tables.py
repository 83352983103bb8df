"""Parquet table access for the test warehouse layout ``{dir}/{name}.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; projections and filters applied later reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> list[str]:
    """Expose tables as temp views so SQL text can refer to them by name."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
    return list(names)
