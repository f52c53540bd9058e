"""Readers for the benchmark parquet tables.

Only ``spark.read.parquet`` with a declared column list; Catalyst prunes the
columns and pushes filters into the scan, so a query that needs two columns
reads two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
