"""Readers for the named input tables (one Parquet dataset per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table; naming columns lets the scan's ReadSchema shrink early."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """``spark.table`` for catalog names, quoted with backticks when needed."""
    parts = name.split(".")
    quoted = ".".join(p if p.startswith("`") else f"`{p}`" for p in parts)
    return spark.table(quoted)


def register_views(spark: SparkSession, base_dir: str,
                   names: tuple[str, ...] = TABLES) -> None:
    """Expose every input table as a temporary view for ``spark.sql``."""
    for name in names:
        path = table_path(base_dir, name)
        if os.path.exists(path):
            spark.read.parquet(path).createOrReplaceTempView(name)
