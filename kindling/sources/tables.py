"""Parquet tables of the driver's star schema (SRC16) and catalog tables (SRC15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC16: columnar scan; Catalyst pushes filters and prunes columns."""
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables below ``sf_dir``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC15: a table or view registered in the session catalog."""
    return spark.table(name)
