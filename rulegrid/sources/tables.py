"""Parquet table access.

Reads go through ``spark.read.parquet`` so Catalyst prunes columns and pushes
filters into the scan (``ReadSchema`` / ``PushedFilters`` in the plan).  Nothing
is cached: at scale a re-scan is cheaper and safer than executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    return spark.read.parquet(table_path(data_dir, name))
