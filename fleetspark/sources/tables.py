"""Readers for the base tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    """``<dir>/<name>.parquet``; on a local disk also a plain ``<dir>/<name>``
    folder.  Remote folders (``scheme://``) are not probed from the driver."""
    if "://" in sf_dir:
        return f"{sf_dir.rstrip('/')}/{name}.parquet"
    path = os.path.join(sf_dir, f"{name}.parquet")
    return path if os.path.exists(path) else os.path.join(sf_dir, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it.

    How many tasks a small table is read by is the session's business
    (``spark.sql.files.minPartitionNum``, ``spark.sql.files.maxPartitionBytes``).
    """
    return spark.read.parquet(table_path(sf_dir, name))


def stream_path(sf_dir: str, name: str) -> str:
    """A table's path for a file stream.  A stream takes folders and patterns
    only; this pattern has one match, the file or folder of the table."""
    return f"{sf_dir.rstrip('/')}/{name}.parque[t]"
