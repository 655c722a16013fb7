"""Write a report partitioned by instance (one folder per instance)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "instance_id",
                 mode: str = "errorifexists") -> str:
    """Write ``df`` under ``path``; readers prune instances by folder.

    Rows are rebalanced by the partition column first: adaptive execution packs
    small instances together and splits a busy one over several tasks, so the
    number of files follows the size of the report, not tasks x instances.

    ``mode="replace"`` overwrites the folders of the instances (or days) that
    ``df`` has and leaves all others as they are, so that a report can be run
    again for some of them; each folder appears only when the whole job is done.
    """
    w = df.hint("rebalance", partition_by) if partition_by else df
    writer = w.write.format(fmt)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)
    return path
