"""Counter rows stored so that every later check runs without a shuffle.

``bucketBy`` puts each snapshot's rows into one bucket of each write; reading
the table, Spark knows that rows of one snapshot are in one task, so the pivot
of the checks needs no exchange.  The rows are dealt by the same hash before
they are written, so there is one file a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SNAPSHOT = ("instance_id", "snapshot_id")
#: Rows that one bucket holds, so that neither its writer's sort nor a check's pivot grows with the table.
BUCKET_ROWS = 1 << 21


def buckets_for(rows: int, least: int = 16) -> int:
    """Buckets for a table of some ``rows`` rows."""
    return max(least, -(-rows // BUCKET_ROWS))


def write_bucketed(rows: DataFrame, table: str, buckets: int, keys=SNAPSHOT, path: str | None = None, mode: str = "errorifexists") -> str:
    """Store ``rows`` as table ``table``, at ``path`` if given, in ``buckets`` buckets by ``keys``.

    Choose ``buckets`` by size, some 128 to 256 MB each; the number of tasks of
    a check is the number of buckets.
    """
    writer = rows.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
