"""Static lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Memory in MB of each managed-database instance class
# (49 classes), as the health check's pool-vs-RAM rule uses them.
INSTANCE_CLASS_MEMORY_MB = {
    "db.t3.micro": 1024,
    "db.t3.small": 2048,
    "db.t3.medium": 4096,
    "db.t3.large": 8192,
    "db.t3.xlarge": 16384,
    "db.t3.2xlarge": 32768,
    "db.t4g.micro": 1024,
    "db.t4g.small": 2048,
    "db.t4g.medium": 4096,
    "db.t4g.large": 8192,
    "db.t4g.xlarge": 16384,
    "db.t4g.2xlarge": 32768,
    "db.m5.large": 8192,
    "db.m5.xlarge": 16384,
    "db.m5.2xlarge": 32768,
    "db.m5.4xlarge": 65536,
    "db.m5.8xlarge": 131072,
    "db.m5.12xlarge": 196608,
    "db.m5.16xlarge": 262144,
    "db.m5.24xlarge": 393216,
    "db.m6g.large": 8192,
    "db.m6g.xlarge": 16384,
    "db.m6g.2xlarge": 32768,
    "db.m6g.4xlarge": 65536,
    "db.m6g.8xlarge": 131072,
    "db.m6g.12xlarge": 196608,
    "db.m6g.16xlarge": 262144,
    "db.r5.large": 16384,
    "db.r5.xlarge": 32768,
    "db.r5.2xlarge": 65536,
    "db.r5.4xlarge": 131072,
    "db.r5.8xlarge": 262144,
    "db.r5.12xlarge": 393216,
    "db.r5.16xlarge": 524288,
    "db.r5.24xlarge": 786432,
    "db.r6g.large": 16384,
    "db.r6g.xlarge": 32768,
    "db.r6g.2xlarge": 65536,
    "db.r6g.4xlarge": 131072,
    "db.r6g.8xlarge": 262144,
    "db.r6g.12xlarge": 393216,
    "db.r6g.16xlarge": 524288,
    "db.r7g.large": 16384,
    "db.r7g.xlarge": 32768,
    "db.r7g.2xlarge": 65536,
    "db.r7g.4xlarge": 131072,
    "db.r7g.8xlarge": 262144,
    "db.r7g.12xlarge": 393216,
    "db.r7g.16xlarge": 524288,
}


def class_memory_table(spark: SparkSession) -> DataFrame:
    """The class -> memory lookup as a DataFrame (instance_class, memory_mb)."""
    return spark.createDataFrame(sorted(INSTANCE_CLASS_MEMORY_MB.items()), "instance_class string, memory_mb long")
