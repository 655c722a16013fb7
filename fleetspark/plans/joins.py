"""Join helpers that keep the physical plan safe at fleet scale.

No side is hinted: Spark broadcasts a side whose size in bytes it knows to be
small (``spark.sql.autoBroadcastJoinThreshold``, also at run time under AQE),
and splits skewed partitions of the joins that it shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """A lookup with one row per key (the largest value of each other column),
    so that a repeated key can't multiply the rows joined to it."""
    return lookup.groupBy(key).agg(*[F.max(c).alias(c) for c in lookup.columns if c != key])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on ``keys``, a null key equal to a null key; the keys are those of ``left``."""
    named = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(named, cond, how).drop(*[f"_right_{k}" for k in keys])


def with_group_count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Attach the row count of each key group to every row.

    A ``count() over (partition by key)`` window would sort every row of a
    busy key in one task.  Here the count is a partial (map-side) aggregate,
    one row per key, joined back: AQE broadcasts it when small and splits
    skewed partitions otherwise.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, list(keys), "left")
