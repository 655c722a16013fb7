"""Exact percentiles of hot groups without a group's values in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per doubling of the value; a group has at most some thousand buckets, whatever its size.
RESOLUTION = 64


def _bucket(value: Column) -> Column:
    """A coarse bucket that never falls as the value grows."""
    size = F.floor(F.log2(F.abs(value) + 1) * RESOLUTION)
    return F.when(value < 0, -size).otherwise(size)


def percentiles_of_counts(counts: DataFrame, keys: list[str], value: str, n: Column, wanted: dict[str, float]) -> DataFrame:
    """``keys`` and one column per entry of ``wanted`` (name -> share): the
    interpolated percentile of each group's non-null values, each counted ``n``
    times.  ``counts`` has a row per key and distinct value.

    Counts are added up per bucket; running counts over a group's buckets tell
    which of them hold the wanted ranks, and only the values of those buckets
    are ranked: neither step's sort grows with the rows of a group, as it would
    with all of its distinct values.  ``counts`` is read twice, with nothing
    filtered or inferred below it, so that both readers can share its exchange;
    a null value weighs nothing.
    """
    v = F.col(value).cast("double")
    rows = counts.select(*keys, v.alias("v"), _bucket(v).alias("b"), F.when(v.isNotNull(), n).otherwise(0).alias("n"))
    buckets = rows.groupBy(*keys, "b").agg(F.sum("n").alias("n"))
    run = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = buckets.select(*keys, "b", (F.sum("n").over(run) - F.col("n")).alias("before"), "n",
                            F.sum("n").over(Window.partitionBy(*keys)).alias("total"))

    def rank(share: float, up: bool) -> Column:
        at = (F.col("total") - 1) * F.lit(share)
        return F.ceil(at) if up else F.floor(at)

    ranks = {(name, up): rank(share, up) for name, share in wanted.items() for up in (False, True)}
    holds = None
    for r in ranks.values():
        one = (F.col("before") <= r) & (r < F.col("before") + F.col("n"))
        holds = one if holds is None else holds | one
    few = placed.where(holds).select(*keys, "b", "before", "total")
    cond = F.col("c.b").eqNullSafe(F.col("f.b"))
    for k in keys:  # null-safe, as a group's key may be null
        cond = cond & F.col(f"c.{k}").eqNullSafe(F.col(f"f.{k}"))
    inside = rows.alias("c").join(few.alias("f"), cond).select(*[F.col(f"c.{k}") for k in keys], "c.b", "v", "n", "before", "total")
    within = Window.partitionBy(*keys, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("end", F.col("before") + F.sum("n").over(within)).withColumn("start", F.col("end") - F.col("n"))
    picks = [F.max(F.when((F.col("start") <= r) & (r < F.col("end")), F.col("v"))).alias(f"{name}_{int(up)}")
             for (name, up), r in ranks.items()]
    got = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *picks)

    def blend(name: str, share: float) -> Column:
        at = (F.col("total") - 1) * F.lit(share)
        low, high = F.col(f"{name}_0"), F.col(f"{name}_1")
        return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return got.select(*keys, *[blend(name, share).alias(name) for name, share in wanted.items()])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """The percentiles of the values of ``df``'s rows; groups without a value are left out."""
    counts = df.groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return percentiles_of_counts(counts, keys, "v", F.col("n"), wanted)
