"""Metric roll-up as a continuous job (tumbling periods, watermark, append)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def utc_instant(c: str) -> Column:
    """A TIMESTAMP_NTZ that is UTC wall-clock time -> the instant, whatever the
    session's time zone (a plain cast would read it in that zone)."""
    return F.expr(f"timestamp_micros(unix_date(cast({c} as date)) * 86400000000L + hour({c}) * 3600000000L"
                  f" + minute({c}) * 60000000L + cast(extract(second from {c}) * 1000000 as bigint))")


def utc_wall_clock(c: str) -> Column:
    """An instant -> its UTC wall-clock time as TIMESTAMP_NTZ."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({c}), TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not NTZ)."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return df.withColumn(col, utc_instant(col))
    return df


def _rollup(points: DataFrame, period: str) -> DataFrame:
    g = points.groupBy("instance_id", "metric", F.window("ts", period).alias("w"))
    return g.agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_points")).select(
        "instance_id", "metric", F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"),
        "avg_value", "n_points")


def metric_rollup_stream(points: DataFrame, period: str = "5 minutes", watermark: str = "10 minutes",
                         once_by: list[str] | None = None) -> DataFrame:
    """Average per (instance, metric, period) on a stream of metric points.

    A period is emitted once the watermark (latest event time minus
    ``watermark``) passes its end; later points for it are dropped.  State
    holds only the open periods.

    ``once_by`` names the columns that tell points apart: of points that agree
    in them and come within the watermark of each other (a file delivered
    again, an agent that repeats itself) the first counts.  Its state holds the
    keys of that time.
    """
    timed = event_time(points).withWatermark("ts", watermark)
    return _rollup(timed.dropDuplicatesWithinWatermark(once_by) if once_by else timed, period)


def open_periods(points: DataFrame, period: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """The periods that the stream still holds open once it has read ``points``.

    Only points from a period before the watermark on are read: the bound is a
    literal on the event time, found by one aggregate over it.
    """
    last = points.agg(F.max("ts").alias("ts"))
    at = event_time(last).select((F.col("ts") - F.expr(f"interval {watermark}")).alias("w"),
                                 (F.col("ts") - F.expr(f"interval {watermark}") - F.expr(f"interval {period}")).alias("from"))
    raw = last.select((F.col("ts") - F.expr(f"interval {watermark}") - F.expr(f"interval {period}")).cast("string").alias("raw"))
    mark, low = at.select(F.unix_micros("w")).first()[0], raw.first()[0]
    kind = points.schema["ts"].dataType.simpleString()
    recent = points if low is None else points.where(F.col("ts") >= F.lit(low).cast(kind))
    return _rollup(event_time(recent), period).where(F.unix_micros("period_end") > F.lit(mark).cast("bigint"))
