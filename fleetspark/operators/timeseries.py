"""Metric points, load samples and event feeds.

All look-backs take an explicit ``as_of``; nothing reads the clock.  A window
is ``as_of - lookback <= ts <= as_of``.  Range filters on the timestamp reach
the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# The ten instance metrics and their unit factors
# (bytes -> MiB, bytes -> GiB, seconds -> milliseconds).
METRIC_UNITS = (
    ("cpu", "cpu_percent", 1.0),
    ("connections", "connections", 1.0),
    ("memory", "freeable_memory_mb", 1.0 / (1024 * 1024)),
    ("storage", "free_storage_gb", 1.0 / (1024 * 1024 * 1024)),
    ("read_iops", "read_iops", 1.0),
    ("write_iops", "write_iops", 1.0),
    ("read_latency", "read_latency_ms", 1000.0),
    ("write_latency", "write_latency_ms", 1000.0),
    ("net_rx", "network_rx_mib_s", 1.0 / (1024 * 1024)),
    ("net_tx", "network_tx_mib_s", 1.0 / (1024 * 1024)),
)


# Cloud metric names per metric id; the document-store engine
# ('docdb') reports storage and network under other names.
CLOUD_METRIC_NAMES = {
    "cpu": "CPUUtilization",
    "connections": "DatabaseConnections",
    "memory": "FreeableMemory",
    "storage": "FreeStorageSpace",
    "read_iops": "ReadIOPS",
    "write_iops": "WriteIOPS",
    "read_latency": "ReadLatency",
    "write_latency": "WriteLatency",
    "net_rx": "NetworkReceiveThroughput",
    "net_tx": "NetworkTransmitThroughput",
}
DOCDB_METRIC_NAMES = {
    "storage": "FreeLocalStorage",
    "net_rx": "NetworkBytesIn",
    "net_tx": "NetworkBytesOut",
}


def points_from_cloud_names(raw: DataFrame, instances: DataFrame, name_col: str = "metric_name") -> DataFrame:
    """Raw points named as the cloud service names them -> points with metric ids.

    The engine of each instance picks the name set (a join on the inventory,
    which AQE broadcasts when small); names outside the set are dropped.
    """
    eng = instances.select("instance_id", (F.col("engine") == "docdb").alias("_docdb"))
    j = raw.join(eng, "instance_id")
    mid = None
    for metric, name in CLOUD_METRIC_NAMES.items():
        doc = DOCDB_METRIC_NAMES.get(metric, name)
        cond = F.when(F.col("_docdb"), F.col(name_col) == doc).otherwise(F.col(name_col) == name)
        mid = F.when(cond, F.lit(metric)) if mid is None else mid.when(cond, F.lit(metric))
    return (j.withColumn("metric", mid).where(F.col("metric").isNotNull())
            .select("instance_id", "metric", "ts", "value"))


def as_of_lit(df: DataFrame, ts_col: str, as_of) -> Column:
    """``as_of`` as a literal of the same timestamp flavour as ``df[ts_col]``
    (NTZ stays NTZ, so no session time zone enters the comparison)."""
    text = as_of.strftime("%Y-%m-%d %H:%M:%S") if isinstance(as_of, (dt.datetime, dt.date)) else str(as_of)
    is_ntz = isinstance(df.schema[ts_col].dataType, TimestampNTZType)
    return F.lit(text).cast("timestamp_ntz" if is_ntz else "timestamp")


def in_lookback(df: DataFrame, ts_col: str, as_of, lookback: str, date_col: str | None = None) -> DataFrame:
    """Rows with ``as_of - lookback <= ts <= as_of`` (lookback like '15 minutes').

    ``date_col`` names a date column the table is partitioned by (the date of
    ``ts``); the same window on it lets the scan skip whole partitions, while
    the timestamp range still decides row by row.
    """
    end = as_of_lit(df, ts_col, as_of)
    start = end - F.expr(f"INTERVAL {lookback}")
    cond = (F.col(ts_col) >= start) & (F.col(ts_col) <= end)
    if date_col is not None:
        cond = (F.col(date_col) >= F.to_date(start)) & (F.col(date_col) <= F.to_date(end)) & cond
    return df.where(cond)


def _ts_text(c) -> Column:
    return F.date_format(c, RFC3339)


# ------------------------------------------------------------------ A7


def metric_rollup(points: DataFrame, period: str = "5 minutes") -> DataFrame:
    """Average per (instance, metric, fixed period).  Partial aggregation
    runs map-side, so the shuffle carries one row per key and period."""
    g = points.groupBy("instance_id", "metric", F.window("ts", period).alias("w"))
    return g.agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_points")).select(
        "instance_id", "metric", F.col("w.start").alias("period_start"), "avg_value", "n_points")


# ------------------------------------------------------------------ W1


def latest_metrics(points: DataFrame, instances: DataFrame, as_of, lookback: str = "15 minutes",
                   period: str = "5 minutes", metrics=METRIC_UNITS, date_col: str | None = None) -> DataFrame:
    """One row per instance with the newest period average of each metric
    within the look-back, scaled to its unit, 0 when there is none.

    The newest-period pick and the pivot are one aggregation per instance:
    ``max_by(avg, period_start)`` restricted to each metric by ``when``.
    """
    names = [m[0] for m in metrics]
    roll = metric_rollup(in_lookback(points.where(F.col("metric").isin(*names)), "ts", as_of, lookback, date_col),
                         period)
    return latest_of_rollup(roll, instances, metrics)


def rollup_of_periods(periods: DataFrame, period: str = "5 minutes") -> DataFrame:
    """A7 from stored sums (``n``, ``total`` per ``period_start``) of periods that divide ``period``."""
    g = periods.groupBy("instance_id", "metric", F.window("period_start", period).alias("w"))
    return g.agg((F.sum("total") / F.sum("n")).alias("avg_value"), F.sum("n").alias("n_points")).select(
        "instance_id", "metric", F.col("w.start").alias("period_start"), "avg_value", "n_points")


def latest_of_rollup(roll: DataFrame, instances: DataFrame, metrics=METRIC_UNITS) -> DataFrame:
    """W1 from period averages."""
    names = [m[0] for m in metrics]
    aggs = [F.max_by(F.when(F.col("metric") == m, F.col("avg_value")),
                     F.when(F.col("metric") == m, F.col("period_start"))).alias(m) for m in names]
    latest = roll.groupBy("instance_id").agg(*aggs)
    j = instances.select("instance_id", "engine").join(latest, "instance_id", "left")
    return j.select("instance_id", "engine",
                    *[(F.coalesce(F.col(m), F.lit(0.0)) * F.lit(f)).alias(out) for m, out, f in metrics])


# ------------------------------------------------------------------ J7


def replica_lag(instances: DataFrame, points: DataFrame, as_of, source: str | None = None,
                metric: str = "replica_lag", lookback: str = "5 minutes", period: str = "60 seconds",
                date_col: str | None = None) -> DataFrame:
    """Replicas (non-empty source) with the newest period average of the
    lag metric in the look-back; -1 when there is none.  One left join on a
    pre-aggregated latest-value table replaces one metric call per replica."""
    reps = instances.where(F.coalesce(F.col("source_instance_id"), F.lit("")) != "")
    if source is not None:
        reps = reps.where(F.col("source_instance_id") == source)
    roll = metric_rollup(in_lookback(points.where(F.col("metric") == metric), "ts", as_of, lookback, date_col), period)
    latest = roll.groupBy("instance_id").agg(F.max_by("avg_value", "period_start").alias("lag"))
    j = reps.join(latest, "instance_id", "left")
    return j.select(F.col("instance_id").alias("identifier"), F.col("source_instance_id").alias("source"),
                    "status", F.col("instance_class").alias("class"), "availability_zone", "multi_az", "engine",
                    "engine_version", F.coalesce(F.col("lag"), F.lit(-1.0)).alias("replica_lag_seconds"))


def replica_cascades(lags: DataFrame) -> DataFrame:
    """J7 along chains of replicas: per row of ``replica_lag`` the root source,
    its depth below it, and the lag summed over the hops to it.

    A replica of a replica reports the lag of its own hop only.  A hop whose lag
    is unknown (-1) makes the sum -1.  Replicas whose chain runs in a circle have
    no root: null, depth null, lag -1.  One recursive query steps up a hop at a
    time; it has a row per replica and hop.  LIMIT ALL and the recursion level
    lift Spark's limits for such queries: a path holds no replica twice, so the
    recursion ends.
    """
    hop = lags.select("identifier", "source", F.when(F.col("replica_lag_seconds") >= 0, F.col("replica_lag_seconds")).alias("lag"))
    chain = lags.sparkSession.sql("""
        WITH RECURSIVE chain(identifier, up, hops, lag, path) MAX RECURSION LEVEL 1000000 AS (
          SELECT identifier, source, 1, lag, array(identifier) FROM {hop}
          UNION ALL
          SELECT c.identifier, h.source, c.hops + 1, c.lag + h.lag, array_append(c.path, h.identifier)
          FROM chain c JOIN {hop} h ON h.identifier = c.up WHERE NOT array_contains(c.path, h.identifier))
        SELECT identifier, max_by(struct(up, hops, lag, array_contains(path, up) AS circle), hops) AS last FROM (SELECT * FROM chain LIMIT ALL) GROUP BY identifier""", hop=hop)
    last = F.col("last")
    top = chain.select("identifier", F.when(~last["circle"], last["up"]).alias("root_source"),
                       F.when(~last["circle"], last["hops"].cast("long")).alias("depth"),
                       F.when(~last["circle"], last["lag"]).alias("_lag"))
    return lags.select("identifier", "source", "replica_lag_seconds").join(top, "identifier").select(
        "identifier", "source", "root_source", "depth", "replica_lag_seconds", F.coalesce("_lag", F.lit(-1.0)).alias("total_lag_seconds"))


# ------------------------------------------------------------------ A8, A9


def top_by_load(samples: DataFrame, keys: list[str], as_of, minutes: int = 60, k: int = 10,
                seconds_per_sample: float = 1.0, date_col: str | None = None) -> DataFrame:
    """Top-k per instance by average active sessions over the look-back.

    Aggregate first (one row per instance and key), then rank: the window sees
    aggregated rows, not samples.  Ties go to the smaller key text.
    """
    s = in_lookback(samples, "ts", as_of, f"{int(minutes)} minutes", date_col)
    agg = s.groupBy("instance_id", *keys).agg(F.count(F.lit(1)).alias("samples"))
    return ranked_load(agg, keys, minutes, k, seconds_per_sample)


def ranked_load(agg: DataFrame, keys: list[str], minutes: int, k: int = 10, seconds_per_sample: float = 1.0) -> DataFrame:
    """Top-k per instance of ``samples`` counted per key, from raw samples or from stored periods."""
    load = F.col("samples") * F.lit(float(seconds_per_sample)) / F.lit(minutes * 60.0)
    w = Window.partitionBy("instance_id").orderBy(F.desc("samples"), *[F.asc(c) for c in keys])
    ranked = agg.select("instance_id", *keys, load.alias("db_load"), F.row_number().over(w).cast("bigint").alias("rank"))
    return ranked.where(F.col("rank") <= k)


def top_sql_by_load(samples: DataFrame, as_of, minutes: int = 60, k: int = 10,
                    seconds_per_sample: float = 1.0, date_col: str | None = None) -> DataFrame:
    """Top statements by load per instance."""
    return top_by_load(samples, ["statement"], as_of, minutes, k, seconds_per_sample, date_col)


def top_waits_by_load(samples: DataFrame, as_of, minutes: int = 60, k: int = 10,
                      seconds_per_sample: float = 1.0, date_col: str | None = None) -> DataFrame:
    """Top (wait type, wait name) by load per instance."""
    return top_by_load(samples, ["wait_type", "wait_name"], as_of, minutes, k, seconds_per_sample, date_col)


# ------------------------------------------------------------------ P4


def event_lookback(events: DataFrame, as_of, minutes: int = 1440, source: str | None = None,
                   date_col: str | None = None) -> DataFrame:
    """Events of one source (or all) within the last ``minutes`` of ``as_of``."""
    e = in_lookback(events, "event_time", as_of, f"{int(minutes)} minutes", date_col)
    if source is not None:
        e = e.where(F.col("source_identifier") == source)
    cats = F.col("categories") if "categories" in events.columns else F.array(F.col("category"))
    return e.select(_ts_text(F.col("event_time")).alias("date"), "message", cats.alias("categories"),
                    "source_identifier")
