"""Stored period tables and look-backs that read the fewest of them.

Raw points or samples are added up once per minute; hours are made of minutes
and days of hours.  Each table has (keys, ``period_start``, ``n``, ``total``)
and is partitioned by day, so a day that arrives late or again is replaced
alone.  A look-back of any length is then cut into whole days, the whole hours
on either side, the whole minutes on either side of those, and two raw edges of
less than a minute: a month ending now reads some thirty days, at most 46 hours
and 118 minutes per key instead of every point.

``n`` and ``total`` add up exactly for counts and whole numbers; sums of
fractions may differ from the raw path in the last digit, as any other order of
additions would.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import write_report
from .timeseries import as_of_lit

#: Levels from fine to coarse.
LEVELS = {"minute": dt.timedelta(minutes=1), "hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1)}
INSTANT = dt.timedelta(microseconds=1)
EPOCH = dt.datetime(1970, 1, 1)


def _sums(df: DataFrame, keys: list[str], ts: str, level: str, n, total) -> DataFrame:
    w = F.window(ts, f"1 {level}").alias("w")
    return df.groupBy(*keys, w).agg(F.sum(n).alias("n"), F.sum(total).alias("total")).select(
        *keys, F.col("w.start").alias("period_start"), "n", "total", F.to_date("w.start").alias("period_day"))


def write_periods(raw: DataFrame, folder: str, keys: list[str], ts: str = "ts", value: str | None = None) -> str:
    """Store the three tables of ``raw`` under ``folder``, replacing the days that ``raw`` has (whole days of it).

    ``value`` is added up per key and period, and its non-null values are
    counted; without it rows are counted and ``total`` is null.
    """
    spark, n = raw.sparkSession, F.lit(1) if value is None else F.col(value).isNotNull().cast("long")
    total = F.lit(None).cast("long") if value is None else F.col(value)
    rows = _sums(raw.where(F.col(ts).isNotNull()), keys, ts, "minute", n, total)
    days = None
    for level in LEVELS:
        path = f"{folder}/{level}"
        write_report(rows, path, partition_by="period_day", mode="replace")
        stored = spark.read.parquet(path)
        if days is None:
            days = [r["period_day"] for r in rows.select("period_day").distinct().collect()]  # one row per day of ``raw``
        coarser = list(LEVELS)[list(LEVELS).index(level) + 1:][:1]
        if coarser:
            rows = _sums(stored.where(F.col("period_day").isin(days)), keys, "period_start", coarser[0], F.col("n"), F.col("total"))
    return folder


def cover(start: dt.datetime, end: dt.datetime, coarsest: str = "day") -> list[tuple[str, dt.datetime, dt.datetime]]:
    """(level, from, before) ranges that make up ``start <= t < end``: the coarsest periods in the middle, finer ones beside them.

    Ranges of one level are ascending, disjoint and not empty; ``raw`` ranges are shorter than a minute.
    """
    names = list(LEVELS)[:list(LEVELS).index(coarsest) + 1]
    out, gaps = [], [(start, end)]
    for level in reversed(names):
        size, rest = LEVELS[level], []
        for a, b in gaps:
            first, last = EPOCH - ((EPOCH - a) // size) * size, EPOCH + ((b - EPOCH) // size) * size
            if first < last:
                out.append((level, first, last))
                rest += [(a, first), (last, b)]
            else:
                rest.append((a, b))
        gaps = [(a, b) for a, b in rest if a < b]
    return out + [("raw", a, b) for a, b in gaps]


def read_periods(raw: DataFrame, folder: str, keys: list[str], as_of: dt.datetime, lookback: dt.timedelta, ts: str = "ts",
                 value: str | None = None, coarsest: str = "day", date_col: str | None = None) -> DataFrame:
    """``keys, period_start, n, total`` whose sums are those of the rows of ``raw`` with ``as_of - lookback <= ts <= as_of``.

    ``raw`` is read for the edges only; with ``date_col``, its partition column
    of days, the scan opens no other day.  Use a ``coarsest`` level that divides
    the periods wanted of the result.
    """
    spark, parts = raw.sparkSession, []
    ranges = cover(as_of - lookback, as_of + INSTANT, coarsest)
    at = lambda df, c, t: as_of_lit(df, c, t.strftime("%Y-%m-%d %H:%M:%S.%f"))
    for level in ("raw", *LEVELS):
        mine = sorted((a, b) for name, a, b in ranges if name == level)
        if not mine:
            continue
        df = raw if level == "raw" else spark.read.parquet(f"{folder}/{level}")
        when, day = (ts, date_col) if level == "raw" else ("period_start", "period_day")
        cond = F.lit(False)
        for a, b in mine:
            inside = (F.col(when) >= at(df, when, a)) & (F.col(when) < at(df, when, b))
            if day is not None:
                inside = inside & F.col(day).between(F.lit(a.date()), F.lit((b - INSTANT).date()))
            cond = cond | inside
        rows = df.where(cond)
        if level == "raw":
            n = F.lit(1) if value is None else F.col(value).isNotNull().cast("long")
            rows = _sums(rows, keys, ts, "minute", n, F.lit(None).cast("long") if value is None else F.col(value))
        parts.append(rows.select(*keys, "period_start", "n", "total"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
