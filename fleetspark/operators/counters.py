"""Server counters and settings in long key/value form (S1, X1) and the pivot
that turns them into one numeric row per snapshot.

Long form: ``(instance_id, snapshot_id, captured_at, scope, name, value STRING)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import parse_double

SNAPSHOT = ("instance_id", "snapshot_id")


def counter_name(c: str = "name") -> Column:
    """A counter's or setting's name for comparisons: servers report status
    names capitalised (``Threads_connected``) and compare all names ignoring case."""
    return F.lower(F.col(c))


def kv_like(kv: DataFrame, pattern: str | None = None, scope: str | None = None) -> DataFrame:
    """Counters whose name matches a LIKE pattern (case-insensitive); None/'' = all.

    Names come back as the server wrote them.  Adds ``n_matched``, the number
    of matching names per snapshot.
    """
    out = kv
    if scope:
        out = out.where(F.col("scope") == scope)
    if pattern:
        out = out.where(F.col("name").ilike(pattern))
    w = Window.partitionBy(*SNAPSHOT)
    return out.select(*SNAPSHOT, "scope", "name", "value", F.count(F.lit(1)).over(w).alias("n_matched"))


def kv_numeric(kv: DataFrame) -> DataFrame:
    """Counters that parse as a plain number, as DOUBLE; other rows dropped."""
    v = parse_double("value")
    return kv.select(*SNAPSHOT, "scope", "name", v.alias("value")).where(F.col("value").isNotNull())


def pivot_counters(kv: DataFrame, numeric: list[str], nullable: list[str] = ()) -> DataFrame:
    """One row per snapshot with the named counters as DOUBLE columns.

    Values are parsed to DOUBLE *before* the shuffle and pivoted with
    ``max(when(name = n, v))`` per name: fixed-width buffers keep the
    aggregate a hash aggregate with map-side partials (a pivot over text
    values falls back to a sort-based aggregate).  ``numeric`` columns read 0
    when missing or non-numeric, as the checks expect; ``nullable`` columns
    stay NULL when missing.  Names are matched ignoring case.  One shuffle on
    (instance_id, snapshot_id).
    """
    names = list(numeric) + list(nullable)
    num = kv.where(counter_name().isin(*names)).select(
        *SNAPSHOT, counter_name().alias("name"), (F.col("value") if dict(kv.dtypes)["value"] == "double"
                            else parse_double("value")).alias("v"))
    wide = num.groupBy(*SNAPSHOT).agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in names])
    return wide.select(*SNAPSHOT, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in numeric],
                       *[F.col(n) for n in nullable])
