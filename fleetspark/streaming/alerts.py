"""Health checks on a stream of wide counter snapshots; non-ok rows out.

Stateless (one projection and a stream-static join with the instance-class
lookup, which is read anew for every batch), so it runs in append mode without
a watermark, unless snapshots that come again are to be dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import counter
from ..operators.counters import SNAPSHOT
from ..operators.checks import CHECK_COUNTERS, ENGINE_HISTORY, check_rows, class_memory_lookup
from .metrics import event_time


def wide_snapshot_counters(snapshots: DataFrame, class_memory: DataFrame) -> DataFrame:
    """Wide snapshot rows (one column per counter) -> the check input frame.

    Numeric columns convert straight to DOUBLE (the same value as their text
    parsed); text columns go through the strict parse.
    """
    types = dict(snapshots.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    cols = [(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if types.get(c) in numeric
             else counter(F.col(c).cast("string"))).alias(c) for c in CHECK_COUNTERS]
    hist = F.col("history_list_length").cast("bigint").cast("double").alias(ENGINE_HISTORY)
    w = snapshots.select("instance_id", "snapshot_id", "instance_class", *cols, hist)
    return w.join(class_memory_lookup(class_memory), "instance_class", "left")


def health_alerts_stream(snapshots: DataFrame, class_memory: DataFrame, once_within: str | None = None,
                         ts_col: str = "captured_at") -> DataFrame:
    """Checks H1-H12 for every arriving snapshot; only warning / critical rows.

    With ``once_within`` (such as '1 day'), a watermark on ``ts_col``, a
    snapshot that is delivered again within it alerts once; the state holds the
    snapshot keys of that time.
    """
    if once_within is not None:
        snapshots = event_time(snapshots, ts_col).withWatermark(ts_col, once_within).dropDuplicatesWithinWatermark(list(SNAPSHOT))
    rows = check_rows(wide_snapshot_counters(snapshots, class_memory))
    return rows.where(F.col("status") != "ok").drop("total_checks")
