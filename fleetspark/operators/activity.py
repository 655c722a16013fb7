"""Sessions, operations, statement history, plans and probes
(P2, A5, P3, J6, P11, J11, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_bytes
from ..plans.joins import null_safe_join
from ..plans.percentile import percentiles_of_counts

def _s(c: str):
    return F.coalesce(F.col(c), F.lit(""))


def _visible_processes(procs: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Process rows without the probe's own connection, text NULL -> ''."""
    info = _s("info") if max_bytes is None else cut_bytes(_s("info"), max_bytes)
    return procs.where(~F.coalesce(F.col("is_own_connection"), F.lit(False))).select(
        "instance_id", "id", F.col("user_name").alias("user"), "host", _s("db").alias("db"), "command",
        F.col("time_sec").alias("time"), _s("state").alias("state"),
        info.alias("info"))


def _keep(include_idle: bool, min_time_sec: int, include_no_statement: bool):
    cond = F.lit(True)
    if not include_idle:
        cond = cond & (F.col("command") != "Sleep")
    if min_time_sec > 0:
        cond = cond & (F.col("time") >= min_time_sec)
    if not include_no_statement:
        cond = cond & (F.col("info") != "")
    return cond


def active_processes(procs: DataFrame, include_idle: bool = False, min_time_sec: int = 0,
                     include_no_statement: bool = False, max_bytes: int | None = None) -> DataFrame:
    """Running statements with the reference's filter rules; the whole
    statement, or with ``max_bytes`` its first bytes up to a whole character."""
    return _visible_processes(procs, max_bytes).where(_keep(include_idle, min_time_sec, include_no_statement))


def process_counts(procs: DataFrame, include_idle: bool = False, min_time_sec: int = 0,
                   include_no_statement: bool = False) -> DataFrame:
    """A5: per instance the number of shown processes and of idle ones; idle
    counts every Sleep row before the other filters.  One aggregation."""
    v = _visible_processes(procs)
    keep = _keep(include_idle, min_time_sec, include_no_statement)
    return v.groupBy("instance_id").agg(
        F.count_if(keep).alias("total"),
        F.count_if(F.col("command") == "Sleep").alias("total_idle"))


def long_running_ops(ops: DataFrame, min_secs: int = 0) -> DataFrame:
    """Operations running at least ``min_secs``, without the probe's own
    ``currentOp`` command on ``admin.$cmd`` (first key of the command document)."""
    first_key = F.try_element_at(F.json_object_keys("command_json"), F.lit(1))
    own = (F.col("ns") == "admin.$cmd") & (F.coalesce(first_key, F.lit("")) == "currentOp")
    return ops.where((F.col("secs_running") >= min_secs) & ~own).select(
        "instance_id", "opid", "secs_running", "op", "ns", F.col("command_json").alias("command"), "client",
        F.col("descr").alias("desc"))


def process_statement_history(threads: DataFrame, hist: DataFrame, process_id: int | None = None,
                              sort: bool = False) -> DataFrame:
    """Statement history of connections (threads joined to history on the
    thread) with the connection itself; duration ms = timer / 10^9; NULL text
    -> ''; ``sort`` orders by start."""
    th = threads.where(F.col("processlist_id").isNotNull())
    if process_id is not None:
        th = th.where(F.col("processlist_id") == process_id)
    th = th.select("instance_id", "thread_id", "processlist_id", _s("user_name").alias("user"), _s("host").alias("host"),
                   _s("db").alias("db"), _s("command").alias("command"), F.coalesce("time_sec", F.lit(0)).alias("time"),
                   _s("state").alias("state"), _s("info").alias("info"))
    j = th.join(hist, ["instance_id", "thread_id"])
    out = j.select("instance_id", "processlist_id", "user", "host", "db", "command", "time", "state", "info", "thread_id",
                   "timer_start", _s("sql_text").alias("sql_text"), (F.col("timer_wait") / F.lit(1e9)).alias("duration_ms"),
                   "rows_affected", "rows_sent", "rows_examined", "errors")
    return out.orderBy("instance_id", "processlist_id", "timer_start") if sort else out


def plan_rows_clean(plans: DataFrame) -> DataFrame:
    """Captured plan rows with NULL text -> ''."""
    return plans.select("instance_id", "database_name", "id", "select_type", _s("table_name").alias("table"),
                        _s("partitions").alias("partitions"), "access_type", _s("possible_keys").alias("possible_keys"),
                        _s("used_key").alias("key"), _s("key_len").alias("key_len"), _s("ref").alias("ref"),
                        F.col("est_rows").alias("rows"), F.coalesce(F.col("filtered").cast("double"), F.lit(0.0)).alias("filtered"),
                        _s("extra").alias("extra"))


def unused_indexes(index_columns: DataFrame, plans: DataFrame, database: str | None = None,
                   include_primary: bool = False) -> DataFrame:
    """Indexes never chosen as the key of any captured plan row.

    Distinct index keys anti-joined with the distinct used keys: the shuffle
    carries one row per index, not per column or plan row.
    """
    idx = index_columns.select("instance_id", F.col("table_schema").alias("database_name"), "table_name",
                               "index_name").distinct()
    if not include_primary:
        idx = idx.where(F.col("index_name") != "PRIMARY")
    if database is not None:
        idx = idx.where(F.col("database_name") == database)
    used = (plans.where(F.col("used_key").isNotNull())
            .select("instance_id", "database_name", "table_name", F.col("used_key").alias("index_name")).distinct())
    return idx.join(used, ["instance_id", "database_name", "table_name", "index_name"], "left_anti")


def index_usage(index_columns: DataFrame, plans: DataFrame, calls: DataFrame, include_primary: bool = False) -> DataFrame:
    """J11 by the evidence of a slow log: per index the logged calls whose captured plan chose it, and their time.

    ``plans`` are plan rows with the ``fingerprint`` of their statement;
    ``calls`` has (instance_id, fingerprint, calls, total_ms), such as a digest
    or its stored count tables give.  The two meet on a 64-bit hash of the
    fingerprint, so no statement text is shuffled.  A plan that chose an index
    in several rows of a statement counts each call once.  Indexes without
    evidence have 0 calls.
    """
    key = F.xxhash64("fingerprint").alias("_statement")
    index = ["instance_id", "database_name", "table_name", "index_name"]
    chosen = (plans.where(F.col("used_key").isNotNull() & F.col("fingerprint").isNotNull())
              .select("instance_id", "database_name", "table_name", F.col("used_key").alias("index_name"), key).distinct())
    logged = calls.select("instance_id", key, "calls", "total_ms").groupBy("instance_id", "_statement").agg(
        F.sum("calls").alias("calls"), F.sum("total_ms").alias("total_ms"))
    # null-safe, as a plain join would hand "is not null" down to some readers of the digest's count table only,
    # which then could not share it: the log would be parsed again for each
    used = null_safe_join(chosen.where(F.col("instance_id").isNotNull()), logged, ["instance_id", "_statement"]).groupBy(*index).agg(
        F.sum("calls").alias("calls"), F.sum("total_ms").alias("total_ms"), F.count(F.lit(1)).alias("statements"))
    idx = index_columns.select("instance_id", F.col("table_schema").alias("database_name"), "table_name", "index_name").distinct()
    if not include_primary:
        idx = idx.where(F.col("index_name") != "PRIMARY")
    zero = F.lit(0).cast("long")
    return idx.join(used, index, "left").select(
        *index, F.coalesce("statements", zero).alias("statements"), F.coalesce("calls", zero).alias("calls"),
        F.coalesce("total_ms", F.lit(0.0)).alias("total_ms"))


def probe_summary(probes: DataFrame) -> DataFrame:
    """Per instance probes, success rate, and p50 / p95 latency of the
    successful probes (failures log 0 and do not count; NULL if none).

    All of it follows from the probes per instance and latency, counted in one
    pass; a failed probe is counted under no latency.
    """
    counts = probes.groupBy("instance_id", F.when(F.col("success"), F.col("latency_ms")).alias("latency_ms")).agg(
        F.count(F.lit(1)).alias("probes"), F.count_if(F.col("success")).alias("good"))
    counts = counts.where((F.col("probes") > 0) | (F.col("good") > 0))  # every reader asks for both: one shared exchange
    totals = counts.groupBy("instance_id").agg(
        F.sum("probes").alias("probes"), (F.sum("good") / F.sum("probes")).alias("success_rate"))
    lat = percentiles_of_counts(counts, ["instance_id"], "latency_ms", F.col("good"), {"p50_ms": 0.5, "p95_ms": 0.95})
    return null_safe_join(totals, lat, ["instance_id"], "left").select(
        "instance_id", "probes", "success_rate", F.round("p50_ms", 3).alias("p50_ms"), F.round("p95_ms", 3).alias("p95_ms"))
