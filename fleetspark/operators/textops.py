"""Free-text telemetry: engine status reports (X5, X7) and slow logs.

Everything is native ``regexp_extract`` / ``regexp_replace`` inside whole-stage
codegen; no Python UDF touches the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.joins import null_safe_join
from ..plans.percentile import percentiles_of_counts


# Patterns with several numbers are matched once; the numbers are then read from
# the short match: name -> (pattern, literal, decimal numbers).  Patterns that
# start with a digit group are searched only in the lines holding a literal every
# match contains (None: whole text).
_MULTI = {
    "rw_shared": (T.RW_SHARED, None, False),
    "rw_excl": (T.RW_EXCL, None, False),
    "file_io": (T.FILE_IO_RATE, " avg bytes/read, ", True),
    "bp_hit": (T.BP_HIT_RATE, None, False),
    "bp_rw": (T.BP_RW_RATE, " creates/s, ", True),
    "queries": (T.QUERIES_INSIDE, " queries inside InnoDB, ", False),
    "row_ops": (T.ROW_OPS_RATE, " inserts/s, ", True),
}

# One-number patterns: column -> pattern; each number stands in one group.
_NUMBERS = {
    "sem_reservation_count": T.RESERVATION_COUNT,
    "sem_signal_count": T.SIGNAL_COUNT,
    "trx_id_counter": T.TRX_ID_COUNTER,
    "trx_history_list_length": T.HISTORY_LENGTH,
    "log_sequence_number": T.LOG_SEQUENCE,
    "log_flushed_up_to": T.LOG_FLUSHED,
    "log_last_checkpoint": T.LAST_CHECKPOINT,
    "bp_size_pages": T.BP_SIZE,
    "bp_free_pages": T.BP_FREE,
    "bp_database_pages": T.BP_DATABASE,
    "bp_modified_pages": T.BP_MODIFIED,
}

# Numbers out of those matches: column -> (match, which of its numbers).
_IN_MATCH = {
    "sem_rw_shared_spins": ("rw_shared", 0), "sem_rw_shared_os_waits": ("rw_shared", 2),
    "sem_rw_excl_spins": ("rw_excl", 0), "sem_rw_excl_os_waits": ("rw_excl", 2),
    "io_reads_per_sec": ("file_io", 0), "io_writes_per_sec": ("file_io", 2), "io_log_writes_per_sec": ("file_io", 3),
    "bp_reads_per_sec": ("bp_rw", 0), "bp_writes_per_sec": ("bp_rw", 2),
    "row_queries_inside": ("queries", 0), "row_queries_in_queue": ("queries", 1),
    "row_inserts_per_sec": ("row_ops", 0), "row_updates_per_sec": ("row_ops", 1),
    "row_deletes_per_sec": ("row_ops", 2), "row_reads_per_sec": ("row_ops", 3),
    "_hit_a": ("bp_hit", 0), "_hit_b": ("bp_hit", 1),
}

STATUS_COLUMNS = [
    "monitor_time", "sem_reservation_count", "sem_signal_count", "sem_rw_shared_spins", "sem_rw_shared_os_waits", "sem_rw_excl_spins",
    "sem_rw_excl_os_waits", "has_deadlock", "trx_id_counter", "trx_history_list_length", "io_reads_per_sec", "io_writes_per_sec",
    "io_log_writes_per_sec", "log_sequence_number", "log_flushed_up_to", "log_last_checkpoint", "bp_size_pages", "bp_free_pages",
    "bp_database_pages", "bp_modified_pages", "bp_hit_rate_pct", "bp_reads_per_sec", "bp_writes_per_sec", "row_queries_inside",
    "row_queries_in_queue", "row_inserts_per_sec", "row_updates_per_sec", "row_deletes_per_sec", "row_reads_per_sec"]


def innodb_status(status: DataFrame, text_col: str = "status_text",
                  keys=("instance_id", "snapshot_id")) -> DataFrame:
    """The engine status report parsed into a timestamp and 27 numbers in
    six groups (flat, group-prefixed columns); 0 / '' where a pattern is absent.

    The report is cut into lines and matched, each pattern once, in one
    projection; the numbers of each match become an array in the next, and the
    columns are read from the arrays.
    """
    x = F.col("_t")
    lines = status.select(*keys, F.col(text_col).alias("_t"), F.split(text_col, "\n").alias("_lines"))
    whole = lambda d: F.coalesce(T.to_bigint(d), F.lit(0).cast("bigint"))
    matches = lines.select(
        *keys, F.regexp_extract(x, T.MONITOR_TIME, 1).alias("monitor_time"), x.contains(T.DEADLOCK_MARK).alias("has_deadlock"),
        F.transform(F.array(*[F.regexp_extract(x, p, 1) for p in _NUMBERS.values()]), whole).alias("_numbers"),
        *[(T.first_match_in_lines("_lines", p, lit) if lit else F.regexp_extract(x, p, 0)).alias(k) for k, (p, lit, _) in _MULTI.items()])
    parts = matches.select(*keys, "monitor_time", "has_deadlock", "_numbers", *[
        F.transform(F.regexp_extract_all(k, F.lit(T.UNSIGNED), F.lit(0)), (lambda d: d.try_cast("double")) if decimal else T.to_bigint).alias(k)
        for k, (_, _, decimal) in _MULTI.items()])
    zero = {k: F.lit(0.0) if decimal else F.lit(0).cast("bigint") for k, (_, _, decimal) in _MULTI.items()}
    out = parts.select(*keys, "monitor_time", "has_deadlock", *[F.get("_numbers", F.lit(i)).alias(c) for i, c in enumerate(_NUMBERS)],
                       *[F.coalesce(F.get(k, F.lit(i)), zero[k]).alias(c) for c, (k, i) in _IN_MATCH.items()])
    hit = F.when(F.col("_hit_b") > 0, F.col("_hit_a").cast("double") / F.col("_hit_b").cast("double") * 100).otherwise(F.lit(0.0))
    return out.withColumn("bp_hit_rate_pct", hit).select(*keys, *STATUS_COLUMNS)


def deadlocks(status: DataFrame, text_col: str = "status_text", keys=("instance_id", "snapshot_id")) -> DataFrame:
    """Latest deadlock of each report that has one, read only between the
    deadlock heading and the next TRANSACTIONS line: time ('' if none), victim
    transaction number (0 if none) and the non-empty queries in order."""
    t = F.col(text_col)
    sec = T.section_between(t, T.DEADLOCK_START, T.DEADLOCK_END)
    queries = F.filter(F.transform(F.regexp_extract_all(sec, F.lit(T.TX_QUERY), 1),
                                   lambda q: F.regexp_replace(q, r"^\s+|\s+$", "")),
                       lambda q: q != "")
    return (status.where(t.contains(T.DEADLOCK_MARK))
            .select(*keys, F.regexp_extract(sec, T.DEADLOCK_TIME, 1).alias("deadlock_time"),
                    F.coalesce(F.regexp_extract(sec, T.DEADLOCK_VICTIM, 1).try_cast("int"), F.lit(0)).alias("victim"),
                    queries.alias("queries")))


def slow_log_records(records: DataFrame, text_col: str = "record_text",
                     keys=("instance_id", "rec_id")) -> DataFrame:
    """Slow-log records -> query and lock time in ms, rows sent / examined,
    user@host and the statement text (header lines removed).  Times are parsed
    as decimals so '8.37' s is exactly 8370 ms.

    The timing fields are read from the '# Query_time:' header line, cut out
    once (literal-led pattern, fast), instead of scanning the whole record
    (statement included) once per field.
    """
    t = F.col(text_col)
    staged = records.select(*keys, t.alias("_t"), F.regexp_extract(t, T.SLOW_TIMING_LINE, 0).alias("_h"))
    h = F.col("_h")
    ms = lambda p: (F.regexp_extract(h, p, 1).try_cast("decimal(20,6)") * 1000).cast("double")
    return staged.select(
        *keys,
        ms(T.SLOW_QUERY_TIME).alias("query_ms"),
        ms(T.SLOW_LOCK_TIME).alias("lock_ms"),
        F.regexp_extract(h, T.SLOW_ROWS_SENT, 1).try_cast("bigint").alias("rows_sent"),
        F.regexp_extract(h, T.SLOW_ROWS_EXAMINED, 1).try_cast("bigint").alias("rows_examined"),
        F.regexp_extract("_t", T.SLOW_USER_HOST, 1).alias("user_host"),
        F.regexp_replace("_t", T.SLOW_HEADER_LINES, "").alias("sql_text"),
    )


def query_fingerprint(records: DataFrame, sql_col: str = "sql_text") -> DataFrame:
    """Adds the statement fingerprint."""
    return records.withColumn("fingerprint", T.fingerprint(F.col(sql_col)))


def digest_counts(parsed: DataFrame, by=("instance_id",)) -> DataFrame:
    """A10's count table: per log (``by``), fingerprint and time value the calls,
    rows and least statement text.

    All of a digest follows from it, exact percentiles included, and the tables
    of several logs or days merge into the table of all of them
    (``merge_digest_counts``), so that a log is parsed once and its table kept.
    """
    fp = parsed if "fingerprint" in parsed.columns else query_fingerprint(parsed)
    return fp.groupBy(*by, "fingerprint", "query_ms").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("rows_sent").alias("rows_sent"),
        F.sum("rows_examined").alias("rows_examined"), F.min("sql_text").alias("sample"))


def merge_digest_counts(counts: DataFrame, by=("instance_id",)) -> DataFrame:
    """One count table out of several tables' rows (a union, or stored days); other columns are dropped."""
    return counts.groupBy(*by, "fingerprint", "query_ms").agg(
        F.sum("calls").alias("calls"), F.sum("rows_sent").alias("rows_sent"),
        F.sum("rows_examined").alias("rows_examined"), F.min("sample").alias("sample"))


def digest_of_counts(counts: DataFrame, by=("instance_id",), sort: bool = False) -> DataFrame:
    """A10 from a count table with one row per log, fingerprint and time value."""
    keys = [*by, "fingerprint"]
    # rows that count something: asking for every column lets all readers of the
    # table below share one exchange, so that the log is scanned and parsed once
    counts = counts.where((F.col("calls") > 0) | (F.col("rows_sent") > 0) | (F.col("rows_examined") > 0) | F.col("sample").isNotNull())
    ms = F.col("query_ms") * F.col("calls")
    g = counts.groupBy(*keys).agg(
        F.sum("calls").alias("calls"),
        F.sum(ms).alias("total_ms"),
        (F.sum(ms) / F.sum(F.when(F.col("query_ms").isNotNull(), F.col("calls")))).alias("avg_ms"),
        F.max("query_ms").alias("max_ms"),
        F.sum("rows_sent").alias("rows_sent"),
        F.sum("rows_examined").alias("rows_examined"),
        F.min_by("sample", F.struct(-F.col("query_ms"), F.col("sample"))).alias("sample"),
    )
    p95 = percentiles_of_counts(counts, keys, "query_ms", F.col("calls"), {"p95_ms": 0.95})
    total = counts.groupBy(*by).agg(F.sum(ms).alias("_log_ms"))
    out = (null_safe_join(null_safe_join(g, p95, keys, "left"), total, list(by))
           .select(*keys, "calls", "total_ms", "avg_ms", "max_ms", F.round("p95_ms", 3).alias("p95_ms"), "rows_sent",
                   "rows_examined", "sample", (F.col("total_ms") / F.col("_log_ms")).alias("share")))
    return out.orderBy(*by, F.desc("total_ms"), "fingerprint") if sort else out


def slow_query_digest(parsed: DataFrame, by=("instance_id",), sort: bool = False) -> DataFrame:
    """A10: per log (instance) and fingerprint: calls, total / avg / max / p95
    ms, rows sent / examined, share of the log's total time, and the text of
    the slowest call (ties to the smallest text).

    The log becomes its count table in one map-side aggregated pass; totals,
    percentiles and shares are read from that table, so no group's rows,
    values or fingerprints meet in one task.
    """
    return digest_of_counts(digest_counts(parsed, by), by, sort)


def flat_queries(c: Column) -> Column:
    return F.array_join(c, " | ")
