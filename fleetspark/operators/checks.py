"""Health checks and configuration advice over counter snapshots.

One pass for all twelve checks: filter the needed names -> one pivot per
snapshot -> every ratio in one projection -> explode the checks to rows ->
classify.  A zero denominator (or unknown instance class, or a missing
history line) gives no row.  Thresholds are data (``CHECKS``); bounds are
compared on the unrounded value.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import parse_double
from ..functions.rule_text import RuleError, column, parsed, settings
from ..functions.text import HISTORY_LENGTH, to_bigint
from ..plans.joins import one_per_key
from .counters import SNAPSHOT, counter_name, pivot_counters

# Counters (status and settings) the twelve checks read.
CHECK_COUNTERS = [
    "innodb_buffer_pool_read_requests", "innodb_buffer_pool_reads", "innodb_buffer_pool_size",
    "connections", "threads_created", "threads_cached", "created_tmp_tables",
    "created_tmp_disk_tables", "innodb_buffer_pool_pages_total", "innodb_buffer_pool_pages_dirty",
    "open_files", "open_files_limit", "innodb_log_writes", "innodb_log_waits", "sort_scan",
    "sort_range", "sort_merge_passes", "uptime", "innodb_os_log_written",
    "innodb_redo_log_capacity", "threads_connected", "max_connections",
]
# Name of the history length taken from the engine status text.
ENGINE_HISTORY = "engine_history_list_length"


@dataclass(frozen=True)
class Check:
    order: int
    name: str
    unit: str
    value: Callable[[], Column]      # NULL = no row (zero denominator etc.)
    rules: tuple                     # ((op, bound, status), ...) first match wins, else 'ok'


def _c(n: str) -> Column:
    return F.col(n)


def _ratio(num: Column, den_name: str) -> Column:
    den = _c(den_name)
    return F.when(den != 0, num / den)


# Check names, units and thresholds as the reference reports them.
CHECKS: tuple[Check, ...] = (
    Check(1, "innodb_buffer_pool_hit_rate", "%",
          lambda: _ratio((_c("innodb_buffer_pool_read_requests") - _c("innodb_buffer_pool_reads")) * 100.0,
                         "innodb_buffer_pool_read_requests"),
          (("<", 90, "critical"), ("<", 99, "warning"))),
    Check(2, "innodb_buffer_pool_size_vs_ram", "%",
          lambda: F.when((_c("innodb_buffer_pool_size") != 0) & _c("memory_mb").isNotNull(),
                         _c("innodb_buffer_pool_size") / 1024.0 / 1024.0 * 100.0 / _c("memory_mb")),
          ((">", 75, "critical"), ("<", 60, "warning"))),
    Check(3, "thread_cache_hit_rate", "%",
          lambda: F.when(_c("connections") != 0,
                         100.0 - (_c("threads_created") * 100.0 / _c("connections"))),
          (("<", 50, "critical"), ("<", 90, "warning"))),
    Check(4, "thread_cache_ratio", "%",
          lambda: _ratio(_c("threads_cached") * 100.0, "threads_created"),
          (("<", 10, "warning"),)),
    Check(5, "temporary_tables_on_disk", "%",
          lambda: _ratio(_c("created_tmp_disk_tables") * 100.0, "created_tmp_tables"),
          ((">", 25, "warning"),)),
    Check(6, "history_list_length", "rows",
          lambda: _c(ENGINE_HISTORY),
          ((">", 1_000_000, "critical"), (">", 100_000, "critical"), (">", 10_000, "warning"))),
    Check(7, "max_connections_usage", "%",
          lambda: _ratio(_c("threads_connected") * 100.0, "max_connections"),
          ((">", 80, "critical"), (">", 70, "warning"))),
    Check(8, "innodb_dirty_pages_ratio", "%",
          lambda: F.when(_c("innodb_buffer_pool_pages_total") != 0,
                         _c("innodb_buffer_pool_pages_dirty") / _c("innodb_buffer_pool_pages_total") * 100.0),
          ((">=", 75, "warning"),)),
    Check(9, "open_files_utilization", "%",
          lambda: _ratio(_c("open_files") * 100.0, "open_files_limit"),
          ((">=", 85, "warning"),)),
    Check(10, "flushing_logs", "%",
          lambda: _ratio(_c("innodb_log_waits") * 100.0, "innodb_log_writes"),
          ((">", 20, "critical"), (">=", 5, "warning"))),
    Check(11, "sort_merge_passes_ratio", "%",
          lambda: F.when((_c("sort_scan") + _c("sort_range")) != 0,
                         _c("sort_merge_passes") * 100.0 / (_c("sort_scan") + _c("sort_range"))),
          ((">=", 25, "critical"), (">=", 10, "warning"))),
    Check(12, "innodb_redo_log", "min",
          lambda: F.when((_c("innodb_os_log_written") != 0) & (_c("innodb_redo_log_capacity") != 0),
                         (_c("uptime") / 60.0) * _c("innodb_redo_log_capacity") / _c("innodb_os_log_written")),
          (("<", 45, "warning"), (">", 75, "warning"))),
)
CHECK_BY_KEY = {c.name: c for c in CHECKS}
# Counters each check reads (history and class memory come from their own rows).
CHECK_INPUTS = {
    "innodb_buffer_pool_hit_rate": ["innodb_buffer_pool_read_requests", "innodb_buffer_pool_reads"],
    "innodb_buffer_pool_size_vs_ram": ["innodb_buffer_pool_size"],
    "thread_cache_hit_rate": ["threads_created", "connections"],
    "thread_cache_ratio": ["threads_cached", "threads_created"],
    "temporary_tables_on_disk": ["created_tmp_disk_tables", "created_tmp_tables"],
    "history_list_length": [],
    "max_connections_usage": ["threads_connected", "max_connections"],
    "innodb_dirty_pages_ratio": ["innodb_buffer_pool_pages_dirty", "innodb_buffer_pool_pages_total"],
    "open_files_utilization": ["open_files", "open_files_limit"],
    "flushing_logs": ["innodb_log_waits", "innodb_log_writes"],
    "sort_merge_passes_ratio": ["sort_merge_passes", "sort_scan", "sort_range"],
    "innodb_redo_log": ["uptime", "innodb_redo_log_capacity", "innodb_os_log_written"],
}

_OPS = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__,
        "=": Column.__eq__}


def classify(value: Column, rules) -> Column:
    """First matching (op, bound, status) rule, else 'ok'."""
    out = None
    for op, bound, status in rules:
        cond = _OPS[op](value, F.lit(bound))
        out = F.when(cond, F.lit(status)) if out is None else out.when(cond, F.lit(status))
    return out.otherwise(F.lit("ok")) if out is not None else F.lit("ok")


def history_kv(status_text: DataFrame) -> DataFrame:
    """History list length from the engine status text, as a numeric counter row.

    Extracting before any shuffle shrinks each text to one number; the row is
    then unioned into the counter table so the checks need one pivot, no join.
    The digits are read as a 64-bit integer; larger numbers are its largest value.
    """
    h = to_bigint(F.regexp_extract("text", HISTORY_LENGTH, 1)).cast("double")
    # the array of one keeps the filter above the text's own computation, which would else be done twice
    text = status_text.select(*SNAPSHOT, F.explode(F.array("status_text")).alias("text"))
    return (text.select(*SNAPSHOT, h.alias("value"))
            .where(F.col("value").isNotNull())
            .select(*SNAPSHOT, F.lit(ENGINE_HISTORY).alias("name"), "value"))


def class_memory_lookup(class_memory: DataFrame) -> DataFrame:
    """One row per instance class; of a repeated class the largest memory."""
    return one_per_key(class_memory.select("instance_class", F.col("memory_mb").cast("double").alias("memory_mb")),
                       "instance_class")


def memory_kv(kv: DataFrame, class_memory: DataFrame) -> DataFrame:
    """Memory (MB) of each snapshot's instance class as a numeric counter row.

    The class text is resolved before the pivot, so the pivot aggregates
    numbers only.  Unknown classes give no row (and so no H2 check).  The join
    is left to Spark, which broadcasts a lookup that is small in bytes.
    """
    mem = class_memory_lookup(class_memory).withColumnRenamed("instance_class", "value")
    cls = kv.where(counter_name() == "instance_class").select(*SNAPSHOT, "value")
    return cls.join(mem, "value").select(*SNAPSHOT, F.lit("memory_mb").alias("name"), F.col("memory_mb").alias("value"))


def counter_rows(kv: DataFrame, status_text: DataFrame | None = None, class_memory: DataFrame | None = None, names=None) -> DataFrame:
    """(snapshot, name, value): the numbers that the checks read, one row each, names in lower case."""
    names = list(CHECK_COUNTERS if names is None else names)
    long = kv.where(counter_name().isin(*names)).select(*SNAPSHOT, counter_name().alias("name"), parse_double("value").alias("value"))
    if class_memory is not None:
        long = long.unionByName(memory_kv(kv, class_memory))
    if status_text is not None:
        long = long.unionByName(history_kv(status_text))
    return long


def snapshot_counters(kv: DataFrame, status_text: DataFrame | None = None,
                      class_memory: DataFrame | None = None, names=None) -> DataFrame:
    """Wide numeric snapshot rows for the checks (+ history and memory_mb).

    ``names`` limits the pivot to the counters the wanted checks read.
    """
    names = list(CHECK_COUNTERS if names is None else names)
    return pivot_counters(counter_rows(kv, status_text, class_memory, names), names, [ENGINE_HISTORY, "memory_mb"])


def threshold_text(check: Check) -> str:
    """The rule list of a check as text, e.g. 'critical if < 90; warning if < 99; else ok'."""
    parts = [f"{status} if {op} {bound:,}" for op, bound, status in check.rules]
    return "; ".join(parts + ["else ok"])


def check_rows(wide: DataFrame, checks=CHECKS) -> DataFrame:
    """One row per (snapshot, check) that applies, in the reference's order, with the number of them per
    snapshot (``total_checks``), counted before the rows are spread.

    Each value is computed once, in a column, and each status once from it; what
    is the same for all rows of a check is added to the spread rows by the
    check's place.  All of it is compiled code (a filter over an array is not).
    """
    values = wide.select(*SNAPSHOT, *[c.value().cast("double").alias(f"_value{i}") for i, c in enumerate(checks)])
    found = [F.col(f"_value{i}") for i in range(len(checks))]
    judged = values.select(*SNAPSHOT, *found, *[classify(v, c.rules).alias(f"_status{i}") for i, (v, c) in enumerate(zip(found, checks))])
    total = sum((F.when(v.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for v in found), F.lit(0)).cast("bigint")
    spread = judged.select(*SNAPSHOT, total.alias("total_checks"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("_check"), v.alias("value"), F.col(f"_status{i}").alias("status")) for i, v in enumerate(found)])))
    of = lambda text: F.get(F.array(*[F.lit(text(c)) for c in checks]), F.col("_check"))
    return spread.where(F.col("value").isNotNull()).select(
        *SNAPSHOT, "total_checks", of(lambda c: c.order).alias("check_order"), of(lambda c: c.name).alias("check_name"), "value",
        of(lambda c: c.unit).alias("unit"), "status", of(threshold_text).alias("threshold"),
        F.concat(of(lambda c: f"{c.name} ({c.unit}): "), F.col("status"), of(lambda c: f" ({threshold_text(c)})")).alias("description"))


CHECK_COLUMNS = ("check_name", "value", "unit", "status", "threshold", "description")


def health_check(kv: DataFrame, name: str, status_text: DataFrame | None = None,
                 class_memory: DataFrame | None = None) -> DataFrame:
    """One check by name, one row per snapshot where it applies.
    Only the counters this check reads are pivoted."""
    c = CHECK_BY_KEY[name]
    wide = snapshot_counters(kv, status_text if c.order == 6 else None,
                             class_memory if c.order == 2 else None, CHECK_INPUTS[c.name])
    return check_rows(wide, [c]).select(*SNAPSHOT, *CHECK_COLUMNS)


def health_report(kv: DataFrame, status_text: DataFrame, class_memory: DataFrame) -> DataFrame:
    """All twelve checks in the reference's order plus the total per snapshot."""
    rows = check_rows(snapshot_counters(kv, status_text, class_memory))
    return rows.select(*SNAPSHOT, "check_order", *CHECK_COLUMNS, "total_checks")


def health_report_of_rows(rows: DataFrame) -> DataFrame:
    """H13 from stored ``counter_rows``; bucketed by snapshot (``sources/bucketed.py``) they are not shuffled."""
    wide = pivot_counters(rows, list(CHECK_COUNTERS), [ENGINE_HISTORY, "memory_mb"])
    return check_rows(wide).select(*SNAPSHOT, "check_order", *CHECK_COLUMNS, "total_checks")


# ---------------------------------------------------------------- H14

MIB = 1048576


def chunk_size_advice(kv: DataFrame) -> DataFrame:
    """Buffer-pool chunk alignment and size check with a recommended chunk.

    Status: not aligned (pool mod (instances x chunk) <> 0) -> warning; chunk
    below 2 % of pool -> warning; above 5 % -> warning; else ok (no advice).
    The advice is searched once per *distinct* (pool, instances) pair:
    chunk = pool / instances / n must be whole and a multiple of 1 MiB, for any
    whole n; prefer 2-5 % of pool, then nearest to 3.5 %, then the smaller n.
    All arithmetic is exact in integers.
    """
    names = ["innodb_buffer_pool_size", "innodb_buffer_pool_instances", "innodb_buffer_pool_chunk_size"]
    wide = pivot_counters(kv.where(F.col("scope") == "variables"), names)
    cfg = (wide.select(*SNAPSHOT, F.col(names[0]).alias("pool"), F.col(names[1]).alias("instances"),
                       F.col(names[2]).alias("chunk"))
           .where((F.col("pool") != 0) & (F.col("instances") != 0) & (F.col("chunk") != 0)))
    out = cfg.join(best_chunks(cfg.select("pool", "instances").distinct()), ["pool", "instances"], "left")
    aligned = (F.col("pool") % (F.col("instances") * F.col("chunk"))) == 0
    pct = F.col("chunk") * 100.0 / F.col("pool")
    status = (F.when(~aligned, F.lit("not_aligned")).when(pct < 2, F.lit("too_small"))
              .when(pct > 5, F.lit("too_large")).otherwise(F.lit("ok")))
    out = out.select(*SNAPSHOT, "pool", "instances", "chunk", pct.alias("chunk_pct"), status.alias("finding"),
                     "best_chunk")
    advise = F.col("finding") != "ok"
    rec = F.when(advise, F.col("best_chunk"))
    return out.select(
        *SNAPSHOT,
        F.col("pool").cast("bigint").alias("pool_bytes"),
        F.col("instances").cast("bigint").alias("instances"),
        F.col("chunk").cast("bigint").alias("chunk_bytes"),
        "chunk_pct",
        F.when(advise, F.lit("warning")).otherwise(F.lit("ok")).alias("status"),
        "finding",
        rec.alias("recommended_chunk_bytes"),
        F.when(advise, F.col("best_chunk") * 100.0 / F.col("pool")).alias("recommended_pct"),
        F.when(advise, F.try_divide(F.col("pool"), F.col("instances") * F.col("best_chunk"))).alias("chunks_per_instance"),
    )


def best_chunks(pairs: DataFrame) -> DataFrame:
    """Best chunk per distinct (pool, instances) that has a candidate; pairs
    without one get no row (a left join back gives them NULL).

    With q = pool / instances in MiB (a whole number, or there is no
    candidate), n and the chunk in MiB are a pair of divisors of q.  One of
    them is at most the root of q, so the divisors up to it and their partners
    are all there are.
    """
    whole = "p % (i * 1048576) = 0"
    p = (pairs.select("pool", "instances", F.col("pool").cast("bigint").alias("p"), F.col("instances").cast("bigint").alias("i"))
         .where(whole).withColumn("q", F.expr(f"p div (i * {MIB})")))
    low = p.withColumn("low", F.expr("filter(sequence(1L, cast(floor(sqrt(q)) as bigint)), d -> q % d = 0)"))
    # the root may be rounded; a divisor that is met from both sides does no harm
    both = low.withColumn("n", F.expr("concat(low, transform(low, d -> q div d))"))
    chunk = f"(q div x) * {MIB}"
    key = (f"struct(not({chunk} * 100 between p * 2 and p * 5) as out_of_range, abs({chunk} * 1000 - p * 35) as dist,"
           f" x as n, {chunk} as c)")
    return both.select("pool", "instances", F.expr(f"array_min(transform(n, x -> {key})).c").alias("best_chunk"))


# ---------------------------------------------------------------- H15


def variable_rules(kv: DataFrame, rules: DataFrame) -> DataFrame:
    """User rules (name, op, bound, severity) checked against settings.

    Names are matched ignoring case.  A setting that is missing or not numeric
    matches no rule.  The join is left to Spark (a small rules table is broadcast).
    """
    r = rules.select("rule_id", counter_name().alias("rule_name"), "op", F.col("bound").cast("double").alias("bound"), "severity")
    s = kv.where(F.col("scope") == "variables").select(*SNAPSHOT, "name", parse_double("value").alias("num"))
    j = s.join(r, counter_name() == F.col("rule_name"))
    v, b, op = F.col("num"), F.col("bound"), F.col("op")
    hit = (F.when(op == "<", v < b).when(op == "<=", v <= b).when(op == "=", v == b)
           .when(op == ">=", v >= b).when(op == ">", v > b).otherwise(F.lit(False)))
    return j.where(hit).select(*SNAPSHOT, "rule_id", F.col("name").alias("setting"),
                               F.col("num").alias("value"), "op", "bound", "severity")


def setting_expressions(kv: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """H15 over several settings: ``(rule_id, text, severity)`` rules of ``functions/rule_text.py`` checked per snapshot.

    One row for each rule that holds: ``outcome`` 'violated', ``message`` its
    text, ``inputs`` the settings it names with their values.  A rule that names
    a setting which is missing or not a number holds only if its other parts
    decide that.  A malformed rule gives one row without a snapshot: ``outcome``
    'malformed', ``message`` what is wrong.  Only the named settings are pivoted,
    in one shuffle of one row per snapshot; the rules are part of the plan, so
    their number is a user's list, not a table.
    """
    trees, bad = [], []
    for rule_id, text, severity in rules:
        try:
            trees.append((rule_id, text, severity, parsed(text)))
        except RuleError as e:
            bad.append((None, None, rule_id, "malformed", str(e), None, severity))
    named = sorted({n for *_, tree in trees for n in settings(tree)})
    schema = "rule_id string, outcome string, message string, inputs map<string,double>, severity string"
    spark, kinds = kv.sparkSession, dict(kv.dtypes)
    out = spark.createDataFrame(bad, ", ".join(f"{c} {kinds[c]}" for c in SNAPSHOT) + ", " + schema)
    if not trees:
        return out
    wide = pivot_counters(kv.where(F.col("scope") == "variables"), [], named)
    found = F.array(*[F.when(column(tree), F.struct(
        F.lit(rule_id).alias("rule_id"), F.lit("violated").alias("outcome"), F.lit(text).alias("message"),
        F.create_map(*[x for n in settings(tree) for x in (F.lit(n), F.col(f"`{n}`"))]).alias("inputs"),
        F.lit(severity).alias("severity"))) for rule_id, text, severity, tree in trees])
    held = wide.select(*SNAPSHOT, F.inline(F.filter(found, lambda x: x.isNotNull())))
    return held.unionByName(out)
