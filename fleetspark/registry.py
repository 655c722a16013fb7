"""

Each entry takes ``(spark, sf_dir)``, derives the fixture tables from the base
tables in ``sf_dir`` and runs one operator over them, whole tables in, whole
result out.  ``ORACLES`` (in ``oracles.py``) holds the DuckDB SQL for each key.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import activity, catalog, checks, counters, periods, textops
from .operators import inventory as inv
from .operators import timeseries as ts
from .functions.text import fingerprint
from .sources.bucketed import buckets_for, read_bucketed, write_bucketed
from .sources.fixtures import Fixtures, bindable_sql, fixture_deps
from .sources.sinks import write_report
from .sources.slowlog import read_slow_log, read_slow_log_context
from .sources.tables import stream_path
from .streaming import alerts as _alerts
from .streaming import metrics as _smetrics
from .streaming.runner import run_available_now, scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(key: str):
    def deco(fn: Callable[[Fixtures], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn
    return deco


# ------------------------------------------------------------ health checks

def _hc(key: str, check_name: str):
    @register(key)
    def q(fx: Fixtures) -> DataFrame:
        return checks.health_check(fx.counter_kv(), check_name, fx["innodb_status_text"], fx["class_memory"])
    return q


for _c in checks.CHECKS:
    _hc({
        "innodb_buffer_pool_hit_rate": "hc_buffer_pool_hit_rate",
        "innodb_buffer_pool_size_vs_ram": "hc_buffer_pool_vs_ram",
        "thread_cache_hit_rate": "hc_thread_cache_hit_rate",
        "thread_cache_ratio": "hc_thread_cache_ratio",
        "temporary_tables_on_disk": "hc_tmp_tables_on_disk",
        "history_list_length": "hc_history_list_length",
        "max_connections_usage": "hc_max_connections",
        "innodb_dirty_pages_ratio": "hc_dirty_pages",
        "open_files_utilization": "hc_open_files",
        "flushing_logs": "hc_log_waits",
        "sort_merge_passes_ratio": "hc_sort_merge_passes",
        "innodb_redo_log": "hc_redo_log_minutes",
    }[_c.name], _c.name)


@register("health_report")
def q_health_report(fx: Fixtures) -> DataFrame:
    return checks.health_report(fx.counter_kv(), fx["innodb_status_text"], fx["class_memory"])


@register("chunk_size_advice")
def q_chunk_size_advice(fx: Fixtures) -> DataFrame:
    return checks.chunk_size_advice(fx.counter_kv())


@register("health_report_stored")
def q_health_report_stored(fx: Fixtures) -> DataFrame:
    """H13 from counter rows stored in buckets by snapshot; the table's name leaves the catalog, its files stay."""
    path = scratch_path(fx.spark, "health_report", "counters")
    rows = checks.counter_rows(fx.counter_kv(), fx["innodb_status_text"], fx["class_memory"])
    buckets = buckets_for(fx["counter_snapshots"].count() * (len(checks.CHECK_COUNTERS) + 2))
    table = write_bucketed(rows, "fleet_counters_" + uuid.uuid4().hex, buckets, path=path)
    stored = read_bucketed(fx.spark, table)
    report = checks.health_report_of_rows(stored)
    fx.spark.sql(f"DROP TABLE {table}")
    return report


@register("variable_rules")
def q_variable_rules(fx: Fixtures) -> DataFrame:
    return checks.variable_rules(fx.counter_kv(), fx["setting_rules"])


SETTING_EXPRESSIONS = [
    ("e1", "innodb_buffer_pool_size / innodb_buffer_pool_instances < 1073741824", "warning"),
    ("e2", "open_files_limit < max_connections * 5 and max_connections > 0", "warning"),
    ("e3", "innodb_redo_log_capacity / innodb_buffer_pool_size < 0.05 or innodb_redo_log_capacity = 0", "notice"),
    ("e4", "max_connections / innodb_buffer_pool_chunk_size", "notice"),
    ("e5", "max_connections > (", "notice"),
    ("e6", "absent_setting - max_connections > 0", "notice"),
]


@register("setting_expressions")
def q_setting_expressions(fx: Fixtures) -> DataFrame:
    """H15 with rules over several settings; the values that a rule read come as text."""
    got = checks.setting_expressions(fx.counter_kv(), SETTING_EXPRESSIONS)
    listed = F.expr("array_join(transform(array_sort(map_entries(inputs)), x -> concat(x.key, '=', cast(x.value as bigint))), ',')")
    return got.withColumn("inputs", listed)


# ------------------------------------------------------------ catalog


def flat_list(col: str, fields: list[str], sep: str = "|") -> Column:
    """Array of structs -> 'a:b:c|a:b:c' text (for order-insensitive hashing)."""
    parts = ", ".join(f"coalesce(cast(x.{f} as string), '')" for f in fields)
    return F.expr(f"array_join(transform({col}, x -> concat_ws(':', {parts})), '{sep}')")


@register("column_catalog")
def q_column_catalog(fx: Fixtures) -> DataFrame:
    return catalog.column_catalog(fx["cat_columns"])


@register("table_inventory")
def q_table_inventory(fx: Fixtures) -> DataFrame:
    return catalog.table_inventory(fx["cat_tables"], fx["cat_collations"])


@register("size_totals")
def q_size_totals(fx: Fixtures) -> DataFrame:
    return catalog.size_totals(catalog.table_inventory(fx["cat_tables"], fx["cat_collations"]))


@register("database_sizes")
def q_database_sizes(fx: Fixtures) -> DataFrame:
    return catalog.database_sizes(fx["cat_schemata"], fx["cat_tables"])


@register("data_dictionary")
def q_data_dictionary(fx: Fixtures) -> DataFrame:
    d = catalog.data_dictionary(fx["cat_columns"], fx["cat_tables"])
    return d.select("instance_id", "table_schema", "table_name", "comment",
                    flat_list("columns", ["position", "name", "type", "unsigned", "nullable", "default",
                                          "comment"]).alias("columns"))


@register("index_catalog")
def q_index_catalog(fx: Fixtures) -> DataFrame:
    d = catalog.index_catalog(fx["cat_index_columns"], fx["cat_index_sizes"])
    return d.select("instance_id", "table_schema", "table_name", "index_name", "type", "unique", "visible",
                    "cardinality", "size_mb",
                    flat_list("columns", ["position", "column", "sub_part", "nullable"]).alias("columns"))


@register("deprecated_engine")
def q_deprecated_engine(fx: Fixtures) -> DataFrame:
    return catalog.deprecated_engine(fx["cat_tables"])


@register("deprecated_engine_tables")
def q_deprecated_engine_tables(fx: Fixtures) -> DataFrame:
    return catalog.deprecated_engine_tables(fx["cat_tables"])


@register("missing_primary_key")
def q_missing_primary_key(fx: Fixtures) -> DataFrame:
    return catalog.missing_primary_key(fx["cat_tables"], fx["cat_constraints"])


@register("missing_primary_key_tables")
def q_missing_primary_key_tables(fx: Fixtures) -> DataFrame:
    return catalog.missing_primary_key_tables(fx["cat_tables"], fx["cat_constraints"])


@register("foreign_key_graph")
def q_foreign_key_graph(fx: Fixtures) -> DataFrame:
    return catalog.foreign_key_graph(fx["cat_key_usage"], fx["cat_ref_constraints"])


@register("autoincrement_overflow")
def q_autoincrement_overflow(fx: Fixtures) -> DataFrame:
    return catalog.autoincrement_overflow(fx["cat_columns"], fx["cat_tables"])


@register("pg_table_inventory")
def q_pg_table_inventory(fx: Fixtures) -> DataFrame:
    return catalog.pg_table_inventory(fx["pg_relations"], fx["pg_namespaces"], fx["pg_roles"],
                                      fx["pg_access_methods"], fx["pg_user_stats"])


@register("pg_database_sizes")
def q_pg_database_sizes(fx: Fixtures) -> DataFrame:
    return catalog.pg_database_sizes(fx["pg_databases"], fx["pg_roles"])


@register("collection_stats")
def q_collection_stats(fx: Fixtures) -> DataFrame:
    return catalog.collection_stats(fx["doc_collections"], fx["doc_collection_stats"])


@register("docdb_database_sizes")
def q_docdb_database_sizes(fx: Fixtures) -> DataFrame:
    return catalog.docdb_database_sizes(fx["doc_collections"], fx["doc_collection_stats"])


# ------------------------------------------------------------ time series


# Fixed anchor of every look-back on the fixtures (FIXTURES.md).
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


@register("metric_rollup")
def q_metric_rollup(fx: Fixtures) -> DataFrame:
    r = ts.metric_rollup(fx["metric_points"], "5 minutes")
    return r.withColumn("period_start", F.date_format("period_start", ts.RFC3339))


@register("latest_metrics")
def q_latest_metrics(fx: Fixtures) -> DataFrame:
    return ts.latest_metrics(fx["metric_points"], fx["instances"], AS_OF, lookback="3 days", period="1 hour")


@register("replica_lag")
def q_replica_lag(fx: Fixtures) -> DataFrame:
    return ts.replica_lag(fx["instances"], fx["metric_points"], AS_OF, metric="read_latency",
                          lookback="3 days", period="1 hour")


@register("replica_cascades")
def q_replica_cascades(fx: Fixtures) -> DataFrame:
    """Chains of up to six hops: every instance but each seventh replicates the one before it."""
    n = F.substring("instance_id", 4, 20).cast("long")
    chained = fx["instances"].withColumn("source_instance_id", F.when(n % 7 != 0, F.concat(F.lit("db-"), n - 1)))
    return ts.replica_cascades(ts.replica_lag(chained, fx["metric_points"], AS_OF, metric="read_latency", lookback="3 days", period="1 hour"))


@register("top_sql_by_load")
def q_top_sql_by_load(fx: Fixtures) -> DataFrame:
    return ts.top_sql_by_load(fx["load_samples"], AS_OF, minutes=1440)


@register("top_waits_by_load")
def q_top_waits_by_load(fx: Fixtures) -> DataFrame:
    return ts.top_waits_by_load(fx["load_samples"], AS_OF, minutes=1440)


def _stored_periods(fx: Fixtures, fixture: str, keys: list[str], value: str | None) -> tuple[DataFrame, str]:
    """A fixture stored by day, and the folder of its period tables."""
    path = scratch_path(fx.spark, f"{fixture}_periods", "tables")
    write_report(fx[fixture].withColumn("day", F.to_date("ts")), f"{path}/raw", partition_by="day", mode="replace")
    raw = fx.spark.read.parquet(f"{path}/raw")
    return raw, periods.write_periods(raw, path, keys, "ts", value)


@register("top_sql_by_load_periods")
def q_top_sql_by_load_periods(fx: Fixtures) -> DataFrame:
    """A8 from stored minutes, hours and days, and the raw samples at the edges of the look-back."""
    keys = ["instance_id", "statement"]
    raw, folder = _stored_periods(fx, "load_samples", keys, None)
    got = periods.read_periods(raw, folder, keys, AS_OF, dt.timedelta(minutes=1440), date_col="day")
    return ts.ranked_load(got.groupBy(*keys).agg(F.sum("n").alias("samples")), ["statement"], 1440)


@register("latest_metrics_periods")
def q_latest_metrics_periods(fx: Fixtures) -> DataFrame:
    """W1 from stored minutes and hours, and the raw points at the edges of the look-back."""
    keys = ["instance_id", "metric"]
    raw, folder = _stored_periods(fx, "metric_points", keys, "value")
    got = periods.read_periods(raw, folder, keys, AS_OF, dt.timedelta(days=3), value="value", coarsest="hour", date_col="day")
    return ts.latest_of_rollup(ts.rollup_of_periods(got, "1 hour"), fx["instances"])


@register("event_lookback")
def q_event_lookback(fx: Fixtures) -> DataFrame:
    e = ts.event_lookback(fx["instance_events"], AS_OF, minutes=1440)
    return e.withColumn("categories", F.array_join("categories", ","))


# ------------------------------------------------------------ counters, text, activity


@register("kv_like")
def q_kv_like(fx: Fixtures) -> DataFrame:
    return counters.kv_like(fx.counter_kv(), "innodb_buffer_pool%")


@register("kv_numeric")
def q_kv_numeric(fx: Fixtures) -> DataFrame:
    return counters.kv_numeric(fx.counter_kv())


@register("innodb_status")
def q_innodb_status(fx: Fixtures) -> DataFrame:
    return textops.innodb_status(fx["innodb_status_text"])


@register("deadlocks")
def q_deadlocks(fx: Fixtures) -> DataFrame:
    d = textops.deadlocks(fx["innodb_status_text"])
    return d.withColumn("queries", textops.flat_queries(F.col("queries")))


@register("slow_log_records")
def q_slow_log_records(fx: Fixtures) -> DataFrame:
    return textops.slow_log_records(fx["slow_log"])


@register("query_fingerprint")
def q_query_fingerprint(fx: Fixtures) -> DataFrame:
    r = textops.slow_log_records(fx["slow_log"]).select("instance_id", "rec_id", "sql_text")
    return textops.query_fingerprint(r)


@register("slow_query_digest")
def q_slow_query_digest(fx: Fixtures) -> DataFrame:
    return textops.slow_query_digest(textops.slow_log_records(fx["slow_log"]))


@register("slow_query_digest_stored")
def q_slow_query_digest_stored(fx: Fixtures) -> DataFrame:
    """The digest of three days from their stored count tables; the last day's table is written again."""
    path = scratch_path(fx.spark, "slow_query_digest", "counts")
    log = textops.slow_log_records(fx["slow_log"]).withColumn("log_day", F.col("rec_id") % 3)
    counts = textops.digest_counts(log, by=("log_day", "instance_id"))
    write_report(counts, path, partition_by="log_day", mode="replace")
    write_report(counts.where("log_day = 2"), path, partition_by="log_day", mode="replace")
    return textops.digest_of_counts(textops.merge_digest_counts(fx.spark.read.parquet(path)))


@register("active_processes")
def q_active_processes(fx: Fixtures) -> DataFrame:
    return activity.active_processes(fx["processes"])


@register("process_counts")
def q_process_counts(fx: Fixtures) -> DataFrame:
    return activity.process_counts(fx["processes"])


@register("long_running_ops")
def q_long_running_ops(fx: Fixtures) -> DataFrame:
    return activity.long_running_ops(fx["current_ops"], min_secs=0)


@register("process_statement_history")
def q_process_statement_history(fx: Fixtures) -> DataFrame:
    return activity.process_statement_history(fx["threads"], fx["statement_history"])


@register("plan_rows_clean")
def q_plan_rows_clean(fx: Fixtures) -> DataFrame:
    return activity.plan_rows_clean(fx["plan_rows"])


@register("unused_indexes")
def q_unused_indexes(fx: Fixtures) -> DataFrame:
    return activity.unused_indexes(fx["cat_index_columns"], fx["plan_rows"])


@register("redundant_indexes")
def q_redundant_indexes(fx: Fixtures) -> DataFrame:
    """The fixture's indexes begin alike; the fourth, B-tree, covers the second."""
    return catalog.redundant_indexes(fx["cat_index_columns"])


@register("index_usage")
def q_index_usage(fx: Fixtures) -> DataFrame:
    """Plans of two statements, tied to the slow log's digest by fingerprint."""
    statement = (F.when(F.col("used_key") == "ix_2", "update orders set st = 'Z' where k = 77 /* app */")
                 .otherwise("SELECT * FROM t3 WHERE id IN (5, 6) -- by key"))
    plans = fx["plan_rows"].withColumn("fingerprint", fingerprint(statement))
    digest = textops.slow_query_digest(textops.slow_log_records(fx["slow_log"]))
    return activity.index_usage(fx["cat_index_columns"], plans, digest, include_primary=True)


@register("probe_summary")
def q_probe_summary(fx: Fixtures) -> DataFrame:
    return activity.probe_summary(fx["probes"])


# ------------------------------------------------------------ inventory


@register("instance_inventory")
def q_instance_inventory(fx: Fixtures) -> DataFrame:
    return inv.instance_inventory(fx.instance_docs())


@register("server_status_flat")
def q_server_status_flat(fx: Fixtures) -> DataFrame:
    return inv.server_status_flat(fx.server_status_docs())


@register("backup_inventory")
def q_backup_inventory(fx: Fixtures) -> DataFrame:
    return inv.backup_inventory(fx["backups"])


@register("parameter_overrides")
def q_parameter_overrides(fx: Fixtures) -> DataFrame:
    return inv.parameter_overrides(fx["parameters"])


@register("secret_inventory")
def q_secret_inventory(fx: Fixtures) -> DataFrame:
    return inv.secret_inventory(fx["secrets"])


@register("log_file_inventory")
def q_log_file_inventory(fx: Fixtures) -> DataFrame:
    return inv.log_file_inventory(fx["log_files"])


@register("maintenance_queue")
def q_maintenance_queue(fx: Fixtures) -> DataFrame:
    return inv.maintenance_queue(fx["maintenance_actions"])


@register("host_inventory")
def q_host_inventory(fx: Fixtures) -> DataFrame:
    return inv.host_inventory(fx.host_reservations())


@register("health_events")
def q_health_events(fx: Fixtures) -> DataFrame:
    return inv.health_events(fx["health_feed"], fx["health_details"])


@register("json_key_filter")
def q_json_key_filter(fx: Fixtures) -> DataFrame:
    j = inv.json_key_filter(fx["config_blobs"], key_filter="db")
    kv = F.expr("array_join(array_sort(transform(map_entries(`values`), e -> concat(e.key, '=', e.value))), ',')")
    return j.select("name", kv.alias("values"), "raw_value", "n_keys")


@register("config_key_audit")
def q_config_key_audit(fx: Fixtures) -> DataFrame:
    return inv.config_key_audit(fx["config_blobs"])


# ------------------------------------------------------------ streaming


def _stream_of(fx: Fixtures, name: str) -> DataFrame:
    """A fixture table derived inside a stream: each of its base tables is read
    as a file stream (one file or a folder, wherever it lies) with the table's
    schema, and the fixture SQL is applied to the streaming DataFrames."""
    streams = {d: fx.spark.readStream.schema(fx[d].schema).parquet(stream_path(fx.sf_dir, d)) for d in fixture_deps(name)}
    return fx.spark.sql(bindable_sql(name, streams), **streams)


def _drained(fx: Fixtures, stream: DataFrame, key: str) -> DataFrame:
    """What the stream emits over the files that are there now."""
    sink = scratch_path(fx.spark, key, "sink")
    run_available_now(stream, sink, scratch_path(fx.spark, key, "checkpoint"))
    return fx.spark.read.schema(stream.schema).parquet(sink)


@register("metric_rollup_stream")
def q_metric_rollup_stream(fx: Fixtures) -> DataFrame:
    stream = _smetrics.metric_rollup_stream(_stream_of(fx, "metric_points"), "5 minutes", "10 minutes")
    closed = _drained(fx, stream, "metric_rollup_stream")
    every = closed.unionByName(_smetrics.open_periods(fx["metric_points"], "5 minutes", "10 minutes"))
    return every.select("instance_id", "metric",
                        F.date_format(_smetrics.utc_wall_clock("period_start"), ts.RFC3339).alias("period_start"),
                        "avg_value", "n_points")


@register("health_alerts_stream")
def q_health_alerts_stream(fx: Fixtures) -> DataFrame:
    stream = _alerts.health_alerts_stream(_stream_of(fx, "counter_snapshots"), fx["class_memory"])
    return _drained(fx, stream, "health_alerts_stream")


# ------------------------------------------------------------ A2 for the other inventories

@register("database_size_totals")
def q_database_size_totals(fx: Fixtures) -> DataFrame:
    d = catalog.database_sizes(fx["cat_schemata"], fx["cat_tables"])
    return catalog.size_totals(d, keys=("instance_id",), size_col="size_mb", free_col=None)


@register("pg_table_size_totals")
def q_pg_table_size_totals(fx: Fixtures) -> DataFrame:
    t = catalog.pg_table_inventory(fx["pg_relations"], fx["pg_namespaces"], fx["pg_roles"],
                                   fx["pg_access_methods"], fx["pg_user_stats"])
    return catalog.size_totals(t, keys=("instance_id",), size_col="total_mb", free_col=None)


@register("pg_database_size_totals")
def q_pg_database_size_totals(fx: Fixtures) -> DataFrame:
    d = catalog.pg_database_sizes(fx["pg_databases"], fx["pg_roles"])
    return catalog.size_totals(d, keys=("instance_id",), size_col="size_mb", free_col=None)


# ------------------------------------------------------------ S2 from log files


@register("slow_log_files")
def q_slow_log_files(fx: Fixtures) -> DataFrame:
    """The slow log written as server log files and read from them: some entries
    share a heading, some statements hold a heading's text, and the server's
    start-up lines stand between entries."""
    path = scratch_path(fx.spark, "slow_log_files", "logs")
    start = "mysqld, Version: 8.0.36 (x). started with:\nTcp port: 3306  Unix socket: /s\nTime                 Id Command    Argument\n"
    at = F.col("rec_id")
    line = F.concat(F.when(at % 50 == 0, start).otherwise(""), F.when(at % 2 == 0, "# Time: 2024-01-01T00:00:00.000000Z\n").otherwise(""),
                    F.col("record_text"), F.when(at % 7 == 0, " -- # Time: later").otherwise(""))
    fx["slow_log"].select(line.alias("value")).write.text(path)
    entries = read_slow_log(fx.spark, path).withColumns({"instance_id": F.lit(""), "rec_id": F.lit(0)})
    r = textops.slow_log_records(entries)
    return r.groupBy("user_host", "query_ms", "lock_ms", "rows_sent", "rows_examined", "sql_text").agg(F.count(F.lit(1)).alias("n"))


@register("slow_log_context")
def q_slow_log_context(fx: Fixtures) -> DataFrame:
    """One log per instance, in order of the entries; time and database are written only when they change.

    A log is rotated, as servers do: it is dealt in ranges of its entries, and a
    range, which one task writes, begins with its time and database, so that no
    task has a whole instance's log.
    """
    path = scratch_path(fx.spark, "slow_log_context", "logs")
    order = Window.partitionBy("instance_id", "range").orderBy("rec_id")
    db, second = F.concat(F.lit("db"), F.floor(F.col("rec_id") / 5000) % 3), F.floor(F.col("rec_id") / 40)
    dealt = fx["slow_log"].select("instance_id", "rec_id", "record_text").repartitionByRange("instance_id", "rec_id")
    log = dealt.withColumns({"range": F.spark_partition_id(), "db": db, "second": second})
    log = log.withColumns({"old_db": F.lag("db").over(order), "old_second": F.lag("second").over(order)})
    user, rest = F.substring_index("record_text", "\n", 1), F.expr("substr(record_text, locate('\n', record_text))")
    changed = lambda a, b: F.col(a).isNull() | (F.col(a) != F.col(b))
    timing = F.substring_index(rest, "\n", 2)
    statement = F.expr("substr(record_text, length(substring_index(record_text, '\n', 2)) + 1)")
    line = F.concat(F.when(changed("old_second", "second"), F.concat(F.lit("# Time: "), F.col("second"), F.lit("\n"))).otherwise(""),
                    user, timing, F.when(changed("old_db", "db"), F.concat(F.lit("\nuse "), F.col("db"), F.lit(";"))).otherwise(""), statement)
    ordered = log.select("instance_id", "range", "rec_id", line.alias("value")).sortWithinPartitions("instance_id", "range", "rec_id")
    ordered.select("instance_id", "value").write.partitionBy("instance_id").text(path)
    got = read_slow_log_context(fx.spark, path)
    instance = F.regexp_extract("file_path", "instance_id=([^/]*)/", 1)
    parsed = textops.slow_log_records(got.select(instance.alias("instance_id"), "log_time", "database", "record_text"),
                                      keys=("instance_id", "log_time", "database"))
    return parsed.groupBy("instance_id", "log_time", "database", "query_ms", "sql_text").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ the operators' optional filters


@register("active_processes_filtered")
def q_active_processes_filtered(fx: Fixtures) -> DataFrame:
    return activity.active_processes(fx["processes"], include_idle=True, min_time_sec=200, include_no_statement=True, max_bytes=500)


@register("process_counts_filtered")
def q_process_counts_filtered(fx: Fixtures) -> DataFrame:
    return activity.process_counts(fx["processes"], include_idle=True, min_time_sec=200, include_no_statement=True)


@register("long_running_ops_filtered")
def q_long_running_ops_filtered(fx: Fixtures) -> DataFrame:
    return activity.long_running_ops(fx["current_ops"], min_secs=200)


@register("process_statement_history_one")
def q_process_statement_history_one(fx: Fixtures) -> DataFrame:
    return activity.process_statement_history(fx["threads"], fx["statement_history"], process_id=501)


@register("unused_indexes_filtered")
def q_unused_indexes_filtered(fx: Fixtures) -> DataFrame:
    return activity.unused_indexes(fx["cat_index_columns"], fx["plan_rows"], database="Brand#11")


@register("event_lookback_filtered")
def q_event_lookback_filtered(fx: Fixtures) -> DataFrame:
    e = ts.event_lookback(fx["instance_events"], AS_OF, minutes=1440, source="db-3")
    return e.withColumn("categories", F.array_join("categories", ","))


@register("replica_lag_filtered")
def q_replica_lag_filtered(fx: Fixtures) -> DataFrame:
    return ts.replica_lag(fx["instances"], fx["metric_points"], AS_OF, source="db-4", metric="read_latency",
                          lookback="3 days", period="1 hour")


@register("backup_inventory_filtered")
def q_backup_inventory_filtered(fx: Fixtures) -> DataFrame:
    return inv.backup_inventory(fx["backups"], instance="db-7", kind="manual")


@register("secret_inventory_filtered")
def q_secret_inventory_filtered(fx: Fixtures) -> DataFrame:
    return inv.secret_inventory(fx["secrets"], name="Building")


@register("host_inventory_filtered")
def q_host_inventory_filtered(fx: Fixtures) -> DataFrame:
    return inv.host_inventory(fx.host_reservations(), text="WEB-b")


@register("health_events_filtered")
def q_health_events_filtered(fx: Fixtures) -> DataFrame:
    return inv.health_events(fx["health_feed"], fx["health_details"], service="RDS", status="open")


@register("config_key_audit_filtered")
def q_config_key_audit_filtered(fx: Fixtures) -> DataFrame:
    return inv.config_key_audit(fx["config_blobs"], key_filter="DB_")
