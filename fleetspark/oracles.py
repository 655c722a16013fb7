"""DuckDB oracle SQL for every registered key, written from the operator

Each text reads the fixture tables, which ``with_fixtures`` prepends as CTEs
over the base tables the driver registers as views.
"""

from __future__ import annotations

from .sources.fixtures import with_fixtures

ORACLES: dict[str, str] = {}


def oracle(key: str, fixtures, sql: str) -> None:
    ORACLES[key] = with_fixtures(sql, fixtures)


# ------------------------------------------------------------ health checks
# Wide counters as DOUBLE, missing = 0 (the checks' rule), history from text.
_CS = """cs AS (
  SELECT c.instance_id, c.snapshot_id, c.instance_class,
         COALESCE(CAST(innodb_buffer_pool_read_requests AS DOUBLE), 0) AS rr,
         COALESCE(CAST(innodb_buffer_pool_reads AS DOUBLE), 0) AS rd,
         COALESCE(CAST(innodb_buffer_pool_size AS DOUBLE), 0) AS pool,
         COALESCE(CAST(connections AS DOUBLE), 0) AS conns,
         COALESCE(CAST(threads_created AS DOUBLE), 0) AS tcreated,
         COALESCE(CAST(threads_cached AS DOUBLE), 0) AS tcached,
         COALESCE(CAST(created_tmp_tables AS DOUBLE), 0) AS tmp_all,
         COALESCE(CAST(created_tmp_disk_tables AS DOUBLE), 0) AS tmp_disk,
         COALESCE(CAST(innodb_buffer_pool_pages_total AS DOUBLE), 0) AS pg_total,
         COALESCE(CAST(innodb_buffer_pool_pages_dirty AS DOUBLE), 0) AS pg_dirty,
         COALESCE(CAST(open_files AS DOUBLE), 0) AS open_files,
         COALESCE(CAST(open_files_limit AS DOUBLE), 0) AS open_limit,
         COALESCE(CAST(innodb_log_writes AS DOUBLE), 0) AS log_writes,
         COALESCE(CAST(innodb_log_waits AS DOUBLE), 0) AS log_waits,
         COALESCE(CAST(sort_scan AS DOUBLE), 0) AS sort_scan,
         COALESCE(CAST(sort_range AS DOUBLE), 0) AS sort_range,
         COALESCE(CAST(sort_merge_passes AS DOUBLE), 0) AS smp,
         COALESCE(CAST(uptime AS DOUBLE), 0) AS uptime,
         COALESCE(CAST(innodb_os_log_written AS DOUBLE), 0) AS written,
         COALESCE(CAST(innodb_redo_log_capacity AS DOUBLE), 0) AS capacity,
         COALESCE(CAST(threads_connected AS DOUBLE), 0) AS tconn,
         COALESCE(CAST(max_connections AS DOUBLE), 0) AS maxconn,
         CAST(CAST(NULLIF(regexp_extract(t.status_text, 'History list length (\\d+)', 1), '') AS BIGINT) AS DOUBLE) AS hll,
         CAST(m.memory_mb AS DOUBLE) AS memory_mb
  FROM counter_snapshots c
  JOIN innodb_status_text t ON t.instance_id = c.instance_id AND t.snapshot_id = c.snapshot_id
  LEFT JOIN class_memory m ON m.instance_class = c.instance_class
)"""

# (order, name, unit, value, condition, status) in the reference's order.
_CHECK_SQL = [
    (1, "innodb_buffer_pool_hit_rate", "%", "(rr - rd) * 100.0 / rr", "rr <> 0",
     "CASE WHEN v < 90 THEN 'critical' WHEN v < 99 THEN 'warning' ELSE 'ok' END"),
    (2, "innodb_buffer_pool_size_vs_ram", "%", "pool / 1024.0 / 1024.0 * 100.0 / memory_mb",
     "memory_mb IS NOT NULL AND pool <> 0",
     "CASE WHEN v > 75 THEN 'critical' WHEN v < 60 THEN 'warning' ELSE 'ok' END"),
    (3, "thread_cache_hit_rate", "%", "100.0 - (tcreated * 100.0 / conns)", "conns <> 0",
     "CASE WHEN v < 50 THEN 'critical' WHEN v < 90 THEN 'warning' ELSE 'ok' END"),
    (4, "thread_cache_ratio", "%", "tcached * 100.0 / tcreated", "tcreated <> 0",
     "CASE WHEN v < 10 THEN 'warning' ELSE 'ok' END"),
    (5, "temporary_tables_on_disk", "%", "tmp_disk * 100.0 / tmp_all", "tmp_all <> 0",
     "CASE WHEN v > 25 THEN 'warning' ELSE 'ok' END"),
    (6, "history_list_length", "rows", "hll", "hll IS NOT NULL",
     "CASE WHEN v > 100000 THEN 'critical' WHEN v > 10000 THEN 'warning' ELSE 'ok' END"),
    (7, "max_connections_usage", "%", "tconn * 100.0 / maxconn", "maxconn <> 0",
     "CASE WHEN v > 80 THEN 'critical' WHEN v > 70 THEN 'warning' ELSE 'ok' END"),
    (8, "innodb_dirty_pages_ratio", "%", "pg_dirty / pg_total * 100.0", "pg_total <> 0",
     "CASE WHEN v >= 75 THEN 'warning' ELSE 'ok' END"),
    (9, "open_files_utilization", "%", "open_files * 100.0 / open_limit", "open_limit <> 0",
     "CASE WHEN v >= 85 THEN 'warning' ELSE 'ok' END"),
    (10, "flushing_logs", "%", "log_waits * 100.0 / log_writes", "log_writes <> 0",
     "CASE WHEN v > 20 THEN 'critical' WHEN v >= 5 THEN 'warning' ELSE 'ok' END"),
    (11, "sort_merge_passes_ratio", "%", "smp * 100.0 / (sort_scan + sort_range)", "sort_scan + sort_range <> 0",
     "CASE WHEN v >= 25 THEN 'critical' WHEN v >= 10 THEN 'warning' ELSE 'ok' END"),
    (12, "innodb_redo_log", "min", "(uptime / 60.0) * capacity / written", "written <> 0 AND capacity <> 0",
     "CASE WHEN v < 45 THEN 'warning' WHEN v > 75 THEN 'warning' ELSE 'ok' END"),
]
_HC_KEYS = ["hc_buffer_pool_hit_rate", "hc_buffer_pool_vs_ram", "hc_thread_cache_hit_rate",
            "hc_thread_cache_ratio", "hc_tmp_tables_on_disk", "hc_history_list_length",
            "hc_max_connections", "hc_dirty_pages", "hc_open_files", "hc_log_waits",
            "hc_sort_merge_passes", "hc_redo_log_minutes"]
_HC_FIX = ["counter_snapshots", "innodb_status_text", "class_memory"]


# The rule lists as the report words them.
_THRESHOLDS = ["critical if < 90; warning if < 99; else ok", "critical if > 75; warning if < 60; else ok",
               "critical if < 50; warning if < 90; else ok", "warning if < 10; else ok", "warning if > 25; else ok",
               "critical if > 1,000,000; critical if > 100,000; warning if > 10,000; else ok",
               "critical if > 80; warning if > 70; else ok", "warning if >= 75; else ok", "warning if >= 85; else ok",
               "critical if > 20; warning if >= 5; else ok", "critical if >= 25; warning if >= 10; else ok",
               "warning if < 45; warning if > 75; else ok"]


def _check_select(order, name, unit, value, cond, status, with_order=False) -> str:
    extra = f"{order} AS check_order, " if with_order else ""
    said = f"'{name} ({unit}): ' || {status} || ' ({_THRESHOLDS[order - 1]})'"
    return (f"SELECT instance_id, snapshot_id, {extra}'{name}' AS check_name, v AS value, '{unit}' AS unit, "
            f"{status} AS status, '{_THRESHOLDS[order - 1]}' AS threshold, {said} AS description FROM (SELECT instance_id, snapshot_id, {value} AS v FROM cs WHERE {cond}) x")


for _key, _spec in zip(_HC_KEYS, _CHECK_SQL):
    oracle(_key, _HC_FIX, f"WITH {_CS}\n{_check_select(*_spec)}")

oracle("health_report", _HC_FIX, f"""WITH {_CS},
allc AS (
{' UNION ALL '.join(_check_select(*s, with_order=True) for s in _CHECK_SQL)}
)
SELECT instance_id, snapshot_id, check_order, check_name, value, unit, status, threshold, description,
       COUNT(*) OVER (PARTITION BY instance_id, snapshot_id) AS total_checks
FROM allc""")

# Every divisor n of the pool's MiB per instance, by distinct (pool, instances); exact integers.
oracle("chunk_size_advice", ["counter_snapshots"], """
WITH cfg AS (
  SELECT instance_id, snapshot_id, CAST(innodb_buffer_pool_size AS BIGINT) AS pool,
         CAST(innodb_buffer_pool_instances AS BIGINT) AS inst, CAST(innodb_buffer_pool_chunk_size AS BIGINT) AS chunk
  FROM counter_snapshots
  WHERE COALESCE(innodb_buffer_pool_size, 0) <> 0 AND COALESCE(innodb_buffer_pool_instances, 0) <> 0
    AND COALESCE(innodb_buffer_pool_chunk_size, 0) <> 0
),
pairs AS (SELECT DISTINCT pool, inst FROM cfg),
sized AS (SELECT pool, inst, pool // inst // 1048576 AS q FROM pairs WHERE pool % (inst * 1048576) = 0),
cand AS (
  SELECT pool, inst, n, q // n * 1048576 AS c
  FROM (SELECT pool, inst, q, unnest(range(1, q + 1)) AS n FROM sized) WHERE q % n = 0
),
ranked AS (
  SELECT pool, inst, c, ROW_NUMBER() OVER (PARTITION BY pool, inst ORDER BY
           CASE WHEN c * 100 >= pool * 2 AND c * 100 <= pool * 5 THEN 0 ELSE 1 END,
           abs(c * 1000 - pool * 35), n) AS rk
  FROM cand
),
best AS (SELECT pool, inst, c AS best FROM ranked WHERE rk = 1),
j AS (
  SELECT cfg.*, best.best,
         CASE WHEN pool % (inst * chunk) <> 0 THEN 'not_aligned'
              WHEN CAST(chunk AS DOUBLE) * 100.0 / pool < 2 THEN 'too_small'
              WHEN CAST(chunk AS DOUBLE) * 100.0 / pool > 5 THEN 'too_large' ELSE 'ok' END AS finding
  FROM cfg LEFT JOIN best USING (pool, inst)
)
SELECT instance_id, snapshot_id, pool AS pool_bytes, inst AS instances, chunk AS chunk_bytes,
       CAST(chunk AS DOUBLE) * 100.0 / pool AS chunk_pct,
       CASE WHEN finding = 'ok' THEN 'ok' ELSE 'warning' END AS status, finding,
       CASE WHEN finding <> 'ok' THEN best END AS recommended_chunk_bytes,
       CASE WHEN finding <> 'ok' THEN CAST(best AS DOUBLE) * 100.0 / pool END AS recommended_pct,
       CASE WHEN finding <> 'ok' AND best IS NOT NULL THEN CAST(pool AS DOUBLE) / (inst * best) END AS chunks_per_instance
FROM j""")

# Settings as text -> number; rule operators on the number.
oracle("variable_rules", ["counter_snapshots", "setting_rules"], """
WITH kv AS (
  UNPIVOT (SELECT instance_id, snapshot_id,
                  CAST(innodb_buffer_pool_size AS VARCHAR) AS innodb_buffer_pool_size,
                  CAST(open_files_limit AS VARCHAR) AS open_files_limit,
                  CAST(innodb_redo_log_capacity AS VARCHAR) AS innodb_redo_log_capacity,
                  CAST(max_connections AS VARCHAR) AS max_connections,
                  CAST(innodb_buffer_pool_instances AS VARCHAR) AS innodb_buffer_pool_instances,
                  CAST(innodb_buffer_pool_chunk_size AS VARCHAR) AS innodb_buffer_pool_chunk_size,
                  server_version
           FROM counter_snapshots)
  ON COLUMNS(* EXCLUDE (instance_id, snapshot_id)) INTO NAME name VALUE val
),
num AS (
  SELECT instance_id, snapshot_id, name,
         CASE WHEN regexp_full_match(val, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(val AS DOUBLE) END AS num
  FROM kv
)
SELECT n.instance_id, n.snapshot_id, r.rule_id, n.name AS setting, n.num AS value, r.op,
       CAST(r.bound AS DOUBLE) AS bound, r.severity
FROM num n JOIN setting_rules r ON r.name = n.name
WHERE (r.op = '<' AND n.num < r.bound) OR (r.op = '<=' AND n.num <= r.bound) OR (r.op = '=' AND n.num = r.bound)
   OR (r.op = '>=' AND n.num >= r.bound) OR (r.op = '>' AND n.num > r.bound)""")

# H15 over several settings: the same numbers side by side, one branch per rule.
oracle("setting_expressions", ["counter_snapshots"], """
WITH c AS (
  SELECT instance_id, snapshot_id, TRY_CAST(innodb_buffer_pool_size AS DOUBLE) AS pool, TRY_CAST(open_files_limit AS DOUBLE) AS files,
         TRY_CAST(innodb_redo_log_capacity AS DOUBLE) AS redo, TRY_CAST(max_connections AS DOUBLE) AS conn,
         TRY_CAST(innodb_buffer_pool_instances AS DOUBLE) AS inst
  FROM counter_snapshots
),
held AS (
  SELECT instance_id, snapshot_id, 'e1' AS rule_id, 'innodb_buffer_pool_size / innodb_buffer_pool_instances < 1073741824' AS message,
         'innodb_buffer_pool_instances=' || CAST(inst AS BIGINT) || ',innodb_buffer_pool_size=' || CAST(pool AS BIGINT) AS inputs,
         'warning' AS severity
  FROM c WHERE pool / NULLIF(inst, 0) < 1073741824
  UNION ALL
  SELECT instance_id, snapshot_id, 'e2', 'open_files_limit < max_connections * 5 and max_connections > 0',
         'max_connections=' || CAST(conn AS BIGINT) || ',open_files_limit=' || CAST(files AS BIGINT), 'warning'
  FROM c WHERE files < conn * 5 AND conn > 0
  UNION ALL
  SELECT instance_id, snapshot_id, 'e3',
         'innodb_redo_log_capacity / innodb_buffer_pool_size < 0.05 or innodb_redo_log_capacity = 0',
         'innodb_buffer_pool_size=' || CAST(pool AS BIGINT) || ',innodb_redo_log_capacity=' || CAST(redo AS BIGINT), 'notice'
  FROM c WHERE redo / NULLIF(pool, 0) < 0.05 OR redo = 0
)
SELECT instance_id, snapshot_id, rule_id, 'violated' AS outcome, message, inputs, severity FROM held
UNION ALL SELECT NULL, NULL, 'e4', 'malformed',
  'a comparison expected, not max_connections / innodb_buffer_pool_chunk_size', NULL, 'notice'
UNION ALL SELECT NULL, NULL, 'e5', 'malformed', 'not an expression', NULL, 'notice'""")



# ------------------------------------------------------------ catalog
oracle("column_catalog", ["cat_columns"], """
SELECT instance_id, table_schema, table_name, ordinal_position AS position, column_name AS name,
       column_type AS type, is_nullable = 'YES' AS nullable, COALESCE(column_default, '') AS "default",
       COALESCE(character_set_name, '') AS charset, COALESCE(collation_name, '') AS collation,
       COALESCE(column_key, '') AS key, COALESCE(extra, '') AS extra, COALESCE(column_comment, '') AS comment,
       contains(lower(column_type), 'unsigned') AS unsigned
FROM cat_columns""")

_TABLE_INV = """ti AS (
  SELECT t.instance_id, t.table_schema, t.table_name, COALESCE(t.engine, '') AS engine,
         COALESCE(t.row_format, '') AS row_format, COALESCE(c.character_set_name, '') AS charset,
         COALESCE(t.table_collation, '') AS collation, CAST(COALESCE(t.table_rows, 0) AS BIGINT) AS row_count,
         round(CAST(COALESCE(t.data_length, 0) AS DOUBLE) / 1048576.0, 2) AS data_mb,
         round(CAST(COALESCE(t.index_length, 0) AS DOUBLE) / 1048576.0, 2) AS index_mb,
         round(CAST(COALESCE(t.data_length + t.index_length, 0) AS DOUBLE) / 1048576.0, 2) AS total_mb,
         round(CAST(COALESCE(t.data_free, 0) AS DOUBLE) / 1048576.0, 2) AS free_mb,
         round(CAST(COALESCE(t.data_free, 0) AS DOUBLE) / NULLIF(t.data_length + t.index_length + t.data_free, 0) * 100, 1) AS frag_pct,
         CAST(COALESCE(t.auto_increment, 0) AS DECIMAL(20,0)) AS auto_increment,
         COALESCE(t.table_comment, '') AS comment,
         COALESCE(strftime(t.create_time, '%Y-%m-%dT%H:%M:%SZ'), '') AS created_at,
         COALESCE(strftime(t.update_time, '%Y-%m-%dT%H:%M:%SZ'), '') AS updated_at
  FROM cat_tables t LEFT JOIN cat_collations c ON c.collation_name = t.table_collation
  WHERE t.table_type = 'BASE TABLE'
)"""
oracle("table_inventory", ["cat_tables", "cat_collations"], f"WITH {_TABLE_INV} SELECT * FROM ti")
oracle("size_totals", ["cat_tables", "cat_collations"], f"""WITH {_TABLE_INV}
SELECT instance_id, table_schema, COUNT(*) AS n_items, round(SUM(total_mb), 2) AS total_size_mb,
       round(SUM(free_mb), 2) AS total_free_mb
FROM ti GROUP BY instance_id, table_schema""")

oracle("database_sizes", ["cat_schemata", "cat_tables"], """
SELECT s.instance_id, s.schema_name, s.default_character_set_name AS charset, s.default_collation_name AS collation,
       round(CAST(COALESCE(SUM(t.data_length + t.index_length), 0) AS DOUBLE) / 1048576.0, 2) AS size_mb,
       CAST(COUNT(t.table_name) AS BIGINT) AS tables
FROM cat_schemata s LEFT JOIN cat_tables t ON t.instance_id = s.instance_id AND t.table_schema = s.schema_name
GROUP BY s.instance_id, s.schema_name, s.default_character_set_name, s.default_collation_name""")

oracle("data_dictionary", ["cat_columns", "cat_tables"], """
SELECT t.instance_id, t.table_schema, t.table_name, COALESCE(t.table_comment, '') AS comment,
       string_agg(concat_ws(':', CAST(c.ordinal_position AS VARCHAR), COALESCE(c.column_name, ''), COALESCE(c.column_type, ''),
                  CAST(contains(lower(c.column_type), 'unsigned') AS VARCHAR), CAST(c.is_nullable = 'YES' AS VARCHAR),
                  COALESCE(c.column_default, ''), COALESCE(c.column_comment, '')), '|' ORDER BY c.ordinal_position) AS columns
FROM cat_columns c JOIN cat_tables t ON t.instance_id = c.instance_id AND t.table_schema = c.table_schema
  AND t.table_name = c.table_name AND t.table_type = 'BASE TABLE'
GROUP BY t.instance_id, t.table_schema, t.table_name, t.table_comment""")

oracle("index_catalog", ["cat_index_columns", "cat_index_sizes"], """
WITH idx AS (
  SELECT instance_id, table_schema, table_name, index_name,
         arg_min(index_type, seq_in_index) AS type, arg_min(non_unique, seq_in_index) = 0 AS "unique",
         arg_min(is_visible, seq_in_index) = 'YES' AS visible,
         CAST(COALESCE(arg_min(cardinality, seq_in_index), 0) AS BIGINT) AS cardinality,
         string_agg(concat_ws(':', CAST(seq_in_index AS VARCHAR), COALESCE(column_name, ''),
                    CAST(COALESCE(sub_part, 0) AS VARCHAR), CAST(nullable = 'YES' AS VARCHAR)), '|' ORDER BY seq_in_index) AS columns
  FROM cat_index_columns GROUP BY instance_id, table_schema, table_name, index_name
)
SELECT i.instance_id, i.table_schema, i.table_name, i.index_name, i.type, i."unique", i.visible, i.cardinality,
       COALESCE(round(s.stat_value * s.page_size / 1024.0 / 1024.0, 2), 0.0) AS size_mb, i.columns
FROM idx i LEFT JOIN cat_index_sizes s ON s.instance_id = i.instance_id AND s.database_name = i.table_schema
  AND s.table_name = i.table_name AND s.index_name = i.index_name AND s.stat_name = 'size'""")

_SYS = "('mysql', 'information_schema', 'performance_schema', 'sys')"
oracle("deprecated_engine_tables", ["cat_tables"], f"""
SELECT instance_id, table_schema, table_name, table_schema || '.' || table_name AS qualified_name
FROM cat_tables WHERE engine = 'MyISAM' AND table_schema NOT IN {_SYS}""")
oracle("deprecated_engine", ["cat_tables"], f"""
WITH inst AS (SELECT DISTINCT instance_id FROM cat_tables),
bad AS (SELECT instance_id, COUNT(*) AS n FROM cat_tables WHERE engine = 'MyISAM' AND table_schema NOT IN {_SYS} GROUP BY instance_id)
SELECT i.instance_id, 'deprecated_table_engine' AS check_name,
       CASE WHEN COALESCE(b.n, 0) > 0 THEN 'warning' ELSE 'ok' END AS status, CAST(COALESCE(b.n, 0) AS BIGINT) AS n_tables
FROM inst i LEFT JOIN bad b USING (instance_id)""")
_NOPK = f"""nopk AS (
  SELECT t.instance_id, t.table_schema, t.table_name
  FROM cat_tables t LEFT JOIN cat_constraints c ON c.instance_id = t.instance_id AND c.table_schema = t.table_schema
    AND c.table_name = t.table_name AND c.constraint_type = 'PRIMARY KEY'
  WHERE t.table_type = 'BASE TABLE' AND t.table_schema NOT IN {_SYS} AND c.constraint_name IS NULL
)"""
oracle("missing_primary_key_tables", ["cat_tables", "cat_constraints"], f"""WITH {_NOPK}
SELECT instance_id, table_schema, table_name, table_schema || '.' || table_name AS qualified_name FROM nopk""")
oracle("missing_primary_key", ["cat_tables", "cat_constraints"], f"""WITH {_NOPK},
inst AS (SELECT DISTINCT instance_id FROM cat_tables),
bad AS (SELECT instance_id, COUNT(*) AS n FROM nopk GROUP BY instance_id)
SELECT i.instance_id, 'missing_primary_key' AS check_name,
       CASE WHEN COALESCE(b.n, 0) > 0 THEN 'warning' ELSE 'ok' END AS status, CAST(COALESCE(b.n, 0) AS BIGINT) AS n_tables
FROM inst i LEFT JOIN bad b USING (instance_id)""")

oracle("foreign_key_graph", ["cat_key_usage", "cat_ref_constraints"], """
WITH j AS (
  SELECT k.*, r.update_rule, r.delete_rule
  FROM cat_key_usage k JOIN cat_ref_constraints r ON r.instance_id = k.instance_id
    AND r.constraint_name = k.constraint_name AND r.constraint_schema = k.table_schema
  WHERE k.referenced_table_name IS NOT NULL
)
SELECT instance_id, table_schema, table_name AS "table", 'outgoing' AS direction, referenced_table_name AS other_table,
       constraint_name, ordinal_position, column_name, referenced_column_name, update_rule, delete_rule FROM j
UNION ALL
SELECT instance_id, table_schema, referenced_table_name AS "table", 'incoming' AS direction, table_name AS other_table,
       constraint_name, ordinal_position, column_name, referenced_column_name, update_rule, delete_rule FROM j""")

oracle("autoincrement_overflow", ["cat_columns", "cat_tables"], """
WITH j AS (
  SELECT c.instance_id, c.table_schema, c.table_name AS "table", c.column_name AS "column", c.column_type,
         contains(lower(c.column_type), 'unsigned') AS unsigned,
         CAST(COALESCE(t.auto_increment, 0) AS DECIMAL(20,0)) AS current_value,
         CAST(CASE
           WHEN contains(lower(c.column_type), 'tinyint') THEN CASE WHEN contains(lower(c.column_type), 'unsigned') THEN 255 ELSE 127 END
           WHEN contains(lower(c.column_type), 'smallint') THEN CASE WHEN contains(lower(c.column_type), 'unsigned') THEN 65535 ELSE 32767 END
           WHEN contains(lower(c.column_type), 'mediumint') THEN CASE WHEN contains(lower(c.column_type), 'unsigned') THEN 16777215 ELSE 8388607 END
           WHEN contains(lower(c.column_type), 'bigint') THEN CASE WHEN contains(lower(c.column_type), 'unsigned') THEN 18446744073709551615 ELSE 9223372036854775807 END
           ELSE CASE WHEN contains(lower(c.column_type), 'unsigned') THEN 4294967295 ELSE 2147483647 END END AS DECIMAL(20,0)) AS max_value
  FROM cat_columns c JOIN cat_tables t ON t.instance_id = c.instance_id AND t.table_schema = c.table_schema
    AND t.table_name = c.table_name
  WHERE c.extra LIKE '%auto_increment%' AND t.table_type = 'BASE TABLE'
)
SELECT *, CAST(current_value AS DOUBLE) / CAST(max_value AS DOUBLE) * 100 AS pct_used,
       CAST(CASE WHEN max_value >= current_value THEN max_value - current_value ELSE 0 END AS DECIMAL(20,0)) AS remaining_value
FROM j""")

oracle("pg_table_inventory", ["pg_relations", "pg_namespaces", "pg_roles", "pg_access_methods", "pg_user_stats"], """
SELECT c.instance_id, n.nspname AS schema, c.relname AS name, r.rolname AS owner, COALESCE(am.amname, '') AS access_method,
       greatest(CAST(c.reltuples AS BIGINT), 0) AS row_count, CAST(COALESCE(s.n_dead_tup, 0) AS BIGINT) AS dead_tuples,
       round(c.data_bytes / 1048576.0, 2) AS data_mb, round(c.index_bytes / 1048576.0, 2) AS index_mb,
       round(c.total_bytes / 1048576.0, 2) AS total_mb, COALESCE(c.description, '') AS comment,
       COALESCE(strftime(greatest(s.last_vacuum, s.last_autovacuum), '%Y-%m-%dT%H:%M:%SZ'), '') AS last_vacuum,
       COALESCE(strftime(greatest(s.last_analyze, s.last_autoanalyze), '%Y-%m-%dT%H:%M:%SZ'), '') AS last_analyze
FROM pg_relations c
JOIN pg_namespaces n ON n.instance_id = c.instance_id AND n.oid = c.relnamespace
JOIN pg_roles r ON r.instance_id = c.instance_id AND r.oid = c.relowner
LEFT JOIN pg_access_methods am ON am.instance_id = c.instance_id AND am.oid = c.relam
LEFT JOIN pg_user_stats s ON s.instance_id = c.instance_id AND s.relid = c.oid
WHERE c.relkind = 'r' AND n.nspname NOT IN ('pg_catalog', 'information_schema', 'pg_toast')""")

oracle("pg_database_sizes", ["pg_databases", "pg_roles"], """
SELECT d.instance_id, d.datname, r.rolname AS owner, d.encoding, d.datcollate AS collation,
       d.datconnlimit AS connection_limit, round(d.size_bytes / 1048576.0, 2) AS size_mb
FROM pg_databases d JOIN pg_roles r ON r.instance_id = d.instance_id AND r.oid = d.datdba WHERE NOT d.datistemplate""")

oracle("collection_stats", ["doc_collections", "doc_collection_stats"], """
SELECT c.instance_id, c.database_name, c.name, CAST(COALESCE(s.doc_count, 0) AS BIGINT) AS count,
       CAST(COALESCE(s.size_bytes, 0) AS DOUBLE) / 1024 / 1024 AS size_mb,
       CAST(COALESCE(s.avg_obj_size, 0) AS DOUBLE) AS avg_obj_size_bytes,
       CAST(COALESCE(s.nindexes, 0) AS INTEGER) AS index_count,
       CAST(COALESCE(s.total_index_size, 0) AS DOUBLE) / 1024 / 1024 AS total_index_size_mb
FROM doc_collections c LEFT JOIN doc_collection_stats s
  ON s.instance_id = c.instance_id AND s.database_name = c.database_name AND s.name = c.name""")

oracle("docdb_database_sizes", ["doc_collections", "doc_collection_stats"], """
WITH db AS (
  SELECT c.instance_id, c.database_name, SUM(COALESCE(s.size_bytes, 0)) AS bytes, SUM(COALESCE(s.doc_count, 0)) AS docs
  FROM doc_collections c LEFT JOIN doc_collection_stats s
    ON s.instance_id = c.instance_id AND s.database_name = c.database_name AND s.name = c.name
  GROUP BY c.instance_id, c.database_name
)
SELECT instance_id, database_name AS name, CAST(bytes AS DOUBLE) / 1024 / 1024 AS size_mb, docs = 0 AS empty,
       CAST(SUM(bytes) OVER (PARTITION BY instance_id) AS DOUBLE) / 1024 / 1024 AS total_size_mb
FROM db""")


# ------------------------------------------------------------ time series
_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
_FMT = "'%Y-%m-%dT%H:%M:%SZ'"

oracle("metric_rollup", ["metric_points"], f"""
SELECT instance_id, metric, strftime(time_bucket(INTERVAL '5 minutes', ts), {_FMT}) AS period_start,
       avg(value) AS avg_value, COUNT(*) AS n_points
FROM metric_points GROUP BY instance_id, metric, time_bucket(INTERVAL '5 minutes', ts)""")

_LATEST = f"""roll AS (
  SELECT instance_id, metric, time_bucket(INTERVAL '1 hour', ts) AS ps, avg(value) AS a
  FROM metric_points WHERE ts >= {_AS_OF} - INTERVAL 3 DAY AND ts <= {_AS_OF}
  GROUP BY instance_id, metric, time_bucket(INTERVAL '1 hour', ts)
),
latest AS (SELECT instance_id, metric, arg_max(a, ps) AS v FROM roll GROUP BY instance_id, metric)"""
_UNITS = [("cpu", "cpu_percent", "1.0"), ("connections", "connections", "1.0"),
          ("memory", "freeable_memory_mb", "(CAST(1 AS DOUBLE) / 1048576)"),
          ("storage", "free_storage_gb", "(CAST(1 AS DOUBLE) / 1073741824)"),
          ("read_iops", "read_iops", "1.0"), ("write_iops", "write_iops", "1.0"),
          ("read_latency", "read_latency_ms", "1000.0"), ("write_latency", "write_latency_ms", "1000.0"),
          ("net_rx", "network_rx_mib_s", "(CAST(1 AS DOUBLE) / 1048576)"),
          ("net_tx", "network_tx_mib_s", "(CAST(1 AS DOUBLE) / 1048576)")]
oracle("latest_metrics", ["metric_points", "instances"], f"""WITH {_LATEST}
SELECT i.instance_id, i.engine,
       {', '.join(f"COALESCE(max(l.v) FILTER (WHERE l.metric = '{m}'), 0.0) * {f} AS {o}" for m, o, f in _UNITS)}
FROM instances i LEFT JOIN latest l ON l.instance_id = i.instance_id
GROUP BY i.instance_id, i.engine""")

_LAG = f"""WITH {_LATEST}
SELECT i.instance_id AS identifier, i.source_instance_id AS source, i.status, i.instance_class AS class,
       i.availability_zone, i.multi_az, i.engine, i.engine_version, COALESCE(l.v, -1.0) AS replica_lag_seconds
FROM instances i LEFT JOIN latest l ON l.instance_id = i.instance_id AND l.metric = 'read_latency'
WHERE COALESCE(i.source_instance_id, '') <> ''"""
oracle("replica_lag", ["metric_points", "instances"], _LAG)
oracle("replica_cascades", ["metric_points", "instances"], f"""WITH {_LATEST},
i AS (SELECT instance_id, CAST(substr(instance_id, 4) AS BIGINT) AS n FROM instances),
r AS (SELECT i.instance_id AS identifier, 'db-' || CAST(n - 1 AS VARCHAR) AS source, COALESCE(l.v, -1.0) AS replica_lag_seconds
      FROM i LEFT JOIN latest l ON l.instance_id = i.instance_id AND l.metric = 'read_latency' WHERE n % 7 <> 0)
SELECT * FROM (
  WITH RECURSIVE chain(identifier, up, hops, lag, path) AS (
    SELECT identifier, source, 1, NULLIF(replica_lag_seconds, -1.0), [identifier] FROM r
    UNION ALL
    SELECT c.identifier, h.source, c.hops + 1, c.lag + NULLIF(h.replica_lag_seconds, -1.0), list_append(c.path, h.identifier)
    FROM chain c JOIN r h ON h.identifier = c.up WHERE NOT list_contains(c.path, h.identifier)),
  last AS (SELECT * FROM chain QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY hops DESC) = 1)
  SELECT r.identifier, r.source, CASE WHEN NOT list_contains(path, up) THEN up END AS root_source,
         CAST(CASE WHEN NOT list_contains(path, up) THEN hops END AS BIGINT) AS depth, r.replica_lag_seconds,
         CASE WHEN list_contains(path, up) THEN -1.0 ELSE COALESCE(lag, -1.0) END AS total_lag_seconds
  FROM r JOIN last USING (identifier))""")
oracle("replica_lag_filtered", ["metric_points", "instances"], _LAG + " AND i.source_instance_id = 'db-4'")


def _top(keys: str) -> str:
    return f"""
WITH agg AS (
  SELECT instance_id, {keys}, COUNT(*) AS samples FROM load_samples
  WHERE ts >= {_AS_OF} - INTERVAL 1440 MINUTE AND ts <= {_AS_OF}
  GROUP BY instance_id, {keys}
),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY instance_id ORDER BY samples DESC, {keys}) AS rank FROM agg)
SELECT instance_id, {keys}, CAST(samples AS DOUBLE) * 1.0 / 86400.0 AS db_load, rank FROM r WHERE rank <= 10"""


oracle("top_sql_by_load", ["load_samples"], _top("statement"))
ORACLES["latest_metrics_periods"] = ORACLES["latest_metrics"]
oracle("top_sql_by_load_periods", ["load_samples"], _top("statement"))
oracle("top_waits_by_load", ["load_samples"], _top("wait_type, wait_name"))

_EVENTS = f"""
SELECT strftime(event_time, {_FMT}) AS date, message, category AS categories, source_identifier
FROM instance_events WHERE event_time >= {_AS_OF} - INTERVAL 1440 MINUTE AND event_time <= {_AS_OF}"""
oracle("event_lookback", ["instance_events"], _EVENTS)
oracle("event_lookback_filtered", ["instance_events"], _EVENTS + " AND source_identifier = 'db-3'")


# ------------------------------------------------------------ counters
_KV = """kv AS (
  UNPIVOT (SELECT instance_id, snapshot_id, {cols} FROM counter_snapshots)
  ON COLUMNS(* EXCLUDE (instance_id, snapshot_id)) INTO NAME name VALUE value
)"""
_COUNTER_COLS = ["instance_class", "innodb_buffer_pool_read_requests", "innodb_buffer_pool_reads",
                 "innodb_buffer_pool_size", "connections", "threads_created", "threads_cached",
                 "created_tmp_tables", "created_tmp_disk_tables", "history_list_length",
                 "innodb_buffer_pool_pages_total", "innodb_buffer_pool_pages_dirty", "open_files",
                 "open_files_limit", "innodb_log_writes", "innodb_log_waits", "sort_scan", "sort_range",
                 "sort_merge_passes", "uptime", "innodb_os_log_written", "innodb_redo_log_capacity",
                 "threads_connected", "max_connections", "innodb_buffer_pool_instances",
                 "innodb_buffer_pool_chunk_size", "server_version"]
_SETTINGS = ("'innodb_buffer_pool_size', 'open_files_limit', 'innodb_redo_log_capacity', 'max_connections', "
             "'innodb_buffer_pool_instances', 'innodb_buffer_pool_chunk_size', 'server_version'")
_KV_SQL = _KV.format(cols=", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _COUNTER_COLS))
_SCOPE = (f"CASE WHEN name = 'instance_class' THEN 'meta' WHEN name IN ({_SETTINGS}) THEN 'variables' "
          f"ELSE 'status' END")

_SERVER_NAME = f"CASE WHEN {_SCOPE} = 'status' THEN upper(name[1]) || name[2:] ELSE name END"

oracle("kv_like", ["counter_snapshots"], f"""WITH {_KV_SQL}
SELECT instance_id, snapshot_id, {_SCOPE} AS scope, {_SERVER_NAME} AS name, value,
       COUNT(*) OVER (PARTITION BY instance_id, snapshot_id) AS n_matched
FROM kv WHERE name ILIKE 'innodb_buffer_pool%'""")

oracle("kv_numeric", ["counter_snapshots"], f"""WITH {_KV_SQL}
SELECT instance_id, snapshot_id, {_SCOPE} AS scope, {_SERVER_NAME} AS name, TRY_CAST(value AS DOUBLE) AS value
FROM kv WHERE regexp_full_match(value, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')""")

# ------------------------------------------------------------ text
_L = "COALESCE(TRY_CAST(regexp_extract(status_text, '{p}', {g}) AS BIGINT), 0)"
_D = "COALESCE(TRY_CAST(regexp_extract(status_text, '{p}', {g}) AS DOUBLE), 0.0)"


def _l(p, g=1):
    return _L.format(p=p, g=g)


def _d(p, g=1):
    return _D.format(p=p, g=g)


_HIT_A = _l(r"Buffer pool hit rate (\d+) / (\d+)", 1)
_HIT_B = _l(r"Buffer pool hit rate (\d+) / (\d+)", 2)
oracle("innodb_status", ["counter_snapshots", "innodb_status_text"], f"""
SELECT instance_id, snapshot_id,
  regexp_extract(status_text, '(\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}) \\d+ INNODB MONITOR OUTPUT', 1) AS monitor_time,
  {_l(r"OS WAIT ARRAY INFO: reservation count (\d+)")} AS sem_reservation_count,
  {_l(r"OS WAIT ARRAY INFO: signal count (\d+)")} AS sem_signal_count,
  {_l(r"RW-shared spins (\d+), rounds \d+, OS waits (\d+)", 1)} AS sem_rw_shared_spins,
  {_l(r"RW-shared spins (\d+), rounds \d+, OS waits (\d+)", 2)} AS sem_rw_shared_os_waits,
  {_l(r"RW-excl spins (\d+), rounds \d+, OS waits (\d+)", 1)} AS sem_rw_excl_spins,
  {_l(r"RW-excl spins (\d+), rounds \d+, OS waits (\d+)", 2)} AS sem_rw_excl_os_waits,
  contains(status_text, 'LATEST DETECTED DEADLOCK') AS has_deadlock,
  {_l(r"Trx id counter (\d+)")} AS trx_id_counter,
  {_l(r"History list length (\d+)")} AS trx_history_list_length,
  {_d(r"(\d+\.?\d*) reads/s, \d+ avg bytes/read, (\d+\.?\d*) writes/s, (\d+\.?\d*) log writes/s", 1)} AS io_reads_per_sec,
  {_d(r"(\d+\.?\d*) reads/s, \d+ avg bytes/read, (\d+\.?\d*) writes/s, (\d+\.?\d*) log writes/s", 2)} AS io_writes_per_sec,
  {_d(r"(\d+\.?\d*) reads/s, \d+ avg bytes/read, (\d+\.?\d*) writes/s, (\d+\.?\d*) log writes/s", 3)} AS io_log_writes_per_sec,
  {_l(r"Log sequence number\s+(\d+)")} AS log_sequence_number,
  {_l(r"Log flushed up to\s+(\d+)")} AS log_flushed_up_to,
  {_l(r"Last checkpoint at\s+(\d+)")} AS log_last_checkpoint,
  {_l(r"Buffer pool size\s+(\d+)")} AS bp_size_pages,
  {_l(r"Free buffers\s+(\d+)")} AS bp_free_pages,
  {_l(r"Database pages\s+(\d+)")} AS bp_database_pages,
  {_l(r"Modified db pages\s+(\d+)")} AS bp_modified_pages,
  CASE WHEN {_HIT_B} > 0 THEN CAST({_HIT_A} AS DOUBLE) / CAST({_HIT_B} AS DOUBLE) * 100 ELSE 0.0 END AS bp_hit_rate_pct,
  {_d(r"(\d+\.?\d*) reads/s, (\d+\.?\d*) creates/s, (\d+\.?\d*) writes/s", 1)} AS bp_reads_per_sec,
  {_d(r"(\d+\.?\d*) reads/s, (\d+\.?\d*) creates/s, (\d+\.?\d*) writes/s", 3)} AS bp_writes_per_sec,
  {_l(r"(\d+) queries inside InnoDB, (\d+) queries in queue", 1)} AS row_queries_inside,
  {_l(r"(\d+) queries inside InnoDB, (\d+) queries in queue", 2)} AS row_queries_in_queue,
  {_d(r"(\d+\.?\d*) inserts/s, (\d+\.?\d*) updates/s, (\d+\.?\d*) deletes/s, (\d+\.?\d*) reads/s", 1)} AS row_inserts_per_sec,
  {_d(r"(\d+\.?\d*) inserts/s, (\d+\.?\d*) updates/s, (\d+\.?\d*) deletes/s, (\d+\.?\d*) reads/s", 2)} AS row_updates_per_sec,
  {_d(r"(\d+\.?\d*) inserts/s, (\d+\.?\d*) updates/s, (\d+\.?\d*) deletes/s, (\d+\.?\d*) reads/s", 3)} AS row_deletes_per_sec,
  {_d(r"(\d+\.?\d*) inserts/s, (\d+\.?\d*) updates/s, (\d+\.?\d*) deletes/s, (\d+\.?\d*) reads/s", 4)} AS row_reads_per_sec
FROM innodb_status_text""")

oracle("deadlocks", ["counter_snapshots", "innodb_status_text"], """
WITH s AS (
  SELECT instance_id, snapshot_id,
         CASE WHEN strpos(status_text, 'LATEST DETECTED DEADLOCK' || chr(10)) = 0 THEN ''
              ELSE substr(status_text, strpos(status_text, 'LATEST DETECTED DEADLOCK' || chr(10)) + 25) END AS rest
  FROM innodb_status_text WHERE contains(status_text, 'LATEST DETECTED DEADLOCK')
),
sec AS (
  SELECT instance_id, snapshot_id,
         CASE WHEN strpos(rest, chr(10) || 'TRANSACTIONS' || chr(10)) > 0
              THEN substr(rest, 1, strpos(rest, chr(10) || 'TRANSACTIONS' || chr(10)) - 1) ELSE rest END AS sec
  FROM s
)
SELECT instance_id, snapshot_id,
       regexp_extract(sec, '(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}) \\d+\\n\\*\\*\\*', 1) AS deadlock_time,
       COALESCE(TRY_CAST(regexp_extract(sec, 'WE ROLL BACK TRANSACTION \\((\\d+)\\)', 1) AS INTEGER), 0) AS victim,
       array_to_string(list_filter(list_transform(regexp_extract_all(sec, 'MySQL thread id \\d+[^\\n]*\\n([^\\n]+)', 1),
                       lambda q: regexp_replace(q, '^\\s+|\\s+$', '', 'g')), lambda q: q <> ''), ' | ') AS queries
FROM sec""")

_SLOW = """parsed AS (
  SELECT instance_id, rec_id, CAST(query_ms AS DOUBLE) AS query_ms,
         CAST(CAST(regexp_extract(regexp_extract(record_text, '# Query_time:[^\\n]*', 0), 'Lock_time: ([0-9.]+)', 1) AS DECIMAL(20,6)) * 1000 AS DOUBLE) AS lock_ms,
         CAST(rows_sent AS BIGINT) AS rows_sent, CAST(rows_examined AS BIGINT) AS rows_examined,
         regexp_extract(record_text, '# User@Host: ([^\\n]*)', 1) AS user_host,
         regexp_replace(record_text, '^(#[^\\n]*\\n|SET timestamp=\\d+;\\n|use [^\\n]*;\\n)+', '') AS sql_text
  FROM slow_log
)"""
_NUM = r"(?:0x[0-9a-f]+|0b[01]+|(?:[0-9]+(?:\.[0-9]+)*|\.[0-9]+)(?:e[-+]?[0-9]+)?)\b"
_NAME = r"[a-z0-9_$@\x{80}-\x{10FFFF}]"
_TOKEN = (r"/\*[\s\S]*?(?:\*/|\z)|--(?:[ \t\r][^\n]*|\n|\z)|#[^\n]*|[xbn]?'(?:[^'\\]|\\[\s\S]|'')*(?:'|\\?\z)"
          r'|"(?:[^"\\]|\\[\s\S]|"")*(?:"|\\?\z)|' + _NUM
          + r"|`[^`]*(?:`|\z)|[0-9]*[a-z_$@\x{80}-\x{10FFFF}]" + _NAME + r"*(?:\." + _NAME + r"+)*|[\s\S]").replace("'", "''")
_FP_TOKENS = rf"""list_transform(regexp_extract_all(lower(sql_text), '{_TOKEN}'), lambda t:
  CASE WHEN regexp_matches(t, '^([xbn]?''|")') THEN '?' WHEN regexp_matches(t, '^(#|/\*|--)') THEN ' '
       WHEN regexp_full_match(t, '{_NUM}') THEN '?' ELSE t END)"""
_FP_FLAT = rf"""trim(regexp_replace(regexp_replace(regexp_replace(array_to_string({_FP_TOKENS}, ''),
  '\(\s*[-+]?\?(\s*,\s*[-+]?\?)*\s*\)', '(?+)', 'g'), '\(\?\+\)(\s*,\s*\(\?\+\))+', '(?+)', 'g'), '\s+', ' ', 'g'))"""
_FP = f"rtrim({_FP_FLAT}, ' ;')"
# The same entries from log files (FIXTURES.md): every seventh statement has a heading's text inside a line.
oracle("slow_log_files", ["slow_log"], f"""WITH {_SLOW}
SELECT user_host, query_ms, lock_ms, rows_sent, rows_examined,
       sql_text || CASE WHEN rec_id % 7 = 0 THEN ' -- # Time: later' ELSE '' END AS sql_text, COUNT(*) AS n
FROM parsed GROUP BY ALL""")
oracle("slow_log_context", ["slow_log"], f"""WITH {_SLOW}
SELECT instance_id, CAST(rec_id // 40 AS VARCHAR) AS log_time, 'db' || CAST((rec_id // 5000) % 3 AS VARCHAR) AS "database",
       query_ms, sql_text, COUNT(*) AS n
FROM parsed GROUP BY ALL""")
oracle("slow_log_records", ["slow_log"], f"WITH {_SLOW} SELECT * FROM parsed")
oracle("query_fingerprint", ["slow_log"], f"WITH {_SLOW} SELECT instance_id, rec_id, sql_text, {_FP} AS fingerprint FROM parsed")
for _key in ("slow_query_digest", "slow_query_digest_stored"):
  oracle(_key, ["slow_log"], f"""WITH {_SLOW},
fp AS (SELECT *, {_FP} AS fingerprint FROM parsed),
g AS (
  SELECT instance_id, fingerprint, COUNT(*) AS calls, SUM(query_ms) AS total_ms, avg(query_ms) AS avg_ms,
         max(query_ms) AS max_ms, round(quantile_cont(query_ms, 0.95), 3) AS p95_ms,
         CAST(SUM(rows_sent) AS BIGINT) AS rows_sent, CAST(SUM(rows_examined) AS BIGINT) AS rows_examined,
         first(sql_text ORDER BY query_ms DESC, sql_text) AS sample
  FROM fp GROUP BY instance_id, fingerprint
)
SELECT *, total_ms / SUM(total_ms) OVER (PARTITION BY instance_id) AS share FROM g""")

# ------------------------------------------------------------ activity
_PROCS = """v AS (
  SELECT instance_id, id, user_name AS "user", host, COALESCE(db, '') AS db, command, time_sec AS "time",
         COALESCE(state, '') AS state, COALESCE(info, '') AS info
  FROM processes WHERE NOT COALESCE(is_own_connection, false)
)"""
oracle("active_processes", ["processes"], f"WITH {_PROCS} SELECT * FROM v WHERE command <> 'Sleep' AND info <> ''")
oracle("active_processes_filtered", ["processes"], f"""WITH {_PROCS}
SELECT * REPLACE (left(info, 500) AS info) FROM v WHERE "time" >= 200""")
oracle("process_counts_filtered", ["processes"], f"""WITH {_PROCS}
SELECT instance_id, COUNT(*) FILTER (WHERE "time" >= 200) AS total, COUNT(*) FILTER (WHERE command = 'Sleep') AS total_idle
FROM v GROUP BY instance_id""")
oracle("process_counts", ["processes"], f"""WITH {_PROCS}
SELECT instance_id, COUNT(*) FILTER (WHERE command <> 'Sleep' AND info <> '') AS total,
       COUNT(*) FILTER (WHERE command = 'Sleep') AS total_idle
FROM v GROUP BY instance_id""")
_OPS = """
SELECT instance_id, opid, secs_running, op, ns, command_json AS command, client, descr AS "desc"
FROM current_ops
WHERE secs_running >= {least} AND NOT (ns = 'admin.$cmd' AND COALESCE(json_keys(command_json)[1], '') = 'currentOp')"""
oracle("long_running_ops", ["current_ops"], _OPS.replace("{least}", "0"))
oracle("long_running_ops_filtered", ["current_ops"], _OPS.replace("{least}", "200"))
_HISTORY = """
SELECT t.instance_id, t.processlist_id, COALESCE(t.user_name, '') AS "user", COALESCE(t.host, '') AS host, COALESCE(t.db, '') AS db,
       COALESCE(t.command, '') AS command, COALESCE(t.time_sec, 0) AS "time", COALESCE(t.state, '') AS state,
       COALESCE(t.info, '') AS info, t.thread_id, h.timer_start, COALESCE(h.sql_text, '') AS sql_text,
       h.timer_wait / 1e9 AS duration_ms, h.rows_affected, h.rows_sent, h.rows_examined, h.errors
FROM threads t JOIN statement_history h ON h.instance_id = t.instance_id AND h.thread_id = t.thread_id
WHERE t.processlist_id IS NOT NULL"""
oracle("process_statement_history", ["threads", "statement_history"], _HISTORY)
oracle("process_statement_history_one", ["threads", "statement_history"], _HISTORY + " AND t.processlist_id = 501")
oracle("plan_rows_clean", ["plan_rows"], """
SELECT instance_id, database_name, id, select_type, COALESCE(table_name, '') AS "table", COALESCE(partitions, '') AS partitions,
       access_type, COALESCE(possible_keys, '') AS possible_keys, COALESCE(used_key, '') AS key, COALESCE(key_len, '') AS key_len,
       COALESCE(ref, '') AS ref, est_rows AS rows, COALESCE(CAST(filtered AS DOUBLE), 0.0) AS filtered, COALESCE(extra, '') AS extra
FROM plan_rows""")
_UNUSED = """
SELECT DISTINCT i.instance_id, i.table_schema AS database_name, i.table_name, i.index_name
FROM cat_index_columns i
WHERE i.index_name <> 'PRIMARY' AND NOT EXISTS (
  SELECT 1 FROM plan_rows p WHERE p.instance_id = i.instance_id AND p.database_name = i.table_schema
    AND p.table_name = i.table_name AND p.used_key = i.index_name)"""
oracle("unused_indexes", ["cat_index_columns", "plan_rows"], _UNUSED)
oracle("unused_indexes_filtered", ["cat_index_columns", "plan_rows"], _UNUSED + " AND i.table_schema = 'Brand#11'")
oracle("probe_summary", ["probes"], """
SELECT instance_id, COUNT(*) AS probes, CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE) / COUNT(*) AS success_rate,
       round(quantile_cont(latency_ms, 0.5) FILTER (WHERE success), 3) AS p50_ms,
       round(quantile_cont(latency_ms, 0.95) FILTER (WHERE success), 3) AS p95_ms
FROM probes GROUP BY instance_id""")


# ------------------------------------------------------------ inventory
oracle("instance_inventory", ["instances"], """
SELECT instance_id AS identifier, instance_class AS class, status, engine, engine_version, availability_zone, multi_az,
       COALESCE(endpoint_address, '') AS endpoint_address, CAST(COALESCE(endpoint_port, 0) AS BIGINT) AS endpoint_port,
       COALESCE(storage_type, '') AS storage_type, CAST(COALESCE(storage_iops, 0) AS BIGINT) AS storage_iops,
       CAST(COALESCE(storage_throughput, 0) AS BIGINT) AS storage_throughput, performance_insights_enabled
FROM instances""")
oracle("server_status_flat", ["counter_snapshots", "server_status"], """
SELECT instance_id, snapshot_id, CAST(uptime AS DOUBLE) AS uptime_seconds, CAST(uptime AS DOUBLE) / 3600 AS uptime_hours,
       COALESCE(host, '') AS host, COALESCE(version, '') AS version,
       conn_current, conn_available, conn_total_created, op_insert, op_query, op_update, op_delete, op_getmore, op_command,
       mem_resident_mb, mem_virtual_mb, net_bytes_in, net_bytes_out, net_requests,
       lock_total_micros // 1000000 AS lock_total_time_secs, lock_queue_total, lock_queue_readers, lock_queue_writers,
       lock_active_total, lock_active_readers, lock_active_writers
FROM server_status""")
_BACKUPS = f"""
SELECT identifier, instance_id, snapshot_type, status, COALESCE(strftime(created_at, {_FMT}), '') AS created_at,
       allocated_storage_gb, encrypted, percent_progress, engine, COALESCE(engine_version, '') AS engine_version
FROM backups"""
oracle("backup_inventory", ["backups"], _BACKUPS)
oracle("backup_inventory_filtered", ["backups"], _BACKUPS + " WHERE instance_id = 'db-7' AND snapshot_type = 'manual'")
oracle("parameter_overrides", ["parameters"], """
SELECT p.instance_id, p.parameter_group, p.name, p.value, p.source, p.data_type, p.apply_type, p.is_modifiable,
       COALESCE(p.description, '') AS description
FROM parameters p
WHERE p.source = 'user' AND p.group_position = (SELECT min(q.group_position) FROM parameters q WHERE q.instance_id = p.instance_id)""")
_SECRETS = f"""
SELECT arn, name, COALESCE(description, '') AS description, rotation_enabled,
       COALESCE(strftime(last_changed, {_FMT}), '') AS last_changed,
       COALESCE(strftime(last_accessed, {_FMT}), '') AS last_accessed
FROM secrets"""
oracle("secret_inventory", ["secrets"], _SECRETS)
oracle("secret_inventory_filtered", ["secrets"], _SECRETS + " WHERE lower(name) LIKE 'building%'")
oracle("log_file_inventory", ["log_files"], f"""
SELECT instance_id, name, size_bytes // 1024 AS size_kb,
       COALESCE(strftime(epoch_ms(last_written_ms), {_FMT}), '') AS last_written,
       COUNT(*) OVER (PARTITION BY instance_id) AS n_files
FROM log_files""")
oracle("maintenance_queue", ["maintenance_actions"], f"""
SELECT resource_identifier, action, COALESCE(strftime(auto_applied_after, {_FMT}), '') AS auto_applied_after,
       COALESCE(strftime(current_apply_date, {_FMT}), '') AS current_apply_date, COALESCE(description, '') AS description,
       COALESCE(opt_in_status, '') AS opt_in_status, COUNT(*) OVER (PARTITION BY resource_identifier) AS total_actions
FROM maintenance_actions""")
_HOSTS = """
SELECT COALESCE(name_tag, '') AS name, host_id AS instance_id, COALESCE(private_ip, '') AS private_ip,
       COALESCE(public_ip, '') AS public_ip, COALESCE(zone, '') AS zone, COALESCE(host_type, '') AS type,
       COALESCE(state, '') AS state
FROM hosts"""
oracle("host_inventory", ["hosts"], _HOSTS)
oracle("host_inventory_filtered", ["hosts"],
       _HOSTS + " WHERE contains(lower(COALESCE(name_tag, '')), 'web-b') OR contains(lower(host_id), 'web-b')")
_HEALTH = f"""
SELECT f.arn, f.service, f.type_code, f.type_category, COALESCE(f.region, '') AS region, f.status,
       COALESCE(strftime(f.start_time, {_FMT}), '') AS start_time, COALESCE(strftime(f.end_time, {_FMT}), '') AS end_time,
       COALESCE(strftime(f.last_updated, {_FMT}), '') AS last_updated, COALESCE(d.description, '') AS description
FROM health_feed f LEFT JOIN health_details d ON d.arn = f.arn"""
oracle("health_events", ["health_feed", "health_details"], _HEALTH)
oracle("health_events_filtered", ["health_feed", "health_details"], _HEALTH + " WHERE f.service = 'RDS' AND f.status = 'open'")
# Keys and values by position; of a repeated key the last counts; the text null is an empty object.
_JSON = """j AS (
  SELECT name, blob, trim(blob) = 'null' AS is_null, CASE WHEN json_valid(blob) THEN json_type(blob) = 'OBJECT' ELSE false END AS is_obj FROM config_blobs
),
e AS (
  SELECT name, unnest(generate_series(1, len(json_keys(blob)))) AS i, json_keys(blob) AS ks, json_extract(blob, '$.*') AS vs
  FROM j WHERE is_obj
),
kv AS (SELECT name, ks[i] AS key, arg_max(vs[i] ->> '$', i) AS value FROM e GROUP BY name, ks[i])"""
oracle("json_key_filter", ["config_blobs"], f"""
WITH {_JSON},
k AS (
  SELECT name, string_agg(key || '=' || value, ',' ORDER BY key || '=' || value) AS kv, COUNT(*) AS n
  FROM kv WHERE contains(lower(key), 'db') GROUP BY name
)
SELECT j.name, CASE WHEN j.is_obj OR j.is_null THEN COALESCE(k.kv, '') END AS "values",
       CASE WHEN NOT j.is_obj AND NOT j.is_null THEN j.blob END AS raw_value, CAST(COALESCE(k.n, 0) AS INTEGER) AS n_keys
FROM j LEFT JOIN k ON k.name = j.name""")
oracle("config_key_audit", ["config_blobs"], f"WITH {_JSON} SELECT key, COUNT(*) AS n_blobs FROM kv GROUP BY key")
oracle("config_key_audit_filtered", ["config_blobs"],
       f"WITH {_JSON} SELECT key, COUNT(*) AS n_blobs FROM kv WHERE contains(lower(key), 'db_') GROUP BY key")


# ------------------------------------------------------------ streaming
# The closed periods from the stream and those still open: every period.
oracle("metric_rollup_stream", ["metric_points"], f"""
SELECT instance_id, metric, strftime(time_bucket(INTERVAL '5 minutes', ts), {_FMT}) AS period_start,
       avg(value) AS avg_value, COUNT(*) AS n_points
FROM metric_points GROUP BY instance_id, metric, time_bucket(INTERVAL '5 minutes', ts)""")

# H1-H12 on wide snapshots (history from the counter column), non-ok rows.
_CS_WIDE = _CS.replace(
    "CAST(CAST(NULLIF(regexp_extract(t.status_text, 'History list length (\\d+)', 1), '') AS BIGINT) AS DOUBLE) AS hll",
    "CAST(c.history_list_length AS DOUBLE) AS hll").replace(
    "  JOIN innodb_status_text t ON t.instance_id = c.instance_id AND t.snapshot_id = c.snapshot_id\n", "")
oracle("health_alerts_stream", ["counter_snapshots", "class_memory"], f"""WITH {_CS_WIDE},
allc AS (
{' UNION ALL '.join(_check_select(*s, with_order=True) for s in _CHECK_SQL)}
)
SELECT * FROM allc WHERE status <> 'ok'""")


# ------------------------------------------------------------ A2 for the other inventories
oracle("database_size_totals", ["cat_schemata", "cat_tables"], """
WITH d AS (
  SELECT s.instance_id, s.schema_name,
         round(CAST(COALESCE(SUM(t.data_length + t.index_length), 0) AS DOUBLE) / 1048576.0, 2) AS size_mb
  FROM cat_schemata s LEFT JOIN cat_tables t ON t.instance_id = s.instance_id AND t.table_schema = s.schema_name
  GROUP BY s.instance_id, s.schema_name, s.default_character_set_name, s.default_collation_name
)
SELECT instance_id, COUNT(*) AS n_items, round(SUM(size_mb), 2) AS total_size_mb FROM d GROUP BY instance_id""")
oracle("pg_table_size_totals", ["pg_relations", "pg_namespaces", "pg_roles", "pg_access_methods", "pg_user_stats"], """
SELECT c.instance_id, COUNT(*) AS n_items, round(SUM(round(c.total_bytes / 1048576.0, 2)), 2) AS total_size_mb
FROM pg_relations c JOIN pg_namespaces n ON n.instance_id = c.instance_id AND n.oid = c.relnamespace JOIN pg_roles r ON r.instance_id = c.instance_id AND r.oid = c.relowner
LEFT JOIN pg_access_methods am ON am.instance_id = c.instance_id AND am.oid = c.relam
LEFT JOIN pg_user_stats s ON s.instance_id = c.instance_id AND s.relid = c.oid
WHERE c.relkind = 'r' AND n.nspname NOT IN ('pg_catalog', 'information_schema', 'pg_toast')
GROUP BY c.instance_id""")
oracle("pg_database_size_totals", ["pg_databases", "pg_roles"], """
SELECT d.instance_id, COUNT(*) AS n_items, round(SUM(round(d.size_bytes / 1048576.0, 2)), 2) AS total_size_mb
FROM pg_databases d JOIN pg_roles r ON r.instance_id = d.instance_id AND r.oid = d.datdba WHERE NOT d.datistemplate GROUP BY d.instance_id""")

ORACLES["health_report_stored"] = ORACLES["health_report"]

oracle("redundant_indexes", ["cat_index_columns"], """
WITH i AS (
  SELECT instance_id, table_schema, table_name, index_name, min(non_unique) = 0 AS uniq,
         list(column_name || ':' || CAST(COALESCE(sub_part, 0) AS VARCHAR) ORDER BY seq_in_index) AS cols,
         string_agg(column_name, ',' ORDER BY seq_in_index) AS names
  FROM cat_index_columns WHERE index_type = 'BTREE' GROUP BY ALL
)
SELECT x.instance_id, x.table_schema AS database_name, x.table_name, x.index_name, x.names AS columns,
       first(y.index_name ORDER BY len(y.cols), y.index_name) AS covered_by
FROM i x JOIN i y ON x.instance_id = y.instance_id AND x.table_schema = y.table_schema AND x.table_name = y.table_name
  AND x.index_name <> y.index_name AND list_slice(y.cols, 1, len(x.cols)) = x.cols
  AND (len(y.cols) > len(x.cols) OR y.uniq OR y.index_name < x.index_name)
WHERE NOT x.uniq GROUP BY ALL""")
oracle("index_usage", ["slow_log", "cat_index_columns", "plan_rows"], f"""WITH {_SLOW},
c AS (SELECT instance_id, {_FP} AS fingerprint, COUNT(*) AS calls, SUM(query_ms) AS total_ms FROM parsed GROUP BY ALL),
p AS (SELECT DISTINCT instance_id, database_name, table_name, used_key AS index_name,
             CASE WHEN used_key = 'ix_2' THEN 'update orders set st = ? where k = ?' ELSE 'select * from t3 where id in (?+)' END AS fingerprint
      FROM plan_rows WHERE used_key IS NOT NULL),
u AS (SELECT p.instance_id, database_name, table_name, index_name, COUNT(*) AS statements, SUM(calls) AS calls, SUM(total_ms) AS total_ms
      FROM p JOIN c ON c.instance_id = p.instance_id AND c.fingerprint = p.fingerprint GROUP BY ALL),
i AS (SELECT DISTINCT instance_id, table_schema AS database_name, table_name, index_name FROM cat_index_columns)
SELECT i.*, COALESCE(u.statements, 0) AS statements, CAST(COALESCE(u.calls, 0) AS BIGINT) AS calls, COALESCE(u.total_ms, 0.0) AS total_ms
FROM i LEFT JOIN u USING (instance_id, database_name, table_name, index_name)""")
