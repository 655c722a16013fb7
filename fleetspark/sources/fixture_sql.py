"""Fixture tables of FIXTURES.md, derived from the driver's base tables.

Fixed values: the SQL texts below are the fixture definitions of FIXTURES.md,
kept verbatim because both engines (Spark here, DuckDB in the oracle) must see
the same rows.  Each text runs unchanged on Spark SQL and on DuckDB.
"""

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["cat_tables"] = """\
SELECT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id,
       CASE WHEN p_partkey % 29 = 3 THEN 'mysql' ELSE p_brand END AS table_schema,
       't' || CAST(p_partkey AS STRING) AS table_name,
       CASE WHEN p_partkey % 16 = 7 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
       CASE WHEN p_partkey % 16 = 7 THEN NULL WHEN p_partkey % 7 = 0 THEN 'MyISAM' ELSE 'InnoDB' END AS engine,
       CASE WHEN p_partkey % 3 = 0 THEN 'Compact' ELSE 'Dynamic' END AS row_format,
       CASE WHEN p_partkey % 19 = 0 THEN 'no_such_collation' WHEN p_partkey % 2 = 0 THEN 'utf8mb4_general_ci' ELSE 'latin1_swedish_ci' END AS table_collation,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey * 37 END AS table_rows,
       CASE WHEN p_partkey % 16 = 7 THEN NULL WHEN p_partkey % 23 = 0 THEN 0 ELSE p_partkey * 65536 + p_size * 1024 END AS data_length,
       CASE WHEN p_partkey % 16 = 7 THEN NULL WHEN p_partkey % 23 = 0 THEN 0 ELSE p_size * 16384 * (p_partkey % 5) END AS index_length,
       CASE WHEN p_partkey % 16 = 7 THEN NULL WHEN p_partkey % 23 = 0 THEN 0 ELSE (p_partkey % 6) * 1048576 END AS data_free,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey * 1000003 END AS auto_increment,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END AS table_comment,
       CASE WHEN p_partkey % 10 = 6 THEN NULL ELSE TIMESTAMP '2023-05-06 07:08:09' END AS create_time,
       CASE WHEN p_partkey % 3 = 1 THEN TIMESTAMP '2024-01-20 21:22:23' END AS update_time
FROM part
"""

FIXTURE_SQL["cat_collations"] = """\
SELECT * FROM (VALUES ('utf8mb4_general_ci', 'utf8mb4'), ('latin1_swedish_ci', 'latin1')) AS v(collation_name, character_set_name)
"""

FIXTURE_SQL["cat_schemata"] = """\
SELECT DISTINCT instance_id, table_schema AS schema_name, 'utf8mb4' AS default_character_set_name, 'utf8mb4_general_ci' AS default_collation_name FROM cat_tables
UNION ALL
SELECT DISTINCT instance_id, 'empty_db' AS schema_name, 'latin1' AS default_character_set_name, 'latin1_swedish_ci' AS default_collation_name FROM cat_tables
"""

FIXTURE_SQL["cat_constraints"] = """\
SELECT instance_id, table_schema, table_name, 'PRIMARY' AS constraint_name, 'PRIMARY KEY' AS constraint_type
FROM cat_tables WHERE table_type = 'BASE TABLE' AND table_rows % 3 <> 0
UNION ALL
SELECT instance_id, table_schema, table_name, 'uq_1' AS constraint_name, 'UNIQUE' AS constraint_type
FROM cat_tables WHERE table_type = 'BASE TABLE'
"""

FIXTURE_SQL["cat_columns"] = """\
SELECT 'db-' || CAST(p.p_partkey % 10 AS STRING) AS instance_id, CASE WHEN p.p_partkey % 29 = 3 THEN 'mysql' ELSE p.p_brand END AS table_schema,
       't' || CAST(p.p_partkey AS STRING) AS table_name,
       s.i AS ordinal_position, 'c' || CAST(s.i AS STRING) AS column_name,
       CASE WHEN s.i > 1 THEN (CASE WHEN p.p_size % 2 = 0 THEN 'varchar(64)' ELSE 'decimal(10,2) unsigned' END)
            ELSE CASE p.p_partkey % 11 WHEN 0 THEN 'tinyint' WHEN 1 THEN 'tinyint unsigned' WHEN 2 THEN 'smallint'
                 WHEN 3 THEN 'smallint unsigned' WHEN 4 THEN 'mediumint' WHEN 5 THEN 'mediumint unsigned' WHEN 6 THEN 'int'
                 WHEN 7 THEN 'INT UNSIGNED' WHEN 8 THEN 'bigint(20)' WHEN 9 THEN 'bigint(20) unsigned' ELSE 'double' END END AS column_type,
       CASE WHEN s.i = 1 THEN 'NO' ELSE 'YES' END AS is_nullable,
       CASE WHEN s.i = 2 THEN '0' END AS column_default,
       CASE WHEN s.i > 1 AND p.p_size % 2 = 0 THEN 'utf8mb4' END AS character_set_name,
       CASE WHEN s.i > 1 AND p.p_size % 2 = 0 THEN 'utf8mb4_general_ci' END AS collation_name,
       CASE WHEN s.i = 1 THEN 'PRI' ELSE '' END AS column_key,
       CASE WHEN s.i = 1 THEN 'auto_increment' ELSE '' END AS extra,
       CASE WHEN s.i = 3 THEN p.p_name END AS column_comment
FROM part p JOIN (VALUES (1), (2), (3), (4)) AS s(i) ON s.i <= 1 + p.p_partkey % 4
"""

FIXTURE_SQL["cat_index_columns"] = """\
SELECT c.instance_id, c.table_schema, c.table_name,
       CASE WHEN k.i = 1 THEN 'PRIMARY' ELSE 'ix_' || CAST(k.i AS STRING) END AS index_name,
       CASE WHEN k.i = 3 THEN 'HASH' ELSE 'BTREE' END AS index_type,
       CASE WHEN k.i = 1 THEN 0 ELSE 1 END AS non_unique,
       CASE WHEN k.i = 4 THEN 'NO' ELSE 'YES' END AS is_visible,
       CASE WHEN k.i = 2 THEN NULL ELSE 100 * c.ordinal_position END AS cardinality,
       c.ordinal_position AS seq_in_index, c.column_name,
       CASE WHEN c.column_type = 'varchar(64)' THEN 10 END AS sub_part,
       c.is_nullable AS nullable
FROM cat_columns c JOIN (VALUES (1), (2), (3), (4)) AS k(i) ON c.ordinal_position <= k.i
"""

FIXTURE_SQL["cat_index_sizes"] = """\
SELECT instance_id, table_schema AS database_name, table_name, index_name, 'size' AS stat_name,
       MAX(seq_in_index) * 17 AS stat_value, 16384 AS page_size
FROM cat_index_columns WHERE index_name <> 'ix_4' GROUP BY instance_id, table_schema, table_name, index_name
"""

FIXTURE_SQL["cat_key_usage"] = """\
SELECT t.instance_id, t.table_schema, t.table_name, 'fk_' || t.table_name AS constraint_name,
       k.i AS ordinal_position, 'c' || CAST(k.i AS STRING) AS column_name,
       t.referenced_table_name, 'r' || CAST(k.i AS STRING) AS referenced_column_name
FROM (SELECT instance_id, table_schema, table_name, table_rows,
             LAG(table_name) OVER (PARTITION BY instance_id, table_schema ORDER BY table_name) AS referenced_table_name
      FROM cat_tables WHERE table_type = 'BASE TABLE') t
JOIN (VALUES (1), (2)) AS k(i) ON k.i = 1 OR t.table_rows % 6 = 0
"""

FIXTURE_SQL["cat_ref_constraints"] = """\
SELECT DISTINCT instance_id, table_schema AS constraint_schema, constraint_name,
       'CASCADE' AS update_rule,
       'RESTRICT' AS delete_rule
FROM cat_key_usage WHERE referenced_table_name IS NOT NULL
"""

FIXTURE_SQL["plan_rows"] = """\
SELECT instance_id, table_schema AS database_name, table_name, 1 AS id, 'SIMPLE' AS select_type,
       CASE WHEN seq_in_index = 1 THEN 'ref' ELSE 'ALL' END AS access_type,
       CASE WHEN index_name IN ('PRIMARY', 'ix_2') AND seq_in_index = 1 THEN index_name END AS used_key,
       100 * seq_in_index AS est_rows,
       CASE WHEN seq_in_index = 3 THEN 'p0,p1' END AS partitions,
       CASE WHEN seq_in_index < 3 THEN 'PRIMARY,ix_2' END AS possible_keys,
       CASE WHEN index_name = 'PRIMARY' AND seq_in_index = 1 THEN '8' END AS key_len,
       CASE WHEN seq_in_index = 1 THEN 'const' END AS ref,
       CASE WHEN seq_in_index = 4 THEN NULL ELSE CAST(100 AS DOUBLE) / seq_in_index END AS filtered,
       CASE WHEN seq_in_index = 2 THEN 'Using where' END AS extra
FROM cat_index_columns
"""

FIXTURE_SQL["pg_relations"] = """\
SELECT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, p_partkey AS oid,
       CASE WHEN p_partkey % 17 = 0 THEN 1 WHEN p_partkey % 5 = 0 THEN 3 ELSE 2 END AS relnamespace,
       't' || CAST(p_partkey AS STRING) AS relname, p_partkey % 3 AS relowner,
       CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 2 END AS relam,
       CASE WHEN p_partkey % 12 = 0 THEN 'i' ELSE 'r' END AS relkind,
       CASE WHEN p_partkey % 8 = 0 THEN -1 ELSE p_partkey * 10 END AS reltuples,
       p_partkey * 8192 AS data_bytes, p_size * 8192 AS index_bytes, p_partkey * 8192 + p_size * 8192 + 24576 AS total_bytes,
       CASE WHEN p_partkey % 4 = 0 THEN p_name END AS description
FROM part
"""

FIXTURE_SQL["pg_namespaces"] = """\
SELECT DISTINCT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, 1 AS oid, 'pg_catalog' AS nspname FROM part
UNION ALL
SELECT DISTINCT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, 2 AS oid, 'public' AS nspname FROM part
UNION ALL
SELECT DISTINCT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, 3 AS oid, 'sales_' || CAST(p_partkey % 10 AS STRING) AS nspname FROM part
"""

FIXTURE_SQL["pg_roles"] = """\
SELECT DISTINCT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, 0 AS oid, 'postgres' AS rolname FROM part
UNION ALL
SELECT DISTINCT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, 1 AS oid, 'app_' || CAST(p_partkey % 10 AS STRING) AS rolname FROM part
"""

FIXTURE_SQL["pg_access_methods"] = """\
SELECT DISTINCT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, 2 AS oid,
       CASE WHEN p_partkey % 10 = 4 THEN 'heap_v2' ELSE 'heap' END AS amname FROM part
"""

FIXTURE_SQL["pg_user_stats"] = """\
SELECT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, p_partkey AS relid, p_size * 3 AS n_dead_tup,
       CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2024-01-02 03:04:05' END AS last_vacuum,
       CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '2024-01-05 00:00:00' END AS last_autovacuum,
       CASE WHEN p_partkey % 4 = 0 THEN TIMESTAMP '2024-01-09 00:00:00' END AS last_analyze,
       CASE WHEN p_partkey % 6 = 0 THEN TIMESTAMP '2024-01-08 10:00:00' END AS last_autoanalyze
FROM part WHERE p_partkey % 10 <> 7
"""

FIXTURE_SQL["pg_databases"] = """\
SELECT 'db-' || CAST(c_custkey % 10 AS STRING) AS instance_id, 'app_' || CAST(c_custkey AS STRING) AS datname,
       c_custkey % 3 AS datdba, 'UTF8' AS encoding, 'en_US.UTF-8' AS datcollate, -1 AS datconnlimit,
       c_custkey % 6 = 0 AS datistemplate, c_custkey * 1234567 AS size_bytes
FROM customer
"""

FIXTURE_SQL["doc_collections"] = """\
SELECT 'db-' || CAST(c_custkey % 10 AS STRING) AS instance_id, c_mktsegment AS database_name,
       'coll_' || CAST(c_custkey AS STRING) AS name
FROM customer
"""

FIXTURE_SQL["doc_collection_stats"] = """\
SELECT 'db-' || CAST(c_custkey % 10 AS STRING) AS instance_id, c_mktsegment AS database_name,
       'coll_' || CAST(c_custkey AS STRING) AS name, c_custkey * 11 AS doc_count, c_custkey * 4096 AS size_bytes,
       512 AS avg_obj_size, c_custkey % 5 AS nindexes, c_custkey * 1024 AS total_index_size
FROM customer WHERE c_custkey % 7 <> 0
"""

FIXTURE_SQL["counter_snapshots"] = """\
SELECT 'db-' || CAST(o_custkey % 100 AS STRING) AS instance_id, o_orderkey AS snapshot_id, o_orderdate AS captured_at,
       CASE o_orderkey % 4 WHEN 0 THEN 'db.t3.large' WHEN 1 THEN 'db.m5.xlarge' WHEN 2 THEN 'db.r5.xlarge' ELSE 'db.unknown' END AS instance_class,
       CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 10000 + (o_orderkey % 97) * 100 END AS innodb_buffer_pool_read_requests,
       (o_orderkey % 17) * 100 AS innodb_buffer_pool_reads,
       ((o_orderkey % 9) + 1) * 2147483648 AS innodb_buffer_pool_size,
       CASE WHEN o_orderkey % 41 = 0 THEN 0 ELSE 1000 + (o_orderkey % 13) * 10 END AS connections,
       CASE WHEN o_orderkey % 43 = 0 THEN 0 ELSE (o_orderkey % 11) * 90 + 1 END AS threads_created,
       o_orderkey % 9 AS threads_cached,
       CASE WHEN o_orderkey % 61 = 0 THEN 0 ELSE 200 + o_orderkey % 100 END AS created_tmp_tables,
       o_orderkey % 90 AS created_tmp_disk_tables,
       CASE o_orderkey % 6 WHEN 0 THEN 500 WHEN 1 THEN 5000 WHEN 2 THEN 50000 WHEN 3 THEN 500000 WHEN 4 THEN 5000000 ELSE NULL END AS history_list_length,
       CASE WHEN o_orderkey % 59 = 0 THEN 0 ELSE 8192 END AS innodb_buffer_pool_pages_total,
       (o_orderkey % 10) * 800 AS innodb_buffer_pool_pages_dirty,
       (o_orderkey % 20) * 50 AS open_files,
       CASE WHEN o_orderkey % 53 = 0 THEN 0 ELSE 1000 END AS open_files_limit,
       CASE WHEN o_orderkey % 47 = 0 THEN 0 ELSE 1000 END AS innodb_log_writes,
       (o_orderkey % 30) * 10 AS innodb_log_waits,
       CASE WHEN o_orderkey % 37 = 0 THEN 0 ELSE 100 + o_orderkey % 10 END AS sort_scan,
       CASE WHEN o_orderkey % 37 = 0 THEN 0 ELSE 50 END AS sort_range,
       o_orderkey % 60 AS sort_merge_passes,
       86400 * (1 + o_orderkey % 3) AS uptime,
       CASE WHEN o_orderkey % 67 = 0 THEN 0 ELSE 1073741824 * (1 + o_orderkey % 31) END AS innodb_os_log_written,
       104857600 * (1 + o_orderkey % 5) AS innodb_redo_log_capacity,
       o_orderkey % 100 AS threads_connected,
       CASE WHEN o_orderkey % 71 = 0 THEN 0 ELSE 100 END AS max_connections,
       CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 ELSE 3 END AS innodb_buffer_pool_instances,
       (1 + o_orderkey % 7) * 33554432 AS innodb_buffer_pool_chunk_size,
       '8.0.' || CAST(o_orderkey % 40 AS STRING) AS server_version
FROM orders
"""

FIXTURE_SQL["class_memory"] = """\
SELECT * FROM (VALUES ('db.t3.large', 8192), ('db.m5.xlarge', 16384), ('db.r5.xlarge', 32768)) AS v(instance_class, memory_mb)
"""

FIXTURE_SQL["setting_rules"] = """\
SELECT * FROM (VALUES ('r1', 'open_files_limit', '<', 1000, 'warning'), ('r2', 'max_connections', '=', 0, 'critical'),
  ('r3', 'innodb_buffer_pool_instances', '>', 4, 'notice'), ('r4', 'innodb_redo_log_capacity', '>=', 524288000, 'notice'),
  ('r5', 'innodb_buffer_pool_chunk_size', '<=', 33554432, 'warning'), ('r6', 'no_such_setting', '>', 0, 'warning')) AS v(rule_id, name, op, bound, severity)
"""

FIXTURE_SQL["innodb_status_text"] = """\
SELECT instance_id, snapshot_id,
       '2024-01-15 10:20:30 140 INNODB MONITOR OUTPUT' || chr(10)
    || 'OS WAIT ARRAY INFO: reservation count ' || CAST(snapshot_id * 3 AS STRING) || chr(10)
    || 'OS WAIT ARRAY INFO: signal count ' || CAST(snapshot_id * 2 AS STRING) || chr(10)
    || 'RW-shared spins ' || CAST(snapshot_id AS STRING) || ', rounds 7, OS waits 5' || chr(10)
    || 'RW-excl spins 9, rounds 8, OS waits ' || CAST(snapshot_id % 7 AS STRING) || chr(10)
    || CASE WHEN snapshot_id % 3 = 0 THEN 'LATEST DETECTED DEADLOCK' || chr(10) || '------' || chr(10)
         || '2024-01-14 01:02:03 139' || chr(10) || '*** (1) TRANSACTION:' || chr(10)
         || 'MySQL thread id 11, query id 5 localhost app' || chr(10) || 'UPDATE a SET x = ' || CAST(snapshot_id AS STRING) || chr(10)
         || '*** (2) TRANSACTION:' || chr(10) || 'MySQL thread id 12, query id 6 localhost app' || chr(10) || 'DELETE FROM b' || chr(10)
         || '*** WE ROLL BACK TRANSACTION (' || CAST(1 + snapshot_id % 2 AS STRING) || ')' || chr(10) || '------------' ELSE '------------' END || chr(10)
    || 'TRANSACTIONS' || chr(10) || '------------' || chr(10)
    || 'Trx id counter ' || CAST(snapshot_id + 1000 AS STRING) || chr(10)
    || CASE WHEN history_list_length IS NULL THEN '' ELSE 'History list length ' || CAST(history_list_length AS STRING) || chr(10) END
    || 'MySQL thread id 99, not in the deadlock section' || chr(10) || 'SELECT 1' || chr(10)
    || '1.50 reads/s, 16384 avg bytes/read, 2.25 writes/s, 0.75 log writes/s' || chr(10)
    || 'Log sequence number' || repeat(' ', CAST(1 + snapshot_id % 10 AS INT)) || CAST(snapshot_id * 100 AS STRING) || chr(10)
    || 'Log flushed up to   ' || CAST(snapshot_id * 99 AS STRING) || chr(10)
    || 'Last checkpoint at  ' || CAST(snapshot_id * 98 AS STRING) || chr(10)
    || 'Buffer pool size   8191' || chr(10) || 'Free buffers       1024' || chr(10)
    || 'Database pages     ' || CAST(7000 + snapshot_id % 100 AS STRING) || chr(10) || 'Modified db pages  12' || chr(10)
    || 'Buffer pool hit rate ' || CAST(900 + snapshot_id % 100 AS STRING) || ' / 1000' || chr(10)
    || '3.50 reads/s, 4.25 creates/s, 5.75 writes/s' || chr(10)
    || '2 queries inside InnoDB, ' || CAST(snapshot_id % 4 AS STRING) || ' queries in queue' || chr(10)
    || '10.50 inserts/s, 20.25 updates/s, 30.75 deletes/s, ' || CAST(snapshot_id % 50 AS STRING) || '.00 reads/s' || chr(10) AS status_text
FROM counter_snapshots
"""

FIXTURE_SQL["processes"] = """\
SELECT 'db-' || CAST(user_id % 10 AS STRING) AS instance_id, event_id AS id, 'u' || CAST(user_id AS STRING) AS user_name,
       '10.0.0.' || CAST(user_id % 250 AS STRING) AS host, CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'app' END AS db,
       CASE WHEN event_type = 'view' THEN 'Sleep' ELSE 'Query' END AS command, event_id % 400 AS time_sec,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'executing' END AS state,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'view' AND event_id % 5 <> 0 THEN NULL
            WHEN event_id % 9 = 0 THEN repeat('select 1 ', 100) ELSE 'select ' || props END AS info,
       event_id % 1000 = 1 AS is_own_connection
FROM events
"""

FIXTURE_SQL["statement_history"] = """\
SELECT 'db-' || CAST(l_suppkey % 10 AS STRING) AS instance_id, l_suppkey AS thread_id,
       l_orderkey * 10 + l_linenumber AS timer_start, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'stmt ' || l_returnflag END AS sql_text,
       (l_orderkey % 5000) * 1000000000 AS timer_wait, l_linenumber AS rows_affected, l_partkey % 50 AS rows_sent,
       l_partkey AS rows_examined, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS errors
FROM lineitem
"""

FIXTURE_SQL["threads"] = """\
SELECT 'db-' || CAST(s_suppkey % 10 AS STRING) AS instance_id, s_suppkey AS thread_id,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey + 500 END AS processlist_id,
       'u' || CAST(s_nationkey AS STRING) AS user_name, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE '10.0.1.' || CAST(s_suppkey % 250 AS STRING) END AS host,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'app' END AS db, CASE WHEN s_suppkey % 2 = 0 THEN 'Sleep' ELSE 'Query' END AS command,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 400 END AS time_sec, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'executing' END AS state,
       CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'select ' || CAST(s_suppkey AS STRING) END AS info
FROM supplier
"""

FIXTURE_SQL["current_ops"] = """\
SELECT 'db-' || CAST(user_id % 10 AS STRING) AS instance_id, event_id AS opid, event_id % 300 AS secs_running, event_type AS op,
       CASE WHEN event_id % 8 = 0 THEN 'admin.$cmd' ELSE 'app.orders' END AS ns,
       CASE WHEN event_id % 16 = 0 THEN '{"currentOp": 1}' ELSE '{"find": "orders"}' END AS command_json,
       '10.0.0.1' AS client, 'conn' || CAST(user_id AS STRING) AS descr
FROM events
"""

FIXTURE_SQL["slow_log"] = """\
SELECT 'db-' || CAST(l_suppkey % 10 AS STRING) AS instance_id, l_orderkey * 10 + l_linenumber AS rec_id,
       (l_partkey % 900) * 10 AS query_ms, l_linenumber AS rows_sent, l_partkey AS rows_examined,
       '# User@Host: app[app] @ h [10.0.0.1]' || chr(10)
    || '# Query_time: ' || CAST(((l_partkey % 900) - (l_partkey % 100)) / 100 AS INT) || '.' || lpad(CAST(l_partkey % 100 AS STRING), 2, '0')
    || '  Lock_time: 0.00  Rows_sent: ' || CAST(l_linenumber AS STRING) || '  Rows_examined: ' || CAST(l_partkey AS STRING) || chr(10)
    || CASE WHEN l_linenumber % 3 = 0 THEN 'SELECT * FROM t' || CAST(l_linenumber AS STRING) || ' WHERE id IN (' || CAST(l_orderkey AS STRING) || ', 2,3);'
            WHEN l_linenumber % 3 = 1 THEN 'UPDATE orders  SET st = ''' || l_returnflag || ''' WHERE k = ' || CAST(l_orderkey AS STRING) || ';'
            ELSE 'select name from part' || chr(10) || 'where size > ' || CAST(l_partkey AS STRING) || ';' END AS record_text
FROM lineitem
"""

FIXTURE_SQL["metric_points"] = """\
SELECT 'db-' || CAST(user_id % 10 AS STRING) AS instance_id,
       CASE event_type WHEN 'click' THEN 'cpu' WHEN 'view' THEN 'connections' WHEN 'error' THEN 'memory' WHEN 'purchase' THEN 'storage' ELSE 'read_latency' END AS metric,
       ts, CAST(floor(value) AS BIGINT) * CASE event_type WHEN 'error' THEN 1048576 WHEN 'purchase' THEN 1073741824 ELSE 1 END AS value
FROM events WHERE user_id % 10 <> 9 OR event_type <> 'click'
"""

FIXTURE_SQL["load_samples"] = """\
SELECT 'db-' || CAST(user_id % 10 AS STRING) AS instance_id, ts, 'select ' || CAST(event_id % 23 AS STRING) AS statement,
       CASE WHEN event_id % 2 = 0 THEN 'io' ELSE 'cpu' END AS wait_type, 'w' || CAST(event_id % 17 AS STRING) AS wait_name
FROM events
"""

FIXTURE_SQL["instance_events"] = """\
SELECT 'db-' || CAST(user_id % 10 AS STRING) AS source_identifier, ts AS event_time, event_type AS category, 'msg ' || CAST(event_id AS STRING) AS message FROM events
"""

FIXTURE_SQL["health_feed"] = """\
SELECT 'arn:' || CAST(event_id AS STRING) AS arn, CASE WHEN user_id % 2 = 0 THEN 'RDS' ELSE 'EC2' END AS service,
       CASE event_id % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' ELSE 'upcoming' END AS status, ts AS start_time,
       'TYPE_' || upper(event_type) AS type_code, CASE WHEN event_id % 2 = 0 THEN 'issue' ELSE 'scheduledChange' END AS type_category,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'region-' || CAST(user_id % 4 AS STRING) END AS region,
       CASE WHEN event_id % 3 = 1 THEN ts END AS end_time, CASE WHEN event_id % 6 <> 0 THEN ts END AS last_updated
FROM events
"""

FIXTURE_SQL["health_details"] = """\
SELECT 'arn:' || CAST(event_id AS STRING) AS arn, 'detail ' || event_type AS description FROM events WHERE event_id % 4 <> 0
"""

FIXTURE_SQL["probes"] = """\
SELECT 'db-' || CAST(user_id % 10 AS STRING) AS instance_id, ts AS probed_at, event_type <> 'error' AS success,
       CASE WHEN event_type = 'error' THEN 0 ELSE event_id % 250 END AS latency_ms FROM events
"""

FIXTURE_SQL["instances"] = """\
SELECT 'db-' || CAST(c_custkey AS STRING) AS instance_id,
       CASE c_custkey % 4 WHEN 0 THEN 'db.t3.large' WHEN 1 THEN 'db.m5.xlarge' WHEN 2 THEN 'db.r5.xlarge' ELSE 'db.unknown' END AS instance_class,
       CASE c_custkey % 5 WHEN 4 THEN 'docdb' WHEN 3 THEN 'postgres' ELSE 'mysql' END AS engine, '8.0' AS engine_version,
       CASE WHEN c_custkey % 12 = 0 THEN 'stopped' ELSE 'available' END AS status, 'az-' || CAST(c_custkey % 3 AS STRING) AS availability_zone,
       c_custkey % 2 = 0 AS multi_az, CASE WHEN c_custkey % 3 = 2 THEN 'db-' || CAST(c_custkey - 1 AS STRING) ELSE '' END AS source_instance_id,
       CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE 'host' || CAST(c_custkey AS STRING) END AS endpoint_address,
       CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE 3306 END AS endpoint_port, 'gp3' AS storage_type,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 3000 END AS storage_iops, CAST(NULL AS INT) AS storage_throughput,
       c_custkey % 5 <> 4 AS performance_insights_enabled
FROM customer
"""

FIXTURE_SQL["hosts"] = """\
SELECT CAST((c_custkey - c_custkey % 4) AS STRING) AS reservation_id, 'i-' || CAST(c_custkey AS STRING) AS host_id,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'Web-' || c_mktsegment END AS name_tag, '10.0.0.' || CAST(c_custkey % 250 AS STRING) AS private_ip,
       CASE WHEN c_custkey % 2 = 0 THEN '54.0.0.1' END AS public_ip, 'az-1' AS zone, 'm5.large' AS host_type,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'running' END AS state
FROM customer
"""

FIXTURE_SQL["backups"] = """\
SELECT 's-' || CAST(o_orderkey AS STRING) AS identifier, 'db-' || CAST(o_custkey % 100 AS STRING) AS instance_id,
       CASE WHEN o_orderstatus = 'F' THEN 'manual' ELSE 'automated' END AS snapshot_type, 'available' AS status, o_orderdate AS created_at,
       o_orderkey % 500 AS allocated_storage_gb, o_orderkey % 2 = 0 AS encrypted, 100 AS percent_progress,
       CASE WHEN o_custkey % 3 = 0 THEN 'postgres' ELSE 'mysql' END AS engine, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '8.0.' || CAST(o_custkey % 40 AS STRING) END AS engine_version
FROM orders
"""

FIXTURE_SQL["maintenance_actions"] = """\
SELECT 'arn:db-' || CAST(o_custkey % 100 AS STRING) AS resource_identifier, o_orderkey AS action_no, o_orderpriority AS action,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS auto_applied_after, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS current_apply_date,
       'patch' AS description, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'pending' END AS opt_in_status
FROM orders
"""

FIXTURE_SQL["parameters"] = """\
SELECT 'db-' || CAST(p_partkey % 10 AS STRING) AS instance_id, p_partkey % 2 AS group_position, 'pg-' || CAST(p_partkey % 2 AS STRING) AS parameter_group,
       'param_' || CAST(p_partkey AS STRING) AS name, CAST(p_size AS STRING) AS value,
       CASE p_partkey % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'system' ELSE 'engine-default' END AS source, 'integer' AS data_type, 'dynamic' AS apply_type,
       p_partkey % 4 <> 0 AS is_modifiable, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_name END AS description
FROM part
"""

FIXTURE_SQL["log_files"] = """\
SELECT 'db-' || CAST(o_custkey % 100 AS STRING) AS instance_id, 'slowquery/log.' || CAST(o_orderkey AS STRING) AS name,
       o_orderkey * 333 AS size_bytes, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1700000000123 + o_orderkey * 1000 END AS last_written_ms
FROM orders
"""

FIXTURE_SQL["secrets"] = """\
SELECT c_mktsegment || '/db/' || CAST(c_custkey AS STRING) AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS description,
       c_custkey % 2 = 0 AS rotation_enabled, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE TIMESTAMP '2024-01-03 00:00:00' END AS last_changed,
       'arn:secret:' || CAST(c_custkey AS STRING) AS arn, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE TIMESTAMP '2024-01-29 00:00:00' END AS last_accessed
FROM customer
"""

FIXTURE_SQL["config_blobs"] = """\
SELECT 'cfg-' || CAST(event_id AS STRING) AS name,
       CASE WHEN event_id % 5 = 0 THEN 'plain text' WHEN event_id % 11 = 0 THEN ' null'
            WHEN event_id % 7 = 0 THEN '{"db_port": 1, "DB_Host": "h", "region": "eu", "db_port": ' || CAST(event_id % 9000 AS STRING) || ', "db_port": 7, "region": "us"}' ELSE '{"DB_Host": "h", "db_port": ' || CAST(event_id % 9000 AS STRING) || ', "region": "eu"}' END AS blob
FROM events
"""

FIXTURE_SQL["server_status"] = """\
SELECT instance_id, snapshot_id, uptime, threads_connected AS conn_current, max_connections AS conn_available, connections AS conn_total_created,
       innodb_log_waits AS op_insert, sort_scan AS op_query, sort_range AS op_update, open_files AS lock_queue_total,
       innodb_buffer_pool_pages_dirty AS mem_resident_mb, snapshot_id * 1500001 AS lock_total_micros, innodb_os_log_written AS net_bytes_in,
       'host-' || instance_id AS host, CASE WHEN snapshot_id % 13 = 0 THEN NULL ELSE server_version END AS version,
       sort_merge_passes AS op_delete, threads_cached AS op_getmore, threads_created AS op_command,
       innodb_buffer_pool_pages_dirty * 3 AS mem_virtual_mb, innodb_os_log_written * 2 AS net_bytes_out, connections * 7 AS net_requests,
       open_files % 5 AS lock_queue_readers, open_files % 3 AS lock_queue_writers, threads_connected AS lock_active_total,
       threads_connected % 7 AS lock_active_readers, threads_connected % 5 AS lock_active_writers
FROM counter_snapshots
"""
