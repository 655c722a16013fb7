"""Explicit schemas of every input table (never inferred).

``INPUT_SCHEMAS`` maps each input of the operators (the fixture tables of
FIXTURES.md and the nested / long shapes the adapters produce) to its DDL.
``conform`` selects and casts a stored table to its declared schema, so a
file written with wider integer types or extra columns still feeds the
operators the types they were written for.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

INPUT_SCHEMAS: dict[str, str] = {
    "cat_tables": "instance_id string, table_schema string, table_name string, table_type string, engine string, row_format string, table_collation string, table_rows bigint, data_length bigint, index_length bigint, data_free bigint, auto_increment bigint, table_comment string, create_time timestamp, update_time timestamp",
    "cat_collations": "collation_name string, character_set_name string",
    "cat_schemata": "instance_id string, schema_name string, default_character_set_name string, default_collation_name string",
    "cat_constraints": "instance_id string, table_schema string, table_name string, constraint_name string, constraint_type string",
    "cat_columns": "instance_id string, table_schema string, table_name string, ordinal_position int, column_name string, column_type string, is_nullable string, column_default string, character_set_name string, collation_name string, column_key string, extra string, column_comment string",
    "cat_index_columns": "instance_id string, table_schema string, table_name string, index_name string, index_type string, non_unique int, is_visible string, cardinality int, seq_in_index int, column_name string, sub_part int, nullable string",
    "cat_index_sizes": "instance_id string, database_name string, table_name string, index_name string, stat_name string, stat_value int, page_size int",
    "cat_key_usage": "instance_id string, table_schema string, table_name string, constraint_name string, ordinal_position int, column_name string, referenced_table_name string, referenced_column_name string",
    "cat_ref_constraints": "instance_id string, constraint_schema string, constraint_name string, update_rule string, delete_rule string",
    "plan_rows": "instance_id string, database_name string, table_name string, id int, select_type string, access_type string, used_key string, est_rows int, partitions string, possible_keys string, key_len string, ref string, filtered double, extra string",
    "pg_relations": "instance_id string, oid bigint, relnamespace int, relname string, relowner bigint, relam int, relkind string, reltuples bigint, data_bytes bigint, index_bytes int, total_bytes bigint, description string",
    "pg_namespaces": "instance_id string, oid int, nspname string",
    "pg_roles": "instance_id string, oid int, rolname string",
    "pg_access_methods": "instance_id string, oid int, amname string",
    "pg_user_stats": "instance_id string, relid bigint, n_dead_tup int, last_vacuum timestamp, last_autovacuum timestamp, last_analyze timestamp, last_autoanalyze timestamp",
    "pg_databases": "instance_id string, datname string, datdba bigint, encoding string, datcollate string, datconnlimit int, datistemplate boolean, size_bytes bigint",
    "doc_collections": "instance_id string, database_name string, name string",
    "doc_collection_stats": "instance_id string, database_name string, name string, doc_count bigint, size_bytes bigint, avg_obj_size int, nindexes bigint, total_index_size bigint",
    "counter_snapshots": "instance_id string, snapshot_id bigint, captured_at timestamp_ntz, instance_class string, innodb_buffer_pool_read_requests bigint, innodb_buffer_pool_reads bigint, innodb_buffer_pool_size bigint, connections bigint, threads_created bigint, threads_cached bigint, created_tmp_tables bigint, created_tmp_disk_tables bigint, history_list_length int, innodb_buffer_pool_pages_total int, innodb_buffer_pool_pages_dirty bigint, open_files bigint, open_files_limit int, innodb_log_writes int, innodb_log_waits bigint, sort_scan bigint, sort_range int, sort_merge_passes bigint, uptime bigint, innodb_os_log_written bigint, innodb_redo_log_capacity bigint, threads_connected bigint, max_connections int, innodb_buffer_pool_instances int, innodb_buffer_pool_chunk_size bigint, server_version string",
    "class_memory": "instance_class string, memory_mb int",
    "setting_rules": "rule_id string, name string, op string, bound int, severity string",
    "innodb_status_text": "instance_id string, snapshot_id bigint, status_text string",
    "processes": "instance_id string, id bigint, user_name string, host string, db string, command string, time_sec bigint, state string, info string, is_own_connection boolean",
    "statement_history": "instance_id string, thread_id bigint, timer_start bigint, sql_text string, timer_wait bigint, rows_affected int, rows_sent bigint, rows_examined bigint, errors int",
    "threads": "instance_id string, thread_id bigint, processlist_id bigint, user_name string, host string, db string, command string, time_sec bigint, state string, info string",
    "current_ops": "instance_id string, opid bigint, secs_running bigint, op string, ns string, command_json string, client string, descr string",
    "slow_log": "instance_id string, rec_id bigint, query_ms bigint, rows_sent int, rows_examined bigint, record_text string",
    "metric_points": "instance_id string, metric string, ts timestamp_ntz, value bigint",
    "load_samples": "instance_id string, ts timestamp_ntz, statement string, wait_type string, wait_name string",
    "instance_events": "source_identifier string, event_time timestamp_ntz, category string, message string",
    "health_feed": "arn string, service string, status string, start_time timestamp_ntz, type_code string, type_category string, region string, end_time timestamp_ntz, last_updated timestamp_ntz",
    "health_details": "arn string, description string",
    "probes": "instance_id string, probed_at timestamp_ntz, success boolean, latency_ms bigint",
    "instances": "instance_id string, instance_class string, engine string, engine_version string, status string, availability_zone string, multi_az boolean, source_instance_id string, endpoint_address string, endpoint_port int, storage_type string, storage_iops int, storage_throughput int, performance_insights_enabled boolean",
    "hosts": "reservation_id string, host_id string, name_tag string, private_ip string, public_ip string, zone string, host_type string, state string",
    "backups": "identifier string, instance_id string, snapshot_type string, status string, created_at timestamp_ntz, allocated_storage_gb bigint, encrypted boolean, percent_progress int, engine string, engine_version string",
    "maintenance_actions": "resource_identifier string, action_no bigint, action string, auto_applied_after timestamp_ntz, current_apply_date timestamp_ntz, description string, opt_in_status string",
    "parameters": "instance_id string, group_position bigint, parameter_group string, name string, value string, source string, data_type string, apply_type string, is_modifiable boolean, description string",
    "log_files": "instance_id string, name string, size_bytes bigint, last_written_ms bigint",
    "secrets": "name string, description string, rotation_enabled boolean, last_changed timestamp, arn string, last_accessed timestamp",
    "config_blobs": "name string, blob string",
    "server_status": "instance_id string, snapshot_id bigint, uptime bigint, conn_current bigint, conn_available int, conn_total_created bigint, op_insert bigint, op_query bigint, op_update int, lock_queue_total bigint, mem_resident_mb bigint, lock_total_micros bigint, net_bytes_in bigint, host string, version string, op_delete bigint, op_getmore bigint, op_command bigint, mem_virtual_mb bigint, net_bytes_out bigint, net_requests bigint, lock_queue_readers bigint, lock_queue_writers bigint, lock_active_total bigint, lock_active_readers bigint, lock_active_writers bigint",
    "counter_kv": "instance_id string, snapshot_id bigint, captured_at timestamp_ntz, scope string, name string, value string",
    "instance_docs": "instance_id string, instance_class string, engine string, engine_version string, status string, availability_zone string, multi_az boolean, source_instance_id string, endpoint struct<address:string,port:int>, storage struct<type:string,iops:int,throughput:int>, performance_insights_enabled boolean",
    "host_reservations": "reservation_id string, hosts array<struct<host_id:string,tags:array<struct<key:string,value:string>>,private_ip:string,public_ip:string,zone:string,host_type:string,state:struct<name:string>>>",
    "server_status_docs": "instance_id string, snapshot_id bigint, host string, version string, uptime bigint, connections struct<current:bigint,available:int,total_created:bigint>, opcounters struct<insert:bigint,query:bigint,update:int,delete:bigint,getmore:bigint,command:bigint>, global_lock struct<current_queue:struct<total:bigint,readers:bigint,writers:bigint>,active_clients:struct<total:bigint,readers:bigint,writers:bigint>,total_time_micros:bigint>, mem struct<resident:bigint,virtual:bigint>, network struct<bytes_in:bigint,bytes_out:bigint,num_requests:bigint>",
}


@lru_cache(maxsize=None)
def schema(name: str) -> StructType:
    """The declared StructType of an input table."""
    return DataType.fromDDL(INPUT_SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns of ``name`` in order, cast to their types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(name).fields])


def read_input(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a stored input table (parquet) and conform it to its schema."""
    return conform(spark.read.parquet(path), name)
