"""Cloud inventory documents and feeds: instances, hosts, backups, maintenance,
parameters, log files, secret metadata, settings blobs, server status, health
events (P5-P9, X3, X4, X8, J8, S3, A12).

Nested API replies arrive as struct / array columns; they are flattened with
field access and ``explode`` / ``inline``, never with Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import with_group_count

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _s(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _ts_text(c) -> Column:
    return F.coalesce(F.date_format(F.col(c) if isinstance(c, str) else c, RFC3339), F.lit(""))


# ------------------------------------------------------------------ P7


def instance_inventory(docs: DataFrame) -> DataFrame:
    """Instance documents flattened; a missing endpoint gives '' and 0,
    missing storage numbers give 0."""
    return docs.select(
        F.col("instance_id").alias("identifier"), F.col("instance_class").alias("class"), "status", "engine",
        "engine_version", "availability_zone", "multi_az",
        _s("endpoint.address").alias("endpoint_address"),
        F.coalesce(F.col("endpoint.port").cast("bigint"), F.lit(0).cast("bigint")).alias("endpoint_port"),
        _s("storage.type").alias("storage_type"),
        F.coalesce(F.col("storage.iops").cast("bigint"), F.lit(0).cast("bigint")).alias("storage_iops"),
        F.coalesce(F.col("storage.throughput").cast("bigint"), F.lit(0).cast("bigint")).alias("storage_throughput"),
        "performance_insights_enabled")


# ------------------------------------------------------------------ P8


def server_status_flat(docs: DataFrame) -> DataFrame:
    """Server status document flattened; uptime hours = seconds / 3600
    (fractional); global lock seconds = micros div 1,000,000 (integer)."""
    return docs.select(
        "instance_id", "snapshot_id", _s("host").alias("host"), _s("version").alias("version"),
        F.col("uptime").cast("double").alias("uptime_seconds"),
        (F.col("uptime").cast("double") / 3600).alias("uptime_hours"),
        F.col("connections.current").alias("conn_current"), F.col("connections.available").alias("conn_available"),
        F.col("connections.total_created").alias("conn_total_created"),
        F.col("opcounters.insert").alias("op_insert"), F.col("opcounters.query").alias("op_query"),
        F.col("opcounters.update").alias("op_update"), F.col("opcounters.delete").alias("op_delete"),
        F.col("opcounters.getmore").alias("op_getmore"), F.col("opcounters.command").alias("op_command"),
        F.col("mem.resident").alias("mem_resident_mb"), F.col("mem.virtual").alias("mem_virtual_mb"),
        F.col("network.bytes_in").alias("net_bytes_in"), F.col("network.bytes_out").alias("net_bytes_out"),
        F.col("network.num_requests").alias("net_requests"),
        F.expr("global_lock.total_time_micros div 1000000").alias("lock_total_time_secs"),
        *[F.col(f"global_lock.{at}.{who}").alias(f"lock_{name}_{who}")
          for at, name in (("current_queue", "queue"), ("active_clients", "active")) for who in ("total", "readers", "writers")])


# ------------------------------------------------------------------ P5


def backup_inventory(b: DataFrame, instance: str | None = None, kind: str | None = None) -> DataFrame:
    """P5: backups with optional equality filters on instance and type."""
    out = b
    if instance is not None:
        out = out.where(F.col("instance_id") == instance)
    if kind is not None:
        out = out.where(F.col("snapshot_type") == kind)
    return out.select("identifier", "instance_id", "snapshot_type", "status", _ts_text("created_at").alias("created_at"),
                      "allocated_storage_gb", "encrypted", "percent_progress", _s("engine").alias("engine"),
                      _s("engine_version").alias("engine_version"))


# ------------------------------------------------------------------ P6


def parameter_overrides(params: DataFrame) -> DataFrame:
    """User-set parameters of the first parameter group of each instance.

    The first group is found by a per-instance ``min`` (map-side partial
    aggregation, one row per instance) joined back, instead of a window that
    would put every parameter row of a busy instance into one task.
    """
    first = params.groupBy("instance_id").agg(F.min("group_position").alias("group_position"))
    j = params.where(F.col("source") == "user").join(first, ["instance_id", "group_position"], "left_semi")
    return j.select("instance_id", "parameter_group", "name", "value", "source", "data_type", "apply_type",
                    "is_modifiable", _s("description").alias("description"))


# ------------------------------------------------------------------ P9


def secret_inventory(s: DataFrame, name: str | None = None) -> DataFrame:
    """Secret metadata (never values); the optional name filter is the
    secrets API's: a prefix match that ignores case."""
    out = s if name is None else s.where(F.lower("name").startswith(name.lower()))
    return out.select(_s("arn").alias("arn"), "name", _s("description").alias("description"), "rotation_enabled",
                      _ts_text("last_changed").alias("last_changed"), _ts_text("last_accessed").alias("last_accessed"))


# ------------------------------------------------------------------ S3


def epoch_millis_ntz(c: str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC (no session time zone involved)."""
    return F.expr(f"timestampadd(MILLISECOND, {c}, TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def log_file_inventory(files: DataFrame) -> DataFrame:
    """S3: log files with size in KB (integer division), last-written time as
    text ('' if missing) and the number of files of the instance."""
    out = files.select(
        "instance_id", "name", F.expr("size_bytes div 1024").alias("size_kb"),
        _ts_text(epoch_millis_ntz("last_written_ms")).alias("last_written"))
    return with_group_count(out, ["instance_id"], "n_files")


# ------------------------------------------------------------------ X8


def maintenance_queue(actions: DataFrame) -> DataFrame:
    """Pending maintenance actions per resource (one row each), dates as
    text ('' if none), and the number of actions of the resource.

    Accepts either flat action rows or resources with an ``actions`` array.
    """
    flat = actions
    if "actions" in actions.columns:
        flat = actions.select("resource_identifier", F.inline("actions"))
    out = flat.select("resource_identifier", "action", _ts_text("auto_applied_after").alias("auto_applied_after"),
                      _ts_text("current_apply_date").alias("current_apply_date"), _s("description").alias("description"),
                      _s("opt_in_status").alias("opt_in_status"))
    return with_group_count(out, ["resource_identifier"], "total_actions")


# ------------------------------------------------------------------ X4


def host_inventory(reservations: DataFrame, text: str | None = None) -> DataFrame:
    """Reservations exploded to hosts; Name tag ('' if none); keep a host if
    the tag or the host id contains ``text`` (case-insensitive); NULL -> ''."""
    h = reservations.select(F.explode("hosts").alias("h")).select("h.*")
    name = F.coalesce(F.try_element_at(F.filter("tags", lambda t: t["key"] == "Name"), F.lit(1))["value"], F.lit(""))
    h = h.withColumn("name", name)
    if text:
        t = text.lower()
        h = h.where(F.lower("name").contains(t) | F.lower("host_id").contains(t))
    return h.select("name", F.col("host_id").alias("instance_id"), _s("private_ip").alias("private_ip"),
                    _s("public_ip").alias("public_ip"), _s("zone").alias("zone"), _s("host_type").alias("type"),
                    _s("state.name").alias("state"))


# ------------------------------------------------------------------ J8


def health_events(feed: DataFrame, details: DataFrame, service: str | None = None,
                  status: str | None = None) -> DataFrame:
    """Health events with optional service / status filters, left-joined
    to their details by ARN ('' when missing)."""
    f = feed
    if service is not None:
        f = f.where(F.col("service") == service)
    if status is not None:
        f = f.where(F.col("status") == status)
    # One description per event (the reference keeps a map by ARN); the
    # aggregate's partitioning on arn is reused by the join.
    d = details.groupBy("arn").agg(F.max("description").alias("description"))
    j = f.join(d, "arn", "left")
    return j.select("arn", "service", _s("type_code").alias("type_code"), _s("type_category").alias("type_category"),
                    _s("region").alias("region"), "status", _ts_text("start_time").alias("start_time"),
                    _ts_text("end_time").alias("end_time"), _ts_text("last_updated").alias("last_updated"),
                    _s("description").alias("description"))


# ------------------------------------------------------------------ X3, A12


def json_key_filter(blobs: DataFrame, key_filter: str | None = None, blob_col: str = "blob") -> DataFrame:
    """JSON object text -> map; keep keys containing ``key_filter``
    (case-insensitive); of a repeated key the last value counts; the text
    ``null`` is an empty map; other text is returned raw.

    A blob is parsed once, in a projection of its own; only maps that have a
    key twice are gone through for their last values.
    """
    parsed = blobs.select("name", F.col(blob_col).alias("_blob"), F.from_json(F.col(blob_col), "map<string,string>").alias("_map"))
    raw, keys = F.col("_map"), F.map_keys("_map")
    last = F.transform(F.array_distinct(keys), lambda k: F.struct(
        k, F.element_at(F.filter(F.map_entries(raw), lambda e: e["key"] == k), -1)["value"]))
    empty = F.create_map().cast("map<string,string>")
    m = (F.when(F.trim("_blob") == "null", empty).when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(last))
         .otherwise(raw))
    if key_filter:
        kf = key_filter.lower()
        m = F.map_filter(m, lambda k, v: F.lower(k).contains(kf))
    kept = parsed.select("name", "_blob", m.alias("values"))
    return kept.select("name", "values", F.when(F.col("values").isNull(), F.col("_blob")).alias("raw_value"),
                       F.coalesce(F.size("values"), F.lit(0)).alias("n_keys"))


def config_key_audit(blobs: DataFrame, key_filter: str | None = None, blob_col: str = "blob") -> DataFrame:
    """Number of blobs per JSON key after the key filter; non-JSON blobs
    add no keys.  groupBy on the key aggregates map-side, so a key present in
    every blob is no hot spot."""
    kv = json_key_filter(blobs, key_filter, blob_col).where(F.col("values").isNotNull())
    keys = kv.select(F.explode(F.map_keys("values")).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_blobs"))
