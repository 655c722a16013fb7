"""Fixture tables (FIXTURES.md) as Spark DataFrames, plus the adapters that give
some of them the shape the operators read (long key/value counters, nested
API documents).

Each fixture is one Spark SQL projection over the base tables, so Catalyst
prunes columns and pushes filters from the operator through the fixture down
to the parquet scan.  Nothing is materialised or collected here.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixture_sql import FIXTURE_SQL
from .tables import BASE_TABLES, read_table

_REF = re.compile(r"(?:FROM|JOIN)\s+(\w+)")


@lru_cache(maxsize=None)
def fixture_deps(name: str) -> tuple[str, ...]:
    """Tables (base or fixture) a fixture reads directly."""
    refs = []
    for ref in _REF.findall(FIXTURE_SQL[name]):
        if (ref in FIXTURE_SQL or ref in BASE_TABLES) and ref not in refs:
            refs.append(ref)
    return tuple(refs)


def fixture_closure(names) -> list[str]:
    """Fixtures needed by ``names``, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in FIXTURE_SQL:
            return
        for d in fixture_deps(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_fixtures(sql: str, fixtures) -> str:
    """Prefix ``sql`` with CTEs for the named fixtures (for the DuckDB oracle).

    If ``sql`` starts with its own WITH, its CTEs follow the fixture CTEs.
    """
    ctes = [f"{n} AS (\n{FIXTURE_SQL[n].strip()}\n)" for n in fixture_closure(fixtures)]
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _bindable(sql: str, deps) -> str:
    """Fixture SQL with its table references as ``{name}`` placeholders.

    ``spark.sql(text, **frames)`` binds each DataFrame under a private,
    generated view name, so nothing is registered under the table names in
    the caller's session.  Literal braces (JSON text in two fixtures) are
    doubled first; only FROM / JOIN references to the fixture's own input
    tables are rewritten (SQL text held as data, e.g. 'DELETE FROM b', is not).
    """
    text = sql.replace("{", "{{").replace("}", "}}")

    def bind(m: re.Match) -> str:
        name = m.group(1)
        return m.group(0).replace(name, "{" + name + "}") if name in deps else m.group(0)

    return _REF.sub(bind, text)


def bindable_sql(name: str, deps) -> str:
    """The fixture's SQL ready for ``spark.sql(text, **frames)``."""
    return _bindable(FIXTURE_SQL[name], deps)


class Fixtures:
    """Lazily built fixture DataFrames for one data folder.

    ``fx["cat_tables"]`` runs the fixture SQL with its input tables bound as
    DataFrames (no session-wide temp views), so several ``Fixtures`` objects
    over different folders can live side by side in one session.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._dfs: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._dfs:
            if name in FIXTURE_SQL:
                deps = {dep: self.table(dep) for dep in fixture_deps(name)}
                self._dfs[name] = self.spark.sql(_bindable(FIXTURE_SQL[name], deps), **deps)
            else:
                self._dfs[name] = read_table(self.spark, self.sf_dir, name)
        return self._dfs[name]

    __getitem__ = table

    # ---- adapters: the shapes the reference reads -------------------------

    def counter_kv(self) -> DataFrame:
        """Counters in long string form, as SHOW STATUS / VARIABLES return them."""
        return counters_long(self.table("counter_snapshots"))

    def instance_docs(self) -> DataFrame:
        return instances_nested(self.table("instances"))

    def host_reservations(self) -> DataFrame:
        return hosts_nested(self.table("hosts"))

    def server_status_docs(self) -> DataFrame:
        return server_status_nested(self.table("server_status"))


# Names that are server settings (SHOW VARIABLES); all other counters are status.
SETTING_NAMES = (
    "innodb_buffer_pool_size", "open_files_limit", "innodb_redo_log_capacity",
    "max_connections", "innodb_buffer_pool_instances", "innodb_buffer_pool_chunk_size",
    "server_version",
)
SNAPSHOT_KEYS = ("instance_id", "snapshot_id", "captured_at")


def counters_long(wide: DataFrame) -> DataFrame:
    """Wide snapshot rows -> (instance_id, snapshot_id, captured_at, scope, name, value STRING).

    Status names are written as servers report them, with a capital first
    letter; settings are in lower case.  ``instance_class`` (known from the
    inventory, not a counter) travels as scope 'meta'.
    """
    def scope(c: str) -> str:
        return "meta" if c == "instance_class" else "variables" if c in SETTING_NAMES else "status"

    # scope and name are written once a column, not made from text in every row
    pairs = [F.struct(F.lit(scope(c)).alias("scope"), F.lit(c[0].upper() + c[1:] if scope(c) == "status" else c).alias("name"),
                      F.col(c).cast("string").alias("value")) for c in wide.columns if c not in SNAPSHOT_KEYS]
    return wide.select(*SNAPSHOT_KEYS, F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


def instances_nested(flat: DataFrame) -> DataFrame:
    """Instance rows in the nested shape of the describe-instances reply."""
    endpoint = F.when(F.col("endpoint_address").isNull(), F.lit(None)).otherwise(
        F.struct(F.col("endpoint_address").alias("address"), F.col("endpoint_port").alias("port")))
    storage = F.struct(F.col("storage_type").alias("type"), F.col("storage_iops").alias("iops"),
                       F.col("storage_throughput").alias("throughput"))
    return flat.select("instance_id", "instance_class", "engine", "engine_version", "status",
                       "availability_zone", "multi_az", "source_instance_id",
                       endpoint.alias("endpoint"), storage.alias("storage"),
                       "performance_insights_enabled")


def hosts_nested(flat: DataFrame) -> DataFrame:
    """Host rows grouped into reservations with a key/value tag list per host.

    A reservation holds a handful of hosts (bounded), so ``collect_list`` is safe.
    """
    tags = F.when(F.col("name_tag").isNull(), F.array().cast("array<struct<key:string,value:string>>")).otherwise(
        F.array(F.struct(F.lit("Name").alias("key"), F.col("name_tag").alias("value"))))
    host = F.struct(F.col("host_id"), tags.alias("tags"), "private_ip", "public_ip", "zone", "host_type",
                    F.struct(F.col("state").alias("name")).alias("state"))
    return flat.groupBy("reservation_id").agg(F.collect_list(host).alias("hosts"))


def server_status_nested(flat: DataFrame) -> DataFrame:
    """Server status rows as the nested serverStatus document."""
    return flat.select(
        "instance_id", "snapshot_id", "host", "version", F.col("uptime").alias("uptime"),
        F.struct(F.col("conn_current").alias("current"), F.col("conn_available").alias("available"),
                 F.col("conn_total_created").alias("total_created")).alias("connections"),
        F.struct(F.col("op_insert").alias("insert"), F.col("op_query").alias("query"),
                 F.col("op_update").alias("update"), F.col("op_delete").alias("delete"),
                 F.col("op_getmore").alias("getmore"), F.col("op_command").alias("command")).alias("opcounters"),
        F.struct(F.struct(F.col("lock_queue_total").alias("total"), F.col("lock_queue_readers").alias("readers"),
                          F.col("lock_queue_writers").alias("writers")).alias("current_queue"),
                 F.struct(F.col("lock_active_total").alias("total"), F.col("lock_active_readers").alias("readers"),
                          F.col("lock_active_writers").alias("writers")).alias("active_clients"),
                 F.col("lock_total_micros").alias("total_time_micros")).alias("global_lock"),
        F.struct(F.col("mem_resident_mb").alias("resident"), F.col("mem_virtual_mb").alias("virtual")).alias("mem"),
        F.struct(F.col("net_bytes_in").alias("bytes_in"), F.col("net_bytes_out").alias("bytes_out"),
                 F.col("net_requests").alias("num_requests")).alias("network"),
    )
