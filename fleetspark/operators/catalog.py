"""Schema and size audits over captured catalog tables of a whole fleet.

MySQL-style catalog: P1, J1, A1, A2, A3, A4, A6, J4, J5, J10.
PostgreSQL catalog: J2, J3.  Document store: J9, P10.

Every join is on the instance plus the catalog key (collations, which are the
same everywhere, on their name), so a fleet-wide run is one job.  Join
strategies are left to Spark's sizes in bytes.  Rows come unordered;
``sort=True`` gives the report order, a range shuffle of the whole fleet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mb
from ..plans.joins import one_per_key

SYSTEM_SCHEMAS = ("mysql", "information_schema", "performance_schema", "sys")   # fixed values
PG_SYSTEM_SCHEMAS = ("pg_catalog", "information_schema", "pg_toast")              # fixed values
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _s(c: str) -> Column:
    """NULL text -> '' (the reference's convention for optional text)."""
    return F.coalesce(F.col(c), F.lit(""))


def _ts_text(c: str) -> Column:
    """A time as text, '' if there is none."""
    return F.coalesce(F.date_format(F.col(c), RFC3339), F.lit(""))


def _ordered(df: DataFrame, sort: bool, *keys) -> DataFrame:
    """Report order (a range shuffle) only when asked; inventories that feed
    an aggregate skip it."""
    return df.orderBy(*keys) if sort else df


def _unsigned(c: str) -> Column:
    return F.lower(F.col(c)).contains("unsigned")


# ------------------------------------------------------------------ P1


def column_catalog(cols: DataFrame, schema: str | None = None, table: str | None = None,
                   sort: bool = False) -> DataFrame:
    """Columns of tables in ordinal order, NULL text -> '', flags parsed."""
    out = cols
    if schema is not None:
        out = out.where(F.col("table_schema") == schema)
    if table is not None:
        out = out.where(F.col("table_name") == table)
    return _ordered(out.select(
        "instance_id", "table_schema", "table_name",
        F.col("ordinal_position").alias("position"), F.col("column_name").alias("name"),
        F.col("column_type").alias("type"), (F.col("is_nullable") == "YES").alias("nullable"),
        _s("column_default").alias("default"), _s("character_set_name").alias("charset"),
        _s("collation_name").alias("collation"), _s("column_key").alias("key"), _s("extra").alias("extra"),
        _s("column_comment").alias("comment"), _unsigned("column_type").alias("unsigned"),
    ), sort, "instance_id", "table_schema", "table_name", "position")


# ------------------------------------------------------------------ J1, A2


def table_inventory(tables: DataFrame, collations: DataFrame, schema: str | None = None,
                    sort: bool = False) -> DataFrame:
    """Base tables with charset (via the collation lookup), sizes in MB
    (2 places), fragmentation % (1 place, NULL when all sizes are NULL/0),
    ordered by total size descending per instance."""
    t = tables.where(F.col("table_type") == "BASE TABLE")
    if schema is not None:
        t = t.where(F.col("table_schema") == schema)
    coll = one_per_key(collations.select(F.col("collation_name").alias("table_collation"), "character_set_name"),
                       "table_collation")
    j = t.join(coll, "table_collation", "left")
    di = F.col("data_length") + F.col("index_length")
    frag = F.round(F.coalesce(F.col("data_free"), F.lit(0)) / F.nullif(di + F.col("data_free"), F.lit(0)) * 100, 1)
    return _ordered(j.select(
        "instance_id", "table_schema", "table_name",
        _s("engine").alias("engine"), _s("row_format").alias("row_format"),
        _s("character_set_name").alias("charset"), _s("table_collation").alias("collation"),
        F.coalesce(F.col("table_rows"), F.lit(0)).cast("bigint").alias("row_count"),
        mb(F.coalesce(F.col("data_length"), F.lit(0)), 2).alias("data_mb"),
        mb(F.coalesce(F.col("index_length"), F.lit(0)), 2).alias("index_mb"),
        mb(F.coalesce(di, F.lit(0)), 2).alias("total_mb"),
        mb(F.coalesce(F.col("data_free"), F.lit(0)), 2).alias("free_mb"),
        frag.alias("frag_pct"),
        F.coalesce(F.col("auto_increment"), F.lit(0)).cast("decimal(20,0)").alias("auto_increment"),
        _s("table_comment").alias("comment"),
        _ts_text("create_time").alias("created_at"), _ts_text("update_time").alias("updated_at"),
    ), sort, "instance_id", F.desc("total_mb"), "table_schema", "table_name")


def size_totals(inventory: DataFrame, keys=("instance_id", "table_schema"),
                size_col: str = "total_mb", free_col: str | None = "free_mb") -> DataFrame:
    """A2: per-call totals: number of items and the sum of the (already
    rounded) sizes, per instance and schema.  Partial aggregation map-side."""
    aggs = [F.count(F.lit(1)).alias("n_items"), F.round(F.sum(size_col), 2).alias("total_size_mb")]
    if free_col:
        aggs.append(F.round(F.sum(free_col), 2).alias("total_free_mb"))
    return inventory.groupBy(*keys).agg(*aggs)


# ------------------------------------------------------------------ A1


def database_sizes(schemata: DataFrame, tables: DataFrame, sort: bool = False) -> DataFrame:
    """A1: schemata left-joined to their tables; MB of data+index (2 places);
    count of table names (views count too).  Tables are pre-aggregated per
    (instance, schema) before the join, so the join sees one row per schema."""
    per_schema = (tables.groupBy("instance_id", F.col("table_schema").alias("schema_name"))
                  .agg(F.sum(F.col("data_length") + F.col("index_length")).alias("bytes"),
                       F.count("table_name").alias("n_tables")))
    j = schemata.join(per_schema, ["instance_id", "schema_name"], "left")
    return _ordered(j.select(
        "instance_id", "schema_name", F.col("default_character_set_name").alias("charset"),
        F.col("default_collation_name").alias("collation"),
        mb(F.coalesce(F.col("bytes"), F.lit(0)), 2).alias("size_mb"),
        F.coalesce(F.col("n_tables"), F.lit(0)).cast("bigint").alias("tables"),
    ), sort, "instance_id", F.desc("size_mb"), "schema_name")


# ------------------------------------------------------------------ A3


def data_dictionary(cols: DataFrame, tables: DataFrame) -> DataFrame:
    """A3: per base table its comment and ordered list of columns.

    The list is bounded by the column count of one table; ``sort_array`` on a
    struct led by the ordinal gives the column order.
    """
    bt = tables.where(F.col("table_type") == "BASE TABLE").select(
        "instance_id", "table_schema", "table_name", _s("table_comment").alias("comment"))
    col = F.struct(F.col("ordinal_position").alias("position"), F.col("column_name").alias("name"),
                   F.col("column_type").alias("type"), _unsigned("column_type").alias("unsigned"),
                   (F.col("is_nullable") == "YES").alias("nullable"), _s("column_default").alias("default"),
                   _s("column_comment").alias("comment"))
    per_table = cols.groupBy("instance_id", "table_schema", "table_name").agg(
        F.sort_array(F.collect_list(col)).alias("columns"))
    return bt.join(per_table, ["instance_id", "table_schema", "table_name"])


# ------------------------------------------------------------------ A4


def index_catalog(index_columns: DataFrame, sizes: DataFrame) -> DataFrame:
    """A4: one row per index: type, unique, visible, cardinality of its first
    column row, ordered columns, and size in MB (2 places; 0 without a size row)."""
    col = F.struct(F.col("seq_in_index").alias("position"), F.col("column_name").alias("column"),
                   F.coalesce(F.col("sub_part"), F.lit(0)).cast("bigint").alias("sub_part"),
                   (F.col("nullable") == "YES").alias("nullable"))
    keys = ["instance_id", "table_schema", "table_name", "index_name"]
    idx = index_columns.groupBy(*keys).agg(
        F.min_by("index_type", "seq_in_index").alias("type"),
        (F.min_by("non_unique", "seq_in_index") == 0).alias("unique"),
        (F.min_by("is_visible", "seq_in_index") == "YES").alias("visible"),
        F.coalesce(F.min_by("cardinality", "seq_in_index"), F.lit(0)).cast("bigint").alias("cardinality"),
        F.sort_array(F.collect_list(col)).alias("columns"))
    sz = (sizes.where(F.col("stat_name") == "size")
          .select("instance_id", F.col("database_name").alias("table_schema"), "table_name", "index_name",
                  F.round(F.col("stat_value") * F.col("page_size") / 1024.0 / 1024.0, 2).alias("size_mb")))
    return (idx.join(sz, keys, "left")
            .withColumn("size_mb", F.coalesce(F.col("size_mb"), F.lit(0.0))))


# ------------------------------------------------------------------ J11


def redundant_indexes(index_columns: DataFrame) -> DataFrame:
    """Non-unique B-tree indexes whose columns another B-tree index of the table begins with.

    ``covered_by`` is that index, the shortest if there are several, then the
    first by name.  Of indexes with the same columns a unique one stays, else
    the first by name; the others are redundant.  Columns count as the same with
    the same prefix length.  Indexes meet on table and first column; an index
    has few columns, and a table few indexes that begin alike.
    """
    keys = ["instance_id", "table_schema", "table_name"]
    part = F.struct("column_name", F.coalesce(F.col("sub_part"), F.lit(0)).cast("bigint").alias("sub_part"))
    idx = index_columns.where(F.col("index_type") == "BTREE").groupBy(*keys, "index_name").agg(
        F.sort_array(F.collect_list(F.struct("seq_in_index", part.alias("part")))).alias("c"), (F.min("non_unique") == 0).alias("unique"))
    idx = idx.select(*keys, "index_name", "unique", F.col("c.part").alias("columns"), F.col("c")[0]["part"]["column_name"].alias("first"))
    x = idx.where(~F.col("unique"))
    y = idx.select(*keys, "first", F.col("index_name").alias("covered_by"), F.col("unique").alias("_unique"), F.col("columns").alias("_columns"))
    n, m = F.size("columns"), F.size("_columns")
    better = (m > n) | F.col("_unique") | (F.col("covered_by") < F.col("index_name"))
    pairs = x.join(y, [*keys, "first"]).where((F.col("covered_by") != F.col("index_name")) & (m >= n) & better
                                              & (F.slice("_columns", F.lit(1), n) == F.col("columns")))
    names = F.array_join(F.transform("columns", lambda c: c["column_name"]), ",")
    return pairs.groupBy(*keys, "index_name").agg(
        F.min(names).alias("columns"), F.min_by("covered_by", F.struct(m, F.col("covered_by"))).alias("covered_by")).select(
        "instance_id", F.col("table_schema").alias("database_name"), "table_name", "index_name", "columns", "covered_by")


# ------------------------------------------------------------------ A6, J5


def _check_summary(per_instance: DataFrame, check_name: str) -> DataFrame:
    """Per instance one check row: warning with the count of offending tables, or ok.

    ``per_instance`` has (instance_id, n_tables).  The offending tables stay
    rows (the *_tables functions); a per-instance list would gather an
    unbounded group into one row.
    """
    n = F.col("n_tables").cast("bigint")
    return per_instance.select("instance_id", F.lit(check_name).alias("check_name"),
                               F.when(n > 0, F.lit("warning")).otherwise(F.lit("ok")).alias("status"),
                               n.alias("n_tables"))


def _is_myisam_user_table() -> Column:
    return (F.col("engine") == "MyISAM") & ~F.col("table_schema").isin(*SYSTEM_SCHEMAS)


def deprecated_engine_tables(tables: DataFrame) -> DataFrame:
    """A6 detail: MyISAM tables outside the system schemas, one row each."""
    return (tables.where(_is_myisam_user_table())
            .select("instance_id", "table_schema", "table_name",
                    F.concat_ws(".", "table_schema", "table_name").alias("qualified_name")))


def deprecated_engine(tables: DataFrame) -> DataFrame:
    """Per instance, warning + number of MyISAM tables, or ok.  One
    aggregation (map-side partial counts), every instance of the catalog kept."""
    per = tables.groupBy("instance_id").agg(F.count_if(F.coalesce(_is_myisam_user_table(), F.lit(False)))
                                            .alias("n_tables"))
    return _check_summary(per, "deprecated_table_engine")


def _with_pk_flag(tables: DataFrame, constraints: DataFrame) -> DataFrame:
    pk = (constraints.where(F.col("constraint_type") == "PRIMARY KEY")
          .select("instance_id", "table_schema", "table_name", F.lit(True).alias("_has_pk")).distinct())
    return tables.join(pk, ["instance_id", "table_schema", "table_name"], "left")


def _no_pk_user_table() -> Column:
    return ((F.col("table_type") == "BASE TABLE") & ~F.col("table_schema").isin(*SYSTEM_SCHEMAS)
            & F.col("_has_pk").isNull())


def missing_primary_key_tables(tables: DataFrame, constraints: DataFrame) -> DataFrame:
    """J5 detail: base tables outside system schemas with no PRIMARY KEY."""
    return (_with_pk_flag(tables, constraints).where(_no_pk_user_table())
            .select("instance_id", "table_schema", "table_name",
                    F.concat_ws(".", "table_schema", "table_name").alias("qualified_name")))


def missing_primary_key(tables: DataFrame, constraints: DataFrame) -> DataFrame:
    """Per instance, warning + number of tables without a primary key, or
    ok.  One left join on the primary-key set, then one aggregation."""
    per = (_with_pk_flag(tables, constraints).groupBy("instance_id")
           .agg(F.count_if(F.coalesce(_no_pk_user_table(), F.lit(False))).alias("n_tables")))
    return _check_summary(per, "missing_primary_key")


# ------------------------------------------------------------------ J4


def foreign_key_graph(key_usage: DataFrame, ref: DataFrame, table: str | None = None) -> DataFrame:
    """Outgoing and incoming foreign keys of every table, one join.

    Key columns join their referential rule on (instance, constraint name,
    constraint schema = table schema).  Each joined row is emitted twice: as
    outgoing for the referencing table and as incoming for the referenced one
    (``other_table`` is then the referencing table).
    """
    kcu = key_usage.where(F.col("referenced_table_name").isNotNull())
    rc = ref.select("instance_id", F.col("constraint_schema").alias("table_schema"), "constraint_name",
                    "update_rule", "delete_rule")
    j = kcu.join(rc, ["instance_id", "table_schema", "constraint_name"])
    common = [F.col(c) for c in ("constraint_name", "ordinal_position", "column_name", "referenced_column_name",
                                 "update_rule", "delete_rule")]
    out = F.struct(F.col("table_name").alias("table"), F.lit("outgoing").alias("direction"),
                   F.col("referenced_table_name").alias("other_table"), *common)
    inc = F.struct(F.col("referenced_table_name").alias("table"), F.lit("incoming").alias("direction"),
                   F.col("table_name").alias("other_table"), *common)
    # One join; each joined row is emitted for both of its tables.
    g = j.select("instance_id", "table_schema", F.inline(F.array(out, inc)))
    if table is not None:
        g = g.where(F.col("table") == table)
    return g


# ------------------------------------------------------------------ J10

# Largest auto-increment value per integer type (signed, unsigned).
INT_TYPE_MAX = (
    ("tinyint", 127, 255),
    ("smallint", 32767, 65535),
    ("mediumint", 8388607, 16777215),
    ("bigint", 9223372036854775807, 18446744073709551615),
)
INT_DEFAULT_MAX = (2147483647, 4294967295)      # int / integer and anything else


def int_type_max(column_type) -> Column:
    """Max value of an integer column type as DECIMAL(20,0); tests in the
    order tiny, small, medium, big, else int (also for non-integer types)."""
    t = F.lower(F.col(column_type) if isinstance(column_type, str) else column_type)
    uns = t.contains("unsigned")
    dec = "decimal(20,0)"
    out = None
    for name, smax, umax in INT_TYPE_MAX:
        v = F.when(uns, F.lit(str(umax)).cast(dec)).otherwise(F.lit(str(smax)).cast(dec))
        out = F.when(t.contains(name), v) if out is None else out.when(t.contains(name), v)
    return out.otherwise(F.when(uns, F.lit(str(INT_DEFAULT_MAX[1])).cast(dec))
                         .otherwise(F.lit(str(INT_DEFAULT_MAX[0])).cast(dec)))


def autoincrement_overflow(cols: DataFrame, tables: DataFrame, schema: str | None = None,
                           sort: bool = False) -> DataFrame:
    """Auto-increment columns of base tables with current value, type max,
    % used and remaining (0 when over the max); ordered by % used desc."""
    c = cols.where(F.col("extra").contains("auto_increment"))
    t = tables.where(F.col("table_type") == "BASE TABLE").select(
        "instance_id", "table_schema", "table_name", "auto_increment")
    if schema is not None:
        c, t = c.where(F.col("table_schema") == schema), t.where(F.col("table_schema") == schema)
    j = c.join(t, ["instance_id", "table_schema", "table_name"])
    cur = F.coalesce(F.col("auto_increment"), F.lit(0)).cast("decimal(20,0)")
    mx = int_type_max("column_type")
    out = j.select("instance_id", "table_schema", F.col("table_name").alias("table"),
                   F.col("column_name").alias("column"), "column_type",
                   _unsigned("column_type").alias("unsigned"), cur.alias("current_value"), mx.alias("max_value"))
    pct = F.col("current_value").cast("double") / F.col("max_value").cast("double") * 100
    rem = F.when(F.col("max_value") >= F.col("current_value"),
                 (F.col("max_value") - F.col("current_value")).cast("decimal(20,0)")).otherwise(
        F.lit(0).cast("decimal(20,0)"))
    return _ordered(out.select("*", pct.alias("pct_used"), rem.alias("remaining_value")),
                    sort, "instance_id", F.desc("pct_used"), "table", "column")


# ------------------------------------------------------------------ J2, J3


def pg_table_inventory(rel: DataFrame, ns: DataFrame, roles: DataFrame, am: DataFrame, stats: DataFrame,
                       sort: bool = False) -> DataFrame:
    """Ordinary relations outside system schemas with owner, access method,
    rows (>= 0), dead tuples, sizes in MB and last vacuum / analyze times."""
    n = ns.select("instance_id", F.col("oid").alias("relnamespace"), "nspname")
    r = roles.select("instance_id", F.col("oid").alias("relowner"), "rolname")
    a = am.select("instance_id", F.col("oid").alias("relam"), "amname")
    s = stats.select("instance_id", F.col("relid").alias("oid"), "n_dead_tup", "last_vacuum",
                     "last_autovacuum", "last_analyze", "last_autoanalyze")
    j = (rel.where(F.col("relkind") == "r")
         .join(n.where(~F.col("nspname").isin(*PG_SYSTEM_SCHEMAS)), ["instance_id", "relnamespace"])
         .join(r, ["instance_id", "relowner"]).join(a, ["instance_id", "relam"], "left")
         .join(s, ["instance_id", "oid"], "left"))

    def ts_text(a_: str, b_: str) -> Column:
        return F.coalesce(F.date_format(F.greatest(a_, b_), RFC3339), F.lit(""))

    return _ordered(j.select(
        "instance_id", F.col("nspname").alias("schema"), F.col("relname").alias("name"),
        F.col("rolname").alias("owner"), _s("amname").alias("access_method"),
        F.greatest(F.col("reltuples").cast("bigint"), F.lit(0).cast("bigint")).alias("row_count"),
        F.coalesce(F.col("n_dead_tup"), F.lit(0)).cast("bigint").alias("dead_tuples"),
        mb("data_bytes", 2).alias("data_mb"), mb("index_bytes", 2).alias("index_mb"),
        mb("total_bytes", 2).alias("total_mb"), _s("description").alias("comment"),
        ts_text("last_vacuum", "last_autovacuum").alias("last_vacuum"),
        ts_text("last_analyze", "last_autoanalyze").alias("last_analyze"),
    ), sort, "instance_id", F.desc("total_mb"), "schema", "name")


def pg_database_sizes(dbs: DataFrame, roles: DataFrame, sort: bool = False) -> DataFrame:
    """Non-template databases with owner and size in MB (2 places)."""
    r = roles.select("instance_id", F.col("oid").alias("datdba"), "rolname")
    j = dbs.where(~F.col("datistemplate")).join(r, ["instance_id", "datdba"])
    return _ordered(j.select("instance_id", "datname", F.col("rolname").alias("owner"), "encoding",
                             F.col("datcollate").alias("collation"), F.col("datconnlimit").alias("connection_limit"),
                             mb("size_bytes", 2).alias("size_mb")), sort, "instance_id", F.desc("size_mb"), "datname")


# ------------------------------------------------------------------ J9, P10


def collection_stats(colls: DataFrame, stats: DataFrame) -> DataFrame:
    """Collections with their stats; a missing stats row gives zeros."""
    keys = ["instance_id", "database_name", "name"]
    j = colls.join(stats, keys, "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select(*keys, z("doc_count").cast("bigint").alias("count"),
                    (z("size_bytes").cast("double") / 1024 / 1024).alias("size_mb"),
                    z("avg_obj_size").cast("double").alias("avg_obj_size_bytes"),
                    z("nindexes").cast("int").alias("index_count"),
                    (z("total_index_size").cast("double") / 1024 / 1024).alias("total_index_size_mb"))


def docdb_database_sizes(colls: DataFrame, stats: DataFrame) -> DataFrame:
    """P10: databases of the document store (collections summed): MB
    unrounded, empty flag, and the instance total in MB."""
    keys = ["instance_id", "database_name", "name"]
    j = colls.join(stats, keys, "left")
    db = j.groupBy("instance_id", "database_name").agg(
        F.sum(F.coalesce(F.col("size_bytes"), F.lit(0))).alias("bytes"),
        F.sum(F.coalesce(F.col("doc_count"), F.lit(0))).alias("docs"))
    # Window over the aggregated rows (one per database of an instance).
    w = Window.partitionBy("instance_id")
    return db.select("instance_id", F.col("database_name").alias("name"),
                     (F.col("bytes").cast("double") / 1024 / 1024).alias("size_mb"),
                     (F.col("docs") == 0).alias("empty"),
                     (F.sum("bytes").over(w).cast("double") / 1024 / 1024).alias("total_size_mb"))
