"""Property tests: X2 type maxima, J4 symmetry, X3/X4 filters, P4 window edges."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetspark.operators import catalog, inventory, timeseries
from fleetspark.sources.fixtures import Fixtures


def test_int_type_max_all_types(spark):
    types = ["tinyint", "smallint", "mediumint", "int", "bigint", "integer", "double", "decimal(10,2)"]
    rows = [(t + (" unsigned" if u else ""),) for t in types for u in (False, True)] + [("BIGINT(20) UNSIGNED",)]
    df = spark.createDataFrame(rows, "column_type string")
    got = {r[0]: int(r[1]) for r in df.select("column_type", catalog.int_type_max("column_type")).collect()}
    want = {"tinyint": (127, 255), "smallint": (32767, 65535), "mediumint": (8388607, 16777215),
            "bigint": (2**63 - 1, 2**64 - 1)}
    for t in types:
        s, u = want.get(t, (2**31 - 1, 2**32 - 1))
        assert got[t] == s and got[t + " unsigned"] == u
    assert got["BIGINT(20) UNSIGNED"] == 2**64 - 1


def test_overflow_remaining_is_zero_when_over(spark):
    cols = spark.createDataFrame([("i", "s", "t", "c1", "tinyint", "auto_increment")],
                                 "instance_id string, table_schema string, table_name string, column_name string, "
                                 "column_type string, extra string")
    tabs = spark.createDataFrame([("i", "s", "t", "BASE TABLE", 300)],
                                 "instance_id string, table_schema string, table_name string, table_type string, "
                                 "auto_increment long")
    r = catalog.autoincrement_overflow(cols, tabs).collect()[0]
    assert int(r["remaining_value"]) == 0 and r["pct_used"] > 100


def test_foreign_keys_outgoing_equal_incoming(spark):
    fx = Fixtures(spark, SF_SMALL)
    g = catalog.foreign_key_graph(fx["cat_key_usage"], fx["cat_ref_constraints"])
    counts = {r["direction"]: r["count"] for r in g.groupBy("direction").count().collect()}
    assert counts["outgoing"] == counts["incoming"] > 0
    out = g.where(F.col("direction") == "outgoing").select(
        "instance_id", "table_schema", F.col("table").alias("a"), F.col("other_table").alias("b"), "constraint_name",
        "ordinal_position")
    inc = g.where(F.col("direction") == "incoming").select(
        "instance_id", "table_schema", F.col("other_table").alias("a"), F.col("table").alias("b"), "constraint_name",
        "ordinal_position")
    assert out.exceptAll(inc).count() == 0


def test_host_filter_matches_tag_or_id(spark):
    fx = Fixtures(spark, SF_SMALL)
    res = fx.host_reservations()
    by_tag = inventory.host_inventory(res, "AUTO").collect()
    assert by_tag and all("auto" in r["name"].lower() or "auto" in r["instance_id"].lower() for r in by_tag)
    by_id = inventory.host_inventory(res, "i-1").collect()
    assert by_id and all("i-1" in r["instance_id"] for r in by_id)
    assert inventory.host_inventory(res).count() == fx["hosts"].count()


def test_json_key_filter_raw_and_case(spark):
    df = spark.createDataFrame([("a", '{"DB_Host": "h", "db_port": 5, "x": 1}'), ("b", "plain text")],
                               "name string, blob string")
    got = {r["name"]: r for r in inventory.json_key_filter(df, "DB").collect()}
    assert got["a"]["values"] == {"DB_Host": "h", "db_port": "5"} and got["a"]["n_keys"] == 2
    assert got["a"]["raw_value"] is None
    assert got["b"]["values"] is None and got["b"]["raw_value"] == "plain text" and got["b"]["n_keys"] == 0


def test_event_lookback_edges_inclusive(spark):
    ev = spark.createDataFrame(
        [("s", dt.datetime(2024, 1, 30, 0, 0, 0), "a", "m1"), ("s", dt.datetime(2024, 1, 31, 0, 0, 0), "b", "m2"),
         ("s", dt.datetime(2024, 1, 29, 23, 59, 59), "c", "m3"), ("s", dt.datetime(2024, 1, 31, 0, 0, 1), "d", "m4")],
        "source_identifier string, event_time timestamp_ntz, category string, message string")
    got = sorted(r["message"] for r in timeseries.event_lookback(ev, dt.datetime(2024, 1, 31), 1440).collect())
    assert got == ["m1", "m2"]


def test_no_window_over_raw_rows_for_per_instance_counts(spark):
    from fleetspark.registry import QUERIES
    for key in ("log_file_inventory", "maintenance_queue", "parameter_overrides"):
        p = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Window [" not in p, key


def test_cloud_metric_names_per_engine(spark):
    inst = spark.createDataFrame([("a", "mysql"), ("b", "docdb")], "instance_id string, engine string")
    t = dt.datetime(2024, 1, 30, 23, 55)      # inside the default 15-minute look-back
    raw = spark.createDataFrame(
        [("a", "FreeStorageSpace", t, 2.0 * 2**30), ("a", "FreeLocalStorage", t, 9.0), ("b", "FreeLocalStorage", t, 4.0 * 2**30),
         ("b", "FreeStorageSpace", t, 9.0), ("b", "NetworkBytesIn", t, 2.0 * 2**20), ("a", "CPUUtilization", t, 50.0)],
        "instance_id string, metric_name string, ts timestamp_ntz, value double")
    pts = timeseries.points_from_cloud_names(raw, inst)
    got = {r["instance_id"]: r for r in timeseries.latest_metrics(pts, inst, dt.datetime(2024, 1, 31)).collect()}
    assert got["a"]["free_storage_gb"] == 2.0 and got["a"]["cpu_percent"] == 50.0
    assert got["b"]["free_storage_gb"] == 4.0 and got["b"]["network_rx_mib_s"] == 2.0
    assert got["b"]["cpu_percent"] == 0.0


def test_catalog_ids_are_per_instance(spark):
    from fleetspark.operators import catalog
    roles = spark.createDataFrame([("i1", 10, "alice"), ("i2", 10, "bob")], "instance_id string, oid int, rolname string")
    dbs = spark.createDataFrame([("i1", "d1", 10, "UTF8", "C", -1, False, 2 << 20), ("i2", "d2", 10, "UTF8", "C", -1, False, 1 << 20)],
                                "instance_id string, datname string, datdba int, encoding string, datcollate string, datconnlimit int, datistemplate boolean, size_bytes long")
    got = sorted((r["instance_id"], r["owner"], r["size_mb"]) for r in catalog.pg_database_sizes(dbs, roles).collect())
    assert got == [("i1", "alice", 2.0), ("i2", "bob", 1.0)]


def test_redundant_indexes(spark):
    from fleetspark.operators import catalog
    rows = [(i, n, c.split(":")[0], int(c.split(":")[1]) if ":" in c else None, u, t) for i, n, cols, u, t in [
        ("t", "PRIMARY", "id", 0, "BTREE"), ("t", "a", "x", 1, "BTREE"), ("t", "ab", "x,y", 1, "BTREE"), ("t", "abc", "x,y,z", 1, "BTREE"),
        ("t", "ab2", "x,y", 1, "BTREE"), ("t", "p", "x:10", 1, "BTREE"), ("t", "h", "x", 1, "HASH"), ("t", "u", "x,y", 0, "BTREE"),
        ("t", "id2", "id", 1, "BTREE"), ("s", "a", "x", 1, "BTREE"), ("s", "ba", "y,x", 1, "BTREE")] for c in cols.split(",")]
    seen, out = {}, []
    for t, n, c, sub, u, kind in rows:
        seen[t, n] = seen.get((t, n), 0) + 1
        out.append(("i", "db", t, n, kind, u, seen[t, n], c, sub))
    df = spark.createDataFrame(out, "instance_id string, table_schema string, table_name string, index_name string, index_type string, non_unique int, seq_in_index int, column_name string, sub_part int")
    got = {(r["table_name"], r["index_name"]): r["covered_by"] for r in catalog.redundant_indexes(df).collect()}
    assert got == {("t", "a"): "ab", ("t", "ab"): "u", ("t", "ab2"): "ab", ("t", "id2"): "PRIMARY"}


def test_index_usage_by_logged_statements(spark):
    from fleetspark.operators import activity
    idx = spark.createDataFrame([("i", "db", "t", n) for n in ("PRIMARY", "a", "b", "a")], "instance_id string, table_schema string, table_name string, index_name string")
    plans = spark.createDataFrame([("i", "db", "t", "a", "f1"), ("i", "db", "t", "a", "f1"), ("i", "db", "t", "a", "f2"), ("i", "db", "t", "b", "f3"),
                                   ("i", "db", "t", "b", None), ("j", "db", "t", "b", "f1")],
                                  "instance_id string, database_name string, table_name string, used_key string, fingerprint string")
    calls = spark.createDataFrame([("i", "f1", 3, 30.0), ("i", "f2", 2, 5.0), ("j", "f3", 9, 1.0)], "instance_id string, fingerprint string, calls long, total_ms double")
    got = {r["index_name"]: (r["statements"], r["calls"], r["total_ms"]) for r in activity.index_usage(idx, plans, calls).collect()}
    assert got == {"a": (2, 5, 35.0), "b": (0, 0, 0.0)}
