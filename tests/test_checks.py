"""Boundary values of the health checks, zero denominators, missing counters."""

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import checks


def kv_rows(spark, snaps):
    """snaps: {snapshot_id: {name: value_text}} -> long counter table."""
    rows = [("db-t", sid, "status", n, v) for sid, d in snaps.items() for n, v in d.items()]
    return spark.createDataFrame(rows, "instance_id string, snapshot_id long, scope string, name string, value string")


def run_check(spark, name, snaps, status_text=None, class_memory=None):
    out = checks.health_check(kv_rows(spark, snaps), name, status_text, class_memory)
    return {r["snapshot_id"]: (r["value"], r["status"]) for r in out.collect()}


@pytest.mark.parametrize("reads,expected", [(10, "critical"), (1, "warning"), (0, "ok")])
def test_hit_rate_bounds(spark, reads, expected):
    # requests 100: 10 reads -> exactly 90 -> warning? (<90 critical) 90 is warning; 1 read -> 99 -> ok
    got = run_check(spark, "innodb_buffer_pool_hit_rate",
                    {1: {"innodb_buffer_pool_read_requests": "100", "innodb_buffer_pool_reads": str(reads)}})
    value = (100 - reads) * 100.0 / 100
    want = "critical" if value < 90 else "warning" if value < 99 else "ok"
    assert got[1] == (value, want)


def test_hit_rate_exact_thresholds(spark):
    got = run_check(spark, "innodb_buffer_pool_hit_rate", {
        1: {"innodb_buffer_pool_read_requests": "100", "innodb_buffer_pool_reads": "10"},   # 90 -> warning
        2: {"innodb_buffer_pool_read_requests": "100", "innodb_buffer_pool_reads": "1"},    # 99 -> ok
        3: {"innodb_buffer_pool_read_requests": "100", "innodb_buffer_pool_reads": "11"},   # 89 -> critical
    })
    assert got == {1: (90.0, "warning"), 2: (99.0, "ok"), 3: (89.0, "critical")}


def test_zero_or_missing_denominator_gives_no_row(spark):
    got = run_check(spark, "innodb_buffer_pool_hit_rate", {
        1: {"innodb_buffer_pool_read_requests": "0", "innodb_buffer_pool_reads": "5"},
        2: {"innodb_buffer_pool_reads": "5"},
        3: {"innodb_buffer_pool_read_requests": "abc"},
    })
    assert got == {}


def test_missing_numerator_reads_zero(spark):
    got = run_check(spark, "thread_cache_ratio", {1: {"threads_created": "50"}})
    assert got == {1: (0.0, "warning")}


@pytest.mark.parametrize("name,num,den,value,status", [
    ("thread_cache_hit_rate", ("threads_created", "50"), ("connections", "100"), 50.0, "warning"),
    ("thread_cache_hit_rate", ("threads_created", "10"), ("connections", "100"), 90.0, "ok"),
    ("thread_cache_ratio", ("threads_cached", "10"), ("threads_created", "100"), 10.0, "ok"),
    ("temporary_tables_on_disk", ("created_tmp_disk_tables", "25"), ("created_tmp_tables", "100"), 25.0, "ok"),
    ("temporary_tables_on_disk", ("created_tmp_disk_tables", "26"), ("created_tmp_tables", "100"), 26.0, "warning"),
    ("max_connections_usage", ("threads_connected", "80"), ("max_connections", "100"), 80.0, "warning"),
    ("max_connections_usage", ("threads_connected", "70"), ("max_connections", "100"), 70.0, "ok"),
    ("max_connections_usage", ("threads_connected", "81"), ("max_connections", "100"), 81.0, "critical"),
    ("open_files_utilization", ("open_files", "85"), ("open_files_limit", "100"), 85.0, "warning"),
    ("flushing_logs", ("innodb_log_waits", "5"), ("innodb_log_writes", "100"), 5.0, "warning"),
    ("flushing_logs", ("innodb_log_waits", "20"), ("innodb_log_writes", "100"), 20.0, "warning"),
    ("flushing_logs", ("innodb_log_waits", "21"), ("innodb_log_writes", "100"), 21.0, "critical"),
    ("innodb_dirty_pages_ratio", ("innodb_buffer_pool_pages_dirty", "75"), ("innodb_buffer_pool_pages_total", "100"),
     75.0, "warning"),
])
def test_two_counter_bounds(spark, name, num, den, value, status):
    got = run_check(spark, name, {1: {num[0]: num[1], den[0]: den[1]}})
    assert got == {1: (value, status)}


def test_sort_merge_and_redo_bounds(spark):
    got = run_check(spark, "sort_merge_passes_ratio", {
        1: {"sort_merge_passes": "10", "sort_scan": "50", "sort_range": "50"},
        2: {"sort_merge_passes": "25", "sort_scan": "100"},
        3: {"sort_merge_passes": "5"}})
    assert got == {1: (10.0, "warning"), 2: (25.0, "critical")}
    # minutes = uptime/60 * capacity / written: 60 min uptime, capacity = written -> 60 -> ok
    got = run_check(spark, "innodb_redo_log", {
        1: {"uptime": "3600", "innodb_redo_log_capacity": "100", "innodb_os_log_written": "100"},
        2: {"uptime": "2700", "innodb_redo_log_capacity": "100", "innodb_os_log_written": "100"},
        3: {"uptime": "4560", "innodb_redo_log_capacity": "100", "innodb_os_log_written": "100"},
        4: {"innodb_redo_log_capacity": "100", "innodb_os_log_written": "100"},
        5: {"uptime": "100", "innodb_os_log_written": "100"}})
    assert got == {1: (60.0, "ok"), 2: (45.0, "ok"), 3: (76.0, "warning"), 4: (0.0, "warning")}


def test_history_from_status_text(spark):
    text = spark.createDataFrame(
        [("db-t", 1, "History list length 10000\n"), ("db-t", 2, "History list length 10001\n"),
         ("db-t", 3, "History list length 100001"), ("db-t", 4, "no such line")],
        "instance_id string, snapshot_id long, status_text string")
    got = run_check(spark, "history_list_length", {1: {"uptime": "1"}, 2: {"uptime": "1"}, 3: {"uptime": "1"},
                                                   4: {"uptime": "1"}}, status_text=text)
    assert got == {1: (10000.0, "ok"), 2: (10001.0, "warning"), 3: (100001.0, "critical")}


def test_pool_vs_ram_unknown_class_gives_no_row(spark):
    mem = spark.createDataFrame([("db.small", 1024)], "instance_class string, memory_mb long")
    snaps = {1: {"innodb_buffer_pool_size": str(768 * 1048576), "instance_class": "db.small"},
             2: {"innodb_buffer_pool_size": str(600 * 1048576), "instance_class": "db.small"},
             3: {"innodb_buffer_pool_size": str(800 * 1048576), "instance_class": "db.other"}}
    got = run_check(spark, "innodb_buffer_pool_size_vs_ram", snaps, class_memory=mem)
    assert got == {1: (75.0, "ok"), 2: (600 * 100 / 1024, "warning")}


def test_non_numeric_text_is_not_a_number(spark):
    from fleetspark.functions.numeric import parse_double
    df = spark.createDataFrame([(" 5 ",), ("1d",), ("Infinity",), ("5",), ("-1.5e3",), (".5",)], "v string")
    got = [r[0] for r in df.select(parse_double("v")).collect()]
    assert got == [None, None, None, 5.0, -1500.0, 0.5]


def test_health_report_order_and_total(spark):
    snaps = {1: {"innodb_buffer_pool_read_requests": "100", "connections": "10", "max_connections": "10",
                 "threads_connected": "1", "open_files_limit": "10"}}
    text = spark.createDataFrame([("db-t", 1, "History list length 5")],
                                 "instance_id string, snapshot_id long, status_text string")
    mem = spark.createDataFrame([("x", 1)], "instance_class string, memory_mb long")
    out = checks.health_report(kv_rows(spark, snaps), text, mem).orderBy("check_order").collect()
    assert [r["check_name"] for r in out] == ["innodb_buffer_pool_hit_rate", "thread_cache_hit_rate",
                                              "history_list_length", "max_connections_usage",
                                              "open_files_utilization"]
    assert {r["total_checks"] for r in out} == {5}


def test_variable_rules_missing_setting_matches_nothing(spark):
    kv = spark.createDataFrame([("db-t", 1, "variables", "max_connections", "0"),
                                ("db-t", 1, "variables", "open_files_limit", "abc")],
                               "instance_id string, snapshot_id long, scope string, name string, value string")
    rules = spark.createDataFrame([("r1", "max_connections", "=", 0, "critical"),
                                   ("r2", "open_files_limit", "<", 1000, "warning"),
                                   ("r3", "absent", ">", 0, "warning")],
                                  "rule_id string, name string, op string, bound long, severity string")
    out = checks.variable_rules(kv, rules).collect()
    assert [(r["rule_id"], r["value"]) for r in out] == [("r1", 0.0)]


def expression_kv(spark):
    rows = [("db", 1, "A", "10"), ("db", 1, "b", "4"), ("db", 1, "zero", "0"), ("db", 2, "a", "1"), ("db", 2, "b", "text")]
    return spark.createDataFrame([(i, s, "variables", n, v) for i, s, n, v in rows] + [("db", 2, "status", "b", "9")],
                                 "instance_id string, snapshot_id long, scope string, name string, value string")


@pytest.mark.parametrize("text,snapshots", [
    ("a > b", {1}), ("A - b * 2 = 2", {1}), ("a / zero > 1", set()), ("1 < a < 11", {1}), ("a >= 1", {1, 2}),
    ("not a > 5", {2}), ("a < 5 or b > 3", {1, 2}), ("b > 3 and a > 0", {1}), ("-a < -5", {1}), ("a != 10", {2}),
    ("(a + b) / 2 == 7", {1}), ("a > 1e0 and b <= 4", {1}), ("missing > 0", set()), ("missing > 0 or a = 1", {2}),
])
def test_setting_expressions(spark, text, snapshots):
    got = checks.setting_expressions(expression_kv(spark), [("r", text, "notice")]).collect()
    assert {r["snapshot_id"] for r in got} == snapshots and all(r["outcome"] == "violated" for r in got)


@pytest.mark.parametrize("text", ["", "  ", None, "a >", "a", "1 < 2", "f(a) > 1", "a.b > 1", "a ** 2 > 1", "a > 'x'", "a[0] > 1",
                                  "lambda: a", "a > b if a else b", "a in b", "__import__('os') > 1", "(" * 900, "a > 1" + " " * 1000 + "1"])
def test_malformed_expressions_are_rows(spark, text):
    got = checks.setting_expressions(expression_kv(spark), [("bad", text, "warning"), ("ok", "a = 1", "notice")]).collect()
    assert sorted((r["rule_id"], r["outcome"], r["snapshot_id"]) for r in got) == [("bad", "malformed", None), ("ok", "violated", 2)]


def test_expressions_pivot_named_settings_once(spark):
    plan = checks.setting_expressions(expression_kv(spark), [("x", "a > b", "n"), ("y", "a > 1", "n")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning") == 1 and "zero" not in text


def test_pool_vs_ram_exact_bounds(spark):
    mem = spark.createDataFrame([("c", 1000)], "instance_class string, memory_mb long")
    mib = 1048576
    snaps = {1: {"innodb_buffer_pool_size": str(600 * mib), "instance_class": "c"},     # 60 -> ok
             2: {"innodb_buffer_pool_size": str(750 * mib), "instance_class": "c"},     # 75 -> ok
             3: {"innodb_buffer_pool_size": str(751 * mib), "instance_class": "c"},     # 75.1 -> critical
             4: {"innodb_buffer_pool_size": str(599 * mib), "instance_class": "c"},     # 59.9 -> warning
             5: {"innodb_buffer_pool_size": "0", "instance_class": "c"}}                # no row
    got = run_check(spark, "innodb_buffer_pool_size_vs_ram", snaps, class_memory=mem)
    assert {k: v[1] for k, v in got.items()} == {1: "ok", 2: "ok", 3: "critical", 4: "warning"}
    assert got[1][0] == 60.0 and got[2][0] == 75.0


def test_redo_log_upper_bound_and_sort_merge_exact(spark):
    got = run_check(spark, "innodb_redo_log", {
        1: {"uptime": "4500", "innodb_redo_log_capacity": "100", "innodb_os_log_written": "100"}})   # 75 -> ok
    assert got == {1: (75.0, "ok")}
    got = run_check(spark, "sort_merge_passes_ratio", {
        1: {"sort_merge_passes": "9", "sort_scan": "100"}})                                           # 9 -> ok
    assert got == {1: (9.0, "ok")}


def test_history_above_a_million_is_critical(spark):
    text = spark.createDataFrame([("db-t", 1, "History list length 1000001")],
                                 "instance_id string, snapshot_id long, status_text string")
    got = run_check(spark, "history_list_length", {1: {"uptime": "1"}}, status_text=text)
    assert got == {1: (1000001.0, "critical")}


def test_fixture_classes_agree_with_the_class_table(spark):
    from conftest import SF_SMALL
    from fleetspark.sources.fixtures import Fixtures
    from fleetspark.sources.lookups import INSTANCE_CLASS_MEMORY_MB, class_memory_table
    assert len(INSTANCE_CLASS_MEMORY_MB) == 49
    fx = Fixtures(spark, SF_SMALL)
    for r in fx["class_memory"].collect():
        assert INSTANCE_CLASS_MEMORY_MB[r["instance_class"]] == r["memory_mb"]
    # the full table works as the lookup of the report (same rows for known classes)
    full = checks.health_check(fx.counter_kv(), "innodb_buffer_pool_size_vs_ram", None, class_memory_table(spark))
    part = checks.health_check(fx.counter_kv(), "innodb_buffer_pool_size_vs_ram", None, fx["class_memory"])
    assert full.exceptAll(part).count() == 0 and part.exceptAll(full).count() == 0


def test_checks_say_their_threshold(spark):
    snaps = {1: {"innodb_buffer_pool_read_requests": "100", "innodb_buffer_pool_reads": "10"}}
    r = checks.health_check(kv_rows(spark, snaps), "innodb_buffer_pool_hit_rate").collect()[0]
    assert r["threshold"] == "critical if < 90; warning if < 99; else ok"
    assert r["description"] == "innodb_buffer_pool_hit_rate (%): warning (critical if < 90; warning if < 99; else ok)"


def test_names_as_servers_write_them(spark):
    """Threads_connected 90 of 100 is critical, whatever the case of the names."""
    from fleetspark.operators import checks
    for names in (("Threads_connected", "max_connections"), ("threads_connected", "MAX_CONNECTIONS")):
        kv = spark.createDataFrame([("i", 1, "status", names[0], "90"), ("i", 1, "variables", names[1], "100")],
                                   "instance_id string, snapshot_id long, scope string, name string, value string")
        r = checks.health_check(kv, "max_connections_usage").first()
        assert (r["value"], r["status"], r["threshold"]) == (90.0, "critical", "critical if > 80; warning if > 70; else ok")


def test_history_length_above_a_long_is_critical(spark):
    from fleetspark.operators import checks
    text = spark.createDataFrame([("i", 1, "History list length 99999999999999999999")], "instance_id string, snapshot_id long, status_text string")
    kv = spark.createDataFrame([], "instance_id string, snapshot_id long, scope string, name string, value string")
    assert checks.health_check(kv, "history_list_length", text).first()["status"] == "critical"
