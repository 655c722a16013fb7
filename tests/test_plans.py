"""Physical-plan properties that matter at scale."""

from fleetspark.registry import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookback_filter_and_pruning_reach_the_scan(spark):
    p = _plan(QUERIES["event_lookback"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


def test_class_lookup_is_left_to_spark_and_takes_repeated_classes(spark):
    from fleetspark.operators import checks
    from fleetspark.sources.fixtures import Fixtures
    fx = Fixtures(spark, SF_SMALL)
    mem = fx["class_memory"]
    once = checks.health_check(fx.counter_kv(), "innodb_buffer_pool_size_vs_ram", None, mem)
    twice = checks.health_check(fx.counter_kv(), "innodb_buffer_pool_size_vs_ram", None, mem.unionByName(mem))
    assert once.count() > 0 and once.exceptAll(twice).count() == 0 == twice.exceptAll(once).count()


def test_scans_are_not_dealt_round_robin(spark):
    for key, fn in QUERIES.items():
        if not key.endswith(("_stream", "_files")):
            assert "RoundRobinPartitioning" not in _plan(fn(spark, SF_SMALL)), key


def test_building_a_batch_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for key, fn in QUERIES.items():
        if key.endswith(("_stream", "_files", "_context", "_stored", "_periods")):        # these run their stream or write their files
            continue
        spark.sparkContext.setJobGroup(f"build-{key}", key)
        fn(spark, SF_SMALL)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build-{key}")]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # reading a parquet schema is the reader's own one-task job
        assert all(j is None or len(j.stageIds) == 1 and tracker.getStageInfo(j.stageIds[0]) is None
                   or "parquet" in (tracker.getStageInfo(j.stageIds[0]).name if tracker.getStageInfo(j.stageIds[0]) else "parquet")
                   for j in jobs), key


def test_no_report_is_sorted_unless_asked(spark):
    for key, fn in QUERIES.items():
        if not key.endswith(("_stream", "_files")):
            assert "rangepartitioning" not in _plan(fn(spark, SF_SMALL)), key
    from fleetspark.operators import catalog
    from fleetspark.sources.fixtures import Fixtures
    assert "rangepartitioning" in _plan(catalog.column_catalog(Fixtures(spark, SF_SMALL)["cat_columns"], sort=True))


def test_health_report_counts_without_a_window(spark):
    assert "Window" not in _plan(QUERIES["health_report"](spark, SF_SMALL))


def test_health_report_single_pivot_shuffle(spark):
    df = QUERIES["health_report"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    # the pivot aggregate is the only wide exchange (the other is the lookup's, one row per class)
    assert p.count("Exchange hashpartitioning(instance_id") == 1


def test_no_python_udf_in_any_plan(spark):
    for key, fn in QUERIES.items():
        if key.endswith("_stream"):
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_totals_do_not_sort_before_aggregating(spark):
    for key in ("size_totals", "database_size_totals", "pg_table_size_totals", "pg_database_size_totals"):
        p = _plan(QUERIES[key](spark, SF_SMALL))
        assert "rangepartitioning" not in p, key


def test_top_k_is_limited_before_the_shuffle(spark):
    for key in ("top_sql_by_load", "top_waits_by_load"):
        p = _plan(QUERIES[key](spark, SF_SMALL))
        assert "WindowGroupLimit" in p and "Partial" in p, key


def test_patterns_match_names_in_any_case(spark):
    from fleetspark.operators import counters
    kv = spark.createDataFrame([("i", 1, "status", n, "1") for n in ("Innodb_buffer_pool_reads", "innodb_buffer_pool_size")],
                               "instance_id string, snapshot_id long, scope string, name string, value string")
    for pattern in ("innodb_buffer_pool%", "INNODB%", "%buffer_pool%"):
        got = counters.kv_like(kv, pattern).collect()
        assert {r["name"] for r in got} == {"Innodb_buffer_pool_reads", "innodb_buffer_pool_size"}, pattern


def test_lookback_prunes_date_partitions(spark, tmp_dir):
    import datetime as dt
    import os
    from pyspark.sql import functions as F
    from fleetspark.operators import timeseries as ts
    from fleetspark.sources.fixtures import Fixtures
    path = os.path.join(tmp_dir, "events_by_day")
    ev = Fixtures(spark, SF_SMALL)["instance_events"]
    ev.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    as_of = dt.datetime(2024, 1, 31)
    pruned = ts.event_lookback(stored, as_of, 1440, date_col="event_date")
    p = _plan(pruned)
    assert "PartitionFilters: [isnotnull(event_date" in p and "event_date#" in p.split("PartitionFilters: [")[1]
    plain = ts.event_lookback(ev, as_of, 1440)
    assert pruned.count() == plain.count() > 0
    assert pruned.exceptAll(plain.select(*pruned.columns)).count() == 0
