"""Bucketed counters (S1, H13) and input that is delivered again."""

import datetime as dt
import os
import uuid

from conftest import SF_SMALL

from fleetspark.operators import checks
from fleetspark.registry import QUERIES
from fleetspark.sources.bucketed import read_bucketed, write_bucketed
from fleetspark.sources.fixtures import Fixtures
from fleetspark.streaming.alerts import health_alerts_stream
from fleetspark.streaming.metrics import metric_rollup_stream
from fleetspark.streaming.runner import run_available_now


def test_checks_on_bucketed_counters_need_no_exchange(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    rows = checks.counter_rows(fx.counter_kv(), fx["innodb_status_text"], fx["class_memory"])
    table = write_bucketed(rows, "t_" + uuid.uuid4().hex, 8, path=os.path.join(tmp_dir, "counters"))
    report = checks.health_report_of_rows(read_bucketed(spark, table))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    want = QUERIES["health_report"](spark, SF_SMALL)
    assert report.count() == want.count() > 0 and report.exceptAll(want).count() == 0
    files = [f for f in os.listdir(os.path.join(tmp_dir, "counters")) if f.endswith(".parquet")]
    assert len(files) <= 8
    spark.sql(f"DROP TABLE {table}")


def test_points_delivered_twice_count_once(spark, tmp_dir):
    schema = "instance_id string, metric string, ts timestamp_ntz, value long"
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [("a", "cpu", at(0, 1), 10), ("a", "cpu", at(0, 2), 20), ("b", "cpu", at(0, 1), 5), ("a", "cpu", at(0, 9), 7)]
    src = os.path.join(tmp_dir, "src")
    stream = lambda: metric_rollup_stream(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src),
                                          once_by=["instance_id", "metric", "ts"])
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    for k, batch in enumerate([rows, rows, [("a", "cpu", at(5, 0), 1)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(os.path.join(src, f"b{k}"))
        run_available_now(stream(), sink, ck)
    got = {(r["instance_id"], r["period_start"].strftime("%H:%M"), r["avg_value"], r["n_points"]) for r in spark.read.parquet(sink).collect()}
    assert got == {("a", "00:00", 15.0, 2), ("b", "00:00", 5.0, 1), ("a", "00:05", 7.0, 1)}


def test_snapshots_delivered_twice_alert_once(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    some = fx["counter_snapshots"].limit(50)
    some.write.parquet(os.path.join(tmp_dir, "src", "b0"))
    spark.read.parquet(os.path.join(tmp_dir, "src", "b0")).write.parquet(os.path.join(tmp_dir, "src", "b1"))
    read = lambda: spark.readStream.schema(fx["counter_snapshots"].schema).option("recursiveFileLookup", "true").parquet(os.path.join(tmp_dir, "src"))
    counts = {}
    for name, within in (("once", "3650 days"), ("all", None)):
        sink = os.path.join(tmp_dir, name)
        run_available_now(health_alerts_stream(read(), fx["class_memory"], once_within=within), sink, sink + "-ck")
        got = spark.read.parquet(sink)
        counts[name] = got.count()
        distinct = got.dropDuplicates().count()
    assert counts["all"] == 2 * counts["once"] == 2 * distinct > 0
