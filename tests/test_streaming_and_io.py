"""Streams (T1, T2), the report sink (S4) and the slow-log text source."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetspark.operators import checks, textops, timeseries as ts
from fleetspark.sources.fixtures import Fixtures
from fleetspark.sources.sinks import write_report
from fleetspark.sources.slowlog import read_slow_log
from fleetspark.streaming.alerts import health_alerts_stream
from fleetspark.streaming.metrics import metric_rollup_stream
from fleetspark.streaming.runner import run_available_now


def _stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_rollup_stream_equals_batch_for_closed_periods(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    pts = fx["metric_points"]
    # a sentinel point far ahead moves the watermark past every real period
    sentinel = spark.createDataFrame([("zz", "cpu", None, 0)], "instance_id string, metric string, ts string, value long") \
        .select("instance_id", "metric", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
                F.col("value").cast(pts.schema["value"].dataType))
    src = _stream(spark, pts.unionByName(sentinel), os.path.join(tmp_dir, "src"))
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    run_available_now(metric_rollup_stream(src), sink, ck)
    got = spark.read.parquet(sink).where(F.col("instance_id") != "zz") \
        .select("instance_id", "metric", F.date_format("period_start", ts.RFC3339).alias("p"), "avg_value", "n_points")
    want = ts.metric_rollup(pts).select("instance_id", "metric", F.date_format("period_start", ts.RFC3339).alias("p"),
                                        "avg_value", "n_points")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_alert_stream_equals_filtered_batch_report(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    src = _stream(spark, fx["counter_snapshots"], os.path.join(tmp_dir, "src"))
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    run_available_now(health_alerts_stream(src, fx["class_memory"]), sink, ck)
    got = spark.read.parquet(sink).select("instance_id", "snapshot_id", "check_name", "value", "status")
    batch = checks.health_report(fx.counter_kv(), fx["innodb_status_text"], fx["class_memory"]) \
        .where(F.col("status") != "ok").select("instance_id", "snapshot_id", "check_name", "value", "status")
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_report_sink_round_trip(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    df = ts.latest_metrics(fx["metric_points"], fx["instances"], "2024-01-31 00:00:00", "3 days", "1 hour")
    path = write_report(df, os.path.join(tmp_dir, "report"))
    back = spark.read.parquet(path).select(*df.columns)
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0
    assert any(n.startswith("instance_id=") for n in os.listdir(path))


def test_slow_log_text_source(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    recs = fx["slow_log"].where(F.col("instance_id") == "db-1")
    text = recs.select(F.concat(F.lit("# Time: 2024-01-01T00:00:00Z\n"), F.col("record_text")).alias("value"))
    path = os.path.join(tmp_dir, "slow.log")
    text.coalesce(1).write.text(path)
    back = read_slow_log(spark, path)
    assert back.count() == recs.count()
    assert back.where(F.col("log_time") != "2024-01-01T00:00:00Z").count() == 0
    parsed = textops.slow_log_records(back.withColumn("instance_id", F.lit("db-1")).withColumn("rec_id", F.lit(0)))
    want = textops.slow_log_records(recs.withColumn("rec_id", F.lit(0)))
    cols = ["query_ms", "rows_sent", "rows_examined", "user_host", "sql_text"]
    assert parsed.select(cols).exceptAll(want.select(cols)).count() == 0


def test_rollup_stream_drops_points_behind_the_watermark(spark, tmp_dir):
    """Two micro-batches: the second carries a point for a period that closed
    behind the watermark (10 min); it must not change the emitted average."""
    import datetime as dt
    schema = "instance_id string, metric string, ts timestamp_ntz, value long"
    b1 = [("db-1", "cpu", dt.datetime(2024, 1, 1, 0, 1), 10), ("db-1", "cpu", dt.datetime(2024, 1, 1, 0, 30), 20)]
    b2 = [("db-1", "cpu", dt.datetime(2024, 1, 1, 0, 2), 1000),      # late: period 00:00 closed at 00:30 - 10 min
          ("db-1", "cpu", dt.datetime(2024, 1, 1, 1, 0), 30)]         # moves the watermark past 00:30
    src = os.path.join(tmp_dir, "src")
    spark.createDataFrame(b1, schema).coalesce(1).write.parquet(os.path.join(src, "b1"))
    sink, ck = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ck")
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    run_available_now(metric_rollup_stream(stream()), sink, ck)
    spark.createDataFrame(b2, schema).coalesce(1).write.parquet(os.path.join(src, "b2"))
    run_available_now(metric_rollup_stream(stream()), sink, ck)
    got = {(r["period_start"].strftime("%H:%M"), r["avg_value"], r["n_points"])
           for r in spark.read.parquet(sink).collect()}
    assert ("00:00", 10.0, 1) in got
    assert ("00:30", 20.0, 1) in got
    assert all(p != "01:00" for p, _, _ in got)      # still open


def _folder_copy(spark, tmp_dir, names):
    """Tables as folders of several files, as large tables are."""
    out = os.path.join(tmp_dir, "folders")
    for n in names:
        spark.read.parquet(f"{SF_SMALL}/{n}.parquet").repartition(3).write.parquet(f"{out}/{n}.parquet")
    return out


def test_streams_read_folders_and_remote_style_paths(spark, tmp_dir):
    from fleetspark.registry import QUERIES
    folder = _folder_copy(spark, tmp_dir, ["events", "orders"])
    for key in ("metric_rollup_stream", "health_alerts_stream"):
        want = QUERIES[key](spark, SF_SMALL)
        for path in (folder, f"file://{folder}", f"file://{SF_SMALL}"):
            got = QUERIES[key](spark, path)
            assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0, (key, path)


def test_rollup_stream_with_open_periods_equals_batch(spark):
    from fleetspark.registry import QUERIES
    a, b = QUERIES["metric_rollup_stream"](spark, SF_SMALL), QUERIES["metric_rollup"](spark, SF_SMALL)
    assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def test_report_files_do_not_multiply(spark, tmp_dir):
    df = spark.range(5000).select((F.col("id") % 50).alias("instance_id"), "id").repartition(16)
    path = write_report(df, os.path.join(tmp_dir, "many"))
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs) < 200
    import pytest
    with pytest.raises(Exception, match="(?i)exist"):
        write_report(df, path)


def test_slow_log_entries(spark, tmp_dir):
    """A start-up text, two entries under one heading, a heading's text inside a statement."""
    start = "/usr/sbin/mysqld, Version: 8.0.36 (MySQL). started with:\nTcp port: 3306  Unix socket: /s\nTime                 Id Command    Argument\n"
    entry = lambda u, sql: f"# User@Host: {u}[{u}] @ h [1.1.1.1]\n# Query_time: 1.00  Lock_time: 0.00 Rows_sent: 1  Rows_examined: 2\n{sql}\n"
    text = (start + "# Time: 2024-01-01T00:00:00Z\n" + entry("a", "select 1;") + entry("b", "select '# Time: x';")
            + "# Time: 2024-01-01T00:00:09Z\n" + entry("c", "select 3\nfrom t;") + start + "# Time: 2024-01-02T00:00:00Z\n" + entry("d", "select 4;"))
    path = os.path.join(tmp_dir, "server.log")
    with open(path, "w") as f:
        f.write(text)
    got = {(r["log_time"], r["record_text"].split("[")[0][-1], r["record_text"].split("\n", 2)[2]) for r in read_slow_log(spark, path).collect()}
    assert got == {("2024-01-01T00:00:00Z", "a", "select 1;"), ("2024-01-01T00:00:00Z", "b", "select '# Time: x';"),
                   ("2024-01-01T00:00:09Z", "c", "select 3\nfrom t;"), ("2024-01-02T00:00:00Z", "d", "select 4;")}


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    import pytest
    from fleetspark import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):  # noqa: E301
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
