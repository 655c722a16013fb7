"""Engine status text (X5, X7), fingerprints (X6), slow-log parsing."""

from pyspark.sql import functions as F

from fleetspark.operators import textops

STATUS = "\n".join([
    "2024-02-01 10:00:00 77 INNODB MONITOR OUTPUT",
    "OS WAIT ARRAY INFO: reservation count 12",
    "RW-shared spins 3, rounds 4, OS waits 5",
    "LATEST DETECTED DEADLOCK",
    "------",
    "2024-01-31 09:08:07 55",
    "*** (1) TRANSACTION:",
    "MySQL thread id 1, query id 2 localhost app",
    "  UPDATE t SET a = 1  ",
    "*** (2) TRANSACTION:",
    "MySQL thread id 3, query id 4 localhost app",
    "   ",
    "MySQL thread id 5, query id 6 localhost app",
    "DELETE FROM u",
    "*** WE ROLL BACK TRANSACTION (2)",
    "TRANSACTIONS",
    "MySQL thread id 9, decoy outside the section",
    "SELECT decoy",
    "9.5 reads/s, 100 avg bytes/read, 1.25 writes/s, 0.5 log writes/s",
    "Buffer pool hit rate 950 / 1000",
    "3 queries inside InnoDB, 1 queries in queue",
    "1.00 inserts/s, 2.00 updates/s, 3.00 deletes/s, 4.50 reads/s",
])


def _df(spark, texts):
    return spark.createDataFrame([("db-t", i, t) for i, t in enumerate(texts)],
                                 "instance_id string, snapshot_id long, status_text string")


def test_status_fields_and_missing_sections(spark):
    rows = textops.innodb_status(_df(spark, [STATUS, "nothing here"])).orderBy("snapshot_id").collect()
    a, b = rows
    assert a["monitor_time"] == "2024-02-01 10:00:00"
    assert a["sem_reservation_count"] == 12 and a["sem_signal_count"] == 0
    assert (a["sem_rw_shared_spins"], a["sem_rw_shared_os_waits"]) == (3, 5)
    assert a["has_deadlock"] is True
    assert (a["io_reads_per_sec"], a["io_writes_per_sec"], a["io_log_writes_per_sec"]) == (9.5, 1.25, 0.5)
    assert a["bp_hit_rate_pct"] == 95.0
    assert (a["row_queries_inside"], a["row_queries_in_queue"]) == (3, 1)
    assert (a["row_inserts_per_sec"], a["row_reads_per_sec"]) == (1.0, 4.5)
    assert b["monitor_time"] == "" and b["bp_hit_rate_pct"] == 0.0 and b["has_deadlock"] is False
    assert b["trx_history_list_length"] == 0


def test_deadlock_section_only(spark):
    rows = textops.deadlocks(_df(spark, [STATUS, "no deadlock"])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["deadlock_time"] == "2024-01-31 09:08:07"
    assert r["victim"] == 2
    # blank query dropped, text trimmed, decoy after TRANSACTIONS not read
    assert r["queries"] == ["UPDATE t SET a = 1", "DELETE FROM u"]


def test_deadlock_without_victim_or_end(spark):
    t = "LATEST DETECTED DEADLOCK\nMySQL thread id 1, q\nSELECT 1\n"
    r = textops.deadlocks(_df(spark, [t])).collect()[0]
    assert (r["deadlock_time"], r["victim"], r["queries"]) == ("", 0, ["SELECT 1"])


def test_fingerprint(spark):
    from fleetspark.functions.text import fingerprint
    df = spark.createDataFrame([("SELECT * FROM t WHERE id IN (1, 2,3) AND n = 'x';",),
                                ("select  *\nfrom t where id in (4,5) and n = \"y\"",),
                                ("UPDATE t2 SET v = 1.5 WHERE k = 10;",)], "q string")
    got = [r[0] for r in df.select(fingerprint("q")).collect()]
    assert got[0] == got[1] == "select * from t where id in (?+) and n = ?"
    assert got[2] == "update t2 set v = ? where k = ?"


def test_slow_record_parse(spark):
    rec = ("# User@Host: app[app] @ h [10.0.0.1]\n# Query_time: 8.37  Lock_time: 0.01  Rows_sent: 3  "
           "Rows_examined: 44\nSET timestamp=1700000000;\nselect 1;")
    df = spark.createDataFrame([("db-t", 1, rec)], "instance_id string, rec_id long, record_text string")
    r = textops.slow_log_records(df).collect()[0]
    assert (r["query_ms"], r["lock_ms"], r["rows_sent"], r["rows_examined"]) == (8370.0, 10.0, 3, 44)
    assert r["user_host"] == "app[app] @ h [10.0.0.1]" and r["sql_text"] == "select 1;"


def test_statements_are_cut_on_bytes_and_whole_characters(spark):
    from pyspark.sql import functions as F
    from fleetspark.functions.text import cut_bytes
    texts = ["", "abc", "a" * 600, "é" * 600, "a" + "é" * 300, "日本" * 200, "🙂" * 130]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got in df.select("t", cut_bytes("t", 500).alias("c")).collect():
        assert got == t.encode()[:500].decode(errors="ignore")


def test_percentiles_are_exact(spark):
    import random
    import numpy as np
    from fleetspark.plans.percentile import exact_percentiles
    rng = random.Random(1)
    rows = [(k, rng.choice([rng.uniform(0, 1e6), rng.uniform(-5, 5), 7.25, 0.0])) for k in ("a", "b", None) for _ in range(rng.randint(1, 800))]
    rows += [("one", 3.5), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for k, r in got.items():
        vals = [v for x, v in rows if x == k and v is not None]
        for name, p in (("p50", 50), ("p95", 95), ("p0", 0), ("p100", 100)):
            assert abs(r[name] - np.percentile(vals, p)) < 1e-6 * max(1, abs(r[name]))


def test_repeated_json_keys_count_once(spark):
    from fleetspark.operators import inventory
    df = spark.createDataFrame([("x", '{"a":1,"a":2}'), ("y", '{"a": 3}'), ("z", "null"), ("w", "text")], "name string, blob string")
    got = {r["name"]: (r["values"], r["raw_value"], r["n_keys"]) for r in inventory.json_key_filter(df).collect()}
    assert got == {"x": ({"a": "2"}, None, 1), "y": ({"a": "3"}, None, 1), "z": ({}, None, 0), "w": (None, "text", 0)}
    assert [tuple(r) for r in inventory.config_key_audit(df).collect()] == [("a", 2)]


def test_numbers_after_several_spaces(spark):
    from fleetspark.operators import textops
    df = spark.createDataFrame([("i", 1, "Log sequence number          123")], "instance_id string, snapshot_id long, status_text string")
    assert textops.innodb_status(df).first()["log_sequence_number"] == 123


def test_null_instances_stay_in_digest_and_probes(spark):
    from fleetspark.operators import activity

    log = spark.createDataFrame([(None, "f", 10.0, 1, 2, "select 1"), (None, "f", 30.0, 1, 2, "select 2"), ("a", "f", 5.0, 1, 2, "select 3")],
                                "instance_id string, fingerprint string, query_ms double, rows_sent long, rows_examined long, sql_text string")
    got = {r["instance_id"]: r for r in textops.slow_query_digest(log).collect()}
    assert set(got) == {None, "a"} and got[None]["calls"] == 2 and got[None]["share"] == 1.0 and got[None]["p95_ms"] is not None
    probes = spark.createDataFrame([(None, True, 4.0), (None, True, 4.0), ("a", True, 2.0)], "instance_id string, success boolean, latency_ms double")
    got = {r["instance_id"]: r for r in activity.probe_summary(probes).collect()}
    assert got[None]["p50_ms"] == 4.0 and got[None]["p95_ms"] == 4.0 and got["a"]["p50_ms"] == 2.0


# statement -> fingerprint
STATEMENTS = [
    ("/* it's */ select a from t where b='x'", "select a from t where b=?"),
    ("select 1 -- don't\n, 2 from t", "select ? , ? from t"),
    ("select 'it\\'s', \"a\\\"b\", 'it''s' from t", "select ?, ?, ? from t"),
    ("select 0xFF, 1e5, 1.5E-3, .5, x'1F', b'01', 0b11 from t1", "select ?, ?, ?, ?, ?, ?, ? from t1"),
    ("insert into t values (1,'a'),(2,'b'),\n (3,'c');", "insert into t values (?+)"),
    ("select `a 1`, `2` from `db`.`t-1` where c=-5", "select `a 1`, `2` from `db`.`t-1` where c=-?"),
    ("select a--1 from t", "select a--? from t"),
    ("select 5--\n from t", "select ? from t"),
    ("# c\nselect 2fa, t1.c2 from t_2", "select 2fa, t1.c2 from t_2"),
    ("select 'unterminated", "select ?"),
    ("select a/b from t /* open", "select a/b from t"),
    ("select 1;", "select ?"),
    ("select * from t where id in (-1, 2, +3)", "select * from t where id in (?+)"),
    ("SELECT 'a' 'b', @v:=1, ? FROM T ; ", "select ? ?, @v:=?, ? from t"),
    ("select 'back\\", "select ?"),
    ("select \"it's\", 'say \"x\"'", "select ?, ?"),
    ("select a/**/b, c/*x*/-1", "select a b, c -?"),
    ("where name in('a','b')and x=1", "where name in(?+)and x=?"),
    ("select '-- no comment', '/* nor this */', '# nor this'", "select ?, ?, ?"),
    ("select /* 'a */ b /* ' */ from t", "select b from t"),
    ("select ''''", "select ?"),
    ("select 1.2.3.4, a.1, a.b.5, 1.2.3x, 2fa.5, (3).5, a ..5, @1", "select ?, a.1, a.b.5, ?.3x, 2fa.5, (?+)?, a .?, @1"),
    ("select `b`.5, `1`.c1, 1.2.3.4 -- x", "select `b`?, `1`.c1, ?"), ("select n'a', bin'x', N\"b\" # '", "select ?, bin?, n?"),
    ("é = 'é' and ü1 = 1", "é = ? and ü1 = ?"),
    ("select f(1), g('x', 2), h()", "select f(?+), g(?+), h()"),
    ("--", ""), ("", ""), ("  ;  ", ""), ("select 'a\nb',\n\t2", "select ?, ?"),
]


def test_fingerprint_is_a_lexer(spark):
    import duckdb
    from fleetspark import oracles
    from fleetspark.functions.text import fingerprint
    got = [r[0] for r in spark.createDataFrame([(s,) for s, _ in STATEMENTS], "q string").coalesce(1).select(fingerprint("q")).collect()]
    assert got == [f for _, f in STATEMENTS]
    con = duckdb.connect()
    assert [con.execute(f"SELECT {oracles._FP} FROM (SELECT ? AS sql_text)", [s]).fetchone()[0] for s, _ in STATEMENTS] == got


def test_fingerprint_of_long_literals(spark):
    from fleetspark.functions.text import fingerprint
    long = ["'" + "a\\'" * 50_000 + "'", "(" + ", ".join(["'x'"] * 50_000) + ")", '"' + '""' * 50_000 + '"', "/*" + "*" * 100_000 + "*/ a", "`" + "b" * 50_000]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in long], "q string").coalesce(1).select(fingerprint("q")).collect()]
    assert got[:4] == ["?", "(?+)", "?", "a"] and len(got[4]) == 50_001


def log_rows(spark, seed, n):
    import random
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(rng.choice(["a", "b", None]), rng.choice(["f", "g"]), rng.choice([None, 1.5, float(rng.randint(0, 500))]), rng.randint(0, 9), rng.choice([None, 7]), f"select {rng.randint(0, 50)}")
         for _ in range(n)], "instance_id string, fingerprint string, query_ms double, rows_sent long, rows_examined long, sql_text string")


def digest_rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def test_merged_days_are_the_digest_of_both(spark):
    a, b = log_rows(spark, 1, 400), log_rows(spark, 2, 300)
    days = textops.digest_counts(a).unionByName(textops.digest_counts(b))
    whole = digest_rows(textops.slow_query_digest(a.unionByName(b)))
    assert digest_rows(textops.digest_of_counts(textops.merge_digest_counts(days))) == whole and len(whole) == 6
    import numpy as np
    rows = [r for r in a.collect() + b.collect() if (r["instance_id"], r["fingerprint"]) == ("a", "f") and r["query_ms"] is not None]
    one = next(r for r in textops.slow_query_digest(a.unionByName(b)).collect() if (r["instance_id"], r["fingerprint"]) == ("a", "f"))
    ms = [r["query_ms"] for r in rows]
    assert one["p95_ms"] == round(float(np.percentile(ms, 95)), 3) and one["max_ms"] == max(ms) and abs(one["avg_ms"] - np.mean(ms)) < 1e-9


def test_digest_and_probes_scan_their_input_once(spark, tmp_dir):
    from fleetspark.operators import activity
    log_rows(spark, 3, 500).write.parquet(f"{tmp_dir}/log")
    spark.createDataFrame([("a", i % 3 > 0, float(i % 50)) for i in range(300)], "instance_id string, success boolean, latency_ms double").write.parquet(f"{tmp_dir}/probes")
    for df in (textops.slow_query_digest(spark.read.parquet(f"{tmp_dir}/log")), activity.probe_summary(spark.read.parquet(f"{tmp_dir}/probes"))):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_reports_are_replaced_by_partition(spark, tmp_dir):
    from fleetspark.sources.sinks import write_report
    rows = lambda *r: spark.createDataFrame(list(r), "instance_id string, v int")
    path = f"{tmp_dir}/report"
    write_report(rows(("a", 1), ("a", 2), ("b", 3)), path, mode="replace")
    write_report(rows(("b", 4), ("c", 5)), path, mode="replace")
    assert sorted((r["instance_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("a", 2), ("b", 4), ("c", 5)]
    write_report(rows(("b", 4), ("c", 5)), path, mode="replace")
    assert spark.read.parquet(path).count() == 4
