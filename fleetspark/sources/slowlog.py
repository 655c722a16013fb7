"""S2 source: slow-query log files read as one record per entry.

``spark.read.text`` with the time heading as record separator splits files in
parallel (at block boundaries), so a large log is not read by one task.  A
heading counts only at the start of a line.  What stands under a heading is
split again at lines that begin with ``# User@Host:``, as the server writes the
time once for entries of the same moment.  Start-up lines of the server are no
entries.

The server writes ``use <database>;`` only when the database changes, so an
entry's database is the last one named before it in its file, however many
splits lie between.  That is a scan in two passes: the last name of each split
(one row per split), carried over the splits of a file in order, is what a
split starts with; within a split the names are carried over its entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The lines a slow log is made of.
HEADING = "# Time: "
ENTRY = "# User@Host:"
STARTUP = r"(?m)^[^\n#]*, Version: [^\n]*started with:\n[^\n]*\nTime +Id +Command +Argument(\n|$)"


#: ``use`` among the lines before the statement.
HEADER = r"^(?:#[^\n]*\n|SET timestamp=\d+;\n|use [^\n]*;\n)++"
DATABASE = r"(?m)^use ([^\n]*);$"


def read_slow_log(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, log_time, record_text) per entry; ``log_time`` is null for
    entries before the first heading of a file."""
    return _entries(spark, path).select("file_path", "log_time", "record_text")


def read_slow_log_context(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, log_time, database, record_text): entries with the database
    they ran in, null before the first ``use`` of a file.

    Entries are shuffled once, by split, so that each split's are in order in
    one task; a split has at most ``spark.sql.files.maxPartitionBytes``.
    """
    named = _entries(spark, path).withColumn(
        "named", F.nullif(F.regexp_extract(F.regexp_extract("record_text", HEADER, 0), DATABASE, 1), F.lit("")))
    split = ["file_path", "split_start"]
    # the last name in each split (null if it has none), and so the name each split starts with
    splits = named.groupBy(*split).agg(F.max_by("named", F.when(F.col("named").isNotNull(), F.col("at"))).alias("last"))
    before = Window.partitionBy("file_path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    given = splits.select(*split, F.last("last", ignorenulls=True).over(before).alias("given"))
    within = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = named.withColumn("carried", F.last("named", ignorenulls=True).over(within))
    return carried.join(given, split).select(
        "file_path", "log_time", F.coalesce("carried", "given").alias("database"), "record_text")


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries with their split and their place in it."""
    raw = spark.read.option("lineSep", "\n" + HEADING).text(path)
    headed = F.regexp_replace("value", "^" + HEADING, "")
    # the rest of a heading's line is the time; only what stands before a file's first heading has none
    time = F.regexp_extract(headed, r"^(\d[^\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(headed, r"^\d[^\n]*(\n|$)", ""), STARTUP, "")
    entries = F.filter(F.split(body, f"(?m)^(?={ENTRY})"), lambda e: e.startswith(ENTRY))
    rows = raw.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("split_start"),
                      F.monotonically_increasing_id().alias("row"), F.nullif(F.trim(time), F.lit("")).alias("log_time"), entries.alias("entries"))
    return (rows.select("file_path", "split_start", "row", "log_time", F.posexplode("entries").alias("pos", "entry"))
            .select("file_path", "split_start", F.struct("row", "pos").alias("at"), "log_time",
                    F.regexp_replace("entry", r"\n+$", "").alias("record_text")))
