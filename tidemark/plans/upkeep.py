"""Queries that maintain tables: they write partitioned copies into the shared folder and read
them back."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs, orc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.paths import MERGE_THRESHOLD
from tidemark.operators import upkeep
from tidemark.operators.groups import partition_counts
from tidemark.operators.maintenance import PUBLISHED, STAGED, STAGING, Maintenance
from tidemark.plans.registry import query
from tidemark.session import scratch
from tidemark.sources import inventory, sinks, tables
from tidemark.sources.queue_xml import queue_usage, read_snapshots
from tidemark.sources.tables import table

FLAGS = ["l_returnflag", "l_linestatus"]
A_F = {"l_returnflag": "A", "l_linestatus": "F"}
CONTENT = "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity"
#: Rows of a written file at most; the bytes of a file inverted.
FILE_ROWS, INVERTED = 1_000_000, bytes(255 - x for x in range(256))
SPEC = "concat('l_returnflag=', l_returnflag, '/l_linestatus=', l_linestatus)"


def partitioned_folder(spark, sf):
    """Line items in one folder per flag and status."""
    path = scratch(spark, "lineitem")
    table(spark, sf, "lineitem").hint("rebalance", *FLAGS).write.partitionBy(*FLAGS).parquet(path)
    return path


def partitioned_table(spark, sf):
    name = f"lineitem_{uuid.uuid4().hex}"
    sinks.create_partitioned(spark, table(spark, sf, "lineitem"), name, FLAGS, scratch(spark, name))
    return name


def content(rows):
    return rows.groupBy(*FLAGS).agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


@query("partition_scan", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'
""")
def partition_scan(spark, sf):
    rows = spark.read.parquet(partitioned_folder(spark, sf))
    return tables.partition_scan(rows, A_F).select("l_orderkey", "l_linenumber", "l_quantity")


@query("show_partitions", f"SELECT DISTINCT {SPEC} AS partition FROM lineitem")
def show_partitions(spark, sf):
    return tables.show_partitions(spark, partitioned_table(spark, sf))


@query("file_inventory", f"SELECT {SPEC} AS partition, count(*) AS n FROM lineitem GROUP BY 1")
def file_inventory(spark, sf):
    """Rows per partition, counted per file and joined to the listed files."""
    path = partitioned_folder(spark, sf)
    files = inventory.file_inventory(spark, path)
    per_file = partition_counts(spark.read.parquet(path), [inventory.file_path("_metadata.file_path").alias("path")])
    listed = files.select("partition", F.regexp_replace("path", "^file:/+", "/").alias("path"))
    return listed.join(per_file, "path", "full").groupBy("partition").agg(F.sum("n").alias("n"))


@query("max_file_bytes", f"SELECT DISTINCT {SPEC} AS partition, true AS agrees FROM lineitem")
def max_file_bytes(spark, sf):
    """The largest listed file of each partition is the largest one the scan reports."""
    path = partitioned_folder(spark, sf)
    listed = inventory.partition_sizes(inventory.file_inventory(spark, path)).select("partition", "max_file_bytes")
    spec = F.concat(F.lit("l_returnflag="), "l_returnflag", F.lit("/l_linestatus="), "l_linestatus")
    scanned = spark.read.parquet(path).groupBy(spec.alias("partition")).agg(
        F.max("_metadata.file_size").alias("_largest")
    )
    agrees = F.col("max_file_bytes") == F.col("_largest")
    return listed.join(scanned, "partition").select("partition", agrees.alias("agrees"))


@query("create_like", """
SELECT column_name, column_name IN ('l_returnflag', 'l_linestatus') AS is_partition, 0 AS n
FROM information_schema.columns WHERE table_name = 'lineitem'
""")
def create_like(spark, sf):
    """The columns and partition columns of the new table, and its rows."""
    name = partitioned_table(spark, sf)
    sinks.create_like(spark, name, f"{name}_empty", scratch(spark, "like"))
    made = spark.table(f"{name}_empty")
    parts, rows = tables.partition_columns(spark, f"{name}_empty"), made.count()
    columns = [(c, c in parts, rows) for c in made.columns]
    return spark.createDataFrame(columns, "column_name string, is_partition boolean, n int")


@query("overwrite_partition", """
SELECT l_returnflag, l_linestatus, count(*) AS n,
  sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 2 ELSE 1 END * CAST(l_quantity AS BIGINT))::BIGINT AS quantity
FROM lineitem GROUP BY ALL
""")
def overwrite_partition(spark, sf):
    name = partitioned_table(spark, sf)
    rows = tables.partition_scan(table(spark, sf, "lineitem"), A_F)
    doubled = rows.withColumn("l_quantity", F.col("l_quantity") * 2)
    sinks.overwrite_partition(doubled, name, A_F)
    return content(spark.table(name))


@query("overwrite_dynamic", CONTENT + """
FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity <= 10) GROUP BY ALL
""")
def overwrite_dynamic(spark, sf):
    """Flag A is static, the status comes from the rows; there are rows for one status only."""
    name = partitioned_table(spark, sf)
    rows = table(spark, sf, "lineitem").filter("l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 10")
    sinks.overwrite_partition(rows, name, {"l_returnflag": "A"})
    return content(spark.table(name))


@query("partition_copy", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem
WHERE l_returnflag = 'A' AND l_linestatus = 'F'
""")
def partition_copy(spark, sf):
    name = partitioned_table(spark, sf)
    copy = f"{name}_copy"
    upkeep.copy_partition(spark, name, copy, A_F, scratch(spark, "copy"))
    return spark.table(copy).select("l_orderkey", "l_linenumber", "l_quantity", *FLAGS)


@query("compact_partition", """
SELECT l_returnflag, status, 4 AS files_before, 1 AS files_after, count(*) AS rows, 'ok' AS outcome,
  sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
FROM (SELECT l_returnflag, l_quantity, CASE WHEN l_linestatus = 'F' THEN 'F:x %' END AS status FROM lineitem)
GROUP BY 1, 2
""")
def compact_partition(spark, sf, file_rows=FILE_ROWS, threshold=MERGE_THRESHOLD):
    """Four files in each partition for one that it may keep; values that folders escape, a null, and the content once more.

    The number of files grows with the rows, none of which needs an order: they are dealt by a hash of their key. Both
    numbers of files are given as multiples, so that they don't depend on the size: `files_before` of a quarter of the
    files dealt, `files_after`, rounded up, of the files that the bytes ask for. Small partitions have 4 and 1 themselves.
    """
    name = f"lineitem_{uuid.uuid4().hex}"
    status = F.when(F.col("l_linestatus") == "F", "F:x %")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", status.alias("status"))
    levels, columns = ["l_returnflag", "status"], ["l_orderkey", "l_quantity", "l_returnflag", "status"]
    same = lambda a, b: (a["l_returnflag"] == b["l_returnflag"]) & a["status"].eqNullSafe(b["status"])
    units = F.ceil(F.count("*") / F.lit(4 * file_rows))
    # One row per partition, also in the window.
    first = F.sum("units").over(Window.orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)) * 4
    plan = upkeep.materialised(rows.groupBy(*levels).agg(units.alias("units")).withColumn("first", F.coalesce(first, F.lit(0))), "deal")
    total = 4 * (plan.agg(F.sum("units")).first()[0] or 0)
    number = F.col("first") + F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.col("units") * 4)
    dealt = rows.join(F.broadcast(plan), same(rows, plan)).select(*[rows[c] for c in columns], number.cast("int").alias("_no"))
    dealt.repartitionById(max(total, 1), "_no").drop("_no").write.format("parquet").partitionBy(*levels).option("path", scratch(spark, name)).saveAsTable(name)
    report = upkeep.compact_report(spark, name, threshold)
    after = spark.table(name).groupBy(*levels).agg(F.count("*").alias("rows"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    met = report.join(after, same(report, after)).join(plan, same(report, plan))
    before = F.when(report["files_before"] % plan["units"] == 0, report["files_before"] / plan["units"])
    return met.select(report["l_returnflag"], report["status"], before.cast("int").alias("files_before"),
                      F.ceil(report["files_after"] / report["target_files"]).cast("int").alias("files_after"), after["rows"], "outcome", "quantity")


FAULTS_SQL = """
WITH p AS (SELECT l_returnflag, l_linestatus, CAST(l_quantity AS BIGINT) AS q, l_returnflag = 'N' AND l_linestatus = 'F' AND l_quantity <= 10 AS twice FROM lineitem)
SELECT l_returnflag, l_linestatus,
  CASE WHEN l_returnflag = 'R' THEN 'rolled_back' WHEN l_returnflag = 'A' OR l_linestatus = 'F' THEN 'refused' ELSE 'done' END AS status,
  CASE WHEN l_returnflag IN ('A', 'R') THEN 'damaged' WHEN l_linestatus = 'F' THEN 'count_mismatch' ELSE 'ok' END AS detail,
  l_returnflag || l_linestatus = 'NO' AS renewed, 2 AS runs, count(*) + count(*) FILTER (WHERE twice) AS n,
  (sum(q) + coalesce(sum(q) FILTER (WHERE twice), 0))::BIGINT AS quantity
FROM p GROUP BY 1, 2
"""


@query("maintain", FAULTS_SQL)
def maintain(spark, sf):
    """Maintenance with one staged partition damaged, one that got rows after staging, one damaged after publishing, and a
    run that dies while staging; with the partitions' content and whether it comes from a new folder."""
    name = f"lineitem_{uuid.uuid4().hex}"
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", *FLAGS)
    files = max(4, -(-rows.count() // FILE_ROWS))
    rows.repartition(files).write.format("parquet").partitionBy(*FLAGS).option("path", scratch(spark, name)).saveAsTable(name)
    log, runs = scratch(spark, "log"), []

    def on_step(status):
        if status == STAGING and len(runs) == 1:
            raise InterruptedError("the run dies")
        if status == STAGED:
            invert_files(spark, chain.states(STAGED).filter("partition LIKE '%\"A\"%'"))
            again = spark.table(name).filter("l_returnflag = 'N' AND l_linestatus = 'F' AND l_quantity <= 10")
            again.write.insertInto(name)
        if status == PUBLISHED:
            invert_files(spark, chain.states(PUBLISHED).filter("partition LIKE '%\"R\"%'"))

    chain = Maintenance(spark, name, log, on_step=on_step)
    while len(runs) < 2:
        runs.append(name)
        try:
            report = chain.run()
        except InterruptedError:
            pass
    # By file first: the greatest string of a group is found by sorting its rows, and paths are cut once for each file.
    per_file = spark.table(name).groupBy(*FLAGS, F.col("_metadata.file_path").alias("_file")).agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    place = F.regexp_replace(inventory.file_path("_file"), "/[^/]*$", "")
    live = per_file.groupBy(*FLAGS).agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"), F.max(place).alias("_place"))
    return live.join(report, FLAGS).select(
        *FLAGS, "status", "detail", (F.col("_place") == F.col("path")).alias("renewed"), F.lit(len(runs)).alias("runs"), "n", "quantity")


def invert_files(spark, entries):
    """Inverts the middle third of every file in the folders (`path`) of log entries; tasks do it, files are of bounded length."""
    folders = [r["path"] for r in entries.select("path").distinct().collect()]
    listed = inventory.file_inventory(spark, folders).filter(F.col("path").endswith(".parquet")).select("path")

    def invert(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "/", name))
                with system.open_input_stream(place) as source:
                    data = source.read()
                first, last = len(data) // 3, len(data) // 3 * 2
                with system.open_output_stream(place) as out:
                    out.write(data[:first] + data[first:last].translate(INVERTED) + data[last:])
            yield b

    listed.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(invert, listed.schema).write.format("noop").mode("overwrite").save()


@query("publish_verified", CONTENT + ", 'ok,count_mismatch' AS outcomes FROM lineitem GROUP BY ALL")
def publish_verified(spark, sf):
    """A whole copy of one partition is published, an incomplete copy of another is not."""
    name = partitioned_table(spark, sf)
    outcomes = []
    for flag, least in (("A", 0), ("R", 2)):
        spec = {"l_returnflag": flag, "l_linestatus": "F"}
        staged = upkeep.version_folder(spark, name)
        rows = tables.partition_scan(spark.table(name), spec)
        rows.filter(F.col("l_quantity") >= least).write.parquet(staged)
        outcomes.append(upkeep.publish_verified(spark, name, spec, staged)[0])
    return content(spark.table(name)).withColumn("outcomes", F.lit(",".join(outcomes)))


@query("file_audit", """
SELECT o_orderpriority, count(*) AS n, true AS readable FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'damaged', NULL, false
""")
def file_audit(spark, sf):
    """Folders with a blank and a percent sign in their names are read whole; a file damaged in its middle is found."""
    path = scratch(spark, "orc")
    orders = table(spark, sf, "orders")
    orders.hint("rebalance", "o_orderpriority").write.partitionBy("o_orderpriority").orc(path)
    spoilt(spark, orders, f"{path}/o_orderpriority=damaged")
    audit = inventory.file_audit(spark, path)
    priority = F.url_decode(F.regexp_extract("path", "o_orderpriority=([^/]*)", 1))
    return audit.groupBy(priority.alias("o_orderpriority")).agg(
        F.sum("rows").alias("n"), F.min("readable").alias("readable")
    )


def spoilt(spark, rows, folder):
    """Writes rows as ORC files of bounded length, each with a stretch of its middle overwritten.

    Tasks write the rows and tasks copy the files, a block at a time: the driver plans the files and holds nothing of the rows.
    ORC has no checksums, so the rows are compressed in small chunks: a stretch holds the head of a chunk at least.
    """
    whole = scratch(spark, "whole")
    chunks = {"maxRecordsPerFile": FILE_ROWS, "orc.compress.size": 1024, "orc.create.index": "false"}
    rows.write.options(**chunks).orc(whole)
    files = inventory.file_inventory(spark, whole).filter(F.col("path").endswith(".orc")).select("path")
    dealt = files.repartition(spark.sparkContext.defaultParallelism * 4, "path")

    def spoil(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                spoil_file(name, folder)
            yield b

    dealt.mapInArrow(spoil, dealt.schema).write.format("noop").mode("overwrite").save()


def spoil_file(name, folder, block=1 << 20):
    """Copies an ORC file into a folder, the middle third of its stripes inverted. A file without rows has none and is left out."""
    system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "/", name))
    with system.open_input_file(place) as source:
        whole = orc.ORCFile(source)
        if not whole.nrows:
            return
        content = whole.content_length
    target = f"{fs.FileSystem.from_uri(re.sub('^file:/+', '/', folder))[1]}/{place.rsplit('/', 1)[1]}"
    system.create_dir(target.rsplit("/", 1)[0], recursive=True)
    first, last, at = content // 3, content // 3 * 2, 0
    with system.open_input_stream(place) as source, system.open_output_stream(target) as out:
        while data := source.read(block):
            low, high = max(first - at, 0), max(min(last - at, len(data)), 0)
            if low < high:
                data = data[:low] + data[low:high].translate(INVERTED) + data[high:]
            out.write(data)
            at += len(data)


@query("xml_queue_usage", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS time,
  sum(CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END)::BIGINT AS pending_memory,
  count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS pending_vcores,
  sum(CASE WHEN o_orderstatus = 'O' THEN o_custkey END)::BIGINT AS used_memory,
  max(CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS used_vcores,
  count(*) AS pending_containers, count(DISTINCT o_custkey) AS pending_applications
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
HAVING count(CASE WHEN o_orderstatus = 'O' THEN 1 END) > 0
UNION ALL
SELECT strftime(o_orderdate, '%Y-%m-%d'), NULL, NULL, NULL, NULL, count(*), count(DISTINCT o_custkey)
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
HAVING count(CASE WHEN o_orderstatus = 'O' THEN 1 END) = 0
""")
def xml_queue_usage(spark, sf):
    """A snapshot per order day: a queue per priority, its usage per order state."""
    path = scratch(spark, "queues")
    snapshots(table(spark, sf, "orders")).write.format("xml").options(rowTag="scheduler", rootTag="snapshots").save(path)
    return queue_usage(read_snapshots(spark, path), "orders.1-URGENT", "O")


def snapshots(orders):
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("time")
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("")
    keys = ["time", "o_orderpriority"]
    priced = orders.select(day, "o_orderpriority", state.alias("state"), "o_custkey", F.floor("o_totalprice").alias("price"))
    pending = F.struct(F.sum("price").alias("memory"), F.count("*").alias("vCores"))
    used = F.struct(F.sum("o_custkey").alias("memory"), F.max("o_custkey").alias("vCores"))
    usage = priced.groupBy(*keys, "state").agg(
        F.struct(F.col("state").alias("partitionName"), pending.alias("pending"), used.alias("used")).alias("usage")
    )
    # Bounded lists: three states to a queue, five priorities to a day.
    usage = usage.groupBy(*keys).agg(F.struct(F.collect_list("usage").alias("usage")).alias("resources"))
    totals = priced.groupBy(*keys).agg(
        F.count("*").alias("pendingContainers"), F.countDistinct("o_custkey").alias("numPendingApplications")
    )
    queue = F.struct(
        F.col("o_orderpriority").alias("queueName"), "resources", "pendingContainers", "numPendingApplications"
    )
    days = usage.join(totals, keys).groupBy("time").agg(F.collect_list(queue).alias("queue"))
    return days.select("time", F.array(F.struct(F.lit("orders").alias("queueName"), "queue")).alias("queue"))
