"""Queue usage from scheduler snapshots in XML: nested `queue` elements, usage per node label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT = T.StructType([T.StructField("memory", T.LongType()), T.StructField("vCores", T.LongType())])
USAGE = T.StructType([
    T.StructField("partitionName", T.StringType()),
    T.StructField("pending", AMOUNT),
    T.StructField("used", AMOUNT),
])


def queue_type(depth: int) -> T.StructType:
    """A queue with `depth` levels of queues below it."""
    fields = [
        T.StructField("queueName", T.StringType()),
        T.StructField("resources", T.StructType([T.StructField("usage", T.ArrayType(USAGE))])),
        T.StructField("pendingContainers", T.LongType()),
        T.StructField("numPendingApplications", T.LongType()),
    ]
    if depth:
        fields.append(T.StructField("queue", T.ArrayType(queue_type(depth - 1))))
    return T.StructType(fields)


def read_snapshots(spark: SparkSession, path: str, depth: int = 1, row_tag: str = "scheduler") -> DataFrame:
    """One row per snapshot element: its `time` text and its top queues."""
    schema = T.StructType([
        T.StructField("time", T.StringType()),
        T.StructField("queue", T.ArrayType(queue_type(depth))),
    ])
    return spark.read.format("xml").options(rowTag=row_tag, mode="FAILFAST").schema(schema).load(path)


def _named(queues, name: str):
    return F.get(F.filter(queues, lambda q: q["queueName"] == name), 0)


def queue_usage(snapshots: DataFrame, queue_name: str, label: str = "") -> DataFrame:
    """Usage of the queue with a dotted name on the nodes with a label, one row per snapshot.

    The empty label is the unnamed partition. A queue without that label has null amounts.
    """
    queues = F.col("queue")
    *outer, last = queue_name.split(".")
    for part in outer:
        queues = _named(queues, part)["queue"]
    found = _named(queues, last)
    rows = snapshots.withColumn("_queue", found).filter(F.col("_queue").isNotNull())
    usage = F.filter("_queue.resources.usage", lambda u: F.coalesce(u["partitionName"], F.lit("")) == label)
    rows = rows.withColumn("_usage", F.get(usage, 0))
    return rows.select(
        "time",
        F.col("_usage.pending.memory").alias("pending_memory"),
        F.col("_usage.pending.vCores").alias("pending_vcores"),
        F.col("_usage.used.memory").alias("used_memory"),
        F.col("_usage.used.vCores").alias("used_vcores"),
        F.col("_queue.pendingContainers").alias("pending_containers"),
        F.col("_queue.numPendingApplications").alias("pending_applications"),
    )
