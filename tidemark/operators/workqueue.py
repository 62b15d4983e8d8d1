"""A work queue kept as a table: pending records and an append-only status log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import latest_per_key

PENDING = "pending"


def pending(queue: DataFrame, status: str, wanted, *conditions: Column) -> DataFrame:
    """Records in a status that also meet the conditions. Unknown values are real nulls."""
    rows = queue.filter(F.col(status) == wanted)
    for condition in conditions:
        rows = rows.filter(condition)
    return rows


def largest_first(queue: DataFrame, size: str, row_id: str, limit: int = 1) -> DataFrame:
    """The `limit` largest records, ties by id."""
    return queue.orderBy(F.desc(size), F.asc(row_id)).limit(limit)


def next_record(queue: DataFrame, row_id: str) -> DataFrame:
    return queue.orderBy(row_id).limit(1)


def current_status(log: DataFrame, row_id: str, sequence: str, status: str) -> DataFrame:
    """The last status of each record of the log."""
    return latest_per_key(log, [row_id], [sequence], [status])


def claim(
    records: DataFrame, log: DataFrame, row_id: str, sequence: str, status: str, size: str, limit: int,
    waiting, claimed,
) -> DataFrame:
    """The log rows that claim the largest waiting records: (id, sequence, status).

    A record without a log entry waits. One job owns the queue; appending the returned rows
    to the log makes the claim.
    """
    state = latest_per_key(log, [row_id], [sequence], [status, sequence]).withColumnRenamed(sequence, "_last")
    open_records = records.join(state, row_id, "left").withColumn(
        status, F.coalesce(F.col(status), F.lit(waiting))
    )
    picked = largest_first(open_records.filter(F.col(status) == waiting), size, row_id, limit)
    after = (F.coalesce(F.col("_last"), F.lit(0)) + 1).cast("long")
    return picked.select(row_id, after.alias(sequence), F.lit(claimed).alias(status))


def status_summary(current: DataFrame, status: str) -> DataFrame:
    return current.groupBy(status).agg(F.count("*").alias("n"))
