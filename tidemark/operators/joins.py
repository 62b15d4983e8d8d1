"""Joins: event-time bands, count reconciliation, lookups."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.scalars import MICROSECOND, micros


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    before: timedelta,
    after: timedelta,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal `key` and left_time - before <= right_time <= left_time + after.

    Both ends count. The two inputs share only the column `key`. `how` is `inner`, `left`
    (also left rows without partner) or `left_anti` (only those).

    Joining on the key alone would compare every left with every right row of a key. Time is
    cut into slots as long as the band, so a row meets the rows of at most two slots. The right
    rows are copied into the slots they can reach, each left row stays in its one slot, so
    pairs are found once and outer rows are told once. What skew remains inside a slot is
    real output; adaptive execution splits it. `left_anti` forms no pairs: see `_without_partner`.
    """
    lower, upper = before // MICROSECOND, after // MICROSECOND
    width = max(1, lower + upper)
    if how == "left_anti":
        return _without_partner(left, right, key, left_time, right_time, lower, upper, width)
    here = left.withColumn("_lus", micros(left_time)).withColumn("_slot", time_slot(F.col("_lus"), width))
    reach = right.withColumn("_rus", micros(right_time)).withColumnRenamed(key, "_rkey")
    slots = F.sequence(time_slot(F.col("_rus") - upper, width), time_slot(F.col("_rus") + lower, width))
    reach = reach.withColumn("_rslot", F.explode(slots))
    band = F.col("_rus").between(F.col("_lus") - lower, F.col("_lus") + upper)
    on = (F.col(key) == F.col("_rkey")) & (F.col("_slot") == F.col("_rslot")) & band
    return here.join(reach, on, how).drop("_lus", "_slot", "_rkey", "_rus", "_rslot")


def _without_partner(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, lower: int, upper: int, width: int
) -> DataFrame:
    """The left rows that no right row lies in reach of, by one scan of both sides in order of time.

    Of the right rows not behind a left row's reach the last one decides: if it lies before the reach, none lies in it. Both
    sides are merged by key and slot, and right rows of one time count once, so the work is that of a sort however many
    pairs there would be.
    """
    place = StructType([StructField("_k", right.schema[key].dataType), StructField("_slot", LongType()), StructField("_at", LongType()),
                        StructField("_rus", LongType()), StructField("_row", left.select(F.struct(*left.columns).alias("r")).schema["r"].dataType)])
    known = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    us = micros(left_time)
    here = left.filter(known).select(
        F.col(key), time_slot(us, width), us + upper, F.lit(None).cast("long"), F.struct(*left.columns)).toDF(*place.names)
    there = right.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), micros(right_time).alias("_rus")).filter("_rus IS NOT NULL")
    slots = F.sequence(time_slot(F.col("_rus") - upper, width), time_slot(F.col("_rus") + lower, width))
    reach = there.select("_k", F.explode(slots).alias("_slot"), "_rus").distinct()
    reach = reach.select("_k", "_slot", F.col("_rus").alias("_at"), "_rus", F.lit(None).cast(place["_row"].dataType).alias("_row"))
    # At one time right rows come first: the ends of the band count.
    so_far = Window.partitionBy("_k", "_slot").orderBy("_at", F.col("_rus").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = here.unionByName(reach).withColumn("_last", F.last("_rus", ignorenulls=True).over(so_far))
    alone = both.filter(F.col("_row").isNotNull() & (F.col("_last").isNull() | (F.col("_last") < F.col("_at") - (lower + upper))))
    return alone.select("_row.*").unionByName(left.filter(~known))


def time_slot(us: Column, width: int) -> Column:
    # Whole-number floor: a double would lose microseconds.
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("long")


def count_reconcile(source: DataFrame, target: DataFrame, partition) -> DataFrame:
    """(partition, source_rows, target_rows, status) with `ok`, `count_mismatch`,
    `missing_target` or `missing_source` for every partition of either side."""
    partition = [partition] if isinstance(partition, str) else list(partition)
    counted = source.groupBy(*partition).agg(F.count("*").alias("source_rows"))
    other = target.groupBy(*partition).agg(F.count("*").alias("target_rows"))
    other = other.select(*[F.col(p).alias(f"_{p}") for p in partition], "target_rows")
    on = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in partition]
    joined = counted.join(other, on, "full_outer")
    status = (
        F.when(F.col("source_rows").isNull(), "missing_source")
        .when(F.col("target_rows").isNull(), "missing_target")
        .when(F.col("source_rows") == F.col("target_rows"), "ok")
        .otherwise("count_mismatch")
    )
    names = [F.coalesce(p, f"_{p}").alias(p) for p in partition]
    return joined.select(*names, "source_rows", "target_rows", status.alias("status"))


def latest_per_key(
    log: DataFrame, keys, sequence, values, is_delete: Column | None = None
) -> DataFrame:
    """The last written values of each key; keys whose last write is a delete are gone.

    `max_by` combines before the shuffle, so a key written very often costs one row per task.
    """
    payload = F.struct(*values, (is_delete if is_delete is not None else F.lit(False)).alias("_gone"))
    last = log.groupBy(*keys).agg(F.max_by(payload, F.struct(*sequence)).alias("_last"))
    kept = last.filter(~F.coalesce(F.col("_last._gone"), F.lit(False)))
    return kept.select(*keys, *[F.col("_last")[v].alias(v) for v in values])


def lookup(probe: DataFrame, table: DataFrame, probe_key: str, table_key: str, values) -> DataFrame:
    """Every probe row with the table's values, or nulls where the key is unknown.

    The table has one row per key. Whether it is broadcast is left to its measured size
    (`spark.sql.autoBroadcastJoinThreshold`, rechecked at run time), and a probe key that
    fills a whole partition is split by adaptive execution.
    """
    side = table.select(F.col(table_key).alias("_key"), *values)
    return probe.join(side, F.col(probe_key) == F.col("_key"), "left").drop("_key")
