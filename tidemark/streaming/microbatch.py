"""Streams run through the batch operators, one micro-batch at a time.

Per-key operators need the rows of a key in time order and, between micro-batches, very little:
the event a key still waits with, the start of its open period, its totals. So each micro-batch
is an ordinary batch job on

    what was carried over  +  the rows that became final by this batch's watermark

and writes its results and what to carry on. The operators split keys that are too large for one
task just as they do in batch, and nothing is done row by row in Python but the period walk.

Everything lives in one folder, a subfolder per batch id: `out` (results), `open` (rows newer than
the watermark), `untimed` (rows without a time, as they came), `late` (rows behind the watermark of an earlier batch, as they
came), `carried`, `clock` (the watermark). Where every key ever seen is carried (running totals), `carried` is a table in hash
buckets: a batch reads and rewrites only the buckets of its own keys, and `clock` says in which batch each was written last. A batch reads only what the batch before it
wrote and overwrites its own folders, so a repeated batch gives the same files and a stream
resumed from its checkpoint goes on as if it had never stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import MICROSECOND, micros
from tidemark.operators.matching import one_to_one_match
from tidemark.operators.periods import DROPPED, cap_outcome, period_positions
from tidemark.operators.running import running
from tidemark.operators.sequences import BROKEN, TIMED_OUT, sequence_timeout
from tidemark.session import delete_folder

#: Buckets of a carried table that keeps every key, a file each: more of them for more keys. A batch of few keys touches few of them.
BUCKETS = 32
#: Carry-overs kept for going back, as many batches as Spark keeps in a checkpoint (`spark.sql.streaming.minBatchesToRetain`).
KEPT_BATCHES = 100


@dataclass(frozen=True)
class Step:
    """What a micro-batch does: `work` over the carried and the final rows, then what of the
    outcome is a `result` and what is carried on. The watermark is in epoch microseconds. With a `bucket_key`, what `carry`
    returns holds all keys of the buckets that the batch touched, and other buckets stay as they are."""

    work: Callable[[DataFrame | None, DataFrame], DataFrame]
    results: Callable[[DataFrame, int], DataFrame]
    carry: Callable[[DataFrame, int, DataFrame | None], DataFrame]
    bucket_key: str | None = None


class Incremental:
    """A `foreachBatch` handler that feeds one `Step`. Late rows, at or behind the watermark
    of an earlier batch, take no part; they are an output of their own."""

    def __init__(self, path: str, time: str, bound: timedelta, step: Step, buckets: int = BUCKETS):
        self.path, self.time, self.step, self.buckets = path, time, step, buckets
        self.bound = bound // MICROSECOND

    def folder(self, part: str, batch_id: int) -> str:
        return f"{self.path}/{part}/batch={batch_id}"

    def previous(self, spark: SparkSession, part: str, batch_id: int) -> DataFrame | None:
        return spark.read.parquet(self.folder(part, batch_id - 1)) if batch_id else None

    def keep(self, rows: DataFrame, part: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self.folder(part, batch_id))

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark, us = rows.sparkSession, micros(self.time)
        rows = rows.persist()
        clock = self.previous(spark, "clock", batch_id)
        # One row each: the watermark before, the newest time now.
        before = clock.first()["us"] if clock else None
        newest = rows.agg(F.max(us)).first()[0]
        known = [t for t in (before, None if newest is None else newest - self.bound) if t is not None]
        watermark = max(known, default=-(2**62))
        fresh = rows if before is None else rows.filter(us > before)
        self.keep(rows.filter(F.lit(False) if before is None else us <= before), "late", batch_id)
        self.keep(rows.filter(us.isNull()), "untimed", batch_id)
        waiting = self.previous(spark, "open", batch_id)
        pool = fresh if waiting is None else waiting.unionByName(fresh)
        self.keep(pool.filter(us > watermark), "open", batch_id)
        final = pool.filter(us <= watermark)
        written, touched = (list(clock.first()["written"]) if clock else [-1] * self.buckets), None
        if self.step.bucket_key:
            final = final.persist()
            touched = [r["b"] for r in final.select(self.bucket().alias("b")).distinct().collect()]  # as many as there are buckets at most
            carried = self.bucketed(spark, written, touched)
        else:
            carried = self.previous(spark, "carried", batch_id)
        found = self.step.work(carried, final).persist()
        self.keep(self.step.results(found, watermark), "out", batch_id)
        left = self.step.carry(found, watermark, carried)
        if touched is None:
            self.keep(left, "carried", batch_id)
        else:
            left.withColumn("_b", self.bucket()).repartition("_b").write.mode("overwrite").partitionBy("_b").parquet(self.folder("carried", batch_id))
            for b in touched:
                written[b] = batch_id
        self.keep(spark.createDataFrame([(watermark, written)], "us bigint, written array<bigint>"), "clock", batch_id)
        found.unpersist()
        final.unpersist()
        rows.unpersist()
        self.forget(spark, batch_id - KEPT_BATCHES)

    def bucket(self):
        return F.pmod(F.xxhash64(self.step.bucket_key), F.lit(self.buckets)).cast("int")

    def bucketed(self, spark: SparkSession, written: list[int], buckets: list[int]) -> DataFrame | None:
        """What is carried in some buckets, from the batch that wrote each of them last."""
        places = [f"{self.folder('carried', written[b])}/_b={b}" for b in buckets if written[b] >= 0]
        return spark.read.parquet(*places) if places else None

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Remove what a batch long done left for its successor; results stay."""
        if batch_id < 0:
            return
        if self.step.bucket_key:
            # A bucket goes when the batch after this one has written it anew.
            old, new = (spark.read.parquet(self.folder("clock", n)).first()["written"] for n in (batch_id, batch_id + 1))
            for b in range(self.buckets):
                if old[b] >= 0 and old[b] != new[b]:
                    delete_folder(spark, f"{self.folder('carried', old[b])}/_b={b}")
        for part in ("open", "clock", *(() if self.step.bucket_key else ("carried",))):
            delete_folder(spark, self.folder(part, batch_id))

    def results(self, spark: SparkSession) -> DataFrame:
        """All results so far."""
        return spark.read.parquet(f"{self.path}/out").drop("batch")

    def untimed(self, spark: SparkSession) -> DataFrame:
        """All rows so far that had no time and so took no part."""
        return spark.read.parquet(f"{self.path}/untimed").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        """All rows so far that came too late and so took no part."""
        return spark.read.parquet(f"{self.path}/late").drop("batch")


def _with(carried: DataFrame | None, rows: DataFrame) -> DataFrame:
    return rows if carried is None else carried.unionByName(rows)


def sequence_step(
    key: str, kind: str, time: str, row_id: str, first: str, then: str, within: timedelta,
    chunk_rows: int | None = None,
) -> Step:
    """Results as `sequence_timeout`; a key carries the first event it still waits with."""

    def work(carried, rows):
        rows = _with(carried, rows.select(key, kind, time, row_id))
        return sequence_timeout(rows, key, kind, time, row_id, first, then, within, True, chunk_rows)

    def waits(watermark):
        ends = micros("started_at") + within // MICROSECOND
        return (F.col("outcome") == TIMED_OUT) & (ends > watermark)

    def results(found, watermark):
        return found.filter(~waits(watermark) & (F.col("outcome") != BROKEN))

    def carry(found, watermark, carried):
        return found.filter(waits(watermark)).select(
            key, F.lit(first).alias(kind), F.col("started_at").alias(time), row_id
        )

    return Step(work, results, carry)


def match_step(
    key: str, time: str, row_id: str, side: str, timeout: timedelta, left_only: str = "left_only",
    right_only: str = "right_only", chunk_rows: int | None = None,
) -> Step:
    """Results as `one_to_one_match`; `side` is 0 or 1. A key carries its waiting event."""
    since = F.coalesce("left_time", "right_time")

    def work(carried, rows):
        rows = _with(carried, rows.select(key, time, row_id, side))
        left, right = (rows.filter(F.col(side) == n) for n in (0, 1))
        return one_to_one_match(left, right, key, time, row_id, timeout, left_only, right_only, chunk_rows)

    def waits(watermark):
        alone = F.col("outcome").isin(left_only, right_only)
        return alone & (micros(since) + timeout // MICROSECOND > watermark)

    def results(found, watermark):
        return found.filter(~waits(watermark))

    def carry(found, watermark, carried):
        return found.filter(waits(watermark)).select(
            key, since.alias(time), F.coalesce("left_id", "right_id").alias(row_id),
            F.when(F.col("outcome") == left_only, 0).otherwise(1).alias(side),
        )

    return Step(work, results, carry)


def period_step(
    key: str, time: str, row_id: str, length: timedelta, inclusive: bool = True, cap: int | None = None,
    chunk_rows: int | None = None,
) -> Step:
    """Throttled rows (key, time, id), or with a `cap` the rows (key, time, id, outcome) that pass or
    are flagged. A key carries the first row of its open period and how many rows that has."""
    least = length // MICROSECOND + (0 if inclusive else 1)

    def work(carried, rows):
        rows = _with(carried, rows.select(key, time, row_id, F.lit(None).cast("long").alias("_rows")))
        placed = period_positions(rows, [key], time, row_id, length, inclusive, chunk_rows)
        if carried is None:
            return placed
        # The carried first row stands for all rows its period had before.
        opened = carried.select(
            F.col(key).alias("_key"), micros(time).alias("_start"), F.col("_rows").alias("_before")
        )
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("period_start") == F.col("_start"))
        place = F.col("period_pos") + F.coalesce(F.col("_before") - 1, F.lit(0))
        placed = placed.join(opened, same, "left").withColumn("period_pos", place)
        return placed.drop("_key", "_start", "_before")

    def results(found, watermark):
        new = found.filter(F.col("_rows").isNull())
        if cap is None:
            return new.filter("period_pos = 1").select(key, time, row_id)
        outcome = cap_outcome(F.col("period_pos"), cap).alias("outcome")
        return new.select(key, time, row_id, outcome).filter(F.col("outcome") != DROPPED)

    def carry(found, watermark, carried):
        latest_first = F.struct(-F.col("period_start"), time, row_id)
        last = found.groupBy(key).agg(
            F.max(F.struct("period_start", "period_pos")).alias("_last"),
            F.min_by(F.struct(time, row_id), latest_first).alias("_first"),
        )
        return last.filter(F.col("_last.period_start") + least > watermark).select(
            key, F.col("_first")[time].alias(time), F.col("_first")[row_id].alias(row_id),
            F.col("_last.period_pos").alias("_rows"),
        )

    return Step(work, results, carry)


def running_step(
    key: str, time: str, row_id: str, value: str | None = None, cap: int | None = None,
    chunk_rows: int | None = None,
) -> Step:
    """(key, time, id, running_count[, running_sum]) for each row, or with a `cap` the rows
    (key, time, id, outcome) that pass or are flagged. A key carries its count and sum, in the bucket of its hash."""
    values = [value] if value else []
    running_names = ["running_count", *["running_sum" for _ in values]]

    def work(carried, rows):
        found = running(rows.select(key, time, row_id, *values), [key], [time, row_id], value, chunk_rows)
        if carried is None:
            return found
        before = carried.select(F.col(key).alias("_key"), *[F.col(n).alias(f"_{n}") for n in running_names])
        found = found.join(before, F.col(key).eqNullSafe(F.col("_key")), "left")
        types = dict(carried.dtypes)
        sums = {n: (F.col(n) + F.coalesce(f"_{n}", F.lit(0))).cast(types[n]) for n in running_names}
        return found.withColumns(sums).drop("_key", *[f"_{n}" for n in running_names])

    def results(found, watermark):
        if cap is None:
            return found.select(key, time, row_id, *running_names)
        outcome = cap_outcome(F.col("running_count"), cap).alias("outcome")
        return found.select(key, time, row_id, outcome).filter(F.col("outcome") != DROPPED)

    def carry(found, watermark, carried):
        totals = _with(carried, found.select(key, *running_names))
        last = totals.groupBy(key).agg(F.max_by(F.struct(*running_names), "running_count").alias("_last"))
        return last.select(key, "_last.*")

    return Step(work, results, carry, key)
