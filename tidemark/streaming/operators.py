"""Streaming forms that Spark's own stream operators express."""

from __future__ import annotations

import time as clock
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import timedelta
from math import gcd
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import MICROSECOND, micros
from tidemark.operators.joins import lookup, time_slot
from tidemark.operators.windows import interval_text
from tidemark.session import delete_folder, scratch


def stream_sliding_count(df: DataFrame, key: str, time: str, size: timedelta, slide: timedelta) -> DataFrame:
    """(key, window_start, window_end, n); `df` carries a watermark on `time`.

    Two chained aggregates: rows are counted once, in panes of the greatest length that parts both `size` and `slide`; only the
    panes' counts are copied into the windows they lie in, when the watermark has closed them. A window is
    emitted once the watermark has passed its end.
    """
    pane = timedelta(microseconds=gcd(size // MICROSECOND, slide // MICROSECOND))
    panes = df.groupBy(key, F.window(time, interval_text(pane)).alias("_pane")).agg(F.count("*").alias("_n"))
    window = F.window(F.window_time("_pane"), interval_text(size), interval_text(slide))
    counted = panes.groupBy(key, window.alias("_w")).agg(F.sum("_n").alias("n"))
    return counted.select(
        key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "n"
    )


def stream_interval_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
    before: timedelta, after: timedelta, how: str = "inner",
) -> DataFrame:
    """The interval join of two streams; both carry a watermark on their time.

    The band on the event times lets Spark drop a row once no partner can come any more. As in
    batch, rows meet by key and time slot, so the state of a heavy key is spread over the slots.
    """
    lower, upper = before // MICROSECOND, after // MICROSECOND
    width = max(1, lower + upper)
    here, there = micros(left_time), micros(right_time)
    left = left.withColumn("_slot", time_slot(here, width))
    slots = F.sequence(time_slot(there - upper, width), time_slot(there + lower, width))
    right = right.withColumn("_rslot", F.explode(slots))
    band = F.col(right_time).between(F.col(left_time) - F.lit(before), F.col(left_time) + F.lit(after))
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_slot") == F.col("_rslot"))
    return left.join(right, same & band, how).drop("_slot", "_rslot")


def stream_latest_per_key(df: DataFrame, keys, sequence, values, is_delete: Column) -> DataFrame:
    """(keys, values, deleted): the last write per key, for update mode; deletes are kept as
    such, because a later micro-batch has to take back what an earlier one reported."""
    payload = F.struct(*values, F.coalesce(is_delete, F.lit(False)).alias("deleted"))
    last = df.groupBy(*keys).agg(F.max_by(payload, F.struct(*sequence)).alias("_last"))
    return last.select(*keys, "_last.*")


def stream_word_count(df: DataFrame, text: str, separator: str = r"\s+") -> DataFrame:
    """Word counts so far, for complete or update mode."""
    words = df.select(F.explode(F.split(F.lower(text), separator)).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


class Snapshot(NamedTuple):
    """A copy of a lookup table: its number, the cached rows, where they are written, and when they were read."""

    version: int
    rows: DataFrame
    path: str
    loaded_at: float


class RefreshingLookup:
    """Enrich micro-batches from a copy of a table, which is read again when it is older than `seconds`.

    A load scans the table once, into a folder of its own in the shared folder, and is cached from there: batches are answered
    from memory, a table that is changed or replaced meanwhile can't mix two states, and a lost executor reads the copy
    again and not the table. The old copy serves until the new one is whole, and its memory and folder are freed when
    the next batch has moved on. With `background`, a batch never waits for a load but the first: it is
    answered from the old copy while a thread reads the new one. A load that fails leaves the old copy in use, is kept in
    `failure` and tried again after another `seconds`; only the very first one raises.
    """

    def __init__(self, load: Callable[[], DataFrame], seconds: float = 30.0, now=clock.monotonic, background: bool = False):
        self.load, self.seconds, self.now = load, seconds, now
        self.held: Snapshot | None = None
        self.failure: Exception | None = None
        self.loads = 0
        self.asked_at = 0.0
        self.coming: Future | None = None
        self.reader = ThreadPoolExecutor(1, "lookup") if background else None

    def _read(self, version: int, asked: float) -> Snapshot:
        rows = self.load()
        spark, path = rows.sparkSession, scratch(rows.sparkSession, "lookup")
        rows.write.parquet(path)
        copy = spark.read.schema(rows.schema).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
        copy.count()
        return Snapshot(version, copy, path, asked)

    def _swap(self, new: Snapshot) -> None:
        old, self.held, self.failure = self.held, new, None
        if old is not None:
            old.rows.unpersist()
            delete_folder(old.rows.sparkSession, old.path)

    def current(self) -> DataFrame:
        asked = self.now()
        if self.coming is not None and self.coming.done():
            done, self.coming = self.coming, None
            try:
                self._swap(done.result())
            except Exception as failure:  # the storage's or the loader's own
                self.failure = failure
        if self.coming is None and (self.held is None or asked - self.asked_at >= self.seconds):
            self.asked_at, self.loads = asked, self.loads + 1
            if self.held is not None and self.reader is not None:
                self.coming = self.reader.submit(self._read, self.loads, asked)
            else:
                try:
                    self._swap(self._read(self.loads, asked))
                except Exception as failure:
                    if self.held is None:
                        raise
                    self.failure = failure
        return self.held.rows

    @property
    def version(self) -> int:
        return self.held.version if self.held else 0

    def enrich(self, rows: DataFrame, key: str, table_key: str, values) -> DataFrame:
        return lookup(rows, self.current(), key, table_key, values)

    def close(self) -> None:
        """Waits for a load under way and frees the copy."""
        if self.reader is not None:
            self.reader.shutdown()
        for one in (self.held, self.coming.result() if self.coming is not None and self.coming.exception() is None else None):
            if one is not None:
                one.rows.unpersist()
                delete_folder(one.rows.sparkSession, one.path)
        self.held, self.coming = None, None
