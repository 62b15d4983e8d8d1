"""Sliding event-time windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_text(span: timedelta) -> str:
    return f"{span // timedelta(microseconds=1)} microseconds"


def sliding_count(df: DataFrame, key: str, time: str, size: timedelta, slide: timedelta) -> DataFrame:
    """(key, window_start, window_end, n) for windows aligned to the epoch, `[start, end)`.

    Rows are first counted in panes of one slide; only the pane counts are copied into the
    windows they belong to. Copying the rows would multiply the input by size / slide before
    the shuffle. `size` must be a multiple of `slide`.
    """
    if size % slide:
        raise ValueError("size must be a multiple of slide")
    pane = F.window(time, interval_text(slide))
    panes = df.filter(F.col(time).isNotNull()).groupBy(key, pane.alias("_pane")).agg(F.count("*").alias("_n"))
    back = F.explode(F.sequence(F.lit(0), F.lit(size // slide - 1))).alias("_back")
    copies = panes.select(key, F.col("_pane.start").alias("_start"), "_n", back)
    start = F.col("_start") - F.col("_back") * F.lit(slide)
    windows = copies.groupBy(key, start.alias("window_start")).agg(F.sum("_n").alias("n"))
    return windows.select(key, "window_start", (F.col("window_start") + F.lit(size)).alias("window_end"), "n")
