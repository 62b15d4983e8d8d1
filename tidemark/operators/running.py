"""Aggregates that carry a value along the rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.spread import CHUNK, Spread, spread


def running(
    df: DataFrame, keys, order, value: str | None = None, chunk_rows: int | None = None
) -> DataFrame:
    """Every row with `running_count`, and with `running_sum` when `value` is given."""
    laid = spread(df, keys, order, chunk_rows)
    return _running(laid, value).drop(CHUNK)


def _running(laid: Spread, value: str | None) -> DataFrame:
    parts = {"_rows": (F.count("*"), "total")}
    if value:
        parts["_sum"] = (F.sum(value), "total")
    rows = laid.carry(laid.rows, **parts)
    columns = {"running_count": laid.plus(F.row_number().over(laid.local).cast("long"), "_rows")}
    if value:
        columns["running_sum"] = laid.plus(F.sum(value).over(laid.so_far), "_sum")
    return rows.withColumns(columns).drop("_rows", "_sum")


def running_average(
    df: DataFrame, keys, order, value: str, at_least: int = 2, places: int = 6, chunk_rows: int | None = None
) -> DataFrame:
    """The average so far, reported from the `at_least`-th row of a key on."""
    rows = running(df, keys, order, value, chunk_rows)
    average = F.round(F.col("running_sum") / F.col("running_count"), places)
    return rows.filter(F.col("running_count") >= at_least).withColumn("running_avg", average)


def count_window_average(
    df: DataFrame, keys, order, value: str, size: int, places: int = 6, chunk_rows: int | None = None
) -> DataFrame:
    """Average of every full, non-overlapping group of `size` rows of a key."""
    rows = running(df, keys, order, None, chunk_rows)
    group = F.floor((F.col("running_count") - 1) / size).cast("long")
    grouped = rows.groupBy(*keys, group.alias("group_no")).agg(
        F.count("*").alias("_n"), F.sum(value).alias("_sum")
    )
    average = F.round(F.col("_sum") / F.col("_n"), places).alias("group_avg")
    return grouped.filter(F.col("_n") == size).select(*keys, "group_no", average)


def global_count(df: DataFrame, order, chunk_rows: int | None = None) -> DataFrame:
    """Every row with `operator_count`, its 1-based place in the whole table."""
    return running(df, [], order, None, chunk_rows).withColumnRenamed("running_count", "operator_count")


def keyed_sum_with_global_count(
    df: DataFrame, keys, order, value: str, chunk_rows: int | None = None
) -> DataFrame:
    """(keys, running_sum, operator_count): a sum per key beside one count over all keys."""
    counted = global_count(df, order, chunk_rows)
    return running(counted, keys, order, value, chunk_rows)


def word_count(df: DataFrame, text: str, separator: str = r"\s+") -> DataFrame:
    """How often each lower-cased word occurs."""
    words = df.select(F.explode(F.split(F.lower(text), separator)).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
