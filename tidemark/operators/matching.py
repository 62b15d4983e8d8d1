"""One-to-one matching of two event streams with a time limit.

Each key keeps one waiting event. An arrival from the other side takes it and both are
matched; an arrival from the same side replaces it, and the replaced event is `superseded`.
An event that waits longer than the limit leaves unmatched.

No state machine is needed to say this over a table. Order the events of a key and call
a row a *fresh start* when nothing can be waiting for it: it is the first, or the row before is
from the same side, or that row came more than the limit earlier. From a fresh start on, the rows
alternate between "waits" and "is taken by the one that waits". So a row's role follows from its
distance to the last fresh start, and that from a running maximum.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.spread import spread

MATCHED, SUPERSEDED = "matched", "superseded"
LEFT, RIGHT = "left", "right"


def one_to_one_match(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    row_id: str,
    timeout: timedelta,
    left_only: str = "left_only",
    right_only: str = "right_only",
    chunk_rows: int | None = None,
) -> DataFrame:
    """(key, left_id, left_time, right_id, right_time, outcome), one row per pair or lone event.

    Both inputs carry the columns `key`, `time`, `row_id`. Equal times are ordered by
    `row_id`, then left before right. A gap of exactly `timeout` still matches.
    """
    columns = [key, time, row_id]
    both = left.select(*columns, F.lit(0).alias("_side")).unionByName(
        right.select(*columns, F.lit(1).alias("_side"))
    )
    laid = spread(both, [key], [time, row_id, "_side"], chunk_rows)
    limit = F.lit(timeout)
    place = F.struct(time, row_id, "_side")

    rows = laid.carry(
        laid.rows,
        _before=(F.max(place), "previous"),
        _after=(F.min(place), "following"),
        _rows=(F.count("*"), "total"),
    )
    prior = laid.orelse(F.lag(place).over(laid.local), "_before")
    coming = laid.orelse(F.lead(place).over(laid.local), "_after")
    number = laid.plus(F.row_number().over(laid.local).cast("long"), "_rows")
    rows = rows.withColumns({"_prior": prior, "_coming": coming, "_number": number})
    rows = rows.drop("_before", "_after", "_rows")

    same_side = F.col("_prior._side") == F.col("_side")
    too_old = F.col(time) > F.col("_prior")[time] + limit
    fresh = F.col("_prior").isNull() | same_side | too_old
    rows = rows.withColumn("_fresh", F.when(fresh, F.col("_number")))

    rows = laid.carry(rows, _fresh_before=(F.max("_fresh"), "peak"))
    start = laid.orelse(F.max("_fresh").over(laid.so_far), "_fresh_before")
    waits = rows.withColumn("_start", start).filter((F.col("_number") - F.col("_start")) % 2 == 0)

    coming_side, coming_time = F.col("_coming._side"), F.col("_coming")[time]
    in_time = coming_time.isNotNull() & (coming_time <= F.col(time) + limit)
    is_left = F.col("_side") == 0
    outcome = (
        F.when(in_time & (coming_side != F.col("_side")), MATCHED)
        .when(in_time, SUPERSEDED)
        .when(is_left, left_only)
        .otherwise(right_only)
    )
    waits = waits.withColumn("outcome", outcome)
    matched = F.col("outcome") == MATCHED
    own_id, own_time = F.col(row_id), F.col(time)
    other_id, other_time = F.col("_coming")[row_id], coming_time
    return waits.select(
        key,
        F.when(is_left, own_id).when(matched, other_id).alias("left_id"),
        F.when(is_left, own_time).when(matched, other_time).alias("left_time"),
        F.when(~is_left, own_id).when(matched, other_id).alias("right_id"),
        F.when(~is_left, own_time).when(matched, other_time).alias("right_time"),
        "outcome",
    )


def with_outcome(results: DataFrame, *outcomes: str) -> DataFrame:
    """One named output of an operator that tags its rows with `outcome`."""
    return results.filter(F.col("outcome").isin(*outcomes))
