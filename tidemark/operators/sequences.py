"""Two-step event sequences with a time limit."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.spread import spread

DONE, TIMED_OUT, BROKEN = "done", "timed_out", "broken"


def sequence_timeout(
    df: DataFrame,
    key: str,
    kind: str,
    time: str,
    row_id: str,
    first: str,
    then: str,
    within: timedelta,
    include_broken: bool = False,
    chunk_rows: int | None = None,
) -> DataFrame:
    """One row per `first` event: was `then` the very next event of the key, in time?

    `done` when it was and came less than `within` later, `timed_out` when nothing came in
    that time (exactly `within` later is too late). A different event in between breaks the
    sequence without a report; `include_broken` shows those rows too. Kinds are compared
    without case. The input is bounded, so sequences still open at its end time out.
    """
    columns = df.select(key, kind, time, row_id)
    laid = spread(columns, [key], [time, row_id], chunk_rows)
    place = F.struct(time, row_id, kind)
    rows = laid.carry(laid.rows, _after=(F.min(place), "following"))
    after = laid.orelse(F.lead(place).over(laid.local), "_after")
    rows = rows.withColumn("_next", after).filter(F.lower(kind) == first.lower())
    follow, came = F.col("_next")[kind], F.col("_next")[time]
    late = came.isNull() | (came >= F.col(time) + F.lit(within))
    outcome = (
        F.when(late, TIMED_OUT).when(F.lower(follow) == then.lower(), DONE).otherwise(BROKEN)
    )
    done_at = F.when(F.col("outcome") == DONE, came)
    rows = rows.withColumn("outcome", outcome)
    if not include_broken:
        rows = rows.filter(F.col("outcome") != BROKEN)
    return rows.select(
        key, row_id, F.col(time).alias("started_at"), done_at.alias("done_at"), "outcome"
    )
