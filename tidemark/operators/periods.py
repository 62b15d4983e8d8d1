"""Per-key periods of fixed length, and what is capped by them: throttling and click caps.

A period starts with a row and lasts a fixed time; the first row after it starts the next
one. Where a period starts depends on the one before, so the rows of a key are walked in order.
The walk is one step per period between pointers found for whole Arrow batches, after one exchange.

A key too large for one task is walked chunk by chunk, all at once. Before that, each chunk
must know which period was open when it began, see `_seeds`.
"""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import micros
from tidemark.operators.running import running
from tidemark.operators.spread import CHUNK, Spread, spread

PASSED, FLAGGED, DROPPED = "passed", "flagged", "dropped"


def period_positions(
    df: DataFrame,
    keys,
    time: str,
    row_id: str,
    length: timedelta,
    inclusive: bool = True,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Every row with `period_pos`, its 1-based place inside its period, and `period_start`, the
    period's first time in epoch microseconds.

    A row that comes exactly `length` after the period's first row starts a new period when
    `inclusive`, and still belongs to the old one otherwise. Rows without a time belong to no period: both are null.
    """
    keys = list(keys)
    least = length // timedelta(microseconds=1) + (0 if inclusive else 1)
    laid = spread(df.filter(F.col(time).isNotNull()), keys, [time, row_id], chunk_rows)
    rows = laid.rows.withColumn("_us", micros(F.col(time)))
    if laid.split:
        rows = laid.attach(rows, _seeds(laid, rows, least, chunk_rows))
    else:
        rows = rows.withColumns({"_open": F.lit(None).cast("long"), "_open_rows": F.lit(None).cast("long")})
    ordered = rows.withColumn("_first", F.row_number().over(laid.local) == 1)
    added = [T.StructField(name, T.LongType()) for name in ("period_pos", "period_start")]
    schema = T.StructType([*ordered.schema.fields, *added])
    walked = ordered.mapInArrow(_walker(least), schema)
    return _with_untimed(walked.drop(CHUNK, "_us", "_open", "_open_rows", "_first"), df, time)


def _with_untimed(placed: DataFrame, df: DataFrame, time: str) -> DataFrame:
    """`placed`, and the rows of `df` without a time, for which the added columns are null."""
    if not df.schema[time].nullable:
        return placed
    added = {f.name: F.lit(None).cast(f.dataType) for f in placed.schema if f.name not in df.columns}
    return placed.unionByName(df.filter(F.col(time).isNull()).withColumns(added))


def _walker(least: int):
    """The period walk over sorted Arrow batches; rows arrive key by key, chunk by chunk.

    Where the next period would start if one started at a row is found for all rows of a batch at once; the walk itself
    then takes one step for each period.
    """

    def walk(batches):
        start, place = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            first, us, opened, opened_rows = (batch.column(batch.schema.get_field_index(c)) for c in ("_first", "_us", "_open", "_open_rows"))
            us = us.to_numpy()
            heads = np.flatnonzero(first.to_numpy(zero_copy_only=False))
            begins = heads if len(heads) and heads[0] == 0 else np.concatenate(([0], heads))
            onward = _next_starts(us, begins, least).tolist()
            ends, starts, taken_over = [*begins[1:].tolist(), n], [], []
            goes_on = len(begins) > len(heads)
            seeded = opened.null_count < n
            for i, end in zip(begins.tolist(), ends):
                if i or not goes_on:
                    start = opened[i].as_py() if seeded else None
                    place = (opened_rows[i].as_py() or 0) if seeded else 0
                if start is not None:
                    # What the period that is open takes in before a new one starts.
                    upto = i + int(np.searchsorted(us[i:end], start + least))
                    taken_over.append((i, upto, start, place))
                    i = upto
                while i < end:
                    starts.append(i)
                    i = onward[i]
            base = np.zeros(n, np.int64)
            base[starts] = starts
            np.maximum.accumulate(base, out=base)
            places, began = np.arange(1, n + 1) - base, us[base]
            for i, upto, since, before in taken_over:
                places[i:upto], began[i:upto] = np.arange(before + 1, before + 1 + upto - i), since
            start, place = int(began[-1]), int(places[-1])
            names = [*batch.schema.names, "period_pos", "period_start"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(began)], names=names)

    return walk


def _next_starts(us: np.ndarray, begins: np.ndarray, least: int) -> np.ndarray:
    """For each row the first one of its group that comes `least` or more after it, or the group's end."""
    ends = np.append(begins[1:], len(us))
    span = int(us.max()) - int(us.min()) + least + 1
    if span * len(begins) < 1 << 62:
        group = np.repeat(np.arange(len(begins)), ends - begins)
        line = group * span + (us - us.min())
        return np.searchsorted(line, line + least)
    return np.concatenate([a + np.searchsorted(us[a:b], us[a:b] + least) for a, b in zip(begins.tolist(), ends.tolist())])


def _seeds(laid: Spread, rows: DataFrame, least: int, chunk_rows: int | None) -> DataFrame:
    """(keys, chunk, _open, _open_rows): the period open at the start of each chunk.

    Whatever period is open when a chunk begins, the chunk's first period start is one of the
    rows up to the first one a whole length after the chunk's first row. Each chunk works out
    where a walk from every such row would leave it (`_exits`). That makes the walk over
    chunks a chain of links, and the chain is followed by doubling the links: as many rounds
    as the chunk count has bits, each a join on key and time.
    """
    heavy = rows.filter(F.col(CHUNK).isNotNull()).select(F.struct(*laid.keys).alias("_k"), CHUNK, "_us")
    chunks = heavy.groupBy("_k", CHUNK).agg(
        F.min("_us").alias("_lo"), F.count("*").alias("_n")
    ).checkpoint(eager=True)

    key_type = heavy.schema["_k"].dataType
    schema = T.StructType([
        T.StructField("_k", key_type),
        T.StructField(CHUNK, T.IntegerType()),
        T.StructField("_in", T.LongType()),
        T.StructField("_out", T.LongType()),
    ])
    exits = heavy.groupBy("_k", CHUNK).applyInArrow(_exits(least), schema).checkpoint(eager=True)

    opening = chunks.groupBy("_k").agg(F.min(CHUNK).alias(CHUNK), F.min("_lo").alias("_in"))
    reached = exits.join(laid.small(opening), ["_k", CHUNK, "_in"], "left_semi")
    reached = reached.select("_k", F.col("_out").alias("_src"))
    hops = _hops(exits, least, chunk_rows).checkpoint(eager=True)
    longest = chunks.groupBy("_k").count().agg(F.max("count")).first()[0]
    for _ in range(int(longest).bit_length()):
        onward = reached.join(hops, ["_k", "_src"]).select("_k", F.col("_dst").alias("_src"))
        reached = reached.unionByName(onward).distinct().checkpoint(eager=True)
        ahead = hops.select("_k", F.col("_src").alias("_dst"), F.col("_dst").alias("_far"))
        doubled = hops.join(ahead, ["_k", "_dst"]).select("_k", "_src", F.col("_far").alias("_dst"))
        hops = doubled.checkpoint(eager=True)
    return _open_periods(laid, heavy, chunks, exits, reached)


def _exits(least: int):
    """For one chunk: the last period start reached from each row the walk may enter by."""

    def of_chunk(chunk: pa.Table) -> pa.Table:
        times = np.unique(chunk.column("_us").to_numpy())
        onward = np.searchsorted(times, times + least)
        jump = np.where(onward < len(times), onward, np.arange(len(times)))
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        entries = min(int(np.searchsorted(times, times[0] + least)) + 1, len(times))
        same = pa.array(np.zeros(entries, dtype=np.int64))
        return pa.table({
            "_k": chunk.column("_k").take(same),
            CHUNK: chunk.column(CHUNK).take(same),
            "_in": times[:entries],
            "_out": times[jump[:entries]],
        })

    return of_chunk


def _hops(exits: DataFrame, least: int, chunk_rows: int | None) -> DataFrame:
    """(_k, _src, _dst): from each chunk exit to the exit of the chunk entered next.

    The next period starts at the first entry row not before `_src + least`. Reading the
    entries and the wanted times backwards, that is the last entry seen.
    """
    entry = F.struct((-F.col("_in")).alias("at"), (-F.col(CHUNK)).alias("no"), F.col("_out").alias("out"))
    entries = exits.select(
        "_k", entry["at"].alias("_at"), F.lit(0).alias("_ask"), entry.alias("_entry"),
        F.lit(None).cast("long").alias("_src"),
    )
    asked = exits.select("_k", F.col("_out").alias("_src")).distinct().select(
        "_k", (-(F.col("_src") + least)).alias("_at"), F.lit(1).alias("_ask"),
        F.lit(None).cast(entries.schema["_entry"].dataType).alias("_entry"), "_src",
    )
    laid = spread(entries.unionByName(asked), ["_k"], ["_at", "_ask"], chunk_rows)
    rows = laid.carry(laid.rows, _seen=(F.max("_entry"), "peak"))
    found = laid.orelse(F.max("_entry").over(laid.so_far), "_seen")
    rows = rows.withColumn("_found", found).filter((F.col("_ask") == 1) & F.col("_found").isNotNull())
    return rows.select("_k", "_src", F.col("_found.out").alias("_dst"))


def _open_periods(laid, heavy, chunks, exits, reached) -> DataFrame:
    place = exits.groupBy("_k", F.col("_out").alias("_src")).agg(F.min(CHUNK).alias(CHUNK))
    last = reached.join(place, ["_k", "_src"]).select("_k", CHUNK, F.col("_src").alias("_last"))
    # At most one row per chunk from here on.
    inside = heavy.join(laid.small(last), ["_k", CHUNK])
    last = inside.filter(F.col("_us") >= F.col("_last")).groupBy("_k", CHUNK, "_last").agg(
        F.count("*").alias("_tail")
    )
    ordered = Window.partitionBy("_k").orderBy(CHUNK)
    upto, earlier = (ordered.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    table = chunks.join(last, ["_k", CHUNK], "left").withColumn("_upto", F.sum("_n").over(upto))
    table = table.withColumn("_base", F.col("_upto") - F.col("_tail"))
    opened = F.col("_upto") - F.col("_n") - F.max("_base").over(earlier)
    table = table.withColumns({"_open": F.max("_last").over(earlier), "_open_rows": opened})
    return table.select("_k.*", CHUNK, "_open", "_open_rows").checkpoint(eager=True)


def throttle(
    df: DataFrame,
    keys,
    time: str,
    row_id: str,
    interval: timedelta,
    inclusive: bool = True,
    chunk_rows: int | None = None,
) -> DataFrame:
    """The first row of a key and each row at least `interval` after the last one kept.

    With `inclusive=False` a row exactly `interval` later is not kept. A row without a time is after none and not kept.
    """
    rows = period_positions(df, keys, time, row_id, interval, inclusive, chunk_rows)
    return rows.filter(F.col("period_pos") == 1).drop("period_pos", "period_start")


def cap_outcome(place: Column, cap: int) -> Column:
    return F.when(place <= cap, PASSED).when(place == cap + 1, FLAGGED).otherwise(DROPPED)


def click_cap(
    df: DataFrame,
    keys,
    time: str,
    row_id: str,
    cap: int = 10,
    ttl: timedelta | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Every row with `outcome`: the first `cap` rows of a key pass, the next one is flagged
    once and blocks the key, later rows are dropped.

    Counting starts anew `ttl` after the first row of a counting period; None means never.
    Rows are taken in event-time order. A row without a time counts for nothing, its outcome is null.
    """
    if ttl is None:
        rows = running(df.filter(F.col(time).isNotNull()), keys, [time, row_id], None, chunk_rows)
        rows = _with_untimed(rows.withColumnRenamed("running_count", "period_pos").drop(CHUNK), df, time)
    else:
        rows = period_positions(df, keys, time, row_id, ttl, True, chunk_rows)
    place = F.col("period_pos")
    return rows.withColumn("outcome", F.when(place.isNotNull(), cap_outcome(place, cap))).drop("period_pos", "period_start")
