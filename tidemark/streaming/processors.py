"""Stateful stream operators in event-time order.

Every operator here reports what its batch twin reports, whatever order the rows arrive in. Rows
wait in state until the watermark says that nothing older can come; the key's timer then takes
them out in time order. Only what still waits is held, and it is held in the state store, not in
the Python worker.

Waiting rows are sorted in lots and stored in entries of many rows each, so the calls to the store are few. But for small
ones, no entry crosses a border between buckets of time, which are counted from the watermark and double in length: an entry that the watermark
parts is stored anew, a row in a large one at most once for each doubling. The timer merges the entries that are due and opens each when its first row's turn comes.
A key has one timer, at the first time at which it has something to do. A key's state ends
with the first watermark after which no row can make use of it: with the wait's limit, with the end of the open
period, or, where a `ttl` is given, that long after the key's last row.

Input rows need a key, a time with a watermark, an id and optionally a tag.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from heapq import heappop, heappush, heapreplace
from itertools import groupby, islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidemark.functions.scalars import MICROSECOND, micros
from tidemark.operators.matching import MATCHED, SUPERSEDED
from tidemark.operators.periods import FLAGGED, PASSED
from tidemark.operators.sequences import BROKEN, DONE, TIMED_OUT

WAITING = "rows array<struct<us: bigint, id: bigint, tag: string, amount: bigint>>"
#: Rows that are sorted together, rows of an entry of the state at most, rows up to which an entry may go on into the next bucket,
#: and the length of the first bucket of time in microseconds.
LOT, ENTRY, SMALL, BUCKET = 32_768, 1_024, 64, 64_000_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def at(us: int | None) -> datetime | None:
    return None if us is None else EPOCH + us * MICROSECOND


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] or ""


class InOrder(StatefulProcessor):
    """Buffers the rows of a key and hands them to `step` one by one in (time, id, tag) order.

    Subclasses give `state_schema` and `step(state, row)`, which returns the new state (None: nothing to keep) and
    output rows. A row is `(us, id, tag, amount)`. A state that ends has `ends(state)`, the first time at which a row
    can't use it any more, and `ended(state)`, the output rows of its end.
    """

    state_schema = ""
    row: Row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "start bigint, entry bigint", WAITING)
        self.state = handle.getValueState("state", self.state_schema)
        #: The number of the next entry, and the time of the key's timer in milliseconds.
        self.agenda = handle.getValueState("agenda", "entries bigint, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Rows go on to the state in lots, so the worker never holds a whole key.
        entries, due = self.agenda.get() or (0, None)
        then, final = due, timerValues.getCurrentWatermarkInMs() * 1000
        while lot := sorted(((r["us"], r["id"], r["tag"], r["amount"]) for r in islice(rows, LOT)), key=_order):
            entries = self.store(lot, final, entries)
            least = lot[0][0] // 1000
            then = least if then is None else min(then, least)
        if then != due and due is not None:
            self.handle.deleteTimer(due)
        if then != due:
            self.handle.registerTimer(then)
        self.agenda.update((entries, then))
        return iter(())

    def store(self, rows: list[tuple], final: int, entries: int) -> int:
        """Write sorted rows; returns the number of the next entry."""
        entry: list[tuple] = []
        for _, bucket in groupby(rows, key=lambda r: max(0, (r[0] - final) // BUCKET).bit_length()):
            for row in bucket:
                if len(entry) == ENTRY:
                    entries = self.put(entry, entries)
                entry.append(row)
            if len(entry) >= SMALL:
                entries = self.put(entry, entries)
        return self.put(entry, entries) if entry else entries

    def put(self, entry: list[tuple], entries: int) -> int:
        self.waiting.updateValue((entry[0][0], entries), (entry[:],))
        entry.clear()
        return entries + 1

    def taken(self, final: int, rest: list[tuple]) -> Iterator[tuple]:
        """The rows up to `final` in order, out of the state. `rest` gets the later rows of the entries that were opened,
        then `self.later` is the start of the first entry that was not."""
        opened: list[tuple] = []  # heap of (order, entry, row, further rows)
        self.later = None
        for start, entry in [*sorted(map(tuple, self.waiting.keys())), (None, None)]:
            before = final + 1 if start is None else min(start, final + 1)
            while opened and opened[0][0][0] < before:
                _, number, row, more = opened[0]
                yield row
                if (row := next(more, None)) is None:
                    heappop(opened)
                else:
                    heapreplace(opened, (_order(row), number, row, more))
            if start is None or start > final:
                self.later = start
                break
            more = iter([tuple(r) for r in self.waiting.getValue((start, entry))[0]])
            self.waiting.removeKey((start, entry))
            row = next(more)
            heappush(opened, (_order(row), entry, row, more))
        for _, _, row, more in opened:
            rest += [row, *more]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        # No row at or before the watermark can come any more.
        final = timerValues.getCurrentWatermarkInMs() * 1000
        before = self.state.get()
        before = None if before is None else tuple(before)
        state, entries, rest = before, self.agenda.get()[0], []
        for row in self.taken(final, rest):
            if state is not None and (end := self.ends(state)) is not None and end <= row[0]:
                yield from self.rows(key, self.ended(state))
                state = None
            state, results = self.step(state, row)
            yield from self.rows(key, results)
        times = [] if self.later is None else [self.later]
        if rest:
            rest.sort(key=_order)
            entries = self.store(rest, final, entries)
            times.append(rest[0][0])
        end = self.ends(state) if state is not None else None
        if end is not None and end <= final + 1:
            yield from self.rows(key, self.ended(state))
            state = None
        elif end is not None:
            times.append(end - 1)
        if state is None and before is not None:
            self.state.clear()
        elif state is not None and state != before:
            self.state.update(state)
        if times:
            # The timer that runs is removed when this returns; another one must have another time.
            then = max(min(times) // 1000, due + 1)
            self.handle.registerTimer(then)
            self.agenda.update((entries, then))
        else:
            self.agenda.clear()

    def rows(self, key, results: list[tuple]) -> Iterator[Row]:
        return (self.row(*key, *values) for values in results)

    def step(self, state, row):
        raise NotImplementedError

    def ends(self, state) -> int | None:
        return None

    def ended(self, state) -> list[tuple]:
        return []

    def close(self) -> None:
        pass


class Running(InOrder):
    """(id, running_count, running_sum) for every row, anew after `ttl` without a row."""

    state_schema = "n bigint, total bigint, us bigint"

    def __init__(self, ttl: int | None = None):
        self.ttl = ttl

    def step(self, state, row):
        n, total, _ = state or (0, 0, 0)
        n, total = n + 1, total + (row[3] or 0)
        return (n, total, row[0]), [(row[1], n, total)]

    def ends(self, state):
        return None if self.ttl is None else state[2] + self.ttl


class Periods(InOrder):
    """(id, position) for every row: its place in a period of fixed length, or in the key."""

    state_schema = "start bigint, place bigint"

    def __init__(self, least: int | None):
        self.least = least

    def step(self, state, row):
        start, place = state or (row[0], 0)
        return (start, place + 1), [(row[1], place + 1)]

    def ends(self, state):
        return None if self.least is None else state[0] + self.least


class Sequence(InOrder):
    """(id, started_at, done_at, outcome) for every first event."""

    state_schema = "us bigint, id bigint"

    def __init__(self, first: str, then: str, within: timedelta):
        self.first, self.then = first.lower(), then.lower()
        # An event exactly `within` later is too late.
        self.within = within // MICROSECOND

    def step(self, state, row):
        us, row_id, kind, _ = row
        out = []
        if state is not None:
            started, started_id = state
            if (kind or "").lower() == self.then:
                out.append((started_id, at(started), at(us), DONE))
            else:
                out.append((started_id, at(started), None, BROKEN))
        return ((us, row_id) if (kind or "").lower() == self.first else None), out

    def ends(self, state):
        return state[0] + self.within

    def ended(self, state):
        return [(state[1], at(state[0]), None, TIMED_OUT)]


class TwoStreamMatch(InOrder):
    """(left_id, left_time, right_id, right_time, outcome); the tag is the side, 0 or 1."""

    state_schema = "us bigint, id bigint, side string"

    def __init__(self, timeout: timedelta, left_only: str, right_only: str):
        # An event exactly `timeout` later still matches.
        self.timeout = timeout // MICROSECOND + 1
        self.alone = {"0": left_only, "1": right_only}

    def report(self, slot, outcome):
        us, row_id, side = slot
        own, none = (row_id, at(us)), (None, None)
        return (*own, *none, outcome) if side == "0" else (*none, *own, outcome)

    def step(self, state, row):
        slot = (row[0], row[1], row[2])
        if state is None:
            return slot, []
        if state[2] == row[2]:
            return slot, [self.report(state, SUPERSEDED)]
        left, right = (state, slot) if state[2] == "0" else (slot, state)
        return None, [(left[1], at(left[0]), right[1], at(right[0]), MATCHED)]

    def ends(self, state):
        return state[0] + self.timeout

    def ended(self, state):
        return [self.report(state, self.alone[state[2]])]


def _in_order(df: DataFrame, key, time, row_id, processor, columns: str, tag: Column, amount: Column) -> DataFrame:
    rows = df.select(
        F.col(key), micros(time).alias("us"), F.col(row_id).cast("long").alias("id"),
        tag.cast("string").alias("tag"), amount.cast("long").alias("amount"), F.col(time),
    )
    output = StructType([df.schema[key], *StructType.fromDDL(columns).fields])
    processor.row = Row(*output.names)
    return rows.groupBy(key).transformWithState(
        statefulProcessor=processor,
        outputStructType=output,
        outputMode="append",
        timeMode="eventTime",
    )


def stream_running(
    df: DataFrame, key: str, time: str, row_id: str, amount: Column, ttl: timedelta | None = None
) -> DataFrame:
    """(key, id, running_count, running_sum). `amount` is a whole number.

    With a `ttl`, a key that has had no row for so long is forgotten: its state is removed once the watermark has passed
    that time, and a row that comes exactly `ttl` after the last one or later is the first one again.
    """
    columns = "id bigint, running_count bigint, running_sum bigint"
    processor = Running(None if ttl is None else ttl // MICROSECOND)
    return _in_order(df, key, time, row_id, processor, columns, F.lit(None), amount)


def stream_running_average(
    df: DataFrame, key: str, time: str, row_id: str, amount: Column, at_least: int = 2
) -> DataFrame:
    """(key, id, running_count, running_sum, running_avg) from the `at_least`-th row of a key on."""
    rows = stream_running(df, key, time, row_id, amount).filter(F.col("running_count") >= at_least)
    return rows.withColumn("running_avg", F.col("running_sum") / F.col("running_count"))


def stream_throttle(
    df: DataFrame, key: str, time: str, row_id: str, interval: timedelta, inclusive: bool = True
) -> DataFrame:
    """(key, id): the rows the batch form keeps."""
    least = interval // MICROSECOND + (0 if inclusive else 1)
    rows = _in_order(df, key, time, row_id, Periods(least), "id bigint, place bigint", F.lit(None), F.lit(None))
    return rows.filter("place = 1").drop("place")


def stream_click_cap(
    df: DataFrame, key: str, time: str, row_id: str, cap: int = 10, ttl: timedelta | None = None
) -> DataFrame:
    """(key, id, outcome) with `passed` and `flagged` rows; further rows are dropped silently."""
    least = None if ttl is None else ttl // MICROSECOND
    rows = _in_order(df, key, time, row_id, Periods(least), "id bigint, place bigint", F.lit(None), F.lit(None))
    outcome = F.when(F.col("place") <= cap, PASSED).otherwise(FLAGGED)
    return rows.filter(F.col("place") <= cap + 1).withColumn("outcome", outcome).drop("place")


def stream_sequence(
    df: DataFrame, key: str, kind: str, time: str, row_id: str, first: str, then: str, within: timedelta
) -> DataFrame:
    """(key, id, started_at, done_at, outcome) as in the batch form, broken ones left out."""
    columns = "id bigint, started_at timestamp, done_at timestamp, outcome string"
    rows = _in_order(
        df, key, time, row_id, Sequence(first, then, within), columns, F.col(kind), F.lit(None)
    )
    return rows.filter(F.col("outcome") != BROKEN)


def stream_match(
    left: DataFrame, right: DataFrame, key: str, time: str, row_id: str, timeout: timedelta, bound: str,
    left_only: str = "left_only", right_only: str = "right_only",
) -> DataFrame:
    """(key, left_id, left_time, right_id, right_time, outcome) as in the batch form.

    The two streams become one with a side tag; `bound` is its watermark.
    """
    both = left.select(key, time, row_id, F.lit("0").alias("_side")).unionByName(
        right.select(key, time, row_id, F.lit("1").alias("_side"))
    )
    both = both.withWatermark(time, bound)
    columns = (
        "left_id bigint, left_time timestamp, right_id bigint, right_time timestamp, outcome string"
    )
    processor = TwoStreamMatch(timeout, left_only, right_only)
    return _in_order(both, key, time, row_id, processor, columns, F.col("_side"), F.lit(None))
