"""Exact deduplication of normalised texts by counted fingerprints and byte verification.

Each partition gathers the 64-bit fingerprints of its texts in counting quotient filters, one for each range of high bits. A filter
cuts a fingerprint into a quotient, which is not stored but is the place of its run, and a remainder; a run holds its
remainders in order, and a remainder that came more than once has a counter. Filters of one range merge without loss,
whatever their numbers of quotients are, since both are in order of the whole fingerprint. Only fingerprints counted
more than once are looked at again: their texts are compared byte by
byte, by grouping on the text itself. Copies are combined before every shuffle, so a group of any size is one row
for each task that saw it.

Nulls in `text` count as empty, and empty texts are copies of one another. Of equal texts the smallest key stays; a null
key counts as larger than all others. Of several rows with that key and text one stays. An empty table gives an
empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, staged, text_or_empty

#: A fingerprint has 64 bits; its highest bits say which range it belongs to.
RANGE_BITS = 10
#: Fingerprints that a partition gathers before it writes a list.
FILTER_SIZE = 2_000_000
#: Fewer fingerprints than this are not worth a merge of their own.
MERGE_FROM = 65_536
#: Tasks that the rows of one group are dealt to, at most; one bit of a long each.
SALTS = 64


def normalised(text: str | Column) -> Column:
    """Every run of blanks as one space; a null is empty."""
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def build_filter(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints and their counts. Merges such lists when given counts."""
    order = np.argsort(fingerprints, kind="stable")
    keys = fingerprints[order]
    counts = np.ones(len(keys), np.int64) if counts is None else counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class QuotientFilter(NamedTuple):
    """The fingerprints of one range, counted. Of each quotient `runs` says how many remainders it has."""

    shift: int  # bits of a remainder
    runs: np.ndarray
    remainders: np.ndarray
    places: np.ndarray  # of the remainders that came more than once, in order
    counts: np.ndarray  # and how often they came

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """From sorted distinct fingerprints that share their RANGE_BITS high bits."""
        low = fingerprints & np.uint64((1 << (64 - RANGE_BITS)) - 1)
        # One to two remainders for each quotient on average.
        quotient_bits = min(64 - RANGE_BITS, max(0, len(low).bit_length() - 1))
        shift = 64 - RANGE_BITS - quotient_bits
        runs = np.bincount((low >> np.uint64(shift)).astype(np.int64), minlength=1 << quotient_bits)
        places = np.flatnonzero(counts > 1)
        return cls(shift, runs, low & np.uint64((1 << shift) - 1), places, counts[places])

    def fingerprints(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted fingerprints of range `part` and their counts."""
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        counts = np.ones(len(self.remainders), np.int64)
        counts[self.places] = self.counts
        high = np.uint64(part) << np.uint64(64 - RANGE_BITS)
        return high | quotients << np.uint64(self.shift) | self.remainders, counts

    def packed(self) -> bytes:
        """Run lengths in the least width that holds them, remainders cut to whole bytes, then places and counters."""
        width = next(w for w in (1, 2, 4, 8) if int(self.runs.max(initial=0)) < 1 << 8 * w)
        wide = -(-self.shift // 8)
        head = np.array([self.shift, width, len(self.runs), len(self.remainders), len(self.places)], "<i8")
        cut = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        return b"".join((head.tobytes(), self.runs.astype(f"<u{width}").tobytes(), np.ascontiguousarray(cut).tobytes(),
                         self.places.astype("<u4").tobytes(), self.counts.astype("<i8").tobytes()))

    @classmethod
    def unpacked(cls, data: bytes) -> QuotientFilter:
        shift, width, quotients, n, repeated = np.frombuffer(data, "<i8", 5).tolist()
        wide, at = -(-shift // 8), 40
        runs = np.frombuffer(data, f"<u{width}", quotients, at).astype(np.int64)
        at += width * quotients
        remainders = np.zeros((n, 8), np.uint8)
        remainders[:, :wide] = np.frombuffer(data, np.uint8, wide * n, at).reshape(n, wide)
        at += wide * n
        places = np.frombuffer(data, "<u4", repeated, at).astype(np.int64)
        counts = np.frombuffer(data, "<i8", repeated, at + 4 * repeated)
        return cls(shift, runs, remainders.view("<u8").ravel().astype(np.uint64), places, counts)


class Counted:
    """Fingerprints with counts. What was added is merged in once it is as much as what is held, so each is sorted a few times."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.settled = 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > max(MERGE_FROM, 2 * self.settled):
            self._merge()

    def _merge(self) -> None:
        self.parts = [build_filter(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.size = self.settled = len(self.parts[0][0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All of them, sorted and distinct; none are held after that."""
        self._merge()
        out, self.parts, self.size, self.settled = self.parts[0], [], 0, 0
        return out


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """The values of the only column, `fp`, that occur more than once: column `fp`."""
    shift = np.uint64(64 - RANGE_BITS)

    def cut(keys, counts):
        parts = (keys >> shift).astype(np.int64)
        at = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1])))
        ends = np.append(at[1:], len(keys))
        filters = [QuotientFilter.of(keys[a:e], counts[a:e]).packed() for a, e in zip(at, ends)]
        return pa.RecordBatch.from_arrays([pa.array(parts[at]), pa.array(filters, pa.binary())], names=["part", "filter"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counted()
        for b in batches:
            new = np.asarray(b.column(0)).view(np.uint64)
            held.add(new, np.ones(len(new), np.int64))
            if held.size >= FILTER_SIZE:
                yield cut(*held.take())
        if held.size:
            yield cut(*held.take())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = Counted(), None
        for b in batches:
            for range_, packed in zip(b.column("part").to_pylist(), b.column("filter")):
                if range_ != part and held.size:
                    yield repeated(*held.take())
                part = range_
                held.add(*QuotientFilter.unpacked(packed.as_py()).fingerprints(part))
        if held.size:
            yield repeated(*held.take())

    def repeated(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys[counts > 1].view(np.int64))], names=["fp"])

    # A range's filters follow each other in one task, which holds one range at a time and one batch of filters.
    filters = fingerprints.mapInArrow(build, "part long, filter binary")
    return filters.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "fp long")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    read = docs.select(F.col(f"`{key}`").alias("_key"), normalised(f"`{text}`").alias("_norm"))
    marks = staged(read.select("_key", F.xxhash64("_norm").alias("fp"), F.sha2("_norm", 256).alias("sha"),
                               F.monotonically_increasing_id().alias("row")), "exact")
    suspects = staged(repeated_fingerprints(marks.select("fp")), "exact")
    # Byte verification of the suspects only: grouping compares whole texts.
    texts = read.select("_norm", F.xxhash64("_norm").alias("fp")).join(suspects, "fp", "left_semi")
    equal = texts.groupBy("_norm").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.sha2("_norm", 256).alias("sha"))
    # A group lies in up to SALTS tasks when its rows are told its size: it has one row for each salt that its members drew.
    marks = marks.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "row"))
    drawn = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))).alias("drawn")
    groups = (marks.groupBy("sha").agg(first.alias("first"), F.count(F.lit(1)).alias("n"), drawn)
              .where("n > 1").join(equal, "sha", "left_semi"))
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit("drawn", s) == 1)
    found = marks.join(groups.select("sha", "first", "n", F.explode(salts).alias("salt")), ["sha", "salt"], "left")
    alone = F.col("n").isNull()
    return found.select(F.col("_key").alias(key), F.when(alone, F.col("_key")).otherwise(F.col("first._key")).alias("keep_id"),
                        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                        (alone | (F.col("row") == F.col("first.row"))).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns, whatever these are called."""
    stay = exact_groups(docs, key, text).where("kept").select(F.col(f"`{key}`").alias("_key"), F.col("text_sha256").alias("_sha")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{key}`").alias("_key"),
                       F.sha2(normalised(f"`{text}`"), 256).alias("_sha"))
    found = rows.join(stay, rows["_key"].eqNullSafe(stay["_key"]) & (rows["_sha"] == stay["_sha"]), "left_semi")
    # Of rows with one key and text one stays; it is rare that there are any, so the rows aren't shuffled for it unasked.
    if not rows.groupBy("_key", "_sha").count().where("count > 1").isEmpty():
        found = found.dropDuplicates(["_key", "_sha"])
    return found.select("_doc.*")
