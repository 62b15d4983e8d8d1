"""Jaccard join of word n-gram sets by partitioning the universe.

Two sets of sizes r and s reach the threshold only if they differ in at most H(r + s) elements. The hashed universe is cut
into more segments than that, so some segment has the same subset in both (pigeonhole). Sets are handled in bands of
size; every set indexes its segments' subsets for its own band and for the smaller bands that may hold a partner.
Empty subsets are shared by chance and are not indexed: `Plan` allots some segments more, as many as make it
rare that a set has more empty ones, at the least cost in entries. Sets that do have more also index
the one-deletion neighbourhood of every subset: there, a segment with one difference still meets. A pair can still miss only
if each segment that is not empty in both differs in two elements, or in one that is alone there; both sets then have at least
two empty segments more than the plan's, and at most half as many segments with two elements or more as elements may
differ. Such sets, which hashing makes very rare, index their empty segments too, so no pair is lost.

Sets that meet are candidates. Equal sets are one class from the start. First all members of a meeting are compared
with one of them only; then, where the components of a meeting still differ, with the nearest member of
another component; then every pair that is left across components, for which a meeting is cut into blocks of like sizes and
every allowed pair of blocks is compared by itself, in bounded memory. Pairs are first held to a lower bound of their difference (counts per hash class), then verified on
the whole sets. So a group of copies or near copies is never expanded into its pairs, and no link is lost. No partner
list is capped.

A text with fewer words than n is one shingle; a text without words, or a null, has an empty set and links with nothing.
Null keys are kept; a component's id is its smallest key, or null if it has no other. Keys may be repeated, or be structs:
texts are found again by 128 bits of hash and never by key. Repeated rows are equal sets. An
empty table gives an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from tidemark.llm.common import staged, text_or_empty, with_bucket_starts
from tidemark.llm.components import components

#: Similarity in hundredths, words in a shingle, growth of the size bands.
LEAST, WORDS, BAND = 80, 5, 1.25
#: Hash classes whose counts bound the difference of two sets from below: few for a first look, many for a sharp one.
COARSE, FINE = 64, 512
#: Entries that a task gathers before it hands them on, and hash buckets for each shuffle partition.
HELD, BUCKETS = 1_000_000, 4
#: Members of meetings in a row, in a block, and those that are compared at once where their blocks are small.
ROW, BLOCK, MEMBERS = 2000, 4096, 20_000
#: Hash cells in which the members of one size are counted.
CELLS = 16
_WORD_CACHE = 200_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams, A-Z lower-cased."""
    words = text.encode().lower().split()  # of bytes: exactly A-Z, and exactly the six blanks
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if len(h) < n:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64)
    # Odd multipliers, one for each place, then one scramble of the sum.
    odd, end = mixed(np.arange(1, n + 1, dtype=np.uint64) * _M1) | np.uint64(1), len(h) - n + 1
    acc = h[:end] * odd[0]
    for i in range(1, n):
        acc += h[i : end + i] * odd[i]
    acc = np.sort(mixed(acc))
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def set_name(s: np.ndarray) -> int:
    """The 64-bit name of a set, signed."""
    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0])


def class_counts(s: np.ndarray, classes: int) -> bytes:
    """Counts per class; cutting them at 255 only weakens the bound."""
    return np.minimum(np.bincount((s >> np.uint64(20)).astype(np.int64) % classes, minlength=classes), 255).astype(np.uint8).tobytes()


def _counts(column, classes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, classes).astype(np.int16)


def most_different(total: int | np.ndarray, least: int = LEAST):
    """The largest symmetric difference of two sets of `total` elements together that reach the threshold."""
    return total - 2 * -(-least * total // (100 + least))


def band_of(size: int) -> int:
    return int(math.log(size) / math.log(BAND) + 1e-9)


class Plan(NamedTuple):
    segments: int
    spare: int  # more empty segments than this call for deletions


@lru_cache(maxsize=None)
def plan_of(band: int, least: int = LEAST) -> Plan:
    """Segments for pairs whose smaller set lies in a band, allotted at the least expected number of entries."""
    low, high = math.ceil(BAND**band - 1e-9), math.ceil(BAND ** (band + 1) - 1e-9)
    total = high + high * 100 // least
    differ = max(int(most_different(t, least)) for t in range(max(2, total - 20), total + 1))
    size, best = max(1.0, (low * high) ** 0.5), None
    for spare in range(differ + 2):
        m = differ + 1 + spare
        mean = m * (1 - 1 / m) ** size if m > 1 else 0.0
        term = tail = math.exp(-mean)
        for k in range(1, spare + 1):
            term *= mean / k
            tail += term
        cost = m + max(0.0, 1 - tail) * size
        if best is None or cost < best[0]:
            best = (cost, Plan(m, spare))
    return best[1]


def entries(s: np.ndarray, least: int = LEAST, bands: tuple[int, ...] | None = None) -> np.ndarray:
    """The signatures under which a set is indexed: one hash for each band, segment and subset."""
    if not len(s):
        return s
    if bands is None:
        bands = tuple(range(band_of(-(-least * len(s) // 100)), band_of(len(s)) + 1))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(s ^ _M1))))
    found = []
    for band in bands:
        m, spare = plan_of(band, least)
        edges = np.searchsorted(s, (np.arange(1, m, dtype=np.float64) * (2.0**64 / m)).astype(np.uint64))
        edges = np.concatenate(([0], edges, [len(s)]))
        subset, n = sums[edges[1:]] - sums[edges[:-1]], np.diff(edges)
        tag = mixed(np.arange(m, dtype=np.uint64) + np.uint64((band + 1) << 40))
        some = n > 0
        empty = m - int(some.sum())
        found.append(mixed(subset[some] ^ tag[some]))
        if empty > spare:
            segment = np.repeat(np.arange(m), n)
            without = subset[segment] - mixed(s ^ _M1)
            lonely = n[segment] == 1
            found.append(mixed(without[~lonely] ^ tag[segment[~lonely]]))
            if empty > spare + 1 and 2 * int((n > 1).sum()) <= m - 1 - spare:
                found.append(mixed(tag[~some]))
    return np.concatenate(found)


def describe(docs: DataFrame) -> DataFrame:
    """(_key, _h1, _h2, _text) -> (_key, _h1, _h2, n, node, coarse, fine): size, name and class counts of every document's set."""
    schema = StructType([docs.schema["_key"]]).add("_h1", LongType()).add("_h2", LongType()).add("n", LongType()).add("node", LongType()).add("coarse", BinaryType()).add("fine", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node, coarse, fine = [], [], [], []
            for text in b.column(3):
                s = shingles(text.as_py())
                n.append(len(s))
                node.append(set_name(s) if len(s) else None)
                coarse.append(class_counts(s, COARSE) if len(s) else None)
                fine.append(class_counts(s, FINE) if len(s) else None)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                                              pa.array(coarse, pa.binary()), pa.array(fine, pa.binary())], names=schema.names)

    return docs.select("_key", "_h1", "_h2", "_text").mapInArrow(run, schema)


def meetings(docs: DataFrame) -> DataFrame:
    """(meeting, least, nodes): packed names of the sets that share an entry, two or more, at most `ROW` in a row; the same names meet once."""
    parts = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(sigs, nodes) -> pa.RecordBatch:
        sig, node = np.concatenate(sigs), np.repeat(np.array([n for n, _ in nodes], np.int64), [k for _, k in nodes])
        bucket = (sig >> np.uint64(33)).astype(np.int64) % parts
        order = np.argsort(bucket, kind="stable")
        sig, node, bucket = sig[order], node[order], bucket[order]
        at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        ends = np.append(at[1:], len(bucket))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[at]), pa.array([sig[a:e].tobytes() for a, e in zip(at, ends)], pa.binary()),
             pa.array([node[a:e].tobytes() for a, e in zip(at, ends)], pa.binary())], names=["bucket", "sigs", "nodes"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, nodes, held, seen = [], [], 0, set()
        for b in batches:
            for text in b.column(0):
                s = shingles(text.as_py())
                if not len(s) or (name := set_name(s)) in seen:
                    continue  # an equal set of this partition stands for it
                if len(seen) < 2_000_000:
                    seen.add(name)
                sigs.append(entries(s))
                nodes.append((name, len(sigs[-1])))
                held += len(sigs[-1])
                if held > HELD:
                    yield pack(sigs, nodes)
                    sigs, nodes, held = [], [], 0
        if sigs:
            yield pack(sigs, nodes)

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, nodes = [], []
        for b in batches:
            sigs += [np.frombuffer(x.as_py(), np.uint64) for x in b.column("sigs")]
            nodes += [np.frombuffer(x.as_py(), np.int64) for x in b.column("nodes")]
        sig, node = np.concatenate(sigs), np.concatenate(nodes)
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])))
        sig, node = sig[new], node[new]
        first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        ends = np.append(first[1:], len(sig))
        known, out = set(), []
        for a, e in zip(first[ends - first > 1], ends[ends - first > 1]):
            name = set_name(node[a:e])
            if name not in known:
                known.add(name)
                out += [(name, node[a], node[i : min(i + ROW, e)].tobytes()) for i in range(a, e, ROW)]
            if len(out) >= ROW:
                yield rows(out)
                out = []
        yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        names, leasts, packed = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(leasts, pa.int64()), pa.array(packed, pa.binary())],
                                          names=["meeting", "least", "nodes"])

    packed = docs.select("_text").mapInArrow(index, "bucket long, sigs binary, nodes binary")
    return packed.groupBy("bucket").applyInArrow(meet, "meeting long, least long, nodes binary").distinct()


def _pairs_with_first(groups: DataFrame) -> DataFrame:
    """(a, b): every other member of a meeting with its least one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.frombuffer(x.as_py(), np.int64) for x in b.column(1)]
            if parts:
                both = np.stack((np.repeat(np.asarray(b.column(0)), [len(p) for p in parts]), np.concatenate(parts)))
                both = np.unique(both[:, both[0] != both[1]], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0].copy()), pa.array(both[1].copy())], names=["a", "b"])

    return groups.select("least", "nodes").mapInArrow(run, "a long, b long").distinct()


def _near(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs that sizes and class counts allow."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("coarse").alias(f"c{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                na, nb = np.asarray(b.column(2)), np.asarray(b.column(4))
                ok = np.abs(_counts(b.column(3), COARSE) - _counts(b.column(5), COARSE)).sum(1) <= most_different(na + nb, least)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "ca", "nb", "cb")
    return met.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, marks: DataFrame, least: int) -> DataFrame:
    """The pairs that reach the threshold, by their whole sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # One text stands for each set, found by its hashes: keys may be null or repeated. Copies are combined before the shuffle.
    one = marks.where("node is not null").groupBy("node").agg(F.min(F.struct("_h1", "_h2")).alias("one"))
    found = one.join(wanted, "node").select("node", "one._h1", "one._h2")
    first = docs.join(found.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi").groupBy("_h1", "_h2").agg(F.first("_text").alias("_text"))
    texts = staged(first.join(found, ["_h1", "_h2"]).select("node", "_text"), "set-join")
    side = lambda x: texts.select(F.col("node").alias(x), F.col("_text").alias(f"t{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}

        def of(node: int, text) -> np.ndarray:
            if node not in kept:
                if len(kept) > 64:
                    kept.clear()
                kept[node] = shingles(text.as_py())
            return kept[node]

        for b in batches:
            ok = []
            for a, c, ta, tc in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                x, y = of(a, ta), of(c, tc)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= least * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return met.mapInArrow(run, "a long, b long")


def blocks_of(rows: DataFrame, size: int) -> DataFrame:
    """Adds `block`, numbered from 0 in order of n within a meeting: about `size` members each, at most twice that but for chance.

    Members are counted in cells of (n, hash) before any shuffle of theirs; a cell that is larger than a block is dealt by a second hash.
    """
    cell = ["meeting", "n", "cell"]
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("node"), F.lit(CELLS)))
    counted = with_bucket_starts(rows.groupBy(*cell).agg(F.count("*").alias("count")), ["meeting"], ["n", "cell"], "count", "start")
    placed = counted.select(*cell, F.floor(F.col("start") / size).alias("block"), F.ceil(F.col("count") / size).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    return rows.join(placed, cell).withColumn("block", F.col("block") + part).drop("cell", "parts")


def block_pairs(blocks: DataFrame, least: int) -> DataFrame:
    """(meeting, low, high): blocks of one meeting, or one block twice, that may hold a pair by their sizes and components."""
    about = blocks.groupBy("meeting", "block").agg(F.min("n").alias("from"), F.max("n").alias("to"),
                                                   F.min("root").alias("one"), F.max("root").alias("other"))
    side = lambda x: about.select("meeting", *[F.col(c).alias(f"{x}_{c}") for c in ("block", "from", "to", "one", "other")])
    mixed_roots = F.expr("least(low_one, high_one) != greatest(low_other, high_other)")
    # Neighbouring blocks may overlap in size, so either side may hold the smaller set.
    sizes = F.expr(f"100 * low_to >= {least} * high_from AND 100 * high_to >= {least} * low_from")
    return (side("low").join(side("high"), "meeting").where("low_block <= high_block").where(mixed_roots).where(sizes)
            .select("meeting", F.col("low_block").alias("low"), F.col("high_block").alias("high")))


def _pairs_across(groups: DataFrame, roots: DataFrame, nodes: DataFrame, least: int, nearest: bool, block: int = BLOCK) -> DataFrame:
    """(a, b): near pairs of different components within a meeting; with `nearest` one for each member at most.

    A meeting is cut into blocks in order of size, and every allowed pair of blocks is compared by itself: a task streams over its
    pairs of blocks and holds one of them, or several small ones of `MEMBERS` members together.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                parts = [np.frombuffer(x.as_py(), np.int64) for x in b.column(1)[at : at + 64]]
                meeting = np.repeat(np.asarray(b.column(0)[at : at + 64]), [len(p) for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array(meeting), pa.array(np.concatenate(parts))], names=["meeting", "node"])

    rows = groups.select("meeting", "nodes").mapInArrow(unpack, "meeting long, node long").join(roots, "node", "left")
    rows = staged(rows.select("meeting", "node", F.coalesce("root", "node").alias("root")), "set-join")
    split = rows.groupBy("meeting").agg((F.min("root") != F.max("root")).alias("split")).where("split").select("meeting")
    sized = rows.join(split, "meeting", "left_semi").join(nodes.select("node", "n"), "node")
    blocks = staged(blocks_of(sized, block), "set-join")
    pairs = block_pairs(blocks, least)
    # A block goes to each of its pairs; a pair of a block with itself takes it once.
    sides = F.when(F.col("low") == F.col("high"), F.array("low")).otherwise(F.array("low", "high"))
    wanted = pairs.select("meeting", "low", "high", F.explode(sides).alias("block"))
    dealt = blocks.join(wanted, ["meeting", "block"]).join(nodes.select("node", "coarse", "fine"), "node")

    def compare(t: pa.Table) -> pa.RecordBatch:
        meeting, low, high, side, node, root, n = (np.asarray(t.column(c)) for c in ("meeting", "low", "high", "block", "node", "root", "n"))
        counts = _counts(t.column("coarse"), COARSE), _counts(t.column("fine"), FINE)
        new = (meeting[1:] != meeting[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        first = np.flatnonzero(np.concatenate(([True], new)))
        ends = np.repeat(np.append(first[1:], len(node)), np.diff(np.append(first, len(node))))
        closest, partner = np.full(len(node), 1 << 60), np.zeros(len(node), np.int64)
        found = [(np.zeros(0, np.int64),) * 3]
        left, step = np.arange(len(node)), 0
        # All members with the one `step` places on, in order of size within their pair of blocks, at once.
        while len(left):
            step += 1
            left = left[left + step < ends[left]]
            left = left[n[left] * 100 >= least * n[left + step]]
            i = left[(root[left] != root[left + step]) & ((low[left] == high[left]) | (side[left] != side[left + step]))]
            for c in counts:  # the sharp look only at what the first one leaves
                apart = np.abs(c[i] - c[i + step]).sum(1)
                near = apart <= most_different(n[i] + n[i + step], least)
                i, apart = i[near], apart[near]
            if nearest:
                closer = apart < closest[i]
                closest[i[closer]], partner[i[closer]] = apart[closer], node[i[closer] + step]
            else:
                found.append((node[i], node[i + step], apart.astype(np.int64)))
        if nearest:
            i = np.flatnonzero(closest < 1 << 60)
            found.append((node[i], partner[i], closest[i]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["node", "other", "apart"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            # Hand on what is held at the last border between pairs of blocks, once that is enough.
            if sum(x.num_rows for x in held) + b.num_rows > MEMBERS and b.num_rows:
                t = pa.Table.from_batches([*held, b])
                at = np.asarray(t.column("meeting")), np.asarray(t.column("low")), np.asarray(t.column("high"))
                borders = np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0))
                if len(borders):
                    yield compare(t.slice(0, borders[-1] + 1))
                    t = t.slice(borders[-1] + 1)
                held = t.to_batches()
            else:
                held.append(b)
        if sum(x.num_rows for x in held):
            yield compare(pa.Table.from_batches(held))

    border = ["meeting", "low", "high"]
    seen = dealt.repartition(*border).sortWithinPartitions(*border, "n").mapInArrow(across, "node long, other long, apart long")
    if nearest:
        seen = seen.groupBy("node").agg(F.min(F.struct("apart", "other")).alias("best")).select("node", "best.other")
    return seen.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key that links reach)."""
    body = text_or_empty(f"`{text}`")
    read = docs.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(body).alias("_h1"), F.xxhash64(F.lit("second"), body).alias("_h2"),
                       body.alias("_text"))
    marks = staged(describe(read), "set-join")
    nodes = staged(marks.where("node is not null").groupBy("node")
                   .agg(*[F.first(c).alias(c) for c in ("n", "coarse", "fine")]), "set-join")
    marks = marks.drop("coarse", "fine")
    groups = staged(meetings(read), "set-join")
    seen = staged(_near(_pairs_with_first(groups), nodes, least), "set-join")
    links = staged(_verified(seen, read, marks, least), "set-join")
    roots = components(links)
    # The nearest of other components first: where there are links across, they leave few components to compare in full.
    for nearest in (True, False):
        more = staged(_pairs_across(groups, roots, nodes, least, nearest, block).join(seen, ["a", "b"], "left_anti"), "set-join")
        if not more.isEmpty():
            seen = seen.unionAll(more)
            links = staged(links.unionAll(_verified(more, read, marks, least)), "set-join")
            roots = components(links)
    rooted = marks.join(roots, "node", "left").select("_key", "n", F.coalesce("root", "node").alias("root"))
    least_keys = rooted.where("root is not null").groupBy("root").agg(F.min("_key").alias("least"))
    return (rooted.join(least_keys, "root", "left")
            .select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "_key").alias("component_id")))
