"""Repeated passages by anchored windows, grouped by hashes of ever longer pieces. It stands for a depth-limited radix sort of
suffixes, but orders no suffixes.

Of every text the windows of `width` bytes are to be found that start at more than one place. Each window picks an anchor,
the position of the least hash of GRAM bytes inside it. The choice depends on the window's bytes alone, so equal
windows pick the same place, and consecutive windows mostly share theirs: a run of windows with one anchor is
one node. The nodes are grouped in passes by their digit, in each pass a longer piece of text around the anchor that all
windows of a node have in common (its core):

* a core that occurs once drops out: none of its windows is repeated;
* nodes whose whole extents are equal are repeated windows, all of them; one of the nodes stays as a witness;
* what is left, the nodes at the ends of repeated passages, is split into smaller blocks of windows and grouped by the next,
  longer digit. In the last pass a node is one window and its digit is the whole window: equal groups are exactly
  the repeated windows.

Only the first pass sees all nodes (about one for each 170 bytes). Cores are counted with partial sums, and the rows of a core
that very many share are picked where they lie and not gathered by core, so a passage that a third of all documents share is no
task of its own. Pieces of text are compared by 128-bit hashes.

A null text counts as empty. Repeated rows are documents of their own, so all their windows are repeated; spans belong to a
text's content, whatever its key. Texts shorter than `width` are kept whole. An empty table gives an empty result.
Columns other than the keys and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from tidemark.llm.common import staged, text_or_empty

GRAM, WIDTH = 64, 400
#: Sizes of the blocks of windows in the passes after the first one.
BLOCKS = (64, 8, 1)
#: A core with more than one in HEAVY of the rows that meet is picked by a broadcast; fewer than HEAVY cores can be so heavy.
HEAVY = 4096
#: Windows of a long text that are looked at together.
SLAB = 1 << 20
_BYTES = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.random.default_rng(64).integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)
NODE = "h1 long, h2 long, p long, lo int, hi int, core long, f1 long, f2 long"
_NODE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("p", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()),
                   ("core", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM consecutive bytes, by doubling."""
    h, step, k = _BYTES[data], 1, 0
    while step < GRAM:
        h = h[:-step] * _ODD[k] + h[step:]
        h ^= h >> np.uint64(31)
        step, k = 2 * step, k + 1
    return h * _ODD[7]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values if step == width else np.minimum(values[: len(values) - (width - step)], values[width - step :])


def anchor_runs(data: bytes, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in order with the first and last window of each run, and the hash of the anchor's GRAM bytes."""
    raw, windows = np.frombuffer(data, np.uint8), len(data) - width + 1
    parts = []
    for at in range(0, max(0, windows), SLAB):
        upto = min(windows, at + SLAB)
        h = gram_hashes(raw[at : upto + width - 1])
        # The place in the low bits makes the leftmost of equal hashes the least.
        low = sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), width - GRAM + 1)
        place = (low & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        parts.append((place[first] + at, first + at, last + at, h[place[first]]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _nodes(h1, h2, p, lo, hi, core, full: list[bytes]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(full), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(h1, np.int64)), pa.array(np.asarray(h2, np.int64)), pa.array(np.asarray(p, np.int64)),
         pa.array(np.asarray(lo, np.int32)), pa.array(np.asarray(hi, np.int32)), pa.array(np.asarray(core, np.int64)),
         pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], schema=_NODE)


def first_pass(texts: DataFrame, width: int) -> DataFrame:
    """Nodes of all texts: windows p - hi to p - lo, their core, and the hash of their extent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            ones, twos = np.asarray(b.column(0)), np.asarray(b.column(1))
            held, full, count = [], [], 0
            for row, data in enumerate(b.column(2)):
                data, name = data.as_py(), (int(ones[row]), int(twos[row]))
                seen[name] += 1
                if seen[name] > 2:  # two of a kind prove the repetition; more copies add nothing
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                p, first, last, core = anchor_runs(data, width)
                if not len(p):
                    continue
                view = memoryview(data)
                full += [xxhash.xxh3_128_digest(view[s : e + width]) for s, e in zip(first.tolist(), last.tolist())]
                n = len(p)
                held.append((np.full(n, ones[row]), np.full(n, twos[row]), p, p - last, p - first, core.view(np.int64)))
                count += n
                if count > 200_000:
                    yield _nodes(*map(np.concatenate, zip(*held)), full)
                    held, full, count = [], [], 0
            if held:
                yield _nodes(*map(np.concatenate, zip(*held)), full)

    return texts.where(F.octet_length("body") >= width).mapInArrow(run, NODE)


def next_pass(parents: DataFrame, width: int, block: int) -> DataFrame:
    """Nodes of at most `block` windows, from (h1, h2, p, lo, hi, from, extent), where `extent` starts at `from`."""
    top = width - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, full = [], []
            for r in b.to_pylist():
                view, start, p = memoryview(r["extent"]), r["from"], r["p"]
                for number in range(r["lo"] // block, r["hi"] // block + 1):
                    b0, b1 = number * block, min(top, number * block + block - 1)
                    lo, hi = max(r["lo"], b0), min(r["hi"], b1)
                    core = xxhash.xxh3_64_intdigest(view[p - b0 - start : p - b1 + width - start], seed=b0 * 1024 + block)
                    rows.append((r["h1"], r["h2"], p, lo, hi, core))
                    full.append(xxhash.xxh3_128_digest(view[p - hi - start : p - lo + width - start]))
            if rows:
                h1, h2, p, lo, hi, core = zip(*rows)
                yield _nodes(h1, h2, p, lo, hi, np.array(core, np.uint64).view(np.int64), full)

    return parents.mapInArrow(run, NODE)


def _meeting(rows: DataFrame) -> DataFrame:
    """The rows whose core another row has too. Rows of a heavy core stay in the tasks that read them; only the others are dealt by core."""
    counts = staged(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeats")
    most = (counts.agg(F.sum("n")).first()[0] or 0) // HEAVY
    heavy = F.broadcast(counts.where(F.col("n") > most).select("core"))
    others = rows.join(heavy, "core", "left_anti").join(counts.where(F.col("n") <= most).select("core"), "core", "left_semi")
    return rows.join(heavy, "core", "left_semi").unionAll(others)


def _decide(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repeated nodes (h1, h2, p, lo, hi), and those whose windows the next pass must tell apart."""
    same = ["core", "lo", "hi", "f1", "f2"]
    left = staged(_meeting(nodes), "repeats")
    groups = staged(left.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h1", "h2", "p")).alias("one")), "repeats")
    repeated = left.join(groups.where("n > 1").select(*same), same, "left_semi").select("h1", "h2", "p", "lo", "hi")
    open_ = _meeting(groups.drop("n")).select("one.h1", "one.h2", "one.p", "lo", "hi")
    return repeated, open_


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Covered byte ranges (h1, h2, start, end), possibly overlapping, of (h1, h2, body)."""
    span = lambda df: df.select("h1", "h2", (F.col("p") - F.col("hi")).alias("start"), (F.col("p") - F.col("lo") + width).alias("end"))
    repeated, open_ = _decide(staged(first_pass(texts, width), "repeats"))
    spans, open_ = span(repeated), staged(open_, "repeats")
    wanted = open_.groupBy("h1", "h2").agg(F.collect_list(F.struct("p", "lo", "hi")).alias("nodes"))
    # Copies of a text are merged in each task before they are shuffled, so those of one text are no task of their own.
    one = texts.dropDuplicates(["h1", "h2"]).join(wanted, ["h1", "h2"])
    cut = F.col("body").substr(F.col("at.p") - F.col("at.hi") + 1, (F.col("at.hi") - F.col("at.lo") + width).cast("long"))
    extents = staged(one.withColumn("at", F.explode("nodes"))
                     .select("h1", "h2", "at.p", (F.col("at.p") - F.col("at.hi")).alias("from"), "at.lo", "at.hi", cut.alias("extent")), "repeats")
    parents = extents
    for block in BLOCKS:
        repeated, open_ = _decide(staged(next_pass(parents, width, block), "repeats"))
        spans = spans.unionAll(span(repeated))
        open_ = staged(open_, "repeats")
        parents = open_.join(extents.select("h1", "h2", "p", "from", "extent", F.col("lo").alias("_lo"), F.col("hi").alias("_hi")), ["h1", "h2", "p"]).where("lo >= _lo and hi <= _hi").drop("_lo", "_hi")
    return spans


def remove_repeats(docs: DataFrame, width: int = WIDTH, keys: tuple[str, ...] = ("doc_id",), text: str = "text",
                   with_text: bool = False) -> DataFrame:
    """One row per document: keys, n_bytes, n_removed, n_spans, kept_sha256 [, kept: the remaining bytes]."""
    body = text_or_empty(f"`{text}`")
    read = docs.select(*[F.col(f"`{k}`") for k in keys], F.xxhash64(body).alias("h1"), F.xxhash64(F.lit("second"), body).alias("h2"),
                       body.cast("binary").alias("body"))
    spans = repeated_spans(read.select("h1", "h2", "body"), width)
    lists = staged(spans.distinct().groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "repeats")
    met = read.join(lists, ["h1", "h2"], "left").select(*[F.col(f"`{k}`") for k in keys], "spans", "body")
    schema = StructType(met.schema.fields[:-2])
    for name, kind in (("n_bytes", LongType()), ("n_removed", LongType()), ("n_spans", LongType()), ("kept_sha256", StringType())):
        schema = schema.add(name, kind)
    if with_text:
        schema = schema.add("kept", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for spans, data in zip(b.column(b.num_columns - 2), b.column(b.num_columns - 1)):
                data, parts, at, removed, runs = data.as_py(), [], 0, 0, 0
                ends = sorted((s["start"], s["end"]) for s in spans.as_py() or ())
                i = 0
                while i < len(ends):
                    start, end = ends[i]
                    while i < len(ends) and ends[i][0] <= end:
                        end = max(end, ends[i][1])
                        i += 1
                    parts.append(data[at:start])
                    at, removed, runs = end, removed + end - start, runs + 1
                parts.append(data[at:])
                kept = b"".join(parts)
                found.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            new = list(zip(*found)) if found else [[]] * 5
            arrays = [pa.array(new[i], pa.int64()) for i in range(3)] + [pa.array(new[3], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 2)] + arrays
                                             + ([pa.array(new[4], pa.binary())] if with_text else []), names=schema.names)

    return met.mapInArrow(run, schema)
