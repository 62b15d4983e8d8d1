"""Best-fit packing of token sequences by hierarchical residual packing.

Every partition packs its own items best fit, longest first. Bins that are nearly full are final. The others travel
on as items of their fill: a tree of rounds brings the bins of several partitions together and fits them into
one another, until one partition holds all that is left or a round gains nothing. A task never holds more than
`BLOCK` items, so no round grows with the table, and what travels is the little that the round before left open.
Each round is written to the shared folder: a task that runs again can't move an item to another bin.

Nulls in `text` count as empty: such a document is its end token alone. Nulls in other columns are kept, repeated
rows are packed each for itself, an empty table gives an empty result. Columns of `docs` other than those named by
`keys` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructType

from tidemark.llm.common import staged, text_or_empty
from tidemark.llm.tokens import id_bytes, vocabulary_path, worker_encoder

#: Items that one task fits at once, and how many partitions of a round meet in one of the next.
BLOCK, FAN_IN = 100_000, 8
#: A bin is final when less than this share of it is free.
NEARLY_FULL = 1 / 128
END_TOKEN = 0


def token_pieces(docs: DataFrame, capacity: int, keys: tuple[str, ...] = ("doc_id",), text: str = "text",
                 with_ids: bool = False, path: str | None = None) -> DataFrame:
    """Documents as pieces of at most `capacity` tokens: keys, piece, start, length, ids_crc32 [, ids].

    Each document's ids are followed by the end token. Only longer documents are cut; then the first piece takes
    the remainder and all others are full. `ids` are little-endian unsigned 32-bit.
    """
    path = path or vocabulary_path()
    read = docs.select(*[F.col(f"`{k}`") for k in keys], text_or_empty(f"`{text}`").alias("_text"))
    schema = StructType(read.schema.fields[:-1])
    for name, kind in (("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids_crc32", LongType())):
        schema = schema.add(name, kind)
    if with_ids:
        schema = schema.add("ids", BinaryType())
    width, end = 4 * capacity, id_bytes([END_TOKEN])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, id_bytes)
        for b in batches:
            rows, piece, start, length, check, held = [], [], [], [], [], []
            for row, text in enumerate(b.column(b.num_columns - 1).to_pylist()):
                ids = b"".join(encoder.of_text(text)) + end
                first = len(ids) % width or width
                for number, to in enumerate(range(first, len(ids) + 1, width)):
                    at = max(0, to - width) if number else 0
                    part = ids[at:to]
                    rows.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    check.append(zlib.crc32(part))
                    if with_ids:
                        held.append(part)
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(i).take(of) for i in range(b.num_columns - 1)]
                + [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, check))]
                + ([pa.array(held, pa.binary())] if with_ids else []), names=schema.names)

    return read.mapInArrow(cut, schema)


def best_fit(fills: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the items of each bin, largest items first, each into the fullest bin that it fits."""
    order = sorted(range(len(fills)), key=lambda i: (-fills[i], i))
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes = 0  # bit s: some bin has s free
    for i in order:
        size = fills[i]
        fitting = open_sizes >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = free[room].pop()
            if not free[room]:
                open_sizes ^= 1 << room
            bins[number].append(i)
        else:
            room, number = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            free[left].append(number)
            open_sizes |= 1 << left
    return bins


def pack(items: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """`items` with sequence_id and offset: sequences of at most `capacity`, without gaps from 0.

    Any columns may come along, such as the ids themselves; those named as the new ones are replaced. No
    length may be null or above the capacity. Sequence ids are unique, not dense.
    """
    content = [c for c in items.columns if c not in ("sequence_id", "offset")]
    payload = F.struct(*[F.col(f"`{c}`") for c in content]).alias("item")
    bins = items.select(F.col(f"`{length}`").cast("long").alias("fill"), F.array(payload).alias("items"))
    kind = bins.schema["items"].dataType
    schema = (StructType().add("sequence_id", LongType()).add("fill", LongType()).add("final", BooleanType())
              .add("items", ArrayType(kind.elementType)).add("offsets", ArrayType(LongType())))
    close_at = capacity - int(capacity * NEARLY_FULL)
    field = content.index(length)

    def fit(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, made, held, count = TaskContext.get().partitionId(), 0, [], 0
            for b in batches:
                held.append(b)
                count += b.num_rows
                if count >= BLOCK:
                    yield (out := block(held, number, task, made))
                    made, held, count = made + out.num_rows, [], 0
            if count:
                yield block(held, number, task, made)
        return run

    def block(held, number, task, made) -> pa.RecordBatch:
        together = pa.Table.from_batches(held).combine_chunks()
        fills = together.column(0).to_pylist()
        found = best_fit(fills, capacity)
        order = pa.array([i for one in found for i in one], pa.int64())
        lists = together.column(1).take(order).combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten()
        sizes = np.asarray(lists.value_lengths()).astype(np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum([len(x) for x in found])))]
        lengths = np.asarray(flat.field(field)).astype(np.int64)
        before = np.cumsum(lengths) - lengths
        offsets = before - np.repeat(before[edges[:-1]], np.diff(edges))
        total = [sum(fills[i] for i in one) for one in found]
        ids = np.arange(len(found), dtype=np.int64) + made + (task << 32) + (number << 56)
        cut = pa.array(edges, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(total, pa.int64()), pa.array([t >= close_at for t in total], pa.bool_()),
             pa.ListArray.from_arrays(cut, flat), pa.ListArray.from_arrays(cut, pa.array(offsets))],
            schema=pa.schema([("sequence_id", pa.int64()), ("fill", pa.int64()), ("final", pa.bool_()),
                              ("items", pa.list_(flat.type)), ("offsets", pa.list_(pa.int64()))]))

    parts, done, rounds = bins.rdd.getNumPartitions(), [], 0
    current = staged(bins.mapInArrow(fit(0), schema), "packing")
    left = current.where("not final").count()
    while parts > 1 and left:
        done.append(current.where("final"))
        rounds += 1
        parts = max(1, -(-parts // FAN_IN), -(-left // BLOCK))
        merged = current.where("not final").select("fill", "items", "sequence_id").repartition(parts, F.hash("sequence_id"))
        ordered = merged.sortWithinPartitions(F.desc("fill"), "sequence_id").drop("sequence_id")
        current = staged(ordered.mapInArrow(fit(rounds), schema), "packing")
        before, left = left, current.where("not final").count()
        if parts > 1 and left > 0.99 * before:
            break
    done.append(current)
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionAll(more)
    return (whole.select("sequence_id", F.explode(F.arrays_zip("items", "offsets")).alias("_at"))
            .select(*[F.col(f"_at.items.`{c}`") for c in content], "sequence_id", F.col("_at.offsets").alias("offset")))


def pack_documents(docs: DataFrame, capacity: int = 2048, keys: tuple[str, ...] = ("doc_id",), text: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Tokenises and packs: one row per piece with its place."""
    return pack(token_pieces(docs, capacity, keys, text, with_ids), capacity)
