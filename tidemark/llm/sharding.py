"""Balanced label propagation into shards of near equal bytes. DataFrame functions only.

Documents with equal texts are linked. Copies are bundled by text and a hash of the key: a group of any size is at most
`BUNDLES` vertices, and only groups of two rows or more have any. Every vertex starts in a shard drawn by its hash, so a group
starts scattered and most of its edges are cut. In each round the vertices of a group ask for the shard that holds most of its bytes.
What may go from one shard to another is a quota: what the two ask of each other, and beyond that what fits the room of the target
and what leaves it, so full shards can still exchange. Askers are admitted in classes by a hash of the group, the same for all pairs of shards in
a round, so a group that is admitted gathers at once; a quota that ends inside a class is not used up, which may leave a shard
over by a class for each other shard until the next round. Every move goes to where more of the group is: cut edges fall in
every round. Rounds end when no more than `SETTLED` of the linked bytes moved in the last one. The few groups that quotas have left
in several shards are laid whole, in order of a hash, along the room that is left; one that lies across a border goes where its middle is.

Groups above `LARGE` of a shard, of which there is a bounded number, are too large for quotas and are placed before that, from the largest on, each into
the emptiest shard, as long as it fits there; one that fits none is dealt by bundles to as few shards as have room. A shard is over
by `LARGE`, or by one bundle that fits nowhere, at most. Documents without links cut no edges: they are laid along the room
that is left, which evens the sizes.

Nulls in `text` have size 1 and are no copies of anything, as are empty texts. Repeated rows get
places of their own. A null key is a key like others. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import accumulate, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import staged, text_or_empty, with_bucket_starts

#: Vertices of a group of copies, classes by which askers are admitted.
BUNDLES, CLASSES = 64, 4096
#: Groups above this share of a shard are placed one by one: at most shards / LARGE of them, and BUNDLES vertices of each that fits none, are
#: held by the driver. Rounds end when no more than the second share of the linked bytes moved.
LARGE, SETTLED = 1 / 64, 1 / 1000
#: Cells in which places are counted.
CELLS = 4096


def _class(columns: list, number: int, salt: str) -> Column:
    return F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(number)).cast("int")


def _scattered(bundles: DataFrame, room: list[float]) -> DataFrame:
    """(h, bundle, bytes, label): every vertex in a shard drawn by its hash, in proportion to the room of the shards."""
    draw = _class(["h", "bundle"], 1 << 24, "seed") / float(1 << 24)
    edges = list(accumulate(r / (sum(room) or 1) for r in room))
    label = sum((F.when(draw >= e, 1).otherwise(0) for e in edges[:-1]), F.lit(0))
    return bundles.select("h", "bundle", "bytes", label.cast("int").alias("label"))


def _quotas(asked: dict[tuple[int, int], float], spare: list[float]) -> dict[tuple[int, int], float]:
    """What may go from shard to shard: at most what is asked, and into no shard more than it has spare and loses.

    First what two shards ask of each other, which needs no spare. Then whatever a shard with spare can take gives its origin spare.
    """
    quota, spare = dict.fromkeys(asked, 0.0), list(spare)
    for i, j in asked:
        both = min(asked[i, j], asked.get((j, i), 0.0))
        quota[i, j] = both
    takes = [s for s, left in enumerate(spare) if left > 0]
    # Spare that wanders in small pieces isn't worth more steps; what is not admitted asks again in the next round.
    for _ in range(16 * len(spare)):
        if not takes:
            break
        to = takes.pop(0)
        for pair in [p for p in asked if p[1] == to and asked[p] > quota[p]]:
            step = min(asked[pair] - quota[pair], spare[to])
            if step <= 0:
                break
            quota[pair] += step
            spare[to] -= step
            spare[pair[0]] += step
            if spare[pair[0]] > 0 and pair[0] not in takes:
                takes.append(pair[0])
    return quota


def _round(vertices: DataFrame, room: list[float], number: int) -> DataFrame:
    """The vertices after one round, with `moved`."""
    weights = vertices.groupBy("h", "label").agg(F.sum("bytes").alias("weight"))
    # Equal weights are told apart by a hash, so that no shard is preferred.
    heaviest = F.max(F.struct("weight", F.xxhash64("h", "label").alias("tie"), "label"))
    best = weights.groupBy("h").agg(heaviest.alias("best")).select("h", F.col("best.label").alias("best"))
    asks = staged(vertices.join(best, "h").select(
        "h", "bundle", "bytes", "label", F.when(F.col("best") != F.col("label"), F.col("best")).alias("to"),
        _class(["h"], CLASSES, f"round{number}").alias("class")), "sharding")
    # At most a row for each pair of shards.
    sums = asks.groupBy("label", "to").agg(F.sum("bytes").alias("bytes")).collect()
    spare = [r - sum(x["bytes"] for x in sums if x["label"] == s) for s, r in enumerate(room)]
    quotas = _quotas({(r["label"], r["to"]): float(r["bytes"]) for r in sums if r["to"] is not None}, spare)
    quota = vertices.sparkSession.createDataFrame([(*k, v) for k, v in quotas.items()], "label int, to int, quota double")
    classes = asks.where("to is not null").groupBy("label", "to", "class").agg(F.sum("bytes").alias("asked"))
    admitted = (with_bucket_starts(classes, ["label", "to"], ["class"], "asked", "before").join(F.broadcast(quota), ["label", "to"])
                .where(F.col("before") + F.col("asked") <= F.col("quota") * (1 + 1e-6)).select("label", "to", "class", F.lit(True).alias("goes")))
    # At most CLASSES rows for each pair of shards.
    told = asks.join(admitted, ["label", "to", "class"], "left").withColumn("moved", F.coalesce("goes", F.lit(False)))
    return told.select("h", "bundle", "bytes", F.when(F.col("moved"), F.col("to")).otherwise(F.col("label")).alias("label"), "moved")


def propagate(vertices: DataFrame, room: list[float], rounds: int | None = None) -> Iterator[DataFrame]:
    """The vertices (h, bundle, bytes, label, moved) after each round, until hardly any moves; `room` is what a shard holds."""
    linked = vertices.agg(F.sum("bytes")).first()[0] or 0
    for number in count() if rounds is None else range(rounds):
        vertices = staged(_round(vertices, room, number), "sharding")
        yield vertices
        if (vertices.where("moved").agg(F.sum("bytes")).first()[0] or 0) <= SETTLED * linked:
            return


def _laid(rows: DataFrame, room: list[float], amount: float, *order: str) -> DataFrame:
    """Adds `shard`: rows, by cell and `order`, along the room of the shards. A cell starts where those before it end."""
    cells = with_bucket_starts(rows.groupBy("cell").agg(F.sum("size").alias("sum")), [], ["cell"], "sum", "start")
    edges, scale = [], amount / (sum(room) or 1)
    for r in room:
        edges.append((edges[-1] if edges else 0.0) + r * scale)
    along = W.partitionBy("cell").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    lying = rows.join(F.broadcast(cells.select("cell", "start")), "cell").withColumn("end", F.col("start") + F.sum("size").over(along))
    middle = F.col("end") - F.col("size") / 2
    shard = sum((F.when(middle > e, 1).otherwise(0) for e in edges[:-1]), F.lit(0))
    return lying.withColumn("shard", shard.cast("int"))


def _place_large(groups: DataFrame, bundles: DataFrame, shards: int, share: float) -> tuple[list[tuple], list[tuple], list[float]]:
    """(group, shard) of those kept whole, (group, bundle, shard) of those that fit no shard, and the load of each shard."""
    loads, whole, parts = [0.0] * shards, [], []
    heap = [(0.0, s) for s in range(shards)]
    large = sorted(groups.where(F.col("bytes") > LARGE * share).select("h", "bytes").collect(), key=lambda r: (-r["bytes"], r["h"]))
    split = []
    for r in large:
        load, s = heap[0]
        if load + r["bytes"] <= share:
            heapq.heapreplace(heap, (load + r["bytes"], s))
            whole.append((r["h"], s))
        else:
            split.append(r["h"])
    for load, s in heap:
        loads[s] = load
    if split:
        session = groups.sparkSession
        names = session.createDataFrame([(h,) for h in split], "h string")
        found = {}
        for r in bundles.join(F.broadcast(names), "h", "left_semi").select("h", "bundle", "bytes").collect():
            found.setdefault(r["h"], []).append((r["bytes"], r["bundle"]))
        for h in split:
            s = None
            for size, bundle in sorted(found[h], reverse=True):
                if s is None or loads[s] + size > share:
                    s = loads.index(min(loads))
                loads[s] += size
                parts.append((h, bundle, s))
    return whole, parts, loads


def _settled(vertices: DataFrame, room: list[float]) -> DataFrame:
    """(h, label): the shard of every group, which is its own where rounds have gathered it and else one with room."""
    homes = staged(vertices.groupBy("h").agg(F.min("label").alias("label"), (F.min("label") == F.max("label")).alias("whole"),
                                             F.sum("bytes").alias("size")), "sharding")
    held = {r["label"]: r["size"] for r in homes.where("whole").groupBy("label").agg(F.sum("size").alias("size")).collect()}
    rest = homes.where("not whole").select("h", "size", _class(["h"], CELLS, "group").alias("cell"))
    amount = rest.agg(F.sum("size")).first()[0] or 0
    laid = _laid(rest, [max(0.0, r - held.get(s, 0)) for s, r in enumerate(room)], amount, "h")
    return homes.where("whole").select("h", "label").unionAll(laid.select("h", F.col("shard").alias("label")))


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot."""
    spark, body = docs.sparkSession, text_or_empty(f"`{text}`")
    base = staged(docs.select(
        F.col(f"`{key}`").alias("_key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"),
        F.when(F.octet_length(body) > 0, F.sha2(body, 256)).alias("h")), "sharding")
    rows = base.withColumn("bundle", _class(["_key"], BUNDLES, "bundle"))
    total = base.agg(F.sum("size")).first()[0] or 0
    share = total / shards
    bundles = rows.where("h is not null").groupBy("h", "bundle").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    bundles = staged(bundles, "sharding")
    groups = staged(bundles.groupBy("h").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("n > 1"), "sharding")
    whole, parts, loads = _place_large(groups, bundles, shards, share)
    room = [max(0.0, share - x) for x in loads]
    small = bundles.join(groups.where(F.col("bytes") <= LARGE * share).select("h"), "h")
    last = start = staged(_scattered(small, room), "sharding")
    for last in propagate(start, room, rounds):
        pass
    named = _settled(last, room).unionAll(spark.createDataFrame(whole, "h string, label int"))
    pieces = F.broadcast(spark.createDataFrame(parts, "h string, bundle int, label int"))
    vertices = staged(bundles.join(named, "h").select("h", "bundle", "bytes", "label")
                      .unionAll(bundles.join(pieces, ["h", "bundle"]).select("h", "bundle", "bytes", "label")), "sharding")
    # A row for each shard.
    loads = {r["label"]: r["bytes"] for r in vertices.groupBy("label").agg(F.sum("bytes").alias("bytes")).collect()}
    placed = rows.join(vertices.select("h", "bundle", "label"), ["h", "bundle"], "left")
    placed = staged(placed.select("_key", "size", "crc", "label", _class(["_key", "h"], CELLS, "cell").alias("cell")), "sharding")
    # Documents without links along the room that is left.
    room = [max(0.0, share - loads.get(s, 0)) for s in range(shards)]
    lying = _laid(placed.where("label is null"), room, total - sum(loads.values()), "_key", "crc")
    done = staged(lying.select("_key", "size", "crc", "cell", "shard")
                  .unionAll(placed.where("label is not null").select("_key", "size", "crc", "cell", F.col("label").alias("shard"))), "sharding")
    counts = with_bucket_starts(done.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")), ["shard"], ["cell"], "n", "first")
    place = F.row_number().over(W.partitionBy("shard", "cell").orderBy("_key", "crc"))
    return (done.withColumn("place", place).join(F.broadcast(counts.select("shard", "cell", "first")), ["shard", "cell"])
            .select(F.col("_key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("first") + F.col("place") - 1).cast("long").alias("slot")))
