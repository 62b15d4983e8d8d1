"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Every document of a source is expected the same number of copies, its source's target over its source's size. With one
offset the running sum of expected copies is cut at the whole numbers: a document is taken once per whole number
that it crosses. The offset is drawn from the source's name: of evenly spaced draws the one whose words come
nearest to the target, as in a small source one long document more or less would tell. Documents are summed in cells by the logarithm of the size and a hash of the
key, so that every size is sampled evenly; a cell is small however hot its source is. All draws are
hashes of names and keys: reruns agree.

A null source is a source of its own, the last one. A null text has size 0. Repeated rows are documents of their own (equal
keys are told apart by their running position only). Empty tables, and tables without any word, take nothing.
Columns other than key, source and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import staged, with_bucket_starts, word_count

#: Cells by hash for each step of size; steps of size for each doubling.
SPLITS, STEPS = 256, 8
#: Offsets that are compared for each source.
DRAWS = 32
#: Most copies of a document, and so of a source's size.
MOST = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """From (source, source_size): also weight, target. One row per source.

    Sources by code point, null last, take the weights in turn. Targets share the total by weight; a target stops at `most`
    times its source's size and the rest is shared again, until none is above. Sorted by size over weight, the
    stopped sources are the first ones, up to the first whose limit exceeds its share of what those before it left.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn))
    by_limit = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    limit = F.col("source_size") * most
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
             / F.sum("weight").over(by_limit.rowsBetween(0, W.unboundedFollowing)))
    levels = weighed.withColumn("level", level).withColumn("over", limit > F.col("level") * F.col("weight"))
    final = F.min(F.when(F.col("over"), F.struct(F.col("source_size") / F.col("weight"), "level")))
    share = levels.withColumn("shared", final.over(everything)["level"])
    target = F.least(limit.cast("double"), F.coalesce(F.col("shared") * F.col("weight"), limit.cast("double")))
    return share.select("source", "source_size", "weight", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", row: str | None = None) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken (copies times size).

    `row` names a column that tells rows apart which share a key; it comes along as `_row` and decides nothing.
    """
    base = staged(docs.select(F.col(f"`{key}`").alias("_key"), *([] if row is None else [F.col(f"`{row}`").alias("_row")]),
                              F.col(f"`{source}`").alias("source"), word_count(f"`{text}`").alias("size")), "mixing")
    step = F.floor(F.log2(F.col("size") + 1) * STEPS).cast("int")
    rows = base.select("*", step.alias("step"), F.pmod(F.xxhash64(F.col("_key"), F.lit("cell")), F.lit(SPLITS)).cast("int").alias("split"))
    # Cells before sources: the source totals come from the few cells.
    cells = staged(rows.groupBy("source", "step", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mixing")
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")))
    starts = with_bucket_starts(cells, ["source"], ["step", "split"], "n", "start")
    known = starts.join(targets, starts["source"].eqNullSafe(targets["source"])).drop(targets["source"]).drop("n", "words", "weight")
    known = known.withColumnsRenamed({"source": "_source", "step": "_step", "split": "_split"})
    place = W.partitionBy("source", "step", "split").orderBy("size", "_digest")
    ranked = rows.withColumn("_digest", F.xxhash64(F.col("_key"), F.lit("mixing"))).withColumn("rank", F.row_number().over(place))
    met = ranked.join(known, ranked["source"].eqNullSafe(known["_source"]) & (ranked["step"] == known["_step"])
                      & (ranked["split"] == known["_split"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = ["_key"] if row is None else ["_key", "_row"]
    placed = staged(met.select(*named, "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                               rate.alias("rate"), (F.col("start") + F.col("rank")).alias("upto")), "mixing")
    draw = (F.pmod(F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")), F.lit("offset")), F.lit(1000)) + 0.5) / 1000

    def copies(offset: Column) -> Column:
        crossed = F.floor(offset + F.col("upto") * F.col("rate")) - F.floor(offset + (F.col("upto") - 1) * F.col("rate"))
        return F.least(crossed, F.lit(MOST))

    offsets = [(draw + i) / DRAWS for i in range(DRAWS)]
    sums = placed.groupBy("source").agg(F.first("target").alias("target"), *[F.sum(copies(o) * F.col("size")).alias(f"t{i}") for i, o in enumerate(offsets)])
    nearest = F.least(*[F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("miss"), F.lit(i).alias("i")) for i in range(DRAWS)])
    chosen = sums.select(F.col("source").alias("_source"), nearest["i"].alias("i"))
    offset = (draw + F.col("i")) / DRAWS
    return (placed.join(chosen, placed["source"].eqNullSafe(chosen["_source"])).withColumn("copies", copies(offset).cast("int"))
            .select(F.col("_key").alias(key), *named[1:], "source", "size", "source_size", "target",
                    "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")))
