"""Quality rules: base counts of a text, and hashed n-gram importance. DataFrame functions only.

Words and word pairs are hashed to a fixed number of classes. Two multinomials are counted over whole texts: one of the
trusted target (all rows labelled good), one of the raw corpus (all rows). A document's score is
the mean log-likelihood ratio of its n-grams, so length doesn't count. Every document at or above one threshold is kept;
the threshold is the score that best separates all good from all bad rows. Nothing is sampled: labels are joined to hashed
n-grams and to scores by a shuffle, and the sums from the highest score down are exact.

A null text counts as empty: it has no words, fails the base rules and is not kept. Null labels are not used, nor are those
of a key that is labelled both ways; without labels of both kinds only the base rules decide. Repeated rows are judged each for itself. An empty table gives an
empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, staged, text_or_empty, with_bucket_starts

#: Classes of hashed n-grams, in 16 bits. Distinct scores, about, that one task sums up.
CLASSES, SCORES = 1 << 13, 10_000
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def _hashed(docs: DataFrame) -> DataFrame:
    """Adds `_hash`, the hashed words of `_text` in order."""
    return (docs.withColumn("_words", _words(F.col("_text")))
            .withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words"))


def _pair(i: Column) -> Column:
    return F.xxhash64(F.get("_hash", i - 1), F.get("_hash", i))


def _class(h: Column) -> Column:
    return F.pmod(h, F.lit(CLASSES)).cast("int")


def _positions(first: int, last: Column) -> Column:
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to rows with `_text` and `_hash`."""
    lines = F.transform(F.filter(F.split("_text", "\n"), lambda x: F.length(F.regexp_replace(x, BLANKS, "")) > 0), lambda x: F.xxhash64(x))
    n = F.size("_hash")
    counted = docs.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.regexp_replace("_text", BLANKS, "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "_lines": lines,
        "_grams": F.transform(_positions(WINDOW - 1, n - 1), lambda i: F.xxhash64(*[F.get("_hash", i - k) for k in range(WINDOW - 1, -1, -1)])),
    })
    counted = counted.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    # Sorted, equal windows are neighbours. Texts without any skip the sort.
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    counted = counted.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = F.filter("_sorted", lambda x, i: x["h"].eqNullSafe(F.get("_sorted", i - 1)["h"]) | x["h"].eqNullSafe(F.get("_sorted", i + 1)["h"]))
    counted = counted.withColumn("_at", F.sort_array(F.transform(same, lambda x: x["i"])))
    # Each repeated window covers its words less those that the one before it has covered.
    covers = F.transform("_at", lambda at, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), at - F.get("_at", i - 1))))
    covered = F.aggregate(covers, F.lit(0), lambda a, x: a + x)
    return (counted.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_lines", "_grams", "_sorted", "_at"))


def _labelled(labels: DataFrame, key: str, label: str) -> DataFrame:
    known = (labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("good"))
             .where("_key is not null and good in (0, 1)"))
    both = known.groupBy("_key").agg(F.min("good").alias("good"), F.max("good").alias("_most"))
    # Labels grow with the texts: they are joined by a shuffle at any size, which sorts neither side.
    return both.where("good = _most").drop("_most").hint("shuffle_hash")


def log_ratios(docs: DataFrame, labelled: DataFrame) -> list[float]:
    """Per class the log of its target share over its raw share, smoothed by one."""
    grams = F.concat(F.transform("_hash", _class), F.transform(_positions(1, F.size("_hash") - 1), lambda i: _class(_pair(i))))
    # Classes are joined and not texts: they take about half the bytes.
    classes = _hashed(docs).select("_key", grams.cast("array<smallint>").alias("_grams"))
    flagged = classes.join(labelled, "_key", "left").select("_grams", (F.coalesce("good", F.lit(0)) == 1).cast("long").alias("_trusted"))
    # A plain explode would push a filter on the array's size down to the scan, with the hashes anew for each pair of words.
    counts = (flagged.select("_trusted", F.explode_outer("_grams").alias("c")).where("c is not null").groupBy("c")
              .agg(F.count(F.lit(1)).alias("raw"), F.sum("_trusted").alias("target")).collect())
    raw, target = {r["c"]: r["raw"] for r in counts}, {r["c"]: r["target"] for r in counts}
    all_raw, all_target = sum(raw.values()) + CLASSES, sum(target.values()) + CLASSES
    return [math.log((target.get(c, 0) + 1) / all_target) - math.log((raw.get(c, 0) + 1) / all_raw) for c in range(CLASSES)]


def _score(ratios: list[float]) -> Column:
    """Mean log ratio of the n-grams of `_hash`; 0 without words."""
    known = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to one literal
    ratio = lambda h: F.get(known, _class(h))
    n = F.size("_hash")
    ones = F.aggregate("_hash", F.lit(0.0), lambda a, h: a + ratio(h))
    pairs = F.aggregate(_positions(1, n - 1), F.lit(0.0), lambda a, i: a + ratio(_pair(i)))
    return F.when(n > 0, (ones + pairs) / (2 * n - 1)).otherwise(0.0)


def _threshold(scored: DataFrame, scores: int = SCORES) -> float | None:
    """The score from which on the share of good rows kept exceeds that of bad rows most; from (score, good).

    Scores are dealt to parts in falling order, whose sums are carried over; where the parts are cut doesn't matter for the result.
    """
    cells = staged(scored.groupBy("score").agg(F.sum("good").cast("long").alias("good"), F.sum(1 - F.col("good")).cast("long").alias("bad")), "quality")
    good, bad, n = cells.agg(F.sum("good"), F.sum("bad"), F.count("*")).first()
    if not good or not bad:
        return None
    ranged = cells.repartitionByRange(-(-n // scores), F.desc("score"))
    parted = staged(ranged.withColumn("part", F.spark_partition_id()), "quality")
    sums = parted.groupBy("part").agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).withColumn("_all", F.lit(0))
    # A row for each part.
    starts = with_bucket_starts(with_bucket_starts(sums, ["_all"], ["part"], "g", "good_before"), ["_all"], ["part"], "b", "bad_before")
    down = W.partitionBy("part").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    gain = ((F.col("good_before") + F.sum("good").over(down)) / good - (F.col("bad_before") + F.sum("bad").over(down)) / bad).alias("gain")
    met = parted.join(starts.select("part", "good_before", "bad_before"), "part")
    return met.select("score", gain).orderBy(F.desc("gain"), F.desc("score")).first()["score"]


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept: one row per document."""
    read = docs.select(F.col(f"`{key}`").alias("_key"), text_or_empty(f"`{text}`").alias("_text"))
    labelled = _labelled(labels, key, label)
    ratios = log_ratios(read, labelled)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    counted = staged(base_counts(_hashed(read).withColumn("score", _score(ratios))).select("_key", *counts), "quality")
    least = _threshold(counted.join(labelled, "_key").select("score", "good"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    verdict = F.lit(True) if least is None else F.col("score") >= least
    return (counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict)
            .select(F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"))
