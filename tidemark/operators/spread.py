"""Ordered work inside a key, without ever putting a huge key into one task.

Running counts, `lead`/`lag` lookups and matching all need the rows of a key in order.
`Window.partitionBy(key)` gives that, but sends every row of a key to one task. When a key
holds a large share of the table that task never ends. `spread` finds such keys and cuts
their rows into ordered chunks of roughly equal size; everything else keeps the plain window.

* Heavy keys are those counted above the chunk size, counts combined before their shuffle. A key is cut
  because of its own rows only, however large the table is.
* Chunk borders are quantiles of a sample of the heavy rows only, taken over the full
  ordering tuple, so one timestamp shared by many rows can be cut as well. The sample picks
  the borders and nothing else; every row is kept.
* The borders are checkpointed. From then on a row's chunk is a pure function of the row,
  so recomputing lost tasks cannot move rows between chunks.
* What a chunk must know about its neighbours is one summary row per chunk. These tables are counted: up to
  `BROADCAST_ROWS` rows they are broadcast, beyond that they are joined by a shuffle whose
  skewed keys adaptive execution splits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_folder

CHUNK = "_chunk"
BROADCAST_ROWS = 1_000_000
SAMPLES_PER_CHUNK = 50
FANOUT = 8
DEFAULT_CHUNK_ROWS = 4_000_000


@dataclass(frozen=True)
class Spread:
    """Rows with a chunk number (null for ordinary keys) and the window that orders them."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    chunks: int = 0

    def small(self, table: DataFrame) -> DataFrame:
        """A table of at most one row per chunk, to be broadcast if there are few chunks."""
        return _small(table, self.chunks)

    @property
    def local(self):
        """Rows of one key and chunk in order."""
        parts = [*self.keys, CHUNK] if self.split or not self.keys else list(self.keys)
        return Window.partitionBy(*parts).orderBy(*self.order)

    @property
    def so_far(self):
        return self.local.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def summaries(self, rows: DataFrame, **parts: Column) -> DataFrame:
        """One row per heavy key and chunk."""
        aggregates = [expr.alias(name) for name, expr in parts.items()]
        return rows.filter(F.col(CHUNK).isNotNull()).groupBy(*self.keys, CHUNK).agg(*aggregates)

    def attach(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        """Join a table of at most one row per heavy key and chunk to the rows."""
        names = [*self.keys, CHUNK]
        side = table.select(
            *[F.col(n).alias(f"_at_{n}") for n in names],
            *[F.col(c) for c in table.columns if c not in names],
        )
        same = [rows[k].eqNullSafe(side[f"_at_{k}"]) for k in self.keys]
        same.append(rows[CHUNK] == side[f"_at_{CHUNK}"])
        joined = rows.join(self.small(side), reduce(lambda a, b: a & b, same), "left")
        return joined.drop(*[f"_at_{n}" for n in names])

    def carry(self, rows: DataFrame, **parts: tuple[Column, str]) -> DataFrame:
        """Add one column per part: a chunk aggregate combined over the neighbouring chunks.

        `total` sums and `peak` maximises over all earlier chunks of the key, `previous` and
        `following` take the value of the nearest chunk on that side. Without heavy keys the
        rows come back as they are and no column is added.
        """
        if not self.split:
            return rows
        chunks = Window.partitionBy(*self.keys).orderBy(CHUNK)
        earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
        ways = {
            "total": lambda c: F.sum(c).over(earlier),
            "peak": lambda c: F.max(c).over(earlier),
            "previous": lambda c: F.lag(c).over(chunks),
            "following": lambda c: F.lead(c).over(chunks),
        }
        table = self.summaries(rows, **{name: expr for name, (expr, _) in parts.items()})
        table = table.select(*self.keys, CHUNK, *[ways[how](n).alias(n) for n, (_, how) in parts.items()])
        return self.attach(rows, table)

    def plus(self, expr: Column, carried: str) -> Column:
        return expr + F.coalesce(F.col(carried), F.lit(0)) if self.split else expr

    def orelse(self, expr: Column, carried: str) -> Column:
        return F.coalesce(expr, F.col(carried)) if self.split else expr


def spread(df: DataFrame, keys, order, chunk_rows: int | None = None) -> Spread:
    """Lay out `df` for ordered work per key; see the module text.

    `order` must be unique inside a key. `chunk_rows` is the size from which a key is cut.
    """
    keys, order = tuple(keys), tuple(order)
    wanted = chunk_rows or DEFAULT_CHUNK_ROWS
    code = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    heavy = df.groupBy(code.alias("_code")).agg(F.count("*").alias("_n")).filter(F.col("_n") > wanted)
    seen = heavy.agg(F.count("*").alias("keys"), F.sum("_n").alias("rows")).first()
    if not seen["keys"]:
        return Spread(df.withColumn(CHUNK, F.lit(None).cast("int")), keys, order, False)
    borders = _borders(df, keys, order, code, _small(heavy.select("_code"), seen["keys"]), wanted)
    found = borders.agg(F.count("*").alias("n"), F.max("_at").alias("most")).first()
    chunks = 2 * found["n"]  # a key has one chunk more than borders
    return Spread(_with_chunks(df, borders, keys, order, code, chunks, found["most"] or 0), keys, order, True, chunks)


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _with_chunks(df: DataFrame, borders: DataFrame, keys, order, code: Column, chunks: int, most: int) -> DataFrame:
    """Look up each row's chunk by descending a tree over the borders of its key.

    Each level is one hash join in which a row compares itself with the `FANOUT` spans
    below its node, so the cost depends on the number of chunks only, and neither on the type
    nor on the distribution of the ordering columns.
    """
    own = [F.col(k).alias(f"_own_{k}") for k in keys]
    numbers = borders.filter("_at = 1").select("_no", F.col("_code").alias("_own_code"), *own)
    same = [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys]
    on_key = reduce(lambda a, b: a & b, same, F.col("_code") == F.col("_own_code"))
    rows = df.withColumn("_code", code).join(_small(numbers, chunks), on_key, "left")
    rows = rows.select(*df.columns, "_no", F.when(F.col("_no").isNotNull(), 0).alias(CHUNK))
    place = F.struct(*order)
    none = F.lit(None).cast(borders.schema["_place"].dataType).alias("_place")
    starts = borders.select("_no", "_at", "_place").unionByName(numbers.select("_no", F.lit(0).alias("_at"), none))
    width = 1
    while width * FANOUT <= most:
        width *= FANOUT
    while width:
        upto = F.lead("_place").over(Window.partitionBy("_no").orderBy("_at"))
        spans = starts.filter(F.col("_at") % width == 0).select(
            F.col("_no").alias("_span_no"), F.expr(f"int(_at div {width})").alias("_span"),
            F.expr(f"int(_at div {width * FANOUT})").alias("_above"), F.col("_place").alias("_from"), upto.alias("_upto"),
        )
        inside = (
            (F.col("_no") == F.col("_span_no")) & (F.col(CHUNK) == F.col("_above"))
            & (F.col("_from").isNull() | (place >= F.col("_from")))
            & (F.col("_upto").isNull() | (place < F.col("_upto")))
        )
        rows = rows.join(_small(spans, chunks), inside, "left").select(*df.columns, "_no", F.col("_span").alias(CHUNK))
        width //= FANOUT
    return rows.drop("_no")


def _borders(df, keys, order, code, heavy: DataFrame, size: int) -> DataFrame:
    """(_no, _code, keys, _at, _place): the chunk borders of every heavy key, numbered from 1."""
    shared_folder(df.sparkSession)
    share = min(1.0, SAMPLES_PER_CHUNK / size)
    step = max(1, round(size * share))
    sample = df.select(*keys, *order, code.alias("_code")).join(heavy, "_code", "left_semi")
    if share < 1.0:
        sample = sample.sample(share, seed=17)
    number = F.row_number().over(Window.partitionBy("_code", *keys).orderBy(*order))
    picked = sample.withColumn("_n", number).filter(F.col("_n") % step == 0)
    # One row per chunk is all that this window sees.
    key_number = F.dense_rank().over(Window.orderBy("_code", *keys))
    borders = picked.select(
        key_number.alias("_no"), "_code", *keys, (F.col("_n") / step).cast("int").alias("_at"), F.struct(*order).alias("_place")
    )
    return borders.checkpoint(eager=True)
