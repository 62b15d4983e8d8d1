"""Whitening of embeddings by the singular vectors of the centred rows, found by QR, bidiagonalisation and dqds.

Vectors are read as whole numbers (entries scaled and floored), so that counts, sums and deviations are exact. The fit uses each
distinct vector once. Tasks reduce their centred rows to triangular factors by QR, block by block; the factors are stacked and reduced
again in two levels (LEVEL groups, then one), so no product of rows is formed and no task holds more than a batch and two
factors. The last factor, dimension by dimension, goes to `bidiagonal`: Householder bidiagonalisation, dqds for the
singular values, twisted factorisations for the directions. Its size depends on the dimension only.

A vector that is null or holds a null or an entry that isn't finite is dropped, and so is one whose number of entries isn't the
most common one (of equally common ones the greater). Without a vector, or with no entries, the result is empty. Scaled
entries beyond a long are cut to it; a deviation beyond a long is null. A component with no variance (beyond RANK of
the largest) has a null `whitened` and `explained` as it is; it takes no part in the identity error, which is null without
components. With one distinct vector there is no variance at all and `explained` is null. Null and repeated keys are kept.
Columns other than key and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructType

from tidemark.llm.bidiagonal import right_vectors
from tidemark.llm.common import staged

SCALE = 256
#: Groups of the first level in which factors meet.
LEVEL = 256
#: Components whose variance is less than this share of the largest count as none.
RANK = 1e-20
#: Rows that are worked on at once.
ROWS = 4096
_LONG = 1 << 63


class Whitening(NamedTuple):
    n: int
    sums: list[int]
    variances: np.ndarray  # of the returned components, falling
    total: float
    directions: np.ndarray  # one row for each component


def _packed(rows: np.ndarray) -> list[bytes]:
    """Whole numbers as bytes, in the least of three widths that holds a row: equal vectors give equal bytes."""
    out, width = [], np.full(len(rows), 8)
    most = np.maximum(rows.max(1), -(rows.min(1) + 1)) if rows.shape[1] else np.zeros(len(rows))
    width[most < 1 << 31] = 4
    width[most < 1 << 15] = 2
    small, middle = rows.astype(np.int16), rows.astype(np.int32)
    for i, w in enumerate(width.tolist()):
        out.append(bytes([w]) + (small[i] if w == 2 else middle[i] if w == 4 else rows[i]).tobytes())
    return out


def _unpacked(cells: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(c, f"<i{c[0]}", offset=1) for c in cells], np.int64)


def whole_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(_key, size, x): the rows that stay, their entries scaled, floored and packed."""
    kind = vectors.schema[key].dataType
    schema = StructType().add("_key", kind).add("size", IntegerType()).add("x", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                lists = b.column(1)
                sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
                flat = np.asarray(lists.flatten().cast(pa.float64()).fill_null(np.nan), np.float64)
                owner = np.repeat(np.arange(b.num_rows), sizes)
                bad = np.asarray(lists.is_null()).copy()
                bad[owner[~np.isfinite(flat)]] = True
                with np.errstate(over="ignore", invalid="ignore"):
                    scaled = np.floor(np.where(np.isfinite(flat), flat, 0) * scale)
                    cut = np.where(np.abs(scaled) < 2.0**63, scaled, 0).astype(np.int64)
                cut[scaled >= 2.0**63], cut[scaled < -(2.0**63)] = _LONG - 1, -_LONG
                starts, cells = np.concatenate(([0], np.cumsum(sizes))), [None] * b.num_rows
                for size in np.unique(sizes[~bad]).tolist():
                    own = np.flatnonzero((sizes == size) & ~bad)
                    for i, cell in zip(own.tolist(), _packed(cut[starts[own][:, None] + np.arange(size)])):
                        cells[i] = cell
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(cells, pa.binary())], names=schema.names).filter(pa.array(~bad))

    read = vectors.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{vector}`").cast("array<double>").alias("_vector"))
    rows = staged(read.mapInArrow(run, schema), "whitening")
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.col("size") == (common["size"] if common else 0)).where("size > 0")


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            b = whole.slice(at, ROWS)
            if b.num_rows:
                yield b, _unpacked(b.column(column).to_pylist())


def _exact(x: np.ndarray, factor: int, sums: list[int]) -> np.ndarray:
    """factor * x - sums, in longs where they suffice, else in Python's numbers."""
    most = max(abs(int(x.max())), abs(int(x.min())))
    if factor * most + max(map(abs, sums)) < _LONG:
        return x * factor - np.array(sums, np.int64)
    return x.astype(object) * factor - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return np.asarray(_exact(x, n, sums) / n, np.float64)


def column_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of rows of packed vectors and their exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b, x in _blocks(batches, 0):
            wide = max(abs(int(x.max())), abs(int(x.min()))) * len(x) >= _LONG
            part = x.astype(object).sum(0) if wide else x.sum(0).astype(object)
            n, total = n + len(x), part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(total), pa.int64()), pa.array(range(len(total)), pa.int32()),
                                              pa.array([int(t) for t in total], pa.decimal128(38, 0))], names=["n", "at", "s"])

    parts = fit.mapInArrow(run, "n long, at int, s decimal(38,0)")
    sums = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # a row for each dimension
    sums = sorted(sums, key=lambda r: r["at"])
    return (sums[0]["n"], [int(r["s"]) for r in sums]) if sums else (0, [])


def triangular_factor(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of the centred rows, by a tree of stacked factors."""
    size = len(sums)

    def joined(r: np.ndarray | None, more: np.ndarray) -> np.ndarray:
        return np.linalg.qr(more if r is None else np.concatenate((r, more)), mode="r")

    def cell(group: int, r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["g", "r"])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, group = None, 0
        for b, x in _blocks(batches, 0):
            r, group = joined(r, _centred(x, n, sums)), b.column(1)[0].as_py()
        yield from cell(group, r)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for b in batches:
            for packed in b.column("r"):
                r = joined(r, np.frombuffer(packed.as_buffer(), np.float64).reshape(-1, size))
        yield from cell(0, r)

    parts = fit.select("x", F.pmod(F.spark_partition_id(), F.lit(LEVEL)).cast("int").alias("g")).mapInArrow(reduce_rows, "g int, r binary")
    level = parts.groupBy("g").applyInArrow(merge, "g int, r binary")
    top = level.groupBy("g").applyInArrow(merge, "g int, r binary").collect()  # one row
    r = np.frombuffer(top[0]["r"], np.float64).reshape(-1, size)
    return np.concatenate((r, np.zeros((size - len(r), size)))) if len(r) < size else r


def fit_whitening(fit: DataFrame, components: int = 4) -> Whitening | None:
    """The whitening of distinct packed vectors (column x); None without any."""
    n, sums = column_sums(fit)
    if not n:
        return None
    values, directions = right_vectors(triangular_factor(fit, n, sums), components)
    return Whitening(n, sums, values[: len(directions)] / n, float(values.sum() / n), directions)


def apply_whitening(rows: DataFrame, model: Whitening) -> DataFrame:
    """(_key, x) -> (_key, deviation, whitened: an array with one number for each component)."""
    schema = StructType().add("_key", rows.schema["_key"].dataType).add("deviation", LongType()).add("whitened", ArrayType(DoubleType()))
    some = model.variances > RANK * model.variances[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        factors = np.where(some[:, None], model.directions / np.sqrt(model.variances)[:, None], np.nan).T

    def deviations(x: np.ndarray) -> list[int | None]:
        exact = _exact(x, model.n, model.sums)
        if exact.dtype == np.int64 and x.shape[1] * max(abs(int(exact.max())), abs(int(exact.min()))) ** 2 < _LONG:
            return (exact * exact).sum(1).tolist()
        return [d if (d := sum(v * v for v in row)) < _LONG else None for row in exact.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches, 1):
            w = _centred(x, model.n, model.sums) @ factors
            flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviations(x), pa.int64()), lists], names=schema.names)

    return rows.select("_key", "x").mapInArrow(run, schema)


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the covariance of `whitened` less the identity; the covariance is centred before multiplying."""
    kept = [i for i, v in enumerate(model.variances) if v > RANK * model.variances[0]]
    if not kept:
        return None
    of = [F.col("whitened")[i] for i in kept]
    means = whitened.agg(*[F.avg(c) for c in of]).first()
    pairs = [(i, j) for i in range(len(kept)) for j in range(i, len(kept))]
    found = whitened.agg(*[F.avg((of[i] - means[i]) * (of[j] - means[j])) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row for each vector that stays and each component: key, component, n, deviation, whitened, explained, identity_error."""
    rows = whole_vectors(vectors, key, vector)
    fit = staged(rows.select("x").distinct(), "whitening")
    model = fit_whitening(fit, components)
    kind = rows.schema["_key"].dataType
    if model is None:
        none = rows.select("_key", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).where("false")
        model = Whitening(0, [], np.zeros(1), 0.0, np.zeros((1, 0)))
        error, found = None, none
    else:
        found = apply_whitening(rows, model)
        error = identity_error(apply_whitening(fit.select(F.lit(None).cast(kind).alias("_key"), "x"), model), model)
    shares = [float(v / model.total) if model.total else None for v in model.variances]
    each = found.select("_key", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    explained = F.array(*[F.lit(s).cast("double") for s in shares])[F.col("_at")]
    return each.select(F.col("_key").alias(key), (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                       "deviation", "whitened", explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
