"""Ranked lexical search: best-first intervals of documents, bounded by range maxima of every posting list.

The index is a table of postings, one row for each term of a segment. A segment is what one task has read up to SEGMENT_TOKENS
tokens; there the documents are numbered by length, then by id, so that neighbours score alike. A search gathers the
postings of the query's terms by segment. Every posting list gets a sparse table of the maxima of its impacts (with the place
of each), which bounds any interval of documents by the weighted sum of the lists' maxima in it. The best interval
is split at the document that holds the maximum of the heaviest list; this document is scored exactly, and what is
left and right of it goes back to the queue. An interval ends when its bound can't reach the k-th best score so far, or
only equal it with larger ids. Queries are answered in blocks; a first pass over one segment in SAMPLE_EVERY gives
each query a score that its k-th best document reaches at least, from which all segments start.

The arithmetic is that of the integer BM25 of `Statistics`: all scores are exact 64-bit integers.

Nulls and texts without a term are no documents and match nothing; a query without a term has no hits. Repeated rows are
documents of their own. Equal scores go by ascending id, a null id last; ids need an order. Repeated or null query ids are
queries of their own. Empty tables give an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm.common import staged, text_or_empty

#: Bytes that are no part of a term become spaces, A-Z become a-z; bytes from 0x80 on belong to terms.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
#: Tokens of a segment; a longer document is a segment of its own.
SEGMENT_TOKENS = 2_000_000
#: Queries, and their terms, that one pass over the index answers.
BLOCK_QUERIES, BLOCK_TERMS = 512, 200_000
#: Intervals that are split at once.
FRONTIER = 48
#: One segment of so many is searched first, for scores to start from.
SAMPLE_EVERY = 16
_LOW = np.int64((1 << 32) - 1)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Statistics(NamedTuple):
    documents: int
    tokens: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        """The lengths' share of the denominators, per document."""
        if len(lengths) and int(lengths.max()) * 90 * self.documents >= 1 << 63:
            return np.array([10 + 90 * int(n) * self.documents // self.tokens for n in lengths], np.int64)
        return 10 + 90 * lengths * self.documents // self.tokens


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * norm)


def _cells(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Slices of `values` between the edges, as binary cells without a copy of each."""
    width = values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer((edges * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """(segment, term, df, docs, tfs) for each term of a segment, and one row with a null term: ids, lengths, sums.

    `docs` and `tfs` are packed 32-bit numbers, `lengths` 64-bit ones. A document's number is its place in `ids`, which are
    in order of length and id.
    """
    kind = docs.schema[key].dataType
    schema = StructType([StructField("segment", LongType()), StructField("term", BinaryType()), StructField("df", LongType()),
                         StructField("docs", BinaryType()), StructField("tfs", BinaryType()), StructField("lengths", BinaryType()),
                         StructField("tokens", LongType())])
    read = (docs.select(F.col(f"`{key}`").alias("_key"), text_or_empty(f"`{text}`").cast("binary").alias("_text"))
            .withColumn("_part", F.spark_partition_id().cast("long")))
    schema = schema.add("ids", ArrayType(kind))

    def flush(name: int, keys: list, tokens: list[np.ndarray], names: list[bytes], ids_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(t) for t in tokens], np.int64)
        # Order of length, then id (nulls last): a document's number is its place there.
        rank = sorted(range(len(keys)), key=lambda i: (-int(lengths[i]), keys[i] is None, keys[i] if keys[i] is not None else 0))
        place = np.empty(len(keys), np.int64)
        place[rank] = np.arange(len(keys))
        found = np.concatenate(tokens).astype(np.int64) << np.int64(32) | np.repeat(place, lengths)
        pairs, tf = np.unique(found, return_counts=True)
        term, doc = pairs >> np.int64(32), (pairs & _LOW).astype(np.int32)
        edges = np.append(np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))), len(term))
        none = lambda n, t: pa.nulls(n, t)
        n = len(edges) - 1
        columns = [pa.array(np.full(n, name)), pa.array([names[i] for i in term[edges[:-1]]], pa.binary()), pa.array(np.diff(edges)),
                   _cells(doc, edges), _cells(tf.astype(np.int32), edges), none(n, pa.binary()), none(n, pa.int64()), none(n, ids_type)]
        rows = pa.RecordBatch.from_arrays(columns, names=schema.names)
        for at in range(0, n, 10_000):
            yield rows.slice(at, 10_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), none(1, pa.binary()), pa.array([len(keys)], pa.int64()), none(1, pa.binary()), none(1, pa.binary()),
             pa.array([lengths[rank].tobytes()], pa.binary()), pa.array([int(lengths.sum())], pa.int64()), pa.array([[keys[i] for i in rank]], ids_type)],
            names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, tokens, held, count, part, ids_type = [], [], 0, 0, 0, pa.list_(pa.int64())
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        for b in batches:
            ids_type = pa.list_(b.schema.field(0).type)
            for key_, text_, part_ in zip(b.column(0), b.column(1), b.column(2)):
                words = terms_of(text_.as_py())
                if not words:
                    continue
                if held and held + len(words) > segment_tokens:
                    yield from flush((part << 24) + count, keys, tokens, list(vocabulary), ids_type)
                    keys, tokens, held, count = [], [], 0, count + 1
                    vocabulary.clear()
                part = part_.as_py()
                keys.append(key_.as_py())
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                held += len(words)
        if keys:
            yield from flush((part << 24) + count, keys, tokens, list(vocabulary), ids_type)

    return staged(read.mapInArrow(run, schema), "lexical")


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(query, _key, term): the distinct terms of every query row; `query` numbers the rows."""
    schema = StructType([StructField("query", LongType()), queries.schema[key], StructField("term", BinaryType())])
    schema = StructType([schema[0], StructField("_key", schema[1].dataType), schema[2]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms_of(t.as_py()))) for t in b.column(2)]
            at = pa.array(np.repeat(np.arange(b.num_rows), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([t for f in found for t in f], pa.binary())], names=schema.names)

    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col(f"`{key}`").alias("_key"),
                          text_or_empty(f"`{text}`").cast("binary").alias("_text"))
    return staged(rows.mapInArrow(run, schema), "lexical")


class Segment:
    """The postings of one segment for the terms of a block, with their range-maximum tables."""

    def __init__(self, terms: np.ndarray, docs: list[np.ndarray], tfs: list[np.ndarray], norms: np.ndarray, ranks: np.ndarray):
        """`terms`: their numbers in the block, ascending. `ranks`: the documents' places in the order of ids."""
        self.size, self.terms = len(norms), terms
        self.ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64) if docs else self.ends
        doc = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
        self.doc = doc
        self.impact = impacts(np.concatenate(tfs).astype(np.int64), norms[doc]) if docs else doc
        #: A posting's list and document in one ascending number.
        self.place = np.repeat(np.arange(len(docs), dtype=np.int64), self.ends - self.starts) * self.size + doc
        # Maxima over 2^level postings; the low half prefers the leftmost of equal impacts.
        self.best = _sparse_table(self.impact << np.int64(32) | (_LOW - np.arange(len(doc))), np.maximum, int((self.ends - self.starts).max(initial=1)))
        self.ranks = ranks
        self.least = _sparse_table(ranks, np.minimum, self.size)
        self.splits = 0

    def _range(self, table: np.ndarray, a: np.ndarray, b: np.ndarray, pick, empty: int) -> np.ndarray:
        some = b > a
        level = np.frexp(np.where(some, b - a, 1))[1] - 1
        low = np.where(some, a, 0)
        found = pick(table[level, low], table[level, np.where(some, b - (1 << level), 0)])
        return np.where(some, found, empty)

    def _bounds(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sums of the lists' maxima, and the document at which to split."""
        top = self._range(self.best, a, b, np.maximum, 0)
        shares = (top >> np.int64(32)) * weights
        heavy = shares.argmax(1)
        where = _LOW - (top[np.arange(len(top)), heavy] & _LOW)
        return shares.sum(1), self.doc[np.minimum(where, len(self.doc) - 1)]

    def search(self, lists: np.ndarray, weights: np.ndarray, k: int, floor: int = 1) -> list[tuple[int, int]]:
        """The k best (score, document) that score `floor` or more, by score and rank. `lists`: places in `terms`."""
        a, b = self.starts[lists][None, :], self.ends[lists][None, :]
        bound, split = self._bounds(a, b, weights)
        lo, hi = np.zeros(1, np.int64), np.full(1, self.size)
        top: list[tuple[int, int, int]] = []  # (score, -rank, document), the worst first
        while len(bound):
            if len(top) == k:
                worst, rank = top[0][0], -top[0][1]
                hope = bound >= worst
                tied = np.flatnonzero(bound == worst)
                if len(tied):
                    hope[tied] = self._range(self.least, lo[tied], hi[tied], np.minimum, self.size) < rank
            else:
                hope = bound >= floor
            if not hope.all():
                a, b, bound, split, lo, hi = a[hope], b[hope], bound[hope], split[hope], lo[hope], hi[hope]
            if not len(bound):
                break
            if len(bound) > FRONTIER:
                order = np.argpartition(-bound, FRONTIER)
                now, later = order[:FRONTIER], order[FRONTIER:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            self.splits += len(now)
            sa, sb, d = a[now], b[now], split[now]
            at = np.searchsorted(self.place, lists[None, :] * self.size + d[:, None])
            there = at < sb
            there[there] = self.doc[at[there]] == np.broadcast_to(d[:, None], at.shape)[there]
            score = np.where(there, self.impact[np.minimum(at, len(self.doc) - 1)] * weights, 0).sum(1)
            for s, doc, r in zip(score.tolist(), d.tolist(), self.ranks[d].tolist()):
                if s >= floor and (len(top) < k or (s, -r) > top[0][:2]):
                    (heapq.heappush if len(top) < k else heapq.heapreplace)(top, (s, -r, doc))
            na, nb = np.concatenate((sa, at + there)), np.concatenate((at, sb))
            nlo, nhi = np.concatenate((lo[now], d + 1)), np.concatenate((d, hi[now]))
            some = nhi > nlo
            na, nb, nlo, nhi = na[some], nb[some], nlo[some], nhi[some]
            nbound, nsplit = self._bounds(na, nb, weights)
            a, b = np.concatenate((a[later], na)), np.concatenate((b[later], nb))
            bound, split = np.concatenate((bound[later], nbound)), np.concatenate((split[later], nsplit))
            lo, hi = np.concatenate((lo[later], nlo)), np.concatenate((hi[later], nhi))
        return [(s, doc) for s, _, doc in sorted(top, reverse=True)]


def _sparse_table(values: np.ndarray, pick, longest: int) -> np.ndarray:
    """Row `level` has at each place what `pick` makes of the 2^level values from there on."""
    levels = max(1, int(longest).bit_length())
    table = np.empty((levels, max(1, len(values))), np.int64)
    table[0, : len(values)] = values
    for level in range(1, levels):
        step = 1 << (level - 1)
        table[level] = table[level - 1]
        table[level, : max(0, len(values) - step)] = pick(table[level - 1, : len(values) - step], table[level - 1, step : len(values)])
    return table


class Block(NamedTuple):
    """Queries of one pass: of query i the terms at terms[edges[i]:edges[i+1]], and the score to start from."""

    queries: np.ndarray
    edges: np.ndarray
    terms: np.ndarray
    weights: np.ndarray  # by term
    floors: np.ndarray


def _search_segments(rows: DataFrame, kind, block: Block, stats: Statistics, k: int) -> DataFrame:
    """(query, _id, score) of each segment's best documents; rows: (segment, t, docs, tfs, ids, lengths)."""
    schema = StructType([StructField("query", LongType()), StructField("_id", kind), StructField("score", LongType())])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, docs, tfs, ids, lengths = [], [], [], pa.array([], pa.int64()), np.zeros(0, np.int64)
        for b in batches:
            for t, d, f, packed, who in zip(b.column("t"), b.column("docs"), b.column("tfs"), b.column("lengths"), b.column("ids")):
                if t.is_valid:
                    numbers.append(t.as_py())
                    docs.append(np.frombuffer(d.as_buffer(), np.int32).copy())
                    tfs.append(np.frombuffer(f.as_buffer(), np.int32).copy())
                else:
                    ids, lengths = who.values, np.frombuffer(packed.as_buffer(), np.int64).copy()
        if not numbers:
            return
        order = np.argsort(numbers, kind="stable")
        keys = ids.to_pylist()
        ranks = np.empty(len(keys), np.int64)
        ranks[sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] if keys[i] is not None else 0))] = np.arange(len(keys))
        here = np.array(numbers, np.int64)[order]
        segment = Segment(here, [docs[i] for i in order], [tfs[i] for i in order], stats.norms(lengths), ranks)
        found: list[tuple[int, int, int]] = []
        for i, query in enumerate(block.queries.tolist()):
            wanted = block.terms[block.edges[i] : block.edges[i + 1]]
            at = np.searchsorted(here, wanted)
            there = (at < len(here)) & (here[np.minimum(at, len(here) - 1)] == wanted)
            there &= block.weights[wanted] > 0
            if there.any():
                found += [(query, d, s) for s, d in segment.search(at[there], block.weights[wanted[there]], k, int(block.floors[i]))]
        query, doc, score = zip(*found) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), ids.take(pa.array(doc, pa.int64())), pa.array(score, pa.int64())], names=schema.names)

    return rows.groupBy("segment").applyInArrow(run, schema)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "item_id", text: str = "text", id_name: str = "doc_id") -> DataFrame:
    """The k best documents of every query: key, rank, `id_name`, score. `index` is what `build_index` returns."""
    spark = index.sparkSession
    kind = index.schema["ids"].dataType.elementType
    sums = index.where("term is null").agg(F.sum("df").alias("n"), F.sum("tokens").alias("tokens")).first()
    terms = query_terms(queries, key, text)
    shape = terms.agg(F.count_distinct("query").alias("q"), F.count(F.lit(1)).alias("t")).first()
    results = []
    blocks = max(1, -(-shape["q"] // BLOCK_QUERIES), -(-shape["t"] // BLOCK_TERMS)) if sums["n"] else 0
    for number in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number)
        df = own.select("term").distinct().join(index.select("term", "df"), "term").groupBy("term").agg(F.sum("df").alias("df"))
        # One block's terms and queries: at most about BLOCK_TERMS rows.
        known = {bytes(r["term"]): r["df"] for r in df.collect()}
        block = _block(own.select("query", "term").collect(), known, Statistics(sums["n"], sums["tokens"]))
        if not len(block.queries):
            continue
        named = spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(known)], "term binary, t int")
        wanted = index.join(F.broadcast(named), "term", "left").where("t is not null or term is null")
        rows = staged(wanted.select("segment", "t", "docs", "tfs", "lengths", "ids"), "lexical")
        stats = Statistics(sums["n"], sums["tokens"])
        sample = rows.where(F.pmod(F.xxhash64("segment"), F.lit(SAMPLE_EVERY)) == 0)
        first = _best(_search_segments(sample, kind, block, stats, k), k).where(F.col("rank") == k).select("query", "score").collect()
        floors = {r["query"]: r["score"] for r in first}
        block = block._replace(floors=np.array([floors.get(q, 1) for q in block.queries.tolist()], np.int64))
        results.append(_best(_search_segments(rows, kind, block, stats, k), k))
    names = terms.select("query", "_key").distinct()
    if not results:
        results = [_best(names.select("query", F.lit(None).cast(kind).alias("_id"), F.lit(0).cast("long").alias("score")).where("score > 0"), k)]
    best = reduce(DataFrame.unionAll, results)
    return best.join(names, "query").select(F.col("_key").alias(key), "rank", F.col("_id").alias(id_name), "score")


def _block(rows: list, known: dict[bytes, int], stats: Statistics) -> Block:
    number = {t: i for i, t in enumerate(known)}
    of: dict[int, list[int]] = {}
    for r in rows:
        if (t := number.get(bytes(r["term"]))) is not None:
            of.setdefault(r["query"], []).append(t)
    queries = sorted(of)
    lists = [np.array(sorted(of[q]), np.int64) for q in queries]
    return Block(np.array(queries, np.int64), np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64),
                 np.concatenate(lists) if lists else np.zeros(0, np.int64),
                 np.array([stats.weight(df) for df in known.values()], np.int64), np.ones(len(queries), np.int64))
