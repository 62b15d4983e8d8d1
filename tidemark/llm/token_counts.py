"""Token counts by a two-tier lookup on the map side.

A bounded sample of texts gives the frequent pre-tokens and their lengths in tokens. They are broadcast as one
compact table. A worker looks each pre-token up there; a miss is encoded by the tokenizer and kept in
the worker's own bounded cache. Pre-tokens never cross the network and the sample only decides which lookups are
quick: every count is the tokenizer's own.

Nulls in `text` count as empty (0 bytes, 0 tokens); a null in any other column is kept; repeated rows are counted
each for itself; an empty table gives an empty result. Extra columns stay, but for those named as the new ones,
which are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from tidemark.llm.common import text_or_empty
from tidemark.llm.tokens import KEPT_PIECE, PieceEncoder, pieces, vocabulary_path, worker_encoder

#: Texts sampled for the broadcast table, and entries of that table.
SAMPLE_TEXTS, TABLE_ENTRIES = 4_000, 50_000


def frequent_pretokens(docs: DataFrame, text: str = "text", sample: int = SAMPLE_TEXTS,
                       entries: int = TABLE_ENTRIES, path: str | None = None) -> tuple[str, bytes]:
    """The most frequent pre-tokens of a sample joined by spaces, and one byte for the length of each."""
    path = path or vocabulary_path()
    total = docs.count()
    some = docs.select(F.col(text).alias("t")).where(F.col(text).isNotNull())
    if total > sample:
        some = some.sample(sample / total, seed=7)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(p for p in pieces(t)[1:] if len(p) <= KEPT_PIECE and " " not in p)
        yield pa.RecordBatch.from_pydict({"p": list(seen), "n": list(seen.values())},
                                         schema=pa.schema([("p", pa.string()), ("n", pa.int64())]))

    top = (some.mapInArrow(count, "p string, n long").groupBy("p").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "p").limit(entries).toArrow().column("p").to_pylist())
    encoder = PieceEncoder(path, len)
    kept = [(p, encoder[p]) for p in top]  # a kept piece is short, so its length fits a byte
    return " ".join(p for p, _ in kept), bytes(n for _, n in kept)


def count_tokens(docs: DataFrame, text: str = "text", limit: int = 1024, path: str | None = None) -> DataFrame:
    """`docs` without its text, with n_bytes, n_tokens and over_limit (more than `limit` tokens)."""
    path = path or vocabulary_path()
    known = docs.sparkSession.sparkContext.broadcast(frequent_pretokens(docs, text, path=path))
    names = ("n_bytes", "n_tokens", "over_limit")
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (text, *names)], text_or_empty(f"`{text}`").alias("_text"))
    target = [f.name for f in kept.schema if f.name != "_text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, len, lambda: dict(zip(known.value[0].split(" "), known.value[1])))
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            n = [sum(encoder.of_text(t)) for t in texts]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(target))]
                + [pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[*target, *names])

    schema = StructType(kept.schema.fields[:-1]).add("n_bytes", LongType()).add("n_tokens", LongType()).add("over_limit", BooleanType())
    return kept.mapInArrow(count, schema)
