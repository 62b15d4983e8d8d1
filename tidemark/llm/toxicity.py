"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

Trained in numpy on the driver from a bounded sample of labelled documents, applied to every whole text in Arrow batches.
A word's embedding row is its hash; the row remembers the training word that owns it, so other words of that
hash are read as unknown and not as that word. Every filter reports its strongest window in the text, however long
it is. One logistic layer turns the reports into a logit.

Thresholds are calibrated by language on labelled rows that training did not see, and moved to one common
score: a text is predicted toxic from 0.3 on. The language is guessed from the text's own function words, so
labels, lang, source and keys never enter a score.

A null text counts as empty and gets the score of a text without any known word. Null labels are not learnt from; without
labels of both kinds every score is the share of toxic labels (0 without any). Repeated rows are scored each for itself; an
empty table gives an empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from tidemark.llm.common import text_or_empty

#: The bound of the labelled sample: so many toxic and so many other documents at most.
TOXIC_SAMPLE, OTHER_SAMPLE = 2_000, 4_000
ROWS, DIM, FILTERS, WIDTHS = 1 << 16, 12, 8, (1, 2, 3)
#: A word needs so many training documents to own a row.
LEAST_DOCS = 3
THRESHOLD = 0.3
#: Labelled toxic rows that a language needs for a threshold of its own.
LEAST_TOXIC = 25
UNKNOWN, PAD = 0, 1
WORDS = re.compile(r"[^\W_]+")
#: Frequent function words by which a language is guessed.
FUNCTION_WORDS = {
    "en": "the and of to in is that for was with on as are be by from or this",
    "de": "der die das und ist in den von mit ein eine nicht auf auch als zu dem des",
    "fr": "le la les des et en que qui dans un une pour pas est sur ne se au",
    "es": "el la los las de y en que un una por con no es se del al lo",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def language_of(words: list[str]) -> int:
    """Index in LANGUAGES of the language with most function words in a text."""
    counts = Counter(words)
    hits = [sum(counts[w] for w in line.split()) for line in FUNCTION_WORDS.values()]
    best = max(range(len(hits)), key=lambda i: (hits[i], -i))
    return best if hits[best] else len(hits)


@dataclass
class Model:
    rows: dict[str, int]
    embedding: np.ndarray  # ROWS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    biases: np.ndarray  # of the filters, width by width
    out: np.ndarray
    bias: float
    thresholds: np.ndarray  # logits, per language
    scale: float = 1.0


class _Known(dict):
    def __missing__(self, word):
        return UNKNOWN


def row_of(word: str) -> int:
    return zlib.crc32(word.encode()) % (ROWS - 2) + 2


def own_rows(docs_of: dict[str, int]) -> dict[str, int]:
    """The row of each word that owns one, from the number of training documents of each word: the most frequent of its hash."""
    owned: dict[int, str] = {}
    for word, n in sorted(docs_of.items(), key=lambda x: (-x[1], x[0])):
        if n < LEAST_DOCS:
            break
        owned.setdefault(row_of(word), word)
    return {w: r for r, w in owned.items()}


def flat_ids(texts: list[list[str]], rows: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row ids of all texts behind one another, padded so that no window spans two texts; where each starts."""
    known, pad = _Known(rows), [PAD] * max(WIDTHS)
    ids: list[int] = []
    starts = []
    for words in texts:
        starts.append(len(ids))
        ids.extend(map(known.__getitem__, words))
        ids.extend(pad)
    return np.asarray(ids, np.int32), np.asarray(starts, np.int64)


def pooled(ids: np.ndarray, starts: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
    """Per text the maximum of each filter; `tables[k][j]` has what a row adds as the j-th word of a window."""
    found = []
    for parts in tables:
        n = len(ids) - len(parts) + 1
        z = parts[0][ids[:n]]
        for j in range(1, len(parts)):
            z += parts[j][ids[j : n + j]]
        found.append(np.maximum.reduceat(z, starts, axis=0))
    return np.concatenate(found, axis=1)


def tables_of(model: Model) -> list[list[np.ndarray]]:
    return [[(model.embedding @ w).astype(np.float32) for w in f] for f in model.filters]


def logits(ids: np.ndarray, starts: np.ndarray, model: Model, tables=None) -> np.ndarray:
    if not len(starts):
        return np.zeros(0)
    top = pooled(ids, starts, tables or tables_of(model))
    return np.maximum(top + model.biases, 0) @ model.out + model.bias


def train(coded: list[np.ndarray], rows: dict[str, int], labels: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 0.02, seed: int = 1) -> Model:
    """Minimises the log loss by Adam over coded texts (`flat_ids` of each). The first dimension starts from smoothed log odds."""
    draw = np.random.default_rng(seed)
    embedding = draw.normal(0, 0.05, (ROWS, DIM))
    toxic, other = np.ones(ROWS), np.ones(ROWS)
    for ids, y in zip(coded, labels):
        (toxic if y else other)[np.unique(ids)] += 1
    odds = np.log(toxic / (labels.sum() + 2)) - np.log(other / (len(labels) - labels.sum() + 2))
    embedding[:, 0] = np.clip(odds, -3, 3)
    embedding[[UNKNOWN, PAD]] = 0
    filters = [draw.normal(0, 0.1, (k, DIM, FILTERS)) for k in WIDTHS]
    for f in filters:
        f[0, 0, : FILTERS // 2] += 0.5
    size = FILTERS * len(WIDTHS)
    model = Model(rows, embedding, filters, np.zeros(size) - 0.1, draw.normal(0.2, 0.05, size), -1.0, np.zeros(len(LANGUAGES)))
    dense = [*filters, model.biases, model.out]
    first, second = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    grown = np.full(ROWS, 1e-8)
    step, bias_m, bias_v = 0, 0.0, 0.0
    for _ in range(epochs):
        order = draw.permutation(len(coded))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            ids = np.concatenate([coded[i] for i in some])
            starts = np.concatenate(([0], np.cumsum([len(coded[i]) for i in some])[:-1]))
            own = np.repeat(np.arange(len(some)), [len(coded[i]) for i in some])
            values = model.embedding[ids]
            tops, places = [], []
            for f in filters:
                n = len(ids) - len(f) + 1
                z = sum(values[j : n + j] @ f[j] for j in range(len(f)))
                top = np.maximum.reduceat(z, starts, axis=0)
                hits = z == top[own[:n]]
                place = np.empty(top.shape, np.int64)
                for c in range(FILTERS):
                    at_c = np.flatnonzero(hits[:, c])
                    place[own[at_c[::-1]], c] = at_c[::-1]
                tops.append(top)
                places.append(place)
            raw = np.concatenate(tops, axis=1) + model.biases
            active = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-(active @ model.out + model.bias)))
            d = (p - labels[some]) / len(some)
            d_raw = d[:, None] * model.out * (raw > 0)
            grads, touched, pulls = [], [], []
            for w, (f, place) in enumerate(zip(filters, places)):
                part = d_raw[:, w * FILTERS : (w + 1) * FILTERS]
                g = np.zeros_like(f)
                for j in range(len(f)):
                    x = values[place + j]  # documents x FILTERS x DIM
                    g[j] = np.einsum("df,dfe->ef", part, x)
                    touched.append(ids[place + j].ravel())
                    pulls.append((part[:, :, None] * f[j].T).reshape(-1, DIM))
                grads.append(g)
            grads += [d_raw.sum(0), active.T @ d + 1e-4 * model.out]
            step += 1
            for param, g, m, v in zip(dense, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            bias_m += 0.1 * (d.sum() - bias_m)
            bias_v += 0.001 * (d.sum() ** 2 - bias_v)
            model.bias -= rate * (bias_m / (1 - 0.9**step)) / (np.sqrt(bias_v / (1 - 0.999**step)) + 1e-8)
            which, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            pull = np.zeros((len(which), DIM))
            np.add.at(pull, inverse, np.concatenate(pulls))
            grown[which] += (pull**2).mean(1)
            pull /= np.sqrt(grown[which])[:, None]
            pull[which < 2] = 0
            model.embedding[which] -= rate * pull
    return model


def best_threshold(values: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the gap between two logits at which F1 is largest."""
    order = np.argsort(-values, kind="stable")
    v, y, w = values[order], labels[order], weights[order]
    hit, taken = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hit / (taken + (w * y).sum())
    f1[:-1][v[:-1] == v[1:]] = -1
    best = int(np.argmax(f1))
    return float((v[best] + v[best + 1]) / 2) if best + 1 < len(v) else float(v[best] - 1e-6)


def calibrate(model: Model, coded: list[np.ndarray], langs: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
    starts, tables = np.zeros(1, np.int64), tables_of(model)
    found = np.array([logits(ids, starts, model, tables)[0] for ids in coded])
    if len(found) and 0 < labels.sum() < len(labels):
        model.thresholds[:] = best_threshold(found, labels, weights)
        for i in range(len(LANGUAGES)):
            here = langs == i
            if labels[here].sum() >= LEAST_TOXIC and (1 - labels[here]).sum() >= LEAST_TOXIC:
                model.thresholds[i] = best_threshold(found[here], labels[here], weights[here])
        model.scale = max(1e-3, float(found.std()))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | float:
    """The model, from at most TOXIC_SAMPLE + OTHER_SAMPLE labelled rows; the share of toxic labels if one kind is missing.

    Rows whose crc32 of the key as text has the remainder 2 by 4 are never read; those with 3 calibrate.
    """
    part = F.crc32(F.col("_key").cast("string").cast("binary")) % 4
    known = (labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("y"))
             .where("_key is not null and y is not null").withColumn("part", part).where("part != 2"))
    totals = {r["y"]: r["n"] for r in known.where("y in (0, 1)").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("_key"), "_key").limit(n)
    sample = by_hash(1, TOXIC_SAMPLE).unionAll(by_hash(0, OTHER_SAMPLE))
    read = docs.select(F.col(f"`{key}`").alias("_key"), text_or_empty(f"`{text}`").alias("_text"))
    # The broadcast side has TOXIC_SAMPLE + OTHER_SAMPLE rows at most.
    rows = read.join(F.broadcast(sample), "_key").select("_key", "_text", "y", "part").toArrow().sort_by("_key")
    y = np.asarray(rows.column("y")).astype(float)
    if not 0 < y.sum() < len(y):
        return float(y.mean()) if len(y) else 0.0
    held = np.asarray(rows.column("part")) == 3
    if not 0 < y[~held].sum() < (~held).sum():
        held = np.zeros(len(y), bool)
    # Words are read twice rather than kept, for the driver's memory.
    docs_of: Counter = Counter()
    langs = []
    for t, h in zip(rows.column("_text"), held):
        words = words_of(t.as_py())
        langs.append(language_of(words))
        if not h:
            docs_of.update(set(words))
    owned = own_rows(docs_of)
    del docs_of
    coded, langs = [flat_ids([words_of(t.as_py())], owned)[0] for t in rows.column("_text")], np.array(langs)
    weight = np.where(y == 1, totals.get(1, 0) / max(1, y.sum()), totals.get(0, 0) / max(1, (1 - y).sum()))
    model = train([c for c, h in zip(coded, held) if not h], owned, y[~held])
    check = held if 0 < y[held].sum() < held.sum() else ~held
    calibrate(model, [c for c, h in zip(coded, check) if h], langs[check], y[check], weight[check])
    model.embedding = model.embedding.astype(np.float32)
    return model


def scores(texts: list[list[str]], model: Model, tables=None) -> np.ndarray:
    """0 to 1, with THRESHOLD at the threshold of the text's language."""
    over = (logits(*flat_ids(texts, model.rows), model, tables) - model.thresholds[[language_of(t) for t in texts]]) / model.scale if texts else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(3 * over + np.log(THRESHOLD / (1 - THRESHOLD)), -700, 700)))


_TABLES: dict[str, list] = {}


def score(docs: DataFrame, model: Model | float, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The key columns with score and predicted."""
    read = docs.select(*[F.col(f"`{k}`") for k in keys], text_or_empty(f"`{text}`").alias("_text"))
    schema = StructType(read.schema.fields[:-1]).add("score", DoubleType()).add("predicted", IntegerType())
    sent, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # a model is of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        if not isinstance(own, float) and name not in _TABLES:
            _TABLES.clear()
            _TABLES[name] = tables_of(own)
        for b in batches:
            found: list[np.ndarray] = []
            chunk, held = [], 0
            texts = b.column(b.num_columns - 1)
            for i in range(b.num_rows):
                chunk.append(words_of(texts[i].as_py()))
                held += len(chunk[-1])
                if held > 100_000 or i == b.num_rows - 1:
                    found.append(scores(chunk, own, _TABLES[name]) if not isinstance(own, float) else np.full(len(chunk), own))
                    chunk, held = [], 0
            value = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(value, pa.float64()),
                                              pa.array((value >= THRESHOLD).astype(np.int32))], names=schema.names)

    return read.mapInArrow(run, schema)
