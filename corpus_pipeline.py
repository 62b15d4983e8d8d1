"""From raw documents to packed sequences: five stages, each one operator of `tidemark.llm`.

A stage takes (spark, docs, sf_dir) and returns the next one's documents; the last returns the pieces with
their places. Key: doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, packing, set_join, toxicity
from tidemark.llm.common import staged, table

CAPACITY = 2048


def _as_struct(docs: DataFrame):
    """All columns as one, so that none of their names can meet one of an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """(_n, _doc): the rows with numbers of their own, written, so that each decision is one about a row and not about a key."""
    return staged(docs.select(F.monotonically_increasing_id().alias("_n"), _as_struct(docs)), label)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on this input's labels, predicts to be toxic.

    Each row is judged by its own text. A null or empty text is judged as one without words and stays unless such texts are
    mostly toxic; null and repeated keys stay or go with their texts. Without labels of both kinds the share of toxic labels is
    everyone's score. Further columns, whatever their names, come along.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.score(docs.select(_as_struct(docs), "text"), model, keys=("_doc",))
    return judged.where("predicted = 0").select("_doc.*")


def exact_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each set of documents whose normalised texts are equal: the smallest doc_id, a null one last.

    Null and empty texts are copies of one another. Of rows with one key and text one stays; rows with one key and other
    texts are judged by their texts. Further columns come along.
    """
    return exact_dedup.deduplicate(docs)


def near_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near duplicates: the smallest doc_id, a null one last, then the first row.

    Texts without words are near nothing and stay. Rows that share a doc_id are documents of their own. Further columns come along.
    """
    rows = _numbered(docs, "near")
    keyed = rows.select(F.struct(F.col("_doc.doc_id").isNull().alias("none"), F.col("_doc.doc_id").alias("id"), "_n").alias("key"), F.col("_doc.text").alias("text"))
    stay = set_join.near_duplicates(keyed, key="key").where("key = component_id").select("key._n")
    return rows.join(stay, "_n", "left_semi").select("_doc.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it.

    A null source is one of its own. Texts without words have no size and are taken as others of their source are. Rows that share
    a doc_id are drawn for themselves. Further columns come along with every copy.
    """
    rows = _numbered(docs, "mixed")
    read = rows.select("_n", "_doc.doc_id", "_doc.source", "_doc.text")
    taken = mixing.mix(read, row="_n").where("copies > 0").select(F.col("_row").alias("_n"), "copies")
    met = rows.join(taken, "_n")
    return met.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of CAPACITY: one row per piece. A repeated document is packed each time.

    A null or empty text is the end token alone. Null keys are kept; further columns are not.
    """
    return packing.pack_documents(docs, CAPACITY)


STAGES = [
    ("toxicity", toxicity_filter), ("exact_dedup", exact_dedup_filter), ("near_dedup", near_dedup_filter),
    ("mixing", mixing_stage), ("packing", packing_stage),
]
#: SQL can't express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
