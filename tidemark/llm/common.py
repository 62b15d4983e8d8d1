"""What the operators of this package share: words, table access, staging in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch

#: The blanks that separate words, as a regular expression class, and its complement.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """The rows of `df`, written once below the shared folder and read back.

    Cuts the lineage: rows can't change when a lost executor's tasks run again, and iterative
    plans stay short.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Number of words of a text; a null has none."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def with_bucket_starts(cells: DataFrame, within: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds `name`: the sum of `value` over all cells of the same `within` that come earlier in `order`.

    For pre-aggregated cells, of which there is a bounded number for each `within`.
    """
    from pyspark.sql import Window as W

    before = W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return cells.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
