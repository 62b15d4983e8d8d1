"""Writing: partitions, tables like others, several outputs from one pass."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import partition_columns, spec_sql, table_exists

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def create_like(spark: SparkSession, source: str, target: str, location: str | None = None) -> bool:
    """Create an empty table with the columns and partitions of another, unless it exists.

    Returns whether it was created.
    """
    if table_exists(spark, target):
        return False
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {target} LIKE {source}{place}")
    return True


def create_partitioned(spark: SparkSession, df: DataFrame, name: str, partition, location: str) -> None:
    """A new parquet table at a location, filled from `df`.

    The rebalance hint gathers the rows of a partition into few files and splits a partition
    that would fill more than one task.
    """
    df.hint("rebalance", *partition).write.format("parquet").partitionBy(*partition).option("path", location).saveAsTable(name)


def overwrite_partition(df: DataFrame, name: str, spec: dict[str, object]) -> None:
    """Replace what `spec` names with the rows of `df`; other partitions stay as they are.

    A spec of all partition columns replaces that one partition, also by nothing at all. A spec
    of some of them replaces those partitions under it that `df` has rows for. The remaining
    partition columns are taken from the catalog and read from the columns of `df`.
    """
    spark = df.sparkSession
    dynamic = [c for c in partition_columns(spark, name) if c not in spec]
    plain = [c.name for c in spark.catalog.listColumns(name) if not c.isPartition]
    clause = ", ".join([spec_sql(spec)] * bool(spec) + [f"`{c}`" for c in dynamic])
    mode = "dynamic" if dynamic else "static"
    with setting(spark, OVERWRITE_MODE, mode):
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({clause}) SELECT * FROM {{rows}}",
            rows=df.select(*plain, *dynamic),
        )


def overwrite_dynamic(df: DataFrame, path: str, partition) -> None:
    """Write to a partitioned folder and replace only the partitions `df` has rows for."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition).parquet(path)


def drop_partition(spark: SparkSession, name: str, spec: dict[str, object]) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec_sql(spec)})")


def write_outputs(results: DataFrame, path: str, tag: str = "outcome") -> None:
    """All tagged outputs in one pass, a folder per tag below `path`."""
    results.write.mode("overwrite").partitionBy(tag).parquet(path)


def split_outputs(results: DataFrame, tags, tag: str = "outcome") -> dict[str, DataFrame]:
    """The named outputs of an operator that tags its rows."""
    return {name: results.filter(F.col(tag) == name) for name in tags}
