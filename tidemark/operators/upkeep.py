"""Table upkeep: copy, compact, verify and publish partitions of catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.paths import MERGE_THRESHOLD
from tidemark.operators.groups import partition_counts
from tidemark.operators.joins import count_reconcile
from tidemark.session import is_scratch, scratch
from tidemark.sources.inventory import file_inventory, file_path, partition_sizes, with_target_files
from tidemark.sources.sinks import create_like, overwrite_partition
from tidemark.sources.tables import (
    partition_columns,
    partition_scan,
    spec_sql,
    table_exists,
    table_location,
)

OK, COUNT_MISMATCH, EMPTY_SOURCE = "ok", "count_mismatch", "empty_source"
MISSING_SOURCE, READ_ERROR = "missing_source", "read_error"
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name of a null
READ_FAILURES = (PySparkException, Py4JJavaError)
OUTCOME_SCHEMA = "outcome string, source_rows bigint, target_rows bigint"


def copy_outcomes(source: DataFrame, target: DataFrame, partition, expected: DataFrame | None = None) -> DataFrame:
    """(partition, source_rows, target_rows, outcome) for each partition of a copy.

    A partition that is listed in `expected` and has no source rows is `empty_source`; one that
    only the target has is `missing_source`.
    """
    partition = list(partition)
    compared = count_reconcile(source, target, partition)
    if expected is not None:
        listed = expected.select(*partition).distinct().withColumn("_listed", F.lit(True))
        compared = listed.join(compared, partition, "full_outer")
    else:
        compared = compared.withColumn("_listed", F.lit(None).cast("boolean"))
    rows_in, rows_out = F.coalesce("source_rows", F.lit(0)), F.coalesce("target_rows", F.lit(0))
    outcome = (
        F.when((rows_in == 0) & F.col("_listed"), EMPTY_SOURCE)
        .when(rows_in == 0, MISSING_SOURCE)
        .when(rows_in == rows_out, OK)
        .otherwise(COUNT_MISMATCH)
    )
    return compared.select(
        *partition, rows_in.alias("source_rows"), rows_out.alias("target_rows"), outcome.alias("outcome")
    )


def verify_partition(spark: SparkSession, source: str, target: DataFrame, spec: dict[str, object]) -> DataFrame:
    """One row (outcome, source_rows, target_rows): was this partition copied whole?

    Both sides are really counted. A failed read is an outcome, not an exception.
    """
    outcome, counts = READ_ERROR, [None, None]
    if not table_exists(spark, source):
        outcome = MISSING_SOURCE
    else:
        try:
            counts = [partition_scan(spark.table(source), spec).count(), target.count()]
            outcome = EMPTY_SOURCE if counts[0] == 0 else OK if counts[0] == counts[1] else COUNT_MISMATCH
        except READ_FAILURES:
            pass
    return spark.createDataFrame([(outcome, *counts)], OUTCOME_SCHEMA)


def verify_subpartitions(rows: DataFrame, expected: DataFrame, partition) -> DataFrame:
    """(partition, n, verified): every expected partition with its rows; none is a failure."""
    partition = list(partition)
    counted = expected.select(*partition).distinct().join(partition_counts(rows, partition), partition, "left")
    n = F.coalesce("n", F.lit(0))
    return counted.select(*partition, n.alias("n"), (n > 0).alias("verified"))


def copy_partition(
    spark: SparkSession, source: str, target: str, spec: dict[str, object], location: str | None = None
) -> DataFrame:
    """Copy a partition into a table of the same shape, made when absent; returns the outcome."""
    create_like(spark, source, target, location)
    overwrite_partition(partition_scan(spark.table(source), spec), target, spec)
    return verify_partition(spark, source, partition_scan(spark.table(target), spec), spec)


def version_folder(spark: SparkSession, name: str) -> str:
    """A new folder for staged partitions beside the table's own, which may become the live one.

    Readers of the table's folder pass over names that start with an underscore.
    """
    return f"{table_location(spark, name)}/_versions/{uuid.uuid4().hex}"


def compact_partition(
    spark: SparkSession, name: str, spec: dict[str, object], threshold: int = MERGE_THRESHOLD
) -> tuple[str, str | None]:
    """Rewrite one partition into as few files as its size asks for and publish it when the
    counts agree; see `publish_verified` for the result.

    Rows are dealt out evenly, not by a key, so no file waits for a heavy value.
    """
    sizes = partition_sizes(file_inventory(spark, table_location(spark, name, spec)))
    # One row: the sizes of one partition.
    files = with_target_files(sizes, threshold).first()["target_files"]
    staged = f"{version_folder(spark, name)}/{spec_path(spec)}"
    partition_scan(spark.table(name), spec).repartition(files).write.parquet(staged)
    return publish_verified(spark, name, spec, staged)


def scanned_sizes(rows: DataFrame, levels: list[str]) -> DataFrame:
    """Per partition, by the values of its columns: rows, files, total_bytes, max_file_bytes, any_file.

    Files and sizes come from the scan itself, so it doesn't matter where a partition lies or what it is called.
    """
    per_file = rows.groupBy(*levels, F.col("_metadata.file_path").alias("_file")).agg(
        F.count("*").alias("_rows"), F.max("_metadata.file_size").alias("_bytes"))
    return per_file.groupBy(*levels).agg(
        F.sum("_rows").alias("rows"), F.count("*").alias("files"), F.sum("_bytes").alias("total_bytes"),
        F.max("_bytes").alias("max_file_bytes"), F.min("_file").alias("any_file"))


def compact_report(spark: SparkSession, name: str, threshold: int = MERGE_THRESHOLD) -> DataFrame:
    """Compact all partitions that have more files than they should. One row for each partition, also those that
    need no rewrite: its partition columns, files_before, target_files, files_after, rows and outcome.

    One job rewrites them together. Every file gets a number of its own and every row one of its partition's files by
    its position in the old files: rows are dealt evenly whatever they hold, and no task writes two files. The
    counts are compared, then the catalog is pointed to the new folders where they agree. Only the catalog calls for the
    partitions that change come from the driver.
    """
    levels = partition_columns(spark, name)
    same = lambda a, b: reduce(and_, [a[c].eqNullSafe(b[c]) for c in levels])
    sizes = materialised(with_target_files(scanned_sizes(spark.table(name), levels), threshold), "compaction-sizes")
    first = F.sum("target_files").over(Window.orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1))
    plan = materialised(sizes.filter("files > target_files").withColumn("_first", F.coalesce(first, F.lit(0))), "compaction-plan")
    total = plan.agg(F.sum("target_files")).first()[0] or 0
    result = [*levels, "files_before", "target_files", "files_after", "rows", "outcome"]
    left = sizes.filter("files <= target_files").select(
        *levels, F.col("files").alias("files_before"), "target_files", F.col("files").alias("files_after"), "rows", F.lit(OK).alias("outcome"))
    if not total:
        return left
    place = F.hash("_metadata.file_path").cast("long") + F.col("_metadata.row_index")
    rows = spark.table(name).withColumn("_place", place)
    wanted = plan.select(*levels, "_first", "target_files")
    dealt = rows.join(wanted, same(rows, wanted)).select(
        *[rows[c] for c in spark.table(name).columns], (F.col("_first") + F.pmod("_place", F.col("target_files"))).cast("int").alias("_no"))
    staged = version_folder(spark, name)
    dealt.repartitionById(int(total), "_no").drop("_no").write.partitionBy(*levels).parquet(staged)
    written = scanned_sizes(spark.read.schema(spark.table(name).schema).parquet(staged), levels)
    written = written.select(*levels, F.col("rows").alias("_new"), F.col("files").alias("_files"), F.col("any_file").alias("_any"))
    met = plan.join(written, same(plan, written), "left")
    outcome = F.when(F.col("_new") == F.col("rows"), OK).otherwise(COUNT_MISMATCH)
    done = materialised(met.select(*[plan[c] for c in levels], F.col("files").alias("files_before"), "target_files", F.col("_files").alias("files_after"),
                                   "rows", outcome.alias("outcome"), file_path("_any").alias("_any")), "compaction")
    point_partitions(spark, name, (({c: row[c] for c in levels}, row["_any"].rsplit("/", 1)[0])
                                   for row in done.filter(F.col("outcome") == OK).toLocalIterator()))
    return done.select(*result).unionByName(left)


def compact_table(spark: SparkSession, name: str, threshold: int = MERGE_THRESHOLD) -> dict[str, str]:
    """`compact_report` of the partitions to rewrite as {partition: outcome}; a null value is called as in a folder's name."""
    levels = partition_columns(spark, name)
    named = lambda v: DEFAULT_PARTITION if v is None else v
    rows = compact_report(spark, name, threshold).filter("files_before > target_files").toLocalIterator()
    return {spec_path({c: named(r[c]) for c in levels}): r["outcome"] for r in rows}


def materialised(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spec_path(spec: dict[str, object]) -> str:
    return "/".join(f"{name}={value}" for name, value in spec.items())


def publish_verified(spark: SparkSession, name: str, spec: dict[str, object], staged: str) -> tuple[str, str | None]:
    """Point a partition at a staged folder if the folder holds as many rows.

    A scratch folder is refused: `release` would delete the live data. Stage below `version_folder`.
    Returns the outcome and, if published, the previous folder. That folder is left as it was;
    `point_partition` with it rolls the change back. Nothing is published on any other outcome.
    """
    if is_scratch(staged, beside=table_location(spark, name)):
        raise ValueError(f"{staged} is a scratch folder and can't become a partition")
    old = table_location(spark, name, spec)
    try:
        target = spark.read.parquet(staged)
    except READ_FAILURES:
        return READ_ERROR, None
    # One row.
    outcome = verify_partition(spark, name, target, spec).first()["outcome"]
    if outcome != OK:
        return outcome, None
    point_partition(spark, name, spec, staged)
    return outcome, old


def point_partition(spark: SparkSession, name: str, spec: dict[str, object], location: str) -> None:
    point_partitions(spark, name, [(spec, location)])


def point_partitions(spark: SparkSession, name: str, places: Iterable[tuple[dict[str, object], str]]) -> None:
    """Point partitions to folders: a catalog call for each, and one refresh for all of them."""
    for spec, location in places:
        place = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec_sql(spec)}) SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)
