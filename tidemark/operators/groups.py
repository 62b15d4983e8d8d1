"""Plain grouped results: counts per partition, coverage classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_counts(df: DataFrame, partition, name: str = "n") -> DataFrame:
    return df.groupBy(*partition).agg(F.count("*").alias(name))


def coverage_class(
    members: DataFrame, group: str, covered: Column, groups: DataFrame | None = None
) -> DataFrame:
    """(group, n_with, n_without, coverage): how much of each group has a property.

    `coverage` is `all`, `none` or `partial`; a group listed in `groups` without members is
    `empty`.
    """
    flag = F.coalesce(covered, F.lit(False))
    counted = members.groupBy(group).agg(
        F.count_if(flag).alias("n_with"), F.count_if(~flag).alias("n_without")
    )
    if groups is not None:
        counted = groups.select(group).distinct().join(counted, group, "left").fillna(0, ["n_with", "n_without"])
    coverage = (
        F.when((F.col("n_with") == 0) & (F.col("n_without") == 0), "empty")
        .when(F.col("n_with") == 0, "none")
        .when(F.col("n_without") == 0, "all")
        .otherwise("partial")
    )
    return counted.select(group, "n_with", "n_without", coverage.alias("coverage"))


def sorted_merge(first: DataFrame, second: DataFrame, *order: str) -> DataFrame:
    """Both inputs in one order; equal rows are all kept."""
    return first.unionByName(second).orderBy(*order)
