"""Reading: parquet tables, delimited text, ranges, partitions and the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import field

CLICK_SCHEMA = "user_id bigint, ad_id bigint, province string, city string, click_time bigint"
ORDER_SCHEMA = "order_id string, order_type string, tx_id string, order_time bigint"
RECEIPT_SCHEMA = "tx_id string, pay_type string, pay_time bigint"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_delimited(spark: SparkSession, path: str, schema: str, stream: bool = False, **options) -> DataFrame:
    """Comma-separated text without header, columns by position. A bad number fails the read."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(mode="FAILFAST", header=False, **options).csv(path)


def parse_delimited(df: DataFrame, text: str, schema: str, separator: str = ",") -> DataFrame:
    """Split a text column into typed columns by position. A bad number fails the query."""
    fields = T.StructType.fromDDL(schema).fields
    return df.select(
        *[field(text, i, separator).cast(f.dataType).alias(f.name) for i, f in enumerate(fields, 1)]
    )


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table from a short list written in the program."""
    return spark.createDataFrame(rows, schema)


def range_scan(spark: SparkSession, start: int, end: int, inclusive: bool = False) -> DataFrame:
    """(id): the whole numbers from `start`, up to `end` or just before it."""
    return spark.range(start, end + 1 if inclusive else end)


def spec_conditions(spec: dict[str, object]) -> list[Column]:
    return [F.col(name) == value for name, value in spec.items()]


def partition_scan(df: DataFrame, spec: dict[str, object], keep_spec: bool = False) -> DataFrame:
    """The rows of one partition. Conditions on partition columns prune whole folders."""
    for condition in spec_conditions(spec):
        df = df.filter(condition)
    return df if keep_spec else df.drop(*spec)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    """(partition): the specs the catalog knows, such as `a=1/b=2`."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def table_location(spark: SparkSession, name: str, spec: dict[str, object] | None = None) -> str:
    part = f" PARTITION ({spec_sql(spec)})" if spec else ""
    details = spark.sql(f"DESCRIBE FORMATTED {name}{part}")
    # One line of catalog text.
    found = details.filter("col_name = 'Location'").select("data_type").collect()
    return found[0][0].removeprefix("file:")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def spec_sql(spec: dict[str, object]) -> str:
    """`{a: 1, b: x}` as the text of a static PARTITION clause."""

    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, (int, float)):
            return str(value)
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{name}` = {literal(value)}" for name, value in spec.items())
