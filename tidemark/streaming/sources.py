"""Stream input, sinks and restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ROCKSDB
from tidemark.sources.sinks import setting

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def read_stream(spark: SparkSession, path: str, schema, file_format: str = "parquet", **options) -> DataFrame:
    """A stream over the files of a folder. `maxFilesPerTrigger` or `maxBytesPerTrigger` bound
    what one micro-batch takes in."""
    return spark.readStream.format(file_format).schema(schema).options(**options).load(path)


def with_event_time(df: DataFrame, time: str, bound: str) -> DataFrame:
    """Set the watermark: the largest time seen less `bound`. Rows behind it are dropped.

    A time without zone is read in the session zone, since watermarks need a zoned type.
    """
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, bound)


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", interval: str | None = None
):
    """Process what there is, append it to parquet files and stop; with `interval`, run on.

    Started again with the same checkpoint it goes on where it stopped: no row is lost or
    written twice.
    """
    writer = stream.writeStream.format("parquet").outputMode(mode)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _start(stream, writer, interval)


def run_to_console(stream: DataFrame, label: str, mode: str = "append", interval: str = "2 seconds"):
    """Print each micro-batch; `label` names the query."""
    writer = stream.writeStream.format("console").queryName(label).outputMode(mode)
    return _start(stream, writer, interval)


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    interval: str | None = None,
):
    """Hand each micro-batch to `handle(rows, batch_id)`; same stopping rule as above.

    A batch may be handed over again after a failure, so `handle` should overwrite by id.
    """
    writer = stream.writeStream.foreachBatch(handle).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    return _start(stream, writer, interval)


def _start(stream: DataFrame, writer, interval: str | None):
    # Keyed state with timers needs the RocksDB store; it also keeps state off the heap.
    with setting(stream.sparkSession, STATE_STORE, ROCKSDB):
        if interval:
            return writer.trigger(processingTime=interval).start()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query


def batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each micro-batch to its own folder, replacing it on a retry."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
