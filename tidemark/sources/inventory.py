"""File inventories: what lies in a folder, how large it is, whether it can be read."""

from __future__ import annotations

import importlib
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import MERGE_THRESHOLD, target_files


def file_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, partition, length, modified) for each data file below a folder or several.

    Files are listed, not opened, because `content` is never selected. `partition` is the
    `a=1/b=2` part of the path, empty where there is none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    spec = F.regexp_extract("path", "/((?:[^/=]+=[^/]*/)*[^/=]+=[^/]*)/[^/]*$", 1)
    return files.select(
        "path", spec.alias("partition"), "length", F.col("modificationTime").alias("modified")
    )


def partition_sizes(inventory: DataFrame) -> DataFrame:
    """(partition, files, total_bytes, max_file_bytes, avg_file_bytes)"""
    return inventory.groupBy("partition").agg(
        F.count("*").alias("files"),
        F.sum("length").alias("total_bytes"),
        F.max("length").alias("max_file_bytes"),
        F.floor(F.sum("length") / F.count("*")).alias("avg_file_bytes"),
    )


def with_target_files(sizes: DataFrame, threshold: int = MERGE_THRESHOLD) -> DataFrame:
    wanted = target_files("total_bytes", "max_file_bytes", "files", threshold)
    return sizes.withColumn("target_files", wanted)


def rewrite_decision(sizes: DataFrame, threshold: int = MERGE_THRESHOLD) -> DataFrame:
    """Add `decision`: `copy` where files are large on average, else `rewrite`."""
    large = F.col("avg_file_bytes") > threshold
    return sizes.withColumn("decision", F.when(large, "copy").otherwise("rewrite"))


def file_path(path: str | Column) -> Column:
    """A path as listings have it, from a scan's percent-encoded `_metadata.file_path` URI."""
    column = F.col(path) if isinstance(path, str) else path
    decoded = F.url_decode(F.regexp_replace(column, "[+]", "%2B"))
    return F.regexp_replace(decoded, "^file:/+", "/")


class _Source:
    """A file for a format's reader; keeps the error of the storage itself apart from those of the reader."""

    def __init__(self, raw):
        self.raw, self.failure, self.closed = raw, None, False

    def _call(self, name, *args):
        try:
            return getattr(self.raw, name)(*args)
        except OSError as failure:
            self.failure = failure
            raise

    def read(self, *size):
        return self._call("read", *size)

    def seek(self, *place):
        return self._call("seek", *place)

    def tell(self):
        return self.raw.tell()

    def size(self):
        return self.raw.size()

    def readable(self):
        return True

    def seekable(self):
        return True

    def writable(self):
        return False

    def flush(self):
        pass

    def close(self):
        self.closed = True
        self.raw.close()


def _chunks(source: _Source, at: int, length: int):
    """The contents of the zstd chunks that fill a range of an ORC file, one at a time."""
    end = at + length
    while at < end:
        source.seek(at)
        head = int.from_bytes(source.read(3), "little")
        at += 3 + (head >> 1)
        if at > end:
            raise ValueError(f"a chunk of {head >> 1} bytes passes the end of its stripe")
        data = source.read(head >> 1)
        yield data if head & 1 else pa.CompressedInputStream(pa.BufferReader(data), "zstd").read()


def _fields(message: bytes):
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, message[at : at + size]
            at += size


def _check_chunks(source: _Source, orc) -> None:
    """Reads every chunk of the stripes: the ORC reader goes on after a zstd chunk that can't be decompressed."""
    size = source.size()
    footer = b"".join(_chunks(source, size - 1 - orc.file_postscript_length - orc.file_footer_length, orc.file_footer_length))
    for number, stripe in _fields(footer):
        if number == 3:
            place = dict(_fields(stripe))
            for _ in _chunks(source, place[1], sum(place.get(i, 0) for i in (2, 3, 4))):
                pass


def _rows_of(source: _Source, file_format: str) -> int:
    """Rows of a file, all columns of which are read, a stripe or batch at a time."""
    if file_format == "orc":
        orc = importlib.import_module("pyarrow.orc").ORCFile(source)
        if orc.compression == "ZSTD":
            _check_chunks(source, orc)
        found, said = sum(orc.read_stripe(i).num_rows for i in range(orc.nstripes)), orc.nrows
    else:
        parquet = importlib.import_module("pyarrow.parquet").ParquetFile(source)
        found, said = sum(b.num_rows for b in parquet.iter_batches()), parquet.metadata.num_rows
    if found != said:
        raise ValueError(f"{found} rows read, {said} announced")
    return found


def file_audit(spark: SparkSession, path: str, file_format: str = "orc") -> DataFrame:
    """(path, rows, readable, error) for each file of a folder with the format's extension, orc or parquet.

    Files are dealt out to tasks, which read every column of theirs. A file whose content can't be read, or holds other
    rows than its footer says, is damaged: it has no rows and an error. ORC has no checksums: a change inside a chunk that
    still decompresses can't be told. An empty file of the format has 0 rows.
    A storage that fails is no damage: that error ends the job.
    """
    listed = file_inventory(spark, path).filter(F.col("path").endswith(f".{file_format}")).select("path", "length")
    dealt = listed.repartition(spark.sparkContext.defaultParallelism * 4, "path")

    def audit(batches):
        for b in batches:
            rows, errors = [], []
            for name in b.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "/", name))
                with system.open_input_file(place) as raw:
                    source, count, error = _Source(raw), None, None
                    try:
                        count = _rows_of(source, file_format)
                    except Exception as damage:
                        if source.failure:
                            raise source.failure from damage
                        error = f"{type(damage).__name__}: {damage}"[:500]
                rows.append(count)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.int64()), pa.array(errors, pa.string())],
                                             names=["path", "rows", "error"])

    found = dealt.select("path").mapInArrow(audit, "path string, rows long, error string")
    return found.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "rows", F.col("error").isNull().alias("readable"), "error")
