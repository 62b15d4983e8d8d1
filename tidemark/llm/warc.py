"""WARC archives as a chunked record table.

Records are written and read as rows of (record, chunk number): a payload above the chunk size becomes several rows,
and neither the writer nor the reader ever holds more than one chunk of it. Both carry the record's SHA-1 from chunk
to chunk; the last chunk of a record has the digest and length of the whole. Of equal payloads the one with
the smallest id is stored, the others are revisit records that refer to it.

Payloads are cut before anything else; the chunk rows are written once and shuffled once, by record. Which record is the
first of its payload is decided on narrow rows (record, digest) alone.

Each task streams into files of its own in the shared folder, one gzip member per record. The writer's result lists the
files of successful tasks; only these are read back, so what a lost task has left behind is never seen.

Null payloads count as empty. A null id is larger than all others; rows which share an id and a payload are records of
their own, of the same type. A null address leaves its header out. An empty table gives no archive and no
rows. Columns other than the three named ones are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tidemark.llm.common import staged, text_or_empty
from tidemark.session import scratch

CHUNK_BYTES, FILE_BYTES = 1 << 18, 1 << 30
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Python batches hold few chunk rows, so that a worker's memory is bounded by chunks and not by records.
BATCH_ROWS = 64
#: Shares in which the records of one payload find their first.
SALTS = 16
RECORD_ID, NO_ID = "urn:record:", "-"


def record_table(pages: DataFrame, key: str = "page_id", address: str = "url", payload: str = "html",
                 dedup_from: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows: record, address, kind, refers_to, digest, n_bytes, chunk, chunks, data.

    `record` and `refers_to` are the keys as text. Payloads of `dedup_from` bytes or more are stored once.
    """
    body = text_or_empty(f"`{payload}`").cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("record"),
                        F.col(f"`{address}`").cast("string").alias("address"), body.alias("body"))
    chunks = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / chunk_bytes)).cast("int")
    cut = rows.withColumn("chunks", chunks).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cut = cut.select("row", "record", "address", "chunk", "chunks", F.substring("body", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"))
    schema = StructType([*cut.schema.fields]).add("digest", StringType()).add("n_bytes", LongType())
    cut = staged(cut.mapInArrow(_digested, schema), "warc-chunks", "zstd")
    # Copies are found on narrow rows, one for each record. Only payloads that occur again are joined, in SALTS shares.
    whole = cut.where("chunk = chunks - 1").select("row", "record", "digest", "n_bytes", "chunks", F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    first = (whole.groupBy("digest", "n_bytes").agg(F.min("record").alias("first"), F.count("*").alias("count")).where("count > 1")
             .select("digest", "n_bytes", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")))
    again = (F.col("n_bytes") >= dedup_from) & F.col("first").isNotNull() & ~F.col("record").eqNullSafe(F.col("first"))
    marks = (whole.join(first, ["digest", "n_bytes", "salt"], "left").withColumn("again", F.coalesce(again, F.lit(False)))
             .where("again OR chunks > 1").select("row", "again", F.col("first").cast("string").alias("first"), F.col("digest").alias("found"), F.col("n_bytes").alias("length")))
    # A record's chunks come to one task in order; its header needs the digest that its last chunk has.
    known = cut.repartition("row").join(staged(marks, "warc-marks"), "row", "left").withColumn("again", F.coalesce("again", F.lit(False)))
    known = known.where("NOT again OR chunk = chunks - 1").sortWithinPartitions("row", "chunk")
    return known.select(
        F.col("record").cast("string").alias("record"), "address", F.when(F.col("again"), "revisit").otherwise("response").alias("kind"),
        F.when(F.col("again"), F.col("first")).alias("refers_to"), F.coalesce("found", "digest").alias("digest"), F.coalesce("length", "n_bytes").alias("n_bytes"),
        F.when(F.col("again"), 0).otherwise(F.col("chunk")).alias("chunk"), F.when(F.col("again"), 1).otherwise(F.col("chunks")).alias("chunks"),
        F.when(F.col("again"), F.lit(b"")).otherwise(F.col("data")).alias("data"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds digest and n_bytes of the whole payload to the last chunk of each record, carried over the chunks before it."""
    sha, size = hashlib.sha1(), 0
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            part = b.slice(at, BATCH_ROWS)
            digests, lengths = [], []
            for chunk, chunks, data in zip(part["chunk"].to_pylist(), part["chunks"].to_pylist(), part["data"]):
                if chunk == 0:
                    sha, size = hashlib.sha1(), 0
                held = data.as_buffer()
                sha.update(held)
                size += held.size
                last = chunk == chunks - 1
                digests.append(sha.hexdigest() if last else None)
                lengths.append(size if last else None)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digests, pa.string()), pa.array(lengths, pa.int64())],
                                             names=[*part.schema.names, "digest", "n_bytes"])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _name(record: str | None) -> str:
    return f"<{RECORD_ID}{NO_ID if record is None else '=' + quote(record, safe='')}>"


def _record(name: str) -> str | None:
    inner = name.strip("<>")[len(RECORD_ID):]
    return None if inner == NO_ID else unquote(inner[1:])


def _head(row: dict, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    block = len(HTTP_HEAD) + (row["n_bytes"] if row["kind"] == "response" else 0)
    lines = ["WARC/1.1", f"WARC-Type: {row['kind']}", f"WARC-Record-ID: {_name(row['record'])}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {row['n_bytes']}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {block}"]
    if row["address"] is not None:
        lines.append(f"WARC-Target-URI: {quote(row['address'], safe=':/?#[]@!$&()*+,;=%~-._')}")
    if row["kind"] == "revisit":
        lines.append(f"WARC-Refers-To: {_name(row['refers_to'])}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP_HEAD


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield from b.slice(at, BATCH_ROWS).to_pylist()


def write_archives(records: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the chunk rows of `record_table`; one row per archive: path, records, n_bytes (of payloads)."""
    folder = folder or scratch(records.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        out, path, count, held, sha, pack = None, "", 0, 0, None, None
        for row in _small_batches(batches):
            if row["chunk"] == 0:
                if out is not None and held >= file_bytes:
                    out.close()
                    yield _listing(path, count, held)
                    out = None
                if out is None:
                    path, count, held = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(_open(path)[1], compression=None)
                sha, pack = hashlib.sha1(), zlib.compressobj(3, zlib.DEFLATED, 31)
                out.write(pack.compress(_head(row, date)))
            sha.update(row["data"])
            held += len(row["data"])
            out.write(pack.compress(row["data"]))
            if row["chunk"] == row["chunks"] - 1:
                if row["kind"] == "response" and sha.hexdigest() != row["digest"]:
                    raise ValueError(f"record {row['record']}: its chunks don't give its digest")
                out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                count += 1
        if out is not None:
            out.close()
            yield _listing(path, count, held)

    return staged(records.mapInArrow(write, "path string, records long, n_bytes long"), "warc-list")


def _listing(path: str, count: int, held: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": [count], "n_bytes": [held]})


READ = ("record string, address string, kind string, refers_to string, chunk int, last boolean, n_bytes long, "
        "digest string, data binary")


def _chunks(stream, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    """The records of an archive as chunk rows in the order of READ, chunk by chunk."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"not the start of a record: {line[:40]!r}")
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        left = int(fields["Content-Length"])
        while (line := stream.readline()) not in (b"\r\n", b""):
            left -= len(line)
        left -= len(line)
        sha, seen, number, kind = hashlib.sha1(), 0, 0, fields["WARC-Type"]
        base = (_record(fields["WARC-Record-ID"]), unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
                kind, _record(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None)
        while True:
            data = stream.read(min(left, chunk_bytes))
            if left and not data:
                raise ValueError(f"record {base[0]} ends early")
            left -= len(data)
            seen += len(data)
            sha.update(data)
            last = left == 0
            if last and kind == "response":
                digest = base64.b32encode(sha.digest()).decode()
                if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
                    raise ValueError(f"record {base[0]} has another digest than its payload")
                length = seen
            elif last:
                digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
            else:
                digest, length = None, None
            if last or with_data:
                yield (*base, number, last, length, digest, data if with_data else None)
            number += 1
            if last:
                break


def read_archives(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """Chunk rows of the listed archives. `n_bytes` and `digest` (base32) of the full payload are in a record's last row.

    Without data only the last row of each record is returned. The digest of every stored payload is checked.
    """
    kind = pa.schema([("record", pa.string()), ("address", pa.string()), ("kind", pa.string()), ("refers_to", pa.string()),
                      ("chunk", pa.int32()), ("last", pa.bool_()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("data", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                system, place = _open(path)
                with system.open_input_file(place) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows: list[tuple] = []
                    for row in _chunks(stream, chunk_bytes, with_data):
                        rows.append(row)
                        if len(rows) >= (BATCH_ROWS if with_data else 4096):
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    files = archives.count()
    return archives.select("path").repartition(max(1, files), "path").mapInArrow(read, READ)
