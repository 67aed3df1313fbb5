"""WARC archives written and read as a chunked record table.

A record travels as rows (record, chunk number, bytes) with the digest and
length of the payload so far, so neither writer nor reader holds a record as
a whole: the writer streams chunks into one gzip member per record, the
reader streams them out again.  Records whose payload another record has
already are written as revisits without it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, ship, shared_folder, written

CHUNK_BYTES = 1 << 16
LEAST_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BREAKS = re.compile(r"[\x00-\x20\x7f]")
_END = b"\r\n\r\n"


def with_types(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, length, refers_to): refers_to is the
    least page_id with the same payload, null for that page itself."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")) \
        .select("*", F.sha2("payload", 256).alias("digest"),
                F.octet_length("payload").cast("long").alias("length"))
    first = written(rows.where(F.col("length") >= least).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                    .where("n > 1 and first is not null").drop("n"), "warc-first")
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", "length",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _header(page_id, url, digest, length, refers_to) -> bytes:
    revisit = refers_to is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", len(_HTTP) + (0 if revisit else length)),
              ("X-Payload-Length", length)]
    if url:
        fields.append(("WARC-Target-URI", _BREAKS.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if revisit:
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE),
                   ("X-Refers-To-Page-ID", refers_to)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + _HTTP


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows of every record, in order; a header goes with chunk 0."""
    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, digest, length, refers_to = (
                batch.column(c)[i].as_py() for c in (0, 1, 3, 4, 5))
            payload = memoryview(batch.column(2)[i].as_buffer()) if refers_to is None else b""
            running, record = hashlib.sha256(), _record_id(page_id)
            for k, at in enumerate(range(0, max(1, len(payload)), CHUNK_BYTES)):
                data = bytes(payload[at:at + CHUNK_BYTES])
                running.update(data)
                head = _header(page_id, url, digest, length, refers_to) if k == 0 else None
                yield pa.RecordBatch.from_pydict(
                    {"record": [record], "chunk": [k], "last": [at + CHUNK_BYTES >= len(payload)],
                     "head": [head], "data": [data], "digest": [running.hexdigest()],
                     "expected": [digest if refers_to is None else None]}, _CHUNK_TYPES)


_CHUNK_TYPES = pa.schema([("record", pa.string()), ("chunk", pa.int64()), ("last", pa.bool_()),
                          ("head", pa.binary()), ("data", pa.binary()), ("digest", pa.string()),
                          ("expected", pa.string())])
_CHUNK_SCHEMA = ("record string, chunk long, last boolean, head binary, data binary, "
                 "digest string, expected string")


def _gathered(batches: Iterator[pa.RecordBatch], size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some megabytes."""
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def chunk_table(typed: DataFrame) -> DataFrame:
    """Chunk rows of ``with_types`` rows; a record's rows follow each other."""
    return typed.mapInArrow(lambda batches: _gathered(_chunks(batches)), _CHUNK_SCHEMA)


def _write(batches: Iterator[pa.RecordBatch], folder: str, level: int) -> Iterator[pa.RecordBatch]:
    task, records = TaskContext.get(), 0
    files, base = filesystem(folder)
    name = f"part-{task.partitionId():07d}.warc.gz"
    temporary = f"{base}/{name}.{task.taskAttemptId()}.open"
    with files.open_output_stream(temporary) as out:
        gzip = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    gzip = zlib.compressobj(level, zlib.DEFLATED, 31)
                    out.write(gzip.compress(row["head"]))
                out.write(gzip.compress(row["data"]))
                if row["last"]:
                    if row["expected"] not in (None, row["digest"]):
                        raise ValueError(f"{row['record']} lost bytes on its way")
                    out.write(gzip.compress(_END) + gzip.flush())
                    records += 1
    files.move(temporary, f"{base}/{name}")
    yield pa.RecordBatch.from_pydict({"name": [name], "records": [records]})


def write_archives(pages: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Write one archive per task; returns their manifest (name, records)."""
    ship(pages.sparkSession)
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    return written(chunk_table(with_types(pages)).mapInArrow(
        partial(_write, folder=folder, level=level), "name string, records long"), "warc-manifest")


def _members(file, size: int = 1 << 18) -> Iterator[Iterator[bytes]]:
    """Per gzip member the parts of its content."""
    rest = file.read(size)
    while rest:
        gzip = zlib.decompressobj(31)

        def parts(data=rest, gzip=gzip):
            nonlocal rest
            while True:
                # Decompressed sizes are bounded too, whatever the ratio.
                part = gzip.decompress(data, CHUNK_BYTES)
                if part:
                    yield part
                data = gzip.unconsumed_tail
                if gzip.eof:
                    rest = gzip.unused_data or file.read(size)
                    return
                if not data and not (data := file.read(size)):
                    raise ValueError("an archive ends inside a record")

        yield parts()


def records(file, payload: bool = True) -> Iterator[dict]:
    """Chunk rows of an open archive: page_id, record_type, refers_to, chunk,
    last, data, payload_bytes and payload_digest so far."""
    for parts in _members(file):
        held = b""
        while (at := held.find(_END)) < 0:
            held += next(parts)
        lines = held[:at].decode().split("\r\n")[1:]
        fields = dict(line.split(": ", 1) for line in lines)
        held = held[at + len(_END):]
        number = lambda k: int(fields[k]) if k in fields else None
        row = {"page_id": number("X-Page-ID"), "record_type": fields["WARC-Type"],
               "refers_to": number("X-Refers-To-Page-ID")}
        while len(held) < len(_HTTP):
            held += next(parts)
        held, left = held[len(_HTTP):], number("Content-Length") - len(_HTTP)
        running, total, k = hashlib.sha256(), 0, 0
        while True:
            data = held[:left]
            running.update(data)
            total, left = total + len(data), left - len(data)
            last = left == 0
            if last:
                end = held[len(data):] + b"".join(parts)  # what follows is the record's end mark
                if end != _END:
                    raise ValueError("a record does not end where it should")
            whole = row["record_type"] == "response"
            digest = running.hexdigest() if whole else fields["WARC-Payload-Digest"][7:]
            if whole and last and digest != fields["WARC-Payload-Digest"][7:]:
                raise ValueError("a payload does not match its digest")
            yield row | {"chunk": k, "last": last, "data": data if payload else None,
                         "payload_bytes": total if whole else number("X-Payload-Length"),
                         "payload_digest": digest}
            if last:
                break
            k += 1
            held = next(parts)


_READ_TYPES = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()),
                         ("refers_to", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()),
                         ("data", pa.binary()), ("payload_bytes", pa.int64()),
                         ("payload_digest", pa.string())])


def _read(batches: Iterator[pa.RecordBatch], folder: str, payload: bool) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = filesystem(f"{folder}/{name}")
                with files.open_input_file(path) as file:
                    held: list[dict] = []
                    for row in records(file, payload):
                        held.append(row)
                        if len(held) >= 64:
                            yield pa.RecordBatch.from_pylist(held, _READ_TYPES)
                            held = []
                    yield pa.RecordBatch.from_pylist(held, _READ_TYPES)

    return _gathered(rows())


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame,
                  payload: bool = True) -> DataFrame:
    """Chunk rows of all archives; without ``payload`` the bytes are read and
    checked but not returned."""
    ship(spark)
    # The manifest has one row per archive.
    names = [(r["name"],) for r in manifest.where("records > 0").collect()]
    return spark.createDataFrame(names, "name string").repartition(max(1, len(names))).mapInArrow(
        partial(_read, folder=folder, payload=payload),
        "page_id long, record_type string, refers_to long, chunk long, last boolean, "
        "data binary, payload_bytes long, payload_digest string")


def archived(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of
    every page, read back from archives written into a fresh shared folder.

    A null html is an empty payload.  Of rows with equal payloads of at least
    100 bytes the least page_id is the response; rows that repeat that
    page_id too are responses as well; a null page_id is a revisit if another
    row with its payload has an id, else a response.  An empty table gives an
    empty result; other columns than page_id, url and html are not read.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    found = read_archives(spark, folder, write_archives(pages, folder), payload=False)
    return found.where("last").select("page_id", "payload_bytes", "payload_digest",
                                      "record_type", "refers_to")
