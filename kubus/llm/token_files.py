"""Token ids in seekable binary files.

A file is a row of independent zstandard frames with content checksums, the
last of which holds the document index, followed by a seek table in a
skippable frame (the public seekable layout: per frame its compressed size,
size and checksum).  A reader opens the table from the file's end and
decompresses only the frames that hold the requested documents.

Documents are ordered by id over all files: a range shuffle, then every task
writes its range as one file.  A task writes to a name of its own attempt and
renames it when complete, so a repeated task replaces its file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, ship, shared_folder, written
from .encoding import ID_TYPE, encoder

# Fixed values of the seekable layout.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
HAS_CHECKSUM = 0x80
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
NULL_ID = -(1 << 63)


class FrameWriter:
    """Appends ids of documents to an open file, ``frame_bytes`` per frame."""

    def __init__(self, out, frame_bytes: int = 1 << 20, level: int = 3) -> None:
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True,
                                                   write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.held = bytearray()
        self.ids: list[int] = []
        self.lengths: list[int] = []

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(NULL_ID if doc_id is None else doc_id)
        self.lengths.append(len(ids) // ID_TYPE.itemsize)
        self.held += ids
        while len(self.held) >= self.frame_bytes:
            self._frame(bytes(self.held[:self.frame_bytes]))
            del self.held[:self.frame_bytes]

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        self._frame(np.array(self.ids, "<i8").tobytes() + np.array(self.lengths, "<u4").tobytes())
        table = b"".join(_ENTRY.pack(*e) for e in self.entries) + _FOOTER.pack(
            len(self.entries), HAS_CHECKSUM, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Reads documents of one file; ``frames_read`` counts what it opened."""

    def __init__(self, path: str) -> None:
        files, name = filesystem(path)
        self.file = files.open_input_file(name)
        size = self.file.size()
        count, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEK_MAGIC or flags != HAS_CHECKSUM:
            raise ValueError(f"{path} has no seek table")
        table = self._at(size - _FOOTER.size - count * _ENTRY.size, count * _ENTRY.size)
        self.entries = list(_ENTRY.iter_unpack(table))
        self.offsets = np.cumsum([0, *(e[0] for e in self.entries)]).tolist()
        self.frames_read = 0
        index = self._frame(count - 1)
        docs = len(index) // 12
        self.ids = np.frombuffer(index, "<i8", docs)
        self.lengths = np.frombuffer(index, "<u4", docs, 8 * docs).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.frame_ends = np.cumsum([e[1] for e in self.entries[:-1]], dtype=np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def _frame(self, k: int) -> bytes:
        packed, size, checksum = self.entries[k]
        data = zstandard.ZstdDecompressor().decompress(self._at(self.offsets[k], packed),
                                                       max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        self.frames_read += 1
        return data

    def documents(self, positions: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """(position, ids) of the documents at ascending ``positions``; every
        frame that is needed is decompressed once, one at a time."""
        k, frame = -1, b""
        for i in positions:
            at, end = (int(x) * ID_TYPE.itemsize for x in self.starts[i:i + 2])
            parts = []
            while at < end:
                need = int(np.searchsorted(self.frame_ends, at, side="right"))
                if need != k:
                    k, frame = need, self._frame(need)
                first = int(self.frame_ends[k]) - len(frame)
                part = frame[at - first:end - first]
                parts.append(part)
                at += len(part)
            yield i, b"".join(parts)

    def find(self, doc_ids: Iterable[int]) -> dict[int, bytes]:
        wanted = np.flatnonzero(np.isin(self.ids, list(doc_ids)))
        return {int(self.ids[i]): ids for i, ids in self.documents(wanted.tolist())}


CACHED_PIECES = 500_000  # this job's workers hold little else


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, kind: str,
                 end_id: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    shard = task.partitionId()
    files, base = filesystem(folder)
    temporary = f"{base}/shard-{shard:07d}-{task.taskAttemptId()}.open"
    end, code = np.array([end_id], ID_TYPE).tobytes(), encoder(tokenizer, kind, CACHED_PIECES)
    with files.open_output_stream(temporary) as out:
        writer = FrameWriter(out)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 1024):
                some = code.encode(texts.slice(at, 1024).to_pylist())
                for doc_id, ids in zip(batch.column(0).slice(at, 1024).to_pylist(), some):
                    writer.add(doc_id, ids + end)
        writer.close()
    name = f"shard-{shard:07d}.zst"
    files.move(temporary, f"{base}/{name}")
    yield pa.RecordBatch.from_pydict({"shard": [shard], "name": [name],
                                      "docs": [len(writer.ids)], "ids": [sum(writer.lengths)]})


def write_token_files(docs: DataFrame, tokenizer: str, kind: str, end_id: int,
                      folder: str | None = None) -> DataFrame:
    """Write the ids of all texts, ``end_id`` after each, in ascending doc_id
    order; returns the manifest (shard, name, docs, ids) of the files.

    Null texts are empty, so only the end id remains; null ids come first;
    rows that repeat an id follow each other in any order; an empty table
    gives no documents; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    # The text's hash keeps one much repeated id from landing in one task.
    ordered = rows.withColumn("_tie", F.xxhash64("text")) \
        .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return written(ordered.select("doc_id", "text").mapInArrow(
        partial(_write_shard, folder=folder, tokenizer=tokenizer, kind=kind, end_id=end_id),
        "shard long, name string, docs long, ids long"), "token-manifest")


def _read_shards(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = FrameReader(f"{folder}/{name}")
            crcs = np.fromiter((zlib.crc32(ids) for _, ids in
                                reader.documents(range(len(reader.ids)))),
                               np.int64, len(reader.ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(reader.ids, mask=reader.ids == NULL_ID),
                 pa.array(start + reader.starts[:-1]), pa.array(reader.lengths), pa.array(crcs)],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the
    files; start counts the ids of all documents before it."""
    # The manifest has one row per file: it is small whatever the files hold.
    shards, start = [], 0
    for row in manifest.where("docs > 0").orderBy("shard").collect():
        shards.append((row["name"], start))
        start += row["ids"]
    ship(spark)
    frame = spark.createDataFrame(shards, "name string, start long")
    return frame.repartition(max(1, len(shards))).mapInArrow(
        partial(_read_shards, folder=folder),
        "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """Write the files into a fresh shared folder and read them back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    manifest = write_token_files(docs, tokenizer, kind, end_id, folder)
    return read_token_files(spark, folder, manifest)
