"""Small helpers shared by the operators: written tables in the shared
folder, worker imports, and word iteration over whole texts."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, written

__all__ = ["ROOT", "crc32_mod", "filesystem", "read_table", "shared_folder", "ship", "word_blocks",
           "written"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path.

    Only fills in a worker environment that names no path of its own; on a
    cluster the package is installed or shipped with ``--py-files``.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder every executor and the driver share."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, about ``size`` bytes at a time,
    so that a very long text never becomes one huge word list."""
    pos, n = 0, len(data)
    while pos < n:
        end = min(n, pos + size)
        if end < n:
            m = _SPACE.search(data, end)
            end = m.start() if m else n
        yield data[pos:end].split()
        pos = end


def crc32_mod(col: str, modulus: int):
    """crc32 of a column's text form, modulo ``modulus`` (null stays null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def filesystem(path: str):
    """(pyarrow file system, path in it) of a path in a shared folder, as
    Spark writes it (``file:/a/b``, ``s3a://...``, ``hdfs://...`` or plain)."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
