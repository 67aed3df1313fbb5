"""SimHash near-duplicates by tiled exact comparison.

1. Every text gets a 64-bit fingerprint; equal fingerprints become one class,
   so copies cost nothing further.
2. Classes are cut into tiles by the population counts of four 16-bit
   segments.  Fingerprints within ``radius`` bits have segment counts whose
   differences add up to at most ``radius``; all other tile pairs are
   skipped without looking at their rows.  A tile that outgrows
   ``tile_rows`` is split by hash and all its part pairs are compared.
3. The remaining tile pairs are compared exactly with numpy exclusive-or and
   bit counts.  A tile pair returns a spanning forest of its links, never all
   pairs of a dense group.
4. Connected components over the links, in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, word_blocks, written
from .components import connected_components

SEED = 42
SEGMENTS = 4
SEGMENT_BITS = 16


def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text (UTF-8): a bit is 1 if it is set in over half
    of the XXH64 hashes of all word shingles.  A shorter text is one shingle;
    a text without words has fingerprint zero."""
    if not data:
        return 0
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(data.lower()):
        words = tail + words
        tail = words[-(shingle - 1):] if shingle > 1 else []
        hashes = np.fromiter(map(digest, map(b" ".join, zip(*(words[i:] for i in range(shingle))))),
                             dtype="<u8")
        total += len(hashes)
        for i in range(0, len(hashes), 1 << 15):
            bits = np.unpackbits(hashes[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8),
                                 axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    if not total:
        if not tail:
            return 0
        return digest(b" ".join(tail))
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): one row per input row; fp as a signed 64-bit
    integer, text_hash tells rows with one id but different texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps)],
                                             ["doc_id", "text_hash", "fp"])

    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, text_hash long, fp long")


def _tile_key(fp):
    """Population counts of the four segments, five bits each."""
    key = F.lit(0)
    for i in range(SEGMENTS):
        count = F.bit_count(F.shiftrightunsigned(fp, SEGMENT_BITS * i)
                            .bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)))
        key = key + count * F.lit(1 << (5 * i))
    return key.cast("int")


def _key_steps(radius: int) -> list[int]:
    """Key differences of tile pairs that can hold a link, each pair of keys
    once.  A count below 0 or above 16 lands on a key that no tile has."""
    vectors = [v for v in product(range(-radius, radius + 1), repeat=SEGMENTS)
               if sum(map(abs, v)) <= radius]
    steps = {sum(d * (1 << (5 * i)) for i, d in enumerate(v)) for v in vectors}
    return sorted(s for s in steps if s >= 0)


def link_forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Index pairs (i in a, j in b) that connect whatever the links between
    ``a`` and ``b`` connect, at most ``len(a) + len(b) - 1`` of them."""
    n = len(a)
    parent = list(range(n if same else n + len(b)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shift, edges = 0 if same else n, []
    owner = np.full(len(b), -1, np.int64)
    step = max(1, (1 << 20) // max(1, len(b)))
    for lo in range(0, n, step):
        near = np.bitwise_count(a[lo:lo + step, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(len(b))[None, :] > np.arange(lo, lo + len(near))[:, None]
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            i, js = lo + row, np.flatnonzero(near[row])
            owners, new = owner[js], js[owner[js] < 0]
            # Of the columns another row has linked already, one per such row is enough.
            _, first = np.unique(owners[owners >= 0], return_index=True)
            for j in new.tolist() + js[owners >= 0][first].tolist():
                x, y = find(i), find(shift + j)
                if x != y:
                    parent[x] = y
                    edges.append((i, j))
            owner[new] = i
    return edges


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right, same = (batch.column(i) for i in range(3))
        us, vs = [], []
        for i in range(batch.num_rows):
            a = left[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            b = right[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            for x, y in link_forest(a, b, same[i].as_py(), radius):
                us.append(a[x])
                vs.append(b[y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (us, vs)], ["u", "v"])


def links(classes: DataFrame, radius: int = 2, tile_rows: int = 2048) -> DataFrame:
    """(u, v): links that connect all distinct fingerprints ``fp`` of
    ``classes`` that differ in at most ``radius`` bits."""
    keyed = classes.select("fp", _tile_key(F.col("fp")).alias("key"))
    # At most 17^4 rows, whatever the input: every key is four counts of 0..16.
    parts = keyed.groupBy("key").agg(F.ceil(F.count("*") / F.lit(tile_rows)).alias("n"))
    tiles = (keyed.join(F.broadcast(parts), "key")
             .groupBy("key", F.pmod(F.xxhash64("fp"), "n").alias("part"))
             .agg(F.collect_list("fp").alias("fps")))
    tiles = written(tiles, "simhash-tiles")
    steps = F.array(*[F.lit(s) for s in _key_steps(radius)])
    left = tiles.select(F.col("key").alias("key_a"), F.col("part").alias("part_a"),
                        F.col("fps").alias("fps_a"), F.explode(steps).alias("step")) \
        .withColumn("key", F.col("key_a") + F.col("step"))
    pairs = left.join(tiles, "key").where("step > 0 or part_a <= part").select(
        "fps_a", "fps", (F.expr("step = 0 and part_a = part")).alias("same"))
    return pairs.mapInArrow(partial(_links, radius=radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2, tile_rows: int = 2048) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs``.

    component_id is the least id reachable over fingerprints that differ in
    at most ``radius`` bits, root the component's least fingerprint.  Null and empty texts have fingerprint zero and
    link like any other; a null id never becomes a component_id unless the
    component has no other; repeated rows each give a row; an empty table
    gives an empty result; other columns are not read.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    edges = written(links(classes, radius, tile_rows), "simhash-links")
    roots = connected_components(edges)
    linked = written(roots.join(classes, F.col("node") == F.col("fp")), "simhash-linked")
    lowest = linked.groupBy("root").agg(F.min("low").alias("component"))
    of_link = linked.select("fp", "root").join(lowest, "root")
    of_class = classes.join(of_link, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.coalesce("component", "low").alias("component_id"))
    return prints.join(written(of_class, "simhash-components"), "fp") \
        .select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Documents without near-duplicates: one row of each component stays,
    with all its columns: the least doc_id, then the least text hash; a
    component with only null ids keeps one row too.  Rows equal in doc_id and
    text count as one."""
    found = near_duplicates(docs, shingle=shingle, radius=radius)
    first = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
             .groupBy("root").agg(F.min(F.struct("doc_id", "text_hash", "n")).alias("first"))
             .select(F.col("first.doc_id").alias("_kept_id"),
                     F.col("first.text_hash").alias("_kept_hash"), F.col("first.n").alias("_n")))
    kept = written(first, "simhash-kept")
    own = [docs[c] for c in docs.columns]
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"])
                     & (F.xxhash64(docs["text"]) == kept["_kept_hash"]))
    return rows.where(kept["_n"] == 1).select(*own).unionByName(
        rows.where(kept["_n"] > 1).select(*own).dropDuplicates(["doc_id", "text"]))
