"""Packing documents into sequences: large-item matching, then best fit.

Documents above a third of the capacity share a sequence with at most one
other such document; a greedy matching gives each, from the longest down, the
longest partner that still fits.  Smaller documents go, from the longest
down, into the smallest remaining gap that holds them.

What goes where depends on lengths alone, and there are at most ``capacity``
of them.  The plan is therefore made from the corpus-wide counts per length:
a list of rules "the documents of length l with ranks r.. go into sequences
b.., from offset o".  Each document then finds its place by its rank among
those of its length, in parallel.  A gap that takes documents of length l
shrinks below half, so a rule list is at most about log2(capacity) times as
long as the number of gaps opened, itself a small multiple of ``capacity``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written
from .encoding import ID_TYPE, SLICE_BYTES, encoder

CAPACITY = 4096


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rules (length, first rank, documents per sequence, sequences, first
    sequence, offset), by length and first rank, for counts per length."""
    left = {n: c for n, c in counts.items() if c}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    rules: list[tuple[int, ...]] = []
    ranks: dict[int, int] = defaultdict(int)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    sequences = 0

    def place(length: int, per: int, n: int, first: int, offset: int, items: int) -> None:
        rules.append((length, ranks[length], per, n, first, offset))
        ranks[length] += items

    # Large documents, at most two in a sequence.
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        k = bisect_right(large, min(a, capacity - a)) - 1
        b = large[k] if k >= 0 else None
        if b == a and left[a] == 1:  # no partner of its own length; the next shorter one
            b = large[k - 1] if k >= 1 else None
        n = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
        place(a, 1, n, sequences, 0, n)
        left[a] -= n
        if b is not None:
            place(b, 1, n, sequences, a, n)
            left[b] -= n
        gaps[capacity - a - (b or 0)].append((sequences, n))
        sequences += n
        large = [x for x in large if left[x]]

    # Smaller documents, longest first, into the smallest gap that holds them.
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        n = left[length]
        for gap in range(length, capacity + 1):
            if not n:
                break
            per, ranges, gaps[gap] = gap // length, gaps[gap], []
            for first, size in ranges:
                full = min(size, n // per)
                if full:
                    place(length, per, full, first, capacity - gap, full * per)
                    gaps[gap - per * length].append((first, full))
                    n -= full * per
                rest = size - full
                if rest and 0 < n < per:
                    place(length, n, 1, first + full, capacity - gap, n)
                    gaps[gap - n * length].append((first + full, 1))
                    full, rest, n = full + 1, rest - 1, 0
                if rest:
                    gaps[gap].append((first + full, rest))
        if n:
            per = capacity // length
            full, last = divmod(n, per)
            for size, items in ((full, per), (1, last)):
                if size and items:
                    place(length, items, size, sequences, 0, size * items)
                    gaps[capacity - items * length].append((sequences, size))
                    sequences += size
    return np.array(sorted(rules), np.int64).reshape(-1, 6)


def _shares(texts: pa.Array, size: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """(first row, rows) of consecutive shares; the texts after a share's first hold less than ``size`` bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.append(np.flatnonzero(np.diff(upto // size)) + 1, len(upto)).tolist() if len(upto) else []
    return [(at, end - at) for at, end in zip([0, *cuts], cuts)]


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, kind: str, end_id: int,
            capacity: int) -> Iterator[pa.RecordBatch]:
    """Pieces of documents; ``rank`` counts those of one length in this task."""
    part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    end, code = np.array([end_id], ID_TYPE).tobytes(), encoder(tokenizer, kind)
    size = capacity * ID_TYPE.itemsize
    for batch in batches:
        for at, n in _shares(batch.column(1)):
            some = code.encode(batch.column(1).slice(at, n).to_pylist())
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).slice(at, n).to_pylist(), some):
                ids += end
                for piece, cut in enumerate(range(0, len(ids), size)):
                    own = ids[cut:cut + size]
                    length = len(own) // ID_TYPE.itemsize
                    rows.append((doc_id, piece, piece * capacity, length, own, part,
                                 int(seen[length])))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), _PIECE_TYPES)], _PIECE_NAMES)


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids", "part", "rank"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
_PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids binary, part int, "
                 "rank long")


def tokenised(docs: DataFrame, tokenizer: str, kind: str, end_id: int,
              capacity: int = CAPACITY) -> DataFrame:
    """Written table of pieces (doc_id, piece, start, length, ids, part, rank):
    a text's ids followed by ``end_id``, cut only beyond ``capacity``; part
    and rank number the pieces of one length."""
    ship(docs.sparkSession)
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
                   .mapInArrow(partial(_pieces, tokenizer=tokenizer, kind=kind, end_id=end_id,
                                       capacity=capacity), _PIECE_SCHEMA), "pack-pieces")


def _place(batches: Iterator[pa.RecordBatch], rules: np.ndarray) -> Iterator[pa.RecordBatch]:
    # A rule's place in one order over all lengths: ranks stay below 2^48.
    keys = (rules[:, 0] << 48) + rules[:, 1]
    for batch in batches:
        *kept, ranks = batch.columns
        lengths, ranks = batch.column("length").to_numpy(), ranks.to_numpy()
        own = rules[np.searchsorted(keys, (lengths << 48) + ranks, side="right") - 1]
        i = ranks - own[:, 1]
        sequence, offset = own[:, 4] + i // own[:, 2], own[:, 5] + i % own[:, 2] * lengths
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                         [*batch.schema.names[:-1], "sequence_id", "offset"])


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank, sequence_id,
    offset) for every row of ``tokenised``; the ids themselves stay there.

    Pieces of equal length are alike, whatever their documents; null and repeated
    doc_ids are kept, an empty table gives an empty result.
    """
    per_part = written(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    # At most ``capacity`` rows: one per length.
    counts = {r["length"]: r["n"] for r in
              per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    first = per_part.select("length", "part", (F.sum("n").over(upto) - F.col("n")).alias("first"))
    slim = pieces.select("doc_id", "piece", "start", "length",
                         F.crc32("ids").alias("ids_crc32"), "part", "rank")
    ranked = slim.join(first, ["length", "part"]).select(
        *slim.columns, (F.col("rank") + F.col("first")).alias("rank_of_length"))
    return ranked.mapInArrow(partial(_place, rules=plan(counts, capacity)),
                             "doc_id long, piece int, start long, length long, ids_crc32 long, "
                             "part int, rank long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, kind: str, end_id: int,
         capacity: int = CAPACITY) -> DataFrame:
    """The place of every piece of every document.

    Null and empty texts are the end id alone; repeated rows and ids are
    packed each; an empty table gives an empty result; other columns are not
    read.
    """
    return place(tokenised(docs, tokenizer, kind, end_id, capacity), capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences.  A group holds at
    most one sequence's capacity of ids; empty tables give an empty result."""
    own = ["length", "part", "rank"]
    rows = placed.select(*own, "sequence_id", "offset").join(pieces.select(*own, "ids"), own)
    return rows.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")) \
        .select("sequence_id", "length", F.expr(
            "aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
