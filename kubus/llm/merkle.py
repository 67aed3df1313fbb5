"""Merkle manifest of a data set, with one inclusion proof per document.

Leaves of a language are numbered by document id.  An aligned block of
``BLOCK`` leaves is built by appending them one by one: every open subtree
keeps the partial witnesses of the nodes below it, and whenever a sibling
subtree is completed both sides' witnesses grow by the other's root.  Block
roots, made by many tasks, are in turn appended as nodes of the next blocks,
until one node a language remains; the languages' subroots are appended the
same way.  A document's witness is its own part, then its block's, its
block's block's, and its language's.

A witness entry stands for one level: ``<hash`` (sibling to the left),
``>hash`` (to the right) or ``-`` (no sibling: the node is hashed alone).
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .common import ship, written
from ..operators.ordering import numbered

BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS
LEFT, RIGHT, ALONE = "<", ">", "-"


def field(column: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def node_hash(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Frontier:
    """The open subtrees of an append-only tree and the witnesses below them."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int]] = []  # height, root, first node below
        self.witnesses: list[list[str]] = []

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._add(0, node, len(self.witnesses) - 1)

    def _add(self, height: int, root: str, first: int) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, begin = self.open.pop()
            for witness in self.witnesses[begin:first]:
                witness.append(RIGHT + root)
            for witness in self.witnesses[first:]:
                witness.append(LEFT + left)
            height, root, first = height + 1, node_hash(left, root), begin
        self.open.append((height, root, first))

    def close(self, height: int | None = None) -> str:
        """No node follows: the last node of every level without a sibling is
        hashed alone, until one node remains or, if given, up to ``height``."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            at, root, first = self.open.pop()
            for witness in self.witnesses[first:]:
                witness.append(ALONE)
            self._add(at + 1, node_hash(root), first)
        return self.open[0][1]


def folded(node: Column, witness: Column) -> Column:
    """The root that a node and its witness lead to."""
    def step(below: Column, entry: Column) -> Column:
        side, other = F.substring(entry, 1, 1), F.substring(entry, 2, 64)
        return F.sha2(F.when(side == LEFT, F.concat(other, below))
                      .when(side == RIGHT, F.concat(below, other)).otherwise(below), 256)

    return F.aggregate(witness, node, step)


def siblings(witness: Column) -> Column:
    """The hashes in a witness, from the leaf up."""
    return F.array_join(F.transform(witness, lambda e: F.substring(e, 2, 64)), "")


def _block(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pos")
    frontier = Frontier()
    for node in rows.column("node").to_pylist():
        frontier.append(node)
    # A tree of one block ends where one node is left; other blocks are nodes
    # of the next level and all have its height.
    frontier.close(BLOCK_BITS if rows.column("total")[0].as_py() > BLOCK else None)
    return rows.append_column("witness", pa.array(frontier.witnesses, pa.list_(pa.string())))


def _appended(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` plus witness up to their tree's root, (tree, root)) of nodes
    (tree, pos, total, node, ...): rounds of blocks, each 1/1024 of the last."""
    levels, roots = [], []
    while True:
        block = F.shiftright("pos", BLOCK_BITS)
        schema = StructType([*nodes.schema.fields, StructField("witness", ArrayType(StringType()))])
        level = written(nodes.groupBy("tree", block.alias("block")).applyInArrow(_block, schema),
                        f"{name}-{len(levels)}")
        levels.append(level)
        nodes = written(level.where(F.col("pos") % BLOCK == 0).select(
            "tree", F.shiftright("pos", BLOCK_BITS).alias("pos"),
            F.ceil(F.col("total") / BLOCK).cast("long").alias("total"),
            folded(F.col("node"), F.col("witness")).alias("node")), f"{name}-roots")
        roots.append(nodes.where("total = 1").select("tree", F.col("node").alias("root")))
        nodes = nodes.where("total > 1")
        if nodes.isEmpty():
            break
    above = levels.pop()
    for level in reversed(levels):
        upper = above.select("tree", F.col("pos").alias("block"), F.col("witness").alias("_upper"))
        above = level.withColumn("block", F.shiftright("pos", BLOCK_BITS)) \
            .join(upper, ["tree", "block"], "left") \
            .withColumn("witness", F.concat("witness", F.coalesce("_upper", F.array().cast(
                "array<string>")))).drop("block", "_upper")
    return above, reduce(DataFrame.unionByName, roots)


def manifest(leaves: DataFrame) -> DataFrame:
    """Every row of ``leaves`` (doc_id, lang, leaf and any others) plus
    ``witness``, ``subroot`` and ``root``; a reader who has the root checks a
    document with ``folded(leaf, witness)``.

    A null language is a tree of its own, before the others; null ids come
    first in their tree; rows that repeat an id are leaves of their own,
    ordered by their hash; a lone leaf is its tree's subroot; an empty table
    gives an empty result.  Other columns may have any names but those added.
    """
    ship(leaves.sparkSession)
    # "=" keeps the bytewise order and null apart from the empty string.
    slim = written(leaves.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), F.col("leaf").alias("node"),
        F.col("doc_id").alias("by_id"), F.monotonically_increasing_id().alias("by_row"),
        F.struct(*leaves.columns).alias("row")), "merkle-leaves")
    nodes = numbered(slim, ["tree"], ["by_id", "node", "by_row"], "merkle-order") \
        .select("tree", "pos", "total", "node", "row")
    proofs, subroots = _appended(nodes, "merkle-blocks")
    trees = numbered(written(subroots, "merkle-subroots").select("tree", F.col("root").alias("node")),
                     [], ["tree"], "merkle-trees")
    tops, root = _appended(trees.select(F.lit("").alias("tree"), "pos", "total", "node",
                                        F.col("tree").alias("of")), "merkle-top")
    row = root.first()  # one row, or none of an empty table
    tops = written(tops.select(F.col("of").alias("tree"), F.col("node").alias("subroot"),
                               F.col("witness").alias("_top"),
                               F.lit(row and row["root"]).cast("string").alias("root")), "merkle-tops")
    return proofs.join(tops, "tree").select(
        "row.*", F.concat("witness", "_top").alias("witness"), "subroot", "root")
