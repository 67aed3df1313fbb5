"""Prefix trie of conversations that are rebuilt from others' heads.

A rebuilt conversation is the head of a base conversation followed by the
rest of its own turns.  Its prefixes are told apart by fingerprints from a
monoid: a run of turns is (B^length, hash), runs combine by
``(p, v) * (q, w) = (p * q, v * q + w)`` modulo 2^127 - 1.  Products over the
stored turns are scanned once, in the order of the turns, partition by
partition; the products of a conversation that spans partitions are combined
afterwards.  A rebuilt prefix then needs no text: with the own product up to
the cut and up to the turn, the base's up to its head is put in place of the
own one.

Fingerprints only propose.  Equal prefixes are verified from the stored turns:
a turn's hash must belong to one (role, text) of the table, and the members of
a prefix group must share their last turn's hash and their parent group.  If
any check fails, everything is done again with another base.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from ..operators.ordering import in_order, part

MODULUS = (1 << 127) - 1
ROOT = bytes(16)
CHUNK = 1 << 13  # conversation ids in one row of text
_WORD = r"[^\x20\x09-\x0D]+"


def _base(seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"trie {seed}".encode()).digest()[:16], "big") % MODULUS


def _bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    for batch in batches:
        yield [c.to_pylist() for c in batch.columns]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)],
                                      schema=schema)


_SCANNED = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("at", pa.int64()),
                      ("product", pa.binary()), ("item", pa.binary()), ("words", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[pa.RecordBatch]:
    """Running products of sorted turns, within the partition."""
    current, at, product = object(), 0, 0
    for columns in _columns(batches):
        rows = []
        for conv, segment, item, words in zip(*columns):
            if conv != current:
                current, at, product = conv, 0, 0
            at += 1
            product = (product * base + int.from_bytes(item, "big")) % MODULUS
            rows.append((conv, segment, at, _bytes(product), item, words))
        yield _batch(rows, _SCANNED)


_PREFIX = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()),
                     ("parent", pa.binary()), ("item", pa.binary()), ("words", pa.int64())])


def _spliced(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[pa.RecordBatch]:
    """Fingerprints of rebuilt prefixes that end in an own turn: ``rest`` turns
    after the cut, whose own product ``cut`` gives way to the base's ``head``."""
    inverse = pow(base, -1, MODULUS)
    for columns in _columns(batches):
        rows = []
        for conv, depth, rest, product, cut, head, item, words in zip(*columns):
            swap = int.from_bytes(head or ROOT, "big") - int.from_bytes(cut or ROOT, "big")
            node = (int.from_bytes(product, "big") + swap * pow(base, rest, MODULUS)) % MODULUS
            above = (node - int.from_bytes(item, "big")) * inverse % MODULUS
            rows.append((conv, depth, _bytes(node), _bytes(above), item, words))
        yield _batch(rows, _PREFIX)


_STORED = pa.schema([("conv", pa.int64()), ("at", pa.int64()), ("product", pa.binary()),
                     ("item", pa.binary()), ("words", pa.int64())])


def _continued(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[pa.RecordBatch]:
    """Products of a later segment: the ``n`` turns ``before`` it times its own."""
    for columns in _columns(batches):
        yield _batch([(conv, at + n, _bytes((int.from_bytes(before, "big") * pow(base, at, MODULUS)
                                             + int.from_bytes(product, "big")) % MODULUS), item, words)
                      for conv, at, product, item, words, n, before in zip(*columns)], _STORED)


def _stored(turns: DataFrame, base: int) -> DataFrame:
    """(conv, at, product, item, words) of every stored turn, ``product`` over
    the conversation's turns up to this one, ``at`` from 1."""
    ordered = in_order(turns, ["conv", "turn", "item", "row"], "trie-turns")
    scanned = written(ordered.select("conv", part().alias("part"), "item", "words").mapInArrow(
        partial(_scan, base=base), "conv long, part long, at long, product binary, item binary, "
                                   "words long"), "trie-scanned")
    segments = scanned.groupBy("conv", "part").agg(F.max("at").alias("n"),
                                                   F.max_by("product", "at").alias("product"))
    # A partition boundary cuts one conversation at most, so these are at most
    # two rows a partition.
    cut = segments.join(segments.groupBy("conv").agg(F.count("*").alias("parts"))
                        .where("parts > 1").select("conv"), "conv").collect()
    before, state = [], {}
    for row in sorted(cut, key=lambda r: (r["conv"], r["part"])):
        n, product = state.get(row["conv"], (0, 0))
        before.append((row["conv"], row["part"], n, _bytes(product)))
        state[row["conv"]] = (n + row["n"], (product * pow(base, row["n"], MODULUS)
                                             + int.from_bytes(row["product"], "big")) % MODULUS)
    offsets = turns.sparkSession.createDataFrame(
        before, "conv long, part long, n long, before binary")
    if not before:
        return scanned.drop("part")
    joined = scanned.join(offsets, ["conv", "part"], "left").select("conv", "at", "product", "item",
                                                                    "words", "n", "before")
    untouched = joined.where("n is null").drop("n", "before")
    return written(untouched.unionByName(joined.where("n is not null").mapInArrow(
        partial(_continued, base=base),
        "conv long, at long, product binary, item binary, words long")), "trie-stored")


def _prefixes(stored: DataFrame, splices: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, node, parent, item, words) of every prefix of every
    rebuilt conversation, its empty one included; (conv, length))."""
    most = splices.agg(F.max("head").alias("n")).first()["n"] or 0
    heads = written(stored.where(F.col("at") <= most), "trie-heads")
    convs = stored.groupBy("conv").agg(F.max("at").alias("n"))
    convs = written(convs.join(splices, "conv", "left").select(
        "conv", "n", "base", F.coalesce("head", F.lit(0)).cast("long").alias("head")), "trie-convs")
    known = convs.select(F.col("conv").alias("base"), F.col("n").alias("of_base"))
    plan = convs.join(known, "base", "left").select(
        "conv", "n", "base", F.least("n", "head").alias("cut"),
        F.least("head", F.coalesce("of_base", F.lit(0))).alias("head"))

    def product(conv: str, at: str, name: str) -> DataFrame:
        return heads.select(F.col("conv").alias(conv), F.col("at").alias(at),
                            F.col("product").alias(name))

    plan = written(plan.join(product("conv", "cut", "cut_product"), ["conv", "cut"], "left")
                   .join(product("base", "head", "head_product"), ["base", "head"], "left"), "trie-plan")
    fingerprint = partial(_spliced, base=base)
    schema = "conv long, depth long, node binary, parent binary, item binary, words long"
    own = stored.join(plan, "conv").where("at > cut").select(
        "conv", (F.col("head") + F.col("at") - F.col("cut")).alias("depth"),
        (F.col("at") - F.col("cut")).alias("rest"), "product", F.col("cut_product").alias("cut"),
        F.col("head_product").alias("head"), "item", "words").mapInArrow(fingerprint, schema)
    # Head prefixes are the base's own.
    taken = plan.select("conv", "base", "head").join(
        heads.withColumnRenamed("conv", "base"), "base").where("at <= head").select(
        "conv", F.col("at").alias("depth"), F.lit(0).cast("long").alias("rest"), "product",
        F.lit(None).cast("binary").alias("cut"), F.lit(None).cast("binary").alias("head"),
        "item", "words").mapInArrow(fingerprint, schema)
    none = F.lit(None).cast("binary")
    empty = plan.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"),
                        none.alias("parent"), none.alias("item"), F.lit(0).cast("long").alias("words"))
    lengths = plan.select("conv", (F.col("head") + F.col("n") - F.col("cut")).alias("length"))
    return written(own.unionByName(taken).unionByName(empty), "trie-prefixes"), lengths


def _one_to_one(turns: DataFrame) -> bool:
    """Does each hash of the stored turns belong to one role and text?"""
    contents = turns.groupBy("role", "text").agg(F.first("item").alias("item"))
    return contents.groupBy("item").count().where("count > 1").isEmpty()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, node, conv) to texts of up to ``CHUNK`` joined ids."""
    schema = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("first", pa.int64()),
                        ("ids", pa.string())])
    key, held = None, []

    def flush() -> list[tuple]:
        return [(*key, held[0], ",".join(map(str, held)))] if held else []

    for columns in _columns(batches):
        rows = []
        for depth, node, conv in zip(*columns):
            if (depth, node) != key or len(held) == CHUNK:
                rows += flush()
                key, held = (depth, node), []
            held.append(conv)
        yield _batch(rows, schema)
    yield _batch(flush(), schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest a node; only one digest state is held."""
    schema = pa.schema([("depth", pa.int64()), ("node", pa.binary()), ("ends_sha256", pa.string())])
    key, digest = None, None
    for columns in _columns(batches):
        rows = []
        for depth, node, _, ids in zip(*columns):
            if (depth, node) == key:
                digest.update(b",")
            else:
                rows += [(*key, digest.hexdigest())] if key else []
                key, digest = (depth, node), hashlib.sha256()
            digest.update(ids.encode())
        yield _batch(rows, schema)
    yield _batch([(*key, digest.hexdigest())] if key else [], schema)


def _ends(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256): the conversations that end at a node, whose
    ids are joined by many tasks and digested in order."""
    last = prefixes.select("conv", "depth", "node").join(
        lengths.withColumnRenamed("length", "depth"), ["conv", "depth"]).select("depth", "node", "conv")
    order = ["depth", "node", "conv"]
    chunks = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, node binary, first long, ids string")
    chunks = written(chunks, "trie-ends")
    return chunks.repartition("depth", "node").sortWithinPartitions("depth", "node", "first").mapInArrow(
        _digests, "depth long, node binary, ends_sha256 string")


def _subtrees(nodes: DataFrame, prefixes: DataFrame, sums: list[str], deepest: int) -> DataFrame:
    """(depth, node, sums): sums over subtrees.  Round k adds what nodes 2^k
    below have summed up so far; the smallest member's own prefix tells the
    node 2^k above, so no join meets a hot key."""
    paths = prefixes.select("conv", "depth", "node")
    found = written(nodes.select("conv", "depth", "node", *sums), "trie-sums")
    step = 1
    while step <= deepest:
        up = found.where(F.col("depth") >= step).select(
            "conv", (F.col("depth") - step).alias("depth"), *sums)
        given = up.join(paths, ["conv", "depth"]).select(
            F.lit(None).cast("long").alias("conv"), "depth", "node", *sums)
        found = written(found.select("conv", "depth", "node", *sums).unionByName(given)
                        .groupBy("depth", "node").agg(F.min("conv").alias("conv"),
                                                      *[F.sum(s).cast("long").alias(s) for s in sums]),
                        "trie-sums")
        step *= 2
    return found.select("depth", "node", *sums)


def prefix_trie(turns: DataFrame, splices: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role, text; ``splices`` (conv_id, base_id,
    head) gives a conversation the first ``head`` turns of its base in place of
    as many of its own; conversations not in it stay as they are, and a base
    that is not in ``turns`` has no turns.

    Null roles and texts are empty; turns of one number are ordered by the
    SHA-256 of byte count of the role, ``:``, role and text (null numbers
    first); repeated rows are turns of their own; turns without a conv_id
    belong to no conversation; an empty table has no conversation and gives an
    empty result; other columns are not read.
    """
    ship(turns.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"),
        content.alias("content"))
    splices = written(splices.select(F.col("conv_id").cast("long").alias("conv"),
                                     F.col("base_id").cast("long").alias("base"),
                                     F.col("head").cast("long").alias("head")), "trie-splices")
    for seed in range(8):
        # Another seed takes other digits of the hash too.
        item = F.unhex(F.substring("content", 1 + 4 * seed, 31))
        hashed = rows.withColumn("item", item)
        slim = written(hashed.select("conv", "turn", "item", F.regexp_count("text", F.lit(_WORD))
                                     .cast("long").alias("words"),
                                     F.monotonically_increasing_id().alias("row")), "trie-items")
        if not _one_to_one(hashed):
            continue
        prefixes, lengths = _prefixes(_stored(slim, _base(seed)), splices, _base(seed))
        groups = written(prefixes.groupBy("depth", "node").agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"),
            F.max("parent").alias("other_parent"), F.min("item").alias("item"),
            F.max("item").alias("other_item"), F.max("words").alias("words")), "trie-groups")
        if groups.where("parent <> other_parent or item <> other_item").isEmpty():
            break
    else:
        raise RuntimeError("no base tells the prefixes apart")
    children = written(groups.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children")), "trie-children")
    nodes = written(groups.join(children, ["depth", "node"], "left").select(
        "depth", "node", "conv", "n_convs", "parent",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).cast("long").alias("saved_tokens")), "trie-nodes")
    deepest = nodes.agg(F.max("depth").alias("n")).first()["n"] or 0
    sums = _subtrees(nodes, prefixes, ["n_leaves", "saved_tokens"], deepest)
    ends = _ends(prefixes, lengths)
    by_node = groups.select("depth", F.col("node").alias("above"), F.col("conv").alias("parent_conv_id")) \
        .withColumn("depth", F.col("depth") + 1)
    return (nodes.drop("n_leaves", "saved_tokens").withColumnRenamed("parent", "above")
            .join(by_node, ["depth", "above"], "left").join(sums, ["depth", "node"])
            .join(ends, ["depth", "node"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                    "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
