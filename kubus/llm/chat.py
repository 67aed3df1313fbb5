"""Chat formatting of reply trees, in DataFrame functions.

Messages name their parent.  Iterative self-joins on the parent links, each
doubling the distance covered, enumerate the path from every leaf to its
root; branches are ranked by score, and each chosen path becomes one
formatted conversation with a loss mask over the assistant's texts.

A turn reads ``<s>[INST] role [/INST] text</s>``.  Control strings inside
roles and texts get a backslash after their first character, and backslashes
are doubled, so a reader recovers every text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

BEGIN, MIDDLE, END = "<s>[INST] ", " [/INST] ", "</s>"
ASSISTANT = "assistant"
_CONTROL = r"(<)(?=/?s>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, "$1$2\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def messages_from_turns(turns: DataFrame) -> DataFrame:
    """Message table (conv, conv_id, node, parent, role, text, score) of plain
    conversations: a turn answers the one before it.

    Null roles and texts are empty; turns that repeat a number are ordered by
    role and text; a null conv_id is a conversation of its own.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                        F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(order)).select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"), "conv_id", "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(conv, leaf, node, up): every node on the way from a leaf to its root,
    ``up`` steps above the leaf.  A message without its parent is a root.

    Takes one row per (conv, node), neither null, as ``formatted`` passes them;
    an empty table gives an empty result; other columns are not read.
    """
    nodes = written(messages.select("conv", "node", "parent"), "chat-nodes")
    links = nodes.alias("n").join(
        nodes.select(F.col("conv").alias("c"), F.col("node").alias("above")),
        F.expr("n.conv = c and n.parent = above"), "left_semi")
    jumps = written(links.select("conv", "node", F.col("parent").alias("above")), "chat-jumps")
    leaves = nodes.join(links.select("conv", F.col("parent").alias("node")),
                        ["conv", "node"], "left_anti")
    found = written(leaves.select("conv", F.col("node").alias("leaf"), "node",
                                  F.lit(0).alias("up")), "chat-paths")
    count, step = jumps.count(), 1
    most = count
    while count:
        if step > most:
            raise ValueError("parent links form a cycle")
        # found reaches less than ``step`` up, jumps exactly ``step``.
        further = found.join(jumps, ["conv", "node"]).select(
            "conv", "leaf", F.col("above").alias("node"), (F.col("up") + step).alias("up"))
        found = written(found.unionByName(further), "chat-paths")
        twice = jumps.alias("a").join(jumps.alias("b"), F.expr(
            "a.conv = b.conv and a.above = b.node")).selectExpr("a.conv", "a.node", "b.above")
        jumps = written(twice, "chat-jumps")
        count, step = jumps.count(), step * 2
    return found


def chosen(messages: DataFrame, found: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, leaf, branch): the ``branches`` paths of each conversation with
    the highest mean score; ties go to the least leaf.  Null scores do not count
    in a mean, paths without a score come last; empty tables give an empty result."""
    scores = found.join(messages.select("conv", "node", "score"), ["conv", "node"]) \
        .groupBy("conv", "leaf").agg(F.avg("score").alias("score"))
    rank = Window.partitionBy("conv").orderBy(F.desc("score"), "leaf")
    return scores.select("conv", "leaf", F.row_number().over(rank).alias("branch")) \
        .where(F.col("branch") <= branches)


def one_per_node(messages: DataFrame) -> DataFrame:
    """Messages with one row per conversation and node: of several the one
    whose parent, role, text, score and conv_id are least (nulls first)."""
    rest = F.struct("parent", "role", "text", "score", "conv_id")
    return messages.groupBy("conv", "node").agg(F.min(rest).alias("m")).select(
        "conv", "m.conv_id", "node", "m.parent", "m.role", "m.text", "m.score")


def formatted(messages: DataFrame, branches: int = 1, unique: bool = False) -> DataFrame:
    """(conv_id, branch, formatted, mask): one row per chosen path.

    ``mask`` has a (skip, take) pair per turn in code points: skip so many
    after the last one, then so many are trained on.  A path is one output
    string and has to fit into a row.

    A null ``conv`` is a conversation of its own; null roles and texts are
    empty; rows that repeat a node count once (see ``one_per_node``; a caller
    that knows nodes are ``unique`` saves that pass); messages without a node
    are left out, as nothing can follow or name them; ties between branches go
    to the least leaf; an empty table gives an empty result; other columns are
    not read.
    """
    messages = messages.where("node is not null").select(
        F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("conv"),
        "conv_id", "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), "score")
    messages = written(messages if unique else one_per_node(messages), "chat-messages")
    found = paths(messages)
    rows = found.join(chosen(messages, found, branches), ["conv", "leaf"]) \
        .join(messages, ["conv", "node"])
    turns = rows.groupBy("conv", "conv_id", "branch").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("up")).alias("at"), escape(F.col("role")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == ASSISTANT).alias("loss")))).alias("turns"))

    def pair(t: Column, i: Column) -> Column:
        head = F.length(t["head"]) + len(BEGIN) + len(MIDDLE) + F.when(i > 0, len(END)).otherwise(0)
        body = F.length(t["body"])
        return F.struct((head + F.when(t["loss"], 0).otherwise(body)).alias("skip"),
                        F.when(t["loss"], body).otherwise(0).alias("take"))

    return turns.select("conv_id", "branch", F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(BEGIN), t["head"], F.lit(MIDDLE), t["body"], F.lit(END))), "").alias("formatted"),
        F.transform("turns", pair).alias("mask"))


def parsed(output: DataFrame) -> DataFrame:
    """(conv_id, branch, formatted, turns, loss): turns (role, text) and the
    texts under the mask, both read from the formatted string.  Takes rows of
    ``formatted``: null ids are kept, equal rows give equal rows, an empty table
    gives an empty result; other columns are not read."""
    parts = output.withColumn("parts", F.split("formatted", END)) \
        .withColumn("parts", F.slice("parts", F.lit(1), F.size("parts") - 1))

    def turn(part: Column) -> Column:
        middle = F.instr(part, MIDDLE.strip())
        return F.struct(
            unescape(F.substring(part, F.lit(len(BEGIN) + 1),
                                 middle - F.lit(len(BEGIN) + 2))).alias("role"),
            unescape(F.substring(part, middle + F.lit(len(MIDDLE) - 1),
                                 F.length(part))).alias("text"))

    def under(x: Column, i: Column) -> Column:
        # Skips run from the end of the turn before; a part begins after its end mark.
        at = x["mask"]["skip"] - F.when(i > 0, len(END)).otherwise(0) + 1
        return F.when(x["mask"]["take"] > 0,
                      unescape(F.substring(x["parts"], at, x["mask"]["take"]))).otherwise("")

    return parts.select("conv_id", "branch", "formatted", F.transform("parts", turn).alias("turns"),
                        F.transform(F.arrays_zip("parts", "mask"), under).alias("loss"))


def digests(output: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of formatted conversations, read back from them."""
    loss = F.array_join("loss", "")
    return parsed(output).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def with_control_example(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -1, whose texts are control strings."""
    example = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                        F.col("turn").cast("long").alias("turn"), "role", "text") \
        .unionByName(example)
