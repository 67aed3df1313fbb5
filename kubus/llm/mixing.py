"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, up to ``passes`` times
over.  A copy's virtual time is the tokens its source has sent by then over
the source's weight.  All copies are range-sorted by virtual time and the
order is cut where the total budget is used up: each source has then sent in
proportion to its weight, or all it has, and what a short source leaves over
goes to the others.  A copy counts at its middle (half of its own tokens), so
that a source ends on the nearer side of the cut.

Everything is DataFrame work: running sums come from one range sort and
totals per partition, so a source may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from ..operators.ordering import numbered, with_running

WEIGHTS = (5, 2, 1)
PASSES = 3
_WORD = r"[^\x20\x09-\x0D]+"


def shuffle_key(doc_id: Column) -> Column:
    """A number that depends on the id alone, so reruns agree."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.substring(F.sha2(F.concat(F.lit("mix:"), text), 256), 1, 15)


def targets(sources: DataFrame, passes: int = PASSES) -> DataFrame:
    """``sources`` (rank, weight, source_size, ...) plus ``target``: shares of
    the sum of all sizes by weight, none above ``passes`` times its source.

    All sources get weight times one common level, or their limit.  In order
    of the level at which sources reach their limit, the first whose level is
    enough for the budget tells the common one.
    """
    room = sources.withColumn("room", F.col("source_size") * passes) \
        .withColumn("full_at", F.col("room") / F.col("weight"))
    running = written(with_running(room, [], ["full_at", "rank"], {
        "rooms": F.col("room"), "weights": F.col("weight")}, "mix-limits"), "mix-levels")
    total = running.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weight = total["size"] or 0, total["weight"] or 0
    # Tokens sent at a level: the full sources' rooms and the others' weights.
    sent = F.col("rooms") + F.col("full_at") * (F.lit(weight) - F.col("weights"))
    last = running.where(sent >= F.lit(size)).agg(F.min_by(F.struct(
        "_id", (F.col("rooms") - F.col("room")).alias("rooms"),
        (F.lit(weight) - F.col("weights") + F.col("weight")).alias("weights")), "_id").alias("at")).first()
    at = last["at"]
    if at is None:  # no source at all, or rounding at the very last level
        return running.withColumn("target", F.col("room").cast("double")).drop("_id")
    level = (size - at["rooms"]) / at["weights"]
    return running.withColumn("target", F.when(F.col("_id") < at["_id"], F.col("room").cast("double"))
                              .otherwise(F.least(F.col("weight") * F.lit(level), "room"))).drop("_id")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per row of
    ``docs``: ``copies`` (0 to ``passes``) whole copies, ``taken`` tokens.

    Sources in code-point order, null last, get ``weights`` in turn; a token is
    a word.  Null and empty texts have size 0 and are never taken; repeated
    rows are documents of their own, and rows that share an id and a size are
    alike in the result; an empty table gives an empty result; other columns
    are not read.  The mix never exceeds the sum of all sizes.
    """
    sized = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        shuffle_key(F.col("doc_id")).alias("shuffled"),
        F.monotonically_increasing_id().alias("row")), "mix-sizes")
    # Nulls sort first, so the flag puts the null source last.
    key = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")]
    sources = numbered(sized.groupBy(*key).agg(F.sum("size").alias("source_size")), [],
                       ["no_source", "name"], "mix-sources")
    turn = F.array(*[F.lit(w) for w in weights])
    plan = written(targets(sources.select(
        "no_source", "name", F.col("pos").alias("rank"), "source_size",
        F.get(turn, (F.col("pos") % len(weights)).cast("int")).cast("long").alias("weight")), passes)
        .select("no_source", "name", "rank", "weight", "source_size", "target"), "mix-targets")
    queues = written(with_running(
        sized.select("doc_id", "source", *key, "size", "shuffled", "row").join(plan, ["no_source", "name"])
        .drop("no_source", "name"), ["rank"], ["shuffled", "doc_id", "size", "row"],
        {"sent": F.col("size")}, "mix-queues"), "mix-sent")

    def time(turn: int | Column) -> Column:
        middle = 2 * (F.col("source_size") * turn + F.col("sent")) - F.col("size")
        return middle / (2.0 * F.col("weight"))

    budget = queues.agg(F.sum("size").alias("n")).first()["n"] or 0
    copies = queues.select("size", "weight", "source_size", "sent", F.col("_id").alias("queued"),
                           F.explode(F.array(*[F.lit(i) for i in range(passes)])).alias("turn")) \
        .select(time(F.col("turn")).alias("time"), "turn", "queued", "size")
    order = ["time", "turn", "queued"]
    cut = with_running(copies, [], order, {"total": F.col("size")}, "mix-copies") \
        .where(F.col("total") <= budget).agg(F.max(F.struct(*order)).alias("at")).first()["at"]
    if cut is None:  # an empty table: no copy at all
        count = F.lit(0)
    else:
        upto = F.struct(*[F.lit(cut[c]).alias(c) for c in order])
        count = sum((F.when(F.struct(time(i).alias("time"), F.lit(i).alias("turn"),
                                     F.col("_id").alias("queued")) <= upto, 1).otherwise(0)
                     for i in range(passes)), F.lit(0))
    return queues.withColumn("copies", count.cast("int")).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))
