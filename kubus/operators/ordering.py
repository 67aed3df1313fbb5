"""Positions and running sums in a global order, in DataFrame functions.

Rows are range-partitioned and sorted once; a partition's totals, one row a
partition and group, are summed up in a window, so that no task sees more
than a partition's rows however large a group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def part() -> Column:
    """The range partition of a row of ``in_order``."""
    return F.shiftright("_id", _ROW_BITS)


def in_order(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` plus ``_id``, which ascends with ``order`` (nulls first).

    Equal keys cannot be split over partitions, so ``order`` should end with a
    column that tells repeated rows apart.
    """
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_id", F.monotonically_increasing_id()), name)


def part_sums(ordered: DataFrame, group: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """(group, part, first, <sum>, <sum>_before): the first ``_id`` of each
    group's part, the sums there and those of the group's parts before.

    The window holds one row a partition and group; without a group that is one
    row a partition in all.
    """
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(*group, part().alias("part")).agg(
        F.min("_id").alias("first"), *[F.sum(c).cast("long").alias(s) for s, c in sums.items()])
    return written(parts.select("*", *[F.coalesce(F.sum(s).over(before), F.lit(0)).cast("long")
                                       .alias(f"{s}_before") for s in sums]), name)


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` plus ``pos`` (from 0, in their group) and ``total`` (the group's rows)."""
    ordered = in_order(rows, [*group, *order], name)
    parts = part_sums(ordered, group, {"n": F.lit(1)}, f"{name}-parts")
    totals = parts.groupBy(*group).agg(F.sum("n").cast("long").alias("total"))
    if group:
        parts = parts.join(totals, group)
    else:
        parts = parts.withColumn("total", F.lit((totals.first() or [0])[0]).cast("long"))
    parts = written(parts, f"{name}-starts")
    return (ordered.withColumn("part", part()).join(parts, [*group, "part"])
            .withColumn("pos", F.col("_id") - F.col("first") + F.col("n_before"))
            .drop("part", "first", "n", "n_before", "_id"))


def with_running(rows: DataFrame, group: list[str], order: list[str], sums: dict[str, Column],
                 name: str) -> DataFrame:
    """``rows`` plus ``_id`` (see ``in_order``) and, per entry of ``sums``, the
    sum over the group's rows up to and with this one."""
    ordered = in_order(rows, [*group, *order], name)
    parts = part_sums(ordered, group, {f"_{s}": c for s, c in sums.items()}, f"{name}-parts") \
        .drop("first", *[f"_{s}" for s in sums])
    upto = Window.partitionBy(*group, "part").orderBy("_id") \
        .rowsBetween(Window.unboundedPreceding, 0)
    inside = ordered.withColumn("part", part()).select(
        "*", *[F.sum(c).over(upto).alias(f"_{s}") for s, c in sums.items()])
    return inside.join(parts, [*group, "part"]).select(
        *ordered.columns, *[(F.col(f"_{s}") + F.col(f"_{s}_before")).cast("long").alias(s)
                            for s in sums])
