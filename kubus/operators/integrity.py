"""Key integrity checks that replace PK/FK constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def _flagged(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``fact`` plus one column ``_<name>`` per dimension, null for an orphan.

    The distinct keys of a dimension are a written table, so that the join is a
    broadcast by its size or a join of two plain shuffles, in which AQE splits
    a hot key.
    """
    rows = fact
    for name, (dim, key) in dims.items():
        keys = written(dim.select(F.col(key).alias(f"_{name}")).distinct(), f"keys-{name}")
        rows = rows.join(keys, rows[key] == keys[f"_{name}"], "left")
    return rows


def orphan_counts(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dimension, orphan_rows): fact rows whose key has no dimension row.

    ``dims`` maps a name to ``(dimension, key column)``.  One pass over the
    fact's keys.  A null key has no dimension row either.
    """
    rows = _flagged(fact.select(*{key: None for _, key in dims.values()}), dims)
    counts = rows.agg(*[F.count_if(F.col(f"_{name}").isNull()).alias(name) for name in dims])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("dimension"), F.col(name).cast("long").alias("orphan_rows"))
        for name in dims])))


def _missing(names) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(f"_{n}").isNull(), F.lit(n)) for n in names]))


def orphan_rows(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The fact rows that lack a dimension row, with all their columns and
    ``missing``: the names of the dimensions, comma-joined in the order given."""
    missing = _flagged(fact, dims).withColumn("missing", _missing(dims)).where(F.size("missing") > 0)
    return missing.select(*fact.columns, F.array_join("missing", ",").alias("missing"))


def duplicate_keys(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dimension, duplicate_keys): keys that occur more than once."""
    parts = []
    for name, (dim, key) in dims.items():
        dup = dim.groupBy(key).count().where(F.col("count") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).cast("long").alias("duplicate_keys"))
                     .select(F.lit(name).alias("dimension"), "duplicate_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_rows(dim: DataFrame, key: str) -> DataFrame:
    """All rows of ``dim`` that share their key with another, plus ``copies``
    (rows of that key); null is a key like others."""
    counts = dim.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    keys = written(counts, "keys-repeated")
    return dim.join(keys, dim[key].eqNullSafe(keys["_key"])).drop("_key")
