"""CUBE and GROUPING SETS analysis over a star source.

Both return one relation that stacks every aggregation level, told apart
by three GROUPING flags and a text label, with the columns

    geo_dimension, time_dimension, product_dimension,
    geo_grouping, time_grouping, product_grouping,
    total_quantity, total_revenue, transaction_count, avg_unit_price,
    aggregation_level | aggregation_type

Plan shape.  By default the star is first reduced to its *base cuboid*
(one row per (geo, time, product) member triple, with mergeable partial
state: sums, row count, sum and count of unit prices), and only that is
expanded into the requested levels.  The expand step then multiplies the
base cuboid instead of every fact row by 8 (cube) or 5 (grouping sets).
The first aggregate is a regular partial/final hash aggregate, so a hot
member (a third of all rows in one group) is combined map-side before the
shuffle and never lands in one task as raw rows.

``strategy="by_product"`` deals the base cuboid by product member: all levels
that keep the product are then summed where they lie, and the others come from
the geo x time cuboid, so no copy of the base is shuffled.  It is the default
for articles, whose members are as many as the dimension's rows, so that the
base cuboid is about as large as the fact.  A hot article brings at most one
row a shop and time member.

``strategy="lattice"`` replaces the Expand by one aggregate per level, each
fed by its smallest already-computed parent.  A star that already carries
mergeable state (a cuboid cached by ``navigate.Navigator``) is merged
instead of re-aggregated.

``avg_unit_price`` is the *unweighted* mean of per-row revenue/quantity
(zero quantity -> NULL -> not averaged), recombined as
sum(ratio) / count(ratio) in exact integer units (functions/parsing.py);
it is returned as a double rounded half away from zero to 6 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import (CUBE_LEVEL_FALLBACK, CUBE_LEVEL_LABELS,
                                GROUPING_SET_FALLBACK, GROUPING_SET_LABELS,
                                level_label, member_label)
from ..functions.parsing import mean_price, unit_price_e8
from ..model import PRODUCT, resolve_levels

FLAGS = ("geo_grouping", "time_grouping", "product_grouping")
DIMENSIONS = ("geo_dimension", "time_dimension", "product_dimension")
DEFAULT_STRATEGY = None  # "by_product" for articles, else "expand"

# Grouping sets of the cross-table query, as positions into (geo, time, product).
CROSSTAB_SETS = ((0, 1, 2), (0, 1), (0, 2), (0,), ())
CUBE_SETS = ((0, 1, 2), (0, 1), (0, 2), (1, 2), (0,), (1,), (2,), ())


def _with_ratio(star: DataFrame) -> DataFrame:
    return star.withColumn("_ratio", unit_price_e8("revenue", "quantity_sold"))


def _partial_state(prefix: str = "") -> list[Column]:
    """Mergeable measures over raw star rows (SQL text: one JVM call each)."""
    return [F.expr(e) for e in (
        f"sum(quantity_sold) AS {prefix}qty",
        f"sum(revenue) AS {prefix}rev",
        f"count(1) AS {prefix}rows",
        f"sum(CAST(_ratio AS DECIMAL(38,0))) AS {prefix}ratio_sum",
        f"count(_ratio) AS {prefix}ratio_n")]


def has_state(star: DataFrame) -> bool:
    """True for a pre-aggregated star (a cached cuboid with mergeable state)."""
    return "_rows" in star.columns


def state_cuboid(star: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Group raw star rows, or merge a pre-aggregated star, by ``cols``."""
    if has_state(star):
        return star.groupBy(*cols).agg(*[F.sum(c).alias(c) for c in _STATE])
    return _with_ratio(star).groupBy(*cols).agg(*_partial_state("_"))


def base_cuboid(star: DataFrame, cols: tuple[str, str, str]) -> DataFrame:
    """Finest requested level with mergeable state; one shuffle on the keys."""
    return state_cuboid(star, cols)


def _merge_measures() -> list[Column]:
    return [F.expr(e) for e in (
        "sum(_qty) AS qty", "sum(_rev) AS rev", "sum(_rows) AS rows",
        "CAST(sum(_ratio_sum) AS DECIMAL(38,0)) AS ratio_sum", "sum(_ratio_n) AS ratio_n")]


def _final_measures() -> list[Column]:
    return [F.expr(e) for e in (
        "CAST(qty AS BIGINT) AS total_quantity",
        "CAST(rev AS DECIMAL(38,2)) AS total_revenue",
        "CAST(rows AS BIGINT) AS transaction_count")] + [
        mean_price("ratio_sum", "ratio_n").alias("avg_unit_price")]


def _aggregate(star: DataFrame, cols: tuple[str, str, str], sets: tuple[tuple[int, ...], ...],
               via_base_cuboid: bool, strategy: str | None = DEFAULT_STRATEGY) -> DataFrame:
    g, t, p = cols
    if len(sets) == 1:
        return _aggregate_one_set(star, cols, sets[0])
    via_base_cuboid = via_base_cuboid or has_state(star)
    if via_base_cuboid and strategy == "lattice":
        return _lattice(base_cuboid(star, cols), cols, sets)
    if strategy is None:
        strategy = "by_product" if p == PRODUCT.levels[-1][1] else "expand"
    if via_base_cuboid and strategy == "by_product":
        return _by_product(base_cuboid(star, cols), cols, sets)
    if via_base_cuboid:
        source, measures = base_cuboid(star, cols), _merge_measures()
    else:
        source, measures = _with_ratio(star), _partial_state()
    flags = [F.expr(f"CAST(grouping(`{c}`) AS INT) AS {name}") for c, name in zip(cols, FLAGS)]
    if sets == CUBE_SETS:
        grouped = source.cube(g, t, p)
    else:
        grouped = source.groupingSets([[cols[i] for i in s] for s in sets], g, t, p)
    return grouped.agg(*flags, *measures)


_STATE = ("_qty", "_rev", "_rows", "_ratio_sum", "_ratio_n")
_STATE_TYPES = ("bigint", "decimal(38,2)", "bigint", "decimal(38,0)", "bigint")


def _lattice(base: DataFrame, cols: tuple[str, str, str],
             sets: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Each grouping set aggregated from its smallest already-computed parent.

    (g,t) (g,p) (t,p) come from the base cuboid, (g) from (g,t), () from (g)
    and so on: every row of the base is read about three times instead of
    being copied eight times by ``Expand``.  Shared parents are computed
    once (their shuffles are reused across the union's branches).
    """
    computed: dict[tuple[int, ...], DataFrame] = {(0, 1, 2): base}
    parts = []
    for gset in sorted(sets, key=len, reverse=True):
        if gset not in computed:
            parent = min((k for k in computed if set(gset) <= set(k)), key=len)
            computed[gset] = computed[parent].groupBy(*[cols[i] for i in gset]).agg(
                *[F.sum(c).alias(c) for c in _STATE])
        level = computed[gset]
        parts.append(level.select(
            *[F.col(c) if i in gset else F.lit(None).cast(base.schema[c].dataType).alias(c)
              for i, c in enumerate(cols)],
            *[F.lit(0 if i in gset else 1).alias(f) for i, f in enumerate(FLAGS)],
            *[F.col(c).cast(ty).alias(c.lstrip("_")) for c, ty in zip(_STATE, _STATE_TYPES)]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _by_product(base: DataFrame, cols: tuple[str, str, str],
                sets: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Grouping sets with the product summed in the tasks that hold the product's
    rows, the others from the (geo, time) cuboid."""
    g, t, p = cols
    members = [F.col(c).alias(f"_{d}") for c, d in ((g, "geo"), (t, "time"))]
    sums = [F.sum(c).cast(ty).alias(c.lstrip("_")) for c, ty in zip(_STATE, _STATE_TYPES)]

    def cells(rows: DataFrame, wanted: list[tuple[int, ...]]) -> DataFrame:
        """Every row once for each of the wanted sets, with its flags."""
        return rows.select(*[c for c in rows.columns if c not in ("_geo", "_time")], F.inline(F.array(*[F.struct(
            *[(F.col(m) if i in s else F.lit(None).cast(rows.schema[m].dataType)).alias(c)
              for i, (m, c) in enumerate((("_geo", g), ("_time", t)))],
            *[F.lit(0 if i in s else 1).alias(f) for i, f in enumerate(FLAGS[:2])]) for s in wanted])))

    with_product = [s for s in sets if 2 in s]
    dealt = base.repartition(p).select(*members, p, *_STATE)
    out = cells(dealt, with_product).groupBy(p, g, t, *FLAGS[:2]).agg(*sums) \
        .withColumn(FLAGS[2], F.lit(0))
    rest = [s for s in sets if 2 not in s]
    if not rest:
        return out
    pairs = base.groupBy(*members).agg(*[F.sum(c).alias(c) for c in _STATE])
    small = cells(pairs, rest).groupBy(g, t, *FLAGS[:2]).agg(*sums) \
        .withColumn(FLAGS[2], F.lit(1)).withColumn(p, F.lit(None).cast(base.schema[p].dataType))
    return out.unionByName(small)


def _aggregate_one_set(star: DataFrame, cols: tuple[str, str, str],
                       gset: tuple[int, ...]) -> DataFrame:
    """One grouping set: a plain GROUP BY (no Expand); absent keys are NULL
    and their flags are literal 1."""
    keys = [cols[i] for i in gset]
    if has_state(star):
        out = state_cuboid(star, keys).select(
            *keys, *[F.col(c).alias(c.lstrip("_")) for c in _STATE])
    else:
        out = _with_ratio(star).groupBy(*keys).agg(*_partial_state())
    if not keys:
        # A global aggregate yields one row even on empty input; the CUBE
        # grand total does not.
        out = out.where(F.col("rows") > 0)
    for i, (c, flag) in enumerate(zip(cols, FLAGS)):
        if i not in gset:
            out = out.withColumn(c, F.lit(None).cast(star.schema[c].dataType))
        out = out.withColumn(flag, F.lit(0 if i in gset else 1))
    return out


def _finish(agg: DataFrame, cols: tuple[str, str, str], label_name: str, labels: dict,
            fallback: str, ordered: bool) -> DataFrame:
    out = agg.select(
        *[member_label(c, f).alias(d) for c, f, d in zip(cols, FLAGS, DIMENSIONS)],
        *FLAGS, *_final_measures(),
        level_label(*FLAGS, labels, fallback).alias(label_name))
    return order_levels(out) if ordered else out


def order_levels(df: DataFrame, numeric_time_order: bool = False) -> DataFrame:
    """GROUPING flags ascending, then the member labels as text.

    Within one flag combination an aggregated-away member is constant, so
    sorting on the labels equals the source's COALESCE(.., 'ZZZZ') order.
    Text order means months sort 1, 10, 11, 12, 2, ...; with
    ``numeric_time_order`` they sort by number.  A global sort shuffles every
    row, so results are ordered only on request.
    """
    number = [F.expr("try_cast(time_dimension AS INT)")] if numeric_time_order else []
    geo, time, product = DIMENSIONS
    return df.orderBy(*FLAGS, geo, *number, time, product)


def analysis(source, geo: str = "region", time: str = "quarter",
             product: str = "productGroup", year: int | None = None, *,
             via_base_cuboid: bool = True, ordered: bool = False,
             strategy: str | None = DEFAULT_STRATEGY) -> DataFrame:
    """GROUP BY CUBE(geo, time, product): all 8 aggregation levels.

    ``strategy``: ``"expand"`` (Spark's CUBE over the base cuboid),
    ``"by_product"`` (the base dealt by product member once) or
    ``"lattice"`` (each level from its smallest computed parent).
    """
    cols = resolve_levels(geo, time, product)
    star = source.frame(year)
    agg = _aggregate(star, cols, CUBE_SETS, via_base_cuboid, strategy)
    return _finish(agg, cols, "aggregation_level", CUBE_LEVEL_LABELS,
                   CUBE_LEVEL_FALLBACK, ordered)


def cube_level(source, level: str, geo: str = "region", time: str = "quarter",
               product: str = "productGroup", year: int | None = None, *,
               ordered: bool = False) -> DataFrame:
    """Only the rows of one CUBE level, e.g. ``'Detail Level'``.

    Equal to ``analysis(...)`` filtered on ``aggregation_level``, but
    computes just that grouping set instead of all eight.
    """
    flags = {v: k for k, v in CUBE_LEVEL_LABELS.items()}
    if level not in flags:
        raise ValueError(f"Unknown level {level!r}. Must be one of: {list(flags)}")
    gset = tuple(i for i, f in enumerate(flags[level]) if f == 0)
    cols = resolve_levels(geo, time, product)
    agg = _aggregate(source.frame(year), cols, (gset,), via_base_cuboid=False)
    return _finish(agg, cols, "aggregation_level", CUBE_LEVEL_LABELS,
                   CUBE_LEVEL_FALLBACK, ordered)


def grouping_sets(source, geo: str = "region", time: str = "quarter",
                  product: str = "productGroup", year: int | None = None, *,
                  via_base_cuboid: bool = True, ordered: bool = False,
                  strategy: str | None = DEFAULT_STRATEGY) -> DataFrame:
    """GROUPING SETS ((g,t,p), (g,t), (g,p), (g), ()) for the cross table."""
    cols = resolve_levels(geo, time, product)
    agg = _aggregate(source.frame(year), cols, CROSSTAB_SETS, via_base_cuboid, strategy)
    return _finish(agg, cols, "aggregation_type", GROUPING_SET_LABELS,
                   GROUPING_SET_FALLBACK, ordered)


# -- second-stage helpers on an analysis result ---------------------------

def filter_level(result: DataFrame, level: str, label_col: str = "aggregation_level") -> DataFrame:
    return result.where(F.col(label_col) == level)


def level_counts(result: DataFrame, label_col: str = "aggregation_level") -> DataFrame:
    """Records per aggregation level (one row per label)."""
    return result.groupBy(label_col).agg(F.count(F.lit(1)).alias("records"))


def presentation(result: DataFrame) -> DataFrame:
    """Hide the technical GROUPING flag columns."""
    return result.drop(*FLAGS)


def detail_summary(result: DataFrame, label: str = "Detail Level",
                   label_col: str = "aggregation_level") -> DataFrame:
    """Record count and revenue total of the detail rows (one row)."""
    detail = filter_level(result, label, label_col)
    return detail.agg(F.count(F.lit(1)).alias("record_count"),
                      F.coalesce(F.sum("total_revenue"), F.lit(0))
                      .cast("decimal(38,2)").alias("total_revenue"))


def detail_sample(result: DataFrame, n: int = 10, label: str = "Detail Level",
                  label_col: str = "aggregation_level") -> DataFrame:
    """First ``n`` detail rows in level order (a top-n report by position,
    not by value)."""
    detail = order_levels(filter_level(result, label, label_col))
    return detail.limit(n).select("geo_dimension", "time_dimension", "product_dimension",
                                  "total_revenue")
