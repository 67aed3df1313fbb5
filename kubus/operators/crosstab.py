"""Cross table: (geo, time) rows by product columns, with totals.

``cross_table`` is the whole table in long form, one row per cell:

    geo_region | time_period       | product_member | value | three total flags
    AFRICA     | quarter 1, 1997   | <member>       |  ...     cell
    AFRICA     | quarter 1, 1997   | TOTAL          |  ...     row total
    AFRICA     | total             | <member>       |  ...     subtotal of a region
    total      |                   | <member>       |  ...     column total
    total      |                   | TOTAL          |  ...     grand total

It is one aggregation by grouping sets over the (geo, time, product) cuboid
of the chosen metric; no label leaves the executors and any number of
members is possible.  What is a total is decided by the GROUPING flags, so
NULL members stay in the table like all others.

``cross_table_wide`` lays the same table out with one column per member the
caller names, or for the first members in label order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import resolve_levels, validate_metric
from ..session import written

TOTAL_COLUMN = "TOTAL"
TOTAL_ROW = "total"
REST_COLUMN = "..."

# Cells, row totals, region subtotals (by member and overall), column totals, grand total.
SETS = (("_g", "_t", "_p"), ("_g", "_t"), ("_g", "_p"), ("_g",), ("_p",), ())

_METRIC_TYPE = {"total_quantity": "long", "total_revenue": "decimal(38,2)",
                "transaction_count": "long"}


def _metric_value(metric: str) -> Column:
    return {"total_quantity": F.col("_m_qty").cast("long"),
            "total_revenue": F.col("_m_rev"),
            "transaction_count": F.col("_m_rows").cast("long")}[metric]


def _labels(star: DataFrame, cols: tuple[str, str, str]) -> DataFrame:
    """Members as text plus quantity, revenue and row weight; a star that
    carries pre-aggregated state contributes its sums instead of rows."""
    g, t, p = cols
    if "_rows" in star.columns:
        measures = [F.col("_qty").alias("_m_qty"), F.col("_rev").alias("_m_rev"),
                    F.col("_rows").alias("_m_rows")]
    else:
        measures = [F.col("quantity_sold").alias("_m_qty"), F.col("revenue").alias("_m_rev"),
                    F.lit(1).alias("_m_rows")]
    return star.select(F.col(g).cast("string").alias("_g"), F.col(t).cast("string").alias("_t"),
                       F.col(p).cast("string").alias("_p"), *measures)


def metric_cuboid(star: DataFrame, cols: tuple[str, str, str], metric: str) -> DataFrame:
    """Detail cells (geo, time, product) -> metric; members as text."""
    return (_labels(star, cols).groupBy("_g", "_t", "_p")
            .agg(F.sum(_metric_value(metric)).alias("_v")))


def _time_label(time: str, year: int | None) -> Column:
    suffix = [] if year is None else [F.lit(f", {year}")]
    return F.concat(F.lit(f"{time} "), F.col("_t"), *suffix)


def _row_labels(time: str, year: int | None) -> list[Column]:
    """geo_region and time_period from the members and flags ``_gg``, ``_gt``."""
    return [F.when(F.col("_gg") == 1, TOTAL_ROW).otherwise(F.col("_g")).alias("geo_region"),
            F.when(F.col("_gg") == 1, "").when(F.col("_gt") == 1, TOTAL_ROW)
            .otherwise(_time_label(time, year)).alias("time_period")]


def cross_table(source, geo: str = "region", time: str = "quarter",
                product: str = "productGroup", year: int | None = None,
                metric: str = "total_quantity") -> DataFrame:
    """The long form: geo_region, time_period, product_member, value and the
    flags geo_total, time_total, product_total (1: summed over)."""
    validate_metric(metric)
    cells = metric_cuboid(source.frame(year), resolve_levels(geo, time, product), metric)
    table = cells.groupingSets([list(s) for s in SETS], "_g", "_t", "_p").agg(
        F.grouping("_g").alias("_gg"), F.grouping("_t").alias("_gt"),
        F.grouping("_p").alias("_gp"), F.sum("_v").alias("_v"))
    return table.select(
        *_row_labels(time, year),
        F.when(F.col("_gp") == 1, TOTAL_COLUMN).otherwise(F.col("_p")).alias("product_member"),
        F.col("_v").cast(_METRIC_TYPE[metric]).alias("value"),
        *[F.col(c).cast("int").alias(f) for c, f in (
            ("_gg", "geo_total"), ("_gt", "time_total"), ("_gp", "product_total"))])


def first_members(cells: DataFrame, first: int) -> tuple[list[str | None], bool]:
    """The ``first`` members of the cells in label order (NULL last), and
    whether there are more.  Every task keeps its ``first`` + 1 smallest."""
    rows = cells.select("_p").distinct().orderBy(F.col("_p").asc_nulls_last()).limit(first + 1).collect()
    return [r["_p"] for r in rows[:first]], len(rows) > first


def cross_table_wide(source, members: list[str | None] | None = None, geo: str = "region",
                     time: str = "quarter", product: str = "productGroup",
                     year: int | None = None, metric: str = "total_quantity",
                     first: int = 8) -> DataFrame:
    """geo_region, time_period, one column per entry of ``members`` and TOTAL.

    Only the named members get a column (None: the NULL member, column
    ``NULL``), but TOTAL sums all members on every row.  Without ``members``
    the ``first`` ones in label order get theirs and, if there are more, a
    column ``...`` holds the sum of all others.  Columns are built under
    positional names and renamed last, so members may have any name, also equal
    ones but for case, or that of another column.
    """
    validate_metric(metric)
    cells = metric_cuboid(source.frame(year), resolve_levels(geo, time, product), metric)
    out_type = _METRIC_TYPE[metric]
    rest = False
    if members is None:
        cells = written(cells, "cross-cells")  # read twice: for the labels and the table
        members, rest = first_members(cells, first)

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast(out_type).alias(name)

    chosen = [F.col("_p").eqNullSafe(F.lit(m)) for m in members]
    values = [F.when(c, F.col("_v")) for c in chosen]
    if rest:
        values.append(F.when(~reduce(Column.__or__, chosen, F.lit(False)), F.col("_v")))
    rolled = cells.rollup("_g", "_t").agg(
        F.grouping("_g").alias("_gg"), F.grouping("_t").alias("_gt"),
        *[total(v, f"_c{i}") for i, v in enumerate(values)], total(F.col("_v"), "_c"))
    wide = rolled.select(*_row_labels(time, year), *[f"_c{i}" for i in range(len(values))], "_c")
    return wide.toDF("geo_region", "time_period", *["NULL" if m is None else m for m in members],
                     *[REST_COLUMN] * rest, TOTAL_COLUMN)


def insights(source, geo: str = "region", time: str = "quarter",
             product: str = "productGroup", year: int | None = None,
             metric: str = "total_quantity", top: int = 3) -> DataFrame:
    """First ``top`` geographic totals in label order (not by value) and the
    grand total of the metric: rows (insight, label, value)."""
    validate_metric(metric)
    cols = resolve_levels(geo, time, product)
    per_geo = (_labels(source.frame(year), cols)
               .groupBy("_g").agg(F.sum(_metric_value(metric)).alias("_v")))
    out_type = _METRIC_TYPE[metric]
    firsts = per_geo.orderBy("_g").limit(top).select(
        F.lit("geographic_total").alias("insight"), F.col("_g").alias("label"),
        F.col("_v").cast(out_type).alias("value"))
    grand = per_geo.agg(F.sum("_v").alias("_v")).select(
        F.lit("grand_total").alias("insight"), F.lit("total").alias("label"),
        F.col("_v").cast(out_type).alias("value"))
    return firsts.unionByName(grand)


def table_shape(source, geo: str = "region", time: str = "quarter",
                product: str = "productGroup", year: int | None = None) -> DataFrame:
    """geo members, time periods, product members (NULL members count) and
    the size of the table laid out wide."""
    cells = metric_cuboid(source.frame(year), resolve_levels(geo, time, product),
                          "transaction_count")
    # A struct of a NULL is not NULL, so NULL members are counted too.
    counts = cells.agg(*[F.count_distinct(F.struct(*keys)).alias(name) for keys, name in (
        (["_g"], "geo_members"), (["_t"], "time_periods"), (["_p"], "product_members"),
        (["_g", "_t"], "_pairs"))])
    return counts.select(
        F.col("geo_members").cast("long"), F.col("time_periods").cast("long"),
        F.col("product_members").cast("long"),
        (F.col("_pairs") + F.col("geo_members") + 1).cast("long").alias("table_rows"),
        (F.col("product_members") + 1).cast("long").alias("table_columns"))
