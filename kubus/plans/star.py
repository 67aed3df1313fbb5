"""Star schemas as lazy DataFrames.

A *star source* turns an optional year filter into one flat "star frame"
with the columns in ``model.STAR_COLUMNS``; the OLAP operators only ever
see that frame, so Catalyst prunes whatever a query does not use.

``TpchStar`` maps the TPC-H style input tables onto the retail star:

* fact     = lineitem x orders (``l_orderkey = o_orderkey``)
* date     = ``o_orderdate``; year/quarter/month/day are computed inline
             (the calendar is a pure function of the date, so no join)
* geo      = country ``WORLD`` > region ``r_name`` > city ``n_name`` >
             shop ``s_name`` (via ``l_suppkey``)
* product  = category ``p_type`` > family ``p_type/p_brand`` > group
             ``p_type/p_brand/p_name`` > article ``group#p_partkey``;
             paths are concatenated because brand and name do not nest
             under type.

``WarehouseStar`` reads a warehouse written by ``plans.warehouse``: the
fact is partitioned by ``sale_year`` so a year filter prunes directories.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import year_range_predicate
from ..model import STAR_COLUMNS
from ..operators.facts import accepted, rejected
from ..sources.tables import read_table
from .warehouse import SALES_SCHEMA, SALES_TABLE

WORLD = "WORLD"
FACT_COLUMNS = ("date_key", "shop_key", "product_key", "quantity_sold", "revenue")
MEASURE_COLUMNS = ("quantity_sold", "revenue")
STATE_COLUMNS = ("_qty", "_rev", "_rows", "_ratio_sum", "_ratio_n")


@dataclass
class TpchStar:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- dimensions -------------------------------------------------------
    def dim_shop(self) -> DataFrame:
        """supplier -> nation (city) -> region -> WORLD; one row per supplier."""
        region = self.table("region").selectExpr("r_regionkey AS region_id",
                                                 "r_name AS region_name")
        nation = self.table("nation").selectExpr("n_nationkey AS city_id", "n_name AS city_name",
                                                 "n_regionkey AS n_region")
        supplier = self.table("supplier")
        # No hints: the optimizer broadcasts nation/region (and supplier)
        # only while their estimated size is under the broadcast threshold.
        geo = nation.join(region, F.col("n_region") == F.col("region_id"))
        shops = supplier.join(geo, F.col("s_nationkey") == F.col("city_id"))
        return shops.selectExpr(
            "s_suppkey AS shop_key", "s_suppkey AS shop_id", "s_name AS shop_name",
            "CAST(city_id AS INT) AS city_id", "city_name",
            "CAST(region_id AS INT) AS region_id", "region_name",
            "1 AS country_id", f"'{WORLD}' AS country_name")

    def dim_product(self) -> DataFrame:
        family = "concat(p_type, '/', p_brand)"
        group = f"concat({family}, '/', p_name)"
        return self.table("part").selectExpr(
            "p_partkey AS product_key", "p_partkey AS article_id",
            f"concat({group}, '#', CAST(p_partkey AS STRING)) AS article_name",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
            f"{group} AS product_group_name", f"{family} AS product_family_name",
            "p_type AS product_category_name")

    # -- fact ---------------------------------------------------------------
    def _orders(self, year: int | None) -> DataFrame:
        orders = self.table("orders")
        if year is not None:
            # Range form of year() = y: pushed into the Parquet scan.
            orders = orders.where(year_range_predicate(F.col("o_orderdate"), year))
        return orders

    def fact_lines(self, year: int | None = None, order: tuple[str, ...] = ("*",)) -> DataFrame:
        """lineitem x orders with the raw columns the fact is made from; of an
        order, expressions on them, which are computed before the join."""
        li = self.table("lineitem")
        # Equi-join on the order key: broadcast only while the (filtered)
        # orders side is under the threshold, else a sort-merge join that
        # AQE may convert at runtime and whose hot keys it splits.
        return li.join(self._orders(year).selectExpr(*order), F.col("l_orderkey") == F.col("o_orderkey"))

    _FACT = ("l_suppkey AS shop_key", "l_partkey AS product_key",
             "CAST(l_quantity AS INT) AS quantity_sold",
             "CAST(l_extendedprice AS DECIMAL(10,2)) AS revenue")
    _DATE = "CAST(o_orderdate AS DATE)"

    def fact(self, year: int | None = None) -> DataFrame:
        d = self._DATE
        return self.fact_lines(year).selectExpr(
            f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INT) AS date_key",
            *self._FACT)

    def frame(self, year: int | None = None) -> DataFrame:
        """Fact joined to the base tables one at a time (snowflake order).

        Joining supplier, nation, region and part directly keeps each join
        side a plain scan, so its size estimate is the file size: tiny
        reference tables are broadcast by the optimizer's threshold, while
        supplier and part fall back to shuffle joins once they outgrow it.
        (A pre-joined shop dimension would be estimated as a product of its
        inputs and never broadcast.)
        """
        d = self._DATE
        fact = self.fact_lines(year).selectExpr(
            f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INT) AS date_key",
            f"{d} AS full_date", f"CAST(year({d}) AS INT) AS year",
            f"CAST(quarter({d}) AS INT) AS quarter", f"CAST(month({d}) AS INT) AS month",
            f"CAST(day({d}) AS INT) AS day", *self._FACT)
        supplier = self.table("supplier").selectExpr(
            "s_suppkey AS shop_key", "s_name AS shop_name", "s_nationkey")
        nation = self.table("nation").selectExpr(
            "n_nationkey AS s_nationkey", "n_name AS city_name", "n_regionkey")
        region = self.table("region").selectExpr("r_regionkey AS n_regionkey",
                                                 "r_name AS region_name")
        product = self.dim_product().drop("article_id", "price")
        joined = (fact.join(supplier, "shop_key").join(nation, "s_nationkey")
                  .join(region, "n_regionkey").join(product, "product_key"))
        return joined.selectExpr(*[c for c in STAR_COLUMNS if c != "country_name"],
                                 f"'{WORLD}' AS country_name").select(*STAR_COLUMNS)


def with_date_parts(fact: DataFrame) -> DataFrame:
    """full_date, year, quarter, month and day, all functions of ``date_key``,
    so the calendar need not be joined."""
    key = "date_key"
    return fact.selectExpr(
        "*", f"make_date({key} DIV 10000, {key} DIV 100 % 100, {key} % 100) AS full_date",
        f"CAST({key} DIV 10000 AS INT) AS year",
        f"CAST(({key} DIV 100 % 100 + 2) DIV 3 AS INT) AS quarter",
        f"CAST({key} DIV 100 % 100 AS INT) AS month", f"CAST({key} % 100 AS INT) AS day")


def star_join(fact: DataFrame, dim_shop: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Inner equi-joins of the fact with shop and product dimensions.

    Shop and product dimensions grow with the data (one row per supplier /
    part), so they carry no broadcast hint.  The optimizer broadcasts a side
    while it is under ``spark.sql.autoBroadcastJoinThreshold``; pass written
    tables, whose size it knows.  Otherwise the join is a sort-merge join on
    the surrogate key, whose hot keys AQE splits.
    """
    shop = dim_shop.select("shop_key", "shop_name", "city_name", "region_name",
                           "country_name")
    product = dim_product.select("product_key", "article_name", "product_group_name",
                                 "product_family_name", "product_category_name")
    joined = fact.join(shop, "shop_key").join(product, "product_key")
    if STATE_COLUMNS[0] in fact.columns:
        return joined.select(*[c for c in STAR_COLUMNS if c not in MEASURE_COLUMNS],
                             *STATE_COLUMNS)
    return joined.select(*STAR_COLUMNS)


def preaggregate_fact(fact: DataFrame) -> DataFrame:
    """Fact rows summed per (date_key, shop_key, product_key), with the
    mergeable state the OLAP operators understand (quantity, revenue, rows,
    exact unit-price sum and count).

    Worth it when the fact repeats its keys (many sales of one article in
    one shop on one day): every later join then touches one row per key
    triple.  The aggregate combines map-side, so a hot key is reduced
    before the shuffle.
    """
    from ..operators.cube import state_cuboid
    return state_cuboid(fact.select(*FACT_COLUMNS), ["date_key", "shop_key", "product_key"])


@dataclass
class WarehouseStar:
    """Star over a written warehouse (dims + fact partitioned by sale_year)."""

    spark: SparkSession
    root: str
    preaggregate: bool = False

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.root, name))

    def dim_date(self) -> DataFrame:
        return self.read("dim_date")

    def dim_shop(self) -> DataFrame:
        return self.read("dim_shop")

    def dim_product(self) -> DataFrame:
        return self.read("dim_product")

    def sales(self) -> DataFrame:
        """All classified lines, accepted and rejected."""
        return self.spark.read.schema(SALES_SCHEMA).parquet(os.path.join(self.root, SALES_TABLE))

    def fact(self, year: int | None = None) -> DataFrame:
        # Partition pruning: rejects are partitions of their own, 0 and below.
        keep = F.col("sale_year") > 0 if year is None else F.col("sale_year") == year
        return accepted(self.sales().where(keep))

    def rejects(self) -> DataFrame:
        """Rejected lines of all loads, with file, line and the load's number."""
        lines = self.sales().where(F.col("sale_year") <= 0)
        return rejected(lines.withColumn("load_batch", -F.col("sale_year")), "load_batch")

    def frame(self, year: int | None = None) -> DataFrame:
        fact = self.fact(year)
        if self.preaggregate:
            fact = preaggregate_fact(fact)
        return star_join(with_date_parts(fact), self.dim_shop(), self.dim_product())


@dataclass
class FrameStar:
    """Any DataFrame that already has the star columns."""

    df: DataFrame

    def frame(self, year: int | None = None) -> DataFrame:
        return self.df if year is None else self.df.where(F.col("year") == year)


@dataclass
class FactStar:
    """A fact DataFrame (FACT_COLUMNS, dates from the calendar) plus dimensions."""

    fact_df: DataFrame
    dim_shop: DataFrame
    dim_product: DataFrame
    preaggregate: bool = False

    def frame(self, year: int | None = None) -> DataFrame:
        fact = self.fact_df.select(*FACT_COLUMNS)
        if year is not None:
            fact = fact.where(F.col("date_key").between(year * 10000, year * 10000 + 9999))
        if self.preaggregate:
            fact = preaggregate_fact(fact)
        return star_join(with_date_parts(fact), self.dim_shop, self.dim_product)
