"""Dimension builders: calendar, flattened hierarchies, surrogate keys.

The flattened dimensions reuse the natural integer id of the leaf (shop id,
article id) as surrogate key, which survives any re-computation.  Where
members have no such id, ``assign_keys`` numbers them densely and keeps the
keys of members it has seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, iso_weekday, month_name, quarter_name
from .ordering import numbered

DIM_DATE_COLUMNS = ("date_key", "full_date", "year", "quarter", "month", "day",
                    "day_of_week", "month_name", "quarter_name")


def _date_attributes(full_date: Column) -> list[Column]:
    return [
        date_key(full_date).alias("date_key"),
        full_date.alias("full_date"),
        F.year(full_date).cast("int").alias("year"),
        F.quarter(full_date).cast("int").alias("quarter"),
        F.month(full_date).cast("int").alias("month"),
        F.dayofmonth(full_date).cast("int").alias("day"),
        iso_weekday(full_date).alias("day_of_week"),
        month_name(full_date).alias("month_name"),
        quarter_name(full_date).alias("quarter_name"),
    ]


def _explode_years(bounds: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """First the years, dealt out over the tasks, then each year's days."""
    years = bounds.select(F.explode(F.sequence(lo, hi)).alias("y")).repartition(8, "y")
    days = F.sequence(F.make_date(F.col("y"), F.lit(1), F.lit(1)),
                      F.make_date(F.col("y"), F.lit(12), F.lit(31)), F.expr("INTERVAL 1 DAY"))
    return years.select(F.explode(days).alias("full_date")).select(
        *_date_attributes(F.col("full_date")))


def calendar(spark: SparkSession, start_year: int = 2019, end_year: int = 2020) -> DataFrame:
    """Every day of ``start_year`` .. ``end_year``: at most 366 rows per year.

    Generating the days as a sequence means no invalid day can arise.
    """
    if end_year < start_year:
        raise ValueError("end_year before start_year")
    bounds = spark.range(1).select(F.lit(start_year).alias("lo"), F.lit(end_year).alias("hi"))
    return _explode_years(bounds, F.col("lo"), F.col("hi"))


def calendar_covering(dates: DataFrame, column: str, extra_years: int = 0) -> DataFrame:
    """Calendar spanning the whole years of ``dates[column]`` (lazy).

    For data whose period is not known beforehand; where it is, ``calendar``
    with its first and last year keeps stray dates out.  The bounds come from
    a one-row distributed aggregate, so nothing is collected to the driver.
    """
    bounds = dates.agg(F.min(F.year(column)).alias("lo"),
                       (F.max(F.year(column)) + F.lit(extra_years)).alias("hi"))
    return _explode_years(bounds.where(F.col("lo").isNotNull()), F.col("lo"), F.col("hi"))


def insert_if_absent(new: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing`` (ON CONFLICT DO NOTHING).

    ``plans.warehouse.append_dimension`` appends them to a written table.  The
    anti join shuffles on the key only; duplicates inside ``new`` are removed
    first; null is a key like others.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return new.dropDuplicates(keys).join(known, same, "left_anti")


def assign_keys(members: DataFrame, known: DataFrame | None, natural: list[str], key: str,
                name: str = "keys") -> DataFrame:
    """(``natural``..., ``key``): dense surrogate keys 1, 2, 3, ... that stay.

    Members of ``known`` keep their key; the others are numbered on from its
    largest, in order of ``natural`` (nulls first).  Repeated members get one
    key, nulls are values like others.  Numbering is two passes: a range sort
    over all tasks, then each partition's rows counted and the counts summed
    up, one row a partition.
    """
    distinct = members.select(*natural).distinct()
    first = 1
    if known is not None:
        known = known.select(*natural, F.col(key).cast("long").alias(key))
        distinct = insert_if_absent(distinct, known, natural)
        first += known.agg(F.max(key).alias("last")).first()["last"] or 0
    numbers = numbered(distinct, [], natural, name).select(
        *natural, (F.col("pos") + F.lit(first)).cast("long").alias(key))
    return numbers if known is None else known.unionByName(numbers)


def flatten_chain(leaf: DataFrame, parents: list[tuple[DataFrame, str, str]],
                  distinct: bool = True) -> DataFrame:
    """Leaf -> parent -> grandparent ... inner equi-joins, denormalised.

    ``parents`` is a list of ``(table, fk_in_current, pk_in_table)``; every
    table must already carry distinct column names.  The optimizer broadcasts
    parents below its threshold.  DISTINCT mirrors the source system and is a
    shuffle of the dimension only.
    """
    out = leaf
    for parent, fk, pk in parents:
        out = out.join(parent, out[fk] == parent[pk], "inner")
    return out.distinct() if distinct else out


def shop_dimension(shop: DataFrame, city: DataFrame, region: DataFrame,
                   country: DataFrame) -> DataFrame:
    """Shop -> City -> Region -> Country, one row per shop.

    Inputs use the normalised column names (``ShopID, CityID, Name`` ...).
    """
    s = shop.select(F.col("ShopID").cast("int").alias("shop_id"),
                    F.col("Name").alias("shop_name"), F.col("CityID").alias("s_city"))
    c = city.select(F.col("CityID").alias("city_id"), F.col("Name").alias("city_name"),
                    F.col("RegionID").alias("c_region"))
    r = region.select(F.col("RegionID").alias("region_id"), F.col("Name").alias("region_name"),
                      F.col("CountryID").alias("r_country"))
    co = country.select(F.col("CountryID").alias("country_id"),
                        F.col("Name").alias("country_name"))
    flat = flatten_chain(s, [(c, "s_city", "city_id"), (r, "c_region", "region_id"),
                             (co, "r_country", "country_id")])
    return flat.select(
        F.col("shop_id").cast("long").alias("shop_key"), "shop_id", "shop_name",
        F.col("city_id").cast("int").alias("city_id"), "city_name",
        F.col("region_id").cast("int").alias("region_id"), "region_name",
        F.col("country_id").cast("int").alias("country_id"), "country_name")


def product_dimension(article: DataFrame, group: DataFrame, family: DataFrame,
                      category: DataFrame) -> DataFrame:
    """Article -> ProductGroup -> ProductFamily -> ProductCategory."""
    a = article.select(F.col("ArticleID").cast("int").alias("article_id"),
                       F.col("Name").alias("article_name"),
                       F.col("Price").cast("decimal(10,2)").alias("price"),
                       F.col("ProductGroupID").alias("a_group"))
    g = group.select(F.col("ProductGroupID").alias("product_group_id"),
                     F.col("Name").alias("product_group_name"),
                     F.col("ProductFamilyID").alias("g_family"))
    f = family.select(F.col("ProductFamilyID").alias("product_family_id"),
                      F.col("Name").alias("product_family_name"),
                      F.col("ProductCategoryID").alias("f_category"))
    c = category.select(F.col("ProductCategoryID").alias("product_category_id"),
                        F.col("Name").alias("product_category_name"))
    flat = flatten_chain(a, [(g, "a_group", "product_group_id"),
                             (f, "g_family", "product_family_id"),
                             (c, "f_category", "product_category_id")])
    return flat.select(
        F.col("article_id").cast("long").alias("product_key"), "article_id", "article_name",
        "price", F.col("product_group_id").cast("int").alias("product_group_id"),
        "product_group_name",
        F.col("product_family_id").cast("int").alias("product_family_id"),
        "product_family_name",
        F.col("product_category_id").cast("int").alias("product_category_id"),
        "product_category_name")
