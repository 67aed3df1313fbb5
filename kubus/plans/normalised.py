"""The TPC-H style tables taken apart into the normalised base tables.

The source system's base tables are chains of ids (article to group to family
to category, shop to city to region to country).  An id here is the least
part key below it, so it is the same in every run and needs no numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .star import WORLD

_LEVELS = (("ProductCategoryID", "p_type"), ("ProductFamilyID", "p_brand"),
           ("ProductGroupID", "p_name"))


def normalised_products(star) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(Article, ProductGroup, ProductFamily, ProductCategory)."""
    part = star.table("part")
    path: list[str] = []
    ids = part
    tables = []
    for key, column in _LEVELS:
        parent = tables[-1][0] if tables else None
        path.append(column)
        level = part.groupBy(*path).agg(F.min("p_partkey").alias(key))
        ids = ids.join(level, path)
        tables.append((key, level, list(path), parent))
    article = ids.select(F.col("p_partkey").alias("ArticleID"), "ProductGroupID",
                         F.concat_ws("#", F.concat_ws("/", *path), F.col("p_partkey")).alias("Name"),
                         F.col("p_retailprice").alias("Price"))
    out = [article]
    for i in reversed(range(len(tables))):
        key, level, own, parent = tables[i]
        if parent:
            level = level.join(tables[i - 1][1], own[:-1])
        out.append(level.select(key, *([parent] if parent else []),
                                F.concat_ws("/", *own).alias("Name")))
    return tuple(out)


def normalised_shops(star) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(Shop, City, Region, Country)."""
    country = star.spark.range(1, 2).select(F.col("id").cast("int").alias("CountryID"),
                                            F.lit(WORLD).alias("Name"))
    return (star.table("supplier").selectExpr("s_suppkey AS ShopID", "s_nationkey AS CityID",
                                              "s_name AS Name"),
            star.table("nation").selectExpr("n_nationkey AS CityID", "n_regionkey AS RegionID",
                                            "n_name AS Name"),
            star.table("region").selectExpr("r_regionkey AS RegionID", "1 AS CountryID",
                                            "r_name AS Name"), country)
