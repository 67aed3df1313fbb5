"""Register a star as SQL temp views named like the source warehouse.

``register_star_views`` exposes ``FactSales``, ``DimDate``, ``DimShop`` and
``DimProduct`` with the source warehouse's column names, so analysts can
keep writing their star queries as SQL (``spark.sql``) against the same
tables; Catalyst plans them exactly like the DataFrame operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.labels import CUBE_LEVEL_FALLBACK, CUBE_LEVEL_LABELS, TOTAL_LABEL

# Warehouse column names as the source warehouse defines them.
VIEW_COLUMNS = {
    "DimDate": {"date_key": "DateKey", "full_date": "FullDate", "year": "Year",
                "quarter": "Quarter", "month": "Month", "day": "Day",
                "day_of_week": "DayOfWeek", "month_name": "MonthName",
                "quarter_name": "QuarterName"},
    "DimShop": {"shop_key": "ShopKey", "shop_id": "ShopID", "shop_name": "ShopName",
                "city_id": "CityID", "city_name": "CityName", "region_id": "RegionID",
                "region_name": "RegionName", "country_id": "CountryID",
                "country_name": "CountryName"},
    "DimProduct": {"product_key": "ProductKey", "article_id": "ArticleID",
                   "article_name": "ArticleName", "price": "Price",
                   "product_group_name": "ProductGroupName",
                   "product_family_name": "ProductFamilyName",
                   "product_category_name": "ProductCategoryName"},
    "FactSales": {"date_key": "DateKey", "shop_key": "ShopKey", "product_key": "ProductKey",
                  "quantity_sold": "QuantitySold", "revenue": "Revenue"},
}


def register_star_views(spark: SparkSession, fact: DataFrame, dim_date: DataFrame,
                        dim_shop: DataFrame, dim_product: DataFrame,
                        prefix: str = "") -> dict[str, str]:
    """Create or replace the four temp views; returns view name by table."""
    names = {}
    for table, df in (("FactSales", fact), ("DimDate", dim_date), ("DimShop", dim_shop),
                      ("DimProduct", dim_product)):
        cols = VIEW_COLUMNS[table]
        view = df.selectExpr(*[f"`{c}` AS `{cols[c]}`" for c in cols if c in df.columns])
        name = f"{prefix}{table}"
        view.createOrReplaceTempView(name)
        names[table] = name
    return names


# Level name -> qualified view column, per hierarchy.
SQL_LEVELS = {
    "geo": {"country": "s.CountryName", "region": "s.RegionName", "city": "s.CityName",
            "shop": "s.ShopName"},
    "time": {"year": "d.Year", "quarter": "d.Quarter", "month": "d.Month", "day": "d.Day"},
    "product": {"productCategory": "p.ProductCategoryName",
                "productFamily": "p.ProductFamilyName",
                "productGroup": "p.ProductGroupName", "article": "p.ArticleName"},
}


def cube_statement(geo: str, time: str, product: str, with_year: bool,
                   prefix: str = "") -> str:
    """Spark SQL text of the CUBE analysis over the registered views; the
    year is a named parameter (``:year``), never spliced into the text."""
    from ..functions.parsing import PRICE_SCALE_OUT, PRICE_SCALE_ROW
    g, t, p = SQL_LEVELS["geo"][geo], SQL_LEVELS["time"][time], SQL_LEVELS["product"][product]
    cents = "CAST(f.Revenue * 100 AS BIGINT)"
    q = "f.QuantitySold"
    mag = (f"((abs({cents}) * {PRICE_SCALE_ROW // 100} + abs({q}) div 2) div abs({q}))")
    ratio = (f"CASE WHEN {q} = 0 OR {q} IS NULL OR f.Revenue IS NULL THEN NULL "
             f"WHEN ({cents} < 0) <> ({q} < 0) THEN -{mag} ELSE {mag} END")
    step = PRICE_SCALE_ROW // PRICE_SCALE_OUT
    s, n = f"SUM(CAST({ratio} AS DECIMAL(38,0)))", f"COUNT({ratio})"
    units = f"((abs({s}) + {step // 2} * {n}) div ({step} * {n}))"
    avg = (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(CASE WHEN {s} < 0 THEN -{units} "
           f"ELSE {units} END AS DOUBLE) / {float(PRICE_SCALE_OUT)}D END")
    labels = " ".join(
        f"WHEN GROUPING({g}) = {a} AND GROUPING({t}) = {b} AND GROUPING({p}) = {c} "
        f"THEN '{text}'" for (a, b, c), text in CUBE_LEVEL_LABELS.items())
    where = "WHERE d.Year = :year" if with_year else ""
    return f"""
SELECT
  CASE WHEN GROUPING({g}) = 1 THEN '{TOTAL_LABEL}' ELSE CAST({g} AS STRING) END AS geo_dimension,
  CASE WHEN GROUPING({t}) = 1 THEN '{TOTAL_LABEL}' ELSE CAST({t} AS STRING) END AS time_dimension,
  CASE WHEN GROUPING({p}) = 1 THEN '{TOTAL_LABEL}' ELSE CAST({p} AS STRING) END
    AS product_dimension,
  CAST(GROUPING({g}) AS INT) AS geo_grouping,
  CAST(GROUPING({t}) AS INT) AS time_grouping,
  CAST(GROUPING({p}) AS INT) AS product_grouping,
  CAST(SUM(f.QuantitySold) AS BIGINT) AS total_quantity,
  CAST(SUM(f.Revenue) AS DECIMAL(38,2)) AS total_revenue,
  COUNT(*) AS transaction_count,
  {avg} AS avg_unit_price,
  CASE {labels} ELSE '{CUBE_LEVEL_FALLBACK}' END AS aggregation_level
FROM {prefix}FactSales f
JOIN {prefix}DimShop s ON f.ShopKey = s.ShopKey
JOIN {prefix}DimDate d ON f.DateKey = d.DateKey
JOIN {prefix}DimProduct p ON f.ProductKey = p.ProductKey
{where}
GROUP BY CUBE ({g}, {t}, {p})"""


def sql_analysis(spark: SparkSession, geo: str = "region", time: str = "quarter",
                 product: str = "productGroup", year: int | None = None,
                 prefix: str = "") -> DataFrame:
    """CUBE analysis through ``spark.sql`` over views from ``register_star_views``."""
    from ..model import resolve_levels
    resolve_levels(geo, time, product)  # same validation as the DataFrame API
    text = cube_statement(geo, time, product, year is not None, prefix)
    return spark.sql(text, args={"year": year}) if year is not None else spark.sql(text)
