"""SQL twins of ``kubus.queries.registry()`` (same keys, same columns)."""

from __future__ import annotations

from . import oracle as O
from .functions.labels import CUBE_LEVEL_LABELS
from .queries import CROSSTAB_MEMBERS, SECOND_YEAR, YEAR

_KEYS = (("date", "date_key"), ("shop", "shop_key"), ("product", "product_key"))


def _counts(inner: str, label: str, name: str = "records") -> str:
    return O.wrap(inner, f"SELECT {label}, CAST(COUNT(*) AS BIGINT) AS {name} "
                         f"FROM r GROUP BY {label}")


def _presentation(inner: str) -> str:
    return O.wrap(inner, "SELECT * EXCLUDE (geo_grouping, time_grouping, product_grouping) "
                         "FROM r")


def registry() -> dict[str, str]:
    q: dict[str, str] = {}
    load = O.load_ctes()

    # -- dimensions and keys ------------------------------------------------
    q["dim_date"] = O.dim_date_sql()
    q["dim_shop"] = O.DIM_SHOP_SQL
    q["dim_product"] = O.DIM_PRODUCT_SQL
    q["dim_shop_chain"] = O.DIM_SHOP_CHAIN_SQL
    q["dim_product_chain"] = O.DIM_PRODUCT_CHAIN_SQL
    q["insert_if_absent"] = (f"{O.ctes(new=O.dim_date_sql(1), old=O.dim_date_sql())}\n"
                             "SELECT * FROM new WHERE date_key NOT IN (SELECT date_key FROM old)")

    # -- load ---------------------------------------------------------------
    q["sales_text"] = O.SALES_TEXT_SQL
    q["sales_parsed"] = (f"{O.ctes(**load)}\nSELECT sale_date_key AS date_key, shop_key, "
                         "product_key, sold_quantity AS quantity_sold, sale_revenue AS revenue "
                         "FROM classified WHERE reject_reason IS NULL")
    q["sales_rejects"] = (f"{O.ctes(**load | {'sales_text': O.LOCATED_TEXT_SQL})}\n"
                          "SELECT \"Date\", \"Shop\", \"Article\", \"Sold\", \"Revenue\", "
                          "reject_reason, source_file, source_line FROM classified "
                          "WHERE reject_reason IS NOT NULL")
    q["sales_reject_counts"] = (f"{O.ctes(**load)}\nSELECT reject_reason, "
                                "CAST(COUNT(*) AS BIGINT) AS rows FROM classified "
                                "WHERE reject_reason IS NOT NULL GROUP BY reject_reason")
    q["load_summary"] = (f"{O.ctes(**load)}\nSELECT CAST(COUNT(*) AS BIGINT) AS input_rows, "
                         "CAST(COUNT(*) FILTER (WHERE reject_reason IS NULL) AS BIGINT) "
                         "AS accepted_rows, "
                         "CAST(COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS BIGINT) "
                         "AS rejected_rows FROM classified")
    q["cube_parsed_sales"] = O.cube_over({**load, "star": O.PARSED_STAR_SQL},
                                         "city", "month", "productCategory")
    q["cube_parsed_preaggregated"] = O.cube_over({**load, "star": O.PARSED_STAR_SQL},
                                                 "region", "quarter", "productFamily")
    q["crosstab_parsed_preaggregated"] = O.crosstab_sql(
        "city", "month", "productCategory", None, "transaction_count",
        source={**load, "star": O.PARSED_STAR_SQL})
    q["sales_csv"] = O.SALES_TEXT_SQL
    q["warehouse_rebuilt"] = q["sales_parsed"]
    q["warehouse_row_counts"] = f"{O.ctes(**load)}\n" + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {table}" for name, table in (
            ("dim_date", "dim_date"), ("dim_shop", "dim_shop"), ("dim_product", "dim_product"),
            ("fact_sales", "classified WHERE reject_reason IS NULL"),
            ("rejects", "classified WHERE reject_reason IS NOT NULL")))
    q["warehouse_cube"] = O.cube_over(
        {**load, "star": O.PARSED_STAR_SQL + f' AND c."year" = {YEAR}'},
        "region", "quarter", "productFamily")

    outcome = "coalesce(reject_reason, 'accepted')"
    q["load_report"] = (f"{O.ctes(**load)}\nSELECT {outcome} AS outcome, CAST(COUNT(*) AS BIGINT) AS rows "
                        f"FROM classified GROUP BY {outcome}")
    q["second_load_years"] = (f"{O.ctes(**load)}\nSELECT CAST(year(sale_date) AS INTEGER) AS \"year\", "
                              "COUNT(*) AS rows, CAST(SUM(sale_revenue) AS DECIMAL(38,2)) AS revenue "
                              "FROM classified WHERE reject_reason IS NULL GROUP BY 1")
    q["second_load_calendar"] = O.dim_date_sql()
    q["second_load_rejects"] = (
        f"{O.ctes(**load | {'sales_text': O.LOCATED_TEXT_SQL})}\n" + "\nUNION ALL\n".join(
            f"SELECT reject_reason, CAST({batch} AS INTEGER) AS load_batch, COUNT(*) AS rows FROM classified "
            f"WHERE reject_reason IS NOT NULL AND CAST(source_file[3:] AS INTEGER) {years} {SECOND_YEAR} "
            "GROUP BY reject_reason" for batch, years in ((0, "<="), (1, ">="))))
    q["shop_keys_reload"] = f"""{O.ctes(shops=O.DIM_SHOP_SQL)},
firsts AS (SELECT city_name, shop_name, row_number() OVER (ORDER BY city_name, shop_name) AS first_number
           FROM (SELECT DISTINCT city_name, shop_name FROM shops WHERE shop_id % 2 = 0)),
rests AS (SELECT city_name, shop_name, row_number() OVER (ORDER BY city_name, shop_name)
            + (SELECT count(*) FROM firsts) AS shop_number
          FROM (SELECT city_name, shop_name FROM shops
                EXCEPT SELECT city_name, shop_name FROM firsts))
SELECT city_name, shop_name, first_number AS shop_number, first_number FROM firsts
UNION ALL SELECT city_name, shop_name, shop_number, NULL FROM rests"""
    q["warehouse_footers"] = f"{O.ctes(**load)}\n" + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, {column} AS column_name, "
        f"{least} AS least, {largest} AS largest FROM {table}" for name, table, column, least, largest in (
            ("dim_date", "dim_date", "'full_date'", *(f"CAST({f}(full_date) AS VARCHAR)" for f in ("MIN", "MAX"))),
            ("dim_shop", "dim_shop", *["CAST(NULL AS VARCHAR)"] * 3),
            ("dim_product", "dim_product", *["CAST(NULL AS VARCHAR)"] * 3),
            *(("fact_sales", "classified WHERE reject_reason IS NULL", f"'{c}'",
               *(f"CAST({f}({c}) AS VARCHAR)" for f in ("MIN", "MAX"))) for c in ("sale_date_key", "sold_quantity")),
            ("rejects", "classified WHERE reject_reason IS NOT NULL", *["CAST(NULL AS VARCHAR)"] * 3)))

    # -- fact and integrity -------------------------------------------------
    q["fact_sales"] = O.FACT_SQL
    dims = dict(dim_date=O.dim_date_sql(), dim_shop=O.DIM_SHOP_SQL,
                dim_product=O.DIM_PRODUCT_SQL, fact=O.FACT_SQL)
    q["fact_orphans"] = (f"{O.ctes(**dims)}\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dimension, CAST(COUNT(*) AS BIGINT) AS orphan_rows FROM fact "
        f"WHERE {k} NOT IN (SELECT {k} FROM {t})"
        for n, k, t in (("date", "date_key", "dim_date"), ("shop", "shop_key", "dim_shop"),
                        ("product", "product_key", "dim_product"))))
    q["dimension_duplicates"] = (f"{O.ctes(**dims)}\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dimension, CAST(COUNT(*) AS BIGINT) AS duplicate_keys FROM "
        f"(SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1) d"
        for n, k, t in (("date", "date_key", "dim_date"), ("shop", "shop_key", "dim_shop"),
                        ("product", "product_key", "dim_product"))))

    # Members whose key leaves 3 by 7 are gone, those that leave 5 by 11 come twice.
    gone = ", ".join(f"CASE WHEN {k} % 7 = 3 THEN '{n}' END" for n, k in _KEYS)
    q["loaded_orphan_rows"] = (f"{O.ctes(**load)}\nSELECT sale_date_key AS date_key, shop_key, product_key, "
                               "sold_quantity AS quantity_sold, sale_revenue AS revenue, "
                               f"concat_ws(',', {gone.replace('date_key', 'sale_date_key')}) AS missing "
                               "FROM classified WHERE reject_reason IS NULL AND (sale_date_key % 7 = 3 "
                               "OR shop_key % 7 = 3 OR product_key % 7 = 3)")
    q["loaded_orphans"] = f"{O.ctes(**load)}\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dimension, COUNT(*) AS orphan_rows FROM classified "
        f"WHERE reject_reason IS NULL AND {'sale_' if n == 'date' else ''}{k} % 7 = 3" for n, k in _KEYS)
    q["later_duplicates"] = f"{O.ctes(**dims)}\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dimension, COUNT(*) AS duplicate_keys FROM dim_{n} "
        f"WHERE {k} % 7 <> 3 AND {k} % 11 = 5" for n, k in _KEYS)
    q["later_duplicate_shops"] = (f"{O.ctes(**dims)}\nSELECT s.*, CAST(2 AS BIGINT) AS copies FROM dim_shop s, "
                                  "(VALUES (1), (2)) WHERE shop_key % 7 <> 3 AND shop_key % 11 = 5")

    # -- statistics ---------------------------------------------------------
    q["table_row_counts"] = (f"{O.ctes(**dims)}\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {src}"
        for t, src in (("dim_date", "dim_date"), ("dim_shop", "dim_shop"),
                       ("dim_product", "dim_product"), ("fact_sales", "fact"))))
    loaded = (f"SELECT sale_date_key AS date_key, shop_key, product_key, sold_quantity AS "
              "quantity_sold, sale_revenue AS revenue FROM classified WHERE reject_reason IS NULL")
    stats = (",\n"
             "s AS (SELECT CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue, "
             "CAST(COUNT(*) AS BIGINT) AS total_transactions, "
             "CAST(COUNT(DISTINCT product_key) AS BIGINT) AS unique_products, "
             "CAST(COUNT(DISTINCT shop_key) AS BIGINT) AS unique_shops FROM fact),\n"
             "d AS (SELECT MIN(c.full_date) AS start_date, MAX(c.full_date) AS end_date "
             "FROM fact f JOIN dim_date c ON f.date_key = c.date_key),\n"
             "st AS (SELECT total_revenue, total_transactions, start_date, end_date, "
             "CAST(start_date AS VARCHAR) || ' to ' || CAST(end_date AS VARCHAR) AS date_range, "
             "unique_products, unique_shops FROM s CROSS JOIN d)\n")
    status = (
        "SELECT *, COALESCE(total_transactions, 0) = 0 AS is_empty, "
        "CASE WHEN COALESCE(total_transactions, 0) = 0 THEN "
        "'no facts loaded yet: build the warehouse first' ELSE 'ok' END AS status "
        "FROM st")
    g, t, p = O.resolve_levels("region", "quarter", "productFamily")
    q["distinct_by_level"] = f"""WITH {O.star_cte()}
SELECT CAST({g} AS VARCHAR) AS geo_member, CAST("{t}" AS VARCHAR) AS time_member,
  CAST({p} AS VARCHAR) AS product_member, CAST(GROUPING({g}) AS INTEGER) AS geo_grouping,
  CAST(GROUPING("{t}") AS INTEGER) AS time_grouping, CAST(GROUPING({p}) AS INTEGER) AS product_grouping,
  COUNT(DISTINCT product_key) AS unique_products, COUNT(DISTINCT shop_key) AS unique_shops
FROM star GROUP BY CUBE ({g}, "{t}", {p})"""
    q["summary_statistics"] = O.ctes(**dims) + stats + "SELECT * FROM st"
    q["warehouse_status"] = O.ctes(**dims) + stats + status
    q["warehouse_statistics"] = O.ctes(**load, fact=loaded) + stats + status
    q["sales_summary_view"] = (f"WITH {O.star_cte()}\n"
                               "SELECT \"year\", \"quarter\", \"month\", region_name, city_name, "
                               "product_category_name, product_family_name, "
                               "CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity, "
                               "CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue, "
                               "CAST(COUNT(*) AS BIGINT) AS transaction_count FROM star "
                               "GROUP BY ALL")
    q["sales_summary_sql"] = O.wrap(q["sales_summary_view"],
                                    f"SELECT * FROM r WHERE \"year\" = {YEAR}")

    # -- CUBE ---------------------------------------------------------------
    q["cube_default"] = O.cube_sql("region", "quarter", "productGroup")
    q["cube_year"] = O.cube_sql("region", "quarter", "productCategory", YEAR)
    q["cube_year_direct"] = q["cube_year"]
    q["cube_all_years"] = O.cube_sql("region", "quarter", "productCategory")
    q["cube_base_cuboid"] = q["cube_year"]
    q["cube_city_month_category"] = O.cube_sql("city", "month", "productCategory")
    q["cube_city_month_family"] = O.cube_sql("city", "month", "productFamily")
    q["cube_coarsest"] = O.cube_sql("country", "year", "productCategory")
    q["cube_finest"] = O.cube_sql("shop", "day", "article")
    q["cube_lattice"] = O.cube_sql("region", "month", "productFamily")
    q["cube_sql_views"] = O.cube_sql("region", "quarter", "productFamily", YEAR)
    q["cube_level_detail"] = O.cube_level_sql("Detail Level", "region", "quarter",
                                              "productGroup", None)
    q["cube_level_geo_time"] = O.cube_level_sql("By Geo + Time", "region", "quarter",
                                                "productGroup", None)
    q["cube_level_filter"] = O.cube_level_sql("By Time + Product", "region", "quarter",
                                              "productCategory", None)
    q["cube_level_counts"] = _counts(O.cube_sql("region", "quarter", "productGroup"),
                                     "aggregation_level")
    q["cube_presentation"] = _presentation(q["cube_all_years"])

    # -- GROUPING SETS ------------------------------------------------------
    q["grouping_sets_default"] = O.grouping_sets_sql("region", "quarter", "productGroup")
    q["grouping_sets_year"] = O.grouping_sets_sql("region", "quarter", "productCategory", YEAR)
    q["grouping_sets_finest"] = O.grouping_sets_sql("shop", "day", "article")
    q["grouping_type_counts"] = _counts(
        O.grouping_sets_sql("region", "quarter", "productGroup"), "aggregation_type")

    # -- cross table ----------------------------------------------------------
    for metric, name in (("total_quantity", "crosstab_quantity"),
                         ("total_revenue", "crosstab_revenue"),
                         ("transaction_count", "crosstab_transactions")):
        q[name] = O.crosstab_sql("region", "quarter", "productCategory", YEAR, metric)
    q["crosstab_default"] = O.crosstab_sql("region", "quarter", "productGroup", YEAR,
                                           "total_quantity")
    q["crosstab_capped"] = O.crosstab_wide_sql(CROSSTAB_MEMBERS, "region", "quarter",
                                               "productCategory", YEAR, "total_revenue")
    # The first three product categories of the input in label order.
    q["crosstab_first_members"] = O.crosstab_wide_sql(("ECONOMY", "LARGE", "MEDIUM"), "region", "quarter",
                                                      "productCategory", YEAR, "total_revenue", rest=True)
    q["crosstab_all_years"] = O.crosstab_sql("city", "month", "productFamily", None,
                                             "total_quantity")
    q["crosstab_insights"] = O.insights_sql("region", "quarter", "productGroup", YEAR,
                                            "total_quantity")
    q["crosstab_shape"] = O.shape_sql("region", "quarter", "productGroup", YEAR)

    # -- drill-down / roll-up -------------------------------------------------
    q["drill_start"] = O.cube_sql("region", "quarter", "productGroup", YEAR)
    q["drill_down_geo"] = O.cube_sql("city", "quarter", "productGroup", YEAR)
    q["drill_down_product"] = O.cube_sql("region", "quarter", "article", YEAR)
    q["roll_up_time"] = O.cube_sql("region", "year", "productGroup", YEAR)
    q["navigator_walk"] = O.cube_sql("city", "year", "article", YEAR)
    detail = O.cube_level_sql("Detail Level", "region", "quarter", "productGroup", YEAR)
    q["drill_summary"] = O.wrap(detail, (
        "SELECT 'region' AS geo_level, 'quarter' AS time_level, 'productGroup' AS product_level, "
        "CAST(COUNT(*) AS BIGINT) AS record_count, "
        "CAST(COALESCE(SUM(total_revenue), 0) AS DECIMAL(38,2)) AS total_revenue FROM r"))
    q["drill_sample"] = O.wrap(detail, (
        "SELECT geo_dimension, time_dimension, product_dimension, total_revenue FROM r "
        "ORDER BY geo_grouping, time_grouping, product_grouping, geo_dimension, "
        "time_dimension, product_dimension LIMIT 10"))
    q["drill_detail"] = _presentation(detail)
    assert set(CUBE_LEVEL_LABELS.values())  # labels shared with the Spark side
    return q
