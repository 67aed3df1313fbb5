"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the input tables of ``sf_dir`` in full (or data Spark
derives from them); ``kubus.oracle_queries`` holds the SQL twin of each.
Year-filtered queries use ``YEAR`` as the source system's year parameter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .model import CubePosition
from .operators import crosstab as X
from .operators import cube as C
from .operators import dims as D
from .operators import facts as FT
from .operators import integrity as I
from .operators import navigate as N
from .operators import stats as S
from .plans.normalised import normalised_products, normalised_shops
from .plans.star import FactStar, TpchStar, WarehouseStar
from .plans.views import register_star_views, sql_analysis
from .plans.warehouse import append_dimension, build_warehouse, load_period
from .session import scratch_path, written
from .sources.sales_text import (SALES_COLUMNS, read_sales_csv, render_sales_text,
                                 tpch_sales_keys, tpch_sales_text, with_names, write_sales_csv)

# The input orders span 1995-2001; 1997 plays the role of the source
# system's default analysis year.
YEAR = 1997
# The second load's first year, and the last one of the input.
SECOND_YEAR, LAST_YEAR = 1998, 2001
# The caller's columns of the wide cross table.
CROSSTAB_MEMBERS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO")

Query = Callable[[SparkSession, str], DataFrame]


def star(spark: SparkSession, sf_dir: str) -> TpchStar:
    return TpchStar(spark, sf_dir)


def dim_date(spark: SparkSession, sf_dir: str, extra_years: int = 0) -> DataFrame:
    """Calendar covering every order year (bounded: <= 366 rows per year)."""
    return D.calendar_covering(star(spark, sf_dir).table("orders"), "o_orderdate", extra_years)


def dim_shop_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> nation -> region flattened with the generic chain builder."""
    st = star(spark, sf_dir)
    s = st.table("supplier").select(F.col("s_suppkey").alias("shop_id"),
                                    F.col("s_name").alias("shop_name"),
                                    F.col("s_nationkey").alias("s_city"))
    c = st.table("nation").select(F.col("n_nationkey").alias("city_id"),
                                  F.col("n_name").alias("city_name"),
                                  F.col("n_regionkey").alias("c_region"))
    r = st.table("region").select(F.col("r_regionkey").alias("region_id"),
                                  F.col("r_name").alias("region_name"))
    flat = D.flatten_chain(s, [(c, "s_city", "city_id"), (r, "c_region", "region_id")])
    return flat.select(F.col("shop_id").alias("shop_key"), "shop_id", "shop_name",
                       F.col("city_id").cast("int").alias("city_id"), "city_name",
                       F.col("region_id").cast("int").alias("region_id"), "region_name",
                       F.lit(1).alias("country_id"), F.lit("WORLD").alias("country_name"))


def classified_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = star(spark, sf_dir)
    return FT.classify_sales(tpch_sales_text(st), st.dim_shop(), st.dim_product(),
                             dim_date(spark, sf_dir))


def parsed_star(spark: SparkSession, sf_dir: str, preaggregate: bool = False) -> FactStar:
    """Star over the fact loaded from the rendered sales text.

    The load is materialised first (as the warehouse build writes its fact
    table), so the analysis reads loaded rows instead of re-parsing text.
    """
    st = star(spark, sf_dir)
    fact = written(FT.accepted(classified_sales(spark, sf_dir)), "fact-sales")
    return FactStar(fact, written(st.dim_shop(), "dim-shop"),
                    written(st.dim_product(), "dim-product"), preaggregate=preaggregate)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"kubus-{name}-{uuid.uuid4().hex[:12]}")


# The usual order of a sales file's columns and that of another system's export.
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
CSV_ORDERS = (SALES_COLUMNS, ("Shop", "Revenue", "Date", "Sold", "Article"))


# A written sales file's folders: its order year and its place among that year's files.
FILE_YEAR, FILE_PIECE = "y=([0-9]+)/", "piece=([0-9]+)/"


def sales_files(spark: SparkSession, sf_dir: str) -> str:
    """Rendered sales text as CSV files of an order year, in order of the
    lines' keys; every other year has its columns in another order.

    A year's lines are dealt by range over numbered pieces, so no task sorts or
    writes a whole year; the lines travel as keys, names and numbers, the time
    and quantity as narrow as the text shows them, and become text in the tasks
    that write.  The lines of all years are kept as keys and numbers, names join
    those of a write.  A piece is compressed: it is small enough for one task to read."""
    path = scratch(spark, "sales-csv")
    st = star(spark, sf_dir)
    lines = written(tpch_sales_keys(st).select(*LINE_KEYS, "l_quantity", "o_orderdate"), "sales-lines")
    year = F.year("o_orderdate")
    for i, columns in enumerate(CSV_ORDERS):
        years = with_names(st, lines.where(year % 2 == i)) \
            .withColumn("l_quantity", F.col("l_quantity").cast("int")).repartitionByRange(year, *LINE_KEYS) \
            .withColumns({"y": year, "piece": F.spark_partition_id()}).sortWithinPartitions("y", "piece", *LINE_KEYS)
        write_sales_csv(render_sales_text(years, ("y", "piece")), path, columns=columns, mode="append",
                        partition_by=("y", "piece"), compression="gzip")
    return path


def sales_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales files with mixed headers, scanned back by column name."""
    return read_sales_csv(spark, sales_files(spark, sf_dir))


def lines_of_years(text: DataFrame) -> DataFrame:
    """``text`` with its place among all lines of its year in place of that in
    its file: source_file is the year's folder, and the lines of the year's
    earlier pieces, without their headers, count before those of a file."""
    files = text.groupBy("source_file").agg((F.max("source_line") - 1).alias("n")).select(
        F.col("source_file").alias("_file"), "n",
        F.regexp_extract("source_file", FILE_YEAR, 1).alias("_year"),
        F.regexp_extract("source_file", FILE_PIECE, 1).cast("int").alias("_piece"))
    before = Window.partitionBy("_year").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    files = written(files.select("_file", F.concat(F.lit("y="), "_year").alias("_folder"),
                                 F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")), "sales-pieces")
    return text.join(files, F.col("source_file") == F.col("_file")).select(
        *SALES_COLUMNS, F.col("_folder").alias("source_file"),
        (F.col("source_line") + F.col("_before")).alias("source_line"))


def located_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of the sales files with year folder and line in the year."""
    st = star(spark, sf_dir)
    return FT.rejected(FT.classify_sales(lines_of_years(sales_csv(spark, sf_dir)), st.dim_shop(),
                                         st.dim_product(), dim_date(spark, sf_dir)))


def warehouse(spark: SparkSession, sf_dir: str, runs: int = 1) -> WarehouseStar:
    """Full ETL run into a fresh folder: dims, CSV sales -> fact + rejects;
    further ``runs`` replace the tables of the one before."""
    out = scratch(spark, "warehouse")
    st, text = star(spark, sf_dir), sales_csv(spark, sf_dir)
    for _ in range(runs):
        build_warehouse(out, dim_date(spark, sf_dir), st.dim_shop(), st.dim_product(), text)
    return WarehouseStar(spark, out)


def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the tables of a built warehouse."""
    w = warehouse(spark, sf_dir)
    return S.table_row_counts({"dim_date": w.dim_date(), "dim_shop": w.dim_shop(),
                               "dim_product": w.dim_product(), "fact_sales": w.fact(),
                               "rejects": w.rejects()})


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted lines and rejects by reason, as counted by the write itself."""
    st = star(spark, sf_dir)
    report = build_warehouse(scratch(spark, "warehouse"), dim_date(spark, sf_dir), st.dim_shop(),
                             st.dim_product(), sales_csv(spark, sf_dir))
    return report.frame(spark)


def second_load(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    """A warehouse of the years up to SECOND_YEAR, then a batch of the years
    from SECOND_YEAR on, with a calendar that overlaps the first one's."""
    out, st, text = scratch(spark, "warehouse"), star(spark, sf_dir), sales_csv(spark, sf_dir)
    file_year = F.regexp_extract("source_file", FILE_YEAR, 1).cast("int")
    days, year = dim_date(spark, sf_dir), F.col("year")
    build_warehouse(out, days.where(year <= SECOND_YEAR), st.dim_shop(), st.dim_product(),
                    text.where(file_year <= SECOND_YEAR))
    for _ in range(2):  # a batch may be loaded again
        append_dimension(days.where(year >= SECOND_YEAR), f"{out}/dim_date", "date_key")
        load_period(out, text.where(file_year >= SECOND_YEAR), list(range(SECOND_YEAR, LAST_YEAR + 1)), batch=1)
    return WarehouseStar(spark, out)


def second_load_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and revenue per year after the second load."""
    return second_load(spark, sf_dir).fact().groupBy(
        F.expr("CAST(date_key DIV 10000 AS INT)").alias("year")).agg(
        F.count("*").alias("rows"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"))


def shop_keys_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shops numbered by city and name, first those of even ids, then all:
    the members of the first load keep their key."""
    shops = star(spark, sf_dir).dim_shop()
    natural = ["city_name", "shop_name"]
    first = written(D.assign_keys(shops.where("shop_id % 2 = 0"), None, natural, "shop_number"), "shop-keys")
    every = D.assign_keys(shops, first, natural, "shop_number")
    return every.join(first.withColumnRenamed("shop_number", "first_number"), natural, "left")


def later_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    """Dimensions as a later extract gives them: some members are gone, some
    come twice."""
    st, days = star(spark, sf_dir), dim_date(spark, sf_dir)
    out = {"date": (days, "date_key"), "shop": (st.dim_shop(), "shop_key"),
           "product": (st.dim_product(), "product_key")}
    return {n: (dim.where(f"{k} % 7 <> 3").unionByName(dim.where(f"{k} % 11 = 5 AND {k} % 7 <> 3")), k)
            for n, (dim, k) in out.items()}


def loaded_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded fact rows that the later dimensions lack a member for."""
    return I.orphan_rows(warehouse(spark, sf_dir).fact(), later_dimensions(spark, sf_dir))


def warehouse_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and date bounds of a built warehouse from its files' footers."""
    w = warehouse(spark, sf_dir)
    names = {n: f"{w.root}/{n}" for n in ("dim_date", "dim_shop", "dim_product")}
    return S.footer_statistics(
        spark, {**names, "fact_sales": f"{w.root}/sales", "rejects": f"{w.root}/sales"},
        {"dim_date": ("full_date",), "fact_sales": ("sale_date_key", "sold_quantity")},
        {"fact_sales": "sale_year > 0", "rejects": "sale_year <= 0"})


def warehouse_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status report over a built warehouse."""
    w = warehouse(spark, sf_dir)
    return S.warehouse_status(w.fact(), w.dim_date())


def navigator_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drill down geo, then product, then roll time up to year: the last
    step is answered from the navigation cuboid, not from the fact."""
    nav = N.Navigator(star(spark, sf_dir), YEAR)
    nav.drill_down("geo")
    nav.drill_down("product")
    return nav.roll_up("time")


def sql_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CUBE written as SQL against warehouse-named temp views."""
    st = star(spark, sf_dir)
    register_star_views(spark, st.fact(), dim_date(spark, sf_dir), st.dim_shop(),
                        st.dim_product(), prefix="kubus_")
    return sql_analysis(spark, "region", "quarter", "productFamily", YEAR, prefix="kubus_")


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # -- dimensions and keys ------------------------------------------------
    q["dim_date"] = lambda s, d: dim_date(s, d)
    q["dim_shop"] = lambda s, d: dim_shop_flattened(s, d)
    q["dim_product"] = lambda s, d: star(s, d).dim_product()
    q["dim_shop_chain"] = lambda s, d: D.shop_dimension(*normalised_shops(star(s, d)))
    q["dim_product_chain"] = lambda s, d: D.product_dimension(*normalised_products(star(s, d)))
    q["insert_if_absent"] = lambda s, d: D.insert_if_absent(
        dim_date(s, d, extra_years=1), dim_date(s, d), "date_key")

    # -- load: sales text -> fact with rejects --------------------------------
    q["sales_text"] = lambda s, d: tpch_sales_text(star(s, d))
    q["sales_parsed"] = lambda s, d: FT.accepted(classified_sales(s, d))
    q["sales_rejects"] = located_rejects
    q["sales_reject_counts"] = lambda s, d: FT.reject_counts(classified_sales(s, d))
    q["load_summary"] = lambda s, d: FT.load_summary(classified_sales(s, d))
    q["cube_parsed_sales"] = lambda s, d: C.analysis(parsed_star(s, d), "city", "month",
                                                     "productCategory")
    q["cube_parsed_preaggregated"] = lambda s, d: C.analysis(
        parsed_star(s, d, preaggregate=True), "region", "quarter", "productFamily")
    q["crosstab_parsed_preaggregated"] = lambda s, d: X.cross_table(
        parsed_star(s, d, preaggregate=True), "city", "month", "productCategory", None,
        "transaction_count")
    q["sales_csv"] = lambda s, d: sales_csv(s, d).select(*SALES_COLUMNS)
    q["warehouse_row_counts"] = warehouse_counts
    q["warehouse_statistics"] = warehouse_statistics
    q["warehouse_rebuilt"] = lambda s, d: warehouse(s, d, runs=2).fact()
    q["load_report"] = load_report
    q["second_load_years"] = second_load_years
    q["second_load_calendar"] = lambda s, d: second_load(s, d).dim_date()
    q["second_load_rejects"] = lambda s, d: second_load(s, d).rejects().groupBy(
        "reject_reason", "load_batch").agg(F.count("*").alias("rows"))
    q["shop_keys_reload"] = shop_keys_reload
    q["warehouse_footers"] = warehouse_footers
    q["warehouse_cube"] = lambda s, d: C.analysis(warehouse(s, d), "region", "quarter",
                                                  "productFamily", YEAR)

    # -- fact and integrity ---------------------------------------------------
    q["fact_sales"] = lambda s, d: star(s, d).fact()
    q["fact_orphans"] = lambda s, d: I.orphan_counts(star(s, d).fact(), {
        "date": (written(dim_date(s, d), "calendar"), "date_key"),
        "shop": (star(s, d).dim_shop(), "shop_key"),
        "product": (star(s, d).dim_product(), "product_key")})
    q["dimension_duplicates"] = lambda s, d: I.duplicate_keys({
        "date": (dim_date(s, d), "date_key"),
        "shop": (star(s, d).dim_shop(), "shop_key"),
        "product": (star(s, d).dim_product(), "product_key")})

    q["loaded_orphan_rows"] = loaded_orphans
    q["loaded_orphans"] = lambda s, d: I.orphan_counts(warehouse(s, d).fact(), later_dimensions(s, d))
    q["later_duplicates"] = lambda s, d: I.duplicate_keys(later_dimensions(s, d))
    q["later_duplicate_shops"] = lambda s, d: I.duplicate_rows(*later_dimensions(s, d)["shop"])

    # -- statistics -----------------------------------------------------------
    q["table_row_counts"] = lambda s, d: S.table_row_counts({
        "dim_date": dim_date(s, d), **{n: star(s, d).table(t) for n, t in (
            ("dim_shop", "supplier"), ("dim_product", "part"), ("fact_sales", "lineitem"))}})
    q["distinct_by_level"] = lambda s, d: S.distinct_by_level(
        star(s, d).frame(), "region", "quarter", "productFamily")
    q["summary_statistics"] = lambda s, d: S.summary_statistics(
        star(s, d).fact(), written(dim_date(s, d), "calendar"))
    q["warehouse_status"] = lambda s, d: S.warehouse_status(
        star(s, d).fact(), written(dim_date(s, d), "calendar"))
    q["sales_summary_view"] = lambda s, d: S.sales_summary(star(s, d).frame())
    q["sales_summary_sql"] = lambda s, d: S.sales_summary_for_year(s, star(s, d).frame(), YEAR)

    # -- CUBE -----------------------------------------------------------------
    q["cube_default"] = lambda s, d: C.analysis(star(s, d))
    q["cube_year"] = lambda s, d: C.analysis(star(s, d), "region", "quarter",
                                             "productCategory", YEAR)
    q["cube_year_direct"] = lambda s, d: C.analysis(
        star(s, d), "region", "quarter", "productCategory", YEAR, via_base_cuboid=False)
    q["cube_all_years"] = lambda s, d: C.analysis(star(s, d), "region", "quarter",
                                                  "productCategory")
    q["cube_base_cuboid"] = lambda s, d: C.analysis(
        star(s, d), "region", "quarter", "productCategory", YEAR, via_base_cuboid=True)
    q["cube_city_month_category"] = lambda s, d: C.analysis(star(s, d), "city", "month",
                                                            "productCategory")
    q["cube_city_month_family"] = lambda s, d: C.analysis(star(s, d), "city", "month",
                                                          "productFamily")
    q["cube_coarsest"] = lambda s, d: C.analysis(star(s, d), "country", "year",
                                                 "productCategory")
    q["cube_finest"] = lambda s, d: C.analysis(star(s, d), "shop", "day", "article")
    q["cube_lattice"] = lambda s, d: C.analysis(star(s, d), "region", "month", "productFamily",
                                                strategy="lattice")
    q["cube_sql_views"] = sql_cube
    q["cube_level_detail"] = lambda s, d: C.cube_level(star(s, d), "Detail Level", "region",
                                                       "quarter", "productGroup")
    q["cube_level_geo_time"] = lambda s, d: C.cube_level(star(s, d), "By Geo + Time",
                                                         "region", "quarter", "productGroup")
    q["cube_level_filter"] = lambda s, d: C.cube_level(
        star(s, d), "By Time + Product", "region", "quarter", "productCategory")
    q["cube_level_counts"] = lambda s, d: C.level_counts(
        C.analysis(star(s, d), "region", "quarter", "productGroup"))
    q["cube_presentation"] = lambda s, d: C.presentation(
        C.analysis(star(s, d), "region", "quarter", "productCategory"))

    # -- GROUPING SETS ----------------------------------------------------------
    q["grouping_sets_default"] = lambda s, d: C.grouping_sets(star(s, d))
    q["grouping_sets_year"] = lambda s, d: C.grouping_sets(star(s, d), "region", "quarter",
                                                           "productCategory", YEAR)
    q["grouping_sets_finest"] = lambda s, d: C.grouping_sets(star(s, d), "shop", "day",
                                                             "article")
    q["grouping_type_counts"] = lambda s, d: C.level_counts(
        C.grouping_sets(star(s, d), "region", "quarter", "productGroup"), "aggregation_type")

    # -- cross table --------------------------------------------------------------
    for metric, name in (("total_quantity", "crosstab_quantity"),
                         ("total_revenue", "crosstab_revenue"),
                         ("transaction_count", "crosstab_transactions")):
        q[name] = (lambda m: lambda s, d: X.cross_table(
            star(s, d), "region", "quarter", "productCategory", YEAR, m))(metric)
    q["crosstab_default"] = lambda s, d: X.cross_table(star(s, d), year=YEAR)
    q["crosstab_capped"] = lambda s, d: X.cross_table_wide(
        star(s, d), list(CROSSTAB_MEMBERS), "region", "quarter", "productCategory", YEAR,
        "total_revenue")
    q["crosstab_first_members"] = lambda s, d: X.cross_table_wide(
        star(s, d), None, "region", "quarter", "productCategory", YEAR, "total_revenue", first=3)
    q["crosstab_all_years"] = lambda s, d: X.cross_table(star(s, d), "city", "month",
                                                         "productFamily")
    q["crosstab_insights"] = lambda s, d: X.insights(star(s, d), "region", "quarter",
                                                     "productGroup", YEAR, "total_quantity")
    q["crosstab_shape"] = lambda s, d: X.table_shape(star(s, d), "region", "quarter",
                                                     "productGroup", YEAR)

    # -- drill-down / roll-up -------------------------------------------------------
    start = CubePosition()
    q["drill_start"] = lambda s, d: N.navigate(star(s, d), start, YEAR)
    q["drill_down_geo"] = lambda s, d: N.navigate(star(s, d), start.drill_down("geo"), YEAR)
    q["drill_down_product"] = lambda s, d: N.navigate(
        star(s, d), start.drill_down("product"), YEAR)
    q["roll_up_time"] = lambda s, d: N.navigate(star(s, d), start.roll_up("time"), YEAR)
    q["navigator_walk"] = lambda s, d: navigator_walk(s, d)
    q["drill_summary"] = lambda s, d: N.summary(star(s, d), start, YEAR)
    q["drill_sample"] = lambda s, d: N.sample(star(s, d), start, YEAR)
    q["drill_detail"] = lambda s, d: C.presentation(N.detail(star(s, d), start, YEAR))
    return q
