"""Load path on hand-written lines: dims, calendar, rejects, warehouse."""

import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from fixtures import SALES_LINES, base_tables, sales_text
from kubus.operators import cube as C
from kubus.operators import dims as D
from kubus.operators import facts as FT
from kubus.operators import stats as S
from kubus.plans.star import FactStar, WarehouseStar
from kubus.plans.warehouse import build_warehouse
from kubus.sources.sales_text import read_sales_csv, write_sales_csv


def _dims(spark):
    t = base_tables(spark)
    shop = D.shop_dimension(t["shop"], t["city"], t["region"], t["country"])
    product = D.product_dimension(t["article"], t["group"], t["family"], t["category"])
    return D.calendar(spark, 2019, 2020), shop, product


def test_dimensions(spark):
    cal, shop, product = _dims(spark)
    assert cal.count() == 731
    assert cal.where("date_key = 20200229").count() == 1
    row = shop.where("shop_name = 'Superstore Kiel'").first()
    assert (row.city_name, row.region_name, row.country_name) == (
        "Kiel", "Schleswig-Holstein", "Deutschland")
    art = product.where("article_id = 9").first()
    assert art.price == Decimal("139.99")
    assert (art.product_group_name, art.product_family_name, art.product_category_name) == (
        "CD-Player", "Audio", "Heimelektronik")


def test_insert_if_absent(spark):
    cal = D.calendar(spark, 2019, 2019)
    new = D.calendar(spark, 2019, 2020)
    added = D.insert_if_absent(new.unionByName(new), cal, "date_key")
    assert added.count() == 366


def test_reject_reasons_follow_validation_order(spark):
    cal, shop, product = _dims(spark)
    classified = FT.classify_sales(sales_text(spark), shop, product, cal)
    got = {tuple(r[:5]): r.reject_reason for r in classified.collect()}
    for line, reason in SALES_LINES:
        assert got[line] == reason, line
    assert {r for r in got.values() if r} == set(FT.REASONS)
    s = FT.load_summary(classified).first()
    assert s.input_rows == len(SALES_LINES)
    assert s.accepted_rows + s.rejected_rows == s.input_rows
    fact = {r.revenue for r in FT.accepted(classified).collect()}
    assert Decimal("10.01") in fact


def test_unit_price_ignores_zero_quantity(spark):
    cal, shop, product = _dims(spark)
    fact = FT.accepted(FT.classify_sales(sales_text(spark), shop, product, cal))
    star = FactStar(fact, shop, product)
    r = C.cube_level(star, "Detail Level", "shop", "month", "article", 2019).where(
        "geo_dimension = 'Superstore Kiel' AND time_dimension = '4'").first()
    # rows 5 x 139.00 = 695, 1 x 10.01, and a zero-quantity row (no price)
    assert r.transaction_count == 3
    assert r.total_quantity == 6
    assert r.avg_unit_price == round((139.0 + 10.01) / 2, 6)


def test_csv_round_trip_and_warehouse(spark):
    cal, shop, product = _dims(spark)
    tmp = tempfile.mkdtemp(prefix="kubus-test-")
    write_sales_csv(sales_text(spark), os.path.join(tmp, "sales"))
    text = read_sales_csv(spark, os.path.join(tmp, "sales"))
    assert text.where(F.col("Shop") == "Superstore München").count() == 2
    build_warehouse(os.path.join(tmp, "wh"), cal, shop, product, text)
    wh = WarehouseStar(spark, os.path.join(tmp, "wh"))
    accepted = sum(1 for _, r in SALES_LINES if r is None)
    assert FT.load_summary(wh.sales()).first().asDict() == {
        "input_rows": len(SALES_LINES), "accepted_rows": accepted,
        "rejected_rows": len(SALES_LINES) - accepted}
    assert wh.rejects().count() == len(SALES_LINES) - accepted
    years = sorted(r.sale_year for r in wh.sales().select("sale_year").distinct().collect())
    assert years == [0, 2019, 2020]
    a = C.analysis(wh, "region", "quarter", "productCategory", 2019, ordered=True).collect()
    b = C.analysis(FactStar(FT.accepted(FT.classify_sales(text, shop, product, cal)),
                            shop, product), "region", "quarter", "productCategory",
                   2019, ordered=True).collect()
    assert a == b
    # A second build into the same folder replaces everything.
    before = sorted(map(tuple, wh.sales().collect()), key=str)
    build_warehouse(os.path.join(tmp, "wh"), cal, shop, product, text)
    assert sorted(map(tuple, wh.sales().collect()), key=str) == before
    stats = S.summary_statistics(wh.fact(), wh.dim_date()).first()
    assert stats.date_range == "2019-01-01 to 2020-11-15"
    assert stats.unique_shops == 3


def test_preaggregated_star_matches_row_star(spark):
    cal, shop, product = _dims(spark)
    fact = FT.accepted(FT.classify_sales(sales_text(spark), shop, product, cal))
    rows = FactStar(fact, shop, product)
    pre = FactStar(fact, shop, product, preaggregate=True)
    assert pre.frame().count() < rows.frame().count()  # repeated key triples merged
    for levels in (("shop", "day", "article"), ("region", "month", "productCategory")):
        assert (C.analysis(pre, *levels, ordered=True).collect()
                == C.analysis(rows, *levels, ordered=True).collect())
        assert (C.cube_level(pre, "Detail Level", *levels, ordered=True).collect()
                == C.cube_level(rows, "Detail Level", *levels, ordered=True).collect())
    assert (S.sales_summary(pre.frame()).orderBy("city_name", "month").collect()
            == S.sales_summary(rows.frame()).orderBy("city_name", "month").collect())


def test_unquoted_empty_fields_are_rejected(spark, tmp_path):
    cal, shop, product = _dims(spark)
    (tmp_path / "s.csv").write_text("Date;Shop;Article;Sold;Revenue\n"
                                    "03.04.2019;Superstore Kiel;Brill 28 VE/RL;;1,00\n"
                                    "03.04.2019;Superstore Kiel;Brill 28 VE/RL;1\n",
                                    encoding="ISO-8859-1")
    text = read_sales_csv(spark, str(tmp_path / "s.csv"))
    assert [r.Sold for r in text.collect()] == [None, "1"]
    reasons = [r.reject_reason for r in FT.classify_sales(text, shop, product, cal).collect()]
    assert sorted(reasons) == ["bad_revenue", "bad_sold"]


def test_hot_name_is_split(spark):
    cal, shop, product = _dims(spark)
    good = SALES_LINES[0][0]
    lines = spark.range(60000).selectExpr(
        f"'{good[0]}' AS Date", f"IF(id % 10 > 0, '{good[1]}', concat('none ', id)) AS Shop",
        f"'{good[2]}' AS Article", "cast(id % 9 AS string) AS Sold", f"'{good[4]}' AS Revenue")
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        classified = FT.classify_sales(lines.repartition(8), shop, product, cal)
        rows = classified.collect()
        plan = classified._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 60000 and sum(r.reject_reason is None for r in rows) == 54000
    assert "skew=true" in plan


def test_files_of_a_year_do_not_grow_with_tasks(spark, tmp_path):
    cal, shop, product = _dims(spark)
    text = sales_text(spark).repartition(16)
    build_warehouse(str(tmp_path / "wh"), cal, shop, product, text)
    for year in (0, 2019, 2020):
        files = [f for f in os.listdir(tmp_path / "wh" / "sales" / f"sale_year={year}")
                 if f.endswith(".parquet")]
        assert len(files) == 1


def test_empty_warehouse_has_a_status(spark, tmp_path):
    cal, shop, product = _dims(spark)
    build_warehouse(str(tmp_path / "wh"), cal, shop, product, sales_text(spark).limit(0))
    wh = WarehouseStar(spark, str(tmp_path / "wh"))
    status = S.warehouse_status(wh.fact(), wh.dim_date()).first()
    assert status.is_empty and status.total_transactions == 0


def test_calendar_with_far_dates_is_spread_over_tasks(spark):
    dates = spark.sql("SELECT DATE'0001-05-01' AS d UNION ALL SELECT DATE'2999-05-01'")
    cal = D.calendar_covering(dates, "d")
    assert cal.count() == cal.select("date_key").distinct().count() > 1_000_000
    assert cal.select(F.spark_partition_id()).distinct().count() > 1


def test_appended_rows_are_seen_at_once(spark, tmp_path):
    from kubus.sources.tables import read_table
    path = f"file://{tmp_path}"
    spark.range(5).write.parquet(f"{path}/t.parquet")
    assert read_table(spark, path, "t").count() == 5
    spark.range(5).write.mode("append").parquet(f"{path}/t.parquet")
    assert read_table(spark, path, "t").count() == 10


def test_orphans_are_counted_in_one_pass(spark):
    from kubus.operators import integrity as I
    fact = spark.createDataFrame([(1, 1), (1, 2), (9, 1), (None, 1)], "a int, b int")
    dims = {"x": (spark.createDataFrame([(1,), (1,)], "a int"), "a"),
            "y": (spark.createDataFrame([(1,)], "b int"), "b")}
    assert {tuple(r) for r in I.orphan_counts(fact, dims).collect()} == {("x", 2), ("y", 1)}
