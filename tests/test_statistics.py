"""Bitmap counts, footer statistics, first members of a cross table, integrity rows."""

import random

from pyspark.sql import functions as F

from kubus.operators import crosstab as X
from kubus.operators import integrity as I
from kubus.operators import stats as S
from kubus.plans.star import FrameStar, TpchStar


def plan(df):
    return df._jdf.queryExecution().toString()


def test_bitmaps_count_any_integer_keys(spark):
    r = random.Random(1)
    keys = [None, 0, 1, -1, 32767, 32768, -32768, 2 ** 40, -2 ** 40, *range(5)]
    rows = [(20190101 + i % 28, r.choice(keys), r.choice(keys), 1, None) for i in range(400)]
    fact = spark.createDataFrame(rows, "date_key int, product_key long, shop_key long, quantity_sold int, "
                                       "revenue decimal(10,2)").repartition(5)
    stats = S.summary_statistics(fact)
    found = stats.first()
    assert found.unique_products == len({x[1] for x in rows} - {None})
    assert found.unique_shops == len({x[2] for x in rows} - {None})
    assert found.total_transactions == 400 and found.date_range == "2019-01-01 to 2019-01-28"
    empty = S.summary_statistics(fact.limit(0)).first()
    assert tuple(empty) == (None, 0, None, None, None, 0, 0)


def test_statistics_do_not_expand_the_fact(spark, sf_small):
    star = TpchStar(spark, sf_small)
    state = S.key_bitmaps(star.fact(), [])
    assert "Expand" not in plan(state) and "Expand" not in plan(S.summary_statistics(star.fact()))


def test_footers_answer_counts_and_bounds(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "cast(id % 3 AS int) AS p", "date_add(DATE'2019-01-01', cast(id AS int)) AS d") \
        .write.partitionBy("p").parquet(path)
    found = S.footer_statistics(spark, {"t": path, "q": path}, {"t": ("id", "d")}, {"t": "p <> 0"})
    assert {tuple(r) for r in found.collect()} == {
        ("t", 666, "id", "1", "998"), ("t", 666, "d", "2019-01-02", "2021-09-25"), ("q", 1000, None, None, None)}
    text = plan(found)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(d), MAX(d)]" in text and text.count("BatchScan") >= 2
    assert not S.is_empty_table(spark, path) and S.is_empty_table(spark, path, "p = 7")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_first_members_and_the_rest(spark):
    rows = [("r", 2019, 1, m, q) for m, q in [("b", 1), ("a", 2), (None, 4), ("c", 8), ("a", 16), ("B", 32)]]
    frame = spark.createDataFrame(rows, "region_name string, year int, quarter int, product_category_name string, "
                                        "quantity_sold int").withColumn("revenue", F.lit(1).cast("decimal(10,2)"))
    star = FrameStar(frame)

    def wide(first):
        table = X.cross_table_wide(star, None, "region", "quarter", "productCategory", first=first)
        return table.columns[2:], table.where("geo_region = 'total'").first()[2:]

    assert wide(2) == (["B", "a", "...", "TOTAL"], (32, 18, 13, 63))
    assert wide(5) == (["B", "a", "b", "c", "NULL", "TOTAL"], (32, 18, 1, 8, 4, 63))
    assert wide(8) == wide(5)
    assert wide(0) == (["...", "TOTAL"], (63, 63))


def test_offending_rows_are_named(spark):
    fact = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (9, 7, "z"), (None, 1, "n")], "a int, b int, t string")
    dims = {"x": (spark.createDataFrame([(1,), (1,), (None,)], "a int"), "a"),
            "y": (spark.createDataFrame([(1,), (2,)], "b int"), "b")}
    assert {tuple(r) for r in I.orphan_rows(fact, dims).collect()} == {
        (9, 7, "z", "x,y"), (None, 1, "n", "x")}
    assert {tuple(r) for r in I.orphan_counts(fact, dims).collect()} == {("x", 2), ("y", 1)}
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "a int, t string")
    assert {tuple(r) for r in I.duplicate_rows(twice, "a").collect()} == {
        (1, "a", 2), (1, "b", 2), (None, "d", 2), (None, "e", 2)}
