"""What travels between tasks: shuffles carry keys and a line's own text."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kubus import queries as Q
from kubus.operators import cube as C
from kubus.operators import dims as D
from kubus.operators import facts as FT
from kubus.operators import stats as S
from kubus.plans.star import FrameStar
from kubus.sources.sales_text import tpch_sales_lines


@pytest.fixture
def settings(spark):
    """Session settings for one test."""
    old = {}

    def use(**values):
        for k, v in values.items():
            name = k.replace("__", ".")
            old.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, v)

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def sf_rows(spark, tmp_path):
    """A folder of small tables: 240 lines of 60 orders in three years."""
    def put(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("region", [(0, "EUROPE"), (1, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(0, "FRANCE", 0), (1, "JAPAN", 1)], "n_nationkey int, n_name string, n_regionkey int")
    put("supplier", [(i, f"Supplier#{i % 4}", i % 2) for i in range(5)],
        "s_suppkey long, s_name string, s_nationkey int")
    put("part", [(i, f"part {i % 3}", "Brand#1", f"TYPE{i % 2}", 9.5) for i in range(7)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double")
    put("orders", [(i, datetime(1996 + i % 3, 1 + i % 12, 1 + i % 28)) for i in range(60)],
        "o_orderkey long, o_orderdate timestamp_ntz")
    put("lineitem", [(i % 60, i % 7, i % 5, i // 60, float(i % 9), 10.0 + i) for i in range(240)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double")
    return str(tmp_path)


def test_lookups_shuffle_text_only(spark, sf_rows, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    st = Q.star(spark, sf_rows)
    text = Q.tpch_sales_text(st)
    plan = FT.classify_sales(text, st.dim_shop(), st.dim_product(), D.calendar(spark, 1996, 1998)) \
        ._jdf.queryExecution().optimizedPlan().toString()
    lookup = plan.index("Join LeftOuter, (Article")
    assert "AS sale_revenue" in plan[:lookup] and "AS sale_revenue" not in plan[lookup:]


def test_orders_give_their_date_to_the_joins(spark, sf_rows):
    plan = tpch_sales_lines(Q.star(spark, sf_rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "AS DATE)" in plan.upper() and plan.upper().index("AS DATE)") > plan.index("(l_orderkey")


def test_lines_are_kept_without_names(spark, sf_rows, monkeypatch):
    kept, write = [], Q.written
    monkeypatch.setattr(Q, "written", lambda df, name: kept.append(df.columns) or write(df, name))
    Q.sales_files(spark, sf_rows)
    assert kept == [[*Q.LINE_KEYS, "l_quantity", "o_orderdate"]]


def test_a_load_shuffles_numbers_of_files(spark, sf_rows, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    st = Q.star(spark, sf_rows)
    text = Q.tpch_sales_text(st, ("l_orderkey", "l_linenumber")).selectExpr(
        *Q.SALES_COLUMNS, "CASE WHEN l_orderkey % 5 <> 1 THEN concat('file ', l_orderkey % 3) END AS source_file",
        "l_orderkey * 10L + l_linenumber AS source_line")
    text = text.unionByName(text.where("source_line % 7 = 0"))  # some lines come twice
    dims = st.dim_shop(), st.dim_product(), D.calendar(spark, 1996, 1998)
    found = FT.classify_sales(text, *dims, deal=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    lookup = next(i for i, x in enumerate(plan) if "Join LeftOuter, (Article" in x)
    assert "_file#" in plan[lookup + 1]
    want = FT.classify_sales(text, *dims)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_sales_years_come_in_pieces(spark, sf_rows, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    text = Q.sales_csv(spark, sf_rows)
    files = [r[0] for r in text.select("source_file").distinct().collect()]
    assert len(files) > 3  # more than one of a year
    want = {}
    for r in sorted(Q.tpch_sales_text(Q.star(spark, sf_rows), ("o_orderdate", *Q.LINE_KEYS)).collect(),
                    key=lambda r: [r[k] for k in Q.LINE_KEYS]):
        want.setdefault(f"y={r.o_orderdate.year}", []).append(tuple(r[c] or None for c in Q.SALES_COLUMNS))
    found = {}
    for r in sorted(Q.lines_of_years(text).collect(), key=lambda r: r.source_line):
        lines = found.setdefault(r.source_file, [])
        lines.append(tuple(r[c] or None for c in Q.SALES_COLUMNS))
        assert r.source_line == len(lines) + 1
    assert found == want


def test_sales_files_are_compressed(spark, sf_rows):
    path = Q.sales_files(spark, sf_rows)
    names = [f for _, _, files in os.walk(path.removeprefix("file:")) for f in files if f.startswith("part-")]
    assert names and all(f.endswith(".csv.gz") for f in names)
    found = Q.read_sales_csv(spark, path).select(*Q.SALES_COLUMNS)
    want = Q.tpch_sales_text(Q.star(spark, sf_rows))
    assert sorted(tuple(v or "" for v in r) for r in found.collect()) \
        == sorted(tuple(v or "" for v in r) for r in want.collect())


def test_finest_cube_copies_no_base_rows(spark, sf_rows):
    for operator in (C.analysis, C.grouping_sets):
        plan = operator(Q.star(spark, sf_rows), "shop", "day", "article")._jdf.queryExecution() \
            .optimizedPlan().toString()
        assert "Expand" not in plan


@pytest.mark.parametrize("levels", [("shop", "day", "article"), ("region", "year", "productCategory")])
def test_cube_dealt_by_product_equals_expand(spark, sf_rows, levels):
    frame = Q.star(spark, sf_rows).frame()
    odd = [F.when(F.col("l") % 5 != 2, F.col(c)).alias(c) if c in ("shop_name", "article_name", "region_name",
           "product_category_name", "day", "year", "quantity_sold", "revenue") else F.col(c) for c in frame.columns]
    frame = frame.withColumn("l", F.xxhash64("revenue")).select(*odd)
    for df in (frame, frame.where("shop_key < 0")):
        for operator in (C.analysis, C.grouping_sets):
            a, b = (operator(FrameStar(df), *levels, strategy=s) for s in ("by_product", "expand"))
            assert a.schema.simpleString() == b.schema.simpleString()
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_distinct_by_level_pairs_no_buckets(spark, sf_rows):
    frame = Q.star(spark, sf_rows).frame()
    odd = [F.when(F.col("l") % 5 != 2, F.col(c)).alias(c) if c in (
        "shop_key", "product_key", "region_name", "quarter", "product_family_name") else F.col(c)
        for c in frame.columns]
    frame = frame.withColumn("l", F.xxhash64("revenue")).select(*odd)
    found = S.distinct_by_level(frame, "region", "quarter", "productFamily")
    cols = ("region_name", "quarter", "product_family_name")
    want = {}
    for r in frame.collect():
        for drop in range(8):
            flags = tuple(drop >> i & 1 for i in range(3))
            level = tuple(None if f or r[c] is None else str(r[c]) for c, f in zip(cols, flags))
            for keys, c in zip(want.setdefault((*level, *flags), (set(), set())), ("product_key", "shop_key")):
                keys.update({r[c]} - {None})
    assert {tuple(r)[:6]: tuple(r)[6:] for r in found.collect()} == {
        k: tuple(map(len, v)) for k, v in want.items()}
    assert found.count() == len(want)


def test_distinct_bitmaps_follow_buckets_not_their_pairs(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(S, "written", lambda df, name: kept.append(df) or df)
    frame = spark.range(100).selectExpr("'r' AS region_name", "1 AS quarter", "'f' AS product_family_name",
                                        "id DIV 10 * 32768 AS product_key", "id % 10 * 32768 AS shop_key")
    S.distinct_by_level(frame, "region", "quarter", "productFamily").collect()
    assert kept[0].count() == 20  # not 100
