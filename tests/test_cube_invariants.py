"""Invariants of the OLAP results on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from kubus.operators import crosstab as X
from kubus.operators import cube as C
from kubus.plans.star import FrameStar, TpchStar


def _levels(df, col="aggregation_level"):
    return {r[0]: r[1:] for r in df.groupBy(col).agg(
        F.sum("total_quantity"), F.sum("total_revenue"), F.sum("transaction_count")).collect()}


def test_every_cube_level_sums_to_the_same_totals(spark, sf_small):
    res = C.analysis(TpchStar(spark, sf_small), "region", "quarter", "productCategory", 1997)
    levels = _levels(res)
    assert len(levels) == 8
    assert len(set(levels.values())) == 1
    detail = res.where("aggregation_level = 'Detail Level'")
    g, t, p = (detail.select(c).distinct().count()
               for c in ("geo_dimension", "time_dimension", "product_dimension"))
    assert res.count() <= (g + 1) * (t + 1) * (p + 1)
    gs = C.grouping_sets(TpchStar(spark, sf_small), "region", "quarter", "productCategory", 1997)
    assert gs.count() <= g * t * p + g * t + g * p + g + 1


def test_cube_row_order_and_text_months(spark, sf_small):
    rows = C.analysis(TpchStar(spark, sf_small), "country", "month", "productCategory",
                      1997, ordered=True).collect()
    flags = [(r.geo_grouping, r.time_grouping, r.product_grouping) for r in rows]
    assert flags == sorted(flags)
    months = [r.time_dimension for r in rows if r.aggregation_level == "By Time Only"]
    assert months == sorted(months) and months[:3] == ["1", "10", "11"]
    assert rows[-1].aggregation_level == "Grand Total"
    assert rows[-1].geo_dimension == "[Total]"


def test_base_cuboid_equals_direct(spark, sf_small):
    st = TpchStar(spark, sf_small)
    a = C.analysis(st, "city", "month", "productFamily", None, ordered=True).collect()
    b = C.analysis(st, "city", "month", "productFamily", None, via_base_cuboid=False,
                   ordered=True).collect()
    assert a == b


def test_lattice_strategy_equals_expand(spark, sf_small):
    st = TpchStar(spark, sf_small)
    for kw in ({"ordered": True}, {"year": 1997, "ordered": True}):
        a = C.analysis(st, "city", "quarter", "productFamily", **kw).collect()
        b = C.analysis(st, "city", "quarter", "productFamily", strategy="lattice",
                       **kw).collect()
        assert a == b
    a = C.grouping_sets(st, "region", "month", "article", 1998, ordered=True).collect()
    b = C.grouping_sets(st, "region", "month", "article", 1998, strategy="lattice",
                        ordered=True).collect()
    assert a == b


def test_frame_star_equals_source(spark, sf_small):
    st = TpchStar(spark, sf_small)
    a = C.analysis(FrameStar(st.frame()), "region", "year", "productCategory", 1998,
                   ordered=True).collect()
    b = C.analysis(st, "region", "year", "productCategory", 1998,
                   ordered=True).collect()
    assert a == b


def test_empty_selection(spark, sf_small):
    st = TpchStar(spark, sf_small)
    assert C.analysis(st, year=2019).count() == 0
    assert C.cube_level(st, "Grand Total", year=2019).count() == 0


def test_grouping_sets_are_subset_of_cube(spark, sf_small):
    st = TpchStar(spark, sf_small)
    cols = ["geo_dimension", "time_dimension", "product_dimension", "total_quantity",
            "total_revenue", "transaction_count", "avg_unit_price"]
    gs = C.grouping_sets(st, "region", "quarter", "productCategory", 1997).select(cols)
    cube = C.analysis(st, "region", "quarter", "productCategory", 1997).select(cols)
    assert gs.subtract(cube).count() == 0
    counts = {r[0]: r[1] for r in C.level_counts(
        C.grouping_sets(st, "region", "quarter", "productCategory", 1997),
        "aggregation_type").collect()}
    assert counts["Grand Total"] == 1 and counts["Geographic Total"] == 5


def test_single_level_matches_filtered_cube(spark, sf_small):
    st = TpchStar(spark, sf_small)
    for level in ("Detail Level", "By Time Only", "Grand Total"):
        a = C.cube_level(st, level, "region", "quarter", "productGroup", 1997,
                         ordered=True).collect()
        b = C.filter_level(C.analysis(st, "region", "quarter", "productGroup", 1997, ordered=True),
                           level).collect()
        assert a == b, level


def _odd_star(spark):
    """A star with NULL members and members that differ only in case, hold a
    backtick or read like a total."""
    rows = [(g, q, p, n) for n, (g, q, p) in enumerate([
        ("A", 1, "x"), ("A", 1, "X"), ("A", 2, "a`b"), ("B", 1, "TOTAL"), ("B", 2, None),
        (None, 1, "x"), ("A", None, "x"), ("total", 1, "geo_region"), ("B", 2, None)], 1)]
    frame = spark.createDataFrame(rows, "region_name string, quarter int, "
                                        "product_group_name string, quantity_sold int")
    return FrameStar(frame.withColumn("revenue", F.lit(2).cast("decimal(10,2)")))


def test_cross_table_keeps_every_member(spark):
    rows = X.cross_table(_odd_star(spark)).collect()
    cells = [r for r in rows if not (r.geo_total or r.time_total or r.product_total)]
    grand = [r for r in rows if r.geo_total and r.time_total and r.product_total]
    assert sum(r.value for r in cells) == grand[0].value == sum(range(1, 10))
    assert len(grand) == 1 and (grand[0].geo_region, grand[0].time_period) == ("total", "")
    assert {r.product_member for r in cells} == {"x", "X", "a`b", "TOTAL", None, "geo_region"}
    null_column = [r.value for r in rows if r.geo_total and not r.product_total
                   and r.product_member is None]
    assert null_column == [5 + 9]
    assert {r.time_period for r in cells} == {"quarter 1", "quarter 2", None}


def test_cross_table_totals_equal_the_cube(spark, sf_small):
    st = TpchStar(spark, sf_small)
    rows = X.cross_table(st, "region", "quarter", "productCategory", 1997).collect()
    cube = C.analysis(st, "region", "quarter", "productCategory", 1997).collect()
    flags = lambda r: (r.geo_total, r.time_total, r.product_total)
    sums = {}
    for r in rows:
        sums[flags(r)] = sums.get(flags(r), 0) + r.value
    assert len(sums) == 6 and len(set(sums.values())) == 1
    assert sums[1, 1, 1] == [r.total_quantity for r in cube
                             if r.aggregation_level == "Grand Total"][0]
    assert {r.time_period for r in rows if flags(r) == (0, 0, 0)} == {
        f"quarter {q}, 1997" for q in range(1, 5)}


def test_wide_cross_table_has_the_named_columns(spark):
    members = ["x", "X", "a`b", "TOTAL", None, "geo_region"]
    table = X.cross_table_wide(_odd_star(spark), members)
    assert table.columns == ["geo_region", "time_period", "x", "X", "a`b", "TOTAL", "NULL",
                             "geo_region", "TOTAL"]
    rows = [tuple(r) for r in table.collect()]
    assert all(sum(r[2:-1]) == r[-1] for r in rows)
    assert ("total", "", 1 + 6 + 7, 2, 3, 4, 14, 8, 45) in rows
    few = [tuple(r) for r in X.cross_table_wide(_odd_star(spark), ["x"]).collect()]
    assert ("total", "", 14, 45) in few


def test_insights_and_shape(spark, sf_small):
    st = TpchStar(spark, sf_small)
    ins = X.insights(st, "region", "quarter", "productCategory", 1997).collect()
    assert [r.insight for r in ins] == ["geographic_total"] * 3 + ["grand_total"]
    shape = X.table_shape(st, "region", "quarter", "productCategory", 1997).first()
    assert shape.product_members == 6 and shape.table_columns == 7


def test_navigator_reuses_its_cuboid(spark, sf_small):
    from kubus.model import CubePosition
    from kubus.operators import navigate as N
    st = TpchStar(spark, sf_small)
    nav = N.Navigator(st, 1997)
    first = nav.analysis(ordered=True).collect()
    assert first == N.navigate(st, CubePosition(), 1997, ordered=True).collect()
    cuboid = nav._cuboid
    down = C.order_levels(nav.drill_down("geo")).collect()
    assert nav._cuboid is cuboid  # served by the look-ahead cuboid
    assert down == N.navigate(st, CubePosition().drill_down("geo"), 1997,
                              ordered=True).collect()
    up = C.order_levels(nav.roll_up("time")).collect()
    assert up == N.navigate(st, CubePosition(2, 0, 2), 1997, ordered=True).collect()
    plain = N.Navigator(st, 1997, keep_cuboid=False)
    assert plain.analysis(ordered=True).collect() == first and plain._cuboid is None


def test_months_sort_by_number_on_request(spark, sf_small):
    rows = C.order_levels(C.cube_level(TpchStar(spark, sf_small), "By Time Only", time="month"),
                          numeric_time_order=True).collect()
    assert [r.time_dimension for r in rows] == [str(m) for m in range(1, 13)]


def test_navigation_summary(spark, sf_small):
    from kubus.model import CubePosition
    from kubus.operators import navigate as N
    s = N.summary(TpchStar(spark, sf_small), CubePosition(), 1997).first()
    assert (s.geo_level, s.time_level, s.product_level) == ("region", "quarter", "productGroup")
