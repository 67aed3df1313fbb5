"""Property-based checks of the CUBE machinery on small random stars."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kubus.model import STAR_COLUMNS
from kubus.operators import cube as C
from kubus.plans.star import FrameStar

SCHEMA = ("date_key int, full_date date, year int, quarter int, month int, day int, "
          "shop_key bigint, shop_name string, city_name string, region_name string, "
          "country_name string, product_key bigint, article_name string, "
          "product_group_name string, product_family_name string, "
          "product_category_name string, quantity_sold int, revenue decimal(10,2)")

row = st.tuples(
    st.dates(dt.date(2019, 1, 1), dt.date(2020, 12, 31)),
    st.sampled_from(["North", "South", None]),
    st.sampled_from(["A", "B", "C"]),
    st.integers(min_value=-2, max_value=5),
    st.decimals(min_value=Decimal("-50"), max_value=Decimal("999"), places=2,
                allow_nan=False, allow_infinity=False))


def _frame(spark, rows):
    out = []
    for i, (d, region, cat, qty, rev) in enumerate(rows):
        out.append((d.year * 10000 + d.month * 100 + d.day, d, d.year, (d.month - 1) // 3 + 1,
                    d.month, d.day, i % 3, f"s{i % 3}", f"c{i % 2}", region, "WORLD",
                    i % 4, f"a{i % 4}", f"g{i % 4}", f"f{i % 2}", cat, qty, rev))
    return spark.createDataFrame(out, SCHEMA).select(*STAR_COLUMNS)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_strategies_agree_and_levels_balance(spark, rows):
    star = FrameStar(_frame(spark, rows))
    base = C.analysis(star, "region", "month", "productCategory",
                      ordered=True).collect()
    direct = C.analysis(star, "region", "month", "productCategory",
                        via_base_cuboid=False, ordered=True).collect()
    lattice = C.analysis(star, "region", "month", "productCategory",
                         strategy="lattice", ordered=True).collect()
    assert base == direct == lattice
    totals = {}
    for r in base:
        t = totals.setdefault(r.aggregation_level, [0, Decimal(0), 0])
        t[0] += r.total_quantity
        t[1] += r.total_revenue
        t[2] += r.transaction_count
    assert len({tuple(v) for v in totals.values()}) == 1
    grand = [r for r in base if r.aggregation_level == "Grand Total"][0]
    prices = [rev / q for (_, _, _, q, rev) in rows if q != 0]
    if prices:
        assert abs(grand.avg_unit_price - float(sum(prices) / len(prices))) < 1e-6
    else:
        assert grand.avg_unit_price is None
