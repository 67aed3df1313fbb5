"""Loads into a warehouse that exists, kept keys, counts from the load's own pass."""

import os
import random

import pytest

from fixtures import SALES_LINES, base_tables, sales_text
from kubus.operators import dims as D
from kubus.operators import facts as FT
from kubus.plans import warehouse as W
from kubus.plans.star import WarehouseStar


@pytest.fixture(scope="module")
def dims(spark):
    t = base_tables(spark)
    return (D.calendar(spark, 2019, 2020), D.shop_dimension(t["shop"], t["city"], t["region"], t["country"]),
            D.product_dimension(t["article"], t["group"], t["family"], t["category"]))


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def lines(spark, rows):
    return spark.createDataFrame(rows, "Date string, Shop string, Article string, Sold string, Revenue string")


def line(date, shop="Superstore Kiel", sold="1"):
    return (date, shop, "Brill 28 VE/RL", sold, "139,00")


def test_report_of_a_build_is_the_summary_of_its_lines(spark, dims, tmp_path):
    report = W.build_warehouse(str(tmp_path), *dims, sales_text(spark))
    expected = {}
    for _, reason in SALES_LINES:
        expected[reason] = expected.get(reason, 0) + 1
    assert report.accepted == expected.pop(None) and report.rejected == expected
    star = WarehouseStar(spark, str(tmp_path))
    summary = FT.load_summary(star.sales()).first()
    assert (summary.input_rows, summary.accepted_rows) == (report.total, report.accepted)
    assert {r["outcome"]: r["rows"] for r in report.frame(spark).collect()} == {
        "accepted": report.accepted, **expected}


def test_report_of_an_empty_build(spark, dims, tmp_path):
    report = W.build_warehouse(str(tmp_path), *dims, sales_text(spark).limit(0))
    assert (report.accepted, report.rejected) == (0, {})


def test_a_period_replaces_its_own_years_only(spark, dims, tmp_path):
    out = str(tmp_path)
    W.build_warehouse(out, *dims, sales_text(spark))
    star = WarehouseStar(spark, out)
    old = {y: sorted(map(tuple, star.fact(y).collect())) for y in (2019, 2020)}
    rejects, before = star.rejects().count(), files(out)
    batch = lines(spark, [line("01.05.2020"), line("02.05.2020"), line("01.05.2019"), line("x"),
                          line("03.05.2020", sold="")])
    for _ in range(2):
        report = W.load_period(out, batch, [2020], 1)
        assert (report.accepted, report.rejected) == (2, {W.OTHER_PERIOD: 1, "bad_date": 1, "bad_sold": 1})
        assert sorted(map(tuple, star.fact(2019).collect())) == old[2019]
        assert sorted(r.date_key for r in star.fact(2020).collect()) == [20200501, 20200502]
        assert star.rejects().count() == rejects + 3
        after = files(out)
        gone = set(before) - set(after)
        assert gone and all("sale_year=2020" in f for f in gone)
        assert all(after[f] == before[f] for f in before if f in after)
    assert {r.load_batch for r in star.rejects().collect()} == {W.FULL_LOAD, 1}
    with pytest.raises(ValueError):
        W.load_period(out, batch, [], 1)


def exchanges(spark, monkeypatch, run):
    """Shuffles of the lines in the plan that ``run`` writes classified lines with."""
    plans, write = [], W.write_classified

    def kept(classified, *args, **kw):
        sort = type(classified).sortWithinPartitions
        with monkeypatch.context() as m:
            m.setattr(type(classified), "sortWithinPartitions",
                      lambda df, *by: plans.append(sort(df, *by)) or plans[-1])
            return write(classified, *args, **kw)

    monkeypatch.setattr(W, "write_classified", kept)
    run()
    lines = plans[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    return [x for x in lines if "Exchange" in x and "Broadcast" not in x and "article_name" not in x]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_a_load_shuffles_its_lines_once(spark, dims, tmp_path, monkeypatch, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    text = sales_text(spark).repartition(16)
    W.build_warehouse(str(tmp_path), *dims, text.limit(0))
    text.write.parquet(str(tmp_path / "text"))
    text = spark.read.parquet(str(tmp_path / "text"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        found = exchanges(spark, monkeypatch, lambda: W.load_period(str(tmp_path), text, [2019, 2020], 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Without broadcasts the shops and the calendar shuffle their lookups, too.
    articles = [x for x in found if "hashpartitioning(Article" in x]
    assert len(articles) == 1 and not [x for x in found if "sale_year" in x]
    assert threshold == "-1" or found == articles


def test_append_to_a_dimension_that_exists(spark, tmp_path):
    path = str(tmp_path / "dim_date")
    for _ in range(2):
        W.append_dimension(D.calendar(spark, 2019, 2019), path, "date_key")
        assert spark.read.parquet(path).count() == 365
    for _ in range(2):
        W.append_dimension(D.calendar(spark, 2019, 2020), path, "date_key")
        table = spark.read.parquet(path)
        assert table.count() == table.select("date_key").distinct().count() == 731
    odd = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    for _ in range(2):
        W.append_dimension(odd, str(tmp_path / "odd"), "k")
        assert spark.read.parquet(str(tmp_path / "odd")).count() == 2


def test_keys_are_dense_and_stay(spark):
    r = random.Random(1)
    schema = "a string, b int"
    members = [(r.choice(["x", "y", None, "z"]), r.choice([None, *range(60)])) for _ in range(500)]
    first = D.assign_keys(spark.createDataFrame(members[:200], schema).repartition(7), None, ["a", "b"], "key")
    one = {(x.a, x.b): x.key for x in first.collect()}
    def rank(m):
        return (m[0] is not None, m[0] or "", m[1] is not None, m[1] or 0)
    assert one == {m: i for i, m in enumerate(sorted(set(members[:200]), key=rank), 1)}
    second = D.assign_keys(spark.createDataFrame(members, schema), first, ["a", "b"], "key")
    two = {(x.a, x.b): x.key for x in second.collect()}
    assert set(two) == set(members) and all(two[m] == k for m, k in one.items())
    assert sorted(two.values()) == list(range(1, len(two) + 1))
    new = sorted(set(two) - set(one), key=rank)
    assert [two[m] for m in new] == list(range(len(one) + 1, len(two) + 1))
    assert D.assign_keys(spark.createDataFrame([], schema), None, ["a", "b"], "key").count() == 0
