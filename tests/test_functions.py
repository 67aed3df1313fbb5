import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from kubus.functions.dates import date_key, iso_weekday, month_name, parse_german_date, quarter_name
from kubus.functions.parsing import format_decimal_comma, parse_decimal_comma, parse_int, to_price


def test_text_parsing(spark):
    df = spark.createDataFrame(
        [("1.2.2019", "498,00", " 5 "), ("31.02.2019", "10,005", ""),
         ("01.12.2020", "1.234,56", "x"), ("xx", "0,5", "0"), ("1.1.2020", "5", "5.0"),
         ("1.1.2020", "5", "-3")],
        "d string, r string, s string")
    rows = df.select(parse_german_date(F.col("d")).alias("d"),
                     parse_decimal_comma(F.col("r")).alias("r"),
                     parse_int(F.col("s")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [
        (dt.date(2019, 2, 1), Decimal("498.00"), 5),
        (None, Decimal("10.01"), None),
        (dt.date(2020, 12, 1), None, None),
        (None, Decimal("0.50"), 0),
        (dt.date(2020, 1, 1), Decimal("5.00"), None),
        (dt.date(2020, 1, 1), Decimal("5.00"), -3)]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2019, 1, 6),), (dt.date(2020, 2, 29),)], "d date")
    rows = df.select(date_key(F.col("d")), iso_weekday(F.col("d")), month_name(F.col("d")),
                     quarter_name(F.col("d"))).collect()
    assert [tuple(r) for r in rows] == [(20190106, 7, "January", "Q1"),
                                        (20200229, 6, "February", "Q1")]


def test_price_and_format(spark):
    df = spark.createDataFrame([(469.989990234375,)], "p double")
    r = df.select(to_price(F.col("p")).alias("p")).first()
    assert r.p == Decimal("469.99")
    r = df.select(format_decimal_comma(to_price(F.col("p"))).alias("t")).first()
    assert r.t == "469,99"
