"""Semicolon-separated, German-format sales text.

``read_sales_csv`` reads the real file format: header row, ``;``
separator, ISO-8859-1, columns Date, Shop, Article, Sold and Revenue, found
by the names in each file's header; every field is read as text and parsed
later, so a bad field rejects one row instead of failing the file.

``render_sales_text`` derives the same text from the TPC-H style tables
(one line per lineitem, all lines kept) so the load path can be checked at
any scale.  A fixed, deterministic share of lines is written the way real
exports go wrong (impossible dates, unknown names, thousands separators,
blank quantities) or odd-but-valid (short dates, padded numbers, zero
quantities, a third decimal).  Nothing is filtered: every line reaches the
loader and is either accepted or counted as a reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .located_csv import read_located_csv

SALES_COLUMNS = ("Date", "Shop", "Article", "Sold", "Revenue")
SALES_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SALES_COLUMNS])


def read_sales_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """SALES_COLUMNS by header name, plus ``source_file`` and ``source_line``
    (see ``located_csv`` for odd files).  A field that is missing or empty
    fails to parse later and rejects its line."""
    return read_located_csv(spark, path, SALES_COLUMNS, encoding)


def write_sales_csv(text: DataFrame, path: str, encoding: str = "ISO-8859-1",
                    columns: tuple[str, ...] = SALES_COLUMNS, mode: str = "overwrite",
                    partition_by: str | tuple[str, ...] | None = None, compression: str = "none") -> None:
    """Write sales text as the source format, with the columns in the given
    order; fields are kept verbatim (the CSV writer would otherwise trim blanks
    around ``Sold``).  A file of a ``compression`` that cannot be split is read by
    one task."""
    parts = (partition_by,) if isinstance(partition_by, str) else partition_by or ()
    writer = text.select(*columns, *parts).write.mode(mode)
    for name, value in (("header", True), ("sep", ";"), ("encoding", encoding), ("escape", '"'),
                        ("ignoreLeadingWhiteSpace", False), ("ignoreTrailingWhiteSpace", False),
                        ("compression", compression)):
        writer = writer.option(name, value)
    (writer.partitionBy(*parts) if parts else writer).csv(path)


# Moduli and residues of the line hash h = l_orderkey * 8 +
# l_linenumber that choose how a rendered line deviates.
BAD_DATE = (101, 7)          # 31.02.yyyy            -> bad_date
FUTURE_DATE = (103, 5)       # year + 40             -> date_out_of_range
SHORT_DATE = (7, 3)          # d.M.yyyy              -> accepted
UNKNOWN_SHOP = (107, 11)     # shop name + " X"      -> unknown_shop
UNKNOWN_ARTICLE = (109, 13)  # "X" + article name    -> unknown_article
EMPTY_SOLD = (113, 17)       # ""                    -> bad_sold
ZERO_SOLD = (127, 19)        # "0"                   -> accepted, no unit price
PADDED_SOLD = (11, 4)        # " q "                 -> accepted
THOUSANDS_DOT = (131, 23)    # "1." + amount         -> bad_revenue
THIRD_DECIMAL = (137, 29)    # amount + "5"          -> accepted, rounded half-up
FUTURE_YEARS = 40


def _hit(rule) -> str:
    m, r = rule
    return f"pmod(l_orderkey * 8 + l_linenumber, {m}) = {r}"


def render_sales_text(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """German sales text from a frame with ``l_orderkey, l_linenumber,
    o_orderdate, shop_name, article_name, l_quantity, l_extendedprice``, and
    the columns to ``keep``.

    One SQL projection (a single JVM round trip to build)."""
    d = "CAST(o_orderdate AS DATE)"
    qty = "CAST(CAST(l_quantity AS INT) AS STRING)"
    amount = "replace(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING), '.', ',')"
    return lines.selectExpr(
        f"""CASE WHEN {_hit(BAD_DATE)} THEN concat('31.02.', CAST(year({d}) AS STRING))
                 WHEN {_hit(FUTURE_DATE)} THEN concat(date_format({d}, 'dd.MM.'),
                                                      CAST(year({d}) + {FUTURE_YEARS} AS STRING))
                 WHEN {_hit(SHORT_DATE)} THEN date_format({d}, 'd.M.yyyy')
                 ELSE date_format({d}, 'dd.MM.yyyy') END AS Date""",
        f"CASE WHEN {_hit(UNKNOWN_SHOP)} THEN concat(shop_name, ' X') ELSE shop_name END AS Shop",
        f"""CASE WHEN {_hit(UNKNOWN_ARTICLE)} THEN concat('X', article_name)
                 ELSE article_name END AS Article""",
        f"""CASE WHEN {_hit(EMPTY_SOLD)} THEN ''
                 WHEN {_hit(ZERO_SOLD)} THEN '0'
                 WHEN {_hit(PADDED_SOLD)} THEN concat(' ', {qty}, ' ')
                 ELSE {qty} END AS Sold""",
        f"""CASE WHEN {_hit(THOUSANDS_DOT)} THEN concat('1.', {amount})
                 WHEN {_hit(THIRD_DECIMAL)} THEN concat({amount}, '5')
                 ELSE {amount} END AS Revenue""", *keep)


def tpch_sales_keys(star) -> DataFrame:
    """Every lineitem of a ``TpchStar`` with its order; the time of an order
    travels as its date, which is all the text shows."""
    return star.fact_lines(order=("o_orderkey", "CAST(o_orderdate AS DATE) AS o_orderdate"))


def with_names(star, lines: DataFrame) -> DataFrame:
    """``lines`` plus shop_name and article_name.

    Names come straight from ``part`` and ``supplier`` (plain scans, so the
    optimizer's size estimate decides broadcast vs shuffle join), the smaller
    table last, so that a shuffle by article carries no shop name.
    """
    shops = star.table("supplier").selectExpr("s_suppkey AS l_suppkey", "s_name AS shop_name")
    articles = star.dim_product().selectExpr("product_key AS l_partkey", "article_name")
    return lines.join(articles, "l_partkey").join(shops, "l_suppkey")


def tpch_sales_lines(star) -> DataFrame:
    """What ``render_sales_text`` needs of every lineitem of a ``TpchStar``."""
    return with_names(star, tpch_sales_keys(star))


def tpch_sales_text(star, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rendered sales text for every lineitem of a ``TpchStar``."""
    return render_sales_text(tpch_sales_lines(star), keep)
