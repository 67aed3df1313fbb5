"""Sales text -> fact rows, with counted rejects.

One lazy pass: parse every field with ``try_*`` functions (never raising
under ANSI mode), look names up in the dimensions with left joins, and
give each row the *first* failing check as its reject reason, in the
source system's order:

    bad_date -> unknown_shop -> unknown_article -> bad_revenue -> bad_sold
    -> date_out_of_range  (ours: the date is valid but not in the calendar)

Accepted rows have no reason.  ``accepted + rejected = input`` always.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, parse_german_date
from ..functions.parsing import parse_decimal_comma, parse_int
from ..session import written
from ..sources.located_csv import FILE, LINE

RAW = ("Date", "Shop", "Article", "Sold", "Revenue")
LOCATION = (FILE, LINE)
REASONS = ("bad_date", "unknown_shop", "unknown_article", "bad_revenue", "bad_sold",
           "date_out_of_range")


def name_lookup(dim: DataFrame, name_col: str, key_col: str) -> DataFrame:
    """Name -> key, one row per name (duplicate names: the largest key).

    Deduplicating first keeps a repeated name from multiplying facts.  The
    aggregate is a shuffle of the dimension only.
    """
    return dim.groupBy(name_col).agg(F.max(key_col).alias(key_col))


def file_numbers(lines: DataFrame) -> DataFrame:
    """(file path, number) of the files that ``lines`` name: a written table."""
    files = lines.where(F.col(FILE).isNotNull()).select(F.col(FILE).alias("_path")).distinct()
    return written(files.withColumn("_number", F.monotonically_increasing_id()), "file-numbers")


def numbered_files(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """``lines`` with their file's number; a file without one keeps its path."""
    found = lines.join(numbers, lines[FILE] == numbers["_path"], "left")
    return found.withColumn(FILE, F.when(F.col("_number").isNull(), F.col(FILE))) \
        .select(*lines.columns, F.col("_number").alias("_file"))


def named_files(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """``lines`` with their file's path again, in place of its number."""
    found = lines.join(numbers, lines["_file"] == numbers["_number"], "left")
    return found.withColumn(FILE, F.coalesce(FILE, "_path")).drop("_file", "_path", "_number")


def classify_sales(text: DataFrame, dim_shop: DataFrame, dim_product: DataFrame,
                   dim_date: DataFrame, deal: bool = False) -> DataFrame:
    """Raw columns, where they stand in their file if the text tells, parsed
    columns and ``reject_reason`` (NULL when accepted).

    Parsed columns: sale_date, sale_date_key, sold_quantity, sale_revenue,
    shop_key, product_key (raw and parsed names differ beyond case, since
    column names are case-insensitive).

    The lookups are left joins with written name and key tables.  While such
    a table is below the optimizer's broadcast threshold the lines are not
    shuffled at all; beyond it both join sides are plain shuffles, in which
    AQE splits a hot shop, article or day.  The largest table comes first and
    fields are parsed after the name lookups, so that such a shuffle carries a
    line's own text and nothing that can be computed from it.

    ``deal`` always shuffles the lines to their article, for a caller that
    wants them in partitions that follow their size and not the tasks that
    read them: the lookup's shuffle is then the only one they need.  A
    partition's names are hashed, so its lines are not sorted by article.
    """
    shops = written(name_lookup(dim_shop, "shop_name", "shop_key"), "shop-names")
    articles = written(name_lookup(dim_product, "article_name", "product_key"), "article-names")
    calendar = written(dim_date.select(F.col("date_key").alias("_cal_key")), "calendar-keys")
    if deal:
        articles = articles.hint("shuffle_hash")
    sale_date = parse_german_date(F.col("Date"))
    raw = [*RAW, *(c for c in LOCATION if c in text.columns)]
    lines = text.select(*raw)
    numbers = file_numbers(lines) if deal and FILE in raw else None
    if numbers is not None:
        lines = numbered_files(lines, numbers)
    named = (lines
             .join(articles, lines["Article"] == articles["article_name"], "left")
             .join(shops, lines["Shop"] == shops["shop_name"], "left"))
    if numbers is not None:
        named = named_files(named, numbers)
    parsed = named.select(
        *raw, "shop_key", "product_key",
        sale_date.alias("sale_date"),
        date_key(sale_date).alias("sale_date_key"),
        parse_int(F.col("Sold")).alias("sold_quantity"),
        parse_decimal_comma(F.col("Revenue")).alias("sale_revenue"))
    joined = parsed.join(calendar, F.col("sale_date_key") == F.col("_cal_key"), "left")
    reason = (F.when(F.col("sale_date").isNull(), F.lit("bad_date"))
              .when(F.col("shop_key").isNull(), F.lit("unknown_shop"))
              .when(F.col("product_key").isNull(), F.lit("unknown_article"))
              .when(F.col("sale_revenue").isNull(), F.lit("bad_revenue"))
              .when(F.col("sold_quantity").isNull(), F.lit("bad_sold"))
              .when(F.col("_cal_key").isNull(), F.lit("date_out_of_range")))
    return joined.select(*raw, "sale_date", "sale_date_key", "shop_key", "product_key",
                         "sold_quantity", "sale_revenue", reason.alias("reject_reason"))


def accepted(classified: DataFrame) -> DataFrame:
    """Fact rows: date_key, shop_key, product_key, quantity_sold, revenue."""
    return classified.where(F.col("reject_reason").isNull()).select(
        F.col("sale_date_key").alias("date_key"), "shop_key", "product_key",
        F.col("sold_quantity").alias("quantity_sold"), F.col("sale_revenue").alias("revenue"))


def rejected(classified: DataFrame, *more: str) -> DataFrame:
    """Rejected lines as they stand in the file, why, and where if known."""
    return classified.where(F.col("reject_reason").isNotNull()).select(
        *RAW, "reject_reason", *(c for c in LOCATION if c in classified.columns), *more)


def reject_counts(classified: DataFrame) -> DataFrame:
    return rejected(classified).groupBy("reject_reason").agg(
        F.count(F.lit(1)).cast("long").alias("rows"))


def load_summary(classified: DataFrame) -> DataFrame:
    """One row: input, accepted and rejected line counts (one pass)."""
    ok = F.col("reject_reason").isNull()
    return classified.agg(
        F.count(F.lit(1)).cast("long").alias("input_rows"),
        F.count(F.when(ok, F.lit(1))).cast("long").alias("accepted_rows"),
        F.count(F.when(~ok, F.lit(1))).cast("long").alias("rejected_rows"))
