"""Summary statistics, table row counts, the sales-summary view, status.

Each is a distributed aggregate returning a small DataFrame; the source
system's five separate statistic queries become one pass over the fact.

Exact distinct counts are kept as bitmaps over the integer keys, 32,768 keys
to a bitmap.  Bitmaps merge by OR, so one state serves any coarser grouping.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import resolve_levels
from ..session import written

DISTINCT_KEYS = {"product": "product_key", "shop": "shop_key"}


def _key_to_date(c):
    return F.to_date(c.cast("string"), "yyyyMMdd")


def key_bitmaps(fact: DataFrame, by: list[str], measures: list[Column] = ()) -> DataFrame:
    """(by..., product_bucket, shop_bucket, product_bits, shop_bits, measures):
    one pass over the fact, in which every row sets two bits.  Rows are as many
    as the pairs of buckets met in each group."""
    buckets = [F.bitmap_bucket_number(F.col(c)).alias(f"{k}_bucket") for k, c in DISTINCT_KEYS.items()]
    bits = [F.bitmap_construct_agg(F.bitmap_bit_position(F.col(c))).alias(f"{k}_bits")
            for k, c in DISTINCT_KEYS.items()]
    return fact.groupBy(*by, *buckets).agg(*bits, *measures)


def _merged(state: DataFrame, by: list[str]) -> DataFrame:
    """(by..., kind, n): distinct keys of each kind and bucket in every group."""
    kinds = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_bucket").alias("bucket"),
                                        F.col(f"{k}_bits").alias("bits")) for k in DISTINCT_KEYS]))
    return state.select(*by, kinds).groupBy(*by, "kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))


def _distinct(kind: str) -> Column:
    count = F.sum(F.when(F.col("kind") == kind, F.col("n")))
    return F.coalesce(count, F.lit(0)).cast("long").alias(f"unique_{kind}s")


def summary_statistics(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """total_revenue, total_transactions, date range, unique products/shops.

    ``fact`` has FACT_COLUMNS.  One pass over the fact: the date range is
    taken over facts whose key is in the calendar (the source joins the
    calendar for it), flagged by a left join with the calendar, which is best
    a written table so that its size is known; without one every fact counts.
    Distinct counts come from bitmaps (integer keys; null keys do not count).
    """
    dated = F.lit(True)
    if dim_date is not None:
        cal = dim_date.select("date_key", F.lit(True).alias("_in_calendar"))
        fact = fact.join(cal, "date_key", "left")
        dated = F.col("_in_calendar").isNotNull()
    day = F.when(dated, F.col("date_key"))
    state = written(key_bitmaps(fact, [], [
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.count(F.lit(1)).alias("rows"),
        F.min(day).alias("first"), F.max(day).alias("last")]), "key-bitmaps")
    sums = state.agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.sum("rows").alias("rows"),
                     F.min("first").alias("first"), F.max("last").alias("last"))
    stats = sums.unionByName(_merged(state, []), allowMissingColumns=True).agg(
        F.max("revenue").alias("total_revenue"),
        F.coalesce(F.max("rows"), F.lit(0)).cast("long").alias("total_transactions"),
        _key_to_date(F.max("first")).alias("start_date"), _key_to_date(F.max("last")).alias("end_date"),
        *[_distinct(k) for k in DISTINCT_KEYS])
    return stats.select(
        "total_revenue", "total_transactions", "start_date", "end_date",
        F.concat(F.col("start_date").cast("string"), F.lit(" to "),
                 F.col("end_date").cast("string")).alias("date_range"),
        "unique_products", "unique_shops")


def distinct_by_level(star: DataFrame, geo: str = "region", time: str = "quarter",
                      product: str = "productGroup") -> DataFrame:
    """Distinct products and shops of every CUBE level: the three members, the
    grouping flags, unique_products, unique_shops.

    The finest groups' bitmaps are written once; each level is merged from
    them, so the fact is never expanded.  Products and shops have bitmaps of
    their own: a group's are as many as its buckets, not as the pairs of them.
    """
    cols = list(resolve_levels(geo, time, product))
    keys = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("key"))
                              for k, c in DISTINCT_KEYS.items()]))
    state = written(star.select(*cols, keys).groupBy(
        *cols, "kind", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")), "level-bitmaps")
    sets = [[c for i, c in enumerate(cols) if not drop >> i & 1] for drop in range(8)]
    flags = [f"{c}_grouping" for c in ("geo", "time", "product")]
    merged = state.groupingSets(
        [[*s, "kind", "bucket"] for s in sets], *cols, "kind", "bucket").agg(
        *[F.grouping(c).cast("int").alias(f) for c, f in zip(cols, flags)],
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*cols, *flags).agg(*[_distinct(k) for k in DISTINCT_KEYS]).select(
        *[F.col(c).cast("string").alias(f"{d}_member") for c, d in zip(cols, ("geo", "time", "product"))],
        *flags, "unique_products", "unique_shops")


def warehouse_status(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Status report: the five statistics plus an empty-warehouse flag."""
    s = summary_statistics(fact, dim_date)
    empty = F.coalesce(F.col("total_transactions"), F.lit(0)) == 0
    return s.select("*", empty.alias("is_empty"),
                    F.when(empty, F.lit("no facts loaded yet: build the warehouse first"))
                    .otherwise(F.lit("ok")).alias("status"))


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session that answers COUNT, MIN and MAX from Parquet footers; settings
    of the caller's own session stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_statistics(spark: SparkSession, paths: dict[str, str],
                      bounds: dict[str, tuple[str, ...]] | None = None,
                      partitions: dict[str, str] | None = None) -> DataFrame:
    """(table_name, row_count, column_name, least, largest) of written Parquet
    tables, read from the files' footers alone; bounds as text.

    ``bounds`` names columns (numbers, dates, booleans) whose least and largest
    value is wanted, ``partitions`` a condition on a table's partition columns.
    A table without bounds has one row with a null column.
    """
    session = _footer_session(spark)
    out = []
    for name, path in paths.items():
        table = session.read.parquet(path)
        if partitions and name in partitions:
            table = table.where(partitions[name])
        columns = (bounds or {}).get(name, ())
        found = table.agg(F.count(F.lit(1)).alias("row_count"), *[
            f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for f, n in ((F.min, "least"), (F.max, "largest"))])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"least_{i}").cast("string").alias("least"),
                         F.col(f"largest_{i}").cast("string").alias("largest"))
                for i, c in enumerate(columns)] or [F.struct(*[F.lit(None).cast("string").alias(c) for c in (
                    "column_name", "least", "largest")])]
        # Without any file left the pushed count is a sum over nothing, hence
        # null, although the plan holds it for a number (coalesce would go).
        out.append(found.select(F.lit(name).alias("table_name"),
                                F.greatest("row_count", F.lit(0).cast("long")).alias("row_count"),
                                F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, out)


def is_empty_table(spark: SparkSession, path: str, condition: str | None = None) -> bool:
    """Does a written table hold no row?  From the footers, without any statistic."""
    found = footer_statistics(spark, {"t": path}, partitions={"t": condition} if condition else None)
    return found.first()["row_count"] == 0


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named table; one aggregate each."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SUMMARY_VIEW_KEYS = ("year", "quarter", "month", "region_name", "city_name",
                     "product_category_name", "product_family_name")


def sales_summary(star: DataFrame) -> DataFrame:
    """The analytical view: 7 grouping columns, quantity, revenue, count."""
    pre = "_rows" in star.columns  # a star carrying pre-aggregated state
    return star.groupBy(*SUMMARY_VIEW_KEYS).agg(
        F.sum("_qty" if pre else "quantity_sold").cast("long").alias("total_quantity"),
        F.sum("_rev" if pre else "revenue").cast("decimal(38,2)").alias("total_revenue"),
        (F.sum("_rows") if pre else F.count(F.lit(1))).cast("long").alias("transaction_count"))


def register_sales_summary_view(star: DataFrame, name: str = "sales_summary") -> DataFrame:
    view = sales_summary(star)
    view.createOrReplaceTempView(name)
    return view


def sales_summary_for_year(spark, star: DataFrame, year: int,
                           name: str = "sales_summary") -> DataFrame:
    """The view queried through SQL with a bound parameter (no string
    building): ``SELECT * FROM sales_summary WHERE year = :year``."""
    register_sales_summary_view(star, name)
    return spark.sql(f"SELECT * FROM {name} WHERE year = :year", args={"year": year})
