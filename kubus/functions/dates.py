"""Date functions (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_german_date(text: Column) -> Column:
    """``d.M.yyyy`` text -> date; NULL for malformed or impossible dates.

    Accepts ``1.2.2019`` and ``01.02.2019``; ``31.02.2019`` gives NULL
    (``to_date`` would raise under ANSI mode, ``try_to_date`` does not).
    """
    return F.try_to_date(F.trim(text), "d.M.yyyy")


def date_key(d: Column) -> Column:
    """yyyyMMdd as int, computed arithmetically (no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7 (``weekday`` is Monday = 0)."""
    return (F.weekday(d) + 1).cast("int")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def quarter_name(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def year_range_predicate(ts: Column, year: int) -> Column:
    """``year(ts) = year`` rewritten as a range so Parquet can push it down."""
    start = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (ts >= start) & (ts < end)
