"""Text-to-number parsing for the German-format sales text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_decimal_comma(text: Column, precision: int = 10, scale: int = 2) -> Column:
    """``498,00`` -> 498.00 as decimal; NULL when not a number.

    Only the comma is replaced, so a thousands dot (``1.234,56``) becomes
    ``1.234.56`` and is rejected, as in the source system.  Extra digits
    round half-up (``10,005`` -> 10.01).
    """
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast(
        f"decimal({precision},{scale})")


INT_PATTERN = r"^[+-]?[0-9]+$"


def parse_int(text: Column) -> Column:
    """Integer with surrounding blanks allowed; NULL for empty or junk.

    Only an optional sign and digits are accepted (``5.0`` is rejected, as
    a plain integer parse would), whatever the engine's cast leniency.
    """
    t = F.trim(text)
    return F.when(t.rlike(INT_PATTERN), t.try_cast("int"))


def to_price(value: Column) -> Column:
    """Double price narrowed to DECIMAL(10,2) (469.98999 -> 469.99)."""
    return value.cast("decimal(10,2)")


# Unit prices are averaged in exact integer arithmetic so the result does
# not depend on summation order (partial aggregates, base cuboid, engine):
# each row's revenue/quantity is rounded half away from zero to 1e-8, the
# mean of those is rounded the same way to 1e-6 and only then turned into
# a double (one correctly rounded division, identical everywhere).
PRICE_SCALE_ROW = 10 ** 8
PRICE_SCALE_OUT = 10 ** 6


def unit_price_e8(revenue: str, quantity: str) -> Column:
    """revenue / quantity in units of 1e-8 as bigint; NULL for zero quantity.

    ``revenue`` is a DECIMAL(10,2) column (so cents * 1e8 fits a bigint).
    """
    cents = f"cast({revenue} * 100 as bigint)"
    # cents * 1e6 = revenue in units of 1e-8
    mag = (f"((abs({cents}) * {PRICE_SCALE_ROW // 100} + abs({quantity}) div 2) "
           f"div abs({quantity}))")
    return F.expr(
        f"CASE WHEN {quantity} = 0 OR {quantity} IS NULL OR {revenue} IS NULL THEN NULL "
        f"WHEN ({cents} < 0) <> ({quantity} < 0) THEN -{mag} ELSE {mag} END")


def mean_price(sum_e8: str, count: str) -> Column:
    """Mean of 1e-8 unit prices as a double rounded half away from zero to
    6 decimals; ``sum_e8`` is a decimal(38,0) sum, ``count`` a bigint."""
    step = PRICE_SCALE_ROW // PRICE_SCALE_OUT
    units = f"((abs({sum_e8}) + {step // 2} * {count}) div ({step} * {count}))"
    return F.expr(
        f"CASE WHEN {count} IS NULL OR {count} = 0 THEN NULL "
        f"ELSE cast(CASE WHEN {sum_e8} < 0 THEN -{units} ELSE {units} END AS double) "
        f"/ {float(PRICE_SCALE_OUT)}D END")


def format_decimal_comma(value: Column) -> Column:
    """Decimal -> German text with comma and exactly two decimals."""
    return F.replace(value.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
