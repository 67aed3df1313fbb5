"""Member and aggregation-level labels, derived from GROUPING flags.

Labels are decided from the flags, never from NULL tests, so a genuine
NULL member is not mistaken for a subtotal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL_LABEL = "[Total]"

# Level labels keyed by (geo, time, product) GROUPING flags.
CUBE_LEVEL_LABELS = {
    (0, 0, 0): "Detail Level",
    (0, 0, 1): "By Geo + Time",
    (0, 1, 0): "By Geo + Product",
    (1, 0, 0): "By Time + Product",
    (0, 1, 1): "By Geography Only",
    (1, 0, 1): "By Time Only",
    (1, 1, 0): "By Product Only",
    (1, 1, 1): "Grand Total",
}
CUBE_LEVEL_FALLBACK = "Unknown Level"

GROUPING_SET_LABELS = {
    (0, 0, 0): "Detail",
    (0, 0, 1): "Row Subtotal",
    (0, 1, 0): "Column Subtotal",
    (0, 1, 1): "Geographic Total",
    (1, 1, 1): "Grand Total",
}
GROUPING_SET_FALLBACK = "Other"


def member_label(member: str, grouping_flag: str) -> Column:
    """Member as text, or ``[Total]`` where the level was aggregated away.

    Built as one SQL expression (one JVM round trip instead of several).
    """
    return F.expr(f"CASE WHEN `{grouping_flag}` = 1 THEN '{TOTAL_LABEL}' "
                  f"ELSE CAST(`{member}` AS STRING) END")


def level_label(g: str, t: str, p: str, labels: dict, fallback: str) -> Column:
    """CASE over the three GROUPING flag columns ``g``, ``t``, ``p``."""
    whens = " ".join(
        f"WHEN `{g}` = {a} AND `{t}` = {b} AND `{p}` = {c} THEN '{text}'"
        for (a, b, c), text in labels.items())
    return F.expr(f"CASE {whens} ELSE '{fallback}' END")
