"""Dimension hierarchies and the drill/roll-up position.

A hierarchy is an ordered list of (level, column) pairs, coarse to fine.
A level is ONE column of the star, not a path: grouping by ``month`` uses
the month number only, so January of different years merges, exactly as
the source system does.  Everything here is driver-side metadata; no
Spark job is started.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Hierarchy:
    name: str
    levels: tuple[tuple[str, str], ...]

    @property
    def level_names(self) -> list[str]:
        return [lvl for lvl, _ in self.levels]

    def column(self, level: str) -> str:
        for lvl, col in self.levels:
            if lvl == level:
                return col
        raise ValueError(f"{self.name} has no level {level!r}; its levels are {self.level_names}")

    def index(self, level: str) -> int:
        self.column(level)
        return self.level_names.index(level)

    def __len__(self) -> int:
        return len(self.levels)


# Level names of the three hierarchies, coarse -> fine, as the
# analysis API accepts them, mapped to star-frame column names.
GEO = Hierarchy("geo", (
    ("country", "country_name"),
    ("region", "region_name"),
    ("city", "city_name"),
    ("shop", "shop_name"),
))
TIME = Hierarchy("time", (
    ("year", "year"),
    ("quarter", "quarter"),
    ("month", "month"),
    ("day", "day"),
))
PRODUCT = Hierarchy("product", (
    ("productCategory", "product_category_name"),
    ("productFamily", "product_family_name"),
    ("productGroup", "product_group_name"),
    ("article", "article_name"),
))

HIERARCHIES = {"geo": GEO, "time": TIME, "product": PRODUCT}

# Columns every star frame carries (see plans/star.py).
STAR_COLUMNS = (
    "date_key", "full_date", "year", "quarter", "month", "day",
    "shop_key", "shop_name", "city_name", "region_name", "country_name",
    "product_key", "article_name", "product_group_name",
    "product_family_name", "product_category_name",
    "quantity_sold", "revenue",
)

METRICS = ("total_quantity", "total_revenue", "transaction_count")


def resolve_levels(geo: str, time: str, product: str) -> tuple[str, str, str]:
    """Validate the three level names and return their star columns."""
    return GEO.column(geo), TIME.column(time), PRODUCT.column(product)


def validate_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {list(METRICS)}")
    return metric


@dataclass(frozen=True)
class CubePosition:
    """Current level index per hierarchy; immutable, every move returns a new one.

    The default start is region x quarter x productGroup (indices 1, 1, 2).
    """

    geo: int = 1
    time: int = 1
    product: int = 2

    def __post_init__(self) -> None:
        for dim in HIERARCHIES:
            idx = getattr(self, dim)
            if not 0 <= idx < len(HIERARCHIES[dim]):
                raise ValueError(f"{dim} index {idx} outside hierarchy")

    def level(self, dim: str) -> str:
        return HIERARCHIES[dim].level_names[getattr(self, dim)]

    @property
    def levels(self) -> tuple[str, str, str]:
        return self.level("geo"), self.level("time"), self.level("product")

    def can_drill_down(self, dim: str) -> bool:
        return getattr(self, dim) < len(HIERARCHIES[dim]) - 1

    def can_roll_up(self, dim: str) -> bool:
        return getattr(self, dim) > 0

    def drill_down(self, dim: str, clamp: bool = False) -> "CubePosition":
        if not self.can_drill_down(dim):
            if clamp:
                return self
            raise ValueError(
                f"{dim} cannot go below {self.level(dim)}")
        return replace(self, **{dim: getattr(self, dim) + 1})

    def roll_up(self, dim: str, clamp: bool = False) -> "CubePosition":
        if not self.can_roll_up(dim):
            if clamp:
                return self
            raise ValueError(
                f"{dim} cannot go above {self.level(dim)}")
        return replace(self, **{dim: getattr(self, dim) - 1})

    def report(self) -> dict[str, str]:
        """Level name and 'Level k/4' for each hierarchy."""
        return {
            dim: f"{self.level(dim)} (Level {getattr(self, dim) + 1}/{len(h)})"
            for dim, h in HIERARCHIES.items()
        }
