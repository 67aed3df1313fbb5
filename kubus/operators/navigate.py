"""Drill-down / roll-up navigation over the three hierarchies.

A ``CubePosition`` (model.py) is an immutable triple of level indices;
``drill_down`` / ``roll_up`` return new positions and refuse to move past
either end.  The functions below turn a position into DataFrames.

``Navigator`` keeps one materialised cuboid for a navigation session: the
star grouped by every level from the top of each hierarchy down to the
deepest level visited so far, with mergeable state.  Each later step is a
CUBE over that cuboid instead of a new pass over the fact; it is rebuilt
(one pass) only when a step goes deeper than the cuboid, which is built
``lookahead`` levels below the current position.  Keeping the
coarser columns (year next to month, region next to city) is what makes
every roll-up additive, since a level is a single column.  The cuboid is
checkpointed into the shared checkpoint folder.  A caller whose cuboid would
not be much smaller than the fact sets ``keep_cuboid=False``: every step then
reads the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import GEO, PRODUCT, TIME, CubePosition
from ..plans.star import FrameStar
from ..session import materialize
from . import cube as C


def navigate(source, position: CubePosition, year: int | None = 2019, **kw) -> DataFrame:
    """Full CUBE at the position's levels."""
    geo, time, product = position.levels
    return C.analysis(source, geo, time, product, year, **kw)


def detail(source, position: CubePosition, year: int | None = 2019) -> DataFrame:
    """Detail Level rows at the position (only that grouping set is computed)."""
    geo, time, product = position.levels
    return C.cube_level(source, "Detail Level", geo, time, product, year)


def summary(source, position: CubePosition, year: int | None = 2019) -> DataFrame:
    """One row: the three level names, detail record count and revenue."""
    geo, time, product = position.levels
    s = C.detail_summary(detail(source, position, year))
    return s.select(F.lit(geo).alias("geo_level"), F.lit(time).alias("time_level"),
                    F.lit(product).alias("product_level"), "record_count", "total_revenue")


def sample(source, position: CubePosition, year: int | None = 2019, n: int = 10) -> DataFrame:
    """First ``n`` detail rows in level order (geo, time, product, revenue)."""
    return C.detail_sample(detail(source, position, year), n)


class Navigator:
    """Stateful navigation session with a reusable cuboid (see module doc)."""

    def __init__(self, source, year: int | None = 2019,
                 position: CubePosition | None = None, lookahead: int = 1,
                 keep_cuboid: bool = True):
        self.source = source
        self.year = year
        self.position = position or CubePosition()
        self.lookahead = lookahead
        self.keep_cuboid = keep_cuboid
        self._depth: tuple[int, int, int] | None = None
        self._cuboid: DataFrame | None = None

    def _columns(self, depth: tuple[int, int, int]) -> list[str]:
        return [col for h, d in zip((GEO, TIME, PRODUCT), depth) for _, col in h.levels[:d + 1]]

    def _ensure(self, pos: CubePosition) -> DataFrame | None:
        if not self.keep_cuboid:
            return None
        need = (pos.geo, pos.time, pos.product)
        if self._depth and all(n <= d for n, d in zip(need, self._depth)):
            return self._cuboid
        # Build ``lookahead`` levels below the position, so the usual next
        # drill-down is served without another pass over the fact.
        ahead = tuple(min(n + self.lookahead, len(h) - 1)
                      for n, h in zip(need, (GEO, TIME, PRODUCT)))
        depth = tuple(max(a, b) for a, b in zip(ahead, self._depth or ahead))
        self._cuboid = materialize(C.state_cuboid(self.source.frame(self.year),
                                                  self._columns(depth)))
        self._depth = depth
        return self._cuboid

    def analysis(self, position: CubePosition | None = None, **kw) -> DataFrame:
        pos = position or self.position
        cuboid = self._ensure(pos)
        if cuboid is None:
            return navigate(self.source, pos, self.year, **kw)
        return C.analysis(FrameStar(cuboid), *pos.levels, None, **kw)

    def drill_down(self, dim: str) -> DataFrame:
        self.position = self.position.drill_down(dim)
        return self.analysis()

    def roll_up(self, dim: str) -> DataFrame:
        self.position = self.position.roll_up(dim)
        return self.analysis()
