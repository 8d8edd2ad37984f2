"""The cell dimension: tower (lac, cell) → city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.text import clean_city

CELLS_MODES = ("all", "one", "last")
KEEP = ("largest", "last")


def _kept_city(keep: str) -> Column:
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}, got {keep!r}")
    return (F.max("city") if keep == "largest" else F.max_by("city", "place")).alias("city")


def cell_dimension(cells: DataFrame, keep: str = "largest") -> DataFrame:
    """One city per tower.

    The original job kept whichever city its reducer saw last, which depends
    on shuffle order. Two deterministic choices among the same candidates:
    ``keep="largest"``, the largest name, and ``"last"``, the one of the last
    line in order of file and line (``cells`` read with ``place=True``). Rows
    without a city are never stored.
    """
    return (cells.where(F.col("city").isNotNull())
            .groupBy("lac", "cell")
            .agg(_kept_city(keep)))


def tower_cities(cells: DataFrame, cells_mode: str = "all", strip: str = "quotes",
                 clean: bool = True) -> DataFrame:
    """Towers → cities as the join side of the itinerary operators.

    ``cells_mode="all"`` keeps every city listed for a tower (a tower with
    two cities puts both in the itinerary), ``"one"`` and ``"last"`` keep one
    (``cell_dimension``: the largest name, or the last line's). Duplicate directory rows are removed here, on the
    small side, so they never multiply log rows in the join.
    """
    if cells_mode not in CELLS_MODES:
        raise ValueError(f"cells_mode must be one of {CELLS_MODES}, got {cells_mode!r}")
    if cells_mode in ("one", "last"):
        # Already one row per tower. Grouped by the pair as one value: its
        # partitioning is of no use to the join, which then gets an exchange
        # of its own that adaptive execution can split at a hot tower.
        dim = (cells.where(F.col("city").isNotNull())
               .groupBy(F.struct("lac", "cell").alias("tower")).agg(_kept_city("last" if cells_mode == "last" else "largest"))
               .select("tower.lac", "tower.cell", "city"))
        return dim.withColumn("city", clean_city("city", strip)) if clean else dim
    dim = cells.where(F.col("city").isNotNull()).select("lac", "cell", "city")
    if clean:
        dim = dim.withColumn("city", clean_city("city", strip))
    return dim.distinct()
