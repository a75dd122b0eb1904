"""Joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No more keys than this can have a 1 / HEAVY_KEYS share of the rows each, which bounds what is broadcast.
HEAVY_KEYS = 1_000


def join_with_heavy_keys(rows: DataFrame, keyed: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, which has one row per key and the ``count`` of its rows.

    Keys with at least a thousandth of the ``total`` rows, a thousand at most,
    are broadcast, so their rows stay where they are; the others are shuffled.
    """
    least = max(total // HEAVY_KEYS, 1_000)
    heavy = F.broadcast(keyed.filter(F.col(count) >= least))
    light = keyed.filter(F.col(count) < least)
    return rows.join(heavy, keys).unionByName(rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys))
