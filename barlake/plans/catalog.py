"""The registered queries: what each runs and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: RUN
    oracle: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None) -> Callable[[RUN], RUN]:
    def register(run: RUN) -> RUN:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Entry(run, oracle)
        return run

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """The frame with some columns rounded, for comparison across engines."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def all_queries() -> dict[str, Entry]:
    from barlake.plans import (  # noqa: F401  (importing registers)
        analytics,
        bars,
        continued,
        coverage,
        lake,
        lifecycle,
        mapping,
        quality,
        sources,
        streams,
    )

    return CATALOG
