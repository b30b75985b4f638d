"""Multi-source unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

STRATEGIES = ("INSERT", "UNION", "UNION ALL")


def union_sources(sources: Sequence[DataFrame], strategy: str = "UNION ALL", distinct_each: bool = False) -> DataFrame:
    """Stack sources by column name.

    ``UNION`` removes duplicates over the whole stack: one distinct at the end gives the same rows as
    one after each step. ``INSERT`` (one insert per source) adds the same rows as ``UNION ALL``.
    ``distinct_each`` is the view's DISTINCT toggle; under ``UNION`` it changes nothing."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; expected one of {STRATEGIES}")
    if distinct_each and strategy != "UNION":
        sources = [s.distinct() for s in sources]
    stacked = reduce(DataFrame.unionByName, sources)
    return stacked.distinct() if strategy == "UNION" else stacked
