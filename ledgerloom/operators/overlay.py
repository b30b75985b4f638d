"""Ordered overlays: later sources overwrite earlier ones column by column where they have a value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import all_of, clean_ref
from ledgerloom.operators.latest import keep_any
from ledgerloom.sources.files import PLACE


def overlay_chain(
    sources: Sequence[DataFrame],
    key: str = "input_ref",
    scope: Sequence[str] = (),
    order: str = "seq",
    normalise: bool = True,
) -> DataFrame:
    """Fold ``sources`` (lowest priority first) into one row per (scope, key).

    Within a source the last row per key by ``order`` counts (a source without that column is reduced
    by its content, so that re-runs agree). A NULL in a later source keeps the earlier value; keys
    seen for the first time are appended. A column that no earlier source has reaches only the keys
    that are new at that point. The fold is one union and one grouped aggregation: a single shuffle
    for the whole chain, with hot keys collapsed before it."""
    keys = [*scope, key]
    columns: list[str] = []
    known_before: list[set[str]] = []
    tagged: list[DataFrame] = []
    for i, src in enumerate(sources):
        rest = [c for c in src.columns if c not in keys and c != order]
        known_before.append(set(columns))
        columns += [c for c in rest if c not in columns]
        if normalise:
            src = src.withColumn(key, clean_ref(key))
        if order in src.columns:
            src = src.withColumn("_rank", _rank(src, order))
        else:
            src = keep_any(src, keys).withColumn("_rank", _number_rank(F.lit(0)))
        tagged.append(src.select(*keys, *rest, "_rank", F.lit(i).alias("_src")))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    grouped = stacked.groupBy(*keys).agg(
        *[
            F.max_by(F.struct(*columns), F.when(F.col("_src") == i, F.col("_rank"))).alias(f"_s{i}")
            for i in range(len(sources))
        ]
    )

    def value(column: str) -> Column:
        choices = []
        for i in reversed(range(len(sources))):
            if column in sources[i].columns:
                picked = F.col(f"_s{i}.{column}")
                if i > 0 and column not in known_before[i]:
                    picked = F.when(all_of(F.col(f"_s{j}").isNull() for j in range(i)), picked)
                choices.append(picked)
        return F.coalesce(*choices).alias(column)

    return grouped.select(*keys, *[value(c) for c in columns])


def _number_rank(number: Column) -> Column:
    return F.struct(F.lit(0).alias("file"), F.lit("").alias("path"), F.lit(0).cast("bigint").alias("block"), number.cast("bigint").alias("position"))


def _rank(src: DataFrame, order: str) -> Column:
    """A row's rank in its source: a number, or the place of a row of stacked files. NULL ranks lowest."""
    if src.schema[order].dataType.typeName() != "struct":
        return _number_rank(F.col(order))
    return F.coalesce(F.col(order).cast(PLACE), F.lit(None).cast(PLACE), F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (("file", "int"), ("path", "string"), ("block", "bigint"), ("position", "bigint"))]))


def overlay_merge(base: DataFrame, overlay: DataFrame, key: str = "input_ref", **options) -> DataFrame:
    """One overlay over one base."""
    return overlay_chain([base, overlay], key, **options)
