"""Latest-version, keep-last and scenario-pivot operators.

All of them are grouped aggregations with map-side partial aggregation, so a key that holds a large
part of the rows is collapsed before the shuffle instead of being sorted in one window task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one with the greatest ``order``. NULL order values rank lowest."""
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = order_cols[0] if len(order_cols) == 1 and not rest else F.struct(*order_cols)
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen by the order of all other columns so that re-runs agree."""
    rest = [c for c in df.columns if c not in keys]
    return keep_last(df, keys, rest) if rest else df.distinct()


def latest_version(df: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    return keep_last(df, keys, [version])


def latest_in_max_year(df: DataFrame, keys: Sequence[str], year: str = "fiscal_year", version: str = "version_id") -> DataFrame:
    """Latest version per key within the greatest fiscal year (a scalar subquery on one column)."""
    newest = df.agg(F.max(year)).scalar()
    return latest_version(df.filter(F.col(year) == newest), keys, version)


def rows_at_max_version(df: DataFrame, period: str = "date_key", version: str = "version_id") -> DataFrame:
    """Rows whose (period, version) is the period's greatest version.

    The versions are one row per period, so they are broadcast: Spark knows their size only after it has shuffled the rows
    for the join."""
    newest = df.groupBy(period).agg(F.max(version).alias(version))
    return df.join(F.broadcast(newest), [period, version], "left_semi").select(*df.columns)


def _scenario_value(scenario: str, name: str, value: str) -> Column:
    return F.max(F.when(F.col("scenario") == name, F.col(value))).alias(scenario)


def latest_scenario_pivot(df: DataFrame, keys: Sequence[str], value: str = "value", version: str = "version_id") -> DataFrame:
    """Budget and forecast side by side, each from its latest version: one grouped pass, no window."""

    def newest(name: str) -> Column:
        hit = F.col("scenario") == name
        return F.max_by(F.col(value), F.when(hit, F.col(version)))

    return (
        df.filter(F.col("scenario").isin("Budgets", "Forecast"))
        .groupBy(*keys)
        .agg(newest("Budgets").alias("budget_value"), newest("Forecast").alias("forecast_value"))
    )


def all_versions_pivot(df: DataFrame, keys: Sequence[str], value: str = "value", version: str = "version_id") -> DataFrame:
    """Budget and forecast maxima over every version, with the greatest version seen."""
    return df.groupBy(*keys).agg(
        F.max(version).alias("latest_version_id"),
        _scenario_value("budget_value", "Budgets", value),
        _scenario_value("forecast_value", "Forecast", value),
    )


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once."""
    repeated = df.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    return df.join(repeated, key, "left_semi").select(*df.columns)


def duplicate_report(df: DataFrame, key: str, sample: int = 10) -> DataFrame:
    """First duplicated keys in key order with their row counts and the total of duplicated rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("key_rows")).filter("key_rows > 1")
    total = counts.agg(F.coalesce(F.sum("key_rows"), F.lit(0)).alias("t")).scalar()
    return counts.withColumn("duplicate_rows", total).orderBy(key).limit(sample)
