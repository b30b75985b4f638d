"""Merging freshly built marts into their kept tables.

Each mart is reduced to one row per key first (ties broken by content, so that re-runs agree). Rows
new to the kept table get the next id; rows already there keep theirs, and every column that is not
listed for update keeps the kept value."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators import merge as m
from ledgerloom.operators.latest import keep_any

# Merge keys and updated columns of the two marts.
ADJUSTMENT_KEYS = ("kpi_engine_key", "month_date", "scenario")
ADJUSTMENT_UPDATES = (
    "adjustment_id", "kpi_reference", "location_column_id", "original_value", "kpi_category", "kpi_subcategory",
    "kpi_aggregation", "unit_of_measure", "location_name", "site_code", "year", "month", "source",
)
VARIANCE_KEYS = ("kpi_engine_key", "month_date")
VARIANCE_KEYS_BY_KPI = ("kpi_ref", "location_name", "month_date")
VARIANCE_UPDATES = (
    "variance_id", "kpi_ref", "kpi_engine_key", "kpi_aggregation", "kpi_category", "kpi_subcategory", "unit_of_measure",
    "location_name", "site_code", "company_code", "year", "month", "computation_level", "actual_value",
    "budget_value", "forecast_value", "budget_variance", "budget_variance_pct", "forecast_variance",
    "forecast_variance_pct", "site_leadership_team",
)


def merge_value_adjustments(kept: DataFrame, mart: DataFrame) -> DataFrame:
    """Adjustments: the original value is refreshed only while nobody has adjusted the row."""
    rows = keep_any(mart.drop("adj_id"), ADJUSTMENT_KEYS)
    return m.upsert_protected(kept, rows, ADJUSTMENT_KEYS, ADJUSTMENT_UPDATES, identity="adj_id")


def merge_variances(kept: DataFrame, mart: DataFrame, by_kpi: bool = False) -> DataFrame:
    """Variances by engine key and month, or by KPI, location and month; comments are kept."""
    keys = VARIANCE_KEYS_BY_KPI if by_kpi else VARIANCE_KEYS
    rows = keep_any(mart.drop("var_id"), keys)
    return m.upsert_columns(kept, rows, keys, [c for c in VARIANCE_UPDATES if c not in keys], identity="var_id")
