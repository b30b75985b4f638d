"""Adjustments: summed KPI corrections and trial-balance overrides of general-ledger inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalar import MEASURE_TYPE, clean_ref, key_text, matrix_id

TRIAL_BALANCE_SOURCE = "trial balance adjustments"


#: A measure is summed as whole units and as 10^-12 parts of one, each in a decimal that has room for any number of rows.
_WHOLE, _PART, _PARTS = "decimal(25,0)", "decimal(13,0)", 10**12


def whole_and_part(measure: Column) -> tuple[Column, Column]:
    """A measure's whole units (rounded down) and the rest in 10^-12 parts, which is never negative."""
    v = measure.cast(MEASURE_TYPE)
    whole = F.floor(v).cast(_WHOLE)
    return whole, ((v - whole).cast("decimal(13,12)") * _parts()).cast(_PART)


def summed(df: DataFrame, measure: str) -> tuple[Column, Column]:
    """Aggregates: the exact sum of a measure as whole units and parts. A narrow decimal is summed as it is and divided
    once per group; a wide one, or a number of another type, is divided row by row."""
    kind = df.schema[measure].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 18 and kind.scale <= 12:
        total = checked_sum(measure)
        whole = F.floor(total)
        return whole.cast("decimal(38,0)"), ((total - whole).cast("decimal(13,12)") * _parts()).cast("decimal(38,0)")
    whole, part = whole_and_part(F.col(measure))
    return checked_sum(whole).cast("decimal(38,0)"), checked_sum(part).cast("decimal(38,0)")


def _parts() -> Column:
    return F.lit(_PARTS).cast(_PART)


def measure_of(whole: Column, part: Column) -> Column:
    """Back to DECIMAL(36,12), with the carry of the parts; raises if that has no room for the number."""
    carry = F.floor((part - F.pmod(part, _parts())) / _parts()).cast("decimal(38,0)")
    rest = (F.pmod(part, _parts()).cast(_PART) / _parts()).cast("decimal(13,12)")
    units = _checked(_checked(F.try_add(whole.cast("decimal(38,0)"), carry)).try_cast(_WHOLE))
    return F.when(whole.isNotNull(), _checked((units.cast("decimal(37,12)") + rest).try_cast(MEASURE_TYPE)))


def _checked(value: Column) -> Column:
    """The value, or an error where an exact operation gave none; the same with and without ANSI mode."""
    return F.coalesce(value, F.raise_error(F.lit("amounts exceed an exact decimal")))


def checked_sum(value: Column | str) -> Column:
    """An exact sum of decimals that raises when it has no room, with and without ANSI mode. NULL without any value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(v) > 0, F.coalesce(F.try_sum(v), F.raise_error(F.lit("amounts exceed an exact decimal"))))


def sum_by_kpi(
    df: DataFrame, value: Column | str, kpi_id: str = "kpi_id", dim: str = "kpi_dim_id", scope: Sequence[str] = ()
) -> DataFrame:
    """One summed value per ``<KPI>_<dim>``; unparsable values count as 0, dims are whole-number text.

    Rows whose dim is no whole number have no key and match nothing, so they are left out. Values
    are summed as exact decimals, which makes the sum independent of the row order; a number that no
    DECIMAL(36,12) holds is summed as a double instead, so that only text that is no number counts as 0."""
    v = F.col(value) if isinstance(value, str) else value
    as_double = F.col(dim).try_cast("double")
    dim_number = F.coalesce(F.col(dim).try_cast("bigint"), F.when(as_double == F.floor(as_double), as_double.try_cast("bigint")))
    exact, wide = v.try_cast(MEASURE_TYPE), v.try_cast("double")
    wide = F.when(exact.isNull() & ~F.isnan(wide), wide)
    return (
        df.select(*scope, matrix_id(key_text(kpi_id), dim_number).alias("matrix_id"), exact.alias("_v"), wide.alias("_w"))
        .filter("matrix_id is not null")
        .groupBy(*scope, "matrix_id")
        .agg((F.coalesce(checked_sum("_v").cast("double"), F.lit(0.0)) + F.coalesce(F.sum("_w"), F.lit(0.0))).alias("adjustment"))
    )


def kpi_adjustments(df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Corrections given as a file of (kpi_id, kpi_dim_id, value)."""
    return sum_by_kpi(df, "value", scope=scope)


def table_adjustments(df: DataFrame, scope: Sequence[str] = (), period: Column | None = None, site: str | None = None) -> DataFrame:
    """Corrections from the adjustment table: rows with an adjusted value, which itself is summed."""
    rows = df.filter(F.col("adjusted_value").isNotNull())
    if period is not None:
        rows = rows.filter(F.col("month_date").cast("date") == period)
    if site is not None:
        rows = rows.filter(F.col("site_code") == site)
    return sum_by_kpi(rows, "adjusted_value", "kpi_reference", "location_column_id", scope)


def trial_balance_override(
    gl: DataFrame,
    trial_balance: DataFrame,
    override: str = "current_movement",
    on: Sequence[str] = (),
) -> DataFrame:
    """Recompute the inputs that have at least one overridden account, from all their accounts.

    ``gl``: input_ref, gl_account, fiscal_year, fiscal_month, measure_value.
    ``trial_balance``: account_number, the override column, and any extra match columns in ``on``
    (say the site; by default accounts match across sites).

    An account's override replaces the measure of each of its ledger rows; an account listed more
    than once counts once per listing. Both sides are summed per account before they meet, so a
    hot account is one row per input when it is shuffled, and the affected inputs fall out of the
    same aggregation instead of a second pass."""
    gl_keys = ["input_ref", "account_number", "fiscal_year", "fiscal_month", *on]
    wide = "decimal(38,0)"
    zero = F.lit(0).cast(wide)
    measure = dict(zip(("_measure", "_measure_parts"), summed(gl, "measure_value")))
    listing = dict(zip(("_override", "_override_parts"), summed(trial_balance, override)))
    ledger = (
        gl.withColumn("account_number", F.col("gl_account").cast("string"))
        .groupBy(*gl_keys)
        .agg(F.count("*").cast("decimal(19,0)").alias("_rows"), *[F.coalesce(v, zero).alias(n) for n, v in measure.items()])
    )
    listed = (
        trial_balance.withColumn("account_number", F.col("account_number").cast("string"))
        .groupBy("account_number", *on)
        .agg(
            *[v.alias(n) for n, v in listing.items()],
            F.sum(F.when(F.col(override).isNull(), 1).otherwise(0)).cast("decimal(19,0)").alias("_plain"),
        )
    )

    def total(name: str, own: str) -> Column:
        overridden = F.when(F.col(name).isNull(), zero).otherwise(_checked(F.try_multiply("_rows", name).cast(wide)))
        plain = F.when(F.col("_plain").isNull(), F.col(own)).otherwise(_checked(F.try_multiply("_plain", own).cast(wide)))
        return checked_sum(_checked(F.try_add(overridden, plain).cast(wide)))

    return (
        ledger.join(listed, ["account_number", *on], "left")
        .groupBy(*[k for k in gl_keys if k != "account_number"])
        .agg(
            total("_override", "_measure").alias("_whole"), total("_override_parts", "_measure_parts").alias("_part"),
            F.max(F.col("_override").isNotNull()).alias("_touched"),
        )
        .filter("_touched")
        .select(
            clean_ref("input_ref").alias("input_ref"),
            F.lit(TRIAL_BALANCE_SOURCE).alias("source"),
            F.col("fiscal_month").alias("fin_period"),
            F.col("fiscal_year").alias("fin_year"),
            *on,
            measure_of(F.col("_whole"), F.col("_part")).alias("value"),
        )
    )
