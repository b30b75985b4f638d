"""One reporting run: inputs and overlays -> formulas -> current output and versioned history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import fiscal_period, period_date
from ledgerloom.operators.adjustments import kpi_adjustments, table_adjustments, trial_balance_override
from ledgerloom.operators.engine import EngineRun, run_levels
from ledgerloom.operators.overlay import overlay_chain
from ledgerloom.sources import files, snapshots
from ledgerloom.sources.kept import KeptTable


@dataclass(frozen=True)
class Period:
    """Site and month of a run; the fiscal period follows from the month."""

    site: str
    year: int
    month: int

    @property
    def fiscal(self) -> tuple[int, int]:
        return fiscal_period(self.year, self.month)

    @property
    def date(self) -> Column:
        return period_date(F.lit(self.year), F.lit(self.month))

    @property
    def text(self) -> str:
        return f"{self.year}-{self.month:02d}-01"


def adjustment_source(environment: str, period: Period) -> str:
    """Where KPI corrections come from: the file in the ``ba`` environment and for fiscal 2026-09, else the table."""
    return "file" if environment == "ba" or period.fiscal == (2026, 9) else "table"


def period_corrections(environment: str, period: Period, file_rows: DataFrame, table_rows: DataFrame) -> DataFrame:
    """Summed KPI corrections of one period, from the source that its environment and fiscal period call for.

    The file belongs to the period; of the table only the period's and the site's adjusted rows count."""
    if adjustment_source(environment, period) == "file":
        return kpi_adjustments(file_rows)
    return table_adjustments(table_rows, period=period.date, site=period.site)


def all_inputs(
    unified: DataFrame,
    overlays: Sequence[DataFrame | None],
    scope: Sequence[str] = (),
    order: str = "seq",
) -> DataFrame:
    """Working inputs after all overlays, later ones on top; absent overlays are skipped."""
    return overlay_chain([unified, *[o for o in overlays if o is not None]], "input_ref", scope, order)


def load_period_inputs(
    spark: SparkSession,
    period: Period,
    unified: DataFrame,
    base_path: str | None = None,
    overlay_files: Sequence[str] = (),
    historical_file: str | None = None,
    adjustment_file: str | None = None,
    gl_activity: DataFrame | None = None,
    trial_balance: DataFrame | None = None,
    suffix: str = ".csv",
    fmt: str = "csv",
    store: Callable[[str], str] | None = None,
) -> DataFrame:
    """Unified inputs of the period, then overlay files, historical values, input adjustments and
    trial-balance overrides, in this order.

    With ``store`` (file name -> table name or folder) every file read also replaces its stored table."""
    y, mth = period.year, period.month
    fy, fm = period.fiscal

    def read(name: str | None) -> DataFrame | None:
        if not name or base_path is None:
            return None
        path = files.find_period_file(spark, base_path, y, mth, name, suffix)
        if store is not None:
            return files.ingest_period_file(spark, path, store(name), y, mth, fmt=fmt)
        return files.read_period_file(spark, path, y, mth, fmt=fmt)

    manual = files.stacked_files([read(n) for n in overlay_files])
    overlays = [
        files.input_rows(manual, y, mth) if manual is not None else None,
        _optional(read(historical_file), lambda df: files.historical_rows(df, y, mth, spark)),
        _optional(read(adjustment_file), lambda df: files.adjustment_rows(df, y, mth, spark)),
    ]
    if gl_activity is not None and trial_balance is not None:
        ledger = gl_activity.filter((F.col("fiscal_year") == fy) & (F.col("fiscal_month") == fm))
        balance = snapshots.trial_balance_snapshot(trial_balance, y, mth, period.site)
        changed = trial_balance_override(ledger, balance)
        overlays.append(changed.withColumn("value", F.col("value").cast("string")))
    return all_inputs(files.unified_inputs(unified, fy, fm, period.site), overlays)


def _optional(df: DataFrame | None, then) -> DataFrame | None:
    return None if df is None else then(df)


def run_period(
    period: Period,
    master: DataFrame,
    inputs: DataFrame,
    dim_names: DataFrame | None = None,
    corrections: DataFrame | None = None,
    corrections_kind: str = "table",
    base: DataFrame | None = None,
    run_ts: Column | None = None,
    run_user: str = "",
    order: str | None = None,
) -> EngineRun:
    """Formulas of one site and month; the result has the site as an extra leading column."""
    spark = master.sparkSession
    site, day = F.lit(period.site).alias("site_code"), period.date.alias("date_key")
    scopes = spark.range(1).select(site, day)
    adjustments = None
    if corrections is not None:
        if corrections_kind == "file":
            summed = kpi_adjustments(corrections)
        else:
            summed = table_adjustments(corrections, period=period.date, site=period.site)
        adjustments = summed.select(site, day, "matrix_id", "adjustment")
    return run_levels(
        master.withColumn("site_code", F.lit(period.site)),
        scopes,
        inputs.withColumns({"site_code": F.lit(period.site), "date_key": period.date}),
        adjustments=adjustments,
        base=None if base is None else base.withColumns({"site_code": F.lit(period.site), "date_key": period.date}),
        dim_names=dim_names,
        run_ts=run_ts,
        run_user=run_user,
        order=order,
    )


def publish(spark: SparkSession, run: EngineRun, current_path: str, history_path: str) -> None:
    """Replace the current output (a ``KeptTable``) and append the next version to the ``VersionedHistory``."""
    current = KeptTable(spark, current_path)
    stored = current.replace(run.results.drop("site_code"))
    # the history takes the rows just stored, so that the formulas are not evaluated again
    snapshots.VersionedHistory(spark, history_path).append(current.read(stored))
