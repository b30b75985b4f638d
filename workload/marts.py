"""Queries over latest versions, variance and adjustment marts, and reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import scalar as sc
from ledgerloom.operators.latest import all_versions_pivot, keep_last, latest_scenario_pivot, rows_at_max_version
from ledgerloom.operators.numbering import assign_surrogate_keys, global_row_number
from ledgerloom.plans import marts, views
from ledgerloom.sources.snapshots import append_version
from workload.fixtures import AS_OF, REPORTING_MONTH, Tables, as_date, typed, with_ctes

MONTH = f"DATE '{REPORTING_MONTH}'"


# --- latest versions ------------------------------------------------------------------------


def latest_version_qualify(t: Tables) -> DataFrame:
    return views.latest_engine_values(t.engine_history)


LATEST_VERSION_QUALIFY = typed(
    with_ctes(
        ["engine_history"],
        """SELECT kpi_engine_key, matrix_id, date_key, fiscal_year, fiscal_month, kpi_id, kpi_dim_id, version_id, value AS kpi_value
           FROM engine_history WHERE fiscal_year = (SELECT MAX(fiscal_year) FROM engine_history)
           QUALIFY row_number() OVER (PARTITION BY kpi_engine_key, date_key ORDER BY version_id DESC) = 1""",
    ),
    double="kpi_value",
    text="date_key",
)


def latest_version_semi(t: Tables) -> DataFrame:
    return rows_at_max_version(t.engine_history.select("kpi_engine_key", "matrix_id", "date_key", "version_id", "value"))


LATEST_VERSION_SEMI = typed(
    with_ctes(
        ["engine_history"],
        """SELECT kpi_engine_key, matrix_id, date_key, version_id, value FROM engine_history
           WHERE (date_key, version_id) IN (SELECT (date_key, MAX(version_id)) FROM engine_history GROUP BY date_key)""",
    ),
    double="value",
    text="date_key",
)


def latest_pivot(t: Tables) -> DataFrame:
    return latest_scenario_pivot(t.budget_forecast, ["kpi_id", "kpi_dim_id", "date_key"])


_PIVOT = """SELECT kpi_id, kpi_dim_id, date_key, arg_max(value, version_id) FILTER (scenario = 'Budgets') AS budget_value,
    arg_max(value, version_id) FILTER (scenario = 'Forecast') AS forecast_value FROM budget_forecast
    WHERE scenario IN ('Budgets', 'Forecast') GROUP BY ALL"""


def allversions_pivot(t: Tables) -> DataFrame:
    return all_versions_pivot(t.budget_forecast, ["kpi_id", "kpi_dim_id", "date_key", "kpi_unique_id"])


_ALL_PIVOT = """SELECT * FROM (
      SELECT kpi_id, kpi_dim_id, date_key, kpi_unique_id, max(version_id) AS latest_version_id FROM budget_forecast GROUP BY ALL)
    LEFT JOIN (SELECT kpi_unique_id, date_key, max(value) AS budget_value FROM budget_forecast WHERE scenario = 'Budgets' GROUP BY ALL) USING (kpi_unique_id, date_key)
    LEFT JOIN (SELECT kpi_unique_id, date_key, max(value) AS forecast_value FROM budget_forecast WHERE scenario = 'Forecast' GROUP BY ALL) USING (kpi_unique_id, date_key)"""


def history_append_version(t: Tables) -> DataFrame:
    """A new run for every month, numbered after the month's versions; the old rows lack one column."""
    old = t.engine_history.select("kpi_engine_key", "date_key", "value", "version_id")
    new = t.engine_output.select("kpi_engine_key", "date_key", "value", "kpi_name")
    return append_version(old, new)


HISTORY_APPEND_VERSION = typed(
    with_ctes(
        ["engine_history", "engine_output"],
        """SELECT kpi_engine_key, date_key, value, version_id, CAST(NULL AS VARCHAR) AS kpi_name FROM engine_history
           UNION ALL SELECT kpi_engine_key, o.date_key, value, COALESCE(m.top, 0) + 1, kpi_name FROM engine_output o
           LEFT JOIN (SELECT date_key, MAX(version_id) AS top FROM engine_history GROUP BY 1) m ON o.date_key = m.date_key""",
    ),
    double="value",
    text="date_key",
)

# --- numbering ------------------------------------------------------------------------------


def global_sequence(t: Tables) -> DataFrame:
    return global_row_number(t.orders.select("o_orderpriority", "o_custkey", "o_orderkey"), ["o_orderpriority", "o_custkey", "o_orderkey"])


GLOBAL_SEQUENCE = "SELECT o_orderpriority, o_custkey, o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) AS seq FROM orders"


def surrogate_keys(t: Tables) -> DataFrame:
    target = t.supplier.select(F.col("s_suppkey").alias("party_key"))
    return assign_surrogate_keys(t.customer.select("c_custkey", "c_name", F.lit(None).cast("bigint").alias("party_key")), target, "party_key", ["c_name", "c_custkey"])


SURROGATE_KEYS = """SELECT c_custkey, c_name, (SELECT MAX(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name, c_custkey) AS party_key FROM customer"""

# --- marts ----------------------------------------------------------------------------------


def uom_lookup(t: Tables) -> DataFrame:
    return marts.uom_lookup(t.engine_output, t.actuals_historic, t.budget_forecast)


def _enriched(t: Tables) -> DataFrame:
    # one row per site: stored, their size is known before the join, as that of a location table is
    return views.enriched_output(t.engine_output, t.stored("locations").locations)


def value_adjustment_mart(t: Tables) -> DataFrame:
    return marts.value_adjustment_mart(t.engine_output, t.naming, _enriched(t), uom_lookup(t))


# what a row's source column says about its kind; the labels are the marts' contract
_KIND = "if({0} IS NULL, 'N/A', if({0} = 'Calculated from other KPIs', 'CALCULATED KPI', 'BASE KPI'))"


def _display_id(prefix: str, number: str, width: int) -> str:
    """A number behind its prefix, filled up to a width; wider numbers stay whole."""
    return f"concat({prefix}, '-', lpad({number}::VARCHAR, greatest({width}, length({number}::VARCHAR))::INTEGER, '0'))"


_UNSET = {"adjusted_value": "DOUBLE", "adjustment_reason": "VARCHAR", "adjusted_by": "VARCHAR", "adjusted_at": "VARCHAR", "approved_by": "VARCHAR", "approved_at": "VARCHAR", "priority": "INTEGER"}
VALUE_ADJUSTMENT_MART = typed(
    with_ctes(
        ["enriched", "uoms", "naming"],
        f"""SELECT kpi_engine_key, kpi_id AS kpi_reference, kpi_dim_id::INTEGER AS location_column_id, date_key AS month_date, value AS original_value,
             site_code, dim_name AS location_name, kpi_name AS kpi_aggregation, subcategory AS kpi_subcategory, ifnull(scr_category, category) AS kpi_category,
             uoms.uom AS unit_of_measure, {_KIND.format("source")} AS source, year(date_key)::INTEGER AS year, month(date_key)::INTEGER AS month,
             adj_id, {_display_id("concat('ADJ-', year(date_key))", "adj_id", 4)} AS adjustment_id, 'ACTUAL' AS scenario, 'DRAFT' AS status,
             {", ".join(f"NULL::{t} AS {c}" for c, t in _UNSET.items())}
           FROM (SELECT *, row_number() OVER (ORDER BY kpi_id, kpi_dim_id::INTEGER, date_key) AS adj_id FROM enriched)
           LEFT JOIN naming USING (matrix_id) LEFT JOIN uoms USING (kpi_id)""",
    ),
    double="original_value",
    text="month_date",
)


def variance_current(t: Tables) -> DataFrame:
    return marts.variance_current(t.engine_output, t.budget_forecast)


def variance_history(t: Tables) -> DataFrame:
    return marts.variance_history(_known_kpis(t), t.actuals_historic, t.budget_forecast, as_date(REPORTING_MONTH))


def variance_history_concat(t: Tables) -> DataFrame:
    return marts.variance_history_by_matrix(_known_kpis(t), t.actuals_historic, t.budget_forecast, as_date(REPORTING_MONTH))


def _known_kpis(t: Tables) -> DataFrame:
    """What the output says of each KPI and dim in its latest month."""
    return keep_last(t.engine_output, ["matrix_id"], ["date_key"])


def _variances(facts: str) -> str:
    """The mart's columns for facts (key, unit, kind, actual, budget, forecast, names of the KPI)."""
    sides = ", ".join(
        f"actual - {side} AS {side}_variance, (actual - {side})::DECIMAL(18,2)::DOUBLE / nullif({side}, 0)::DOUBLE * 100.0::DOUBLE AS {side}_variance_pct, {side} AS {side}_value"
        for side in ("budget", "forecast")
    )
    unset = {"site_code": "VARCHAR", "company_code": "VARCHAR", "variance_commentary": "VARCHAR", "var_id": "INTEGER", "priority": "INTEGER"}
    names = {"kpi_aggregation": "kpi_name", "kpi_category": "category", "kpi_subcategory": "subcategory", "location_name": "dim_name", "kpi_ref": "kpi_id", "month_date": "date_key"}
    return f"""SELECT key AS kpi_engine_key, unit AS unit_of_measure, kind AS source, actual AS actual_value, execution_level::BIGINT AS computation_level,
      year(date_key)::INTEGER AS year, month(date_key)::INTEGER AS month, {sides},
      {", ".join(f"{v} AS {k}" for k, v in names.items())}, {", ".join(f"NULL::{t} AS {c}" for c, t in unset.items())} FROM ({facts})"""


_KPI_NAMES = "kpi_name, category, subcategory, dim_name, execution_level"
# plans whose dim is a number, under the text KPI_dim in normal form
_PLAN = "SELECT concat(kpi_id, '_', kpi_dim_id::BIGINT) AS matrix, * EXCLUDE (kpi_id, kpi_dim_id) FROM {0} WHERE regexp_full_match(kpi_dim_id, '[0-9]+')"
# actuals of KPIs that the current output knows, likewise
_KNOWN_ACTUALS = f"""SELECT a.*, k.kpi_engine_key AS known_key, k.matrix_id AS matrix, {", ".join(f"k.{c}" for c in _KPI_NAMES.split(", "))}
    FROM (SELECT kpi_id, kpi_dim_id, date_key, value, uom, kpi_unique_id FROM actuals_historic WHERE TRY_CAST(kpi_dim_id AS BIGINT) IS NOT NULL) a
    JOIN (FROM engine_output QUALIFY row_number() OVER (PARTITION BY matrix_id ORDER BY date_key DESC) = 1) k ON k.matrix_id = concat(a.kpi_id, '_', TRY_CAST(a.kpi_dim_id AS BIGINT))"""
_VARIANCE = {
    "pivoted": _PIVOT,
    "plan_now": _PLAN.format("pivoted"),
    "v_current": _variances(
        f"""SELECT kpi_engine_key AS key, NULL::VARCHAR AS unit, {_KIND.format("source")} AS kind, value AS actual, budget_value AS budget, forecast_value AS forecast,
              kpi_id, o.date_key, {_KPI_NAMES} FROM engine_output o LEFT JOIN plan_now p ON p.matrix = o.matrix_id AND p.date_key = o.date_key"""
    ),
    "known_actuals": _KNOWN_ACTUALS,
    "v_history": _variances(
        f"""SELECT known_key AS key, uom AS unit, NULL::VARCHAR AS kind, value AS actual, budget_value AS budget, forecast_value AS forecast, kpi_id, a.date_key, {_KPI_NAMES}
            FROM known_actuals a LEFT JOIN plan_now p ON p.matrix = a.matrix AND p.date_key = a.date_key AND p.date_key <> {MONTH}"""
    ),
    "all_pivoted": _ALL_PIVOT,
    "plan_ever": _PLAN.format("all_pivoted"),
    "v_matrix": _variances(
        f"""SELECT ifnull(a.kpi_unique_id, p.kpi_unique_id) AS key, uom AS unit, NULL::VARCHAR AS kind, value AS actual, budget_value AS budget, forecast_value AS forecast,
              kpi_id, a.date_key, {_KPI_NAMES}
            FROM known_actuals a LEFT JOIN plan_ever p ON p.matrix = a.matrix AND p.date_key = a.date_key AND p.date_key <> {MONTH}"""
    ),
}
_NUMBERS = "actual_value budget_value forecast_value budget_variance budget_variance_pct forecast_variance forecast_variance_pct"
_FROM = ["engine_output", "actuals_historic", "budget_forecast"]


def variance_final(t: Tables) -> DataFrame:
    return marts.variance_final(variance_current(t), variance_history(t), _enriched(t), uom_lookup(t), t.teams, 1998)


def variance_final_concat(t: Tables) -> DataFrame:
    return marts.variance_final(variance_current(t), variance_history_concat(t), _enriched(t), uom_lookup(t), t.teams, 1998)


def _final_sql(history: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in "kpi_ref month_date location_name kpi_engine_key actual_value budget_value forecast_value source".split())
    more = _VARIANCE | {
        "lines": f"SELECT * EXCLUDE (var_id, source), row_number() OVER (ORDER BY {order}) AS var_id FROM (FROM v_current UNION ALL BY NAME FROM {history})",
        # several places of one key multiply its lines, as a lookup join does
        "places": "SELECT kpi_engine_key, matrix_id, site_code, company_code FROM enriched",
    }
    body = f"""SELECT n.* REPLACE (ifnull(n.unit_of_measure, u.uom) AS unit_of_measure, e.site_code AS site_code, e.company_code AS company_code),
          {_display_id("'VAR-1998'", "n.var_id", 5)} AS variance_id, ifnull(team_name, 'Unknown') AS site_leadership_team
        FROM lines n LEFT JOIN uoms u ON u.kpi_id = n.kpi_ref LEFT JOIN places e USING (kpi_engine_key) LEFT JOIN teams ON teams.kpi_matrix_id = e.matrix_id"""
    return typed(with_ctes(["enriched", "uoms", "teams"], body, more), double=_NUMBERS, text="month_date")


def _variance_query(cte: str) -> str:
    return typed(with_ctes(_FROM, f"SELECT * FROM {cte}", _VARIANCE), double=_NUMBERS, text="month_date")


# --- views ----------------------------------------------------------------------------------


def active_master(t: Tables) -> DataFrame:
    master = t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("active_ind"))
    return views.active_master(master)


ACTIVE_MASTER = "SELECT c_custkey, c_name, 1 AS active_ind FROM customer WHERE c_acctbal > 0"


def forecast_override(t: Tables) -> DataFrame:
    return views.forecast_override(t.budget_forecast, views.engine_actuals(t.engine_history), as_date(AS_OF))


_COMMON = "kpi_unique_id, kpi_matrix_id, date_key, fiscal_year, fiscal_month, scenario, kpi_id, kpi_dim_id, category, subcategory, kpi_name, dim_name, uom, value"
_REPORT = {
    "newest": "SELECT date_key, max(version_id) AS version_id FROM engine_history GROUP BY date_key",
    "actuals": """SELECT * EXCLUDE (kpi_engine_key, matrix_id, version_id, kpi_dim_id), kpi_engine_key AS kpi_unique_id, matrix_id AS kpi_matrix_id,
        kpi_dim_id::VARCHAR AS kpi_dim_id, 'Actual' AS scenario FROM engine_history JOIN newest USING (date_key, version_id)""",
    # a forecast up to this month shows the actual value, where there is one
    "replaced": f"SELECT kpi_unique_id, date_key, value AS actual FROM actuals WHERE date_key < date_trunc('month', DATE '{AS_OF}') + INTERVAL 1 DAY",
    "plans": """SELECT * EXCLUDE (value, scenario, metric_id, version_id, actual), metric_id AS kpi_matrix_id, replace(scenario, 'Budgets', 'Budget') AS scenario,
        if(scenario = 'Forecast', ifnull(actual, value), value) AS value
        FROM budget_forecast LEFT JOIN replaced USING (kpi_unique_id, date_key) WHERE version_id = (SELECT max(version_id) FROM budget_forecast)""",
    "old": "SELECT * EXCLUDE (metric_id), metric_id AS kpi_matrix_id, 'Actual' AS scenario FROM actuals_historic",
    "report": "SELECT DISTINCT * FROM (" + " UNION ALL ".join(f"SELECT {_COMMON} FROM {branch}" for branch in ("old", "plans", "actuals")) + ")",
}
# levels from the finest on; unknown ones come before all, missing ones after
_RANK = "if(loc_level IS NULL, NULL, ifnull(list_position(['location', 'company', 'site'], lower(loc_level)), 0))"


def _best_level(rows: str, group: str) -> str:
    """Rows with 1 where the level is the best of the group."""
    return f"SELECT *, ({_RANK} IS NOT DISTINCT FROM (min({_RANK}) OVER (PARTITION BY {group})))::INTEGER AS location_level_flag FROM ({rows})"


def report_rows(t: Tables) -> DataFrame:
    return views.report_rows(t.engine_history, t.actuals_historic, t.budget_forecast, as_date(AS_OF))


def report_snapshot(t: Tables) -> DataFrame:
    return views.report_snapshot(
        t.engine_history, t.actuals_historic, t.budget_forecast, t.locations, t.calendar, t.value_adjustments, t.variance_comments, as_date(AS_OF)
    )


_AMOUNTS = "kpi_value current_amount aaa_original_value aaa_adjusted_value aaa_adjustment_delta"
REPORT_SNAPSHOT = typed(
    with_ctes(
        ["engine_history", "actuals_historic", "budget_forecast", "locations", "calendar", "value_adjustments", "variance_comments"],
        """SELECT kpi_unique_id, kpi_id, kpi_name, category, subcategory, uom, scenario, date_key, kpi_matrix_id, kpi_dim_id, dim_name, location_level_flag,
              value AS kpi_value, value AS current_amount, kpi_dim_id AS location_column_id, 'kpi_engine' AS data_source,
              original_value AS aaa_original_value, adjusted_value AS aaa_adjusted_value, adjustment_reason,
              coalesce(nullif(adjusted_value, 0) - ifnull(original_value, 0), original_value, 0) AS aaa_adjustment_delta,
              place AS location_display_name, loc_level AS location_level, loc_type AS location_type, loc_type AS mine_type,
              company_code, company_name, company_split, site_code, site_name,
              cal.fiscal_year, cal.fiscal_month AS fiscal_period, fiscal_quarter, month_name, concat('FY', cal.fiscal_year) AS fiscal_year_label, variance_commentary
            FROM flagged
            LEFT JOIN (FROM calendar SELECT DISTINCT *) cal ON cal.date = flagged.date_key
            LEFT JOIN corrections USING (kpi_unique_id, date_key, scenario) LEFT JOIN comments USING (kpi_unique_id, date_key, scenario)""".replace("concat('FY', cal.fiscal_year)", "if(cal.fiscal_year IS NULL, NULL, concat('FY', cal.fiscal_year))"),
        _REPORT
        | {
            "places": "SELECT kpi_dim_id::VARCHAR AS kpi_dim_id, kpi_dim_name AS place, * EXCLUDE (kpi_dim_id, kpi_dim_name) FROM locations",
            "flagged": _best_level("SELECT * FROM report LEFT JOIN places USING (kpi_dim_id)", "kpi_id, date_key, scenario"),
            "corrections": "SELECT kpi_engine_key AS kpi_unique_id, month_date AS date_key, 'Actual' AS scenario, original_value, adjusted_value, adjustment_reason FROM value_adjustments WHERE scenario = 'ACTUAL'",
            "comments": "SELECT kpi_engine_key AS kpi_unique_id, month_date AS date_key, 'Actual' AS scenario, variance_commentary FROM variance_comments",
        },
    ),
    double=_AMOUNTS,
    text="date_key",
)


def location_level_flag(t: Tables) -> DataFrame:
    placed = t.engine_output.join(t.locations.select("kpi_dim_id", "Level"), "kpi_dim_id", "left")
    return views.level_flag(placed.select("kpi_id", "date_key", "kpi_dim_id", F.col("Level").alias("location_level")), ["kpi_id", "date_key"], "location_level")


LOCATION_LEVEL_FLAG = typed(
    with_ctes(
        ["engine_output", "locations"],
        "SELECT kpi_id, date_key, kpi_dim_id, loc_level AS location_level, location_level_flag FROM ("
        + _best_level("SELECT * FROM engine_output LEFT JOIN (SELECT kpi_dim_id, loc_level FROM locations) USING (kpi_dim_id)", "kpi_id, date_key")
        + ")",
    ),
    text="date_key",
)


def adjustment_delta(t: Tables) -> DataFrame:
    return t.value_adjustments.select("kpi_engine_key", sc.adjustment_delta("original_value", "adjusted_value").alias("delta"))


ADJUSTMENT_DELTA = typed(
    with_ctes(
        ["value_adjustments"],
        "SELECT kpi_engine_key, coalesce(nullif(adjusted_value, 0) - ifnull(original_value, 0), original_value, 0) AS delta FROM value_adjustments",
    ),
    double="delta",
)


def calendar_distinct(t: Tables) -> DataFrame:
    return t.calendar.distinct()


QUERIES = {
    "latest_version_qualify": (latest_version_qualify, LATEST_VERSION_QUALIFY),
    "latest_version_semi": (latest_version_semi, LATEST_VERSION_SEMI),
    "latest_scenario_pivot": (latest_pivot, typed(with_ctes(["budget_forecast"], "SELECT * FROM pivoted", {"pivoted": _PIVOT}), double="budget_value forecast_value", text="date_key")),
    "allversions_pivot": (allversions_pivot, typed(with_ctes(["budget_forecast"], _ALL_PIVOT), double="budget_value forecast_value", text="date_key")),
    "history_append_version": (history_append_version, HISTORY_APPEND_VERSION),
    "global_sequence": (global_sequence, GLOBAL_SEQUENCE),
    "surrogate_keys": (surrogate_keys, SURROGATE_KEYS),
    "uom_lookup": (uom_lookup, with_ctes(["uoms"], "SELECT kpi_id, uom FROM uoms")),
    "value_adjustment_mart": (value_adjustment_mart, VALUE_ADJUSTMENT_MART),
    "variance_current": (variance_current, _variance_query("v_current")),
    "variance_history": (variance_history, _variance_query("v_history")),
    "variance_history_concat": (variance_history_concat, _variance_query("v_matrix")),
    "variance_final": (variance_final, _final_sql("v_history")),
    "variance_final_concat": (variance_final_concat, _final_sql("v_matrix")),
    "enriched_output": (_enriched, typed(with_ctes(["enriched"], "SELECT * FROM enriched"), double="value", text="date_key")),
    "active_master": (active_master, ACTIVE_MASTER),
    "forecast_override": (forecast_override, typed(with_ctes(["engine_history", "budget_forecast"], f"SELECT {_COMMON} FROM plans", {k: _REPORT[k] for k in ("newest", "actuals", "replaced", "plans")}), double="value", text="date_key")),
    "report_rows": (report_rows, typed(with_ctes(["engine_history", "actuals_historic", "budget_forecast"], "SELECT * FROM report", _REPORT), double="value", text="date_key")),
    "report_snapshot": (report_snapshot, REPORT_SNAPSHOT),
    "location_level_flag": (location_level_flag, LOCATION_LEVEL_FLAG),
    "adjustment_delta": (adjustment_delta, ADJUSTMENT_DELTA),
    "calendar_distinct": (calendar_distinct, typed(with_ctes(["calendar"], "SELECT DISTINCT * FROM calendar"), text="date")),
}
