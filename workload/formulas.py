"""Queries over the KPI formula engine: every site and month in one run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.engine import EngineRun, formula_with_names, prepare_definitions, run_levels, run_summary, skipped_definitions
from workload.fixtures import DEFINITIONS, RUN_1, Tables, as_ts, typed, with_ctes


def _run(t: Tables, **options) -> EngineRun:
    return run_levels(t.definitions, t.scopes, t.formula_inputs, run_ts=as_ts(RUN_1), run_user="loader", **options)


def _values(run: EngineRun) -> DataFrame:
    """Values with all their twelve decimals."""
    return run.results.select("site_code", "date_key", "kpi_id", "kpi_dim_id", F.col("value").cast("string").alias("value"))


def formula_levels(t: Tables) -> DataFrame:
    return _values(_run(t, texts=False))


def _net_corrections(t: Tables) -> DataFrame:
    """A correction of K1_1 wherever something was returned, and of the KPI without a formula."""
    pairs = F.array(F.struct(F.lit("K1_1").alias("matrix_id"), F.lit(250.5).alias("adjustment")), F.struct(F.lit("K3_3").alias("matrix_id"), F.lit(-1.0).alias("adjustment")))
    returned = t.formula_inputs.filter("input_ref = 'i4'")
    return returned.select("site_code", "date_key", F.explode(pairs).alias("p")).select("site_code", "date_key", "p.*")


def formula_adjusted(t: Tables) -> DataFrame:
    return _values(_run(t, adjustments=_net_corrections(t), texts=False))


def _seeds(t: Tables) -> DataFrame:
    """K9_9 is known from elsewhere where something was returned; a seed for K1_1 is overruled by the master."""
    returned = t.formula_inputs.filter("input_ref = 'i4'")
    seeds = (("K9", 9, F.col("value")), ("K1", 1, F.lit(-1.0)))
    pairs = F.array(*[F.struct(F.lit(k).alias("kpi_id"), F.lit(d).alias("kpi_dim_id"), v.alias("value")) for k, d, v in seeds])
    return returned.select("site_code", "date_key", F.explode(pairs).alias("p")).select("site_code", "date_key", "p.*")


def formula_seeded(t: Tables) -> DataFrame:
    return _values(_run(t, base=_seeds(t), texts=False))


def formula_missing_log(t: Tables) -> DataFrame:
    return _run(t).missing


def formula_stamped(t: Tables) -> DataFrame:
    """Everything but the number: keys, period, names and shown formulas."""
    r = _run(t).results
    return r.select(
        "kpi_engine_key", "matrix_id", "date_key", "fiscal_year", "fiscal_month", "sort_key", "execution_level", "kpi_name",
        "resolved_formula_names", "created_date", "created_by", "site_code",
    )


def formula_audit_text(t: Tables) -> DataFrame:
    """All columns of a corrected run as they are stored: values with twelve decimals, formulas with their operands."""
    r = _run(t, adjustments=_net_corrections(t)).results
    return r.withColumn("value", F.col("value").cast("string"))


def formula_names(t: Tables) -> DataFrame:
    named = formula_with_names(prepare_definitions(t.definitions, ["site_code"]), t.definitions, ["site_code"])
    return named.select("site_code", "kpi_id", "kpi_dim_id", "resolved_formula_names")


def summary(t: Tables) -> DataFrame:
    return run_summary(_run(t))


def formula_skipped(t: Tables) -> DataFrame:
    return skipped_definitions(t.definitions).select("site_code", "kpi_id", "kpi_dim_id", "kpi_name")


def _levels_sql(adj: str = "0.0", empty: str = "0.0", seed: str = "0.0") -> dict[str, str]:
    """One CTE per level: the values of its formulas as doubles."""
    return {
        "l1": f"SELECT *, (I1 - I3) + CAST({adj} AS DOUBLE) AS k11, I1 / I2 AS k12, CAST({empty} AS DOUBLE) AS k33 FROM formula_values",
        "l2": "SELECT *, CASE WHEN I4 > 0 THEN k11 / I4 ELSE 0.0::DOUBLE END AS k21, 0.0::DOUBLE + k12 + 1 AS k22 FROM l1",
        "l3": f"""SELECT *, CASE WHEN k21 > 1000 THEN (k21 + k12) * 2 ELSE CAST({seed} AS DOUBLE) + 5 END AS k31,
            greatest(k11, k21, 0.0::DOUBLE) - least(k12, 3.0::DOUBLE) AS k32 FROM l2""",
    }


def _stored(value: str) -> str:
    """A double as it is stored, with twelve decimals."""
    return f"{value}::VARCHAR::DECIMAL(36,12)::VARCHAR"


def _values_sql(**options: str) -> str:
    return typed(
        with_ctes(
            ["formula_values"],
            f"""SELECT site_code, date_key, kpi_id, kpi_dim_id, {_stored("v")} AS value FROM (
                 SELECT site_code, date_key, 'K1' AS kpi_id, 1 AS kpi_dim_id, k11 AS v FROM l3 UNION ALL SELECT site_code, date_key, 'K1', 2, k12 FROM l3
                 UNION ALL SELECT site_code, date_key, 'K2', 1, k21 FROM l3 UNION ALL SELECT site_code, date_key, 'K2', 2, k22 FROM l3
                 UNION ALL SELECT site_code, date_key, 'K3', 1, k31 FROM l3 UNION ALL SELECT site_code, date_key, 'K3', 2, k32 FROM l3
                 UNION ALL SELECT site_code, date_key, 'K3', 3, k33 FROM l3)""",
            _levels_sql(**options),
        ),
        text="date_key",
        integer="kpi_dim_id",
    )


_IF_RETURNED = "CASE WHEN I4 > 0 THEN {} ELSE 0 END"
_ID_NAMES = {"K1": "Unit price", "K2": "Per return", "K3": "Spread"}  # greatest name per id, as no sequence is given


def _shown(text: str) -> str:
    return re.sub(r"(K\d+)_\d+", lambda m: f"`{_ID_NAMES.get(m.group(1), m.group(1))}`", text.strip())


_NAMES_SQL = " UNION ALL ".join(
    f"SELECT s_suppkey AS site_code, '{k}' AS kpi_id, CAST({d} AS INTEGER) AS kpi_dim_id, '{_shown(text)}' AS resolved_formula_names FROM supplier"
    for k, d, level, _, text in DEFINITIONS
    if level != "n/a"
)
_STAMPED_SQL = typed(
    with_ctes(
        ["formula_values"],
        f"""SELECT sha256(d.matrix_id || '||' || CAST(date_key AS VARCHAR)) AS kpi_engine_key, d.matrix_id, date_key,
              year(date_key + INTERVAL 6 MONTH) AS fiscal_year, month(date_key + INTERVAL 6 MONTH) AS fiscal_month, d.sort_key, d.execution_level,
              d.kpi_name, d.resolved_formula_names, '{RUN_1}.000' AS created_date, 'loader' AS created_by, site_code
            FROM formula_values JOIN (VALUES """
        + ", ".join(
            f"('{k}_{d}', CAST({k[1:]} AS DOUBLE), CAST({level} AS DOUBLE), '{n}', '{_shown(text)}', 1)"
            for k, d, level, n, text in DEFINITIONS
            if level != "n/a"
        )
        + ") d(matrix_id, sort_key, execution_level, kpi_name, resolved_formula_names, one) ON d.one = 1",
    ),
    text="date_key",
    integer="fiscal_year fiscal_month",
)
# what each formula shows with its operands; references that are missing or later show 0 or 0.0
_OPERANDS = {
    "K1_1": "I1::VARCHAR || ' - ' || I3::VARCHAR",
    "K1_2": "I1::VARCHAR || ' / ' || I2::VARCHAR",
    "K2_1": "k11::VARCHAR || ' / ' || CASE WHEN I4 > 0 THEN I4::VARCHAR ELSE '0.0' END",
    "K2_2": "'0.0 + ' || k12::VARCHAR || ' + 1'",
    "K3_1": "'(' || k21::VARCHAR || ' + ' || k12::VARCHAR || ') * 2 if ' || k21::VARCHAR || ' > 1000 else 0 + 5'",
    "K3_2": "'max(' || k11::VARCHAR || ', ' || k21::VARCHAR || ', 0) - min(' || k12::VARCHAR || ', 3)'",
    "K3_3": "''",
}
_CORRECTED = {"K1_1": "+250.500000000000000 [ADJ]", "K3_3": "-1.000000000000000 [ADJ]"}


def _audit_sql() -> str:
    rows = []
    for k, d, level, name, text in DEFINITIONS:
        if level == "n/a":
            continue
        key, shown = f"{k}_{d}", _OPERANDS[f"{k}_{d}"]
        if key in _CORRECTED:
            marked = f"'{_CORRECTED[key]}'" if shown == "''" else f"'(' || {shown} || ') {_CORRECTED[key]}'"
            shown = f"CASE WHEN I4 > 0 THEN {marked} ELSE {shown} END"
        rows.append(
            f"""SELECT sha256('{key}||' || CAST(date_key AS VARCHAR)) AS kpi_engine_key, '{key}' AS matrix_id, date_key, year(date_key + INTERVAL 6 MONTH) AS fiscal_year,
              month(date_key + INTERVAL 6 MONTH) AS fiscal_month, '{k}' AS kpi_id, {d} AS kpi_dim_id, NULL::VARCHAR AS dim_name, {k[1:]}::DOUBLE AS sort_key, {level}::DOUBLE AS execution_level,
              'cat' AS category, 'sub' AS subcategory, '{name}' AS kpi_name, '{text.strip()}' AS python_formula, 'USD' AS uom, {_stored(f"k{k[1:]}{d}")} AS value,
              {shown} AS resolved_formula, 'model' AS source, '{_shown(text)}' AS resolved_formula_names, '{RUN_1}.000' AS created_date, 'loader' AS created_by, site_code FROM l3"""
        )
    levels = _levels_sql(adj=_IF_RETURNED.format(250.5), empty=_IF_RETURNED.format(-1.0))
    return typed(with_ctes(["formula_values"], " UNION ALL ".join(rows), levels), text="date_key", integer="fiscal_year fiscal_month kpi_dim_id")


_SCOPES = "SELECT COUNT(*) AS n FROM (SELECT DISTINCT l_suppkey, date_trunc('month', l_shipdate) FROM lineitem)"

QUERIES = {
    "formula_levels": (formula_levels, _values_sql()),
    "formula_adjusted": (formula_adjusted, _values_sql(adj=_IF_RETURNED.format(250.5), empty=_IF_RETURNED.format(-1.0))),
    "formula_seeded": (formula_seeded, _values_sql(seed=_IF_RETURNED.format("I4"))),
    "formula_missing_log": (
        formula_missing_log,
        typed(
            with_ctes(["formula_values"], "SELECT site_code, date_key, 'K9' AS kpi_id, 9 AS kpi_dim_id, 'Missing KPI dependency → 0' AS reason FROM formula_values"),
            text="date_key",
            bigint="kpi_dim_id",
        ),
    ),
    "formula_stamped": (formula_stamped, _STAMPED_SQL),
    "formula_audit_text": (formula_audit_text, _audit_sql()),
    "formula_names": (formula_names, _NAMES_SQL),
    "formula_skipped": (formula_skipped, "SELECT s_suppkey AS site_code, 'K4' AS kpi_id, CAST(1 AS INTEGER) AS kpi_dim_id, 'Unused' AS kpi_name FROM supplier"),
    "run_summary": (
        summary,
        f"SELECT 'calculated' AS metric, n * 7 AS n FROM ({_SCOPES}) UNION ALL SELECT 'missing', n FROM ({_SCOPES}) UNION ALL SELECT 'skipped', COUNT(*) FROM supplier",
    ),
}
