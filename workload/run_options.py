"""Queries over what users of a run choose: their period files, the source of corrections, active definitions, names, statements."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import merge as m
from ledgerloom.operators.engine import first_missing, prepare_definitions, run_levels
from ledgerloom.operators.expectations import Expectation
from ledgerloom.operators.overlay import overlay_chain
from ledgerloom.plans.kpi_run import Period, period_corrections
from ledgerloom.plans.loads import Load, run, view
from ledgerloom.sources import files
from ledgerloom.sources.durable import checkpoint_dir
from ledgerloom.sources.period_files import PeriodFiles, read_period_files
from ledgerloom.sources.schemas import AUDIT_TRAIL, ColumnSpec, empty
from workload.fixtures import DEFINITIONS, RUN_1, Tables, as_ts, money, typed, with_ctes

# --- period files as CSV --------------------------------------------------------------------

PARTS = 6


def _write_lines(rows: DataFrame, header: str, path: str, order: str) -> None:
    """Lines under a header, in order over several part files; cells come as they are, broken ones too."""
    lines = rows.repartitionByRange(PARTS, order).sortWithinPartitions(order).select(F.col("line").alias(header))
    lines.write.options(header=True, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def _period_files(t: Tables) -> PeriodFiles:
    """The parts table as CSV: every tenth value is blank, every eleventh record has a cell too many, every 13th one too few."""
    base, key = f"{checkpoint_dir(t.spark)}/period-files-{uuid.uuid4()}", F.col("p_partkey")
    value = F.when(key % 10 == 0, "").otherwise(key.cast("string"))
    broken = F.when(key % 11 == 0, ",x,y").when(key % 13 == 0, "").otherwise(",kept")
    plan = t.part.select("p_partkey", F.concat(F.lit(" "), "p_brand", F.lit(","), value, broken).alias("line"))
    _write_lines(plan, " I Ref Values,SCR Value,Note", f"{base}/2026/04/plan/parts_a.csv", "p_partkey")
    _write_lines(plan.withColumn("line", F.lit("never,read,this")), "Input Ref,Value,Note", f"{base}/2026/04/plan/parts_b.csv", "p_partkey")
    static = t.part.select("p_partkey", F.concat("p_type", F.lit(","), key.cast("string")).alias("line"))
    _write_lines(static, "Input Ref,Value", f"{base}/2026/04/static/base.csv", "p_partkey")
    _write_lines(static, "Value, value", f"{base}/2026/04/twice/base.csv", "p_partkey")
    return read_period_files(t.spark, base, 2026, 4, ["plan/parts", "budget/parts", "static/base", "twice/base"])


def period_csv_rows(t: Tables) -> DataFrame:
    """Working inputs from the files: the last row in file order counts, a blank cell too."""
    found = _period_files(t).rows.drop("note")
    rows = found.withColumns({"input_ref": F.coalesce("input_ref", "i_ref_values"), "value": F.coalesce("value", "scr_value")})
    return overlay_chain([files.input_rows(rows.drop("i_ref_values", "scr_value"), 2026, 4)])


_GOOD = "p_partkey % 11 <> 0 AND p_partkey % 13 <> 0"
PERIOD_CSV_ROWS = f"""SELECT input_ref, NULL::VARCHAR AS source, 10::INTEGER AS fin_period, 2026::INTEGER AS fin_year, CASE WHEN blank AND last % 10 = 0 THEN '' ELSE last::VARCHAR END AS value
    FROM (SELECT p_brand AS input_ref, max(p_partkey) AS last, true AS blank FROM part WHERE {_GOOD} GROUP BY 1
          UNION ALL SELECT p_type, max(p_partkey), false FROM part GROUP BY 1)"""


def period_csv_report(t: Tables) -> DataFrame:
    return _period_files(t).report


PERIOD_CSV_REPORT = f"""SELECT 'plan/parts' AS file, 'parts_a.csv' AS path, 2::INTEGER AS candidates, CASE WHEN bad > 0 THEN 'PARTIAL' ELSE 'LOADED' END AS status, good AS n_rows, bad AS n_rejected
      FROM (SELECT COUNT(*) FILTER (WHERE {_GOOD}) AS good, COUNT(*) FILTER (WHERE NOT ({_GOOD})) AS bad FROM part)
    UNION ALL SELECT 'budget/parts', NULL, 0, 'MISSING', 0, 0 UNION ALL SELECT 'static/base', 'base.csv', 1, 'LOADED', COUNT(*), 0 FROM part
    UNION ALL SELECT 'twice/base', 'base.csv', 1, 'UNREADABLE', 0, 0"""


def period_csv_rejected(t: Tables) -> DataFrame:
    return _period_files(t).rejected.select("file", "record")


PERIOD_CSV_REJECTED = f"""SELECT 'plan/parts' AS file, ' ' || p_brand || ',' || CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_partkey::VARCHAR END
      || CASE WHEN p_partkey % 11 = 0 THEN ',x,y' ELSE '' END AS record FROM part WHERE NOT ({_GOOD})"""

# --- corrections by environment and period --------------------------------------------------

#: Environment and period: by the table, by the file for its fiscal month, by the file for its environment.
RUNS = (("prod", Period("C1", 1996, 2)), ("prod", Period("C2", 1995, 7)), ("prod", Period("C3", 2026, 3)), ("ba", Period("C4", 1996, 2)))


def adjustment_switch(t: Tables) -> DataFrame:
    sites = t.locations.select(F.col("kpi_dim_id").alias("location_column_id"), F.col("Company_Code").alias("site_code"))
    table_rows = t.value_adjustments.join(sites, "location_column_id")
    file_rows = t.orders.select(F.lit("K2").alias("kpi_id"), F.col("o_custkey").alias("kpi_dim_id"), money("o_totalprice").cast("string").alias("value"))
    summed = []
    for environment, period in RUNS:
        corrections = period_corrections(environment, period, file_rows, table_rows)
        summed.append(corrections.select(F.lit(environment).alias("environment"), F.lit(period.site).alias("site_code"), F.lit(period.text).alias("month"), "matrix_id", "adjustment"))
    return reduce(DataFrame.unionByName, summed)


def _switch_sql() -> str:
    parts = []
    for environment, p in RUNS:
        labels = f"SELECT '{environment}' AS environment, '{p.site}' AS site_code, '{p.text}' AS month, "
        if environment == "ba" or (p.year, p.month) == (2026, 3):
            parts.append(f"{labels} 'K2_' || CAST(o_custkey AS VARCHAR) AS matrix_id, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS adjustment FROM orders GROUP BY o_custkey")
        else:
            parts.append(
                f"""{labels} kpi_reference || '_' || CAST(location_column_id AS VARCHAR) AS matrix_id, SUM(adjusted_value) AS adjustment
                FROM value_adjustments JOIN locations ON location_column_id = kpi_dim_id
                WHERE adjusted_value IS NOT NULL AND company_code = '{p.site}' AND month_date = DATE '{p.text}' GROUP BY ALL"""
            )
    return typed(with_ctes(["value_adjustments", "locations"], " UNION ALL ".join(parts)), double="adjustment")


# --- definitions ----------------------------------------------------------------------------


def definitions_active(t: Tables) -> DataFrame:
    """Definitions as typed by hand, switched off for some sites by an ``active`` column that is text."""
    flag = F.when(F.col("site_code") % 3 == 0, "0").when(F.col("site_code") % 3 == 1, " 1").when(F.col("kpi_id") == "K2", "1.0")
    typed_in = t.definitions.withColumns({"active": flag, "kpi_name": F.concat(F.lit("\t "), "kpi_name", F.lit(" ")), "uom": F.lit(None).cast("string")})
    return prepare_definitions(typed_in, ["site_code"]).select("site_code", "matrix_id", "kpi_name", "uom", "python_formula", "execution_level")


_ACTIVE = " UNION ALL ".join(
    f"""SELECT s_suppkey AS site_code, '{k}_{d}' AS matrix_id, '{name}' AS kpi_name, NULL::VARCHAR AS uom, '{text.strip()}' AS python_formula, {level}::DOUBLE AS execution_level
        FROM supplier WHERE s_suppkey % 3 = 1{" OR s_suppkey % 3 = 2" if k == "K2" else ""}"""
    for k, d, level, name, text in DEFINITIONS
    if level != "n/a"
)


def formula_dim_names(t: Tables) -> DataFrame:
    """Dimension names looked up by id; the third has none, the first has several."""
    names = t.nation.select(F.col("n_regionkey").alias("kpi_dim_id"), F.col("n_name").alias("kpi_dim_name")).filter("kpi_dim_id <> 3")
    results = run_levels(t.definitions, t.scopes, t.formula_inputs, dim_names=names, run_ts=as_ts(RUN_1), texts=False).results
    return results.select("site_code", "date_key", "matrix_id", "dim_name")


_DIM_NAMES = typed(
    with_ctes(
        ["formula_values"],
        """SELECT site_code, date_key, matrix_id, dim_name FROM formula_values, (VALUES """
        + ", ".join(f"('{k}_{d}', {d})" for k, d, level, _, _ in DEFINITIONS if level != "n/a")
        + """) d(matrix_id, dim) LEFT JOIN (SELECT n_regionkey, max(n_name) AS dim_name FROM nation WHERE n_regionkey <> 3 GROUP BY 1) ON dim = n_regionkey""",
    ),
    text="date_key",
)


def missing_head(t: Tables) -> DataFrame:
    return first_missing(run_levels(t.definitions, t.scopes, t.formula_inputs, run_ts=as_ts(RUN_1)), 20)


_MISSING_HEAD = typed(
    with_ctes(
        ["formula_values"],
        "SELECT site_code, date_key, 'K9' AS kpi_id, 9 AS kpi_dim_id, 'Missing KPI dependency → 0' AS reason FROM formula_values ORDER BY site_code, date_key LIMIT 20",
    ),
    text="date_key",
    bigint="kpi_dim_id",
)

# --- companion tables, views, statements around a load --------------------------------------


def audit_rows(t: Tables) -> DataFrame:
    """Changes of values as rows of the audit table: all its columns and types, NULL where nothing is known."""
    v = t.value_adjustments.filter("adjusted_value is not null")
    rows = v.select(
        F.col("kpi_engine_key").alias("audit_id"), F.lit("ADJUST").alias("event_type"), "kpi_reference", F.col("location_column_id").cast("int").alias("location_column_id"),
        F.col("month_date").cast("string").alias("month_date"), "scenario", F.col("original_value").cast("double").alias("old_value"),
        F.col("adjusted_value").cast("double").alias("new_value"), F.col("adjustment_reason").alias("rationale"),
    )
    return empty(t.spark, AUDIT_TRAIL).unionByName(rows, allowMissingColumns=True)


_AUDIT_ROWS = with_ctes(
    ["value_adjustments"],
    """SELECT kpi_engine_key AS audit_id, 'ADJUST' AS event_type, NULL::VARCHAR AS event_source, kpi_reference, location_column_id::INTEGER AS location_column_id,
      month_date::VARCHAR AS month_date, scenario, original_value::DOUBLE AS old_value, adjusted_value::DOUBLE AS new_value, adjustment_reason AS rationale, NULL::INTEGER AS change_id, """
    + ", ".join(f"NULL::VARCHAR AS {c}" for c in "performed_by performed_at details modify status variance_commentary location metric modified_by comments".split())
    + " FROM value_adjustments WHERE adjusted_value IS NOT NULL",
)

LOG = (
    ColumnSpec("log_key", "bigint"), ColumnSpec("cust_key", "bigint", "o_custkey"), ColumnSpec("amount", "decimal(18,2)", "o_totalprice"),
    ColumnSpec("version", "bigint"), ColumnSpec("is_current", "string"), ColumnSpec("valid_from", "timestamp"), ColumnSpec("valid_to", "timestamp"),
    ColumnSpec("created", "timestamp"), ColumnSpec("updated", "timestamp"),
)
LOG_ROLES = m.Columns(("cust_key",), ("amount",), "log_key", "version", "is_current", "valid_from", "valid_to", "created", "updated")


def persistent_stage_view(t: Tables) -> DataFrame:
    """Two sources of a persistent stage as a view: their rows, all versions the first, without keys and times."""
    paid = t.orders.filter("o_orderstatus = 'F'")
    return view(Load("v_log", "persistent_stage", LOG, LOG_ROLES), [t.orders, paid])


_STAGE_VIEW = " UNION ALL ".join(
    f"""SELECT NULL::BIGINT AS log_key, o_custkey AS cust_key, o_totalprice::DECIMAL(18,2)::DOUBLE AS amount, 1::BIGINT AS version, 'Y' AS is_current,
      NULL::VARCHAR AS valid_from, NULL::VARCHAR AS valid_to, NULL::VARCHAR AS created, NULL::VARCHAR AS updated FROM orders{where}"""
    for where in ("", " WHERE o_orderstatus = 'F'")
)


def view_override(t: Tables) -> DataFrame:
    """A view whose declaration is replaced by a statement of its own."""
    source = f"override_{uuid.uuid4().hex}"
    t.orders.createOrReplaceTempView(source)
    load = Load("v_party", "view", LOG, override=lambda spark: spark.sql(f"SELECT o_custkey AS cust_key, count(*) AS n_orders FROM {source} GROUP BY o_custkey"))
    return view(load, [], t.spark)


def load_statements(t: Tables) -> DataFrame:
    """A load between statements: its source must be there, one counts it before, one reads the stored table after."""
    tag = uuid.uuid4().hex
    source, before, after, path = f"raw_{tag}", f"before_{tag}", f"after_{tag}", f"{checkpoint_dir(t.spark)}/load-statements-{tag}"
    absent = files.tables_missing(t.spark, [source])
    t.orders.createOrReplaceTempView(source)
    files.require_tables(t.spark, [source])

    def write(df: DataFrame) -> DataFrame:
        df.write.parquet(path)
        return t.spark.read.schema(df.schema).parquet(path)

    load = Load(
        "totals", "stage", [ColumnSpec("cust_key", "bigint", "o_custkey"), ColumnSpec("amount", "decimal(18,2)", "o_totalprice", tests={"present": "amount IS NOT NULL"})],
        pre_sql=[f"CREATE OR REPLACE TEMPORARY VIEW {before} AS SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM {source}"],
        post_sql=[f"CREATE OR REPLACE TEMPORARY VIEW {after} AS SELECT count(*) AS n, sum(amount) AS total FROM parquet.`{path}`"],
        tests=[Expectation("orders have a customer", lambda: t.orders.filter("o_custkey is null"), "Before")],
    )
    report = run(t.spark, load, None, [t.spark.table(source)], as_ts(RUN_1), write)
    shown = ",".join(f"{r['test']}={r['status']}" for r in report)
    steps = [t.spark.table(v).withColumn("step", F.lit(s)) for s, v in (("before", before), ("after", after))]
    return steps[0].unionByName(steps[1]).withColumns({"report": F.lit(shown), "absent_before": F.lit(len(absent))})


_STATEMENTS = " UNION ALL ".join(
    f"""SELECT COUNT(*) AS n, SUM(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, '{s}' AS step,
      'orders have a customer=PASSED,amount: present=PASSED' AS report, 1::INTEGER AS absent_before FROM orders"""
    for s in ("before", "after")
)

QUERIES = {
    "period_csv_rows": (period_csv_rows, PERIOD_CSV_ROWS),
    "period_csv_report": (period_csv_report, typed(PERIOD_CSV_REPORT, bigint="n_rows n_rejected", integer="candidates")),
    "period_csv_rejected": (period_csv_rejected, PERIOD_CSV_REJECTED),
    "adjustment_switch": (adjustment_switch, _switch_sql()),
    "definitions_active": (definitions_active, _ACTIVE),
    "formula_dim_names": (formula_dim_names, _DIM_NAMES),
    "formula_missing_head": (missing_head, _MISSING_HEAD),
    "audit_rows": (audit_rows, _AUDIT_ROWS),
    "persistent_stage_view": (persistent_stage_view, _STAGE_VIEW),
    "view_override": (view_override, "SELECT o_custkey AS cust_key, COUNT(*) AS n_orders FROM orders GROUP BY 1"),
    "load_statements": (load_statements, _STATEMENTS),
}
