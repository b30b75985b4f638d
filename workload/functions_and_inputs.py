"""Queries over scalar functions, filters, overlays, adjustments and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import scalar as sc
from ledgerloom.operators import adjustments as adj
from ledgerloom.operators import expectations as ex
from ledgerloom.operators.latest import duplicate_report, duplicate_rows, keep_last
from ledgerloom.operators.overlay import overlay_chain, overlay_merge
from ledgerloom.sources import files, snapshots
from workload.fixtures import Tables, money, typed, with_ctes


def fiscal_calendar(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        sc.fiscal_year(d).alias("fiscal_year"),
        sc.fiscal_month(d).alias("fiscal_month"),
        sc.fiscal_year_label(sc.fiscal_year(d)).alias("fiscal_year_label"),
        sc.month_start(d).alias("month_date"),
    )


FISCAL_CALENDAR = typed(
    """SELECT o_orderkey, year(o_orderdate + INTERVAL 6 MONTH) AS fiscal_year, month(o_orderdate + INTERVAL 6 MONTH) AS fiscal_month,
       'FY' || CAST(year(o_orderdate + INTERVAL 6 MONTH) AS VARCHAR) AS fiscal_year_label, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date
       FROM orders""",
    text="month_date",
    integer="fiscal_year fiscal_month",
)


def engine_key_hash(t: Tables) -> DataFrame:
    matrix = F.when(F.col("l_discount") > 0, sc.matrix_id(F.concat(F.lit("K"), "l_linenumber"), "l_suppkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", sc.engine_key(matrix, sc.month_start("l_shipdate")).alias("kpi_engine_key"))


ENGINE_KEY_HASH = """SELECT l_orderkey, l_linenumber, sha256(
    COALESCE(CASE WHEN l_discount > 0 THEN 'K' || CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) END, 'NA')
    || '||' || CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR)) AS kpi_engine_key FROM lineitem"""


def clean_ref(t: Tables) -> DataFrame:
    typed_ref = F.concat(F.lit("  I"), F.translate(F.col("p_partkey").cast("string"), sc.PLAIN_DIGITS, sc.SUBSCRIPT_DIGITS), F.lit(" "))
    return t.part.select("p_partkey", sc.clean_ref(typed_ref).alias("input_ref"))


CLEAN_REF = "SELECT p_partkey, 'I' || CAST(p_partkey AS VARCHAR) AS input_ref FROM part"


def decimal_round(t: Tables) -> DataFrame:
    raw = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).when(F.col("l_tax") == 0, F.lit(1e16)).otherwise(F.col("l_extendedprice"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", sc.to_measure(raw).alias("value"))


DECIMAL_ROUND = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_discount = 0 OR l_tax = 0 THEN 0.0 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS value FROM lineitem"""


def matrix_sort_key(t: Tables) -> DataFrame:
    kpi = F.concat(F.lit("KPREV"), F.col("p_size").cast("string"), F.lit("x7"))
    return t.part.select("p_partkey", sc.matrix_id(kpi, "p_partkey").alias("matrix_id"), sc.sort_key(kpi).alias("sort_key"))


MATRIX_SORT_KEY = """SELECT p_partkey, 'KPREV' || CAST(p_size AS VARCHAR) || 'x7_' || CAST(p_partkey AS VARCHAR) AS matrix_id,
    CAST(p_size AS DOUBLE) AS sort_key FROM part"""


def display_ids(t: Tables) -> DataFrame:
    y = F.year("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        sc.display_id("ADJ", y, "o_orderkey", 4).alias("adjustment_id"),
        sc.display_id("VAR", y, "o_orderkey", 5, compat=True).alias("variance_id"),
    )


DISPLAY_IDS = """SELECT o_orderkey, 'ADJ-' || CAST(year(o_orderdate) AS VARCHAR) || '-' ||
      CASE WHEN length(CAST(o_orderkey AS VARCHAR)) > 4 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 4, '0') END AS adjustment_id,
    'VAR-' || CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(o_orderkey AS VARCHAR), 5, '0') AS variance_id FROM orders"""


def key_labels(t: Tables) -> DataFrame:
    """Key normalisation, fallback, classification and default labels on one pass."""
    blank = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    source = F.when(F.col("o_orderstatus") == "F", "Calculated from other KPIs").when(F.col("o_orderstatus") == "O", "ledger")
    return t.orders.select(
        "o_orderkey",
        sc.key_text(F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit("  "))).alias("priority_key"),
        sc.blank_fallback(blank, F.lit("none")).alias("status_label"),
        sc.source_kind(source).alias("source_kind"),
        sc.or_unknown(F.when(F.col("o_orderstatus") == "O", "Finance")).alias("team"),
        sc.scenario_label(F.when(F.col("o_orderstatus") == "O", "Budgets").otherwise("Forecast")).alias("scenario"),
    )


KEY_LABELS = """SELECT o_orderkey, upper(o_orderpriority) AS priority_key,
    CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE o_orderstatus END AS status_label,
    CASE o_orderstatus WHEN 'F' THEN 'CALCULATED KPI' WHEN 'O' THEN 'BASE KPI' ELSE 'N/A' END AS source_kind,
    CASE WHEN o_orderstatus = 'O' THEN 'Finance' ELSE 'Unknown' END AS team,
    CASE WHEN o_orderstatus = 'O' THEN 'Budget' ELSE 'Forecast' END AS scenario FROM orders"""


def change_predicate(t: Tables) -> DataFrame:
    """Customers against suppliers of the same number: has the balance or nation changed?"""
    both = t.customer.join(t.supplier, F.col("c_custkey") == F.col("s_suppkey"), "left")
    return both.select(
        "c_custkey",
        sc.value_changed(F.col("c_nationkey"), F.col("s_nationkey")).alias("nation_changed"),
        sc.any_of([sc.value_changed(F.col("c_nationkey"), F.col("s_nationkey"), True), sc.value_changed(F.col("c_custkey"), F.col("s_suppkey"), True)]).alias("any_changed"),
    )


CHANGE_PREDICATE = """SELECT c_custkey, c_nationkey IS DISTINCT FROM s_nationkey AS nation_changed,
    (c_nationkey IS DISTINCT FROM s_nationkey OR c_custkey IS DISTINCT FROM s_suppkey) AS any_changed
    FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey"""


def numeric_dim_filter(t: Tables) -> DataFrame:
    return t.budget_forecast.filter(sc.numeric_text("kpi_dim_id")).select("kpi_id", "kpi_dim_id", "date_key", "scenario", "version_id", "value")


NUMERIC_DIM_FILTER = typed(
    with_ctes(["budget_forecast"], "SELECT kpi_id, kpi_dim_id, date_key, scenario, version_id, value FROM budget_forecast WHERE regexp_full_match(kpi_dim_id, '[0-9]+')"),
    double="value",
    text="date_key",
)


def try_cast_filter(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    odd = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), k)).otherwise(k)
    return t.events.select("event_id", sc.number(odd, "bigint").alias("k")).filter(F.col("k").isNotNull())


TRY_CAST_FILTER = """SELECT * FROM (SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'x' || (props->>'$.k') ELSE props->>'$.k' END AS BIGINT) AS k
    FROM events) WHERE k IS NOT NULL"""


def unified_inputs(t: Tables) -> DataFrame:
    table = t.lineitem.select(
        F.concat(F.lit(" I"), F.col("l_partkey").cast("string")).alias("input_ref"),
        F.col("l_returnflag").alias("source_name"),
        sc.fiscal_month("l_shipdate").alias("fiscal_month"),
        sc.fiscal_year("l_shipdate").alias("fiscal_year"),
        money("l_extendedprice").alias("measure_value"),
    )
    return files.unified_inputs(table)


UNIFIED_INPUTS = typed(
    """SELECT 'I' || CAST(l_partkey AS VARCHAR) AS input_ref, l_returnflag AS source, month(l_shipdate + INTERVAL 6 MONTH) AS fin_period,
       year(l_shipdate + INTERVAL 6 MONTH) AS fin_year, CAST(l_extendedprice AS DECIMAL(18,2)) AS value FROM lineitem""",
    integer="fin_period fin_year",
    text="value",
)


def trial_balance_rows(t: Tables) -> DataFrame:
    tb = t.lineitem.select(
        F.col("l_partkey").cast("string").alias("account_number"), F.col("l_extendedprice").alias("movement"),
        F.col("l_tax").alias("adjustment"), F.col("l_quantity").alias("current_movement"), F.col("l_returnflag").alias("site_code"),
        F.month("l_shipdate").alias("month"), F.year("l_shipdate").alias("year"),
    )
    return snapshots.trial_balance_snapshot(tb, 1998, 6, "A")


TRIAL_BALANCE_ROWS = """SELECT CAST(l_partkey AS VARCHAR) AS account_number, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS movement,
    l_tax AS adjustment, l_quantity AS current_movement, l_returnflag AS site_code, CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem
    WHERE year(l_shipdate) = 1998 AND month(l_shipdate) = 6 AND l_returnflag = 'A'"""


# --- overlays -------------------------------------------------------------------------------


def _overlay_sources(t: Tables) -> list[DataFrame]:
    base = t.part.select(
        F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("input_ref"), F.col("p_brand").alias("source"),
        money("p_retailprice").alias("value"), F.col("p_partkey").alias("seq"),
    )
    typed_in = t.events.select(
        F.concat(F.lit("I"), F.col("user_id").cast("string"), F.lit(" ")).alias("input_ref"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("source"),
        F.when(F.col("event_type") != "error", money("value")).alias("value"),
        F.col("event_id").alias("seq"),
    )
    subscripts = F.translate(F.col("s_suppkey").cast("string"), sc.PLAIN_DIGITS, sc.SUBSCRIPT_DIGITS)
    late = t.supplier.select(
        F.concat(F.when(F.col("s_acctbal") > 5000, "S").otherwise("I"), subscripts).alias("input_ref"),
        F.lit(None).cast("string").alias("source"),
        money("s_acctbal").alias("value"),
        F.col("s_suppkey").alias("seq"),
    )
    return [base, typed_in, late]


_OVERLAY = {
    "base": "SELECT 'I' || CAST(p_partkey AS VARCHAR) AS input_ref, p_brand AS source, CAST(p_retailprice AS DECIMAL(18,2)) AS value FROM part",
    "typed_in": """SELECT 'I' || CAST(user_id AS VARCHAR) AS input_ref, CASE WHEN event_type <> 'view' THEN event_type END AS source,
        CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2)) END AS value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "late": """SELECT CASE WHEN s_acctbal > 5000 THEN 'S' ELSE 'I' END || CAST(s_suppkey AS VARCHAR) AS input_ref, CAST(NULL AS VARCHAR) AS source,
        CAST(s_acctbal AS DECIMAL(18,2)) AS value FROM supplier""",
    "step_1": """SELECT COALESCE(b.input_ref, o.input_ref) AS input_ref, COALESCE(o.source, b.source) AS source, COALESCE(o.value, b.value) AS value
        FROM base b FULL OUTER JOIN typed_in o ON b.input_ref = o.input_ref""",
    "step_2": """SELECT COALESCE(b.input_ref, o.input_ref) AS input_ref, COALESCE(o.source, b.source) AS source, COALESCE(o.value, b.value) AS value
        FROM step_1 b FULL OUTER JOIN late o ON b.input_ref = o.input_ref""",
}


def q_overlay_merge(t: Tables) -> DataFrame:
    return overlay_merge(*_overlay_sources(t)[:2])


def q_overlay_chain(t: Tables) -> DataFrame:
    return overlay_chain(_overlay_sources(t))


# --- adjustments ----------------------------------------------------------------------------


def _ledger(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("I"), F.col("l_partkey").cast("string")).alias("input_ref"), F.col("l_suppkey").alias("gl_account"),
        sc.fiscal_year("l_shipdate").alias("fiscal_year"), sc.fiscal_month("l_shipdate").alias("fiscal_month"),
        money("l_extendedprice").alias("measure_value"),
    )


def _balance(t: Tables) -> DataFrame:
    """Every supplier account once, those with a large balance twice; no movement where the balance is small."""
    rows = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("account_number"),
        F.when(F.col("s_acctbal") >= 4000, money("s_acctbal")).alias("current_movement"),
        F.explode(F.when(F.col("s_acctbal") > 6000, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("listing"),
    )
    return rows.drop("listing")


_TB = {
    "gl": """SELECT 'I' || CAST(l_partkey AS VARCHAR) AS input_ref, l_suppkey AS account, year(l_shipdate + INTERVAL 6 MONTH) AS fy,
        month(l_shipdate + INTERVAL 6 MONTH) AS fm, CAST(l_extendedprice AS DECIMAL(18,2)) AS measure FROM lineitem""",
    "tb": """SELECT s_suppkey AS account, CASE WHEN s_acctbal >= 4000 THEN CAST(s_acctbal AS DECIMAL(18,2)) END AS movement FROM supplier
        UNION ALL SELECT s_suppkey, CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier WHERE s_acctbal > 6000""",
    "joined": "SELECT gl.*, movement FROM gl LEFT JOIN tb ON gl.account = tb.account",
    "touched": "SELECT DISTINCT input_ref, fy, fm FROM joined WHERE movement IS NOT NULL",
}
_TB_SUM = """SELECT input_ref, 'trial balance adjustments' AS source, fm AS fin_period, fy AS fin_year, SUM(COALESCE(movement, measure)) AS value
    FROM joined SEMI JOIN touched USING (input_ref, fy, fm) GROUP BY input_ref, fm, fy"""


def tb_override(t: Tables) -> DataFrame:
    return adj.trial_balance_override(_ledger(t), _balance(t))


def tb_override_legacy(t: Tables) -> DataFrame:
    balance = _balance(t).withColumnRenamed("current_movement", "value")
    return adj.trial_balance_override(_ledger(t), balance, override="value")


def affected_inputs(t: Tables) -> DataFrame:
    """Distinct inputs with at least one overridden account."""
    return adj.trial_balance_override(_ledger(t), _balance(t)).select("input_ref").distinct()


def adjustment_sum(t: Tables) -> DataFrame:
    """Corrections typed by hand: lower-case ids, dims as text (some with a fraction), values that are no number or too large for a decimal."""
    dim = F.col("o_custkey").cast("string")
    dim = F.when(F.col("o_orderkey") % 7 == 0, F.concat(dim, F.lit(".5"))).when(F.col("o_orderkey") % 5 == 0, F.concat(dim, F.lit(".0"))).otherwise(dim)
    large = F.when(F.col("o_orderkey") % 13 == 0, F.lit(str(2**100)))
    rows = t.orders.select(
        F.concat(F.lit(" k"), F.substring("o_orderpriority", 1, 1)).alias("kpi_id"),
        dim.alias("kpi_dim_id"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.coalesce(large, money("o_totalprice").cast("string"))).alias("value"),
    )
    return adj.kpi_adjustments(rows)


ADJUSTMENT_SUM = typed(
    """SELECT 'K' || substr(o_orderpriority, 1, 1) || '_' || CAST(o_custkey AS VARCHAR) AS matrix_id,
       CAST(SUM(CASE WHEN o_orderstatus = 'P' OR o_orderkey % 13 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
         + COUNT(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 13 = 0) * pow(2.0::DOUBLE, 100) AS adjustment
       FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1""",
    double="adjustment",
)


def table_adjustment_sum(t: Tables) -> DataFrame:
    return adj.table_adjustments(t.value_adjustments)


TABLE_ADJUSTMENT_SUM = typed(
    with_ctes(
        ["value_adjustments"],
        """SELECT kpi_reference || '_' || CAST(location_column_id AS VARCHAR) AS matrix_id, SUM(adjusted_value) AS adjustment
           FROM value_adjustments WHERE adjusted_value IS NOT NULL GROUP BY 1""",
    ),
    double="adjustment",
)

# --- duplicates and data tests --------------------------------------------------------------


def dedup_keep_last(t: Tables) -> DataFrame:
    return keep_last(t.events.select("user_id", "event_type", "event_id", "ts", money("value").alias("value"), "props"), ["user_id", "event_type"], ["ts", "event_id"])


DEDUP_KEEP_LAST = typed(
    """SELECT user_id, event_type, event_id, ts, CAST(value AS DECIMAL(18,2)) AS value, props FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    double="value",
    ts="ts",
)


def duplicate_top(t: Tables) -> DataFrame:
    return duplicate_report(t.lineitem.select("l_orderkey", "l_linenumber"), "l_orderkey")


DUPLICATE_TOP = """SELECT l_orderkey, key_rows, CAST(SUM(key_rows) OVER () AS BIGINT) AS duplicate_rows FROM
    (SELECT l_orderkey, COUNT(*) AS key_rows FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1) QUALIFY row_number() OVER (ORDER BY l_orderkey) <= 10"""


def duplicates_all(t: Tables) -> DataFrame:
    return duplicate_rows(t.orders.select("o_custkey", "o_orderkey"), "o_custkey")


DUPLICATES_ALL = "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)"

_TESTS = {
    "l_quantity: positive": "l_quantity > 0",
    "l_discount: at most 5 percent": "l_discount <= 0.05",
    "l_shipdate: present": "l_shipdate IS NOT NULL",
    "l_returnflag: known": "l_returnflag IN ('A', 'N')",
}


def data_tests(t: Tables) -> DataFrame:
    return ex.column_test_counts(t.lineitem, _TESTS)


DATA_TESTS = " UNION ALL ".join(
    f"SELECT '{n}' AS test, COUNT(*) FILTER (WHERE NOT ({c})) AS failed_rows, COUNT(*) AS total_rows FROM lineitem" for n, c in _TESTS.items()
)


def completeness(t: Tables) -> DataFrame:
    def known(df: DataFrame) -> DataFrame:
        return df.withColumn("uom", F.when(sc.usable_uom("uom"), F.col("uom")))

    return ex.completeness({"output": known(t.engine_output), "budget_forecast": known(t.budget_forecast)}, "uom")


COMPLETENESS = with_ctes(
    ["engine_output", "budget_forecast"],
    " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, COUNT(*) FILTER (WHERE uom NOT IN ('UOM', 'UoM', '0')) AS filled_rows, COUNT(*) AS total_rows FROM {n}"
        for label, n in (("output", "engine_output"), ("budget_forecast", "budget_forecast"))
    ),
)

QUERIES = {
    "fiscal_calendar": (fiscal_calendar, FISCAL_CALENDAR),
    "engine_key_hash": (engine_key_hash, ENGINE_KEY_HASH),
    "clean_ref": (clean_ref, CLEAN_REF),
    "decimal_round": (decimal_round, DECIMAL_ROUND),
    "matrix_sort_key": (matrix_sort_key, MATRIX_SORT_KEY),
    "display_ids": (display_ids, DISPLAY_IDS),
    "key_labels": (key_labels, KEY_LABELS),
    "change_predicate": (change_predicate, CHANGE_PREDICATE),
    "numeric_dim_filter": (numeric_dim_filter, NUMERIC_DIM_FILTER),
    "try_cast_filter": (try_cast_filter, TRY_CAST_FILTER),
    "unified_inputs": (unified_inputs, UNIFIED_INPUTS),
    "trial_balance_snapshot": (trial_balance_rows, TRIAL_BALANCE_ROWS),
    "overlay_merge": (q_overlay_merge, typed(with_ctes([], "SELECT * FROM step_1", _OVERLAY), double="value")),
    "overlay_chain": (q_overlay_chain, typed(with_ctes([], "SELECT * FROM step_2", _OVERLAY), double="value")),
    "tb_override": (tb_override, typed(with_ctes([], _TB_SUM, _TB), double="value", integer="fin_period fin_year")),
    "tb_override_legacy": (tb_override_legacy, typed(with_ctes([], _TB_SUM, _TB), double="value", integer="fin_period fin_year")),
    "affected_inputs": (affected_inputs, with_ctes([], "SELECT DISTINCT input_ref FROM touched", _TB)),
    "adjustment_sum": (adjustment_sum, ADJUSTMENT_SUM),
    "table_adjustment_sum": (table_adjustment_sum, TABLE_ADJUSTMENT_SUM),
    "dedup_keep_last": (dedup_keep_last, DEDUP_KEEP_LAST),
    "duplicate_report": (duplicate_top, DUPLICATE_TOP),
    "duplicate_rows": (duplicates_all, DUPLICATES_ALL),
    "data_tests": (data_tests, DATA_TESTS),
    "completeness": (completeness, COMPLETENESS),
}
