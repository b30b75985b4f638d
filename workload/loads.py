"""Queries over warehouse loads: stages, upserts, dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import merge as m
from ledgerloom.plans.loads import Load, create, next_state, view
from ledgerloom.sources.durable import durable
from ledgerloom.sources.schemas import ColumnSpec
from workload.fixtures import FIRST_LOAD, RUN_1, RUN_2, Tables, as_ts, typed, with_ctes

END = "2999-12-31 00:00:00.000"


def _loaded(load: Load, *args) -> DataFrame:
    """The table after a first load, stored as any loaded table is."""
    return durable(next_state(load, *args))


# --- stages and views -----------------------------------------------------------------------

PARTY = (
    ColumnSpec("nation_key", "int", "nation_key"),
    ColumnSpec("kind", "string", "kind", nullable=False, default="'none'"),
    ColumnSpec("in_debt", "boolean", "balance < 0", comment="owes money"),
)


def _parties(t: Tables) -> list[DataFrame]:
    return [
        t.customer.select(F.col("c_nationkey").alias("nation_key"), F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("kind"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.col("s_nationkey").alias("nation_key"), F.lit("SUPPLIER").alias("kind"), F.col("s_acctbal").alias("balance")),
    ]


_CUSTOMERS = "SELECT c_nationkey AS nation_key, COALESCE(nullif(c_mktsegment, 'FURNITURE'), 'none') AS kind, c_acctbal < 0 AS in_debt FROM customer"
_SUPPLIERS = "SELECT s_nationkey AS nation_key, 'SUPPLIER' AS kind, s_acctbal < 0 AS in_debt FROM supplier"


def _stage(t: Tables, **options) -> DataFrame:
    load = Load("party", "stage", PARTY, **options)
    return next_state(load, create(t.spark, load), _parties(t), as_ts(RUN_1))


def stage_union(t: Tables) -> DataFrame:
    return _stage(t, strategy="UNION")


def stage_union_all(t: Tables) -> DataFrame:
    return _stage(t, strategy="UNION ALL")


def stage_insert(t: Tables) -> DataFrame:
    """One insert per source into a stage that keeps its rows: the customers of an earlier load are there already."""
    load = Load("party", "stage", PARTY, strategy="INSERT", truncate_before=False)
    first = _loaded(load, create(t.spark, load), _parties(t)[:1], as_ts(RUN_1))
    return next_state(load, first, _parties(t), as_ts(RUN_2))


def view_distinct(t: Tables) -> DataFrame:
    return view(Load("v_party", "view", PARTY, strategy="UNION ALL", distinct=True), _parties(t))


DIMENSION = (
    ColumnSpec("party_key", "bigint"),
    ColumnSpec("nation_key", "int"),
    ColumnSpec("kind", "string"),
    ColumnSpec("version", "bigint"),
    ColumnSpec("is_current", "string"),
    ColumnSpec("created", "timestamp"),
    ColumnSpec("updated", "timestamp"),
)
DIMENSION_ROLES = m.Columns(("nation_key",), (), "party_key", "version", "is_current", None, None, "created", "updated")


def dimension_view(t: Tables) -> DataFrame:
    return view(Load("v_dim", "dimension", DIMENSION, DIMENSION_ROLES), _parties(t))


_DIMENSION_VIEW = " UNION ALL ".join(
    f"""SELECT CAST(NULL AS BIGINT) AS party_key, nation_key, kind, CAST(1 AS BIGINT) AS version, 'Y' AS is_current,
        CAST(NULL AS VARCHAR) AS created, CAST(NULL AS VARCHAR) AS updated FROM ({q})"""
    for q in (_CUSTOMERS.replace("COALESCE(nullif(c_mktsegment, 'FURNITURE'), 'none')", "nullif(c_mktsegment, 'FURNITURE')"), _SUPPLIERS)
)

# --- facts ----------------------------------------------------------------------------------

ORDER_FACT = (
    ColumnSpec("order_key", "bigint"),
    ColumnSpec("amount", "decimal(28,2)"),
    ColumnSpec("n_lines", "bigint"),
    ColumnSpec("created", "timestamp"),
    ColumnSpec("updated", "timestamp"),
)
FACT_ROLES = m.Columns(("order_key",), created="created", updated="updated")


def fact_upsert(t: Tables) -> DataFrame:
    """First load: finished lines only; second load: all lines. Orders change, stay or appear."""
    load = Load("order_fact", "fact", ORDER_FACT, FACT_ROLES)
    first = _loaded(load, create(t.spark, load), [t.order_totals("F")], as_ts(RUN_1))
    return next_state(load, first, [t.order_totals()], as_ts(RUN_2))


FACT_UPSERT = typed(
    with_ctes(
        ["totals_f", "totals_all"],
        f"""SELECT a.order_key, a.amount, a.n_lines, CASE WHEN f.order_key IS NULL THEN '{RUN_2}.000' ELSE '{RUN_1}.000' END AS created,
            CASE WHEN f.order_key IS NULL OR a.amount <> f.amount OR a.n_lines <> f.n_lines THEN '{RUN_2}.000' ELSE '{RUN_1}.000' END AS updated
            FROM totals_all a LEFT JOIN totals_f f ON a.order_key = f.order_key""",
    ),
    double="amount",
    bigint="n_lines",
)


def _adjustment_states(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Adjustment table after version 1 (large values adjusted by hand), and the drafts of version 2."""
    rows = t.engine_history.select(
        "kpi_engine_key", F.col("date_key").alias("month_date"), F.lit("ACTUAL").alias("scenario"), "version_id", "kpi_name",
        F.col("value").alias("original_value"),
    )
    adjusted = F.when(F.col("original_value") > 30000, F.col("original_value") + 1).cast("decimal(28,2)").alias("adjusted_value")
    old = rows.filter("version_id = 1").select("kpi_engine_key", "month_date", "scenario", "original_value", adjusted, F.lit("old").alias("kpi_name"))
    new = rows.filter("version_id = 2").select("kpi_engine_key", "month_date", "scenario", "original_value", F.lit(None).cast("decimal(28,2)").alias("adjusted_value"), "kpi_name")
    return old, new


ADJUSTMENT_KEYS = ("kpi_engine_key", "month_date", "scenario")


def protected_upsert(t: Tables) -> DataFrame:
    old, new = _adjustment_states(t)
    return m.upsert_protected(old, new, ADJUSTMENT_KEYS, ["original_value", "kpi_name"])


def column_list_upsert(t: Tables) -> DataFrame:
    old, new = _adjustment_states(t)
    return m.upsert_columns(old, new, ADJUSTMENT_KEYS[:2], ["kpi_name"])


def insert_only(t: Tables) -> DataFrame:
    old, new = _adjustment_states(t)
    return m.insert_only(old, new.drop("adjusted_value"))


_STATES = {
    "old": """SELECT kpi_engine_key, date_key AS month_date, 'ACTUAL' AS scenario, value AS original_value,
        CAST(CASE WHEN value > 30000 THEN value + 1 END AS DECIMAL(18,2)) AS adjusted_value, 'old' AS kpi_name FROM engine_history WHERE version_id = 1""",
    "new": """SELECT kpi_engine_key, date_key AS month_date, 'ACTUAL' AS scenario, value AS original_value,
        CAST(NULL AS DECIMAL(18,2)) AS adjusted_value, kpi_name FROM engine_history WHERE version_id = 2""",
}


def _upsert_sql(original: str) -> str:
    body = f"""SELECT kpi_engine_key, month_date, scenario, {original} AS original_value, o.adjusted_value AS adjusted_value,
          COALESCE(n.kpi_name, o.kpi_name) AS kpi_name
        FROM old o FULL OUTER JOIN new n USING (kpi_engine_key, month_date, scenario)"""
    return typed(with_ctes(["engine_history"], body, _STATES), double="original_value adjusted_value", text="month_date")


def append_load(t: Tables) -> DataFrame:
    """No business key: each load adds all its rows as version 1, numbered on."""
    load = Load("log", "persistent_stage", DIMENSION, m.Columns((), (), "party_key", "version", "is_current", None, None, "created", "updated"))
    customers, suppliers = _parties(t)
    first = _loaded(load, create(t.spark, load), [customers], as_ts(RUN_1))
    return next_state(load, first, [suppliers], as_ts(RUN_2))


_APPEND = f"""SELECT row_number() OVER (ORDER BY nation_key, kind NULLS FIRST) AS party_key, nation_key, kind, CAST(1 AS BIGINT) AS version, 'Y' AS is_current,
      '{RUN_1}.000' AS created, '{RUN_1}.000' AS updated FROM (SELECT c_nationkey AS nation_key, nullif(c_mktsegment, 'FURNITURE') AS kind FROM customer)
    UNION ALL SELECT (SELECT COUNT(*) FROM customer) + row_number() OVER (ORDER BY nation_key), nation_key, kind, CAST(1 AS BIGINT), 'Y',
      '{RUN_2}.000', '{RUN_2}.000' FROM ({_SUPPLIERS})"""

# --- dimensions -----------------------------------------------------------------------------


def _customer_columns(tracked: bool) -> tuple[list[ColumnSpec], m.Columns]:
    columns = [
        ColumnSpec("customer_key", "bigint"), ColumnSpec("cust_key", "bigint"), ColumnSpec("last_priority", "string"),
        ColumnSpec("n_orders", "bigint"), ColumnSpec("version", "bigint"), ColumnSpec("is_current", "string"),
        ColumnSpec("valid_from", "timestamp"), ColumnSpec("valid_to", "timestamp"), ColumnSpec("created", "timestamp"),
        ColumnSpec("updated", "timestamp"),
    ]
    roles = m.Columns(("cust_key",), ("last_priority",) if tracked else (), "customer_key", "version", "is_current", "valid_from", "valid_to", "created", "updated")
    return columns, roles


def _two_loads(t: Tables, kind: str, tracked: bool, drop: tuple[str, ...] = ()) -> DataFrame:
    columns, roles = _customer_columns(tracked)
    load = Load("customer", kind, [c for c in columns if c.name not in drop], roles)
    first = _loaded(load, create(t.spark, load), [t.customer_state(FIRST_LOAD).drop(*drop)], as_ts(RUN_1))
    return next_state(load, first, [t.customer_state().drop(*drop)], as_ts(RUN_2))


def scd1_dimension(t: Tables) -> DataFrame:
    return _two_loads(t, "dimension", False)


def scd2_dimension(t: Tables) -> DataFrame:
    return _two_loads(t, "dimension", True)


def scd2_persistent_stage(t: Tables) -> DataFrame:
    """Without a type-1 column: unchanged current rows are touched all the same."""
    return _two_loads(t, "persistent_stage", True, ("n_orders",))


_FIRST = "SELECT *, row_number() OVER (ORDER BY cust_key) AS customer_key FROM state_1"
_SCD1 = typed(
    with_ctes(
        ["state_1", "state_2"],
        f"""SELECT f.customer_key, s.cust_key, s.last_priority, s.n_orders, 1 AS version, 'Y' AS is_current, '{RUN_1}.000' AS valid_from, '{END}' AS valid_to,
              '{RUN_1}.000' AS created, CASE WHEN s.last_priority <> f.last_priority OR s.n_orders <> f.n_orders THEN '{RUN_2}.000' ELSE '{RUN_1}.000' END AS updated
            FROM state_2 s JOIN first f ON s.cust_key = f.cust_key
            UNION ALL SELECT (SELECT COUNT(*) FROM state_1) + row_number() OVER (ORDER BY cust_key), cust_key, last_priority, n_orders, 1, 'Y', '{RUN_2}.000', '{END}',
              '{RUN_2}.000', '{RUN_2}.000' FROM state_2 ANTI JOIN state_1 USING (cust_key)""",
        {"first": _FIRST},
    ),
    bigint="version customer_key n_orders",
)


def _scd2_sql(n_orders: bool) -> str:
    old_n, new_n = ("f.n_orders, ", "s.n_orders, ") if n_orders else ("", "")
    touched = "s.n_orders <> f.n_orders" if n_orders else "TRUE"
    body = f"""
      SELECT f.customer_key, f.cust_key, f.last_priority, {old_n}1 AS version, 'N' AS is_current, '{RUN_1}.000' AS valid_from, '2024-01-31 23:59:59.999' AS valid_to,
        '{RUN_1}.000' AS created, '{RUN_1}.000' AS updated FROM first f JOIN state_2 s ON f.cust_key = s.cust_key WHERE f.last_priority <> s.last_priority
      UNION ALL SELECT f.customer_key, f.cust_key, f.last_priority, {new_n}1, 'Y', '{RUN_1}.000', '{END}', '{RUN_1}.000',
        CASE WHEN {touched} THEN '{RUN_2}.000' ELSE '{RUN_1}.000' END FROM first f JOIN state_2 s ON f.cust_key = s.cust_key WHERE f.last_priority = s.last_priority
      UNION ALL SELECT (SELECT COUNT(*) FROM state_1) + row_number() OVER (ORDER BY s.cust_key), s.cust_key, s.last_priority, {new_n}
        CASE WHEN f.cust_key IS NULL THEN 1 ELSE 2 END, 'Y', '{RUN_2}.000', '{END}', '{RUN_2}.000', '{RUN_2}.000'
        FROM state_2 s LEFT JOIN first f ON s.cust_key = f.cust_key WHERE f.cust_key IS NULL OR f.last_priority <> s.last_priority"""
    return typed(with_ctes(["state_1", "state_2"], body, {"first": _FIRST}), bigint="version customer_key" + (" n_orders" if n_orders else ""))


QUERIES = {
    "stage_union": (stage_union, f"{_CUSTOMERS} UNION {_SUPPLIERS}"),
    "stage_union_all": (stage_union_all, f"{_CUSTOMERS} UNION ALL {_SUPPLIERS}"),
    "stage_insert": (stage_insert, f"{_CUSTOMERS} UNION ALL {_CUSTOMERS} UNION ALL {_SUPPLIERS}"),
    "view_distinct": (view_distinct, f"SELECT DISTINCT * FROM ({_CUSTOMERS}) UNION ALL SELECT DISTINCT * FROM ({_SUPPLIERS})"),
    "dimension_view": (dimension_view, _DIMENSION_VIEW),
    "fact_upsert": (fact_upsert, FACT_UPSERT),
    "protected_upsert": (protected_upsert, _upsert_sql("CASE WHEN n.kpi_name IS NOT NULL AND o.adjusted_value IS NULL THEN n.original_value ELSE o.original_value END")),
    "column_list_upsert": (column_list_upsert, _upsert_sql("COALESCE(o.original_value, n.original_value)")),
    "insert_only": (insert_only, typed(with_ctes(["engine_history"], "SELECT * FROM old UNION ALL SELECT * FROM new", _STATES), double="original_value adjusted_value", text="month_date")),
    "append_load": (append_load, _APPEND),
    "scd1_dimension": (scd1_dimension, _SCD1),
    "scd2_dimension": (scd2_dimension, _scd2_sql(True)),
    "scd2_persistent_stage": (scd2_persistent_stage, _scd2_sql(False)),
}
