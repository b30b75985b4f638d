"""Queries over kept tables: touched-bucket merges, versions of interleaved runs, replacement by own rows, reserved keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import merge as m
from ledgerloom.operators.expectations import Expectation
from ledgerloom.operators.numbering import assign_surrogate_keys
from ledgerloom.plans.loads import Load, kept_table, load_kept
from ledgerloom.plans.measured import load_measured
from ledgerloom.sources import views
from ledgerloom.sources.durable import checkpoint_dir
from ledgerloom.sources.kept import KeptTable, NumberRange
from ledgerloom.sources.schemas import ColumnSpec, enforced, table_schema
from ledgerloom.sources.snapshots import VersionedHistory
from workload import loads
from workload.fixtures import FIRST_LOAD, RUN_1, RUN_2, Tables, as_ts, typed, with_ctes


def _path(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4()}"


def _changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of a later state that an earlier one does not have, as an incremental source delivers them."""
    return new.exceptAll(old)


def kept_fact_upsert(t: Tables) -> DataFrame:
    """Finished lines first; then only the orders whose totals changed or are new."""
    load = Load("order_fact", "fact", loads.ORDER_FACT, loads.FACT_ROLES)
    table = kept_table(t.spark, load, _path(t, "order-fact"), 32)
    load_kept(load, table, [t.order_totals("F")], as_ts(RUN_1))
    load_kept(load, table, [_changed(t.order_totals(), t.order_totals("F"))], as_ts(RUN_2))
    return table.read()


def kept_scd2(t: Tables) -> DataFrame:
    """The versioned dimension in a kept table, its keys from a reserved range."""
    columns, roles = loads._customer_columns(True)
    load = Load("customer", "dimension", columns, roles)
    path = _path(t, "customer")
    table, numbers = kept_table(t.spark, load, path, 32), NumberRange(t.spark, f"{path}/numbers")
    load_kept(load, table, [t.customer_state(FIRST_LOAD)], as_ts(RUN_1), numbers)
    load_kept(load, table, [t.customer_state()], as_ts(RUN_2), numbers)
    return table.read()


def kept_column_upsert(t: Tables) -> DataFrame:
    """The upsert of listed columns, over the touched buckets of a kept table."""
    old, new = loads._adjustment_states(t)
    keys = list(loads.ADJUSTMENT_KEYS[:2])
    table = KeptTable(t.spark, _path(t, "adjustments"), old.schema, keys, 32)
    table.replace(old)
    table.merge(new.select(*keys), lambda rows: m.upsert_columns(rows, new, keys, ["kpi_name"]))
    return table.read()


def versions_of_interleaved_runs(t: Tables) -> DataFrame:
    """Two runs stage at the same time and commit one after the other, a third ends before its commit."""
    rows = t.engine_output.select("kpi_engine_key", "date_key", "value")
    history = VersionedHistory(t.spark, _path(t, "history"))
    history.append(rows)
    one = history.stage(rows.withColumn("value", F.col("value") + 1))
    two = history.stage(rows.withColumn("value", F.col("value") + 2))
    history.stage(rows.withColumn("value", F.lit(-1)))
    history.commit(two)
    history.commit(one)
    return history.read().select("kpi_engine_key", "date_key", "value", "version_id")


VERSIONS = typed(
    with_ctes(["engine_output"], "SELECT kpi_engine_key, date_key, value + CASE v WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS value, v::INTEGER AS version_id FROM engine_output, range(1, 4) r(v)"),
    double="value",
    text="date_key",
)


def replaced_by_own_rows(t: Tables) -> DataFrame:
    """A table of lines becomes its own sums per supplier and part, then those become sums per supplier."""
    table = KeptTable(t.spark, _path(t, "lines"))
    table.replace(t.lineitem.select("l_suppkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("quantity")))
    table.replace(lambda rows: rows.groupBy("l_suppkey", "l_partkey").agg(F.sum("quantity").alias("quantity")))
    table.replace(lambda rows: rows.groupBy("l_suppkey").agg(F.sum("quantity").alias("quantity"), F.count("*").alias("parts")))
    return table.read()


def keys_of_interleaved_loads(t: Tables) -> DataFrame:
    """Customers, then suppliers and nations at the same time: each load reserves its range before either is written."""
    numbers, path = NumberRange(t.spark, _path(t, "numbers")), _path(t, "party")
    columns = [c for c in loads.DIMENSION if c.name in ("party_key", "nation_key", "kind")]
    table = KeptTable(t.spark, path, table_schema(columns), ["nation_key", "kind"], 8)
    customers, suppliers = loads._parties(t)
    nations = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("kind"))

    def numbered(rows: DataFrame) -> DataFrame:
        return assign_surrogate_keys(rows.select("nation_key", "kind"), numbers.reserve, "party_key", ["nation_key", "kind"])

    table.append(numbered(customers))
    one, two = numbered(suppliers), numbered(nations)
    table.append(two)
    table.append(one)
    return table.read()


KEYS = """SELECT row_number() OVER (ORDER BY nation_key, kind NULLS FIRST) AS party_key, nation_key, kind FROM (SELECT c_nationkey AS nation_key, nullif(c_mktsegment, 'FURNITURE') AS kind FROM customer)
    UNION ALL SELECT (SELECT COUNT(*) FROM customer) + row_number() OVER (ORDER BY s_nationkey), s_nationkey, 'SUPPLIER' FROM supplier
    UNION ALL SELECT (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM supplier) + row_number() OVER (ORDER BY n_nationkey), n_nationkey, n_name FROM nation"""


CHECKED = (
    ColumnSpec("nation_key", "int", "nation_key", tests={"in the first twenty": "nation_key < 20"}),
    ColumnSpec("kind", "string", "kind", tests={"known": "kind <> 'MACHINERY'"}),
    ColumnSpec("in_debt", "boolean", "balance < 0"),
)


def load_tests_report(t: Tables) -> DataFrame:
    """Tests before, in and after a load of customers and suppliers; what the column tests say is counted by the write."""
    table = KeptTable(t.spark, _path(t, "party"), table_schema(CHECKED))
    tests = [
        Expectation("customers have a nation", lambda: t.customer.filter("c_nationkey is null"), "Before"),
        Expectation("no debt", lambda: t.customer.filter("c_acctbal < 0"), "Before", continue_on_failure=True),
        Expectation("no debt loaded", lambda: table.read().filter("in_debt"), "After", continue_on_failure=True),
    ]
    outcome = load_measured(Load("party", "stage", CHECKED, strategy="UNION ALL", tests=tests), table, loads._parties(t), as_ts(RUN_1))
    report = t.spark.createDataFrame([tuple(r.values()) for r in outcome.report], "moment string, test string, status string, failed_rows bigint")
    for test, rows in (("rows loaded", table.read()), ("rows set aside", outcome.aside)):
        report = report.unionByName(rows.agg(F.count("*").alias("failed_rows")).select(F.lit("Load").alias("moment"), F.lit(test).alias("test"), F.lit("COUNTED").alias("status"), "failed_rows"))
    return report


LOAD_TESTS = """WITH p AS (SELECT c_nationkey AS nation_key, nullif(c_mktsegment, 'FURNITURE') AS kind, c_acctbal AS balance, TRUE AS is_customer FROM customer
      UNION ALL SELECT s_nationkey, 'SUPPLIER', s_acctbal, FALSE FROM supplier),
    q AS (SELECT *, coalesce(nation_key < 20, FALSE) AS first_ok, coalesce(kind <> 'MACHINERY', FALSE) AS kind_ok FROM p),
    r(moment, test, failed_rows) AS (
      SELECT 'Before', 'customers have a nation', count(*) FILTER (nation_key IS NULL AND is_customer) FROM q UNION ALL SELECT 'Before', 'no debt', count(*) FILTER (balance < 0 AND is_customer) FROM q
      UNION ALL SELECT 'Load', 'nation_key: in the first twenty', count(*) FILTER (NOT first_ok) FROM q UNION ALL SELECT 'Load', 'kind: known', count(*) FILTER (NOT kind_ok) FROM q
      UNION ALL SELECT 'After', 'no debt loaded', count(*) FILTER (first_ok AND kind_ok AND balance < 0) FROM q)
    SELECT moment, test, CASE WHEN failed_rows > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, failed_rows FROM r
    UNION ALL SELECT 'Load', 'rows loaded', 'COUNTED', count(*) FROM q WHERE first_ok AND kind_ok
    UNION ALL SELECT 'Load', 'rows set aside', 'COUNTED', count(*) FROM q WHERE NOT (first_ok AND kind_ok)"""

CONSTRAINED = (
    ColumnSpec("party_key", "bigint", comment="generated"),
    ColumnSpec("nation_key", "int", nullable=False),
    ColumnSpec("kind", "string", nullable=False, default="'none'"),
    ColumnSpec("note", "string", default="'as loaded'"),
)


def table_constraints(t: Tables) -> DataFrame:
    """Customers into a table with NOT NULL, defaults, an identity and a comment; then a load that breaks NOT NULL."""
    table, numbers = KeptTable(t.spark, _path(t, "constrained"), table_schema(CONSTRAINED)), NumberRange(t.spark, _path(t, "numbers"))
    rows = loads._parties(t)[0].select("nation_key", "kind")
    table.replace(enforced(rows, CONSTRAINED, "party_key", numbers))
    try:
        table.append(enforced(rows.withColumn("nation_key", F.nullif("nation_key", F.lit(3))), CONSTRAINED, "party_key", numbers))
        refused = "written"
    except Exception as e:  # noqa: BLE001 - the error is the result
        refused = "nation_key must not be NULL" if "nation_key must not be NULL" in str(e) else str(e)
    kept = table.read()
    return kept.withColumns({"comment": F.lit(kept.schema["party_key"].metadata["comment"]), "refused": F.lit(refused)})


CONSTRAINTS = """SELECT row_number() OVER (ORDER BY nation_key, kind NULLS FIRST) AS party_key, nation_key, coalesce(kind, 'none') AS kind, 'as loaded' AS note, 'generated' AS comment,
    'nation_key must not be NULL' AS refused FROM (SELECT c_nationkey AS nation_key, nullif(c_mktsegment, 'FURNITURE') AS kind FROM customer)"""


def views_by_dependence(t: Tables) -> DataFrame:
    """A chain of views whose names are in the wrong order, two that read each other, and what reads a failing one."""
    at = uuid.uuid4().hex

    def broken() -> DataFrame:
        raise ValueError("no such source")

    read = lambda name: t.spark.table(f"{name}_{at}")
    found = views.register(
        {
            f"{name}_{at}": views.View(build, [f"{r}_{at}" for r in reads])
            for name, build, reads in (
                ("a_totals", lambda: read("m_lines").groupBy("l_suppkey").agg(F.sum("quantity").alias("quantity")), ["m_lines"]),
                ("m_lines", lambda: read("z_base").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("quantity")), ["z_base"]),
                ("z_base", lambda: t.lineitem, []),
                ("c_one", lambda: read("c_two"), ["c_two"]),
                ("c_two", lambda: read("c_one"), ["c_one"]),
                ("f_root", broken, []),
                ("f_above", lambda: read("f_root"), ["f_root"]),
            )
        }
    )
    report = ", ".join(f"{r['view']} {r['status']} {r['error']}".strip() for r in found).replace(f"_{at}", "")
    return read("a_totals").withColumn("report", F.lit(report))


_VIEWS_REPORT = (
    "a_totals SUCCESS, c_one FAILED reads itself: c_one -> c_two -> c_one, c_two FAILED reads itself: c_two -> c_one -> c_two, "
    "f_above SKIPPED not there: f_root, f_root FAILED no such source, m_lines SUCCESS, z_base SUCCESS"
)
QUERIES = {
    "kept_fact_upsert": (kept_fact_upsert, loads.FACT_UPSERT),
    "kept_scd2": (kept_scd2, loads.QUERIES["scd2_dimension"][1]),
    "kept_column_upsert": (kept_column_upsert, loads.QUERIES["column_list_upsert"][1]),
    "versions_of_interleaved_runs": (versions_of_interleaved_runs, VERSIONS),
    "replaced_by_own_rows": (replaced_by_own_rows, "SELECT l_suppkey, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS quantity, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1"),
    "keys_of_interleaved_loads": (keys_of_interleaved_loads, KEYS),
    "load_tests_report": (load_tests_report, LOAD_TESTS),
    "table_constraints": (table_constraints, CONSTRAINTS),
    "views_by_dependence": (views_by_dependence, f"SELECT l_suppkey, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS quantity, '{_VIEWS_REPORT}' AS report FROM lineitem GROUP BY 1"),
}
