"""Queries over the file and run path: period files, filters, stored history, publishing, views, tests around a load."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import engine as en
from ledgerloom.operators.latest import keep_any
from ledgerloom.operators.overlay import overlay_chain
from ledgerloom.plans import publish
from ledgerloom.sources import files, snapshots
from ledgerloom.sources.durable import CODEC, checkpoint_dir
from workload.fixtures import Tables, money, typed, with_ctes

N_FILES = 10


def _new_path(t: Tables) -> str:
    return f"{checkpoint_dir(t.spark)}/run-path-{uuid.uuid4()}"


def period_inputs(t: Tables) -> DataFrame:
    """One site's fiscal period of the unified table, filtered in the scan."""
    table = t.lineitem.select(
        F.concat(F.lit("i"), F.col("l_partkey").cast("string")).alias("input_ref"), F.col("l_linestatus").alias("source_name"),
        F.col("l_linenumber").alias("fiscal_month"), F.col("l_suppkey").alias("fiscal_year"), F.col("l_returnflag").alias("site_code"), money("l_extendedprice").alias("measure_value"),
    )
    return files.unified_inputs(table, 7, 3, "A")


PERIOD_INPUTS = typed(
    """SELECT 'i' || CAST(l_partkey AS VARCHAR) AS input_ref, l_linestatus AS source, l_linenumber AS fin_period, CAST(l_suppkey AS INTEGER) AS fin_year,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS value FROM lineitem WHERE l_suppkey = 7 AND l_linenumber = 3 AND l_returnflag = 'A'""",
    integer="fin_period fin_year",
    text="value",
)


def stacked_period_files(t: Tables) -> DataFrame:
    """Ten stacked files, each the whole parts table with its own values: the last row of the last file counts."""
    frames = []
    for i in range(N_FILES):
        raw = files.read_period_file(t.spark, f"{t.folder}/part.parquet", 2026, 4, ["p_brand", "p_partkey"], fmt="parquet")
        frames.append(raw.select(F.col("p_brand").alias("I_Ref_Values"), (F.col("p_partkey") * N_FILES + i).alias("scr_value"), "date_key", "seq"))
    stacked = files.input_rows(files.stacked_files(frames), 2026, 4)
    return overlay_chain([stacked]).select("input_ref", "source", "fin_period", "fin_year", "value")


STACKED = f"""SELECT p_brand AS input_ref, NULL::VARCHAR AS source, 10::INTEGER AS fin_period, 2026::INTEGER AS fin_year,
    (max(p_partkey) * {N_FILES} + {N_FILES - 1})::VARCHAR AS value FROM part GROUP BY ALL"""


def tagged_files(t: Tables) -> DataFrame:
    """Historical values and manual adjustments from files, and a missing file."""
    raw = files.read_period_file(t.spark, f"{t.folder}/supplier.parquet", 2026, 4, ["s_name", "s_suppkey"], fmt="parquet").withColumnsRenamed({"s_name": "input_ref", "s_suppkey": "value"})
    missing = files.read_period_file(t.spark, f"{t.folder}/no_such_file.parquet", 2026, 4, fmt="parquet")
    parts = [files.historical_rows(raw, 2026, 4, t.spark), files.adjustment_rows(raw, 2026, 4, t.spark), files.historical_rows(missing, 2026, 4, t.spark)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("seq")


TAGGED = """SELECT trim(s_name) AS input_ref, tag AS source, 10::INTEGER AS fin_period, 2026::INTEGER AS fin_year, s_suppkey::VARCHAR AS value
    FROM supplier, (VALUES ('manual precalculated historic values'), ('manual adjustments')) tags(tag)"""


def history_stored(t: Tables) -> DataFrame:
    """A stored history with a narrower decimal and without one column, extended by two more runs and read back."""
    path = _new_path(t)
    new = t.engine_output.select("kpi_engine_key", "date_key", "value", "kpi_name")
    old = new.select("kpi_engine_key", "date_key", F.col("value").cast("decimal(18,2)").alias("value"), F.lit(1).alias("version_id"))
    old.write.option("compression", CODEC).partitionBy("date_key").parquet(path)
    for _ in range(2):
        snapshots.write_version(t.spark, new, path)
    columns = T.StructType([*new.schema.fields, T.StructField("version_id", T.IntegerType())])
    return snapshots.read_history(t.spark, path, columns).select("kpi_engine_key", "date_key", "value", "kpi_name", "version_id")


HISTORY_STORED = typed(
    with_ctes(["engine_output"], "SELECT kpi_engine_key, date_key, value, CASE WHEN v > 1 THEN kpi_name END AS kpi_name, v::INTEGER AS version_id FROM engine_output, range(1, 4) r(v)"),
    double="value",
    text="date_key",
)


def publish_with_ids(t: Tables) -> DataFrame:
    """A mart merged into its kept table: rows there keep id and adjusted value, new ones are numbered on."""
    mart = t.engine_output.select(
        "kpi_engine_key", F.col("date_key").alias("month_date"), F.lit("ACTUAL").alias("scenario"), F.col("kpi_id").alias("kpi_reference"), F.col("kpi_dim_id").cast("int").alias("location_column_id"),
        F.col("value").alias("original_value"), F.col("category").alias("kpi_category"), F.col("subcategory").alias("kpi_subcategory"), F.col("kpi_name").alias("kpi_aggregation"),
        F.col("uom").alias("unit_of_measure"), F.col("dim_name").alias("location_name"), F.lit(None).cast("string").alias("site_code"), F.year("date_key").alias("year"), F.month("date_key").alias("month"),
        "source", F.lit("ADJ").alias("adjustment_id"), F.lit(None).cast("decimal(28,2)").alias("adjusted_value"), F.lit(0).cast("bigint").alias("adj_id"),
    )
    old = mart.filter("kpi_reference = 'K1'").withColumns(
        {
            "original_value": F.lit(1).cast("decimal(28,2)"),
            "adjusted_value": F.when(F.col("location_column_id") % 2 == 0, F.lit(5).cast("decimal(28,2)")),
            "adj_id": (F.lit(1000) + F.col("location_column_id")).cast("bigint"),
        }
    )
    merged = publish.merge_value_adjustments(old, mart)
    return merged.select("kpi_engine_key", "original_value", "adjusted_value", F.when(F.col("kpi_reference") == "K1", F.col("adj_id")).otherwise(F.lit(-1)).cast("bigint").alias("adj_id"))


PUBLISH = typed(
    with_ctes(
        ["engine_output"],
        """SELECT kpi_engine_key, CASE WHEN kpi_id = 'K1' AND kpi_dim_id % 2 = 0 THEN 1 ELSE value END AS original_value,
           CASE WHEN kpi_id = 'K1' AND kpi_dim_id % 2 = 0 THEN 5 END AS adjusted_value, CASE WHEN kpi_id = 'K1' THEN 1000 + kpi_dim_id ELSE -1 END AS adj_id FROM engine_output""",
    ),
    double="original_value adjusted_value",
    bigint="adj_id",
)


def views_by_name(t: Tables) -> DataFrame:
    """Views created from a registry and read back by name; a failing one is reported."""

    def broken() -> DataFrame:
        raise ValueError("no such source")

    name = f"run_path_orders_{uuid.uuid4().hex}"
    report = files.register_views({name: lambda: t.orders.select("o_orderkey", "o_custkey"), "run_path_broken": broken})
    status = {r["view"].replace(name, "orders"): r["status"] for r in report}
    return files.read_table(t.spark, name).withColumn("report", F.lit(",".join(f"{k}={v}" for k, v in sorted(status.items()))))


def kept_any(t: Tables) -> DataFrame:
    return keep_any(t.orders.select("o_custkey", "o_orderstatus", "o_orderkey"), ["o_custkey"])


def _unsupported_master(t: Tables) -> DataFrame:
    return t.part.select(
        F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("kpi_id"),
        F.expr("array('I1 + 1', 'sum(I1)', 'I1 +', '  ', 'round(I1, -3)', 'I1.real')[cast(p_partkey % 6 as int)]").alias("python_formula"),
    )


def formula_problems(t: Tables) -> DataFrame:
    return en.unsupported_definitions(_unsupported_master(t)).select("kpi_id", "problem")


FORMULA_PROBLEMS = """SELECT 'K' || CAST(p_partkey AS VARCHAR) AS kpi_id, CASE p_partkey % 6 WHEN 2 THEN 'not an expression' ELSE 'a part is not supported' END AS problem
    FROM part WHERE p_partkey % 6 IN (1, 2, 5)"""


QUERIES = {
    "period_inputs": (period_inputs, PERIOD_INPUTS),
    "stacked_period_files": (stacked_period_files, STACKED),
    "tagged_files": (tagged_files, TAGGED),
    "history_stored": (history_stored, HISTORY_STORED),
    "publish_with_ids": (publish_with_ids, PUBLISH),
    "views_by_name": (views_by_name, "SELECT o_orderkey, o_custkey, 'orders=SUCCESS,run_path_broken=FAILED' AS report FROM orders"),
    "keep_any": (kept_any, "SELECT o_custkey, arg_max(o_orderstatus, (o_orderstatus, o_orderkey)) AS o_orderstatus, arg_max(o_orderkey, (o_orderstatus, o_orderkey)) AS o_orderkey FROM orders GROUP BY ALL"),
    "formula_problems": (formula_problems, FORMULA_PROBLEMS),
}
