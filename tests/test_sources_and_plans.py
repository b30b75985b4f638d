import datetime as dt
import os

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import merge as m
from ledgerloom.operators.expectations import Expectation, ExpectationFailed
from ledgerloom.plans import loads, marts, views
from ledgerloom.plans.kpi_run import Period, adjustment_source, load_period_inputs, publish, run_period
from ledgerloom.sources import files, schemas, snapshots
from ledgerloom.sources.kept import KeptTable


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_period_file_discovery_and_reading(spark, tmp_path):
    folder = f"{tmp_path}/2026/04/manual"
    put(folder, "b.csv", "Input Ref ,SCR_Value\nI1,1\n")
    put(folder, "a2.csv", " I Ref Values,SCR_Value,Source\nI₁ ,7,x\nI1,,y\nI2,3,\n")
    path = files.find_period_file(spark, str(tmp_path), 2026, 4, "manual", ".csv")
    assert path.endswith("a2.csv")
    assert files.find_period_file(spark, str(tmp_path), 2026, 4, "manual/b", ".csv").endswith("b.csv")
    assert files.find_period_file(spark, str(tmp_path), 2026, 5, "manual", ".csv") is None
    df = files.read_period_file(spark, path, 2026, 4)
    assert df.columns == ["i_ref_values", "scr_value", "source", "date_key", "seq"]
    assert df.orderBy("seq").first()["date_key"] == dt.date(2026, 4, 1)
    # blank cells stay empty text, so that they overwrite
    assert rows(files.input_rows(df, 2026, 4).select("input_ref", "source", "fin_period", "fin_year", "value")) == [
        ("I1", "x", 10, 2026, "7"), ("I1", "y", 10, 2026, ""), ("I2", "", 10, 2026, "3"),
    ]
    assert files.read_period_file(spark, None, 2026, 4) is None
    assert files.read_period_file(spark, f"{tmp_path}/nowhere.csv", 2026, 4) is None
    assert files.read_period_file(spark, path, 2026, 4, columns=["absent"]) is None
    assert files.historical_rows(None, 2026, 4, spark).isEmpty()


def test_whole_run_from_files_to_history(spark, tmp_path):
    period = Period("S", 2026, 4)
    put(f"{tmp_path}/in/2026/04/manual", "m.csv", "i_ref_values,scr_value,source\nI2,20,file\nI4,4,file\n")
    put(f"{tmp_path}/in/2026/04/hist", "h.csv", "input_ref,value\nI4,40\n")
    unified = spark.createDataFrame(
        [("I1", "src", 10, 2026, 1.0, "S"), ("I2", "src", 10, 2026, 2.0, "S"), ("I1", "src", 10, 2026, 9.0, "T"), ("I1", "src", 9, 2026, 8.0, "S")],
        "input_ref string, source_name string, fiscal_month int, fiscal_year int, measure_value double, site_code string",
    )
    gl = spark.createDataFrame([("I1", "A", 2026, 10, 3.0), ("I1", "B", 2026, 10, 4.0)], "input_ref string, gl_account string, fiscal_year int, fiscal_month int, measure_value double")
    tb = spark.createDataFrame([("A", 1.0, 0.0, 30.0, "S", 4, 2026), ("B", 1.0, 0.0, 99.0, "T", 4, 2026)], "account_number string, movement double, adjustment double, current_movement double, site_code string, month int, year int")
    inputs = load_period_inputs(spark, period, unified, f"{tmp_path}/in", ["manual", "absent"], "hist", None, gl, tb)
    got = {r["input_ref"]: (r["source"], float(r["value"])) for r in inputs.collect()}
    assert got == {"I1": ("trial balance adjustments", 34.0), "I2": ("file", 20.0), "I4": (files.HISTORIC_SOURCE, 40.0)}

    master = spark.createDataFrame(
        [("K1", 1, "1", "c", "s", "n", "u", "I1 + I2", "x"), ("K2", 1, "2", "c", "s", "n2", "u", "K1_1 * I4", "x")],
        "kpi_id string, kpi_dim_id int, execution_level string, category string, subcategory string, kpi_name string, uom string, python_formula string, source string",
    )
    corrections = spark.createDataFrame([("K1", 1, dt.date(2026, 4, 1), "S", 1.0)], "kpi_reference string, location_column_id int, month_date date, site_code string, adjusted_value double")
    run = run_period(period, master, inputs, corrections=corrections)
    current, history = f"{tmp_path}/current", f"{tmp_path}/history"
    publish(spark, run, current, history)
    publish(spark, run, current, history)
    assert rows(KeptTable(spark, current).read().select("matrix_id", F.col("value").cast("double"))) == [("K1_1", 55.0), ("K2_1", 2200.0)]
    stored = snapshots.VersionedHistory(spark, history).read()
    assert rows(stored.select("matrix_id", "version_id")) == [("K1_1", 1), ("K1_1", 2), ("K2_1", 1), ("K2_1", 2)]
    assert stored.schema["value"].dataType == T.DecimalType(36, 12)


def test_adjustment_source():
    assert adjustment_source("ba", Period("S", 2026, 4)) == "file"
    assert adjustment_source("dev", Period("S", 2026, 3)) == "file"  # fiscal 2026, month 9
    assert adjustment_source("dev", Period("S", 2026, 4)) == "table"


def test_append_version_widens_and_fills(spark):
    day, other = dt.date(2026, 4, 1), dt.date(2026, 5, 1)
    old = spark.createDataFrame([(day, 1.5, 3), (other, 2.5, 1)], "date_key date, value double, version_id int").withColumn("value", F.col("value").cast("decimal(10,2)"))
    new = spark.createDataFrame([(day, 4.0, "n"), (dt.date(2026, 6, 1), 5.0, "n")], "date_key date, value double, name string")
    got = snapshots.append_version(old, new)
    assert rows(got.select("date_key", F.col("value").cast("double"), "version_id", "name")) == [
        (day, 1.5, 3, None), (day, 4.0, 4, "n"), (other, 2.5, 1, None), (dt.date(2026, 6, 1), 5.0, 1, "n"),
    ]
    assert snapshots.append_version(None, new).first()["version_id"] == 1


def test_schema_evolution_in_stored_history(spark, tmp_path):
    path = f"{tmp_path}/h"
    a = spark.createDataFrame([(dt.date(2026, 4, 1), 1.0)], "date_key date, value double")
    b = spark.createDataFrame([(dt.date(2026, 4, 1), 2.0, "x")], "date_key date, value double, name string")
    snapshots.write_version(spark, a, path)
    snapshots.write_version(spark, b, path)
    got = snapshots.read_history(spark, path).select(F.col("value").cast("double"), "name", "version_id")
    assert rows(got) == [(1.0, None, 1), (2.0, "x", 2)]


def test_companion_tables_and_table_checks(spark):
    assert len(schemas.empty(spark, schemas.AUDIT_TRAIL).columns) == 21
    assert len(schemas.empty(spark, schemas.ANNOTATION).columns) == 14
    assert files.tables_missing(spark, ["no_such_table"]) == ["no_such_table"]
    with pytest.raises(LookupError):
        files.require_tables(spark, ["no_such_table"])


def test_views_report_failures(spark):
    ok = lambda: spark.range(2)
    report = files.register_views({"v_ok": ok, "v_bad": lambda: spark.table("no_such_table")})
    assert [(r["view"], r["status"]) for r in report] == [("v_bad", "FAILED"), ("v_ok", "SUCCESS")]
    assert spark.table("v_ok").count() == 2


COLUMNS = [
    schemas.ColumnSpec("id", "int", nullable=False, comment="key", tests={"positive": "id > 0"}),
    schemas.ColumnSpec("name", "string", "upper(label)", nullable=False, default="'?'"),
]


def test_created_table_keeps_types_and_comments(spark):
    schema = loads.create(spark, loads.Load("t", "stage", COLUMNS)).schema
    assert schema["id"].nullable is False and schema["id"].metadata == {"comment": "key"}
    assert loads.create(spark, loads.Load("t", "stage", COLUMNS, override=lambda s: s.range(3))).count() == 3


def test_stage_run_with_tests_and_sql(spark, tmp_path):
    source = spark.createDataFrame([(1, "a"), (2, None)], "id int, label string")
    before = Expectation("source has rows", lambda: source.filter("id is null"), "Before")
    load = loads.Load("t", "stage", COLUMNS, tests=[before], pre_sql=["create or replace temporary view pre as select 1 x"], post_sql=["create or replace temporary view post as select 2 x"])
    stored = []
    report = loads.run(spark, load, None, [source], F.lit(dt.datetime(2024, 1, 1)), lambda df: stored.extend(rows(df)))
    assert stored == [(1, "A"), (2, "?")]
    assert [r["status"] for r in report] == ["PASSED", "PASSED"]
    assert spark.table("post").first()["x"] == 2
    bad = spark.createDataFrame([(0, "a")], "id int, label string")
    with pytest.raises(ExpectationFailed, match="id: positive"):
        loads.run(spark, load, None, [bad], F.lit(dt.datetime(2024, 1, 1)), lambda df: None)


def test_later_sources_see_earlier_ones(spark):
    columns = [schemas.ColumnSpec("id", "int"), schemas.ColumnSpec("v", "string"), schemas.ColumnSpec("ver", "bigint"), schemas.ColumnSpec("cur", "string"), schemas.ColumnSpec("fin", "timestamp")]
    load = loads.Load("d", "dimension", columns, m.Columns(("id",), ("v",), version="ver", current_flag="cur", end="fin"))
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, "y")], "id int, v string")
    got = rows(loads.next_state(load, loads.create(spark, load), [a, b], F.lit(dt.datetime(2024, 1, 1))).select("id", "v", "ver", "cur"))
    assert got == [(1, "x", 1, "N"), (1, "y", 2, "Y")]


def test_history_variance_by_matrix_falls_back_to_plan_key(spark):
    output = spark.createDataFrame([("K1", 1, "key", 1.0, "d", "c", "s", "n")], "kpi_id string, kpi_dim_id int, kpi_engine_key string, execution_level double, dim_name string, category string, subcategory string, kpi_name string")
    day = dt.date(2026, 3, 1)
    actuals = spark.createDataFrame([("K1", "1", day, 12.0, "t", None), ("K1", "x", day, 1.0, "t", None)], "kpi_id string, kpi_dim_id string, date_key date, value double, uom string, kpi_unique_id string")
    plans = spark.createDataFrame(
        [("K1", "1", day, "Budgets", 10.0, 1, "pk"), ("K1", "1", day, "Budgets", 8.0, 2, "pk"), ("K1", "1", day, "Forecast", 0.0, 2, "pk")],
        "kpi_id string, kpi_dim_id string, date_key date, scenario string, value double, version_id int, kpi_unique_id string",
    )
    month = F.lit(dt.date(2026, 4, 1))
    by_matrix = marts.variance_history_by_matrix(output, actuals, plans, month).collect()
    assert [(r["kpi_engine_key"], r["budget_value"], r["budget_variance"], r["forecast_variance_pct"]) for r in by_matrix] == [("pk", 10.0, 2.0, None)]
    latest = marts.variance_history(output, actuals, plans, month).collect()
    assert [(r["kpi_engine_key"], r["budget_value"], r["budget_variance_pct"]) for r in latest] == [("key", 8.0, 50.0)]


def test_level_flag_unknown_first_null_last(spark):
    df = spark.createDataFrame([("g", "Site"), ("g", "Zone"), ("g", None), ("h", None), (None, "Site"), (None, "Company")], "k string, lv string")
    got = rows(views.level_flag(df, ["k"], "lv"))
    assert got == sorted([("g", "Site", 0), ("g", "Zone", 1), ("g", None, 0), ("h", None, 1), (None, "Site", 0), (None, "Company", 1)], key=lambda r: tuple((x is not None, str(x)) for x in r))
