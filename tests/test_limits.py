"""Large amounts, many files, odd digits and repeated keys: exact results or an error, never a silent difference."""

from decimal import Decimal

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from ledgerloom.operators import adjustments as adj
from ledgerloom.operators import engine as en
from ledgerloom.operators import merge as m
from ledgerloom.operators.overlay import overlay_chain
from ledgerloom.sources import files


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.ansi.enabled")


def test_corrections_with_fractions_and_large_values(spark, ansi):
    data = [("k1", "1", "2.5"), ("k1", "1.5", "7"), ("k1", "1.0", "1"), ("k2", "1", "1e30"), ("k2", "1", "1"), ("k3", "1", "n/a"), ("k3", "1", None)]
    got = adj.kpi_adjustments(spark.createDataFrame(data, "kpi_id string, kpi_dim_id string, value string"))
    assert rows(got) == [("K1_1", 3.5), ("K2_1", 1e30), ("K3_1", 0.0)]



@pytest.mark.parametrize("x", ["0", "-0.000000000001", "123456789012345678901234.123456789012", "-999999999999999999999999.999999999999", "12.5", None])
def test_whole_and_part_round_trip(spark, x):
    df = spark.createDataFrame([(None if x is None else Decimal(x),)], "v decimal(36,12)")
    got = df.select(adj.measure_of(*adj.whole_and_part(F.col("v"))).alias("v")).first()[0]
    assert got == (None if x is None else Decimal(x))


def test_many_listings_of_an_account(spark, ansi):
    gl = spark.createDataFrame([("i1", "7", 2026, 1, Decimal("2.000000000001"))], "input_ref string, gl_account string, fiscal_year int, fiscal_month int, measure_value decimal(36,12)")
    tb = spark.range(1_000_001).select(F.lit("7").alias("account_number"), F.when(F.col("id") == 0, F.lit(1)).cast("decimal(36,12)").alias("current_movement"))
    assert adj.trial_balance_override(gl, tb).first()["value"] == Decimal("2000001.000001000000")


def test_too_large_amounts_raise(spark, ansi):
    gl = spark.createDataFrame([("i1", "7", 2026, 1, Decimal(10) ** 23)], "input_ref string, gl_account string, fiscal_year int, fiscal_month int, measure_value decimal(36,12)")
    tb = spark.range(50).select(F.lit("7").alias("account_number"), F.when(F.col("id") == 0, F.lit(1)).cast("decimal(36,12)").alias("current_movement"))
    with pytest.raises(Exception, match="exact decimal"):
        adj.trial_balance_override(gl, tb).collect()


def test_ten_files_stack_in_order(spark, tmp_path):
    frames = []
    for i in range(10):
        path = tmp_path / "2026" / "04" / "plan" / f"f{i}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("i_ref_values,scr_value\n" + f"I1,{i}\nI2,{10 - i}\nI1,{i}.5\n")
        frames.append(files.read_period_file(spark, str(path), 2026, 4))
    got = overlay_chain([files.input_rows(files.stacked_files(frames), 2026, 4)])
    assert rows(got.select("input_ref", "value")) == [("I1", "9.5"), ("I2", "1")]


def test_a_folder_of_files_keeps_its_order(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"part{i}.csv").write_text("i_ref_values,scr_value\n" + "".join(f"I1,{i}-{k}\n" for k in range(50)))
    df = files.read_period_file(spark, str(tmp_path), 2026, 4)
    assert rows(overlay_chain([files.input_rows(df, 2026, 4)]).select("value")) == [("3-49",)]


def test_a_repeated_source_key_raises_whatever_is_read(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    merged = m.upsert_columns(target, source, ["k"], ["v"])
    for read in (merged.count, merged.collect, merged.select("k").collect, merged.groupBy().agg(F.max("k")).collect):
        with pytest.raises(Exception, match="more than one source row"):
            read()


def test_expired_versions_go_around_the_join(spark):
    roles = m.Columns(["k"], ["v"], None, "ver", "flag", "start", "end_", "made", "seen")
    ts = F.lit("2026-01-01 00:00:00").cast("timestamp")
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    target = m.with_system_columns(target, roles, ts)
    state = m.scd2(target, spark.createDataFrame([(1, "b")], "k int, v string"), roles, ts)
    text = state._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line]
    assert joins and rows(state.select("k", "v", "ver", "flag")) == [(1, "a", 1, "N"), (1, "b", 2, "Y")]


@pytest.mark.parametrize(("formula", "value"), [("round(I1, -3)", 12000.0), ("round(I1, -1)", 12340.0), ("round(I1, 20)", 12344.75), ("round(I1, 1)", 12344.8), ("round(I2, 18)", 1.5e-17), ("round(I1, -30)", 0.0)])
def test_any_number_of_digits(spark, formula, value):
    master = spark.createDataFrame([("S", "K1", 1, "1", "c", "s", "n", "u", formula, "x")], "site_code string, kpi_id string, kpi_dim_id int, execution_level string, category string, subcategory string, kpi_name string, uom string, python_formula string, source string")
    scopes = spark.createDataFrame([("S", "2026-04-01")], "site_code string, date_key string").withColumn("date_key", F.col("date_key").cast("date"))
    inputs = scopes.crossJoin(spark.createDataFrame([("I1", "12344.75"), ("I2", "1.5e-17")], "input_ref string, value string"))
    run = en.run_levels(master, scopes, inputs)
    got = run.results.select(F.col("value").cast("double")).first()[0]
    assert got == pytest.approx(round(value, 12))
    assert run.unsupported.count() == 0
