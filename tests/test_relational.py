import datetime as dt

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from ledgerloom.operators import adjustments as adj
from ledgerloom.operators.expectations import Expectation, ExpectationFailed, column_test_counts, completeness, run_expectations
from ledgerloom.operators.latest import (
    all_versions_pivot, duplicate_report, duplicate_rows, keep_any, keep_last, latest_in_max_year, latest_scenario_pivot, rows_at_max_version,
)
from ledgerloom.operators.numbering import assign_surrogate_keys, global_row_number
from ledgerloom.operators.overlay import overlay_chain, overlay_merge
from ledgerloom.operators.setops import union_sources


def test_keep_last_and_any(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), ("b", None, "q")], "k string, n int, v string")
    assert rows(keep_last(df, ["k"], ["n"])) == [("a", 3, None), ("b", None, "q")]
    assert keep_any(df, ["k"]).count() == 2
    assert rows(keep_last(df.select("k"), ["k"], ["k"])) == [("a",), ("b",)]


def test_latest_versions(spark):
    df = spark.createDataFrame(
        [("x", 2024, "2024-01", 1, 5), ("x", 2025, "2025-01", 1, 6), ("x", 2025, "2025-01", 2, 7), ("y", 2025, "2025-01", 1, 8)],
        "k string, fiscal_year int, date_key string, version_id int, v int",
    )
    assert rows(latest_in_max_year(df, ["k", "date_key"]).select("k", "v")) == [("x", 7), ("y", 8)]
    assert rows(rows_at_max_version(df).select("v")) == [(5,), (7,)]


def test_pivots_differ_on_old_versions(spark):
    df = spark.createDataFrame(
        [("k", "Budgets", 1, 9), ("k", "Budgets", 2, 4), ("k", "Budgets", 3, None), ("k", "Forecast", 1, 3), ("j", "Actual", 1, 1), ("k", "Other", 9, 99)],
        "k string, scenario string, version_id int, value int",
    )
    assert rows(latest_scenario_pivot(df.filter("k = 'k'"), ["k"])) == [("k", None, 3)]
    assert rows(all_versions_pivot(df, ["k"])) == [("j", 1, None, None), ("k", 9, 9, 3)]


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("c", 1), ("c", 1)], "k string, v int")
    assert rows(duplicate_rows(df, "k")) == [("a", 1), ("a", 2), ("c", 1), ("c", 1)]
    assert rows(duplicate_report(df, "k", sample=1)) == [("a", 2, 4)]


def test_numbering_is_gap_free_with_hot_key(spark):
    # a third of all rows have the same leading key
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = [tuple(r) for r in global_row_number(df, ["k", "id"], partitions=7).collect()]
    expected = sorted((0 if i % 3 == 0 else i, i) for i in range(3000))
    assert sorted((n, k, i) for k, i, n in got) == [(n + 1, k, i) for n, (k, i) in enumerate(expected)]
    assert global_row_number(df.filter("id < 0"), ["k", "id"]).count() == 0


def test_surrogate_keys_go_on_from_the_target(spark):
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    target = spark.createDataFrame([(41,)], "sk bigint")
    assert rows(assign_surrogate_keys(new, target, "sk", ["name"]).select("name", "sk")) == [("a", 42), ("b", 43)]
    empty = spark.createDataFrame([], "sk bigint")
    assert rows(assign_surrogate_keys(new, empty, "sk", ["name"]).select("name", "sk")) == [("a", 1), ("b", 2)]


INPUTS = "input_ref string, source string, value double, seq int"


def test_overlay_null_keeps_base_and_new_keys_append(spark):
    base = spark.createDataFrame([("I1", "b", 1.0, 1), (" I₂", "b", 2.0, 2), ("I2", "b", 3.0, 3)], INPUTS)
    over = spark.createDataFrame([("I1 ", None, 9.0, 1), ("I1", "o", None, 2), ("I9", None, 4.0, 3)], INPUTS)
    got = rows(overlay_merge(base, over))
    assert got == [("I1", "o", 1.0), ("I2", "b", 3.0), ("I9", None, 4.0)]
    assert rows(overlay_merge(overlay_merge(base, over), over)) == got


def test_overlay_only_columns_reach_new_keys(spark):
    base = spark.createDataFrame([("I1", 1.0)], "input_ref string, value double")
    over = spark.createDataFrame([("I1", 5.0, "n1"), ("I2", 6.0, "n2")], "input_ref string, value double, note string")
    last = spark.createDataFrame([("I1", "late")], "input_ref string, note string")
    assert rows(overlay_chain([base, over])) == [("I1", 5.0, None), ("I2", 6.0, "n2")]
    assert rows(overlay_chain([base, over, last])) == [("I1", 5.0, "late"), ("I2", 6.0, "n2")]


def test_overlay_chain_equals_stepwise_merges(spark):
    frames = [spark.createDataFrame([(f"I{i % (5 + n)}", f"s{n}" if i % 2 else None, float(i) if i % 3 else None, i) for i in range(12)], INPUTS) for n in range(4)]
    step = frames[0]
    for f in frames[1:]:
        step = overlay_merge(step, f)
    assert rows(overlay_chain(frames)) == rows(step)


def test_union_strategies(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1,), (2,)], "x int")
    assert rows(union_sources([a, b], "UNION")) == [(1,), (2,)]
    assert rows(union_sources([a, b], "UNION ALL")) == [(1,), (1,), (1,), (2,)]
    assert rows(union_sources([a, b], "UNION ALL", distinct_each=True)) == [(1,), (1,), (2,)]
    assert union_sources([a, b], "INSERT").count() == 4
    with pytest.raises(ValueError):
        union_sources([a], "EXCEPT")


def test_trial_balance_override(spark):
    gl = spark.createDataFrame(
        [("I1", "10", 2026, 9, 5.0), ("I1", "10", 2026, 9, 6.0), ("I1", "11", 2026, 9, 7.0), ("I2", "11", 2026, 9, 1.0), ("I3", "12", 2026, 9, None), ("I3", "13", 2026, 9, 2.0)],
        "input_ref string, gl_account string, fiscal_year int, fiscal_month int, measure_value double",
    )
    tb = spark.createDataFrame([(10, 100.0), (11, None), (12, 3.0), (12, 4.0), (12, None)], "account_number int, current_movement double")
    got = rows(adj.trial_balance_override(gl, tb).select("input_ref", F.col("value").cast("double"), "source"))
    # I1: both rows of account 10 overridden, account 11 keeps 7; I2 untouched; I3: 3 + 4 + NULL, and 2
    assert got == [("I1", 207.0, "trial balance adjustments"), ("I3", 9.0, "trial balance adjustments")]


def test_adjustment_sums(spark):
    df = spark.createDataFrame([(" k1", "2", "1.5"), ("K1", "2.0", "x"), ("K1", "2", "2"), ("K2", "n", "1")], "kpi_id string, kpi_dim_id string, value string")
    assert rows(adj.kpi_adjustments(df)) == [("K1_2", 3.5)]
    day = dt.date(2026, 4, 1)
    table = spark.createDataFrame(
        [("k1", 1, day, "A", 5.0), ("K1", 1, day, "A", 2.0), ("K1", 1, day, "A", None), ("K1", 1, day, "B", 9.0), ("K1", 1, dt.date(2026, 5, 1), "A", 8.0)],
        "kpi_reference string, location_column_id int, month_date date, site_code string, adjusted_value double",
    )
    assert rows(adj.table_adjustments(table, period=F.lit(day), site="A")) == [("K1_1", 7.0)]


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    counts = rows(column_test_counts(df, {"x set": "x is not null", "y known": "y in ('a', 'b')", "x big": "x > 0"}))
    assert counts == [("x big", 1, 2), ("x set", 1, 2), ("y known", 0, 2)]
    assert rows(completeness({"t": df}, "x")) == [("t", 1, 2)]
    bad = Expectation("no nulls", lambda: df.filter("x is null"), "Before")
    lenient = Expectation("no nulls", lambda: df.filter("x is null"), "Before", continue_on_failure=True)
    with pytest.raises(ExpectationFailed):
        run_expectations([bad], "Before")
    assert run_expectations([lenient], "Before") == [{"test": "no nulls", "status": "FAILED"}]
    assert run_expectations([bad], "After") == []
    assert run_expectations([bad], "Before", enabled=False) == []
