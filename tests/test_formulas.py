import datetime as dt
import math
import random
import re

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from ledgerloom.operators import engine
from ledgerloom.operators import formula as fx
from ledgerloom.operators.engine import RESULT_COLUMNS, run_levels, run_summary
from ledgerloom.sources.durable import durable

VALUES = {"K1_1": -5.0, "K2_1": 0.0, "KPREV4_10": 2.5, "I1": 1e300, "I22": 3.0, "I3": -0.75}


def by_text(formula, values):
    """Independent evaluator: put the numbers into the text and evaluate that."""
    text = re.sub(fx.ANY_REF, lambda m: str(values[m.group(0)]), formula)
    try:
        result = float(eval(text))
        return result if math.isfinite(result) else 0.0
    except Exception:
        return 0.0


def random_formula(rng, depth):
    def sub():
        return random_formula(rng, depth - 1)

    if depth == 0 or rng.random() < 0.2:
        return rng.choice([*VALUES, "2", "0.5", "3", "7", "0", "1e3"])
    k = rng.random()
    if k < 0.55:
        return f"({sub()} {rng.choice(['+', '-', '*', '/', '//', '%'])} {sub()})"
    if k < 0.7:
        return f"{sub()}{rng.choice(['+', '-', '*', '/', '**'])}{sub()}"
    if k < 0.75:
        return f"-{sub()}"
    if k < 0.83:
        return f"({sub()} if {sub()} {rng.choice(['<', '>', '==', '!=', '<=', '>='])} {sub()} else {sub()})"
    if k < 0.88:
        return f"({sub()} {rng.choice(['and', 'or'])} {sub()})"
    return rng.choice(["abs({})", "min({},1)", "max(2,{})", "round({})", "int({})", "float({})", "(not {})", "round({},2)"]).format(sub())


def evaluate(spark, formulas):
    known = F.create_map(*[x for k, v in VALUES.items() for x in (F.lit(k), F.lit(v))])
    df = spark.createDataFrame([(f,) for f in formulas], "f string").repartition(4).select("f", fx.compiled("f").alias("c"))
    return df.select("f", fx.evaluate(F.col("c"), lambda r: F.try_element_at(known, r)).alias("v"))


def test_random_formulas_match_text_evaluation(spark):
    rng = random.Random(11)
    formulas = [random_formula(rng, 3) for _ in range(400)]
    for r in evaluate(spark, formulas).collect():
        expected = by_text(r["f"], VALUES)
        assert r["v"] == expected or abs(r["v"] - expected) <= 1e-12 * abs(expected) or abs(expected) < 1e-290, r["f"]


@pytest.mark.parametrize(
    "formula, expected",
    [
        ("K1_1**2", -25.0), ("(K1_1)**2", -25.0), ("2**K1_1", 2.0**-5), ("1/0", 0.0), ("K1_1 +", 0.0), ("open('x')", 0.0), ("  ", 0.0),
        ("round(2.675,2)", 2.67), ("7 % K1_1", -3.0), ("K1_1 // 2", -3.0), ("1/K2_1 if K2_1 else 4", 4.0), ("k1_1 + 1", 0.0),
        ("I1*I1", 0.0), ("1/(I1*I1)", 0.0), ("0 and 1/0", 0.0), ("3 or 1/0", 3.0), ("1 < 2 < 3", 1.0), ("pow(2, 3)", 8.0), ("(-8)**0.5", 0.0),
    ],
)
def test_single_formulas(spark, formula, expected):
    assert evaluate(spark, [formula]).first()["v"] == expected


MASTER = "site_code string, kpi_id string, kpi_dim_id int, execution_level string, category string, subcategory string, kpi_name string, uom string, python_formula string, source string, seq int"


def definition(kpi, dim, level, text, name=None, seq=0, site="S"):
    return (site, kpi, dim, level, "c", "s", name or f"{kpi} name", "t", text, "src", seq)


def run(spark, definitions, inputs, **options):
    day = dt.date(2026, 4, 1)
    scopes = spark.createDataFrame([("S", day), ("S", dt.date(2026, 5, 1))], "site_code string, date_key date")
    given = spark.createDataFrame([("S", day, r, v, i) for i, (r, v) in enumerate(inputs)], "site_code string, date_key date, input_ref string, value string, seq int")
    master = spark.createDataFrame(definitions, MASTER)
    return run_levels(master, scopes, given, order="seq", input_order="seq", run_ts=F.lit(dt.datetime(2026, 5, 2)), run_user="u", **options)


def april(result, column="value"):
    got = result.results.filter("date_key = '2026-04-01'").collect()
    return {r["matrix_id"]: float(r[column]) if column == "value" else r[column] for r in got}


def test_levels_missing_and_fallbacks(spark):
    definitions = [
        definition("K1", 1, "1", "I1 + I2 + I99"),
        definition("K1", 2, "1", "K1_1 + 1"),  # same level: reads 0.0
        definition("K2", 1, "2", "K1_01 * 2 + K3_1"),  # later level: 0.0; leading zero in the dim
        definition("K3", 1, "3", "K2_1 + K7_7 + K7_7 + KPREV4_10"),
        definition("K4", 1, "10", "K3_1 / I3"),  # I3 is no number: error
        definition("K5", 1, None, "1"),
        definition("K6", 1, "x", "1"),
        definition("K8", 1, "2", None),
        definition("K9", 1, "2", "I3"),
    ]
    result = run(spark, definitions, [("i1 ", "10"), ("I1", "4"), ("I2", "0.5"), ("I3", "bad"), ("KPREV4_10", "100")])
    assert april(result) == {"K1_1": 4.5, "K1_2": 1.0, "K2_1": 9.0, "K3_1": 109.0, "K4_1": 0.0, "K8_1": 0.0, "K9_1": 0.0}
    texts = april(result, "resolved_formula")
    assert texts["K1_1"] == "4.0 + 0.5 + 0.0"
    assert texts["K2_1"] == "4.5 * 2 + 0.0"
    assert texts["K3_1"] == "9.0 + 0 + 0 + 100.0"
    assert texts["K4_1"] == "109.0 / nan"
    assert texts["K8_1"] == ""
    missing = rows(result.missing.filter("date_key = '2026-04-01'").select("kpi_id", "kpi_dim_id"))
    assert missing == [("K7", 7), ("K7", 7)]
    # the second month has no inputs: KPREV4_10 is missing there too
    assert result.missing.filter("date_key = '2026-05-01'").count() == 3
    assert result.results.count() == 14
    assert result.skipped.count() == 2
    assert result.results.columns == ["site_code", *RESULT_COLUMNS]
    assert rows(run_summary(result)) == [("calculated", 14), ("missing", 5), ("skipped", 2)]


def test_adjustments_reach_later_levels_and_text(spark):
    adjustments = spark.createDataFrame([("S", dt.date(2026, 4, 1), "K1_1", 0.1), ("S", dt.date(2026, 4, 1), "K8_1", -2.0)], "site_code string, date_key date, matrix_id string, adjustment double")
    definitions = [definition("K1", 1, "1", "I1"), definition("K2", 1, "2", "K1_1 * 10"), definition("K8", 1, "1", "")]
    result = run(spark, definitions, [("I1", "5")], adjustments=adjustments)
    assert april(result) == {"K1_1": 5.1, "K2_1": 51.0, "K8_1": -2.0}
    texts = april(result, "resolved_formula")
    assert texts["K1_1"] == "(5.0) +0.100000000000000 [ADJ]"
    assert texts["K8_1"] == "-2.000000000000000 [ADJ]"


def test_seeds_count_only_for_kpis_the_master_lacks(spark):
    base = spark.createDataFrame([("S", dt.date(2026, 4, 1), "k7", 7, 3.0), ("S", dt.date(2026, 4, 1), "K1", 1, 99.0)], "site_code string, date_key date, kpi_id string, kpi_dim_id int, value double")
    definitions = [definition("K1", 1, "2", "1"), definition("K2", 1, "1", "K1_1 + K7_7"), definition("K3", 1, "3", "K1_1 + K7_7")]
    result = run(spark, definitions, [], base=base)
    assert april(result) == {"K1_1": 1.0, "K2_1": 3.0, "K3_1": 4.0}


def test_last_definition_and_name_count(spark):
    definitions = [
        definition("K1", 1, "1", "1", "first", 1), definition("K1", 1, "1", "2", "second", 2), definition("K2", 1, "2", "K1_1 + K5_5", "two", 3),
    ]
    result = run(spark, definitions, [])
    got = rows(result.results.filter("date_key = '2026-04-01'").select("matrix_id", F.col("value").cast("double"), "resolved_formula_names"))
    assert got == [("K1_1", 1.0, "1"), ("K1_1", 2.0, "2"), ("K2_1", 2.0, "`second` + `K5`")]


def test_inactive_definitions_are_dropped(spark):
    master = spark.createDataFrame([definition("K1", 1, "1", "1"), definition("K2", 1, "1", "2")], MASTER)
    master = master.withColumn("active", F.when(F.col("kpi_id") == "K1", 1).otherwise(0))
    scopes = spark.createDataFrame([("S", dt.date(2026, 4, 1))], "site_code string, date_key date")
    inputs = spark.createDataFrame([], "site_code string, date_key date, input_ref string, value double")
    dims = spark.createDataFrame([(1, "Mine")], "kpi_dim_id int, kpi_dim_name string")
    result = run_levels(master, scopes, inputs, dim_names=dims)
    assert [(r["matrix_id"], r["dim_name"]) for r in result.results.collect()] == [("K1_1", "Mine")]


def test_formulas_need_a_site(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(ValueError):
        run_levels(empty, empty, empty, site=())


def test_values_are_gathered_by_hash_and_corrections_read_once(spark, monkeypatch):
    plans = []

    def kept(df, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString())
        return durable(df, **options)

    monkeypatch.setattr(engine, "durable", kept)
    one = spark.range(1).filter("id < 987654321")
    adjustments = one.select(F.lit("S").alias("site_code"), F.lit(dt.date(2026, 4, 1)).alias("date_key"), F.lit("K1_1").alias("matrix_id"), (F.col("id") + 0.5).alias("adjustment"))
    definitions = [definition("K1", 1, "1", "I1"), definition("K2", 1, "2", "K1_1 * 10"), definition("K3", 1, "3", "K2_1 + K1_1")]
    result = run(spark, definitions, [("I1", "5")], adjustments=adjustments)
    assert april(result) == {"K1_1": 5.5, "K2_1": 55.0, "K3_1": 60.5}
    levels = [p for p in plans if "aggregate(" in p and "MapInArrow" not in p and "_operands" in p]
    assert len(levels) == 3
    assert not any("ObjectHashAggregate" in p or "SortAggregate" in p for p in levels)
    assert sum("987654321" in p for p in plans) == 1


@pytest.mark.parametrize("n", [engine.SLOTS, engine.SLOTS + 1, 3 * engine.SLOTS + 2])
def test_formulas_with_many_references(spark, n):
    given = {f"I{i}": float(i) for i in range(1, n + 1) if i % 3}
    adjustments = spark.createDataFrame([("S", dt.date(2026, 4, 1), "K1_1", 0.25)], "site_code string, date_key date, matrix_id string, adjustment double")
    definitions = [definition("K1", 1, "1", " + ".join(f"I{i}" for i in range(1, n + 1))), definition("K1", 2, "1", "I1"), definition("K1", 3, "1", "")]
    result = run(spark, definitions, [(k, str(v)) for k, v in given.items()], adjustments=adjustments)
    assert april(result) == {"K1_1": sum(given.values()) + 0.25, "K1_2": 1.0, "K1_3": 0.0}
    shown = " + ".join(str(given.get(f"I{i}", 0.0)) for i in range(1, n + 1))
    assert april(result, "resolved_formula")["K1_1"] == f"({shown}) +0.250000000000000 [ADJ]"
    # without inputs in May, every operand is 0.0
    assert [float(r["value"]) for r in result.results.filter("date_key = '2026-05-01'").collect()] == [0.0] * 3


def test_null_periods_bad_values_and_repeated_definitions(spark):
    scopes = spark.createDataFrame([("S", dt.date(2026, 4, 1)), ("S", None), ("T", None)], "site_code string, date_key date")
    given = spark.createDataFrame(
        [("S", dt.date(2026, 4, 1), "I1", 2.0), ("S", None, "I1", 7.0), ("S", dt.date(2026, 4, 1), "I2", None), ("S", dt.date(2026, 6, 1), "I1", 9.0), (None, dt.date(2026, 4, 1), "I1", 9.0)],
        "site_code string, date_key date, input_ref string, value double",
    )
    same = definition("K1", 1, "1", "I1 + 1")
    master = spark.createDataFrame([same, same, definition("K1", 2, "1", "I2 + 1"), definition("K2", 1, "2", "K1_1 + K1_2"), definition("K9", 1, "1", "1", site=None)], MASTER)
    got = run_levels(master, scopes, given, run_ts=F.lit(dt.datetime(2026, 5, 2))).results
    assert sorted((r["site_code"], str(r["date_key"]), r["matrix_id"], float(r["value"]), r["resolved_formula"]) for r in got.collect()) == [
        ("S", "2026-04-01", "K1_1", 3.0, "2.0 + 1"), ("S", "2026-04-01", "K1_1", 3.0, "2.0 + 1"), ("S", "2026-04-01", "K1_2", 0.0, "nan + 1"), ("S", "2026-04-01", "K2_1", 3.0, "3.0 + 0.0"),
        ("S", "None", "K1_1", 1.0, "0.0 + 1"), ("S", "None", "K1_1", 1.0, "0.0 + 1"), ("S", "None", "K1_2", 1.0, "0.0 + 1"), ("S", "None", "K2_1", 0.0, "0.0 + 0.0"),
    ]
