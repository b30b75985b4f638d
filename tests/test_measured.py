import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from ledgerloom.operators import merge as m
from ledgerloom.operators.expectations import Expectation
from ledgerloom.plans.loads import Load, kept_table
from ledgerloom.plans.measured import LoadFailed, load_measured, measured_source
from ledgerloom.sources import views
from ledgerloom.sources.kept import NumberRange
from ledgerloom.sources.schemas import ColumnSpec, enforced, table_schema
from ledgerloom.sources.views import View, dependence_order

T0 = dt.datetime(2024, 1, 1)
COLUMNS = (
    ColumnSpec("k", "bigint", "id", tests={"positive": "k > 0", "small": "k < 100"}),
    ColumnSpec("v", "string", "upper(name)", tests={"short": "length(v) <= 3"}),
    ColumnSpec("created", "timestamp"),
    ColumnSpec("updated", "timestamp"),
)
ROLES = m.Columns(("k",), created="created", updated="updated")


def source(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id bigint, name string")


def test_a_write_measures_the_tests_and_sets_rows_aside(spark):
    seen = measured_source(source(spark, (1, "a"), (-1, "b"), (200, "toolong"), (None, "c"), (2, None)), Load("t", "fact", COLUMNS, ROLES))
    assert seen.rows == 5 and seen.failed == {"k: positive": 2, "k: small": 2, "v: short": 2}
    assert rows(seen.passed) == [(1, "A")]
    assert rows(seen.aside) == rows(source(spark, (-1, "B"), (200, "TOOLONG"), (None, "C"), (2, None)))
    nothing = measured_source(source(spark, (1, "a")).limit(0), Load("t", "fact", COLUMNS, ROLES))
    assert nothing.rows == 0 and set(nothing.failed.values()) == {0}


def test_report_of_a_load(spark, tmp_path):
    tests = [
        Expectation("source has rows", lambda: source(spark, (1, "x")).filter("id is null"), "Before"),
        Expectation("known problem", lambda: source(spark, (1, "x"), (2, "y")), "Before", continue_on_failure=True),
        Expectation("no Z", lambda: table.read().filter("v = 'Z'"), "After", continue_on_failure=True),
    ]
    load = Load("t", "fact", COLUMNS, ROLES, tests=tests)
    table = kept_table(spark, load, f"{tmp_path}/t", 4)
    got = load_measured(load, table, [source(spark, (1, "a"), (-5, "b")), source(spark, (2, "z"), (3, "wide"))], F.lit(T0))
    assert [tuple(r.values()) for r in got.report] == [
        ("Before", "source has rows", "PASSED", 0), ("Before", "known problem", "FAILED", 2), ("Load", "k: positive", "FAILED", 1), ("Load", "k: small", "PASSED", 0),
        ("Load", "v: short", "FAILED", 1), ("After", "no Z", "FAILED", 1),
    ]
    assert rows(table.read().select("k", "v")) == [(1, "A"), (2, "Z")] and rows(got.aside) == [(-5, "B"), (3, "WIDE")]


def test_a_failing_test_ends_the_load(spark, tmp_path):
    before = Load("t", "fact", COLUMNS, ROLES, tests=[Expectation("stop", lambda: source(spark, (1, "x")), "Before")])
    table = kept_table(spark, before, f"{tmp_path}/t", 4)
    with pytest.raises(LoadFailed, match="stop") as e:
        load_measured(before, table, [source(spark, (1, "a"))], F.lit(T0))
    assert e.value.report[-1]["failed_rows"] == 1
    with pytest.raises(LoadFailed, match="positive"):
        load_measured(Load("t", "fact", COLUMNS, ROLES), table, [source(spark, (0, "a"))], F.lit(T0), set_aside=False)
    assert table.read().count() == 0
    off = Load("t", "fact", COLUMNS, ROLES, tests=before.tests, tests_enabled=False)
    assert load_measured(off, table, [source(spark, (0, "a"))], F.lit(T0)).report == [] and table.read().count() == 1


TABLE = (
    ColumnSpec("id", "bigint", comment="the key"),
    ColumnSpec("k", "int", nullable=False),
    ColumnSpec("kind", "string", nullable=False, default="'none'"),
    ColumnSpec("note", "string", default="concat('as ', 'loaded')"),
    ColumnSpec("extra", "double"),
)


def test_constraints_are_enforced_when_written(spark, tmp_path):
    numbers = NumberRange(spark, f"{tmp_path}/n")
    given = spark.createDataFrame([("2", None, 9), ("1", "x", 9)], "k string, kind string, other int")
    got = enforced(given, TABLE, "id", numbers)
    assert rows(got) == [(1, 1, "x", "as loaded", None), (2, 2, "none", "as loaded", None)]
    assert got.schema["id"].metadata == {"comment": "the key"} and [f.dataType for f in got.schema.fields] == [f.dataType for f in table_schema(TABLE).fields]
    path = f"{tmp_path}/written"
    got.write.parquet(path)
    assert spark.read.parquet(path).schema["id"].metadata == {"comment": "the key"}
    for bad in (spark.createDataFrame([(None, "x")], "k int, kind string"), spark.createDataFrame([("x",)], "kind string")):
        with pytest.raises(Exception, match="k must not be NULL"):
            enforced(bad, TABLE).write.mode("overwrite").parquet(f"{tmp_path}/bad")
    with pytest.raises(ValueError, match="identity"):
        enforced(given.withColumn("id", F.lit(1)), TABLE, "id", numbers)


def test_dependence_order():
    assert dependence_order({"a": ["z"], "z": ["base"], "m": ["a", "z"], "b": []}) == (["b", "z", "a", "m"], {})
    order, cycles = dependence_order({"a": ["b"], "b": ["c"], "c": ["a"], "d": ["c"], "e": ["e"], "f": []})
    assert order == ["f"] and cycles == {"a": ["a", "b", "c", "a"], "b": ["b", "c", "a", "b"], "c": ["c", "a", "b", "c"], "e": ["e", "e"]}


def test_views_are_created_after_what_they_read(spark):
    def broken():
        raise ValueError("no such source")

    got = views.register(
        {
            "t_a": View(lambda: spark.table("t_z").filter("id > 1"), ["t_z"]), "t_z": View(lambda: spark.range(4), ["some_table"]),
            "t_b": View(lambda: spark.table("t_c"), ["t_c"]), "t_c": View(lambda: spark.table("t_b"), ["t_b"]), "t_d": View(lambda: spark.table("t_b"), ["t_b", "t_z"]),
            "t_e": View(broken), "t_f": View(lambda: spark.table("t_e"), ["t_e"]), "t_g": View(lambda: spark.table("t_f"), ["t_f"]),
        }
    )
    assert {r["view"]: r["status"] for r in got} == dict(t_a="SUCCESS", t_b="FAILED", t_c="FAILED", t_d="SKIPPED", t_e="FAILED", t_f="SKIPPED", t_g="SKIPPED", t_z="SUCCESS")
    errors = {r["view"]: r["error"] for r in got}
    assert errors["t_b"] == "reads itself: t_b -> t_c -> t_b" and errors["t_e"] == "no such source" and errors["t_g"] == "not there: t_f" and errors["t_d"] == "not there: t_b"
    assert spark.table("t_a").count() == 2
