"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import pytest
from tests.helpers import SF
from pyspark.sql import DataFrameWriter

from ledgerloom.operators import engine as en
from workload import check, registry
from workload.fixtures import Tables

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql_with_a_scalable_plan(spark, con, name, monkeypatch):
    written = []
    write = DataFrameWriter.parquet

    def recording(self, *args, **kwargs):
        written.append((self._df.columns, plan(self._df)))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recording)
    df = QUERIES[name](spark, SF)
    # the steps stored on the way count as much as the last one
    for columns, text in [*written, (df.columns, plan(df))]:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Window [" not in text
        # the compiler and its report, on the definition table
        assert "EvalPython" not in text or "_code" in columns or "problem" in columns
    assert check.compare(df, con, ORACLES[name]) == []


def test_period_filter_reaches_the_scan(spark):
    from ledgerloom.sources.files import period_rows

    path = f"{SF}/lineitem.parquet"
    df = spark.read.parquet(path).withColumnsRenamed({"l_linenumber": "fiscal_year", "l_returnflag": "site_code", "l_suppkey": "fiscal_month"})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(period_rows(df, 3, 4, "A").select("l_quantity"))
    assert "EqualTo(l_linenumber,3)" in text and "EqualTo(l_returnflag,A)" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in text


def test_formula_rows_stay_in_the_jvm(spark, monkeypatch):
    plans = []
    stored = en.durable

    def recording(df, **options):
        plans.append((df.columns, plan(df)))
        return stored(df, **options)

    monkeypatch.setattr(en, "durable", recording)
    t = Tables(spark, SF)
    _ = en.run_levels(t.definitions, t.scopes, t.formula_inputs).results
    level_plans = [p for columns, p in plans if "resolved_formula" in columns]
    assert len(level_plans) == 3
    assert not any("EvalPython" in p for p in level_plans)


def test_each_use_of_a_value_is_shuffled_once_and_the_log_needs_no_level(spark, monkeypatch):
    written = []
    stored = en.durable

    def recording(df, **options):
        written.append((df.columns, plan(df)))
        return stored(df, **options)

    monkeypatch.setattr(en, "durable", recording)
    t = Tables(spark, SF)
    run = en.run_levels(t.definitions, t.scopes, t.formula_inputs)
    assert run.missing.count() and not any("resolved_formula" in columns for columns, _ in written)
    del written[:]
    _ = run.results
    uses = [columns for columns, _ in written if "_ref" in columns]
    assert len(uses) == 3  # outside values once, then after each level but the last
