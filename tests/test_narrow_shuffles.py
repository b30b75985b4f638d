"""Keys in few bytes, rows placed once: the same results with narrower shuffles and writes."""

import glob
import hashlib
from datetime import date
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from ledgerloom.functions.scalar import key_bytes, key_of_bytes
from ledgerloom.operators import latest
from ledgerloom.operators import merge as m
from ledgerloom.plans import marts, views
from ledgerloom.sources import snapshots
from ledgerloom.sources.durable import durable
from workload import marts as workload
from workload.fixtures import Tables

HEX = hashlib.sha256(b"x").hexdigest()
KEYS = [HEX, HEX.upper(), HEX[:-1], HEX + "\n", HEX[:63] + "\n", "", "a" * 31, "a" * 32, "K1_1", "\u00fc\u00df", "\x00", None]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_bytes_round_trip_and_stay_different(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string").withColumn("b", key_bytes("k"))
    assert [r[0] for r in df.select(key_of_bytes("b")).collect()] == KEYS
    assert df.select("b").distinct().count() == len(KEYS)
    assert len(df.filter(F.col("k") == HEX).first()["b"]) == 32


def test_stored_steps_take_the_smaller_codec(spark):
    df = durable(spark.range(5))
    assert all(".zstd." in f for f in df.inputFiles()) and df.count() == 5
    assert not any(".zstd." in f for f in durable(spark.range(5), codec=None).inputFiles())


def test_versions_are_broadcast_to_the_rows(spark, tmp_path):
    old = spark.createDataFrame([("a", date(2026, 1, 1), Decimal(1), 1)], "k string, date_key date, value decimal(18,2), version_id int")
    new = spark.createDataFrame([("a", date(2026, 1, 1), Decimal(2)), ("b", date(2026, 2, 1), Decimal(3)), ("c", None, Decimal(4))], "k string, date_key date, value decimal(18,2)")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = snapshots.with_next_version(old, new)
        assert "SortMergeJoin" not in plan(got)
        assert rows(got.select("k", "version_id")) == [("a", 2), ("b", 1), ("c", 1)]
        path = str(tmp_path / "history")
        snapshots.write_version(spark, new, path)
        assert glob.glob(f"{path}/*/*.zstd.parquet")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_keys_common_to_both_are_not_made_distinct(spark):
    target = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("a", 5), ("b", 6), ("b", 7), (None, 8)], "k string, v int")
    fresh = m._unmatched(source, target, ["k"])
    assert "Aggregate" not in plan(fresh)
    assert rows(fresh) == [(None, 8), ("b", 6), ("b", 7)]


KPI = "kpi_id string, kpi_dim_id string, date_key date, fiscal_year int, fiscal_month int, category string, subcategory string, kpi_name string, dim_name string, uom string, value decimal(28,2)"
MONTH = date(1998, 5, 1)


def _kpi_rows(spark, key, data, **more):
    full = [("K1", d, MONTH, 1998, 11, "c", "s", "n", "d", "u", Decimal(v), k, f"K1_{d}") for k, d, v in data]
    df = spark.createDataFrame(full, f"{KPI}, {key} string, {'matrix_id' if key == 'kpi_engine_key' else 'metric_id'} string")
    return df.withColumns({c: F.lit(v) for c, v in more.items()})


def test_report_rows_are_placed_before_they_are_made_distinct(spark):
    data = [(HEX, "1", 5), ("odd", "2", 6), (None, "3", 7), (HEX.upper(), "4", 8)]
    history = _kpi_rows(spark, "kpi_engine_key", data, version_id=1)
    historic = _kpi_rows(spark, "kpi_unique_id", [*data, *data, (HEX, "1", 9)])
    plans = _kpi_rows(spark, "kpi_unique_id", data, version_id=1, scenario="Forecast")
    got = views.report_rows(history, historic, plans, F.lit("1998-06-30").cast("date"))
    text = plan(got)
    assert text.index("REPARTITION_BY_COL") > text.index("HashAggregate") and "Aggregate" not in text[text.index("REPARTITION_BY_COL") : text.index("Union")]
    wanted = [*((k, "Actual", v) for k, _, v in data), (HEX, "Actual", 9), *((k, "Forecast", v) for k, _, v in data)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r[0], r[1], int(r[2])) for r in got.select("kpi_unique_id", "scenario", "value").collect()), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("order", [1, -1])
def test_lines_are_numbered_by_key_text_and_multiplied_by_places(spark, order):
    keys = sorted([HEX, "0" * 63, "zz", "", HEX.upper()])
    spec = "kpi_engine_key string, kpi_ref string, month_date date, location_name string, actual_value decimal(28,2), budget_value decimal(28,2), forecast_value decimal(28,2), source string, unit_of_measure string"
    facts = spark.createDataFrame([(k, "K1", MONTH, "d", Decimal(3), Decimal(2), None, "s", None) for k in keys[::order]], spec)
    other = {c: F.lit(None).cast("string") for c in marts.VARIANCE_COLUMNS if c not in facts.columns}
    current = marts._with_variances(facts.withColumns({c: v for c, v in other.items()}))
    places = spark.createDataFrame([(HEX, "N", "C1", "K1_1"), (HEX, "M", "C1", "K1_2"), ("zz", "N", "C2", "K1_1")], "kpi_engine_key string, site_code string, company_code string, matrix_id string")
    uom = spark.createDataFrame([("K1", "EA")], "kpi_id string, uom string")
    teams = spark.createDataFrame([("K1_1", "Finance")], "kpi_matrix_id string, team_name string")
    got = marts.variance_final(current, current.limit(0), places, uom, teams, 1998)
    found = {(r["kpi_engine_key"], r["var_id"], r["site_code"], r["site_leadership_team"]) for r in got.collect()}
    number = {k: i + 1 for i, k in enumerate(keys)}
    where = {HEX: [("N", "Finance"), ("M", "Unknown")], "zz": [("N", "Finance")]}
    assert found == {(k, number[k], s, t) for k in keys for s, t in where.get(k, [(None, "Unknown")])}
    assert {(r["budget_variance"], r["budget_variance_pct"], r["forecast_variance"]) for r in got.collect()} == {(Decimal("1.00"), 50.0, None)}
    assert got.schema["budget_variance"].dataType == current.schema["budget_variance"].dataType


def test_numbering_stores_no_column_that_follows_from_others(spark, monkeypatch):
    seen = []
    real = marts.global_row_number
    monkeypatch.setattr(marts, "global_row_number", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    test_lines_are_numbered_by_key_text_and_multiplied_by_places(spark, 1)
    assert not {"budget_variance", "forecast_variance_pct"} & set(seen[0].columns)
    assert dict(seen[0].dtypes)["kpi_engine_key"] == "binary"


def test_plans_meet_their_actuals_by_short_keys(spark):
    data = [(HEX, "1", 5), ("odd", "2", 6), (None, "3", 7), (HEX.upper(), "4", 8)]
    actuals = views.engine_actuals(_kpi_rows(spark, "kpi_engine_key", [(k, d, v + 100) for k, d, v in data[:3]], version_id=1))
    got = views.forecast_override(_kpi_rows(spark, "kpi_unique_id", data, version_id=1, scenario="Forecast"), actuals, F.lit("1998-06-30").cast("date"))
    assert "unhex" in plan(got)
    assert rows(got.select("kpi_unique_id", F.col("value").cast("int"))) == rows(spark.createDataFrame([(HEX, 105), ("odd", 106), (None, 7), (HEX.upper(), 8)], "k string, v int"))


def test_plans_are_shuffled_once_before_any_sum(spark, tmp_path):
    day = "timestamp_ntz'1998-03-02'"
    lines = spark.createDataFrame(
        [
            (1, 5.0, 10.0, 0.0, "N"), (1, 5.0, 2.5, 0.0, "N"), (1, 20.0, 1.0, 0.0, "N"), (1, 40.0, 7.0, 0.0, "R"), (1, 40.0, 9.0, 0.0, "A"),
            (2, 5.0, 3.0, 0.1, "R"), (None, 5.0, 4.0, 0.1, "N"), (2, 5.0, None, 0.1, "R"),
        ],
        "l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string",
    )
    lines.selectExpr("*", f"{day} as l_shipdate").unionByName(lines.filter("l_suppkey = 2").selectExpr("*", "cast(null as timestamp_ntz) as l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for query, width in ((workload.latest_pivot, 3), (workload.allversions_pivot, 4)):
        got = query(Tables(spark, str(tmp_path)))
        assert plan(got).count("Exchange hashpartitioning") == 1
        assert "Aggregate" not in plan(got).split("Exchange hashpartitioning")[1]
        values = rows(got.filter("kpi_id = 'K1'").select("kpi_dim_id", F.year("date_key"), F.col("budget_value").cast("double"), F.col("forecast_value").cast("double")))
        latest = 1.0 if width == 3 else 12.5
        assert sorted(values, key=str) == sorted([("S1", 1998, latest, 7.0), ("2", 1998, None, 3.0), (None, 1998, 4.0, None), ("2", None, None, 3.0)], key=str)
    assert Tables(spark, str(tmp_path)).budget_forecast.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def shuffled_joins(df):
    """Joins of a plan for which both sides are shuffled, where tables are broadcast up to 100,000 bytes of known size."""
    return plan(df).count("SortMergeJoin")


@pytest.fixture
def small_broadcasts(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def _grouped(spark, spec, *rows_):
    """Rows whose size Spark does not know, as it knows nothing of a distinct's rows."""
    many = spark.range(20000).select((F.col("id") % len(rows_)).alias("i"))
    return many.join(F.broadcast(spark.createDataFrame([(i, *r) for i, r in enumerate(rows_)], f"i long, {spec}")), "i").drop("i").distinct()


def test_rows_at_their_greatest_version_are_not_shuffled(spark, small_broadcasts):
    big = spark.range(60000).select(F.col("id").alias("v"), F.when(F.col("id") % 3 < 2, MONTH).alias("date_key"), (F.col("id") % 2).alias("version_id"), F.lit("x" * 40).alias("text"))
    got = latest.rows_at_max_version(big)
    assert shuffled_joins(got) == 0
    assert got.agg(F.count("*"), F.min("version_id")).first()[:] == (20000, 1)


def test_units_and_levels_of_unknown_size_do_not_shuffle_the_rows(spark, small_broadcasts):
    spec = "kpi_id string, uom string"
    uom = _grouped(spark, spec, ("K1", "EA"), ("K2", "USD"))
    assert uom.count() == 2
    rows_ = spark.range(60000).select(F.concat(F.lit("K"), (F.col("id") % 3).cast("string")).alias("kpi_ref"), "id", F.lit("x" * 40).alias("text"))
    got = rows_.join(marts._units(uom, "kpi_ref", "_uom"), "kpi_ref", "left")
    assert shuffled_joins(got) == 0 and shuffled_joins(rows_.join(uom.select(F.col("kpi_id").alias("kpi_ref"), "uom"), "kpi_ref", "left")) == 1
    assert rows(got.groupBy("kpi_ref", "_uom").count()) == [("K0", None, 20000), ("K1", "EA", 20000), ("K2", "USD", 20000)]
    places = rows_.select(F.col("kpi_ref").alias("k"), F.element_at(F.array(F.lit("Site"), F.lit("Company")), (F.col("id") % 2 + 1).cast("int")).alias("level"), "text")
    flagged = views.level_flag(places, ["k"], "level")
    assert shuffled_joins(flagged) == 0
    assert rows(flagged.groupBy("level", "location_level_flag").count()) == [("Company", 1, 30000), ("Site", 0, 30000)]


def test_only_plans_that_show_actuals_meet_them(spark):
    data = [(HEX, "1", 5), ("odd", "2", 6), (None, "3", 7)]
    history = _kpi_rows(spark, "kpi_engine_key", [(HEX, "1", 100), (HEX, "1", 200), ("odd", "2", 300)], version_id=1)
    none = _kpi_rows(spark, "kpi_unique_id", data).limit(0)
    plans = _kpi_rows(spark, "kpi_unique_id", data, version_id=1)
    late = plans.withColumns({"date_key": F.lit("1998-07-01").cast("date"), "scenario": F.lit("Forecast")})
    all_plans = reduce(lambda a, b: a.unionByName(b), [plans.withColumn("scenario", F.lit(s).cast("string")) for s in ("Forecast", "Budgets", None)]).unionByName(late)
    got = views.report_rows(history, none, all_plans, F.lit("1998-06-30").cast("date"))
    found = sorted(((r[0], r[1], r[2].month, int(r[3])) for r in got.select("kpi_unique_id", "scenario", "date_key", "value").collect()), key=str)
    wanted = [(HEX, "Actual", 5, 100), (HEX, "Actual", 5, 200), ("odd", "Actual", 5, 300), (HEX, "Forecast", 5, 100), (HEX, "Forecast", 5, 200), ("odd", "Forecast", 5, 300), (None, "Forecast", 5, 7)]
    wanted += [(k, s, m, v) for k, _, v in data for s, m in (("Budget", 5), (None, 5), ("Forecast", 7))]
    assert found == sorted(wanted, key=str)
    joined = [part for part in plan(got).split("Join") if "LeftOuter" in part]
    assert joined


def test_a_query_reads_and_shuffles_only_the_numbers_it_uses(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    for table in (t.engine_output, t.actuals_historic, t.budget_forecast):
        text = plan(table.select("kpi_id", "uom").distinct())
        assert "l_suppkey" in text and "l_extendedprice" not in text
        first = table.filter("kpi_id = 'K2'").select("kpi_name", "category", "subcategory", "uom", "source", "execution_level").distinct()
        assert rows(first) == [("Quantity", "Volume", "Units", "EA", None, 1.0)]


def test_current_keys_travel_to_their_plans_in_few_bytes(spark):
    data = [(HEX, "1", 5), ("odd", "2", 6), (None, "3", 7)]
    output = _kpi_rows(spark, "kpi_engine_key", data, execution_level=1.0, source="s")
    plans = _kpi_rows(spark, "kpi_unique_id", data[:1], version_id=1, scenario="Forecast")
    got = marts.variance_current(output, plans)
    text = plan(got)
    assert text.index("unhex") > text.index("Join")
    assert rows(got.select("kpi_engine_key", F.col("forecast_value").cast("int"))) == [(None, None), (HEX, 5), ("odd", None)]
