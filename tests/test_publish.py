import datetime as dt

from tests.helpers import SF, rows
from pyspark.sql import functions as F

from ledgerloom.plans import publish, views
from ledgerloom.sources import files
from workload import marts as queries
from workload.fixtures import Tables


def test_value_adjustments_keep_adjusted_rows(spark):
    t = Tables(spark, SF)
    mart = queries.value_adjustment_mart(t)
    empty = spark.createDataFrame([], mart.schema)
    first = spark.createDataFrame(publish.merge_value_adjustments(empty, mart).collect(), mart.schema)
    assert first.count() == mart.count()
    assert sorted(r[0] for r in first.select("adj_id").collect()) == list(range(1, first.count() + 1))
    by_hand = F.col("kpi_reference") == "K1"
    kept = first.withColumn("adjusted_value", F.when(by_hand, 7.0)).withColumn("adjustment_reason", F.when(by_hand, "r"))
    again = mart.withColumn("original_value", F.col("original_value") + 1).withColumn("location_name", F.lit("new"))
    merged = publish.merge_value_adjustments(kept, again).join(first.select("adj_id", F.col("original_value").alias("old")), "adj_id")
    got = merged.select(by_hand.alias("h"), (F.col("original_value") - F.col("old")).cast("int").alias("d"), "location_name", "adjustment_reason").distinct()
    assert rows(got) == [(False, 1, "new", None), (True, 0, "new", "r")]


def test_variances_keep_comments(spark, monkeypatch):
    schema = "kpi_engine_key string, kpi_ref string, location_name string, month_date date, actual_value double, variance_commentary string, var_id bigint, variance_id string"
    updates = ["kpi_engine_key", "kpi_ref", "location_name", "actual_value", "variance_id"]
    day = dt.date(2026, 4, 1)
    kept = spark.createDataFrame([("a", "K1", "X", day, 1.0, "said", 5, "VAR-1")], schema)
    mart = spark.createDataFrame([("a", "K1", "X", day, 2.0, None, 1, "VAR-9"), ("b", "K1", "Y", day, 3.0, None, 2, "VAR-8")], schema)
    monkeypatch.setattr(publish, "VARIANCE_UPDATES", updates)
    expected = [("a", "K1", "X", day, 2.0, "said", 5, "VAR-9"), ("b", "K1", "Y", day, 3.0, None, 6, "VAR-8")]
    assert rows(publish.merge_variances(kept, mart)) == expected
    assert rows(publish.merge_variances(kept, mart, by_kpi=True)) == expected


def test_reporting_views(spark):
    t = Tables(spark, SF)
    tables = {
        "engine_output": t.engine_output, "engine_history": t.engine_history, "actuals_historic": t.actuals_historic, "budget_forecast": t.budget_forecast,
        "location_hierarchy": t.locations, "dim_date": t.calendar, "value_adjustment": t.value_adjustments, "variance": t.variance_comments,
    }
    report = files.register_views(views.reporting_views(tables, F.lit(dt.date(1998, 6, 30))))
    assert {r["view"]: r["status"] for r in report} == {
        "engine_output_enriched": "SUCCESS", "engine_output_latest": "SUCCESS", "kpi_master_active": "FAILED", "report_snapshot": "SUCCESS",
    }
    assert spark.table("report_snapshot").columns[0] == "kpi_unique_id"
    assert len(spark.table("report_snapshot").columns) == 35


def test_ingested_file_replaces_its_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Input Ref,Value\nI1,1\n")
    store = f"{tmp_path}/store"
    for _ in range(2):
        got = files.ingest_period_file(spark, f"{tmp_path}/a.csv", store, 2026, 4)
    assert rows(got.select("input_ref", "value", "date_key")) == [("I1", "1", dt.date(2026, 4, 1))]
    assert files.ingest_period_file(spark, None, store, 2026, 4) is None
