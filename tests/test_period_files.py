"""Period files as users hand them in."""

import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from tests.helpers import rows

from ledgerloom.operators.overlay import overlay_chain
from ledgerloom.plans.kpi_run import Period, period_corrections
from ledgerloom.sources import files
from ledgerloom.sources.period_files import read_period_files


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def read(spark, base, names, **options):
    return read_period_files(spark, str(base), 2026, 4, names, **options)


def test_status_of_each_file(spark, tmp_path):
    month = f"{tmp_path}/2026/04"
    put(f"{month}/plan", "b.csv", "Input Ref,Value\nI9,9\n")
    put(f"{month}/plan", "a.csv", "Input Ref,Value\nI1,1\nI2\nI3,3,4\n\nI4,\n")
    put(f"{month}/plan", "_a.csv", "hidden\n")
    put(f"{month}/head", "only.csv", "Input Ref,Value\n")
    put(f"{month}/void", "x.csv", "")
    put(f"{month}/clash", "x.csv", "Input Ref,input_ref\nI1,2\n")
    put(f"{month}/good", "x.csv", "Input Ref,Value\nI5,\"5,5\"\n")
    found = read(spark, tmp_path, ["plan", "none/x", "head", "void", "clash", "good"])
    assert rows(found.report) == sorted(
        [
            ("plan", "a.csv", 2, "PARTIAL", 2, 2), ("none/x", None, 0, "MISSING", 0, 0), ("head", "only.csv", 1, "EMPTY", 0, 0),
            ("void", "x.csv", 1, "UNREADABLE", 0, 0), ("clash", "x.csv", 1, "UNREADABLE", 0, 0), ("good", "x.csv", 1, "LOADED", 1, 0),
        ],
        key=lambda r: tuple((x is not None, str(x)) for x in r),
    )
    assert rows(found.rows.select("input_ref", "value")) == [("I1", "1"), ("I4", ""), ("I5", "5,5")]
    assert rows(found.rejected.select("file", "record")) == [("plan", "I2"), ("plan", "I3,3,4")]
    assert [r[0] for r in found.rejected.orderBy("seq").select("record").collect()] == ["I2", "I3,3,4"]


def test_no_file_at_all(spark, tmp_path):
    found = read(spark, tmp_path, ["plan", "static/x"])
    assert found.rows is None and found.rejected.isEmpty()
    assert rows(found.report) == [("plan", None, 0, "MISSING", 0, 0), ("static/x", None, 0, "MISSING", 0, 0)]
    assert files.input_rows(found.rows, 2026, 4, spark=spark).isEmpty()


def test_wanted_columns_and_headers_with_dots(spark, tmp_path):
    put(f"{tmp_path}/2026/04/plan", "a.csv", "Input Ref,no. of,Value\nI1,x,1\nI2,x\n")
    found = read(spark, tmp_path, ["plan"], columns=["Input Ref", "Value"])
    # a record is judged by all its cells, read or not
    assert found.rows.columns[:2] == ["input_ref", "value"] and rows(found.rows.select("input_ref", "value")) == [("I1", "1")]
    assert rows(read(spark, tmp_path, ["plan"]).rows.select("`no._of`")) == [("x",)]
    assert rows(read(spark, tmp_path, ["plan"], columns=["absent"]).report)[0][3] == "UNREADABLE"


def test_the_last_row_counts_over_splits_and_files(spark, tmp_path):
    month = f"{tmp_path}/2026/04"
    body = "".join(f"I{i % 7},{i}\n" for i in range(4000))
    put(f"{month}/plan", "a.csv", "Input Ref,Value\n" + body)
    put(f"{month}/top", "a.csv", "Input Ref,Value\nI3,\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = read(spark, tmp_path, ["plan", "top"])
        assert found.rows.select("seq.block").distinct().count() > 10
        last = overlay_chain([files.input_rows(found.rows, 2026, 4)])
        want = {f"I{i % 7}": str(i) for i in range(4000)} | {"I3": ""}
        assert {r["input_ref"]: r["value"] for r in last.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parts_of_a_folder_are_one_file_and_must_agree(spark, tmp_path):
    folder = f"{tmp_path}/2026/04/plan/a.csv"
    put(folder, "part-0.csv", "Input Ref,Value\nI1,1\n")
    put(folder, "part-1.csv", "Input Ref,Value\nI1,2\n")
    found = read(spark, tmp_path, ["plan"])
    assert rows(found.report) == [("plan", "a.csv", 1, "LOADED", 2, 0)]
    assert [r["value"] for r in found.rows.orderBy("seq").collect()] == ["1", "2"]
    put(folder, "part-2.csv", "Value,Input Ref\n3,I1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read(spark, tmp_path, ["plan"])


def test_corrections_come_from_the_source_of_the_period(spark):
    given = spark.createDataFrame([("k1", "1", "5"), ("K1", "1.0", "2")], "kpi_id string, kpi_dim_id string, value string")
    table = spark.createDataFrame(
        [("K1", 1, "2026-03-01", "S1", 100.0), ("K1", 1, "2026-02-01", "S1", 8.0), ("K1", 1, "2026-02-01", "S2", 9.0), ("K1", 1, "2026-02-01", "S1", None)],
        "kpi_reference string, location_column_id int, month_date string, site_code string, adjusted_value double",
    )
    assert rows(period_corrections("prod", Period("S1", 2026, 3), given, table)) == [("K1_1", 7.0)]  # the file's 5 and 2
    assert rows(period_corrections("prod", Period("S1", 2026, 2), given, table)) == [("K1_1", 8.0)]
    assert rows(period_corrections("ba", Period("S2", 2026, 2), given, table)) == [("K1_1", 7.0)]
    assert period_corrections("prod", Period("S3", 2026, 2), given, table).isEmpty()
