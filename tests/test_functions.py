import datetime as dt
import hashlib
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import scalar as sc


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_clean_ref_trims_and_turns_subscripts(spark):
    assert one(spark, sc.clean_ref(F.lit(" I₁₂\t"))) == "I12"
    assert one(spark, sc.clean_ref(F.lit(None).cast("string"))) is None


def test_to_measure_edges(spark):
    values = ["0.1234567890125", "-0.1234567890125", "1e16", "nan", "inf", "-inf", None, "abc", "9999999999999999"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(sc.to_measure("v")).collect()]
    zero = Decimal("0E-12")
    assert got[:2] == [Decimal("0.123456789013"), Decimal("-0.123456789013")]
    assert got[2:8] == [zero] * 6
    assert got[8] == zero  # the nearest double is 1e16


def test_fiscal_period_matches_column_form(spark):
    for y, m in [(2025, 6), (2025, 7), (2025, 12), (2026, 1)]:
        d = F.lit(dt.date(y, m, 15))
        assert (one(spark, sc.fiscal_year(d)), one(spark, sc.fiscal_month(d))) == sc.fiscal_period(y, m)
    assert sc.fiscal_period(2025, 7) == (2026, 1)
    assert sc.fiscal_period(2025, 6) == (2025, 12)


def test_engine_key(spark):
    d = F.lit(dt.date(2026, 4, 1))
    assert one(spark, sc.engine_key(F.lit("K1_2"), d)) == hashlib.sha256(b"K1_2||2026-04-01").hexdigest()
    assert one(spark, sc.engine_key(F.lit(None).cast("string"), d)) == hashlib.sha256(b"NA||2026-04-01").hexdigest()


def test_display_id_keeps_wide_numbers_unless_compat(spark):
    assert one(spark, sc.display_id("ADJ", 2026, F.lit(7), 4)) == "ADJ-2026-0007"
    assert one(spark, sc.display_id("ADJ", 2026, F.lit(12345), 4)) == "ADJ-2026-12345"
    assert one(spark, sc.display_id("ADJ", 2026, F.lit(12345), 4, compat=True)) == "ADJ-2026-1234"


def test_variance_pct_is_null_without_plan(spark):
    assert one(spark, sc.variance_pct(F.lit(110.0), F.lit(100.0))) == 10.0
    assert one(spark, sc.variance_pct(F.lit(110.0), F.lit(0.0))) is None
    assert one(spark, sc.variance_pct(F.lit(110.0), F.lit(None).cast("double"))) is None


def test_adjustment_delta(spark):
    null = F.lit(None).cast("double")
    assert one(spark, sc.adjustment_delta(F.lit(10.0), F.lit(12.5))) == 2.5
    assert one(spark, sc.adjustment_delta(F.lit(10.0), F.lit(0.0))) == 10.0
    assert one(spark, sc.adjustment_delta(F.lit(10.0), null)) == 10.0
    assert one(spark, sc.adjustment_delta(null, null)) == 0.0


def test_value_changed_sentinel(spark):
    null, mark = F.lit(None).cast("string"), F.lit("**NULL**")
    assert one(spark, sc.value_changed(null, mark)) is True
    assert one(spark, sc.value_changed(null, mark, compat=True)) is False
    assert one(spark, sc.value_changed(null, null)) is False
    assert one(spark, sc.value_changed(F.lit(1), null)) is True


def test_level_rank(spark):
    df = spark.createDataFrame([("Location",), ("SITE",), ("zone",), (None,)], "v string")
    assert [r[0] for r in df.select(sc.level_rank("v")).collect()] == [1, 3, 0, None]


def test_small_helpers(spark):
    assert one(spark, sc.blank_fallback(F.lit(""), F.lit("b"))) == "b"
    assert one(spark, sc.source_kind(F.lit("Calculated from other KPIs"))) == "CALCULATED KPI"
    assert one(spark, sc.source_kind(F.lit(None).cast("string"))) == "N/A"
    assert one(spark, sc.scenario_label(F.lit("Budgets"))) == "Budget"
    assert one(spark, sc.just_before(F.lit(dt.datetime(2024, 1, 1)))) == dt.datetime(2023, 12, 31, 23, 59, 59, 999000)
    assert one(spark, sc.sort_key(F.lit("KPREV4"))) == 4.0
    assert one(spark, sc.sort_key(F.lit("K"))) is None
    assert one(spark, sc.on_or_before_month(F.lit(dt.date(2024, 5, 31)), F.lit(dt.date(2024, 5, 1)))) is True


def test_number_texts_match_python(spark):
    rng = random.Random(5)
    values = [5.0, -5.0, 0.0, 1e7, 12345678.9, 1e16, 1e-3, 1e-4, 1.25e-4, 1e-5, -1e-7, 1 / 3, 1e15, 1e22, 0.5e-15, 2.5e-16]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-18, 15) for _ in range(500)]
    values += [rng.randint(-(10**9), 10**9) / 2 ** rng.randint(0, 40) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", sc.float_text("v").alias("t"), sc.signed_fixed("v").alias("s")).collect():
        assert r["t"] == repr(r["v"])
        assert r["s"] == f"{r['v']:+.15f}"


def test_number_texts_of_all_sizes(spark):
    """One rule on both sides of 2^62, and where nine digits fill a limb."""
    rng = random.Random(9)
    values = [2.0**k for k in range(-60, 1024, 5)] + [2.0**k - 2.0 ** max(k - 53, 0) for k in range(2, 1024, 7)]
    values += [10.0**k for k in range(309)] + [float(n * 10**9 - 1) for n in (1, 10**6, 9007198)] + [1.7976931348623157e308, 5e-324]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randint(10, 308) for _ in range(300)] + [float("inf"), float("-inf"), float("nan"), -0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", sc.signed_fixed("v").alias("s")).collect():
        assert r["s"] == (None if r["v"] is None else f"{r['v']:+.15f}")
