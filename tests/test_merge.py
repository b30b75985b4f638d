import datetime as dt
import random

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from ledgerloom.operators import merge as m

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
END = dt.datetime(2999, 12, 31)
BEFORE = dt.datetime(2024, 1, 31, 23, 59, 59, 999000)
ROLES = m.Columns(("id",), ("grade",), "sk", "ver", "cur", "beg", "fin", "made", "seen")
SCHEMA = "sk bigint, id int, grade string, note string, ver bigint, cur string, beg timestamp, fin timestamp, made timestamp, seen timestamp"


def row(sk, i, grade, note, ver=1, cur="Y", fin=END):
    return (sk, i, grade, note, ver, cur, T0, fin, T0, T0)


def scd2(spark, target, source, **options):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, "id int, grade string, note string")
    return m.scd2(t, s, ROLES, F.lit(T1), **options)


def test_scd2_branches(spark):
    target = [
        row(1, 1, "A", "x"), row(2, 2, "A", "x"), row(3, 3, "A", "x"), row(4, 4, None, "x"), row(5, 5, "A", "x", 1, "N", T0),
        row(6, 6, "A", "x", 1, "N", T0), row(7, 6, "B", "x", 2), row(8, 8, "A", "x"),
    ]
    source = [(1, "B", "y"), (2, "A", "y"), (3, "A", "x"), (4, None, "y"), (5, "C", "y"), (6, "C", "z"), (9, "A", "n")]
    got = rows(scd2(spark, target, source))
    expected = [
        (1, 1, "A", "x", 1, "N", T0, BEFORE, T0, T0),  # expired: update time untouched
        (9, 1, "B", "y", 2, "Y", T1, END, T1, T1),
        (2, 2, "A", "y", 1, "Y", T0, END, T0, T1),  # other column updated in place
        row(3, 3, "A", "x"),
        row(4, 4, None, "x"),  # NULL tracked value blocks the update
        row(5, 5, "A", "x", 1, "N", T0),  # only expired rows: neither new nor current
        row(6, 6, "A", "x", 1, "N", T0),
        (7, 6, "B", "x", 2, "N", T0, BEFORE, T0, T0),
        (10, 6, "C", "z", 3, "Y", T1, END, T1, T1),
        row(8, 8, "A", "x"),
        (11, 9, "A", "n", 1, "Y", T1, END, T1, T1),
    ]
    assert got == sorted(expected, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_scd2_rerun_changes_nothing(spark):
    source = [(1, "B", "y"), (2, None, "q")]
    once = scd2(spark, [], source)
    again = m.scd2(once, spark.createDataFrame(source, "id int, grade string, note string"), ROLES, F.lit(T1 + dt.timedelta(1)))
    assert rows(once) == rows(again)


def test_persistent_stage_touches_unchanged_rows(spark):
    roles = m.Columns(("id",), ("grade",), None, "ver", "cur", "beg", "fin", "made", "seen")
    schema = "id int, grade string, ver bigint, cur string, beg timestamp, fin timestamp, made timestamp, seen timestamp"
    t = spark.createDataFrame([(1, "A", 1, "Y", T0, END, T0, T0)], schema)
    s = spark.createDataFrame([(1, "A")], "id int, grade string")
    assert m.scd2(t, s, roles, F.lit(T1), touch_unchanged=True).first()["seen"] == T1
    assert m.scd2(t, s, roles, F.lit(T1)).first()["seen"] == T0


def test_scd2_random_loads_keep_invariants(spark):
    rng = random.Random(2)
    state = spark.createDataFrame([], SCHEMA)
    for n in range(3):
        source = [(i, rng.choice("AB"), rng.choice("xy")) for i in rng.sample(range(12), 8)]
        s = spark.createDataFrame(source, "id int, grade string, note string")
        state = spark.createDataFrame(m.scd2(state, s, ROLES, F.lit(T0 + dt.timedelta(n))).collect(), SCHEMA)
        by_id = {}
        for r in state.collect():
            by_id.setdefault(r["id"], []).append(r)
        for versions in by_id.values():
            assert sum(r["cur"] == "Y" for r in versions) == 1
            assert sorted(r["ver"] for r in versions) == list(range(1, len(versions) + 1))
        keys = sorted(r["sk"] for r in state.collect())
        assert keys == list(range(1, len(keys) + 1))


def test_repeated_source_key_raises_when_matched(spark):
    with pytest.raises(Exception, match="more than one source row"):
        scd2(spark, [row(1, 1, "A", "x")], [(1, "B", "x"), (1, "C", "x")]).collect()
    # as in SQL, unmatched repeats are inserted
    assert scd2(spark, [], [(1, "B", "x"), (1, "C", "x")]).count() == 2


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, 1)], "id int, v int")
    s = spark.createDataFrame([(None, 2)], "id int, v int")
    assert rows(m.upsert_columns(t, s, ["id"], ["v"])) == [(None, 1), (None, 2)]


def test_scd1(spark):
    roles = m.Columns(("id",), (), "sk", "ver", "cur", "beg", "fin", "made", "seen")
    t = spark.createDataFrame([row(1, 1, "A", "x"), row(2, 2, None, "x")], SCHEMA)
    s = spark.createDataFrame([(1, "A", "x"), (2, "B", "x"), (3, "C", "z")], "id int, grade string, note string")
    got = rows(m.scd1(t, s, roles, F.lit(T1)))
    assert got == [row(1, 1, "A", "x"), (2, 2, "B", "x", 1, "Y", T0, END, T0, T1), (3, 3, "C", "z", 1, "Y", T1, END, T1, T1)]


def test_fact_upsert_touches_only_changes(spark):
    schema = "id int, qty int, made timestamp, seen timestamp"
    roles = m.Columns(("id",), created="made", updated="seen")
    t = spark.createDataFrame([(1, 5, T0, T0), (2, None, T0, T0), (3, 7, T0, T0)], schema)
    s = spark.createDataFrame([(1, 5), (2, 4), (4, 9)], "id int, qty int")
    got = rows(m.upsert_changed(t, s, roles, F.lit(T1)))
    assert got == [(1, 5, T0, T0), (2, 4, T0, T1), (3, 7, T0, T0), (4, 9, T1, T1)]


def test_protected_and_listed_columns(spark):
    schema = "k int, original_value double, adjusted_value double, name string"
    t = spark.createDataFrame([(1, 1.0, None, "a"), (2, 2.0, 5.0, "b"), (3, 3.0, 0.0, "c")], schema)
    s = spark.createDataFrame([(1, 10.0, None, "A"), (2, 20.0, None, "B"), (3, 30.0, 7.0, "C"), (4, 40.0, None, "D")], schema)
    got = rows(m.upsert_protected(t, s, ["k"], ["original_value", "name"]))
    assert got == [(1, 10.0, None, "A"), (2, 2.0, 5.0, "B"), (3, 3.0, 0.0, "C"), (4, 40.0, None, "D")]
    listed = rows(m.upsert_columns(t, s, ["k"], ["name"]))
    assert listed == [(1, 1.0, None, "A"), (2, 2.0, 5.0, "B"), (3, 3.0, 0.0, "C"), (4, 40.0, None, "D")]
