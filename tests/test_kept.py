import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

from ledgerloom.operators import merge as m
from ledgerloom.operators.numbering import assign_surrogate_keys
from ledgerloom.plans.loads import Load, kept_table, load_kept
from ledgerloom.sources.commits import CommitConflict, Commits
from ledgerloom.sources.kept import KeptTable, NumberRange
from ledgerloom.sources.schemas import ColumnSpec
from ledgerloom.sources.snapshots import VersionedHistory

FACT = (ColumnSpec("k", "bigint"), ColumnSpec("v", "string"), ColumnSpec("created", "timestamp"), ColumnSpec("updated", "timestamp"))
ROLES = m.Columns(("k",), created="created", updated="updated")
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def files(table):
    """Every file of the current state by bucket."""
    return {f.split("/")[-1]: sorted(os.listdir(f)) for f in table.folders()}


def facts(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, v string")


@pytest.fixture
def table(spark, tmp_path):
    made = KeptTable(spark, f"{tmp_path}/t", facts(spark, []).schema, ["k"], 16)
    made.replace(facts(spark, [(i, "old") for i in range(400)] + [(None, "no key")]))
    return made


def upsert(new):
    return lambda old: old.join(new.select("k"), "k", "left_anti").unionByName(new)


def test_markers_are_taken_once(spark, tmp_path):
    commits = Commits(spark, f"{tmp_path}/c")
    assert commits.newest() == 0 and commits.read(0) == {}
    assert commits.take(1, {"a": "ü"}) and not commits.take(1, {"a": 2})
    assert commits.newest() == 1 and commits.read(1) == {"a": "ü"}
    assert [f for f in os.listdir(tmp_path / "c") if f.startswith("_")] == []
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if commits.take(2, {"by": i}) else None) for i in range(8)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert len(won) == 1 and commits.read(2) == {"by": won[0]}


def test_a_merge_reads_and_writes_touched_buckets_only(spark, table):
    before = files(table)
    new = facts(spark, [(3, "new"), (1000, "new")])
    touched = {f"_bucket={r.b}" for r in new.select(table.bucket().alias("b")).collect()}
    seen = []

    def change(old):
        seen.extend(f.split("/")[-2] for f in old.inputFiles())
        plan = old._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        return upsert(new)(old)

    table.merge(new.select("k"), change)
    after = files(table)
    assert set(seen) == touched and 1 <= len(touched) <= 2
    assert {b for b in before if before[b] != after[b]} == touched
    assert rows(table.read()) == rows(facts(spark, [(i, "new" if i == 3 else "old") for i in range(400)] + [(1000, "new"), (None, "no key")]))


def test_buckets_may_get_empty_and_sources_too(spark, table):
    n, _ = table.state()
    assert table.merge(facts(spark, []).select("k"), lambda old: old) == n
    gone = facts(spark, [(i, "") for i in range(400)] + [(None, "")])
    table.merge(gone.select("k"), lambda old: old.limit(0))
    assert table.read().count() == 0 and table.folders() == []
    table.append(facts(spark, [(1, "again")]))
    assert rows(table.read()) == [(1, "again")]


def test_rows_outside_the_touched_buckets_are_refused(spark, table):
    with pytest.raises(ValueError, match="touched"):
        table.merge(facts(spark, [(1, "")]).select("k"), lambda old: facts(spark, [(i, "x") for i in range(50)]))
    assert table.read().filter("v = 'old'").count() == 400


def test_readers_keep_their_state_and_aborted_runs_are_not_seen(spark, table):
    mine = table.read()
    table._write(facts(spark, [(5, "written, never committed")]))
    table.merge(facts(spark, [(5, "new")]).select("k"), upsert(facts(spark, [(5, "new")])))
    assert mine.filter("k = 5").first().v == "old" and table.read().filter("k = 5").first().v == "new"
    assert table.read().filter("v like 'written%'").count() == 0
    assert table.read(1).filter("k = 5").first().v == "old"


def bucket_of(table, k):
    return table.spark.range(1).select(F.lit(k).cast("bigint").alias("k")).select(table.bucket()).first()[0]


@pytest.mark.parametrize("same", [True, False])
def test_interleaved_merges(spark, table, same):
    """Another run commits between our read and our commit: in another bucket ours still holds, in the same it is done again."""
    other = KeptTable(spark, table.path)
    key = next(k for k in range(1, 400) if (bucket_of(table, k) == bucket_of(table, 0)) == same)
    calls = []

    def change(old):
        calls.append(1)
        if len(calls) == 1:
            theirs = facts(spark, [(key, "theirs")])
            other.merge(theirs.select("k"), upsert(theirs))
        return upsert(facts(spark, [(0, "ours")]))(old)

    table.merge(facts(spark, [(0, "")]).select("k"), change)
    got = {r.k: r.v for r in table.read().collect()}
    assert (got[0], got[key], len(got)) == ("ours", "theirs", 401) and len(calls) == (2 if same else 1)


def test_interleaved_replacements_and_appends(spark, table):
    other = KeptTable(spark, table.path)
    calls = []

    def change(old):
        calls.append(1)
        if len(calls) == 1:
            other.append(facts(spark, [(7777, "late")]))
        return old.groupBy("v").agg(F.min("k").alias("k"), F.count("*").alias("n"))

    table.replace(change)
    assert rows(table.read().select("v", "n")) == [("late", 1), ("no key", 1), ("old", 400)] and len(calls) == 2
    with pytest.raises(ValueError, match="keys"):
        table.replace(lambda old: old.drop("k"))

    def always_late(old):
        other.replace(lambda r: r)
        return old

    table.attempts = 2
    with pytest.raises(CommitConflict):
        table.replace(always_late)


def test_a_table_without_keys_cannot_be_merged_and_one_without_schema_not_read(spark, tmp_path):
    plain = KeptTable(spark, f"{tmp_path}/p")
    with pytest.raises(ValueError):
        plain.read()
    plain.append(facts(spark, [(1, "a")]))
    plain.append(facts(spark, [(2, "b")]))
    assert rows(KeptTable(spark, plain.path).read()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        plain.merge(facts(spark, [(1, "")]).select("k"), lambda old: old)


def test_hot_key_of_a_table_is_split_over_files(spark, tmp_path):
    """A bucket of one key may be larger than a task: rebalancing may cut it into several files."""
    table = KeptTable(spark, f"{tmp_path}/hot", facts(spark, []).schema, ["k"], 4)
    hot = spark.range(40_000).select(F.lit(1).cast("bigint").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        table.replace(hot)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    (names,) = files(table).values()
    assert sum(n.endswith(".parquet") for n in names) > 1 and table.read().count() == 40_000


def test_loads_into_kept_tables(spark, tmp_path):
    load = Load("f", "fact", FACT, ROLES)
    table = kept_table(spark, load, f"{tmp_path}/f", 8)
    load_kept(load, table, [facts(spark, [(i, "a") for i in range(50)])], F.lit(T0))
    before = files(table)
    load_kept(load, table, [facts(spark, [(1, "a"), (2, "b")]), facts(spark, [(2, "c"), (99, "d")])], F.lit(T1))
    got = {r.k: (r.v, r.created, r.updated) for r in table.read().collect()}
    assert got[1] == ("a", T0, T0) and got[2] == ("c", T0, T1) and got[99] == ("d", T1, T1) and len(got) == 51
    assert sum(before[b] == x for b, x in files(table).items() if b in before) >= 5


def test_keys_come_from_reserved_ranges(spark, tmp_path):
    numbers = NumberRange(spark, f"{tmp_path}/n")
    one = assign_surrogate_keys(facts(spark, [(i, "x") for i in range(30)]), numbers.reserve, "key", ["k"])
    two = assign_surrogate_keys(facts(spark, [(i, "y") for i in range(20)]), numbers.reserve, "key", ["k"])
    assert [r.key for r in two.orderBy("key").collect()] == list(range(31, 51))
    assert [r.key for r in one.orderBy("key").collect()] == list(range(1, 31)) and numbers.greatest() == 50
    for df in (one, two):
        assert "max(" not in df._jdf.queryExecution().optimizedPlan().toString()
    taken = []
    threads = [threading.Thread(target=lambda: taken.append(numbers.reserve(10))) for _ in range(6)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert sorted(taken) == [51 + 10 * i for i in range(6)]


def test_surrogate_keys_need_a_range(spark, tmp_path):
    load = Load("d", "dimension", [*FACT, ColumnSpec("id", "bigint")], m.Columns(("k",), (), "id", created="created", updated="updated"))
    table = kept_table(spark, load, f"{tmp_path}/d", 4)
    with pytest.raises(ValueError, match="NumberRange"):
        load_kept(load, table, [facts(spark, [(1, "a")])], F.lit(T0))


def test_versions_appear_whole(spark, tmp_path):
    history = VersionedHistory(spark, f"{tmp_path}/h")
    may, june = dt.date(2026, 5, 1), dt.date(2026, 6, 1)
    made = lambda *x: spark.createDataFrame(list(x), "date_key date, value double")
    assert history.read() is None
    history.stage(made((may, 9.0)))  # never committed
    assert history.read() is None
    one, two = history.stage(made((may, 1.0), (june, 1.5))), history.stage(made((may, 2.0), (None, 7.0)))
    assert history.commit(two) == {"2026-05-01": 1, "": 1} and history.commit(one) == {"2026-05-01": 2, "2026-06-01": 1}
    assert history.commit(history.stage(made())) == {}
    later = spark.createDataFrame([(june, 3.0, "n")], "date_key date, value double, name string")
    history.append(later)
    got = {(r.date_key, r.version_id): (float(r.value), r.name) for r in history.read().collect()}
    assert got == {(may, 1): (2.0, None), (None, 1): (7.0, None), (may, 2): (1.0, None), (june, 1): (1.5, None), (june, 2): (3.0, "n")}
    assert history.read(later.schema).count() == 5
