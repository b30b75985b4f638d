import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import sharding
from ledgerloom.llm.sharding import Leaf, standard


def brute(key, tree):
    """Descend by plain loops: (generation, region), rack, shard."""
    node, left = (), [(x.generation, x.region, x.rack, x.shard, x.weight) for x in tree]
    for depth in (2, 3, 4):
        weight = defaultdict(float)
        for p in left:
            weight[p[:depth]] += p[4]
        draws = []
        for child in sorted(weight):
            digits = hashlib.md5(f"{':'.join(map(str, child))}|{key}".encode()).hexdigest()[:13]
            draws.append((-math.log((int(digits, 16) + 0.5) / 2**52) / weight[child], child))
        node = min(draws)[1]
        left = [p for p in left if p[:depth] == node]
    return node[3]


def shards(spark, keys, tree):
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", sharding.shard_of(F.col("k"), tree).alias("s"))
    return {r.k: r.s for r in df.collect()}


def test_equals_plain_descent(spark):
    keys = [str(i) for i in range(500)]
    tree = [*standard(45, base=40), Leaf(0, 0, 3, 2.5, 9)]
    assert shards(spark, keys, tree) == {k: brute(k, tree) for k in keys}


@pytest.mark.parametrize("n", [40, 41, 47, 60])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    keys = [str(i) for i in range(4000)]
    before, after = shards(spark, keys, standard(n)), shards(spark, keys, standard(n + 1))
    moved = [k for k in keys if before[k] != after[k]]
    assert all(after[k] == n for k in moved)
    assert 0.5 * 4000 / (n + 1) < len(moved) < 1.6 * 4000 / (n + 1)


def test_moves_stay_in_subtrees_whose_weights_change(spark):
    keys = [str(i) for i in range(3000)]
    tree = standard(40)
    before = shards(spark, keys, tree)
    # more weight for an old shard, in a rack with others: nothing goes to its neighbours
    more = shards(spark, keys, [*tree, Leaf(0, 1, 5, 1.0, 1)])
    assert {more[k] for k in keys if more[k] != before[k]} == {5}
    # a shard that is drained: documents of other racks keep their place or take what its subtree lost
    less = shards(spark, keys, [x for x in tree if x.shard != 5])
    assert {before[k] for k in keys if less[k] != before[k]} <= set(range(20)) and 5 not in less.values()
    assert all(less[k] == before[k] for k in keys if before[k] >= 20)


def test_weights(spark):
    tree = [Leaf(0, 0, 0, 1.0), Leaf(0, 1, 1, 3.0), Leaf(1, 2, 2, 4.0), Leaf(1, 2, 3, 0.0)]
    count = Counter(shards(spark, [str(i) for i in range(8000)], tree).values())
    assert set(count) == {0, 1, 2}
    assert abs(count[0] - 1000) < 150 and abs(count[1] - 3000) < 250 and abs(count[2] - 4000) < 250


def test_rejected_trees():
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("x"), [])
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("x"), [Leaf(0, 0, 0), Leaf(0, 0, 0)])


def test_assigned(spark, docs):
    rows = [(i, "x" * i) for i in range(200)] + [(7, "again"), (7, "again"), (7, None), (None, "no id"), (None, None), (500, "ü" * 30_000)] + [(8, "hot")] * 300
    df = docs(rows).withColumns({"shard": F.lit(99), "slot": F.lit("s"), "_at": F.lit(0), "_n": F.lit(1), "key": F.lit("k")})
    got = sharding.assigned(df, standard(40), standard(41)).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), brute("" if i is None else str(i), standard(40))) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in got) == want
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append((r.slot, (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"])))
    for found in by_shard.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found))) and [k for _, k in found] == sorted(k for _, k in found)
    assert all(r.grown_shard in (r.shard, 40) for r in got)


def test_equal_rows_are_dealt_over_tasks(spark, docs):
    """The slots of equal rows come from a range partitioning that a key alone could not split."""
    got = sharding.assigned(docs([(1, "same")] * 4000), standard(40))
    assert sorted(r.slot for r in got.collect()) == list(range(4000))
    assert got.select(F.spark_partition_id()).distinct().count() > 1


def test_written_shards(spark, docs, tmp_path):
    df = docs([(i, f"t{i}") for i in range(300)]).withColumn("shard", F.lit("column of the table"))
    sharding.write_shards(df, str(tmp_path / "out"), standard(40))
    back = spark.read.parquet(str(tmp_path / "out")).select("shard", "doc.*").toDF("at", *df.columns)
    assert {(r.doc_id, r.text, r.shard): r["at"] for r in back.collect()} == {(i, f"t{i}", "column of the table"): brute(str(i), standard(40)) for i in range(300)}


def test_no_rows(spark, docs):
    assert sharding.assigned(docs([]), standard(40), standard(41)).collect() == []
