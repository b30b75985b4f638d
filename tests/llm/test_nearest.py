import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import nearest


def brute(rows, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q in ok:
        if i % 50 == 0:
            found = sorted((-float(nearest.cosines(v[None], q)[0]), j) for j, v in ok if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def result(spark, rows, extra=None):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns(extra or {})
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.nearest(df, F.col("vec_id") % 50 == 0).collect())


@pytest.mark.parametrize("width", [1, 3, 64, 100])
def test_equals_brute_force(spark, width):
    r = np.random.default_rng(width)
    centre = r.standard_normal((6, width))
    rows = [(i, (centre[r.integers(6)] * (1 + r.random()) + 0.3 * r.standard_normal(width)).tolist()) for i in range(700)]
    got, want = result(spark, rows), brute(rows)
    assert len(got) == len(want)
    assert len({g[0::2][:2] for g in got} & {w[0::2][:2] for w in want}) >= (0.99 if width > 1 else 0) * len(want)
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-12)


def test_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(30)] + [(50, [1.0, 2.0, 2.0]), (51, None), (52, []), (53, [0.0, 0.0, 0.0]), (54, [1.0, None, 1.0])]
    rows += [(55, [nan, 1.0, 1.0]), (56, [inf, 1.0, 1.0]), (57, [1.0, 1.0]), (None, [1.0, 2.0, 2.0]), (100, None), (150, [1e200, 0.0, 0.0]), (60, [1e-200, 1e-200, 0.0])]
    got = result(spark, rows, {"block": F.lit(1), "ids": F.lit("x"), "q": F.lit(2), "score": F.lit(0)})
    assert [g[:3] for g in got if g[0] == 50] == [(50, n + 1, n) for n in range(5)]
    assert [g[:3] for g in got if g[0] == 0] == [(0, n, n) for n in range(1, 6)]
    assert {g[0] for g in got} == {0, 50, 150}


def test_few_and_no_rows(spark):
    assert result(spark, []) == []
    assert result(spark, [(0, [1.0, 0.0])]) == []
    assert result(spark, [(0, [1.0, 0.0]), (7, [1.0, 1.0])]) == [(0, 1, 7, 1 / np.sqrt(2.0))]


def test_bounds_hold(spark):
    r = np.random.default_rng(9)
    v = r.standard_normal((500, 48))
    c = nearest.Coder(v, 48)
    q = nearest._unit(r.standard_normal((40, 48)))
    estimate, error = c.bounds(*c.encode(v), q)
    assert (np.abs(estimate - nearest._unit(v) @ q.T) <= error).all()


def test_queries_of_all_lanes_are_not_broadcast(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(120)], "vec_id bigint, embedding array<float>")
    found = nearest.nearest(df, F.col("vec_id") % 50 == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [(r.query_id, r["rank"], r.vec_id) for r in found.collect() if r.query_id == 100] == [(100, n + 1, i) for n, i in enumerate((101, 99, 102, 98, 103))]
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_single_precision_is_kept_in_it(spark, monkeypatch):
    kinds = []
    real = nearest._blocks
    monkeypatch.setattr(nearest, "_blocks", lambda *a: kinds.append(a[3]) or real(*a))
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(7).astype(np.float32).astype(float).tolist()) for i in range(200)]
    single = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in nearest.nearest(single, F.col("vec_id") % 50 == 0).collect())
    assert got == result(spark, rows)
    assert kinds == ["float32"] * 2 + ["float64"] * 2
