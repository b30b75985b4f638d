import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import whitening


def brute(rows, wanted=4):
    """Exact integers, and the eigenvectors of the whole matrix."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(int(np.floor(256 * c)) for c in v) for _, v in ok]
    fit = np.array(sorted(set(x)))
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:wanted], u[:, ::-1][:, :wanted]
    out = []
    for (i, _), r in zip(ok, x):
        d = [n * a - int(s) for a, s in zip(r, sums)]
        out += [(i, k + 1, n, sum(a * a for a in d), abs(float(np.array(d) / n @ u[:, k] / np.sqrt(e[k]))), e[k] / np.trace(cov)) for k in range(len(e)) if e[k] > 1e-12 * np.trace(cov)]
    return sorted(out, key=str)


def result(spark, rows, extra=None, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns(extra or {})
    return whitening.whitened(df, **options).collect()


def agrees(got, want):
    got = sorted([tuple(r)[:6] for r in got], key=str)
    key = lambda r: (str(r[0]), r[1], r[3], round(abs(r[4]), 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([abs(g[4]) for g in got], [w[4] for w in want], atol=1e-9)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)


@pytest.mark.parametrize("width", [1, 2, 3, 5, 64, 100])
def test_equals_eigenvectors_of_the_whole_matrix(spark, width):
    r = np.random.default_rng(width)
    rows = [(i, (r.standard_normal(width) * (1 + np.arange(width))[::-1] + 3).tolist()) for i in range(300)]
    rows += rows[:50] + [(None, rows[3][1])]
    got = result(spark, rows)
    agrees(got, brute(rows))
    assert all(0 <= g.identity_error < 1e-12 for g in got)
    # the sign is the same for all rows
    for k in range(1, min(width, 4) + 1):
        white = np.array([g.whitened for g in got if g.component == k])
        assert abs(white.mean()) < 0.3 and white.std() > 0.5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), float(i * i % 7), 1.0]) for i in range(12)] + [(5, [5.0, 4.0, 1.0])] * 40
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 1.0]), (104, [inf, 1.0, 1.0]), (105, [1.0, 2.0])]
    got = result(spark, good + odd, {"x": F.lit(1), "n": F.lit("n"), "v": F.lit(2.0), "deviation": F.lit(0)})
    agrees(got, brute(good))
    assert {g.component for g in got} == {1, 2}  # the third dimension never changes


def test_few_and_no_rows(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None)]) == []
    assert result(spark, [(1, [1.0, 2.0])] * 3) == []
    got = result(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])
    assert {(g.vec_id, g.component, round(abs(g.whitened), 9)) for g in got} == {(1, 1, 1.0), (2, 1, 1.0)}


def test_overflow_raises(spark):
    with pytest.raises(Exception, match="(?i)overflow|too large"):
        result(spark, [(1, [1e300, 1.0]), (2, [0.0, 1.0]), (3, [-1e300, 2.0])])


def _with(eigenvalues, seed=3):
    r = np.random.default_rng(seed)
    u = np.linalg.qr(r.standard_normal((len(eigenvalues), len(eigenvalues))))[0]
    return u @ np.diag(eigenvalues) @ u.T, u


@pytest.mark.parametrize("values", [np.arange(1, 41.0), np.r_[np.ones(36), 1.0001, 1.0002, 5, 5.0000001], np.r_[np.zeros(38), 3, 7], 2.0 ** -np.arange(30)])
def test_inertia_counts(values):
    m, _ = _with(values)
    for shift in np.linspace(0.013, 1.1 * max(values), 17):
        assert whitening.inertia(m, shift) == (values > shift).sum()


def test_inertia_of_matrices_with_empty_diagonals():
    m = np.array([[0, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 2.0], [0, 0, 2.0, 0]])
    assert whitening.inertia(m, 0.0) == 2 and whitening.inertia(m, 1.5) == 1 and whitening.inertia(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize(
    "values",
    [np.arange(1, 65.0), np.ones(40), np.r_[np.ones(60), 9, 9, 9, 9, 9], np.r_[np.full(50, 1.0), 1 + 1e-4 * np.arange(10)], 10.0 ** -np.arange(20), np.r_[np.zeros(30), 1, 2, 3]],
    ids=["even", "equal", "five equal", "close", "steep", "few"],
)
def test_leading_pairs(spark, values):
    m, _ = _with(values)
    e, u = whitening.leading(spark, m, 4)
    want = sorted(values, reverse=True)[: len(e)]
    assert len(e) == min(4, (values > 0).sum()) and np.allclose(e, want, rtol=1e-11, atol=1e-14)
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12) and np.abs(m @ u - u * e).max() < 1e-12 * values.max() * len(m)


def test_intervals_hold_all_wanted():
    m, _ = _with(np.r_[np.linspace(0, 1, 100), np.linspace(2, 3, 30)])
    m = m / np.trace(m)
    found = whitening.intervals(m, 25)
    e = np.linalg.eigvalsh(m)
    assert all(x.count == ((e > x.low) & (e <= x.high)).sum() <= whitening.PER_INTERVAL for x in found) and sum(x.count for x in found) >= 25
