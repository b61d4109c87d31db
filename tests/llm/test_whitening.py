import numpy as np
import pytest
from pyspark.sql import functions as F

from roadwatch.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def spectra(d, kind):
    rng = np.random.default_rng(d + kind)
    if kind == 0:
        return np.cov(rng.standard_normal((3 * d + 5, d)).T, bias=True).reshape(d, d)
    if kind == 1:
        return 3.0 * np.eye(d)  # one eigenvalue d times
    if kind == 2:  # repeated eigenvalues
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        v = (q * np.r_[5, 5, 5, 1, 1, .5, np.full(max(0, d - 6), .1)][:d]) @ q.T
        return (v + v.T) / 2
    q = rng.standard_normal((3, d))  # rank 3
    return q.T @ q


@pytest.mark.parametrize("kind", [0, 1, 2, 3])
@pytest.mark.parametrize("d", [1, 2, 7, 64])
def test_leading_eigenpairs(d, kind):
    v = spectra(d, kind)
    want = np.linalg.eigvalsh(v)[::-1]
    e, x = W.leading(v, 8)
    assert len(e) == min(8, d, 3 if kind == 3 else d)
    assert np.allclose(e, want[:len(e)], rtol=1e-12, atol=1e-13 * want[0])
    assert np.allclose(x @ x.T, np.eye(len(x)), atol=1e-12)
    assert np.abs(v @ x.T - x.T * e).max() < 1e-13 * want[0] * d


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 3, 20):
        a = rng.standard_normal((d, d))
        a = a + a.T
        w = np.linalg.eigvalsh(a)
        for s in rng.uniform(w[0] - 1, w[-1] + 1, 20):
            assert W.above(a, s) == (w > s).sum()
    assert W.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # needs a pivot of two rows
    assert W.above(np.zeros((3, 3)), 0.0) == 0


def brute(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100000
    n, total = len(x), x.sum(axis=0)
    deviation = [sum(int(n * a - s) ** 2 for a, s in zip(row.tolist(), total.tolist())) for row in x]
    y = (n * x - total) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    return deviation, (y @ v / np.sqrt(np.maximum(e, 1e-300)))[:, :k], (e / e.sum())[:k]


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = (rng.standard_normal((300, 12)) * np.linspace(1, 2, 12)).astype(np.float32)
    y = rng.standard_normal((40, 3)).astype(np.float32)
    x[50:120] = x[50]  # copies
    x[5] = 0
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(1000 + i, [float(c) for c in v]) for i, v in enumerate(y)]
    odd = [(5000, None), (5001, [None] * 12), (5002, [float("nan")] * 12), (5003, [float("-inf")] * 12), (5004, [])]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "v", "n", "component")}).repartition(3)
    got = {(r.vec_id, r.component): r for r in W.whiten(df).collect()}
    assert len(got) == 300 * 8 + 40 * 3
    for at, part in ((0, x), (1000, y)):
        deviation, white, share = brute(part)
        k = min(8, part.shape[1])
        found = np.array([[got[at + i, c + 1].whitened for c in range(k)] for i in range(len(part))])
        sign = np.sign((found * white[:, :k]).sum(axis=0))
        assert np.allclose(found * sign, white[:, :k], atol=1e-9)
        for i in range(len(part)):
            r = got[at + i, 1]
            assert (r.n, int(r.deviation)) == (len(part), deviation[i])
            assert abs(r.explained - share[0]) < 1e-12 and 0 <= r.identity_error < 1e-9


def test_degenerate_tables(spark):
    of = lambda rows: W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert of([]) == [] and of([(1, None)]) == [] and of([(1, [1.0, 2.0])]) == []
    assert of([(i, [1.0, 2.0]) for i in range(5)]) == []  # no variance
    line = of([(i, [float(i), float(i), 0.0]) for i in range(4)] + [(None, [9.0, 9.0, 0.0])])  # rank 1, a row without id
    assert {r.component for r in line} == {1} and len(line) == 5 and any(r.vec_id is None for r in line)
    huge = of([(0, [3e38, 0.0]), (1, [-3e38, 1.0]), (2, [0.0, 2.0])])
    assert {r.vec_id for r in huge} == {0, 1, 2} and all(np.isfinite(r.whitened) for r in huge)


def test_whole_number_arithmetic_is_exact():
    rng = np.random.default_rng(4)
    x = rng.integers(-2 ** 39, 2 ** 39, (20, 5))
    total = np.array([int(s) for s in x.sum(axis=0)], object) * 10 ** 6
    c = W.centred(x, 10 ** 9, total)
    assert [[10 ** 9 * a - s for a, s in zip(row, total)] for row in x.tolist()] == c.tolist()
    got = W.squares(c).to_pylist()
    assert [None if g is None else int(g) for g in got] == [s if (s := sum(e * e for e in row)) < 10 ** 38 else None for row in c.tolist()]
