import numpy as np
import pytest

from lacuna.llm import whitening as W


@pytest.mark.parametrize("d", [1, 2, 3, 7, 30])
def test_tridiagonal_keeps_eigenvalues(d):
    a = np.random.default_rng(d).normal(size=(d, d))
    a = a @ a.T
    diagonal, off, mirrors = W.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(np.linalg.eigvalsh(t), np.linalg.eigvalsh(a))
    at = np.linalg.eigvalsh(a)
    middle = (at[1:] + at[:-1]) / 2
    assert W.sturm_count(diagonal, off, middle).tolist() == list(range(1, d))


def matrices():
    r = np.random.default_rng(4)
    q = np.linalg.qr(r.normal(size=(12, 12)))[0]
    yield "random", (lambda b: b @ b.T)(r.normal(size=(20, 20)))
    yield "one cluster", q @ np.diag([5.0, 5, 5, 5 - 1e-13, 3, 3, 1, 1, 1, 0, 0, 0]) @ q.T
    yield "close", q @ np.diag([2 + 1e-9, 2, 2 - 1e-9, 1, .5, .5, .4, .3, .2, .1, .05, 0]) @ q.T
    yield "diagonal", np.diag([1.0, 9, 4, 4, 9, 2])
    yield "identity", np.eye(6)
    yield "zero", np.zeros((5, 5))
    yield "rank one", np.outer(np.arange(6.0), np.arange(6.0))
    yield "huge", (lambda b: b @ b.T)(r.normal(size=(8, 8))) * 1e200
    yield "tiny", (lambda b: b @ b.T)(r.normal(size=(8, 8))) * 1e-200
    yield "graded", q @ np.diag(10.0 ** -np.arange(12)) @ q.T


@pytest.mark.parametrize("name,a", list(matrices()))
@pytest.mark.parametrize("k", [1, 4, 99])
def test_leading_components(name, a, k):
    values, vectors = W.leading_components(a, k)
    k, size = min(k, len(a)), max(float(np.abs(a).max()), 1e-300)
    want, theirs = np.linalg.eigh(a)
    assert np.allclose(values / size, want[::-1][:k] / size, atol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-12)
    assert np.abs(a / size @ vectors.T - vectors.T * (values / size)).max() < 1e-12
    gap = np.diff(want[::-1])[:k] / size
    for j in range(k):
        if (j == 0 or abs(gap[j - 1]) > 1e-3) and (j >= len(gap) or abs(gap[j]) > 1e-3):
            assert abs(abs(vectors[j] @ theirs[:, -1 - j]) - 1) < 1e-12


def brute(rows, scale=256):
    ok = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    d = max((len(v) for _, v in ok), default=0)
    if not d:
        return []
    x = [(i, tuple(int(np.floor(scale * c)) for c in v) + (0,) * (d - len(v))) for i, v in ok]
    own = np.array(sorted({v for _, v in x}))
    n, s = len(own), [sum(int(c) for c in col) for col in own.T]
    c = own - np.array(s) / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    return [(i, k + 1, n, sum((n * a - b) ** 2 for a, b in zip(v, s)), abs((np.array(v) - np.array(s) / n) @ u[:, -1 - k] / np.sqrt(e[-1 - k])),
             e[-1 - k] / np.trace(cov)) for i, v in x for k in range(min(4, d))]


def frame(spark, rows, parts=3):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n int, x int")
    return df.repartition(parts)


def test_equals_numpy(spark):
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=9) * np.linspace(.2, 3, 9)).tolist()) for i in range(400)]
    rows += [(i + 1000, rows[7][1]) for i in range(300)] + [(5, rows[3][1])]  # copies count once
    key = lambda t: t[:2]
    got = sorted(map(tuple, W.whiten(frame(spark, rows)).collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([abs(g[4]) for g in got], [w[4] for w in want], atol=1e-9)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12)
    assert len({g[6] for g in got}) == 1 and got[0][6] < 1e-12
    at = {g[0] for g in got if g[0] >= 1000}
    one = {(g[1], g[4]) for g in got if g[0] in at}
    assert len(one) == 4  # the same sign for all rows


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []),
            (20, [0.5, -0.5]), (20, [0.5, -0.5]), (None, [1.0, 1.0]), (7, [-1.0, 0.01, 3.0]), (8, [0.0, 0.0, 0.0]), (9, [-0.0])]
    got = [tuple(x) for x in W.whiten(frame(spark, rows)).collect()]
    want = brute(rows)
    order = lambda t: (t[0] is None, t[0] or 0, t[1])
    assert [g[:4] for g in sorted(got, key=order)] == [w[:4] for w in sorted(want, key=order)]
    assert np.allclose([abs(g[4]) for g in sorted(got, key=order)], [w[4] for w in sorted(want, key=order)])


def test_nothing_to_fit_and_no_variance(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    same = W.whiten(frame(spark, [(1, [.5, .25]), (2, [.5, .25])])).collect()
    assert {(x.vec_id, x.component, x.n, x.deviation, x.whitened, x.explained, x.identity_error) for x in same} == \
        {(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)}
    line = W.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)])).collect()
    assert all((x.whitened is None) == (x.component > 1) for x in line) and abs(line[0].identity_error) < 1e-12


def test_deviations_are_exact_or_an_error():
    x, sums = np.array([[10 ** 8, -5], [3, 7]]), [10 ** 9, 12]
    assert W.deviations(x, 20, sums, 10 ** 8).tolist() == [sum((20 * int(a) - b) ** 2 for a, b in zip(row, sums)) for row in x]
    with pytest.raises(ArithmeticError):
        W.deviations(x, 10 ** 3, sums, 10 ** 8)
    assert W.deviations(np.array([[10 ** 9]]), 3, [3 * 10 ** 9 - 1], 10 ** 9).tolist() == [1]  # through whole numbers of any size


def test_entries_beyond_a_long(spark):
    with pytest.raises(Exception, match="beyond a long"):
        W.whiten(frame(spark, [(1, [1e300]), (2, [1.0])])).collect()
