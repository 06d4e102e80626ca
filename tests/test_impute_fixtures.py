"""Hand-computed fixtures (FIXTURES.md §3) for the imputation operators."""

import math

import pytest

from conftest import column
from lacuna.operators.impute.linear import impute_linear
from lacuna.operators.impute.local import impute_pchip, impute_akima
from lacuna.operators.impute import splines

N = None


def approx(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if y is None:
            assert x is None or (isinstance(x, float) and math.isnan(x))
        else:
            assert x == pytest.approx(y, abs=1e-9)


def test_gap_basic(series):
    df = series([1, N, 3, N, N, 6])
    for fn in (impute_linear, impute_pchip, impute_akima, splines.impute_quadratic):
        approx(column(fn(df, "level", out="filled")), [1, 2, 3, 4, 5, 6])
    # cubic needs 4 known values: unchanged
    approx(column(splines.impute_cubic(df, "level", out="filled")), [1, N, 3, N, N, 6])


def test_gap_edges(series):
    df = series([N, N, 2, N, 4, N])
    approx(column(impute_linear(df, "level", out="filled")), [2, 2, 2, 3, 4, 4])
    approx(column(impute_akima(df, "level", out="filled")), [N, N, 2, 3, 4, N])
    approx(column(impute_pchip(df, "level", out="filled")), [N, N, 2, 3, 4, 5])
    approx(column(splines.impute_cubic(df, "level", out="filled")), [N, N, 2, N, 4, N])
    approx(column(splines.impute_quadratic(df, "level", out="filled")), [N, N, 2, N, 4, N])


def test_all_null_and_one_value(series):
    for vals in ([N, N, N], [N, 5, N]):
        df = series(vals)
        for fn in (impute_pchip, impute_akima, splines.impute_cubic):
            approx(column(fn(df, "level", out="filled")), vals)


def test_affine_exact_inside(series):
    vals = [2 * i + 1 if i % 3 else None for i in range(20)]
    truth = [2 * i + 1 for i in range(20)]
    df = series(vals)
    for fn in (impute_linear, impute_pchip, impute_akima, splines.impute_cubic, splines.impute_quadratic):
        got = column(fn(df, "level", out="filled"))
        for i in range(1, 19):
            assert got[i] == pytest.approx(truth[i], abs=1e-9), (fn.__name__, i)


def _pchip_ref(x, y, xs):
    """Independent PCHIP (Fritsch–Carlson with the 3-point end rule), written from the published
    algorithm for this test."""
    import numpy as np
    h = np.diff(x)
    m = np.diff(y) / h
    n = len(x)
    d = np.zeros(n)
    if n == 2:
        d[:] = m[0]
    else:
        for k in range(1, n - 1):
            if m[k - 1] * m[k] <= 0:
                d[k] = 0.0
            else:
                w1, w2 = 2 * h[k] + h[k - 1], h[k] + 2 * h[k - 1]
                d[k] = (w1 + w2) / (w1 / m[k - 1] + w2 / m[k])

        def edge(h0, h1, m0, m1):
            e = ((2 * h0 + h1) * m0 - h0 * m1) / (h0 + h1)
            if np.sign(e) != np.sign(m0):
                return 0.0
            if np.sign(m0) != np.sign(m1) and abs(e) > 3 * abs(m0):
                return 3 * m0
            return e
        d[0] = edge(h[0], h[1], m[0], m[1])
        d[-1] = edge(h[-1], h[-2], m[-1], m[-2])
    out = []
    for v in xs:
        k = min(max(np.searchsorted(x, v) - 1, 0), n - 2)
        hh = x[k + 1] - x[k]
        t = (v - x[k]) / hh
        out.append((2*t**3 - 3*t**2 + 1) * y[k] + (t**3 - 2*t**2 + t) * hh * d[k]
                   + (-2*t**3 + 3*t**2) * y[k + 1] + (t**3 - t**2) * hh * d[k + 1])
    return out


def test_pchip_matches_reference_algorithm(series):
    import numpy as np
    vals = [1.0, 2.0, N, 5.0, 3.0, N, 8.0, 8.5, N, 2.0, N]
    got = column(impute_pchip(series(vals), "level", out="filled"))
    known = [(i, v) for i, v in enumerate(vals) if v is not None]
    x = np.array([k for k, _ in known], float)
    y = np.array([v for _, v in known], float)
    for i, v in enumerate(vals):
        if v is None:
            assert got[i] == pytest.approx(_pchip_ref(x, y, [float(i)])[0], abs=1e-9)


def test_native_splines_equal_b_splines(spark, series):
    """The sweeps against collocation in a B-spline basis, an independent way to the same splines."""
    import numpy as np
    r = np.random.default_rng(11)
    many = []
    for n in (3, 4, 5, 6, 9, 30, 84, 200):
        y = [None if r.random() < .35 else float(np.round(r.normal(), 3)) for _ in range(n)]
        many.append(y)
    df = None
    for i, y in enumerate(many):
        one = series(y, station=i)
        df = one if df is None else df.unionByName(one)
    for fn, k in ((splines.impute_cubic, 3), (splines.impute_quadratic, 2)):
        got = {}
        for x in fn(df, "level", out="filled").collect():
            got.setdefault(x.station_id, []).append((x.month, x.filled))
        for i, y in enumerate(many):
            known = np.array([j for j, v in enumerate(y) if v is not None], float)
            gaps = np.array([j for j, v in enumerate(y) if v is None], float)
            want = list(y)
            if len(known) >= k + 1 and len(gaps):
                for j, v in zip(gaps.astype(int), splines.interpolating_spline(known, np.array([y[int(j)] for j in known]), k, gaps)):
                    want[j] = None if np.isnan(v) else v
            approx([v for _, v in sorted(got[i])], want)


def test_splines_keep_columns_and_overwrite(series):
    df = series([1.0, N, 4.0, 9.0, N, 25.0])
    for fn in (splines.impute_cubic, splines.impute_quadratic, splines.impute_smoothing_spline):
        got = fn(df, "level")
        assert sorted(got.columns) == sorted(df.columns) and got.count() == 6 and got.filter("lon = 1.0").count() == 6


def test_smoothing_spline_meets_its_condition():
    """The residual sum is s within a thousandth, unless a polynomial does better; knots are points, as few as the scheme needs."""
    import numpy as np
    r = np.random.default_rng(12)
    for n, noise, s in ((30, 3.0, 30.0), (84, 2.0, 84.0), (84, 10.0, 84.0), (200, 1.5, 150.0), (60, .5, 60.0)):
        x = np.sort(r.choice(3 * n, n, replace=False)).astype(float)
        y = 10 * np.sin(x / 9) + r.normal(0, noise, n)
        t, c = splines.smoothing_fit(x, y, 3, s)
        total = float(((splines._evaluate(t, 3, c, x) - y) ** 2).sum())
        assert abs(total - s) <= 1.0001e-3 * s or len(t) == 8 and total < s or len(t) == n + 4
        assert set(t[4:-4]) <= set(x)
        if len(t) > 8:
            # no spline of these knots with that residual has smaller jumps: the gradient condition of the smoothing problem
            a, b = splines._design(t, 3, x), splines._jumps(t, 3)
            g1, g2 = a.T @ (a @ c - y), b.T @ (b @ c)
            weight = -(g1 @ g2) / (g2 @ g2)
            assert weight > 0 and np.allclose(g1 + weight * g2, 0, atol=1e-6 * np.abs(g1).max() + 1e-8)


def test_smoothing_spline_limits():
    import numpy as np
    x = np.arange(12.0)
    cubic = x ** 3 / 50 - x
    t, c = splines.smoothing_fit(x, cubic, 3, 1.0)
    assert len(t) == 8 and np.allclose(splines._evaluate(t, 3, c, x), cubic)
    y = np.where(x % 2 == 0, 30.0, -30.0)
    t, c = splines.smoothing_fit(x, y, 3, 1e-9)
    assert len(t) == 16 and np.allclose(splines._evaluate(t, 3, c, x), y, atol=1e-4)


def test_rational_search_finds_the_zero_of_a_rational_function():
    f = lambda p: (3 - 2 * p) / (p + 4)
    p, *_ = splines._rational(0.5, f(0.5), 1.0, f(1.0), 5.0, f(5.0))
    assert p == pytest.approx(1.5)
    assert splines._rational(0.5, f(0.5), 1.0, f(1.0), -1.0, -2.0)[0] == pytest.approx(1.5)


def test_smoothing_spline_factors_once_for_all_weights(monkeypatch):
    """A plain series needs no singular-value least squares, which would be solved anew for every knot set and weight."""
    import numpy as np
    r = np.random.default_rng(3)
    x = np.sort(r.choice(84, 70, replace=False)).astype(float)
    y = 25 + 10 * np.sin(x / 9) + r.normal(0, 2, 70)
    monkeypatch.setattr(np.linalg, "lstsq", lambda *a, **k: pytest.fail("lstsq"))
    t, c = splines.smoothing_fit(x, y, 3, 70.0)
    assert len(t) > 8 and float(((splines._evaluate(t, 3, c, x) - y) ** 2).sum()) == pytest.approx(70.0, rel=1e-3)


def test_no_window_reads_the_rest_of_a_series_at_every_row(spark, series):
    from lacuna.operators.impute import local, registry, similar
    from lacuna.operators.impute.linear import impute_linear
    df = series([1, None, 3, None, 2, 5, None])
    made = [fn(df, "level", out="filled") for fn in (impute_linear, local.impute_pchip, local.impute_akima)] + [similar.spectrum(df, "level", ["station_id"])]
    for plan in [m._jdf.queryExecution().optimizedPlan().toString() for m in made]:
        assert "currentrow$(), unboundedfollowing$()" not in plan and "RowFrame, 1, unboundedfollowing$()" not in plan
    assert "REPARTITION_BY_NUM" in registry.predictions_long(df, "level", ["pchip", "knn"])._jdf.queryExecution().executedPlan().toString()


def test_local_methods_change_direction_twice(spark, series):
    """All that looks back is computed together, and all that looks forward: three sorts of a series, not six."""
    from lacuna.operators.impute.local import impute_akima, impute_pchip
    df = series([1.0, None, 4.0, 2.0, None, 7.0])
    for fn in (impute_pchip, impute_akima):
        plan = fn(df, "level", out="f")._jdf.queryExecution().sparkPlan().toString()
        windows = [l for l in plan.splitlines() if "Window [" in l]
        assert 1 + sum(("DESC" in a) != ("DESC" in b) for a, b in zip(windows, windows[1:])) == 3
