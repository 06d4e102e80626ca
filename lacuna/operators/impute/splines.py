"""H2, H3, H4: spline imputation per station, fitted on the known rows against the row position and
evaluated at the null rows. A series (bounded by the calendar) is gathered once as an array.

  H2 cubic       C² interpolating cubic spline, not-a-knot ends; needs ≥ 4 known values;
                 rows outside [first known, last known] stay null.
  H3 quadratic   C¹ interpolating quadratic spline with breakpoints midway between known points but for the first
                 and the last pair; needs ≥ 3 known; ends null. Other orders (``deg``): interpolating B-spline.
  H4 smoothing   the published scheme for smoothing splines with s = number of known points: knots are added where the
                 residual per interval is largest until the least-squares spline has a residual sum ≤ s, then the
                 weight of the jumps of the highest derivative is searched by rational interpolation
                 until the residual is s within a thousandth; leading rows null, trailing rows extrapolated.

H2 and H3 are JVM expressions: their equations are tridiagonal, and a forward and a backward sweep are two
``aggregate`` calls over the series' array. H4 is NumPy in Arrow batches of such arrays. Too few known values →
the series is returned unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH


def _design(t: np.ndarray, k: int, xs: np.ndarray) -> np.ndarray:
    """Values of all B-splines at all ``xs`` (Cox–de Boor, the k + 1 that are not zero at a point at once)."""
    n = len(t) - k - 1
    j = np.clip(np.searchsorted(t, xs, side="right") - 1, k, n - 1)
    b = np.zeros((k + 1, len(xs)))
    b[0] = 1.0
    for d in range(1, k + 1):
        saved = np.zeros(len(xs))
        for r in range(d):
            right, left = t[j + r + 1] - xs, xs - t[j + 1 - d + r]
            den = right + left
            tmp = np.where(den != 0, b[r] / np.where(den != 0, den, 1.0), 0.0)
            b[r] = saved + right * tmp
            saved = left * tmp
        b[d] = saved
    a = np.zeros((len(xs), n))
    a[np.arange(len(xs))[:, None], (j - k)[:, None] + np.arange(k + 1)] = b.T
    return a


def _evaluate(t: np.ndarray, k: int, c: np.ndarray, xs: np.ndarray) -> np.ndarray:
    return _design(t, k, xs) @ c


def _banded_solve(a: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Gaussian elimination without pivoting on the collocation matrix (banded, totally positive)."""
    a = a.copy()
    y = y.astype(float).copy()
    n = len(y)
    for i in range(n):
        p = a[i, i]
        hi = min(n, i + k + 1)
        for r in range(i + 1, hi):
            if a[r, i] != 0.0:
                f = a[r, i] / p
                a[r, i:min(n, i + 2 * k + 2)] -= f * a[i, i:min(n, i + 2 * k + 2)]
                y[r] -= f * y[i]
    c = np.zeros(n)
    for i in range(n - 1, -1, -1):
        hi = min(n, i + 2 * k + 2)
        c[i] = (y[i] - a[i, i + 1:hi] @ c[i + 1:hi]) / a[i, i]
    return c


def interp_knots(x: np.ndarray, k: int) -> np.ndarray:
    if k % 2 == 1:
        m = (k - 1) // 2
        inner = x[m + 1:len(x) - m - 1]
    else:
        mid = (x[1:] + x[:-1]) / 2.0
        inner = mid[1:-1]
    return np.r_[(x[0],) * (k + 1), inner, (x[-1],) * (k + 1)]


def interpolating_spline(x: np.ndarray, y: np.ndarray, k: int, xs: np.ndarray) -> np.ndarray:
    t = interp_knots(x, k)
    c = _banded_solve(_design(t, k, x), y, k)
    out = np.full(len(xs), np.nan)
    inside = (xs >= x[0]) & (xs <= x[-1])
    if inside.any():
        out[inside] = _evaluate(t, k, c, xs[inside])
    return out


TOLERANCE, ROUNDS = 1e-3, 20


def smoothing_spline(x: np.ndarray, y: np.ndarray, xs: np.ndarray, k: int = 3, s: float | None = None) -> np.ndarray:
    """The smoothing spline of degree k with residual sum s (default: the number of points), at ``xs``: NaN before the first point,
    the last piece continued behind the last."""
    t, c = smoothing_fit(x, y, k, float(len(x)) if s is None else s)
    out = np.full(len(xs), np.nan)
    ok = xs >= x[0]
    if ok.any():
        out[ok] = _evaluate(t, k, c, np.asarray(xs[ok], dtype=float))
    return out


def smoothing_fit(x: np.ndarray, y: np.ndarray, k: int, s: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots and coefficients by the published scheme (Dierckx): first the knots, then the smoothing parameter."""
    edge = lambda inner: np.r_[(x[0],) * (k + 1), inner, (x[-1],) * (k + 1)]
    inner, added, last_sum, within = np.zeros(0), 0, 0.0, TOLERANCE * s
    while True:
        t = edge(inner)
        a = _design(t, k, x)
        c = least_squares(a, y)
        terms = (y - a @ c) ** 2
        total = float(terms.sum())
        if len(inner) == 0:
            polynomial = total
        if abs(total - s) < within or (total < s and len(inner) == 0):
            return t, c
        if total < s:
            return t, _smoothed(x, y, t, a, k, s, polynomial, total)
        if len(inner) >= len(x) - k - 1:  # as many knots as an interpolating spline has
            return t, c
        # how many knots more: as the last ones lowered the sum, at most twice as many as then
        if len(inner) == 0:
            added = 1
        else:
            wanted = int(added * (total - s) / (last_sum - total)) if last_sum - total > within else 2 * added
            added = min(2 * added, max(wanted, added // 2, 1))
        last_sum = total
        inner = _more_knots(x, inner, terms, added, len(x) - k - 1)
        if len(inner) == len(x) - k - 1:
            inner = interp_knots(x, k)[k + 1:-k - 1]


def _more_knots(x: np.ndarray, inner: np.ndarray, terms: np.ndarray, added: int, most: int) -> np.ndarray:
    """``added`` knots more, each at the middle point of the interval with the largest residual sum of those that hold a
    point; an interval's sum counts points on its ends by half, and is split in proportion to the points."""
    at = np.searchsorted(x, inner)  # knots are data points
    ends = np.r_[0, at, len(x) - 1]
    sums = [float(terms[lo + 1:hi].sum() + (terms[lo] / 2 if lo else terms[0]) + (terms[hi] / 2 if hi < len(x) - 1 else terms[hi])) for lo, hi in zip(ends[:-1], ends[1:])]
    spans = [(int(lo), int(hi - lo - 1)) for lo, hi in zip(ends[:-1], ends[1:])]  # first point, points inside
    for _ in range(added):
        if len(spans) - 1 >= most:
            break
        open_ = [(sums[i], -i) for i in range(len(spans)) if spans[i][1] and sums[i] > 0]
        if not open_:
            break
        i = -max(open_)[1]
        (lo, points), total = spans[i], sums[i]
        half = points // 2 + 1
        spans[i:i + 1] = [(lo, half - 1), (lo + half, points - half)]
        sums[i:i + 1] = [total * (half - 1) / points, total * (points - half) / points]
    return x[[lo for lo, _ in spans[1:]]]


def _triangle(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Q and the inverse of R of ``a``; None if its columns are dependent or nearly so, where singular values decide."""
    if a.shape[0] < a.shape[1]:
        return None
    q, r = np.linalg.qr(a)
    try:
        inverse = np.linalg.inv(r)
    except np.linalg.LinAlgError:
        return None
    return (q, inverse) if np.linalg.norm(r) * np.linalg.norm(inverse) < 1e4 else None


def least_squares(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    found = _triangle(a)
    return np.linalg.lstsq(a, y, rcond=None)[0] if found is None else found[1] @ (found[0].T @ y)


def _jumps(t: np.ndarray, k: int) -> np.ndarray:
    """Jumps of the k-th derivative of every B-spline at every inner knot, scaled by the mean distance of knots."""
    n, inner = len(t) - k - 1, len(t) - 2 * k - 2
    scale = (inner + 1) / (t[-1] - t[0])
    out = np.zeros((inner, n))
    r = np.arange(inner)
    at = k + 1 + r
    for m in range(k + 2):  # the spline j = r + m has the knots j … j + k + 1, and the one at hand among them
        j = r + m
        product = np.ones(inner)
        for i in range(k + 2):
            if i != k + 1 - m:
                product = product * (t[at] - t[j + i])
        out[r, j] = (t[j + k + 1] - t[j]) / (product * scale ** k)
    return out


def _weighted(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray):
    """A function of p: the coefficients c with the least |y - a c|² + |b c|² / p², and the residual sum of the first part.

    With a = Q R and the singular values s of b R⁻¹ all p have the same vectors: along one of them the plain fit shrinks by
    p² / (s² + p²)."""
    found = _triangle(a)
    if found is None:
        def direct(p):
            c = np.linalg.lstsq(np.vstack([a, b / p]), np.r_[y, np.zeros(len(b))], rcond=None)[0]
            return (lambda: c), float(((y - a @ c) ** 2).sum())
        return direct
    q, inverse = found
    plain = q.T @ y
    rest = float(((y - q @ plain) ** 2).sum())
    _, s, v = np.linalg.svd(b @ inverse, full_matrices=False)
    along = v @ plain

    def at(p):
        less = s * s / (s * s + p * p) * along
        return (lambda: inverse @ (plain - v.T @ less)), rest + float((less * less).sum())
    return at


def _smoothed(x: np.ndarray, y: np.ndarray, t: np.ndarray, a: np.ndarray, k: int, s: float, polynomial: float, least: float) -> np.ndarray:
    """Coefficients for these knots whose residual sum is s within TOLERANCE: the weight p of the fit against the jumps is found
    by interpolating the sum as a rational function of p, from p = 0 (the polynomial) and p = infinity (least squares)."""
    fit = _weighted(x, y, a, _jumps(t, k))
    p = len(a[0]) / float(np.abs(np.diag(np.linalg.qr(a, mode="r"))).sum())
    p1, f1, p3, f3 = 0.0, polynomial - s, -1.0, least - s
    seen_below = seen_above = False
    for _ in range(ROUNDS):
        c, total = fit(p)
        f2 = total - s
        if abs(f2) < TOLERANCE * s:
            break
        if not seen_below:
            if f2 - f3 <= TOLERANCE * s:  # p is too large to tell from infinity
                p3, f3, p = p, f2, p * 0.04
                if p <= p1:
                    p = 0.9 * p1 + 0.1 * p3
                continue
            seen_below = f2 < 0
        if not seen_above:
            if f1 - f2 <= TOLERANCE * s:  # p is too small to tell from nothing
                p1, f1, p = p, f2, p / 0.04
                if p3 >= 0 and p >= p3:
                    p = 0.1 * p1 + 0.9 * p3
                continue
            seen_above = f2 > 0
        if f2 >= f1 or f2 <= f3:
            break
        p, p1, f1, p3, f3 = _rational(p1, f1, p, f2, p3, f3)
    return c()


def _rational(p1: float, f1: float, p2: float, f2: float, p3: float, f3: float) -> tuple[float, float, float, float, float]:
    """The zero of (u p + v) / (p + w) through three points (p3 < 0 stands for infinity), and the points that enclose it."""
    if p3 > 0:
        h1, h2, h3 = f1 * (f2 - f3), f2 * (f3 - f1), f3 * (f1 - f2)
        p = -(p1 * p2 * h3 + p2 * p3 * h1 + p3 * p1 * h2) / (p1 * h1 + p2 * h2 + p3 * h3)
    else:
        p = (p1 * (f1 - f3) * f2 - p2 * (f2 - f3) * f1) / ((f1 - f2) * f3)
    return (p, p1, f1, p2, f2) if f2 < 0 else (p, p2, f2, p3, f3)


# ---------------------------------------------------------------- series as arrays and back
def _gathered(df: DataFrame, value: str, station: str, time: str) -> DataFrame:
    """station, ``_s`` (all rows in time order, as time, value and the other columns), ``_p`` and ``_y``: positions and values of the known rows."""
    rest = [c for c in df.columns if c != station]
    g = df.groupBy(station).agg(F.sort_array(F.collect_list(F.struct(F.col(time).alias("_t"), F.col(value).cast("double").alias("_v"), F.struct(*rest).alias("_r")))).alias("_s"))
    g = g.withColumn("_k", F.filter(F.transform("_s", lambda r, i: F.struct(i.cast("double").alias("p"), r["_v"].alias("y"))), lambda r: r["y"].isNotNull()))
    return g.select(station, "_s", F.col("_k.p").alias("_p"), F.col("_k.y").alias("_y"))


def _spread(g: DataFrame, df: DataFrame, out: str, station: str, value) -> DataFrame:
    """The rows of ``df`` with ``out`` = ``value`` (a function of row position and known value) where there is none."""
    rows = g.select("*", F.posexplode("_s").alias("_i", "_row")).drop("_s")
    res = F.coalesce(F.col("_row._v"), value(F.col("_i").cast("double")))
    rows = rows.select(F.col(station).alias("_station"), F.col("_row._r").alias("_r"), res.alias("_out"))
    cols = [F.col("_station").alias(c) if c == station else F.col(f"_r.`{c}`").alias(c) for c in df.columns if c != out]
    return rows.select(*cols, F.col("_out").alias(out))


def _at(a: str | Column, i) -> Column:
    return F.get(F.col(a) if isinstance(a, str) else a, i)


def sweep(rows: Column) -> Column:
    """The solution of a tridiagonal system, rows given as array<struct<a, b, c, r>> (below, on and above the
    diagonal, right side): elimination from the first row on, substitution from the last one back."""
    pair = "struct<c:double,r:double>"
    start = F.struct(F.array().cast(f"array<{pair}>").alias("rows"), F.lit(0.0).alias("c"), F.lit(0.0).alias("r"))

    def forward(acc, x):
        d = x["b"] - x["a"] * acc["c"]
        c, r = x["c"] / d, (x["r"] - x["a"] * acc["r"]) / d
        return F.struct(F.concat(acc["rows"], F.array(F.struct(c.alias("c"), r.alias("r")))).alias("rows"), c.alias("c"), r.alias("r"))

    def backward(acc, x):
        v = x["r"] - x["c"] * acc["last"]
        return F.struct(F.concat(F.array(v), acc["x"]).alias("x"), v.alias("last"))

    reduced = F.reverse(F.aggregate(rows, start, forward, lambda acc: acc["rows"]))
    return F.aggregate(reduced, F.struct(F.array().cast("array<double>").alias("x"), F.lit(0.0).alias("last")), backward, lambda acc: acc["x"])


def _row(a, b, c, r) -> Column:
    return F.struct(a.alias("a"), b.alias("b"), c.alias("c"), r.alias("r"))


def impute_cubic(df: DataFrame, value: str, station: str = STATION, time: str = MONTH, out: str | None = None) -> DataFrame:
    """H2. Unknowns are the second derivatives at the inner known points; those at the ends follow from them."""
    out = out or value
    g = _gathered(df, value, station, time).withColumn("_m", F.size("_p"))
    h = lambda i: _at("_p", i + 1) - _at("_p", i)
    d = lambda i: (_at("_y", i + 1) - _at("_y", i)) / h(i)
    last = F.col("_m") - 2

    def equation(i):
        h0, h1 = h(i - 1), h(i)
        a = F.when(i == 1, F.lit(0.0)).when(i == last, h0 - h1 * h1 / h0).otherwise(h0)
        c = F.when(i == last, F.lit(0.0)).when(i == 1, h1 - h0 * h0 / h1).otherwise(h1)
        b = 2 * (h0 + h1) + F.when(i == 1, h0 + h0 * h0 / h1).otherwise(F.lit(0.0)) + F.when(i == last, h1 + h1 * h1 / h0).otherwise(F.lit(0.0))
        return _row(a, b, c, 6 * (d(i) - d(i - 1)))

    inner = F.when(F.col("_m") >= 4, sweep(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), equation)))
    g = g.withColumn("_in", inner)
    n = F.size("_in")
    first = _at("_in", F.lit(0)) + h(F.lit(0)) / h(F.lit(1)) * (_at("_in", F.lit(0)) - _at("_in", F.lit(1)))
    end = _at("_in", n - 1) + h(last) / h(last - 1) * (_at("_in", n - 1) - _at("_in", n - 2))
    g = g.withColumn("_c", F.when(F.col("_in").isNotNull(), F.concat(F.array(first), "_in", F.array(end))))

    def at(x):
        k = F.size(F.filter("_p", lambda p: p <= x)) - 1
        step, left = _at("_p", k + 1) - _at("_p", k), x - _at("_p", k)
        right = step - left
        v = ((_at("_c", k) * right * right * right + _at("_c", k + 1) * left * left * left) / (6 * step)
             + (_at("_y", k) / step - _at("_c", k) * step / 6) * right + (_at("_y", k + 1) / step - _at("_c", k + 1) * step / 6) * left)
        return F.when((k >= 0) & (k + 1 < F.col("_m")), v)

    return _spread(g, df, out, station, at)


def impute_quadratic(df: DataFrame, value: str, station: str = STATION, time: str = MONTH, out: str | None = None,
                     deg: int = 2) -> DataFrame:
    """H3. Unknowns are the slopes midway between the known points; the first and the last one are the secants."""
    out = out or value
    if deg != 2:
        return _fitted(df, value, out, station, time, lambda x, y, xs: interpolating_spline(x, y, deg, xs) if len(x) >= deg + 1 else None)
    g = _gathered(df, value, station, time).withColumn("_m", F.size("_p"))
    h = lambda i: _at("_p", i + 1) - _at("_p", i)
    d = lambda i: (_at("_y", i + 1) - _at("_y", i)) / h(i)
    last = F.col("_m") - 2  # the last pair

    def equation(j):
        before, own, after = h(j - 1), h(j), h(j + 1)
        a, c = own / (before + own), own / (own + after)
        b = before / (before + own) + 2 + after / (own + after)
        r = 4 * d(j) - F.when(j == 1, a * d(F.lit(0))).otherwise(F.lit(0.0)) - F.when(j == last - 1, c * d(last)).otherwise(F.lit(0.0))
        return _row(F.when(j == 1, F.lit(0.0)).otherwise(a), b, F.when(j == last - 1, F.lit(0.0)).otherwise(c), r)

    inner = F.when(F.col("_m") >= 4, sweep(F.transform(F.sequence(F.lit(1), F.greatest(last - 1, F.lit(1))), equation))).otherwise(F.array().cast("array<double>"))
    g = g.withColumn("_sl", F.when(F.col("_m") >= 3, F.concat(F.array(d(F.lit(0))), inner, F.array(d(last)))))

    def at(x):
        k = F.size(F.filter("_p", lambda p: p <= x)) - 1
        near = F.when(x > (_at("_p", k) + _at("_p", k + 1)) / 2, k + 1).otherwise(k)
        j = F.least(F.greatest(near, F.lit(1)), last)
        before, own, u = h(j - 1), h(j), x - _at("_p", j)
        s0, s1 = _at("_sl", j - 1), _at("_sl", j)
        v = _at("_y", j) + (s0 * own + s1 * before) / (before + own) * u + (s1 - s0) / (before + own) * u * u
        return F.when((k >= 0) & (k + 1 < F.col("_m")), v)

    return _spread(g, df, out, station, at)


def _fitted(df: DataFrame, value: str, out: str, station: str, time: str, fit) -> DataFrame:
    """``out`` at the null rows from ``fit(known positions, known values, positions asked)``, a series at a time in Arrow batches."""
    g = _gathered(df, value, station, time)
    kind = g.schema[station].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = []
            for p, y, n in zip(b.column(1), b.column(2), b.column(3).to_pylist()):
                p, y, res = p.values.to_numpy(), y.values.to_numpy(), np.full(n, np.nan)
                gaps = np.setdiff1d(np.arange(n), p.astype(int))
                values = fit(p, y, gaps.astype(float)) if len(gaps) else None
                if values is not None:
                    res[gaps] = values
                found.append(res)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.float64()))], [station, "_f"])

    fits = g.select(station, "_p", "_y", F.size("_s").alias("n")).mapInArrow(run, f"`{station}` {kind}, _f array<double>")
    return _spread(g.join(fits, station), df, out, station, lambda i: F.nanvl(F.get("_f", i.cast("int")), F.lit(None).cast("double")))


def impute_smoothing_spline(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                            out: str | None = None, deg: int = 3) -> DataFrame:
    """H4."""
    return _fitted(df, value, out or value, station, time, lambda x, y, xs: smoothing_spline(x, y, xs, deg) if len(x) > deg else None)
