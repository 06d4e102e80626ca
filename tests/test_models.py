"""Properties of the model family, and the window models against NumPy's closed form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import column, month
from lacuna.operators import windows as WIN
from lacuna.operators.impute import models as MD
from lacuna.operators.impute import window_model as WM

N = None


def test_forest_needs_three_rows(spark, series):
    df = series([1.0, N, N, 2.0, N]).selectExpr("*", "cast(1 as double) pet", "cast(2 as double) temp")
    assert column(MD.impute_forest_delta(df, "level", out="filled", num_trees=3)) == [None] * 5


def cart(x, y, w, depth=None):
    """A plain recursive regression tree: (feature, threshold, left, right) or the mean."""
    mean = float((w * y).sum() / w.sum())
    if depth == 0 or len(set(y)) == 1:
        return mean
    best = None
    for f in range(x.shape[1]):
        values = sorted(set(x[:, f]))
        for a, b in zip(values, values[1:]):
            left = x[:, f] <= (a + b) / 2
            score = round(sum(float((w[m] * y[m]).sum()) ** 2 / float(w[m].sum()) for m in (left, ~left)), 9)
            if best is None or score > best[0]:
                best = (score, f, (a + b) / 2)
    if best is None:
        return mean
    left = x[:, best[1]] <= best[2]
    down = None if depth is None else depth - 1
    return best[1], best[2], cart(x[left], y[left], w[left], down), cart(x[~left], y[~left], w[~left], down)


def walk(tree, q):
    while isinstance(tree, tuple):
        tree = tree[2] if q[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("depth", [None, 0, 1, 2, 5])
def test_forest_equals_recursive_trees(depth):
    r = np.random.default_rng(6)
    for n, k in ((3, 1), (20, 2), (60, 3)):
        x, y = np.round(r.normal(size=(n, k)), 1), np.round(r.normal(size=n), 2)
        asked = np.round(r.normal(size=(25, k)), 2)
        weights = MD.bootstrap("s", n, 7, 42)
        assert (weights.sum(axis=1) == n).all()
        trees = [cart(x[w > 0], y[w > 0], w[w > 0].astype(float), depth) for w in weights]
        want = np.mean([[walk(t, q) for q in asked] for t in trees], axis=0)
        assert np.allclose(MD.forest(x, y, asked, weights, depth), want)


def test_each_series_has_its_own_forest(spark, series):
    up = series([0.0, 31.0, 60.0, 91.0, 121.0, N, N]).selectExpr("*", "cast(month(month) as double) pet", "cast(1 as double) temp")
    down = series([100.0, 69.0, 40.0, 9.0, -21.0, N], station=2).selectExpr("*", "cast(month(month) as double) pet", "cast(null as double) temp")
    got = MD.impute_forest_delta(up.unionByName(down), "level", out="filled", num_trees=5)
    one = column(got.filter("station_id = 1"))
    assert one[:2] == [0.0, 31.0] and one[5] > one[4] and one[6] > one[5]
    assert column(got.filter("station_id = 2")) == [None] * 6  # no row has all features


def test_window_model_keeps_rows_at_the_minimum(spark, series):
    """The smallest true value scales to the fill value; the fit must keep it, and a constant series must not fail."""
    flat = WM.impute_window_regression(series([2.0] * 6 + [N]), "level", ["level", "lon"], 3, out="filled", pct=0.0)
    assert column(flat)[:6] == pytest.approx([2.0] * 6)
    none = WM.impute_window_regression(series([N] * 6), "level", ["level", "lon"], 3, out="filled")
    assert column(none) == [None] * 6


def brute_weights(many, size, ridge):
    """Weights of each output by building every window's row, also those that stick out, with -1 beyond the ends."""
    out = []
    for t in range(size):
        rows, y = [], []
        for x, truth in many:
            for j in np.flatnonzero(~np.isnan(truth)):
                window = [x[j - t + a] if 0 <= j - t + a < len(x) else np.full(x.shape[1], -1.0) for a in range(size)]
                rows.append(np.r_[1.0, np.concatenate(window)])
                y.append(truth[j])
        a, y = np.array(rows), np.array(y)
        penalty = np.diag(np.r_[0.0, np.full(a.shape[1] - 1, ridge * len(a))])
        out.append(np.linalg.solve(a.T @ a + penalty, a.T @ y))
    return np.array(out)


def brute_pred(x, weights, size):
    total = [[] for _ in x]
    for i in range(len(x) - size):
        values = weights @ np.r_[1.0, x[i:i + size].ravel()]
        for t in range(size):
            total[i + t].append(values[t])
    return [np.mean(v) if v else None for v in total]


def made(seed, sizes, k):
    r = np.random.default_rng(seed)
    many = []
    for n in sizes:
        x = np.cumsum(r.normal(size=(n, k)), axis=0)
        y = x[:, 0] + r.normal(0, .1, n)
        y[r.random(n) < .2] = np.nan
        x[r.random((n, k)) < .1] = -1
        many.append((x, y))
    return many


def frame(spark, many, scopes):
    rows = [(i, scopes[i], list(map(month, range(len(x)))), x.ravel().tolist(), [None if np.isnan(v) else float(v) for v in y]) for i, (x, y) in enumerate(many)]
    return spark.createDataFrame(rows, "station_id long, cluster string, times array<date>, x array<double>, y array<double>").repartition(3)


@pytest.mark.parametrize("size,k", [(1, 2), (3, 4), (12, 9)])
def test_window_model_equals_closed_form(spark, size, k):
    many = made(size, [40, 25, 60, 3, 1, size + 1, size], k)
    scopes = ["a", "b", "a", None, "b", "c", "c"]
    series = frame(spark, many, scopes)
    us = WM.gram(series, k, size, "cluster")
    assert set(us) == {"all", "a", "b", "c"}
    models = {}
    for s in ("all", "a", "b"):
        own = [m for m, c in zip(many, scopes) if s in ("all", c)]
        models[s] = WM.solve(us[s], k, size, 0.01)
        assert np.allclose(models[s], brute_weights(own, size, 0.01), atol=1e-9)
    got = {}
    for r in WM.predict(series, models, k, size, "cluster").collect():
        got.setdefault((r.station_id, r.scope), []).append((r.month, r.pred))
    assert {key[1] for key in got if key[0] == 3} == {"all"} and (5, "c") not in got
    for (i, s), values in got.items():
        want = brute_pred(many[i][0], models[s], size)
        assert [v is None for _, v in sorted(values)] == [v is None for v in want]
        assert np.allclose([v for _, v in sorted(values) if v is not None], [v for v in want if v is not None])


def test_window_of_ten_years(spark):
    """The reference's default: 120 months of nine features."""
    many = made(1, [300, 200, 130], 9)
    u = sum(a.T @ a for a in (WM.around(x, y, 120) for x, y in many))
    weights = WM.solve(u, 9, 120, 0.01)
    for t in (0, 77):  # all 120 outputs would take minutes
        rows, y = [], []
        for x, truth in many:
            padded = np.vstack([np.full((119, 9), -1.0), x, np.full((119, 9), -1.0)])
            for j in np.flatnonzero(~np.isnan(truth)):
                rows.append(np.r_[1.0, padded[119 + j - t:119 + j - t + 120].ravel()])
                y.append(truth[j])
        a = np.array(rows)
        direct = np.linalg.solve(a.T @ a + np.diag(np.r_[0.0, np.full(1080, 0.01 * len(a))]), a.T @ np.array(y))
        assert np.allclose(weights[t], direct, atol=1e-7)
    found = WM.predicted(many[2][0], weights, 120)
    assert np.isnan(found[129]) and not np.isnan(found[:129]).any()


def test_smaller_windows_and_loss_from_the_same_matrix():
    many = made(3, [50, 40], 3)
    u = sum(a.T @ a for a in (WM.around(x, y, 6) for x, y in many))
    small = sum(a.T @ a for a in (WM.around(x, y, 4) for x, y in many))
    assert np.allclose(WM.narrower(u, 3, 6, 4), small)
    w = WM.solve(small, 3, 4, 0.1)
    errors = []
    for x, y in many:
        rows = WM.around(x, y, 4)
        for t in range(4):
            errors.append((rows[:, -1] - rows[:, WM._place(3, 4, t)] @ w[t]) ** 2)
    assert WM.loss(small, 3, 4, w) == pytest.approx(np.concatenate(errors).mean())
    assert np.isnan(WM.loss(np.zeros_like(small), 3, 4, w))


def test_models_of_all_and_each_class_are_saved(spark, series, tmp_path):
    a = series([float(i % 5) for i in range(20)], station=1).selectExpr("*", "'reactive' cluster")
    b = series([float(3 * i) for i in range(20)], station=2, lon=2.0).selectExpr("*", "'inertial' cluster")
    c = series([1.0, N], station=3, lon=3.0).selectExpr("*", "'rare' cluster")  # too few rows
    df = a.unionByName(b).unionByName(c)
    fitted, scaler = WM.fit_global_and_per_cluster(df, "level", ["level", "lon"], str(tmp_path / "m"), 4)
    assert set(fitted.weights) == {"all", "inertial", "reactive"}
    loaded = WM.WindowModel.load(spark, str(tmp_path / "m"), fitted.features, fitted.value)
    assert loaded.size == 4 and all((loaded.weights[s] == fitted.weights[s]).all() for s in fitted.weights)
    got = {(r.station_id, r.scope) for r in WM.apply_windows(df, loaded, scaler, "cluster").collect()}
    assert got == {(1, "all"), (2, "all"), (3, "all"), (1, "reactive"), (2, "inertial")}


def test_variation_model_rebuilds_levels(spark, series):
    df = series([float(2 * i) for i in range(30)])
    got = column(WM.impute_variation_model(df, "level", ["level"], 3, out="filled", ridge=1e-9, holed=[]))
    assert got[0] == 0.0 and got[10] == pytest.approx(got[9] - 2.0)


def test_overlap_average(spark, series):
    s = series([0.0] * 6).select("station_id", "month").unionByName(series([0.0] * 2, station=2).select("station_id", "month"))
    w = spark.createDataFrame([(1, 0, [1.0, 2.0, 3.0]), (1, 1, [10.0, 20.0, None]), (1, 2, [100.0, 200.0, 300.0])], "station_id long, start int, values array<double>")
    got = {(r.station_id, r.month): r.pred for r in WIN.overlap_average(w, s, 3).collect()}
    assert [got[1, month(i)] for i in range(6)] == [1.0, 6.0, pytest.approx(41.0), pytest.approx(200.0), 300.0, None]
    assert [got[2, month(i)] for i in range(2)] == [None, None]


@pytest.mark.parametrize("pairing", ["cnn", "lstm"])
def test_sliding_windows(spark, series, pairing):
    df = series([0.0, N, 2.0, 3.0, 4.0, 5.0, 6.0]).unionByName(series([1.0] * 4, station=2))
    got = sorted((r.station_id, r.x_end, [x[0] for x in r.x], [y[0] for y in r.y]) for r in WIN.sliding_windows(df, ["level", "lon"], 3, pairing).collect())
    x, y = [0.0, -1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [0.0, N, 2.0, 3.0, 4.0, 5.0, 6.0]
    want = [(1, i - 1, x[i - 3:i], y[i - 3:i]) for i in range(3, 7)] if pairing == "cnn" else [(1, i - 2, x[i - 4:i - 1], y[i - 3:i]) for i in range(4, 7)]
    assert got == want


def test_forest_sorts_by_each_feature_once(monkeypatch):
    calls = []
    plain = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda *a, **k: calls.append(1) or plain(*a, **k))
    r = np.random.default_rng(1)
    x, y = r.normal(size=(40, 2)), r.normal(size=40)
    MD.forest(x, y, x, MD.bootstrap("s", 40, 5, 42))
    assert len(calls) == 2


def test_forest_draws_are_those_of_the_hash():
    import hashlib
    want = np.zeros((3, 7), int)
    for t in range(3):
        for i in range(7):
            want[t, int(hashlib.md5(f"a|{t}|{i}|42".encode()).hexdigest()[:8], 16) % 7] += 1
    assert (MD.bootstrap("a", 7, 3, 42) == want).all()


def test_holes_of_all_features_without_a_row_per_block(spark, series):
    """Hole blocks are drawn per station; holed inputs equal each feature's own blocks, with one aggregation for all."""
    from lacuna.operators.holes import block_rows, hash_int, hole_blocks
    from lacuna.operators.impute.window_model import holed_inputs
    df = series([float(v) for v in range(30)], station=7).withColumn("pet", F.lit(1.0))
    df = df.unionByName(series([1.0, 2.0], station=8).withColumn("pet", F.lit(1.0)).withColumn("station_id", F.lit(None).cast("long")))
    # the SQL rule, block by block
    for pct, sizes in ((0.2, (1, 5)), (0.95, (1, 2))):
        target, hit = int(30 * pct), []
        rows = spark.range(2 * target).select(hash_int(F.lit(7), F.col("id"), 42, "len").alias("l"), hash_int(F.lit(7), F.col("id"), 42, "start").alias("s")).collect()
        blocks = [(min(sizes[0] + r.l % (sizes[1] - sizes[0] + 1), 30), r.s) for r in rows]
        blocks = [range(s % (30 - n + 1), s % (30 - n + 1) + n) for n, s in blocks]
        tail = spark.range(30).orderBy(hash_int(F.lit(7), F.col("id"), 42, "tail"), "id").collect()
        for b in [*blocks, *[[r.id] for r in tail]]:
            hit += b if len(set(hit)) < target else []
        found = hole_blocks(df, pct, 42, sizes)
        assert sorted((r.station_id, r.pos) for r in found.collect()) == [(7, p) for p in sorted(set(hit))]
        assert block_rows("7", 30, pct, 42, sizes) == sorted(set(hit))
    h = holed_inputs(df, ["level", "pet"], ["level", "pet"])
    gone = [{i for i, r in enumerate(h.filter("station_id = 7").orderBy("month").collect()) if r[f"h_{f}"] is None} for f in ("level", "pet")]
    assert gone == [set(block_rows("7", 30, 0.1, seed, (1, 5))) for seed in (42, 43)]
    assert h._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
