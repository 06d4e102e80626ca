"""H9 against a brute-force NumPy rendering of the reference semantics on a small fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import column, month
from lacuna.operators.impute.similar import best_lag, impute_similar_series, lag_of, similarity_topn
from lacuna.operators.neighbours import cell_topk

N = None


def test_chain_break(spark, series):
    tgt = series([1, N, N, N, 5], station=1)
    oth = series([10, 11, N, 13, 14], station=2)
    out = impute_similar_series(tgt.unionByName(oth), "level", out="filled", n_top=1, cluster=None)
    got = column(out.filter("station_id = 1"))
    assert got[:4] == [1.0, 2.0, None, None]


def test_chain_leading(spark, series):
    tgt = series([N, N, 3], station=1)
    oth = series([1, 2, 3], station=2)
    out = impute_similar_series(tgt.unionByName(oth), "level", out="filled", n_top=1, cluster=None)
    assert column(out.filter("station_id = 1"))[:2] == [None, None]


def test_best_lag(spark):
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=40))
    y = np.r_[x[3:], [np.nan] * 3]        # y[t] = x[t+3] → pairs pos_x = pos_y + 3
    rows = [(1, i, float(x[i]), None if np.isnan(y[i]) else float(y[i])) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, pos long, x double, y double")
    assert best_lag(df, ["k"]).collect()[0]["lag"] == 3


def test_lag_equals_plain_search():
    rng = np.random.default_rng(5)
    for n in (3, 6, 30, 70):
        x, y = rng.normal(size=n).round(1), rng.normal(size=n).round(1)
        x[: n // 5] = np.nan
        found = []
        for lag in range(-24, 25):
            p = [(x[i], y[i - lag]) for i in range(n) if 0 <= i - lag < n and not np.isnan(x[i]) and not np.isnan(y[i - lag])]
            a, b = np.array(p).T if p else (np.zeros(0), np.zeros(0))
            if len(p) >= 5 and a.std() > 0 and b.std() > 0:
                found.append((-round(float(np.corrcoef(a, b)[0, 1]), 9), lag))
        assert lag_of(x, y) == (min(found)[1] if found else 0)


def fixture(spark):
    """Two classes of stations with unequal spans and gaps."""
    rng = np.random.default_rng(11)
    rows = []
    for s in range(16):
        start, n = int(rng.integers(0, 10)), int(rng.choice([4, 14, 25, 40]))
        for i in range(n):
            v = None if rng.random() < 0.15 else float(np.sin(i / (2 + s % 5)) + rng.normal(0, 0.3))
            rows.append((s, month(start + i), v, "reactive" if s % 3 else "inertial"))
    return spark.createDataFrame(rows, "station_id long, month date, level double, cluster string"), rows


def filled(values):
    v = np.array([np.nan if x is None else x for x in values], float)
    for i in range(1, len(v)):
        v[i] = v[i - 1] if np.isnan(v[i]) else v[i]
    for i in range(len(v) - 2, -1, -1):
        v[i] = v[i + 1] if np.isnan(v[i]) else v[i]
    return v


def amplitudes(values):
    v = filled(values)
    return np.abs(np.fft.fft(v - v.mean()))[1:11]


def test_top_similar_equals_numpy_with_two_classes(spark):
    df, rows = fixture(spark)
    got = {}
    for r in similarity_topn(df, "level", 3).collect():
        got.setdefault(r.station_id, {})[r["rank"]] = (r.other, r.sim)
    for cluster in ("reactive", "inertial"):
        own = [r for r in rows if r[3] == cluster]
        ids, months = sorted({r[0] for r in own}), sorted({r[1] for r in own})
        value = {(r[0], r[1]): r[2] for r in own}
        union = {s: amplitudes([value.get((s, m)) for m in months]) for s in ids}
        for s in ids:
            grid = [r[2] for r in sorted(own, key=lambda r: r[1]) if r[0] == s]
            size = min(len(grid), len(months), 11)
            mine = amplitudes(grid)[:size - 1]

            def score(o):
                if size <= 2:
                    return 0.0
                other = union[o][:size - 1]
                return round(-float(np.corrcoef(mine, other)[0, 1]), 9) if mine.std() > 1e-9 * abs(mine.mean()) and other.std() > 1e-9 * abs(other.mean()) else 2.0

            order = sorted((score(o), o) for o in ids if o != s)[:3]
            assert [got[s][i + 1][0] for i in range(len(order))] == [o for _, o in order], (s, size)
            assert [got[s][i + 1][1] for i in range(len(order))] == [None if c == 2.0 else pytest.approx(-c, abs=1e-6) for c, _ in order]


@pytest.mark.parametrize("block", [4096, 40])
def test_cell_search_equals_brute_force(spark, block, monkeypatch):
    import lacuna.operators.neighbours as NB
    monkeypatch.setattr(NB, "CELL", 30)
    rng = np.random.default_rng(2)
    z = np.concatenate([rng.normal(size=(200, 4)), rng.normal(5, 0.2, size=(150, 4)), np.ones((10, 4))]).round(2)
    rows = [("a" if i % 2 else "b", i, [float(x) for x in v]) for i, v in enumerate(z)]
    q = spark.createDataFrame(rows, "p string, q_id long, q_z array<double>")
    it = spark.createDataFrame(rows, "p string, i_id long, i_z array<double>")
    got = {}
    for r in cell_topk(q, it, ["p"], 6, block=block).collect():
        got.setdefault(r.q_id, {})[r["rank"]] = (r.dist, r.i_id)
    for p, i, v in rows:
        want = sorted((round(float(np.sqrt(((z[i] - z[j]) ** 2).sum())), 9), j) for o, j, _ in rows if o == p and j != i)[:6]
        assert [got[i][k + 1] for k in range(6)] == [(pytest.approx(d), j) for d, j in want]


@pytest.mark.parametrize("block,items", [(4096, 32768), (40, 50)])
def test_correlated_search_equals_brute_force(spark, block, items, monkeypatch):
    """Blocks of queries against blocks of items; a query that comes twice is answered twice, by whole lists."""
    import lacuna.operators.neighbours as NB
    monkeypatch.setattr(NB, "ITEMS", items, raising=False)
    rng = np.random.default_rng(4)
    z = rng.normal(size=(300, 6)).round(1)
    z[40:70] = z[40]
    z = (z - z.mean(axis=1, keepdims=True)) / z.std(axis=1, keepdims=True)
    rows = [("a" if i % 2 else "b", i, [float(x) for x in v]) for i, v in enumerate(z)]
    q = spark.createDataFrame(rows + rows[:3], "p string, q_id long, q_z array<double>")
    it = spark.createDataFrame(rows, "p string, i_id long, i_z array<double>")
    got = {}
    for r in cell_topk(q, it, ["p"], 6, block=block, correlate=True).collect():
        got.setdefault(r.q_id, []).append((r["rank"], r.i_id, r.sim))
    for p, i, _ in rows:
        order = sorted((-round(min(float(z[i] @ z[j]) / 6, 1.0), 9), j) for o, j, _ in rows if o == p and j != i)[:6]
        copies = 2 if i < 3 else 1
        assert sorted(x[:2] for x in got[i]) == sorted((k + 1, j) for k, (_, j) in enumerate(order) for _ in range(copies)), i
        assert all(sim == pytest.approx(-dict((j, c) for c, j in order)[j], abs=1e-8) for _, j, sim in got[i])


def test_tiles_equal_one_product(monkeypatch):
    import pyarrow as pa
    import lacuna.operators.neighbours as NB
    rng = np.random.default_rng(8)
    z = rng.normal(size=(500, 7)).round(1)
    z[100:200] = z[100]
    z = (z - z.mean(axis=1, keepdims=True)) / z.std(axis=1, keepdims=True)
    ids = rng.permutation(500)
    asked = pa.table({"p": [1] * 90, "q_id": ids[:90], "q_no": ids[:90], "q_z": pa.array(z[:90].tolist())})
    found = pa.table({"p": [1] * 500, "i_id": ids, "i_z": pa.array(z.tolist())})
    whole = NB._tiled_topk(asked, found, ["p"], 5)
    monkeypatch.setattr(NB, "TILE", (16, 32))
    monkeypatch.setattr(NB, "EXACT", 10)
    assert NB._tiled_topk(asked, found, ["p"], 5).equals(whole) and whole.num_rows == 450


def test_vectors_of_one_length_are_a_part(spark):
    """spectrum_similarity: the length of the vectors is one of the columns of a part."""
    from lacuna.plans.catalog import similar_from_vectors
    rng = np.random.default_rng(9)
    rows = [("c", s, i, float(v)) for s in range(8) for i, v in enumerate(rng.normal(size=6))]
    got = similar_from_vectors(spark.createDataFrame(rows, "cluster string, station_id long, bin int, amp double"), 3)
    assert got.count() == 24 and got.filter("station_id = other").count() == 0


def test_station_is_unit_of_work(spark, series):
    """One row a station with its similar series as arrays; months of pairs never are rows of a join or window."""
    from lacuna.operators.impute.similar import similar_pairs
    rng = np.random.default_rng(1)
    df = series([1.0, N, 3.0, 4.0, 2.0, 6.0], station=1)
    for s in (2, 3, 4):
        df = df.unionByName(series([float(v) for v in rng.normal(size=6)], station=s))
    df = df.unionByName(series([5.0], station=9).withColumn("station_id", F.lit(None).cast("long")))
    rows = similar_pairs(df, similarity_topn(df, "level", 2, cluster=None), "level").collect()
    assert sorted(r.station_id for r in rows) == [1, 2, 3, 4]
    assert all(len(r["_t"]) == 6 and len(r["_o"]) == 2 for r in rows)
    done = impute_similar_series(df, "level", out="filled", n_top=2, cluster=None)
    assert done.count() == 25
    assert "windowspecdefinition(station_id#" not in done._jdf.queryExecution().optimizedPlan().toString()


def test_matches_is_left_join():
    from lacuna.operators.impute.similar import _matches
    asked, items = np.array([0, 1, 1, 4]), np.array([1, 1, 2, 4])
    i, j = _matches(asked, items)
    assert list(zip(i.tolist(), j.tolist())) == [(0, -1), (1, 0), (1, 1), (2, 0), (2, 1), (3, 3)]
