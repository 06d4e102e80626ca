"""One pass for a rate's configurations, the log, resuming, and the choice."""

import numpy as np
import pytest

from conftest import month
from lacuna.operators.impute import grid_search as GS
from lacuna.operators.impute import window_model as WM


def frame(spark, n=40, stations=6):
    r = np.random.default_rng(2)
    rows = []
    for s in range(stations):
        level = np.cumsum(r.normal(size=n))
        rows += [(s, month(i), None if r.random() < .1 else float(level[i]), float(s)) for i in range(n)]
    return spark.createDataFrame(rows, "station_id long, month date, level double, lon double")


def test_losses_equal_plain_fits(spark, tmp_path):
    df, log = frame(spark), str(tmp_path / "log")
    best = GS.grid_search(df, "level", ["level", "lon"], log, [2, 4], [0.01, 1.0], [0.1], share=0.75).collect()
    rows = {(r.pct, r["size"], r.ridge): r for r in GS.read_log(spark, log).collect()}
    assert set(rows) == {(0.1, s, r) for s in (2, 4) for r in (0.01, 1.0)}
    series, _ = WM.training_series(df, "level", ["level", "lon"], None, None, 0.1, 42)
    whole = [(np.array(r.x).reshape(-1, 2), np.array([np.nan if v is None else v for v in r.y])) for r in series.collect()]
    for (_, size, ridge), r in rows.items():
        train = [(x[:30], y[:30]) for x, y in whole]
        u = sum(a.T @ a for a in (WM.around(x, y, size) for x, y in train))
        w = WM.solve(u, 2, size, ridge)
        val = np.vstack([WM.around(x[30:], y[30:], size) for x, y in whole])
        errors = np.concatenate([(val[:, -1] - val[:, WM._place(2, size, t)] @ w[t]) ** 2 for t in range(size)])
        assert r.val_loss == pytest.approx(errors.mean(), rel=1e-6)
        assert r.val_accuracy == pytest.approx(1 - errors.mean() / val[:, -1].var(), rel=1e-6)
    assert best[0].val_loss == min(r.val_loss for r in rows.values())


def test_a_second_call_trains_nothing_and_a_wider_one_only_the_rest(spark, tmp_path, monkeypatch):
    df, log, seen = frame(spark), str(tmp_path / "log"), []
    monkeypatch.setattr(WM, "gram", lambda *a, f=WM.gram: (seen.append(a[2]), f(*a))[1])
    first = GS.grid_search(df, "level", ["level"], log, [2, 3], [0.1], [0.1, 0.2]).collect()
    assert len(seen) == 2
    assert GS.grid_search(df, "level", ["level"], log, [2, 3], [0.1], [0.1, 0.2]).collect() == first and len(seen) == 2
    GS.grid_search(df, "level", ["level"], log, [2, 3, 5], [0.1], [0.1])
    assert seen[2:] == [5] and GS.read_log(spark, log).count() == 5


def test_resumes_after_a_failure(spark, tmp_path, monkeypatch):
    df, log, whole = frame(spark), str(tmp_path / "log"), WM.gram
    calls = []

    def fails_later(*a):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return whole(*a)

    monkeypatch.setattr(WM, "gram", fails_later)
    with pytest.raises(RuntimeError):
        GS.grid_search(df, "level", ["level"], log, [2], [0.1, 1.0], [0.1, 0.2])
    assert {r.pct for r in GS.read_log(spark, log).collect()} == {0.1}
    GS.grid_search(df, "level", ["level"], log, [2], [0.1, 1.0], [0.1, 0.2])
    assert len(calls) == 3 and GS.read_log(spark, log).count() == 4


def test_nothing_to_fit(spark, tmp_path):
    df = frame(spark).limit(0)
    assert GS.grid_search(df, "level", ["level"], str(tmp_path / "log"), [2], [0.1], [0.1]).collect() == []
