"""H8: nearest rows of a series, by plain loops."""

import math

import numpy as np
import pytest

from conftest import column
from lacuna.operators.impute import knn as K

N = None


def brute(v, x, k, past):
    known = [i for i, a in enumerate(v) if not np.isnan(a)]
    whole = [not np.isnan(r).any() for r in x]
    complete = [i for i in known if whole[i]]
    out = list(v)
    for i, a in enumerate(v):
        if not np.isnan(a):
            continue
        if len(complete) < k:
            out[i] = np.mean([v[j] for j in known]) if known else np.nan
        elif not whole[i]:
            out[i] = np.mean([v[j] for j in complete])
        else:
            mean, sd = x[complete].mean(axis=0), x[complete].std(axis=0)
            z = (x - mean) / np.where(sd == 0, 1, sd)
            near = sorted((round(math.dist(z[i], z[j]), 9), j) for j in complete if not past or j < i)[:k]
            out[i] = np.mean([v[j] for _, j in near]) if near else np.nan
    return out


@pytest.mark.parametrize("past", [False, True])
def test_equals_plain_loops(past, monkeypatch):
    monkeypatch.setattr(K, "ROWS", 7)
    r = np.random.default_rng(9)
    for n in (1, 4, 6, 60):
        v = np.round(r.normal(size=n), 2)
        v[r.random(n) < .4] = np.nan
        x = np.stack([np.full(n, 2.0), np.arange(n) // 12, np.sin(np.arange(n) * math.pi / 6), np.cos(np.arange(n) * math.pi / 6)], axis=1)
        x[r.random(n) < .05, 0] = np.nan
        assert np.allclose(K.knn_fill(v, x, 5, past), brute(v, x, 5, past), equal_nan=True)


def test_few_known_and_none(spark, series):
    assert column(K.impute_knn(series([1.0, N, 3.0]), "level", out="filled")) == [1.0, 2.0, 3.0]
    assert column(K.impute_knn(series([N, N]), "level", out="filled")) == [N, N]
    past = column(K.impute_knn(series([N, 1.0, 2.0, 3.0, 4.0, 5.0, N]), "level", past_only=True, out="filled"))
    assert past[0] is None and past[6] == 3.0


def test_keeps_columns(series):
    df = series([1.0, N, 3.0, 4.0, 5.0, 6.0, 7.0])
    got = K.impute_knn(df, "level")
    assert sorted(got.columns) == sorted(df.columns) and got.filter("level is null").count() == 0
