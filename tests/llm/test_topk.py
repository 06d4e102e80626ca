import random

import numpy as np
import pytest

from lacuna.llm import topk as T
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same


def brute(vectors, k, every=20):
    ints = {i: np.floor(64 * np.array(v, np.float64)).astype(object) for i, v in vectors.items()}
    dot = lambda a, b: int(sum(int(x) * int(y) for x, y in zip(a, b)))
    out = []
    for q in ints:
        if q % every == 0:
            best = sorted((-dot(ints[q], ints[c]), c) for c in ints if c != q)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best)]
    return sorted(out)


def got(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, block int")
    return sorted(map(tuple, T.top_k(df, k).collect()))


def test_equals_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "VECTORS", 70)
    monkeypatch.setattr(T, "QUERIES", 4)
    r = np.random.default_rng(1)
    rows = {i: [float(np.float32(x)) for x in r.normal(0, 0.2, 12)] for i in range(300)}
    rows.update({i: rows[20] for i in range(300, 360)})  # ties
    assert got(spark, rows.items()) == brute(rows, 5)


@pytest.mark.parametrize("scale", [0.1, 40.0, 1e5])
@pytest.mark.parametrize("few", [0.0, 0.02, 0.5, 1.0])
def test_search_is_exact_wherever_it_stops(scale, few, monkeypatch):
    monkeypatch.setattr(T, "FEW", few)
    r = np.random.default_rng(2)
    v = np.floor(64 * r.normal(0, scale, (400, 16)) * r.choice([1, 0.05], (400, 1))).astype(np.int64)
    ids, qi = np.arange(400)[::-1].copy(), np.arange(0, 400, 20)
    q = v[[int(np.nonzero(ids == i)[0][0]) for i in qi]]
    for i, at, score in T.search(ids, v, qi, q, 7):
        full = v @ q[i]
        want = sorted((-int(s), int(c)) for s, c in zip(full, ids) if c != qi[i])[:7]
        assert [(-int(s), int(ids[a])) for s, a in zip(score, at)] == want


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (20, [0.5, -0.5]),
            (20, [0.5, -0.5]), (None, [1.0, 1.0]), (7, [-1.0, 0.01, 3.0])]
    ok = {0: [1, 2], 1: [1], 6: [], 20: [0.5, -0.5], 7: [-1, 0.01, 3]}
    assert got(spark, rows) == brute({i: v + [0] * (3 - len(v)) for i, v in ok.items()}, 5)
    assert got(spark, []) == [] and got(spark, [(20, [1.0])]) == []


def test_equals_sql(spark):
    r = random.Random(3)
    df = spark.createDataFrame([(i, [r.uniform(-1, 1) for _ in range(8)]) for i in range(200)], "vec_id long, embedding array<float>")
    same(T.top_k(df), duck({"embeddings": df}, ORACLE["op7_topk_search"]))
