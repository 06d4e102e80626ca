import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.llm import birnn as B, queries, toxicity as T


def texts(n, seed):
    """Clean babble, and the same with words that start with "veju" or are "scum"."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["the", "an", "er", "on", "ve", "re", "qu"]) for _ in range(r.randint(1, 3)))
    out = []
    for i in range(n):
        words = [word() for _ in range(r.randint(5, 90))]
        if i % 3 == 0:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["scum", "veju" + word()]))
        out.append((" ".join(words), int(i % 3 == 0)))
    return out


def test_gradient_equals_differences():
    r = np.random.default_rng(0)
    words = ["".join(r.choice(list("abcdé"), r.integers(1, 9))) for _ in range(40)]
    bags = [[[words[i] for i in r.integers(0, 40, n)] for n in sizes] for sizes in ((5, 8, 8), (8, 3))]
    y, p = np.array([1, 0]), {k: v.astype(np.float64) for k, v in B.new_parameters().items()}
    p["words"], p["bias"] = r.normal(0, 0.3, p["words"].shape), np.array([-1.0])
    _, grad = B._gradient(bags, y, p)
    for name in set(p) - {"scale"}:
        flat, g = p[name].reshape(-1), grad[name].reshape(-1)
        i = int(np.abs(g).argmax())
        old, e = flat[i], 1e-3
        flat[i] = old + e
        up = B._gradient(bags, y, p)[0]
        flat[i] = old - e
        down = B._gradient(bags, y, p)[0]
        flat[i] = old
        assert (up - down) / (2 * e) == pytest.approx(g[i], rel=2e-2, abs=1e-5), name


def test_windows_cover_every_word():
    for n in [1, 5, 31, 32, 33, 56, 57, 100, 1000]:
        w = B.windows(np.arange(n))
        assert set(w.reshape(-1)) == set(range(n)) and w.shape[1] == min(n, B.WINDOW)
        assert all(b - a <= B.STRIDE for a, b in zip(B.starts(n), B.starts(n)[1:]))


def test_scores_do_not_depend_on_grouping():
    rows = [t for t, _ in texts(40, 1)] + ["", "one", " ".join(t for t, _ in texts(60, 2)), "x" * 300]
    p = B.new_parameters()
    big, small = B.Scorer(p)(rows), B.Scorer(p, cache=20, group=100)(rows)
    one = np.array([B.Scorer(p)([t])[0] for t in rows])
    assert np.allclose(big, small, atol=1e-5) and np.allclose(big, one, atol=1e-5)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t, "en", "s", len(t), y) for i, (t, y) in enumerate(texts(900, 3))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, y int")


def test_held_out_accuracy(spark, corpus, tmp_path):
    corpus.drop("y").write.parquet(str(tmp_path / "documents.parquet"))
    corpus.selectExpr("doc_id", "1 as quality", "y as toxic").write.parquet(str(tmp_path / "labels.parquet"))
    rows = queries.op10_toxicity(spark, str(tmp_path)).join(corpus, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert 200 < len(held) < 400 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.y for r in held) >= 0.97 * len(held)
    kept = T.clean(corpus.drop("y"), spark.read.parquet(str(tmp_path / "labels.parquet")))
    assert kept.columns == corpus.drop("y").columns
    assert kept.count() == sum(r.score < T.THRESHOLD for r in rows)


def test_odd_rows(spark, odd_docs, odd_labels, no_docs):
    found = T.toxicity(odd_docs, odd_labels)
    assert found.count() == odd_docs.count()
    assert all(r.score == 0 for r in found.filter("doc_id in (1, 2, 3)").collect())
    assert T.toxicity(no_docs, odd_labels).count() == 0
    assert T.toxicity(odd_docs, odd_labels.limit(0)).filter("score != 0 or predicted != 0").count() == 0
    assert T.clean(odd_docs, odd_labels).columns == odd_docs.columns


def test_long_and_missing_labelled_texts(spark):
    """All toxic texts are long, and many labels have no document."""
    pool = texts(1500, 8)
    clean, toxic = [t for t, y in pool if not y], [t for t, y in pool if y]
    rows = [(i, clean[i], 0) for i in range(300)]
    rows += [(1000 + i, " ".join(clean[(7 * i + k) % 900 + 50] for k in range(30)) + " " + toxic[i], 1) for i in range(60)]
    rows += [(2000 + i, " ".join(clean[(11 * i + k) % 900 + 50] for k in range(30)), 0) for i in range(60)]
    assert min(len(t) for i, t, _ in rows if i >= 1000) > 6000
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int").repartition(4)
    labels = docs.select("doc_id", F.col("y").alias("toxic")).union(spark.range(10_000, 20_000).select("id", (F.col("id") % 2).cast("int")))
    found = T.toxicity(docs.drop("y"), labels).join(docs.select("doc_id", "y"), "doc_id").filter("held_out").collect()
    assert len(found) > 100 and sum(r.predicted == r.y for r in found) >= 0.9 * len(found)
    assert sum(r.predicted for r in found if r.y) >= 0.7 * sum(r.y for r in found)


def plain_score(text, p):
    """The network by the equations, one number at a time, over every window of the text."""
    import math
    import zlib
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    dot = lambda a, b: sum(float(x) * float(y) for x, y in zip(a, b))

    def gru(xs, w, b, u):
        k = len(u) // 3
        h, out = [0.0] * k, []
        for x in xs:
            i = [dot(row, x) + float(c) for row, c in zip(w, b)]
            a = [dot(row, h) for row in u]
            z = [sigmoid(i[j] + a[j]) for j in range(k)]
            r = [sigmoid(i[k + j] + a[k + j]) for j in range(k)]
            n = [math.tanh(i[2 * k + j] + r[j] * a[2 * k + j]) for j in range(k)]
            h = [z[j] * h[j] + (1 - z[j]) * n[j] for j in range(k)]
            out.append(h)
        return out

    def pooled(xs, name):
        fw = gru(xs, p[name + "Wf"], p[name + "bf"], p[name + "Uf"])
        bw = gru(xs[::-1], p[name + "Wb"], p[name + "bb"], p[name + "Ub"])[::-1]
        states = [f + b for f, b in zip(fw, bw)]
        e = [dot(p[name + "a"], s) for s in states]
        w = [math.exp(v - max(e)) for v in e]
        return [sum(a * s[j] for a, s in zip(w, states)) / sum(w) for j in range(len(states[0]))]

    def vector(word):
        codes = [ord(c) if ord(c) < 128 else 128 + ord(c) % 127 for c in word] + [0] * (-len(word) % B.FILL)
        return pooled([p["chars"][c] for c in codes], "c") + [float(v) for v in p["words"][zlib.crc32(word.encode()) % B.BUCKETS]]

    words = [w[i:i + 20] for w in text.lower().split() for i in range(0, len(w), 20)]
    if not words:
        return 0.0
    vectors, best = [vector(w) for w in words], -math.inf
    at = 0
    while True:
        first = max(0, min(at, len(words) - 32))
        best = max(best, dot(p["out"], pooled(vectors[first:first + 32], "w")) + float(p["bias"][0]))
        if first + 32 >= len(words):
            return sigmoid(float(p["scale"][0]) * best + float(p["scale"][1]))
        at += 24


def test_scores_equal_the_plain_equations():
    r = np.random.default_rng(2)
    p = B.new_parameters(5)
    p["words"], p["bias"], p["scale"] = r.normal(0, .5, p["words"].shape).astype(np.float32), np.array([.3], np.float32), np.array([1.7, -.4], np.float32)
    rows = ["", "one", "Über ñandú straße 日本", "x" * 61, *(t[:150] for t, _ in texts(3, 4)), " ".join(t for t, _ in texts(9, 5))[:420]]
    assert np.allclose(B.Scorer(p)(rows), [plain_score(t, p) for t in rows], atol=2e-5)
