"""What the search for similar series sends around."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import month
from lacuna.operators import neighbours as NB
from lacuna.operators.impute import similar as SIM


def rows(lengths):
    rng = np.random.default_rng(2)
    return [(s, month(i), float(rng.normal())) for s, n in enumerate(lengths) for i in range(n)]


@pytest.mark.parametrize("lengths, prefixes", [([30] * 6, {11}), ([30, 30, 6, 30, 5], {5, 6, 11}), ([2, 2, 2], set())])
def test_references_have_only_the_prefixes_that_targets_ask_for(spark, monkeypatch, lengths, prefixes):
    sent = []

    def search(queries, items, *rest, **more):
        sent.append({r._L for r in items.select("_L").distinct().collect()})
        return NB.cell_topk(queries, items, *rest, **more)

    monkeypatch.setattr(SIM, "cell_topk", search)
    df = spark.createDataFrame(rows(lengths), "station_id long, month date, level double")
    got = SIM.similarity_topn(df, "level", 2, cluster=None).collect()
    assert sent == [prefixes]
    assert sorted((r.station_id, r["rank"]) for r in got) == [(s, k) for s in range(len(lengths)) for k in (1, 2)]


def test_many_blocks_of_queries_do_not_repeat_the_items(spark, monkeypatch):
    """Items go to 16 blocks of queries at most (before: to 50 here); the neighbours are those of a plain search."""
    counted = spark.sparkContext.accumulator(0)
    plain = NB._tiled_topk

    def tiled(asked, found, part, k):
        counted.add(len(found))
        return plain(asked, found, part, k)

    monkeypatch.setattr(NB, "_tiled_topk", tiled)
    v = np.random.default_rng(4).normal(size=(50, 6))
    z = (v - v.mean(1, keepdims=True)) / v.std(1, keepdims=True)
    df = spark.createDataFrame([("p", i, [float(x) for x in row]) for i, row in enumerate(z)], "p string, id long, z array<double>")
    got = NB.cell_topk(df.select("p", F.col("id").alias("q_id"), F.col("z").alias("q_z")), df.select("p", F.col("id").alias("i_id"), F.col("z").alias("i_z")), ["p"], 3, block=1, correlate=True)
    found = {}
    for r in got.collect():
        found.setdefault(r.q_id, {})[r["rank"]] = r.i_id
    sim = np.corrcoef(z)
    np.fill_diagonal(sim, -2)
    assert found == {i: {k + 1: int(j) for k, j in enumerate(np.argsort(-sim[i])[:3])} for i in range(50)}
    assert 0 < counted.value <= 50 * NB.ASKED
