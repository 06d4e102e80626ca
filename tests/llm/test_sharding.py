import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.llm import queries, sharding as S


@pytest.mark.parametrize("good,bad,drawn", [(30, 50, 20), (5, 0, 3), (0, 9, 4), (400, 9000, 5000), (7, 7, 14), (3, 100, 1)])
def test_draws_follow_the_law(spark, good, bad, drawn):
    long = lambda x: F.lit(x).cast("long")
    x = spark.range(8000).select(S.hypergeometric(long(good), long(bad), long(drawn), S._uniform(F.lit(3), "id")).alias("x")).toPandas().x
    assert x.between(max(0, drawn - bad), min(good, drawn)).all()
    mean = drawn * good / (good + bad)
    sd = np.sqrt(mean * (1 - good / (good + bad)) * (good + bad - drawn) / max(1, good + bad - 1))
    assert abs(x.mean() - mean) <= 5 * sd / np.sqrt(8000) + 1e-9
    assert abs(x.std() - sd) <= 0.06 * sd + 1e-9


def test_matrix_margins(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 50)
    counts = [37, 61, 50, 0, 44, 52, 55, 13]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(counts) if n], "chunk long, n long")
    total = sum(counts)
    got = {r.chunk: r.sends for r in S.matrix(df, total, 5).collect()}
    sizes = [total // 5 + (1 if s < total % 5 else 0) for s in range(5)]
    assert [sum(got.get(c, [0])) for c in range(8)] == counts
    assert [sum(g[s] for g in got.values()) for s in range(5)] == sizes
    assert all(x >= 0 for g in got.values() for x in g)


def test_shards_on_odd_rows(spark, odd_docs, no_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 8)
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op5_sharding(spark, str(tmp_path)).collect()
    docs = odd_docs.collect()
    key = lambda x: str(x)
    want = sorted([(d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs], key=key)
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in rows], key=key) == want
    sizes = [sum(r.shard == s for r in rows) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(16):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert S.shards(no_docs).count() == 0


def test_same_files_same_shards_and_no_order_left(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 100)
    spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text")).write.parquet(str(tmp_path / "d"))
    read = lambda: S.shards(spark.read.parquet(str(tmp_path / "d"))).orderBy("doc_id").toPandas()
    a, b = read(), read()
    assert (a == b).all().all()
    assert abs(np.corrcoef(a.doc_id, a.slot)[0, 1]) < 0.08 and abs(np.corrcoef(a.doc_id, a["shard"])[0, 1]) < 0.08


def test_many_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 64)
    docs = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    rows = S.shards(docs, 7).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last")).collect()
    assert sorted(r.n for r in rows) == [142, 143, 143, 143, 143, 143, 143] and all(r.n == r.slots == r.last + 1 for r in rows)


def test_matrix_has_the_law_of_shuffled_rows(spark, monkeypatch):
    """Cells of drawn matrices against matrices counted from rows that numpy shuffles: margins, cell frequencies, variances and
    covariances within a chunk, between chunks of one half and between chunks far apart."""
    monkeypatch.setattr(S, "CHUNK", 10)
    chunks, n, shards = 256, 10, 4
    counts = spark.createDataFrame([(c, n) for c in range(chunks)], "chunk long, n long")
    drawn = np.array([[r.sends for r in S.matrix(counts, chunks * n, shards, seed).orderBy("chunk").collect()] for seed in range(1)])
    r = np.random.default_rng(1)
    made = []
    for _ in range(60):
        labels = r.permutation(np.repeat(np.arange(shards), chunks * n // shards)).reshape(chunks, n)
        made.append([np.bincount(row, minlength=shards) for row in labels])
    made = np.array(made)
    assert (drawn.sum(axis=2) == n).all() and (drawn.sum(axis=1) == chunks * n // shards).all()
    share = lambda m: np.bincount(m.ravel(), minlength=n + 1) / m.size
    assert np.abs(share(drawn) - share(made)).max() < 0.06
    for s in range(shards):
        assert abs(drawn[:, :, s].var() - made[:, :, s].var()) < 0.6
    within = lambda m: np.mean((m[:, :, 0] - 2.5) * (m[:, :, 1] - 2.5))
    assert abs(within(drawn) - within(made)) < 0.4
    for apart in (1, 2, 64):
        pair = lambda m: np.mean((m[:, :-apart, 0] - 2.5) * (m[:, apart:, 0] - 2.5))  # noqa: B023, E731
        assert abs(pair(drawn) - pair(made)) < 0.45
