import pytest
from pyspark.sql import functions as F

from lacuna.llm import mixing as M
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same


def test_targets_equal_repeated_sharing(spark):
    for sizes in ([100, 1000, 10], [5, 5000, 40, 1, 800], [0, 0], [7], [0, 10, 3]):
        df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        got = [r.target for r in M.targets(df).orderBy("source").collect()]
        weights, caps = [M.WEIGHTS[i % 3] for i in range(len(sizes))], [3 * n for n in sizes]
        want, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
        while open_:
            over = {i for i in open_ if left * weights[i] / sum(weights[j] for j in open_) > caps[i] + 1e-9}
            if not over:
                for i in open_:
                    want[i] = left * weights[i] / sum(weights[j] for j in open_)
                break
            for i in over:
                want[i] = caps[i]
            left -= sum(caps[i] for i in over)
            open_ -= over
        assert got == pytest.approx(want)


def corpus(spark, n=4000):
    words = F.repeat(F.lit("w "), (F.col("id") * 7919 % 97 + 1).cast("int"))
    source = F.when(F.col("id") % 3 == 0, F.lit("big")).when(F.col("id") % 40 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")))
    return spark.range(n).select(F.col("id").alias("doc_id"), words.alias("text"), source.alias("source"), F.lit("en").alias("lang"))


@pytest.mark.parametrize("bucket", [20_000, 37])
def test_words_come_near_targets(spark, bucket, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", bucket)
    docs = corpus(spark)
    found = M.mixture(docs)
    same(found, duck({"documents": docs}, ORACLE["op9_source_mixing"]))
    by = found.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"), F.max("copies").alias("copies")).collect()
    assert all(abs(r.taken - r.target) <= r.most and r.copies <= 3 for r in by)


def test_longer_texts_are_drawn_less(spark):
    found = M.mixture(corpus(spark, 20_000).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")))).filter("source_size > target").toPandas()
    assert found[found["size"] < 30].copies.mean() > found[found["size"] > 70].copies.mean() + 0.05


def test_odd_rows(spark, odd_docs, no_docs):
    found = M.mixture(odd_docs)
    assert found.count() == odd_docs.count()
    same(found, duck({"documents": odd_docs}, ORACLE["op9_source_mixing"]))
    assert M.mixture(no_docs).count() == 0 and M.mix(no_docs).count() == 0


def test_mix_repeats_rows(odd_docs):
    mixed = M.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = mixed.select(F.sum(M.size_of(F.col("text")))).collect()[0][0]
    assert words == M.mixture(odd_docs).agg(F.sum("taken")).collect()[0][0]
