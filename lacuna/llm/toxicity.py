"""Toxicity scores by a bidirectional gated recurrent network with attention pooling (see ``birnn``).

The network is fitted in one Spark task on a bounded sample of labelled texts: at most ``SAMPLE``
of those that ``docs`` holds, up to two fifths of them toxic, drawn in the order of a hash of doc_id.
Texts of any length take part: the task gets at most ``WINDOWS`` windows of each, drawn from the whole
text. Only rows whose crc32(doc_id as text) mod 3 is not 1 are drawn. A fifth of the sample is not fitted
but sets the calibration, by the highest logit over all windows of each whole text, as in scoring. The
fitted parameters have a fixed size (about 250 KB). Every whole text is then scored over all its
overlapping windows in Arrow batches; only doc_ids and the sample's texts are shuffled.

Rows: null and word-free texts score 0. If the sample lacks one of the two labels, all score 0.
Repeated label rows of a doc_id count once, a row marked toxic first; labels that are null don't
count. Repeated documents get equal scores; of different texts of a doc_id the smallest is drawn. A null doc_id is never held out and never drawn.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lacuna.llm import birnn
from lacuna.session import cut_lineage

SAMPLE, WINDOWS, ROWS = 2500, 80, 1000
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _pack(p: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **p)
    return out.getvalue()


def _unpack(data: bytes) -> dict:
    with np.load(io.BytesIO(data)) as z:
        return dict(z)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes | None:
    """The fitted parameters, None if the sample lacks a label."""
    known = (labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null").filter(F.col("text").rlike(r"\S"))
    have = cut_lineage(known.join(named.select("doc_id").distinct(), "doc_id", "left_semi"))
    drawn = F.xxhash64(F.lit("toxicity"), "doc_id")
    toxic = have.filter("toxic = 1").orderBy(drawn, "doc_id").limit(2 * sample // 5)
    clean = have.filter("toxic = 0").orderBy(drawn, "doc_id").limit(sample - 2 * sample // 5)
    chosen = sorted((r.doc_id, int(r.toxic)) for r in toxic.unionByName(clean).collect())  # at most ``sample`` rows of two numbers
    found = np.bincount([y for _, y in chosen], minlength=2)
    if not found.all():
        return None
    prior = known.agg(F.avg("toxic").cast("double")).first()[0]
    order = np.random.default_rng(1).permutation(len(chosen))
    some = found.min() >= 40  # otherwise all are fitted and calibrated on
    rows = [(*chosen[i], place, not some or place % 5 != 4, not some or place % 5 == 4) for place, i in enumerate(order)]
    part = docs.sparkSession.createDataFrame(rows, "doc_id long, toxic int, place int, fitted boolean, calibrated boolean")
    texts = (named.join(F.broadcast(part), "doc_id").groupBy("doc_id", "toxic", "place", "fitted", "calibrated")
             .agg(F.min("text").alias("text")))

    def windows(batches):
        for b in batches:
            drawn = [birnn.drawn_windows(t, WINDOWS, doc_id % 2**63) for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("place"), b.column("toxic"), pa.array(drawn, pa.list_(pa.string()))], ["place", "toxic", "windows"])

    def run(batches):
        rows = sorted(pa.Table.from_batches(list(batches)).to_pylist(), key=lambda r: r["place"])
        p = birnn.train([r["windows"] for r in rows], [r["toxic"] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([_pack(p)], pa.binary())], ["model"])

    bags = texts.filter("fitted").select("doc_id", "place", "toxic", "text").mapInArrow(windows, "place int, toxic int, windows array<string>")
    p = _unpack(bytes(bags.repartition(1).mapInArrow(_guarded(run), "model binary").collect()[0]["model"]))
    shared = docs.sparkSession.sparkContext.broadcast(_pack(p))

    def logits(batches):
        scorer = birnn.Scorer(_unpack(shared.value))
        for b in batches:
            x = scorer.highest(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("place"), b.column("toxic"), pa.array(x, pa.float64())], ["place", "toxic", "x"])

    held = texts.filter("calibrated").select("place", "toxic", "text").mapInArrow(logits, "place int, toxic int, x double")
    held = sorted((r.place, r.toxic, r.x) for r in held.collect() if np.isfinite(r.x))  # at most ``sample`` rows of three numbers
    if held:
        p["scale"] = birnn.calibration([x for *_, x in held], [y for _, y, _ in held], prior)
    return _pack(p)


def _guarded(run):
    """``run`` on an empty partition yields nothing."""
    def f(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            yield from run(batches)
    return f


def with_scores(docs: DataFrame, model: bytes | None, of: tuple[str, ...] = ("text",)) -> DataFrame:
    """``docs`` and a column ``score``, 0 to 1, of the text column or, by ``of``, of a field in a struct column."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = birnn.Scorer(_unpack(shared.value))
        for b in batches:
            for at in range(0, b.num_rows, ROWS):  # so few texts are Python strings at a time
                part = b.slice(at, ROWS)
                texts = part.column(of[0])
                for name in of[1:]:
                    texts = pc.struct_field(texts, name)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scorer(texts.to_pylist()), pa.float64())], [*part.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    whole = docs.select(F.struct(*docs.columns).alias("doc"))  # whatever its columns are named
    return with_scores(whole, fit(docs, labels), ("doc", "text")).filter(F.col("score") < threshold).select("doc.*")
