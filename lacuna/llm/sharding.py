"""A uniform shuffle into shards of exact size, in DataFrame functions only.

Rows are dealt by a hash into chunks. A communication matrix says how many rows each chunk sends to
each shard. Its rows sum to the chunks' counts and its columns to the shards' sizes (at most one row
apart); it is drawn from the multivariate hypergeometric law, so it is distributed as that of a
uniform shuffle. It is drawn by halving: the shards' counts over a span of chunks are split between
the span's halves by hypergeometric draws, level by level, all spans of a level at once. Inside a
chunk the rows are ranked at random and the first ranks go to the first shard, and so on. After the
exchange each shard is permuted again: its rows fall into random bins, and a row's slot is the size
of the bins before it plus its rank in its own.

No chunk or bin holds more than a few ``CHUNK`` rows, whatever the number of rows or copies: a row's
random numbers are a hash of its position in the materialised input too. The same files give the
same result.

Rows: a null text has no bytes, so its size is 1. Repeated rows are rows like any other. Null doc_ids
are dealt like any other. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lacuna.llm.laws import ln_choose
from lacuna.session import cut_lineage

CHUNK, SEED, DEVIATIONS, COUNT_FILES = 8192, 20, 12, 8


def _uniform(*key) -> Column:
    """In (0, 1), from 52 bits of a hash of the key."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 12) + 0.5) / float(1 << 52)


def hypergeometric(good: Column, bad: Column, drawn: Column, u: Column) -> Column:
    """Number of good items among ``drawn`` of good + bad, by inversion of u.

    Probabilities are taken off u at the mode and then to both sides of it in turn, each from the one
    before by the ratio of neighbours, so the work is a few standard deviations.
    """
    one = F.struct(good.alias("good"), bad.alias("bad"), drawn.alias("drawn"), u.alias("u"),
                   F.greatest(F.lit(0), drawn - bad).alias("low"), F.least(good, drawn).alias("high"),
                   F.floor((drawn + 1.0) * (good + 1.0) / (good + bad + 2.0)).alias("mode"))
    return F.element_at(F.transform(F.array(one), _drawn), 1)  # each input is bound once


def _drawn(p: Column) -> Column:
    mode = F.least(p.high, F.greatest(p.low, p.mode))
    at_mode = F.exp(ln_choose(p.good, mode) + ln_choose(p.bad, p.drawn - mode) - ln_choose(p.good + p.bad, p.drawn))
    share = p.good / (p.good + p.bad)
    steps = F.least(p.high - p.low, F.ceil(F.sqrt(p.drawn * share * (1 - share)) * DEVIATIONS + 20))
    start = F.transform(F.array(mode), lambda m: F.struct(p.u.alias("u"), at_mode.alias("up"), at_mode.alias("down"), m.cast("long").alias("x"), m.cast("long").alias("mode")))
    first = F.element_at(F.transform(start, lambda s: s.withField("u", s.u - s.up)), 1)

    def step(s, i):
        a, b = s.mode + i, s.mode - i
        up = F.when(a <= p.high, s.up * (p.good - a + 1) * (p.drawn - a + 1) / (a * (p.bad - p.drawn + a)).cast("double")).otherwise(0.0)
        down = F.when(b >= p.low, s.down * ((b + 1) * (p.bad - p.drawn + b + 1)).cast("double") / ((p.good - b) * (p.drawn - b))).otherwise(0.0)
        # u below 0: x is found already
        return F.element_at(F.transform(F.array(F.struct(up.alias("up"), down.alias("down"))), lambda d: F.struct(
            F.when(s.u < 0, s.u).otherwise(s.u - d.up - d.down).alias("u"), d.up.alias("up"), d.down.alias("down"),
            F.when(s.u < 0, s.x).when(s.u < d.up, a).when(s.u < d.up + d.down, b).otherwise(s.x).cast("long").alias("x"), s.mode.alias("mode"))), 1)

    found = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1)).cast("long")), first, step, lambda s: s.x)
    return F.when((p.good == 0) | (p.drawn == 0), F.lit(0)).when(p.bad == 0, p.drawn).when(steps < 1, mode).otherwise(found).cast("long")


def matrix(counts: DataFrame, rows: int, shards: int, seed: int = SEED) -> DataFrame:
    """chunk and ``sends``, the rows that it sends to each shard. ``counts``: chunk (0 …), n."""
    counts = cut_lineage(counts.coalesce(COUNT_FILES))  # a row for each chunk, read at every level
    levels = max(0, math.ceil(math.log2(max(1, -(-rows // CHUNK)))))
    sizes = [rows // shards + (1 if s < rows % shards else 0) for s in range(shards)]
    spans = counts.sparkSession.range(1).select(F.lit(0).cast("long").alias("span"), F.array(*[F.lit(s).cast("long") for s in sizes]).alias("sends"))
    for level in range(1, levels + 1):
        below = (counts.groupBy(F.shiftright("chunk", levels - level + 1).alias("span"))
                 .agg(F.coalesce(F.sum(F.when(F.shiftright("chunk", levels - level) % 2 == 0, F.col("n"))), F.lit(0)).alias("left")))
        spans = spans.join(below, "span")
        key = lambda s: (F.lit(seed), F.lit(level), F.col("span"), s)
        first = F.aggregate(  # shard by shard: how many of its rows come from the left half
            F.transform("sends", lambda n, s: F.struct(n.alias("n"), s.alias("s"))),
            F.struct(F.col("left").alias("left"), F.aggregate("sends", F.lit(0).cast("long"), lambda a, n: a + n).alias("all"),
                     F.array().cast("array<bigint>").alias("out")),
            lambda acc, x: _with_draw(acc, x.n, hypergeometric(x.n, acc.all - x.n, acc.left, _uniform(*key(x.s)))),
            lambda acc: acc.out)
        spans = spans.select("span", "sends", first.alias("first"))
        spans = spans.select(F.inline(F.array(
            F.struct((F.col("span") * 2).alias("span"), F.col("first").alias("sends")),
            F.struct((F.col("span") * 2 + 1).alias("span"), F.zip_with("sends", "first", lambda a, b: a - b).alias("sends")))))
    return spans.withColumnRenamed("span", "chunk")


def _with_draw(acc: Column, n: Column, draw: Column) -> Column:
    # the draw is bound once, through an array of one item
    return F.element_at(F.transform(F.array(draw), lambda x: F.struct(
        (acc.left - x).alias("left"), (acc.all - n).alias("all"), F.concat(acc.out, F.array(x)).alias("out"))), 1)


def shards(docs: DataFrame, count: int = 16, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = cut_lineage(rows.withColumn("row", F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32", F.monotonically_increasing_id())))
    total = rows.count()
    chunks = 1 << max(0, math.ceil(math.log2(max(1, -(-total // CHUNK)))))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed + 1), "row"), F.lit(chunks)).cast("long"))
    sends = matrix(rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")), total, count, seed)
    local = Window.partitionBy("chunk").orderBy(F.xxhash64(F.lit(seed + 2), "row"), "row", "doc_id", "size", "text_crc32")
    rows = rows.withColumn("rank", F.row_number().over(local))
    ends = F.aggregate("sends", F.array().cast("array<bigint>"), lambda a, n: F.concat(a, F.array(n + F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)))))
    rows = rows.join(sends.select("chunk", ends.alias("ends")), "chunk")
    rows = rows.select("doc_id", "size", "text_crc32", "row", F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("shard"))
    bins = max(1, -(-total // (count * CHUNK)))
    rows = cut_lineage(rows.withColumn("bin", F.pmod(F.xxhash64(F.lit(seed + 3), "row"), F.lit(bins)).cast("int")))
    filled = rows.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    again = Window.partitionBy("shard", "bin").orderBy(F.xxhash64(F.lit(seed + 4), "row"), "row", "doc_id", "size", "text_crc32")
    rows = rows.withColumn("at", F.row_number().over(again) - 1).join(filled, ["shard", "bin"])
    return rows.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot"))
