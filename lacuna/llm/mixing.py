"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Sources share the corpus' words by weight, none above ``most`` times its own (water-filling: the
level is found by one pass over the sources ordered by cap per weight). A source with target t and
size s takes floor(t / s) certain whole copies of each document. The rest of t is a sample without
replacement: documents stand in the order of their random odds u / (1 - u) divided by their
inclusion odds, and the longest head of that order whose words come nearest to the rest is taken.
The inclusion odds are those of the source's open share, times sqrt(mean size / size): long
documents are less likely to be the extra copy, so the cut falls nearer to the rest.

The cut is found without ranking a whole source: words are summed by bucket of the order, and only
the bucket that holds the cut is sorted. Decisions are then a comparison with the source's cut.

Rows: a null text has size 0 and takes nothing. A null source is a source, ordered last. Repeated
rows have one place in the order and share their decision. A null doc_id counts as the smallest.
All randomness is an MD5 of seed, doc_id, size and text, so reruns agree. Extra columns are kept by
``mix``, else ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lacuna.session import cut_lineage

WEIGHTS, MOST, SEED = (5, 2, 1), 3, "mix-1"
BUCKET_ROWS, SMALL = 20_000, 100_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(size: Column, seed: str) -> Column:
    """In (0, 1), from 52 bits."""
    name = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), size.cast("string"),
                       F.md5(F.coalesce("text", F.lit(""))))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    return docs.withColumn("size", size_of(F.col("text"))).withColumn("u", _uniform(F.col("size"), seed))


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) and ``target``; a few rows, ranked in one task."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights))
    rows = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_ = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / open_)
    rows = rows.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole))
    return rows.withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))) \
        .drop("weight", "cap", "level")


def _order(rows: DataFrame) -> DataFrame:
    """``q``: random odds divided by inclusion odds; null where the source has nothing left to sample."""
    share = F.col("rest") / F.col("source_size")
    odds = share / (1 - share) * F.sqrt(F.col("source_size") / F.col("n") / F.greatest(F.col("size"), F.lit(1)))
    return rows.withColumn("q", F.when(F.col("rest") > 0, F.col("u") / (1 - F.col("u")) / odds))


def _place() -> Column:
    return F.struct(F.col("q").alias("q"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.col("size").alias("size"))


def _with(rows: DataFrame, info: DataFrame, small: bool) -> DataFrame:
    info = info.withColumnRenamed("source", "of")
    return rows.join(F.broadcast(info) if small else info, rows["source"].eqNullSafe(F.col("of")), "left").drop("of")


def plan(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> tuple[DataFrame, bool]:
    """For each source its size, target, whole copies, rest and cut (the last place that the sample
    takes); and whether the sources are few enough to be broadcast. ``rows``: source, doc_id, size, u."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    info = targets(sources, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    info = info.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    info = cut_lineage(info)
    small = info.count() <= SMALL
    ordered = _order(_with(rows, info, small)).filter(F.col("q").isNotNull())
    ordered = ordered.withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * F.ceil(F.col("n") / BUCKET_ROWS)))
    sums = ordered.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("words").over(upto)).withColumn("before", F.col("upto") - F.col("words"))
    at = sums.filter("before < rest and upto >= rest").select("source", F.col("bucket").alias("cut_bucket"), "before")
    near = _with(ordered, at, small).filter("bucket = cut_bucket")
    run = Window.partitionBy("source").orderBy(_place()).rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("to", F.col("before") + F.sum("size").over(run))
    taken = near.filter(F.col("to") + (F.col("to") - F.col("size")) <= 2 * F.col("rest"))
    cut = near.groupBy("source").agg(F.min(F.struct("cut_bucket", "before")).alias("edge")).select("source", "edge.cut_bucket")
    last = taken.groupBy("source").agg(F.max(_place()).alias("cut"))
    out = _with(_with(info, cut, small), last, small)
    return cut_lineage(out), small


def attach(rows: DataFrame, info: DataFrame, small: bool) -> DataFrame:
    """``rows`` (source, doc_id, size, u, …) with source_size, target and ``copies``."""
    kept = [c for c in rows.columns if c != "u"]
    rows = _order(_with(rows, info, small))
    bucket = F.floor(F.col("q") / (1 + F.col("q")) * F.ceil(F.col("n") / BUCKET_ROWS))
    extra = F.when(F.col("cut").isNull(), bucket < F.col("cut_bucket")).otherwise(_place() <= F.col("cut"))
    copies = F.col("whole") + F.coalesce(extra, F.lit(False)).cast("int")
    return rows.select(*kept, "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, copies and ``taken`` words of every row."""
    rows = cut_lineage(sized(docs.select("doc_id", "source", "text")).drop("text"))
    return attach(rows, *plan(rows)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame) -> DataFrame:
    """``docs``, each row as often as the mix takes it."""
    rows = cut_lineage(sized(docs.select("doc_id", "source", "text")).drop("text"))
    whole = docs.select(F.struct(*docs.columns).alias("doc"))  # whatever its columns are named
    found = attach(sized(whole.select("doc", "doc.doc_id", "doc.source", "doc.text")), *plan(rows))
    return found.filter("copies > 0").withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("doc.*")
