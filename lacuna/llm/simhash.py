"""SimHash near-duplicate groups with pigeonring candidate filtering.

A 64-bit fingerprint is cut into ``SEGMENTS`` ring segments. If two fingerprints differ in at most
``max_bits`` bits, some starting segment exists from which every chain of l consecutive segments
differs in at most floor(l * max_bits / SEGMENTS) bits. The leading chain whose budget is zero is an
equi-join key, the longer chains are tested bit by bit, the chain over the whole ring is the full
Hamming check.

A bucket of more than ``BUCKET`` fingerprints forms no pairs. Its members are linked in linear time
instead: for ``max_bits`` = 2, two fingerprints link exactly if they share a point at one flipped bit
or less from each, so each member is sent to its 65 such points and all that meet there link to the
smallest. Nothing is dropped.

Rows: null, empty and word-free texts have fingerprint zero and link like any other. Repeated rows
get equal results. Rows whose ``doc_id`` is null take part, but never name a component; a component
of such rows only has a null id. Other columns of the input are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lacuna.session import cut_lineage

SEGMENTS = 5
BUCKET = 32
CROWDED, MANY = 1000, 100_000
_ORDER = "order of representatives"
_SLICE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles (A-Z lower-cased, XXH64 with seed 42), as unsigned int."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    grams = map(b" ".join, zip(*(words[i:] for i in range(k))))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), grams), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at:at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *keep: str) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) and the columns ``keep`` of every row."""
    names = ["doc_id", "fp", *keep]

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *b.columns[2:]], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "utf-8").alias("text"), *[F.col(f"`{c}`") for c in keep])
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), *(rows.schema[c] for c in keep)]))


def _segments(segments: int) -> list[tuple[int, int]]:
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    return list(zip(cuts, cuts[1:]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _chains(segments: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """For each start: the (bit mask, budget) of the chains of 1 … segments segments."""
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in _segments(segments)]
    out = []
    for start in range(segments):
        mask, chain = 0, []
        for n in range(segments):
            mask |= masks[(start + n) % segments]
            chain.append((_signed(mask), (n + 1) * max_bits // segments))
        out.append(chain)
    return out


def _key_masks(segments: int, max_bits: int) -> list[int]:
    """For each start: the mask of the longest chain whose budget is zero."""
    return [[m for m, budget in chain if budget == 0][-1] for chain in _chains(segments, max_bits)]


def _viable(start: Column, diff: Column, segments: int, max_bits: int) -> Column:
    """All chains from ``start`` stay within their budgets; the last is the full Hamming check."""
    test = F.lit(False)
    for i, chain in enumerate(_chains(segments, max_bits)):
        ok = F.lit(True)
        for mask, budget in chain:
            ok = ok & (F.bit_count(diff.bitwiseAND(F.lit(mask))) <= budget)
        test = test | ((start == i) & ok)
    return test


def links(nodes: DataFrame, max_bits: int = 2, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """(a, b), a < b: links between the distinct fingerprints ``nodes.fp`` that have the same
    connected components as all pairs within ``max_bits`` bits; every link is such a pair."""
    if max_bits != 2:
        raise ValueError("the linear way for large buckets is for two bits")
    starts = F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(_key_masks(segments, max_bits))])
    rows = nodes.select("fp", F.inline(starts))
    sizes = rows.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = cut_lineage(rows.join(sizes, ["start", "key"]))
    small = met.filter(F.col("n") <= bucket)
    pairs = (small.select("start", "key", F.col("fp").alias("a"))
             .join(small.select("start", "key", F.col("fp").alias("b")), ["start", "key"])
             .filter("a < b")
             .filter(_viable(F.col("start"), F.col("a").bitwiseXOR(F.col("b")), segments, max_bits))
             .select("a", "b"))
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    points = (met.filter(F.col("n") > bucket).select("fp").distinct()
              .select("fp", F.explode(near).alias("point")))
    centre = points.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = (points.join(centre.select("point", "a"), "point").filter("a < fp")
             .select("a", F.col("fp").alias("b")))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for the nodes of ``edges``.

    Each round takes the smallest label of the neighbours, then the label of that label. A node has
    at most 2 080 neighbours, as fingerprints within two bits are that many.
    """
    both = cut_lineage(edges.select(F.col("a").alias("node"), F.col("b").alias("to"))
                       .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to"))))
    labels = cut_lineage(both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("root")))
    while True:
        seen = (both.join(labels.select(F.col("node").alias("to"), F.col("root").alias("far")), "to")
                .groupBy("node").agg(F.min("far").alias("far")))
        step = (labels.join(seen, "node")
                .select("node", F.col("root").alias("old"), F.least("root", "far").alias("mid")))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("up"))
        step = cut_lineage(step.join(jump, "mid", "left")
                           .select("node", "old", F.least("mid", F.coalesce("up", "mid")).alias("root")))
        labels = step.select("node", "root")
        if step.filter("old != root").isEmpty():
            return labels


def _components(marked: DataFrame, name: str, max_bits: int) -> DataFrame:
    """fp, ``rows``, and the least ``name`` among all rows of its component, of every fingerprint of ``marked``."""
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min(name).alias("first"), F.count(F.lit(1)).alias("rows")))
    roots = components(links(nodes.select("fp"), max_bits))
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "first")
    named = linked.groupBy("root").agg(F.min("first").alias("least"))
    return nodes.join(linked.join(named, "root").select("fp", "least"), "fp", "left") \
        .select("fp", "rows", F.coalesce("least", "first").alias("least"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs`` (doc_id, text, …).

    Rows of a fingerprint that very many share get theirs by broadcast: those of over CROWDED rows and one row in
    MANY, so at most MANY fingerprints."""
    marked = cut_lineage(fingerprints(docs, shingle))
    of = cut_lineage(_components(marked, "doc_id", max_bits).select("fp", "rows", F.col("least").alias("component_id")))
    most = max(CROWDED, marked.count() // MANY)
    crowded = F.broadcast(of.filter(F.col("rows") > most).select("fp", "component_id"))
    few = marked.join(crowded.select("fp"), "fp", "left_anti").join(of.filter(F.col("rows") <= most), "fp")
    out = ["doc_id", "fp", "component_id"]
    return few.select(*out).unionByName(marked.join(crowded, "fp").select(*out))


def representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` for each component: of the smallest doc_id (null last), and of several texts
    or rows under it the one with the smallest hash. Which it is depends on the rows alone."""
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("id"),
                     F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"), F.xxhash64(*docs.columns).alias("row"))
    marked = cut_lineage(fingerprints(docs.withColumn(_ORDER, order), shingle, _ORDER))
    kept = _components(marked, _ORDER, max_bits).select("least.*").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("doc"), order.alias("o"))  # whatever its columns are named
    key = ["unnamed", "id", "text", "row"]
    flat = lambda df, of: df.withColumns({c: F.coalesce(F.col(f"{of}{c}"), F.lit(0)) if c == "id" else F.col(f"{of}{c}") for c in key})
    # one exchange of the texts serves the join and the collapse of rows that are equal throughout
    return flat(rows, "o.").drop("o").join(flat(kept, ""), key, "left_semi").dropDuplicates(key).select("doc.*")
