"""Exact k-nearest search between two tables of vectors (similar series, nearest points)."""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


CELL = 256
ITEMS, MARGIN, TILE, EXACT = 32768, 1e-8, (512, 2048), 1 << 16  # correlations: items of a task, slack of a product of matrices, its size, pairs compared at once
ASKED = 16  # blocks of queries up to which these are as small as asked for


def cell_topk(queries: DataFrame, items: DataFrame, part: list[str], k: int, pivots: int = 256, block: int = 4096,
              correlate: bool = False) -> DataFrame:
    """Exact k nearest items by Euclidean distance: (part…, q_id, i_id, dist, rank).

    With ``correlate`` the arrays are z-normalised, and items are ranked by the correlation (rounded to 9
    digits, the smaller id first); ``dist`` is then the distance that the rounded correlation stands for,
    and a column ``sim`` has the correlation itself, from the two arrays.

    ``queries``: part…, q_id, q_z; ``items``: part…, i_id, i_z (arrays of one length within a part);
    an item is no neighbour of the query with its id; ties (distances rounded to 9 digits) go to the
    smaller id.

    Correlated vectors have many entries, where cells rule out next to nothing: blocks of queries meet blocks of items as
    products of matrices (``_tiled_topk``). For distances, if no part has more than ``block`` items, a block of queries
    meets all items of its part in one vectorised task. Else items fall into the cell of their nearest pivot (one item in CELL of the part, at most ``pivots`` or
    the root of the largest part's size, drawn by hash). A query meets its own cell first, which bounds its k-th
    distance r; then only the cells whose pivot is no farther than r plus the cell's radius can hold a nearer
    item (triangle inequality). Cells are cut into blocks of about ``block`` items, and the queries of a cell into
    blocks too, by hash; a block of items and one of queries are one task that returns k rows for a query, so no
    pair is ever a row.
    """
    types = {f.name: f.dataType.simpleString() for f in queries.select(*part, "q_id").schema.fields}
    types["i_id"] = items.schema["i_id"].dataType.simpleString()
    schema = ", ".join(f"{c} {t}" for c, t in types.items()) + ", dist double, sim double, rank int"
    search = partial(_block_topk, part=part, k=k)
    own = lambda df, cols: df.select([F.col(c).alias(c) for c in cols])  # noqa: E731  both sides may stem from one table
    if correlate:
        return _blocks_topk(queries, items, part, k, block, schema, own)
    sizes = items.groupBy(*part).agg(F.count(F.lit(1)).alias("_size"))
    most = sizes.agg(F.max("_size")).first()[0] or 0
    if most <= block:
        n = max(1, -(-queries.count() // block))
        key = [*part, "block"]
        asked = queries.withColumn("block", F.pmod(F.xxhash64("q_id"), F.lit(n)).cast("int"))
        found = items.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        near = own(asked, [*key, "q_id", "q_z"]).groupBy(*key).cogroup(own(found, [*key, "i_id", "i_z"]).groupBy(*key)).applyInArrow(search, schema)
        return near.drop("sim")
    return _cells_topk(queries, items, part, k, sizes, max(pivots, math.isqrt(most) + 1), block, search, schema, own)


def _blocks_topk(queries: DataFrame, items: DataFrame, part: list[str], k: int, block: int, schema: str, own) -> DataFrame:
    """Every block of queries of a part against every block of its items: k rows a query and block of items, then the best k of these.
    Queries that occur several times are asked once and repeated in the end."""
    from lacuna.session import cut_lineage
    asked = queries.groupBy(*part, "q_id", "q_z").agg(F.count(F.lit(1)).alias("_copies")).withColumn("q_no", F.xxhash64(*part, "q_id", "q_z"))
    asked = cut_lineage(asked)
    sizes = asked.groupBy(*part).agg(F.count(F.lit(1)).alias("_asked"), F.max("_copies").alias("_most"))
    n_asked, copies = sizes.agg(F.max("_asked"), F.max("_most")).first()
    most = items.groupBy(*part).agg(F.count(F.lit(1)).alias("_items")).agg(F.max("_items")).first()[0]
    n_q, n_i = (max(1, -(-(n or 0) // size)) for n, size in ((n_asked, block), (most, ITEMS)))
    n_q = min(n_q, max(ASKED, -(-(n_asked or 0) // ITEMS)))  # each block of queries gets all items: with many small ones, these would grow with the square
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qblock", F.pmod("q_no", F.lit(n_q)).cast("int")).withColumn("iblock", every(n_i))
    right = items.withColumn("iblock", F.pmod(F.xxhash64("i_id"), F.lit(n_i)).cast("int")).withColumn("qblock", every(n_q))
    key = [*part, "qblock", "iblock"]
    search = partial(_tiled_topk, part=part, k=k)
    near = (own(left, [*key, "q_id", "q_no", "q_z"]).groupBy(*key).cogroup(own(right, [*key, "i_id", "i_z"]).groupBy(*key))
            .applyInArrow(search, schema + ", q_no bigint"))
    if n_i > 1:
        best = Window.partitionBy(*part, "q_id", "q_no").orderBy("dist", "i_id")
        near = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    if (copies or 1) > 1:
        again = asked.filter("_copies > 1").select("q_no", "_copies")
        near = near.join(again, "q_no", "left").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_copies", F.lit(1)))))
    return near.select(*part, "q_id", "i_id", "dist", "sim", "rank")


def _cells_topk(queries: DataFrame, items: DataFrame, part: list[str], k: int, sizes: DataFrame, pivots: int, block: int, search, schema: str, own) -> DataFrame:
    from lacuna.session import cut_lineage
    drawn = Window.partitionBy(*part).orderBy(F.xxhash64("i_id"), "i_id")
    piv = (items.withColumn("_r", F.row_number().over(drawn)).filter(F.col("_r") <= pivots)
           .groupBy(*part).agg(F.sort_array(F.collect_list(F.struct("_r", "i_z"))).alias("_p")))
    piv = piv.join(sizes, part).select(*part, F.transform(F.slice("_p", F.lit(1), F.ceil(F.col("_size") / CELL).cast("int")), lambda p: p["i_z"]).alias("_piv"))

    def to_pivots(z):
        return F.transform("_piv", lambda p: F.sqrt(F.aggregate(F.zip_with(F.col(z), p, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)))

    it = items.join(piv, part).withColumn("_d", to_pivots("i_z")).withColumn("_near", F.array_min("_d"))
    it = it.select(*part, "i_id", "i_z", "_near", (F.array_position("_d", F.col("_near")) - 1).cast("int").alias("cell"))
    cells = it.groupBy(*part, "cell").agg(F.max("_near").alias("radius"), F.count(F.lit(1)).alias("_size"))
    cells = cells.withColumn("blocks", F.ceil(F.col("_size") / block).cast("int"))
    it = cut_lineage(it.join(cells.select(*part, "cell", "blocks"), [*part, "cell"])
                     .withColumn("block", F.pmod(F.xxhash64("i_id"), F.col("blocks")).cast("int")).drop("blocks", "_near"))
    listed = cells.groupBy(*part).agg(F.collect_list(F.struct("cell", "radius", "blocks")).alias("_cells"))
    # the distances to the pivots are computed where they are used, never stored with a query
    placed = queries.join(piv, part).join(listed, part).withColumn("_d", to_pivots("q_z"))
    home = F.array_min(F.transform("_cells", lambda c: F.struct(F.get(F.col("_d"), c["cell"]).alias("d"), c["cell"].alias("cell"), c["blocks"].alias("blocks"))))
    qs = cut_lineage(placed.select(*part, "q_id", "q_z", home.alias("_home")))
    key = [*part, "cell", "block", "qblock"]

    def near(asked: DataFrame) -> DataFrame:
        """``asked`` (part…, q_id, q_z, cell, blocks) against every block of its cell."""
        crowd = asked.groupBy(*part, "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("qblocks"))
        left = (asked.join(crowd, [*part, "cell"]).withColumn("qblock", F.pmod(F.xxhash64("q_id"), F.col("qblocks")).cast("int"))
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        right = it.join(crowd, [*part, "cell"]).withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)))
        return own(left, [*key, "q_id", "q_z"]).groupBy(*key).cogroup(own(right, [*key, "i_id", "i_z"]).groupBy(*key)).applyInArrow(search, schema).drop("rank")

    first = near(qs.select("*", F.col("_home.cell").alias("cell"), F.col("_home.blocks").alias("blocks")))
    best = Window.partitionBy(*part, "q_id").orderBy("dist", "i_id")
    first = cut_lineage(first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank"))
    reach = first.groupBy(*part, "q_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(float("inf")).alias("_r"))
    open_ = qs.join(reach, [*part, "q_id"], "left").withColumn("_r", F.coalesce("_r", F.lit(float("inf"))))
    open_ = open_.join(piv, part).join(listed, part).withColumn("_d", to_pivots("q_z"))
    far = F.filter("_cells", lambda c: (c["cell"] != F.col("_home.cell")) & (F.get(F.col("_d"), c["cell"]) - c["radius"] <= F.col("_r") + 1e-6))
    open_ = open_.select(*part, "q_id", "q_z", F.explode(far).alias("_c")).select(*part, "q_id", "q_z", F.col("_c.cell").alias("cell"), F.col("_c.blocks").alias("blocks"))
    every = first.unionByName(near(open_))
    every = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return every.drop("sim")


def _block_topk(asked: pa.Table, found: pa.Table, part: list[str], k: int) -> pa.Table:
    """The k nearest items of a block for each of its queries."""
    names = [*part, "q_id", "i_id", "dist", "sim", "rank"]
    types = [asked.schema.field(c).type for c in [*part, "q_id"]] + [found.schema.field("i_id").type, pa.float64(), pa.float64(), pa.int32()]
    rows = [[], [], [], [], []]
    if len(asked) and len(found):
        q = np.array(asked["q_z"].to_pylist(), np.float64)
        z = np.array(found["i_z"].to_pylist(), np.float64)
        q_id, i_id = asked["q_id"].to_numpy(), found["i_id"].to_numpy()
        step = max(1, (1 << 22) // max(1, z.size))
        for at in range(0, len(q), step):
            d = np.round(np.sqrt(((q[at:at + step, None, :] - z[None]) ** 2).sum(2)), 9)
            d[q_id[at:at + step, None] == i_id[None]] = np.inf
            for i, row in enumerate(d):
                near = np.nonzero(row <= np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1])[0]
                near = near[np.isfinite(row[near])]
                near = near[np.lexsort((i_id[near], row[near]))[:k]]
                rows[0] += [q_id[at + i]] * len(near)
                rows[1] += i_id[near].tolist()
                rows[2] += row[near].tolist()
                rows[3] += [None] * len(near)
                rows[4] += range(1, len(near) + 1)
    same = [[asked[c][0].as_py()] * len(rows[0]) if len(asked) else [] for c in part]
    return pa.table([pa.array(v, t) for v, t in zip([*same, *rows], types)], names=names)


def _tiled_topk(asked: pa.Table, found: pa.Table, part: list[str], k: int) -> pa.Table:
    """The k best correlated items of a block for each of its queries. A product of matrices, tile by tile, leaves the few items that come
    within MARGIN of a query's k-th best so far; only these are compared exactly, by distance and id."""
    types = [asked.schema.field(c).type for c in [*part, "q_id"]] + [found.schema.field("i_id").type, pa.float64(), pa.float64(), pa.int32(), pa.int64()]
    names = [*part, "q_id", "i_id", "dist", "sim", "rank", "q_no"]
    if not len(asked) or not len(found):
        return pa.table([pa.array([], t) for t in types], names=names)
    matrix = lambda t, c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
    q, z = matrix(asked, "q_z"), matrix(found, "i_z")
    dim = z.shape[1]
    q_id, i_id = asked["q_id"].to_numpy(), found["i_id"].to_numpy()
    place = np.unique(i_id, return_inverse=True)[1]  # ids in their order
    across = np.ascontiguousarray(z.T / dim)
    got: list[list[np.ndarray]] = [[], [], [], [], []]
    for at in range(0, len(q), TILE[0]):
        mine, own = q[at:at + TILE[0]], q_id[at:at + TILE[0]]
        row = col = np.zeros(0, np.int64)
        dist = sim = np.zeros(0)
        for lo in range(0, len(z), TILE[1]):
            near = mine @ across[:, lo:lo + TILE[1]]
            if lo == 0:
                near[own[:, None] == i_id[None, :TILE[1]]] = -np.inf
                near[np.isnan(near)] = -np.inf
                least = np.partition(near, -k, axis=1)[:, -k] - MARGIN if near.shape[1] >= k else np.full(len(mine), -np.inf)
                near[near == -np.inf] = np.nan
            hit = np.flatnonzero(near >= least[:, None])
            if not len(hit):
                continue
            r, c = hit // near.shape[1], hit % near.shape[1] + lo
            other = own[r] != i_id[c]
            r, c = r[other], c[other]
            s = np.concatenate([(mine[r[i:i + EXACT]] * z[c[i:i + EXACT]]).sum(1) for i in range(0, len(r) + 1, EXACT)]) / dim
            row, col, sim = np.r_[row, r], np.r_[col, c], np.r_[sim, s]
            dist = np.r_[dist, np.sqrt(2 * dim * np.maximum(1 - np.round(s, 9), 0))]
            order = np.lexsort((place[col], dist, row))
            order = order[_rank(row[order]) < k]
            row, col, sim, dist = row[order], col[order], sim[order], dist[order]
            last = np.flatnonzero(_rank(row) == k - 1)
            least = np.full(len(mine), -np.inf)
            least[row[last]] = np.minimum(sim[last], 1.0) - MARGIN
        for have, more in zip(got, (row + at, col, dist, sim, _rank(row) + 1)):
            have.append(more)
    a, i, dist, sim, rank = (np.concatenate(v) for v in got)
    head = [asked[c].take(pa.array(a)) for c in [*part, "q_id"]]
    return pa.table([*head, found["i_id"].take(pa.array(i)), pa.array(dist), pa.array(sim), pa.array(rank, pa.int32()), asked["q_no"].take(pa.array(a))], names=names)


def _rank(row: np.ndarray) -> np.ndarray:
    """0, 1, … within each run of equal numbers of a sorted array."""
    return np.arange(len(row)) - np.searchsorted(row, row)
