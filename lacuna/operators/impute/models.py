"""H7: completion by a random forest on the change per day, one forest for each series.

A series (bounded by the calendar) is the unit of work: Spark gathers it as arrays, a task grows all its trees
level by level at once (NumPy over rows × trees), and one prediction a row goes back. Trees are
CART regression trees: bootstrap rows, every feature tried at every node, the split with the least squared error at the
midpoint of two neighbouring values, down to pure nodes. Scores that agree in nine digits are ties: the
earlier feature, then the smaller threshold. Bootstrap draws come from the MD5 of series, tree and draw, so
reruns, retries and SQL see the same trees.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH, rate_per_day

MIN_TRAIN = 3


def bootstrap(name: str, n: int, trees: int, seed: int) -> np.ndarray:
    """How often each of ``n`` rows is drawn for each tree (trees × n)."""
    draws, found = [f"{i}|{seed}".encode() for i in range(n)], []
    for t in range(trees):
        head = hashlib.md5(f"{name}|{t}|".encode())
        for d in draws:
            h = head.copy()
            h.update(d)
            found.append(h.digest()[:4])
    drawn = np.frombuffer(b"".join(found), ">u4") % n
    return np.bincount(np.repeat(np.arange(trees) * n, n) + drawn, minlength=trees * n).reshape(trees, n)


def _by_node(node: np.ndarray) -> np.ndarray:
    """Stable order by node: numbers of 16 bits are dealt out instead of compared."""
    return np.argsort(node.astype(np.uint16) if len(node) and node.max() < 1 << 16 else node, kind="stable")


def _best_splits(g: np.ndarray, v: np.ndarray, w: np.ndarray, s: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score (-inf without a split) and threshold of the best split of each node (``size`` rows each) on one feature; node, feature, weight and
    weighted target of the rows, in the order of node and feature."""
    cw, cs = np.cumsum(w), np.cumsum(s)
    end = np.cumsum(size)
    first, last = end - size, end - 1
    base_w, base_s = (np.concatenate([[0], c])[first] for c in (cw, cs))
    total_w, total_s = cw[last] - base_w, cs[last] - base_s
    at = np.flatnonzero((g[1:] == g[:-1]) & (v[1:] > v[:-1]))
    score, threshold = np.full(len(size), -np.inf), np.zeros(len(size))
    if len(at):
        own = g[at]
        lw, ls = cw[at] - base_w[own], cs[at] - base_s[own]
        value = np.round(ls ** 2 / lw + (total_s[own] - ls) ** 2 / (total_w[own] - lw), 9)
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        score[own[start]] = np.maximum.reduceat(value, start)
        hit = np.flatnonzero(value == score[own])[::-1]  # the first of equal ones is written last
        threshold[own[hit]] = (v[at[hit]] + v[at[hit] + 1]) / 2
    return score, threshold


def forest(x: np.ndarray, y: np.ndarray, asked: np.ndarray, weights: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Mean prediction over the trees of the rows ``asked``; ``weights`` (trees × rows) are the bootstrap counts.

    Rows are sorted by each feature once; a level's order is the last one's without the rows of ended nodes, dealt out by node."""
    trees, n = weights.shape
    out = np.zeros((trees, len(asked)))
    tree_of, row = np.nonzero(weights)
    node, w = tree_of.copy(), weights[tree_of, row].astype(np.float64)
    orders = [np.lexsort((x[row, f], node)) for f in range(x.shape[1])]
    ask = np.repeat(np.arange(trees), len(asked))  # node of each asked row in each tree
    open_ = np.arange(trees * len(asked))
    cell, cells = np.tile(np.arange(len(asked)) * x.shape[1], trees), np.ascontiguousarray(asked).ravel()  # where an asked row begins
    n_nodes, level = trees, 0
    while n_nodes:
        target = y[row]
        weighted = w * target
        size = np.bincount(node, minlength=n_nodes)
        total = np.bincount(node, w, n_nodes)
        mean = np.bincount(node, weighted, n_nodes) / total
        low, high = np.full(n_nodes, np.inf), np.full(n_nodes, -np.inf)
        some = np.flatnonzero(size)
        if len(some):
            start, sorted_ = (np.cumsum(size) - size)[some], target[orders[0]]
            low[some], high[some] = np.minimum.reduceat(sorted_, start), np.maximum.reduceat(sorted_, start)
        best, feature, threshold = np.full(n_nodes, -np.inf), np.zeros(n_nodes, np.int64), np.zeros(n_nodes)
        if depth is None or level < depth:
            for f, order in enumerate(orders):
                score, at = _best_splits(node[order], x[row[order], f], w[order], weighted[order], size)
                better = score > best
                best[better], feature[better], threshold[better] = score[better], f, at[better]
        split = np.isfinite(best) & (high > low)
        ended = ~split[ask]
        out.ravel()[open_[ended]] = mean[ask[ended]]
        going = ~ended
        open_, ask, cell = open_[going], ask[going], cell[going]
        number = np.cumsum(split) - 1
        right = cells[cell + feature[ask]] > threshold[ask]
        ask = 2 * number[ask] + right
        keep = split[node]
        place = np.cumsum(keep) - 1
        orders = [place[order[keep[order]]] for order in orders]
        row, node, w = row[keep], node[keep], w[keep]
        node = 2 * number[node] + (x[row, feature[node]] > threshold[node])
        orders = [order[_by_node(node[order])] for order in orders]
        n_nodes, level = 2 * int(split.sum()), level + 1
    return out.mean(axis=0)


def impute_forest_delta(df: DataFrame, value: str, station: str = STATION, time: str = MONTH, out: str | None = None,
                        features: list[str] | None = None, num_trees: int = 100, seed: int = 42, depth: int | None = None) -> DataFrame:
    """H7: regress Δ/day on the features (default pet, temp) from a series' rows having target, Δ/day and the
    features; missing features → their training mean; a null first value ← first known value; then each
    null row = previous + predicted Δ/day × elapsed days (closed form: running sums inside a gap). A series with
    fewer than MIN_TRAIN training rows is null throughout."""
    out = out or value
    features = features or ["pet", "temp"]
    t = rate_per_day(df, value, station, time)
    row = F.struct(F.col(time).alias("t"), F.when(F.col(value).isNotNull(), F.col("delta_per_day")).alias("y"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    series = t.groupBy(station).agg(F.sort_array(F.collect_list(row)).alias("_s"))
    series = series.select(station, F.col(station).cast("string").alias("name"), F.col("_s.t").alias("times"), F.col("_s.y").alias("y"), *[F.col(f"_s.x{i}").alias(f"x{i}") for i in range(len(features))])
    kind, when = series.schema[station].dataType.simpleString(), series.schema["times"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = []
            for i, name in enumerate(b.column(1).to_pylist()):
                y, *x = (c[i].values.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns[3:])
                x = np.stack(x, axis=1)
                known = ~np.isnan(y) & ~np.isnan(x).any(axis=1)
                n = int(known.sum())
                if n < MIN_TRAIN:
                    found.append([None] * len(y))
                    continue
                filled = np.where(np.isnan(x), x[known].mean(axis=0), x)
                found.append(forest(x[known], y[known], filled, bootstrap(name, n, num_trees, seed), depth))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(pa.float64()))], [station, "times", "pred"])

    pred = series.mapInArrow(run, f"`{station}` {kind}, times {when}, pred array<double>")
    pred = pred.select(station, F.inline(F.arrays_zip("times", "pred"))).select(station, F.col("times").alias(time), F.col("pred").alias("_pred"))
    pred = t.join(pred, [station, time])
    w = Window.partitionBy(station).orderBy(time)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_known = F.first(value, True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pred = pred.withColumn("_rn", F.row_number().over(w))
    y0 = F.when((F.col("_rn") == 1) & F.col(value).isNull(), first_known).otherwise(F.col(value))
    pred = pred.withColumn("_y", y0)
    step = F.when(F.col("_rn") == 1, F.lit(0.0)).otherwise(F.col("_pred") * F.coalesce("days_diff", F.lit(0.0)))
    pred = pred.withColumn("_S", F.sum(step).over(upto))
    anchor = F.last(F.when(F.col("_y").isNotNull(), F.struct(F.col("_y").alias("y"), F.col("_S").alias("s"))), True).over(upto)
    pred = pred.withColumn("_a", anchor)
    res = F.when(F.col("_pred").isNull(), F.lit(None)).when(F.col("_y").isNotNull(), F.col("_y")).otherwise(F.col("_a.y") + F.col("_S") - F.col("_a.s"))
    keep = [c for c in df.columns if c != out]
    return pred.withColumn(out, res).select(*keep, out)
