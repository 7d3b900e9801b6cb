"""Random forests by bins: each tree learns from a bootstrap of the rows, each node tries ``max_features`` features, all cuts between bins.

The method and the settings are those of MLlib's forest: Poisson weights of the rows, quantile bins, the square root of the number of features,
Gini impurity, classes by the mean share of the leaves. What differs is where the work is done: trees are grown and kept by
``operators/forest.py``, so a forest may be larger than the driver. Leaves of equal class are not merged.

Weights are hashes of (tree, row), tried features hashes of (tree, node, feature); all sums are of whole numbers. So the trees are the
same for any partitioning and number of blocks.

Defined cases: rows that are equal in key and values have the same weights; NaN is an error, as in MLlib; a node whose cuts bring no fall of the
impurity is a leaf; a tree without rows, and a model without rows, predicts equal shares; equal falls go to the feature that comes first in
the node's order, then to the lowest cut.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.operators.boosting import _draws, _mix, to_bins
from inkprint.operators.forest import BLOCK_CELLS, DOOR, Door, grow_forest, packed, read_block, to_blocks, walk
from inkprint.operators.randomtrees import Tree

LEVEL_CELLS = 1 << 21
QUANTILES = 512
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))  # of 0, 1, 2, ... draws of a row


@dataclass(frozen=True)
class ForestParams:
    n_estimators: int = 100
    max_depth: int = 30
    min_rows: int = 1  # of a child
    bins: int = 32
    max_features: int = 0  # 0: the square root of their number
    seed: int = 0

    def __post_init__(self):
        if not (0 <= self.max_depth <= 30 and 2 <= self.bins <= 256):
            raise ValueError("max_depth must be 0 to 30, bins 2 to 256")

    def tried(self, width: int) -> int:
        return min(width, self.max_features or max(1, int(np.ceil(np.sqrt(width)))))


def tried_features(params: ForestParams, number: int, heaps: np.ndarray, width: int) -> np.ndarray:
    """[node, place]: the features that each node tries, in the order of a hash."""
    node = _mix(heaps.astype(np.uint64) ^ _mix(np.array([(params.seed * 0x9E3779B1 + number + 1) & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64)))
    order = _mix(node[:, None] ^ _mix(np.arange(1, width + 1)))
    return np.argsort(order, axis=1, kind="stable")[:, :params.tried(width)]


def _worth(left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
    """Sum of squared counts by rows, of both sides [..., class]: the larger, the lower the impurity."""
    a, b = left.sum(-1), right.sum(-1)
    worth = (left.astype(np.float64) ** 2).sum(-1) / np.maximum(a, 1) + (right.astype(np.float64) ** 2).sum(-1) / np.maximum(b, 1)
    return np.where((a >= max(1, least)) & (b >= max(1, least)), worth, -np.inf)


def _pure_worth(total: np.ndarray) -> np.ndarray:
    n = total.sum(-1)
    return (total.astype(np.float64) ** 2).sum(-1) / np.maximum(n, 1)


def best_cuts(x: np.ndarray, label: np.ndarray, weight: np.ndarray, slot: np.ndarray, tried: np.ndarray, total: np.ndarray, bins: int,
              least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(worth, feature, bin) of the best cut of each node; ``slot`` is the node of each row, ascending, and every node has rows.
    Nodes are taken some at a time, so that counts stay below ``LEVEL_CELLS``."""
    n, classes = total.shape
    worth, feature, cut = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, dtype=np.int64)
    first = np.searchsorted(slot, np.arange(n + 1))
    cells = np.cumsum(np.minimum(np.diff(first), bins) * classes)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(cells, (cells[a - 1] if a else 0) + LEVEL_CELLS, side="right")))
        rows = slice(first[a], first[b])
        s, y, w = slot[rows] - a, label[rows], weight[rows]
        at = np.arange(first[a], first[b])
        for j in range(tried.shape[1]):
            key = s * bins + x[at, tried[a:b, j][s]]
            if (b - a) * bins <= 2 * len(s):
                node, value = np.divmod(np.arange((b - a) * bins), bins)
                counts = np.bincount(key * classes + y, w, (b - a) * bins * classes).reshape(-1, classes)
            else:  # few rows a node: only the bins that are met
                order = np.argsort(key, kind="stable")
                new = np.diff(key[order], prepend=-1) > 0
                node, value = np.divmod(key[order][new], bins)
                counts = np.bincount((np.cumsum(new) - 1) * classes + y[order], w[order], int(new.sum()) * classes).reshape(-1, classes)
            starts = np.flatnonzero(np.diff(node, prepend=-1))
            summed = np.cumsum(counts, axis=0)
            left = summed - np.where(starts > 0, 1, 0)[node][:, None] * summed[np.maximum(starts - 1, 0)][node]
            found = _worth(left, total[a:b][node] - left, least)
            top = np.maximum.reduceat(found, starts)
            place = np.flatnonzero(found == top[node])
            place = place[np.diff(node[place], prepend=-1) > 0]
            better = np.flatnonzero(top > worth[a:b])
            worth[a + better], feature[a + better], cut[a + better] = top[better], tried[a + better, j], value[place[better]]
        a = b
    return worth, feature, cut


def grow_bins(x: np.ndarray, label: np.ndarray, weight: np.ndarray, number: int, heap: int, depth: int, params: ForestParams,
              n_classes: int, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, float]]:
    """(feature, bin, left, counts, falls) of a tree on one block, or of what lies below its node ``heap``, level by level."""
    kept = np.flatnonzero(weight)
    x, label, weight, slot = x[kept], label[kept], weight[kept], np.zeros(len(kept), dtype=np.int64)
    heaps, levels, made, falls = np.array([heap], dtype=np.uint64), [], 0, np.zeros(x.shape[1])
    while len(heaps):
        n = len(heaps)
        total = np.bincount(slot * n_classes + label, weight, n * n_classes).reshape(n, n_classes).astype(np.int64)
        feature, cut, left = np.full(n, -1), np.zeros(n, dtype=np.int64), np.full(n, -1)
        may = (total.max(1) < total.sum(1)) & (depth < params.max_depth)
        inside = may[slot]
        x, label, weight, slot = x[inside], label[inside], weight[inside], (np.cumsum(may) - 1)[slot[inside]]
        order = np.argsort(slot, kind="stable")
        x, label, weight, slot = x[order], label[order], weight[order], slot[order]
        at = np.flatnonzero(may)
        if len(at):
            worth, f, c = best_cuts(x, label, weight, slot, tried_features(params, number, heaps[at], x.shape[1]), total[at], bins, params.min_rows)
            fall = worth - _pure_worth(total[at])
            good = fall > 1e-9
            feature[at[good]], cut[at[good]] = f[good], c[good]
            left[at[good]] = made + n + 2 * np.arange(good.sum())
            np.add.at(falls, f[good], fall[good])
            inside = good[slot]
            x, label, weight, slot = x[inside], label[inside], weight[inside], slot[inside]
            right = x[np.arange(len(x)), f[slot]] > c[slot]
            slot = 2 * (np.cumsum(good) - 1)[slot] + right
            at = at[good]
        levels.append((feature, cut, left, total))
        made += n
        heaps = (2 * heaps[at][:, None] + np.array([1, 2], dtype=np.uint64)).ravel()
        depth += 1
    feature, cut, left, counts = (np.concatenate(part) for part in zip(*levels))
    return feature, cut, left, counts, {k: float(v) for k, v in enumerate(falls) if v}


@dataclass(frozen=True)
class _Kind:
    """These trees for ``operators/forest.py``. Blocks hold bins; the finished trees hold values."""

    params: ForestParams
    width: int
    n_classes: int
    cuts: list
    cell = np.uint8

    @property
    def bins(self) -> int:
        return max([len(c) for c in self.cuts], default=0) + 1

    @property
    def number_of_trees(self) -> int:
        return self.params.n_estimators

    def weights(self, draw: np.ndarray, number: int) -> np.ndarray:
        return np.searchsorted(_POISSON, _draws(draw, self.params.seed, number, 3), side="right").astype(np.uint8)

    def grow(self, x, label, weight, number, heap, depth) -> tuple[dict, dict]:
        feature, cut, left, counts, fall = grow_bins(x, label, weight, number, heap, depth, self.params, self.n_classes, self.bins)
        return self.values(packed(feature, cut, left, counts)), fall

    def values(self, nodes: dict) -> dict:
        """Cuts between bins as cuts between values."""
        inner = np.flatnonzero(nodes["feature"] >= 0)
        table = np.full((max(1, self.width), self.bins), np.inf)
        for k, c in enumerate(self.cuts):
            table[k, :len(c)] = c
        cut = nodes["cut"].copy()
        cut[inner] = table[nodes["feature"][inner], cut[inner].astype(np.int64)]
        return nodes | {"cut": cut}

    def tops(self, blocks: DataFrame, limit: int) -> list[tuple[dict, dict, list[Door]]]:
        trees = _tops(blocks, self, limit)
        return [(t.nodes(), t.fall, t.doors) for t in trees]


def _tops(blocks: DataFrame, kind: _Kind, limit: int) -> list[Tree]:
    """The trees down to nodes of ``limit`` rows. A pass over the blocks is a level of all trees: counts by (open node, tried feature, bin,
    class) are summed by tree, and only the best cuts reach the driver."""
    spark, p, bins, classes = blocks.sparkSession, kind.params, kind.bins, kind.n_classes
    trees = [Tree(k, p, kind.width, classes, limit=limit) for k in range(p.n_estimators)]

    def tried(tree: Tree) -> np.ndarray:
        return tried_features(p, tree.number, np.array([tree.heap[k] for k in tree.open], dtype=np.uint64), kind.width)

    def count(now):
        def run(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    x, label, draw = read_block(row, kind)
                    for tree in now.value:
                        slot = tree.slots()[walk(tree.nodes(), x)]
                        weight = kind.weights(draw, tree.number)
                        rows = np.flatnonzero((slot >= 0) & (weight > 0))
                        of, y, w = tried(tree), label[rows], weight[rows]
                        n, m = of.shape
                        mine = np.empty((m, n, bins, classes))
                        for j in range(m):
                            at = (slot[rows] * bins + x[rows, of[slot[rows], j]]) * classes + y
                            mine[j] = np.bincount(at, w, n * bins * classes).reshape(n, bins, classes)
                        total[tree.number] = total[tree.number] + mine if tree.number in total else mine
            for number, counts in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([counts.astype(np.int64).tobytes()], pa.binary())], ["tree", "made"])
        return run

    def cut(now):
        def run(batches):
            by, total = {t.number: t for t in now.value}, {}
            for batch in batches:
                for number, made in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    counts = np.frombuffer(made, np.int64)
                    total[number] = total[number] + counts if number in total else counts
            for number, counts in total.items():
                of = tried(by[number])
                n, m = of.shape
                left = np.cumsum(counts.reshape(m, n, bins, classes), axis=2)
                whole = left[0, :, -1]
                worth = _worth(left, whole[None, :, None] - left, p.min_rows).transpose(1, 0, 2).reshape(n, -1)
                best, k = worth.argmax(1), np.arange(n)
                good = (worth[k, best] - _pure_worth(whole) > 1e-9) & (whole.max(1) < whole.sum(1))
                j, c = np.divmod(best, bins)
                found = [(int(of[i, j[i]]), int(c[i]), left[j[i], i, c[i]].tolist(), whole[i].tolist(), bool(good[i])) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([json.dumps(found).encode()], pa.binary())], ["tree", "made"])
        return run

    while any(t.open for t in trees):
        now = spark.sparkContext.broadcast([t for t in trees if t.open])
        tasks = max(1, min(len(now.value), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        found = blocks.mapInArrow(count(now), "tree int, made binary").repartition(tasks, "tree").mapInArrow(cut(now), "tree int, made binary").collect()
        for r in found:
            made = json.loads(bytes(r["made"]))
            tree = trees[r["tree"]]
            tree.tried = [[(f, float(c))] for f, c, *_ in made]
            tree.split(np.array([0 if good else -1 for *_, good in made]), np.array([m[2] for m in made]), np.array([m[3] for m in made]))
        now.unpersist()
    return trees


def cuts_between(values: list[float], bins: int) -> list[float]:
    """Cuts between sorted values that may repeat: between all different ones, or where their counts come closest to equal shares. A frequent
    value takes one bin, and the bins that it saves go to the values after it."""
    different, counts = np.unique(np.array(values, dtype=np.float64), return_counts=True)
    if len(different) <= bins:
        return ((different[1:] + different[:-1]) / 2).tolist()
    stride, cuts = len(values) / bins, []
    sums, target = np.cumsum(counts), len(values) / bins
    for k in range(1, len(different)):
        if abs(sums[k - 1] - target) < abs(sums[k] - target):
            cuts.append(float((different[k - 1] + different[k]) / 2))
            target += stride
    return cuts


def _cuts(rows: DataFrame, vector: str, width: int, bins: int) -> list[list[float]]:
    """The cuts of each column, between ``QUANTILES`` of its values."""
    shares = F.lit([k / QUANTILES for k in range(QUANTILES + 1)]).cast("array<double>")
    cuts = []
    for at in range(0, width, 64):
        row = rows.agg(*[F.percentile_approx(F.nanvl(F.get(F.col(vector), F.lit(k)), F.lit(None).cast("double")), shares, F.lit(10_000)).alias(f"c{k}")
                         for k in range(at, min(width, at + 64))]).first()
        cuts += [cuts_between(row[f"c{k}"] or [], bins) for k in range(at, min(width, at + 64))]
    return cuts


def _in_bins(cuts: list):
    def encode(x: np.ndarray) -> np.ndarray:
        if np.isnan(x).any():
            raise ValueError("a random forest takes no NaN")
        return to_bins(x, cuts)
    return encode


def write_forest(rows: DataFrame, n_classes: int, params: ForestParams = ForestParams(), vector: str = "vector", label: str = "label",
                 key: str | None = None, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The forest as a table of parts in the shared folder (``operators/forest.py``)."""
    first = rows.select(F.size(vector)).first()
    width = first[0] if first else 0
    chosen = rows.select(F.col(vector).cast("array<double>").alias("x"), F.col(label).cast("int").alias("label"),
                         F.xxhash64(*([key] if key else []), vector).alias("draw"))
    cuts = _cuts(chosen, "x", width, params.bins)
    blocks, n_blocks, per_block = to_blocks(chosen, width, _in_bins(cuts), block_cells)
    return grow_forest(blocks, n_blocks, _Kind(params, width, n_classes, cuts), per_block)
