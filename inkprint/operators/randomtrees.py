"""Extremely randomised trees: one random cut for each (tree, node, feature), judged by the class counts on either side.

All rows are used. In a node the features are gone through in the order of a hash, the first ``max_features`` that vary in the node get
a cut between their smallest and largest value there, again by a hash, and the largest fall of the Gini impurity wins. No bins are
made. Hashes are of text, ``seed:tree:node:feature`` (nodes numbered as in a heap), so other programs can repeat them.

A level takes two passes over the rows: smallest and largest values, then counts.

* Several blocks of rows: a pass is one job for all trees; tasks sum their blocks, sums are added by tree, and only the chosen cuts and the
  counts of their sides reach the driver. Nodes whose rows fit a block are left to the tasks (``operators/forest.py``).
* One block (at most ``BLOCK_CELLS`` numbers): the trees are dealt over the tasks, each grown by the same code.

Minima, maxima and counts do not depend on an order, so the trees are the same for any partitioning and number of blocks. They stay in a table
(``write_random_trees``); ``fit_random_trees`` brings them to the driver, for small models.

Defined cases: null and NaN values count as 0; a node that is pure, has less than ``min_rows`` rows or no varying feature is a leaf; without rows
a model predicts equal shares; equal falls go to the feature that comes first in the node's order.
"""

from __future__ import annotations

import json
import pickle
from collections import defaultdict
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkprint.operators.forest import BLOCK_CELLS, DOOR, LEAF, Door, grow_forest, leaf_counts, packed, read_block, to_blocks


@dataclass(frozen=True)
class TreeParams:
    n_estimators: int = 100
    max_depth: int = 30
    min_rows: int = 2
    max_features: int = 0  # 0: the square root of their number
    seed: int = 0

    def tried(self, width: int) -> int:
        return self.max_features or max(1, int(np.sqrt(width)))


def share(seed: int, tree: int, node: int, feature: int, salt: str = "cut") -> float:
    """A number in [0, 1): the first 32 bits of a digest."""
    return int(md5(f"{salt}:{seed}:{tree}:{node}:{feature}".encode()).hexdigest()[:8], 16) / 4294967296.0


class Tree:
    """A tree, or what lies below its node ``heap``, that grows by levels. feature -1 is a leaf; left and left + 1 are the children.
    Children of at most ``limit`` rows are not grown here: they are leaves, or doors if they could be split."""

    def __init__(self, number: int, params: TreeParams, width: int, n_classes: int, heap: int = 0, depth: int = 0, limit: int = 0):
        self.number, self.params, self.width, self.n_classes, self.limit = number, params, width, n_classes, limit
        self.feature, self.cut, self.left, self.heap = [-1], [0.0], [-1], [heap]
        self.counts: list = [None]
        self.fall: dict[int, float] = {}
        self.open, self.depth = [0] if depth < params.max_depth else [], depth
        self.doors: list[Door] = []
        self.tried: list[list[tuple[int, float]]] = []

    def choose(self, low: np.ndarray, high: np.ndarray) -> None:
        """Cuts of the open nodes from the ranges [node, feature]."""
        p, self.tried = self.params, []
        for k, node in enumerate(self.open):
            heap = self.heap[node]
            vary = np.flatnonzero(low[k] < high[k])
            order = sorted(vary.tolist(), key=lambda f: (share(p.seed, self.number, heap, f, "order"), f))
            self.tried.append([(f, float(low[k, f] + share(p.seed, self.number, heap, f) * (high[k, f] - low[k, f])))
                               for f in order[:p.tried(self.width)]])

    def best(self, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The place of the best cut of each open node, -1 for a leaf, from the class counts left[node, tried feature, class]
        and total[node, class]."""
        tried, n = np.array([len(t) for t in self.tried]), total.sum(1)
        grows = (tried > 0) & (n >= self.params.min_rows) & (total.max(1, initial=0) < n)
        if not left.shape[1]:
            return np.full(len(self.open), -1, dtype=np.int64)
        fall = np.round(_impurity(total)[:, None] - _impurity(left) - _impurity(total[:, None] - left), 9)
        fall[np.arange(left.shape[1]) >= tried[:, None]] = -np.inf
        return np.where(grows, fall.argmax(1), -1)

    def split(self, chosen: np.ndarray, left: np.ndarray, total: np.ndarray) -> None:
        """The chosen cuts of the open nodes, with the class counts left[node, class] and total[node, class]."""
        after, falls = [], _fall(total, left).tolist()
        self.depth += 1
        for k, node in enumerate(self.open):
            self.counts[node] = total[k]
            if chosen[k] < 0:
                continue
            feature, cut = self.tried[k][chosen[k]]
            self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
            self.fall[feature] = self.fall.get(feature, 0.0) + falls[k]
            for side, counts in enumerate((left[k], total[k] - left[k])):
                child, heap, n = len(self.feature), 2 * self.heap[node] + 1 + side, int(counts.sum()) if self.limit else 1
                if n > self.limit:
                    after.append(child)
                elif self.depth < self.params.max_depth and n >= self.params.min_rows and counts.max() < n:
                    self.doors.append(Door(child, heap, self.depth, n))
                self.feature.append(-1)
                self.cut.append(0.0)
                self.left.append(-1)
                self.heap.append(heap)
                self.counts.append(counts)
        self.open = after if self.depth < self.params.max_depth else []

    def nodes(self) -> dict:
        """The nodes as a part of a forest."""
        counts = np.array([np.zeros(self.n_classes) if c is None else c for c in self.counts], dtype=np.int64).reshape(-1, self.n_classes)
        feature, left = np.array(self.feature), np.array(self.left)
        at = [d.node for d in self.doors]
        feature[at], left[at] = DOOR, np.arange(len(at)) + 1
        return packed(feature, self.cut, left, counts)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.cut), np.array(self.left)

    def slots(self) -> np.ndarray:
        slot = np.full(len(self.feature), -1, dtype=np.int64)
        slot[self.open] = np.arange(len(self.open))
        return slot


def _impurity(counts: np.ndarray) -> np.ndarray:
    """Rows times the Gini impurity, of counts[..., class]."""
    n = counts.sum(-1)
    return np.where(n > 0, n - (counts.astype(np.float64) ** 2).sum(-1) / np.maximum(n, 1), 0.0)


def _fall(total: np.ndarray, left: np.ndarray) -> np.ndarray:
    return _impurity(total) - _impurity(left) - _impurity(total - left)


def _of_chosen(left: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """left[node, class] of the chosen cuts; of leaves nothing is read."""
    return left[np.arange(len(left)), np.maximum(chosen, 0)] if left.shape[1] else np.zeros((len(left), left.shape[2]), dtype=left.dtype)


def _step(arrays, x: np.ndarray, node: np.ndarray) -> np.ndarray:
    feature, cut, left = arrays
    f = feature[node]
    right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
    return np.where(f >= 0, left[node] + right, node)


def ranges(x: np.ndarray, slot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest values [open node, feature]."""
    low, high = np.full((n, x.shape[1]), np.inf), np.full((n, x.shape[1]), -np.inf)
    rows = np.flatnonzero(slot >= 0)
    rows = rows[np.argsort(slot[rows], kind="stable")]
    if len(rows):
        first = np.flatnonzero(np.diff(slot[rows], prepend=-1))
        low[slot[rows[first]]] = np.minimum.reduceat(x[rows], first)
        high[slot[rows[first]]] = np.maximum.reduceat(x[rows], first)
    return low, high


def sides(x: np.ndarray, label: np.ndarray, slot: np.ndarray, tried: list, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class counts left of each tried cut [node, tried, class], and of the node [node, class]."""
    n, widest = len(tried), max((len(t) for t in tried), default=0)
    feature, cut = np.zeros((n, widest), dtype=np.int64), np.full((n, widest), -np.inf)
    for k, t in enumerate(tried):
        for j, (f, c) in enumerate(t):
            feature[k, j], cut[k, j] = f, c
    rows = np.flatnonzero(slot >= 0)
    s = slot[rows]
    is_left = x[rows[:, None], feature[s]] <= cut[s]
    at = ((s[:, None] * widest + np.arange(widest)) * n_classes + label[rows][:, None])[is_left]
    left = np.bincount(at, minlength=n * widest * n_classes).reshape(n, widest, n_classes)
    return left, np.bincount(s * n_classes + label[rows], minlength=n * n_classes).reshape(n, n_classes)


def grow_here(x: np.ndarray, label: np.ndarray, number: int, params: TreeParams, n_classes: int, heap: int = 0, depth: int = 0) -> Tree:
    """One tree on one block, or what lies below its node ``heap``."""
    tree, node = Tree(number, params, x.shape[1], n_classes, heap, depth), np.zeros(len(x), dtype=np.int64)
    while tree.open and len(x):
        slot = tree.slots()[node]
        tree.choose(*ranges(x, slot, len(tree.open)))
        left, total = sides(x, label, slot, tree.tried, n_classes)
        chosen = tree.best(left, total)
        tree.split(chosen, _of_chosen(left, chosen), total)
        node = _step(tree.arrays(), x, node)
    return tree


@dataclass
class RandomTrees:
    n_classes: int
    trees: list[dict]  # by node: feature, cut, left, share (of the classes), rows
    fall: dict[int, float]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
        out = np.zeros((len(x), self.n_classes))
        for t in self.trees:
            arrays, node = (t["feature"], t["cut"], t["left"]), np.zeros(len(x), dtype=np.int64)
            while True:
                after = _step(arrays, x, node)
                if (after == node).all():
                    break
                node = after
            out += t["share"][node]
        return out / len(self.trees) if self.trees else np.full((len(x), self.n_classes), 1 / self.n_classes)

    def to_json(self) -> str:
        return json.dumps({"n_classes": self.n_classes, "fall": {str(k): v for k, v in self.fall.items()},
                           "trees": [{k: v.tolist() for k, v in t.items()} for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> RandomTrees:
        d = json.loads(text)
        kinds = {"feature": np.int64, "cut": np.float64, "left": np.int64, "share": np.float64, "rows": np.int64}
        return cls(d["n_classes"], [{k: np.array(t[k], dtype=kind) for k, kind in kinds.items()} for t in d["trees"]],
                   {int(k): v for k, v in d["fall"].items()})


def _done(tree: Tree) -> dict:
    """A tree as arrays, which is all the driver holds of it: 32 bytes and 8 a class for each node."""
    counts = np.array([np.zeros(tree.n_classes) if c is None else c for c in tree.counts], dtype=np.float64)
    total = counts.sum(1, keepdims=True)
    return {**dict(zip(("feature", "cut", "left"), tree.arrays())), "rows": total[:, 0].astype(np.int64),
            "share": np.where(total > 0, counts / np.maximum(total, 1), 1 / tree.n_classes), "fall": tree.fall}


def _zeros_for_nan(x: np.ndarray) -> np.ndarray:
    x[np.isnan(x)] = 0.0
    return x


@dataclass(frozen=True)
class _Kind:
    """These trees for ``operators/forest.py``. Blocks hold values, every tree sees every row once."""

    params: TreeParams
    width: int
    n_classes: int
    cell = np.float64

    @property
    def number_of_trees(self) -> int:
        return self.params.n_estimators

    def weights(self, draw: np.ndarray, number: int) -> np.ndarray:
        return np.ones(len(draw), dtype=np.uint8)

    def grow(self, x, label, weight, number, heap, depth) -> tuple[dict, dict]:
        tree = grow_here(x, label, number, self.params, self.n_classes, heap, depth)
        return tree.nodes(), tree.fall

    def tops(self, blocks: DataFrame, limit: int) -> list[tuple[dict, dict, list[Door]]]:
        return [(t.nodes(), t.fall, t.doors) for t in _by_passes(blocks, self, limit)]

    def values(self, nodes: dict) -> dict:
        return nodes


def write_random_trees(rows: DataFrame, n_classes: int, params: TreeParams = TreeParams(), vector: str = "vector", label: str = "label",
                       block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The trees as a table of parts in the shared folder (``operators/forest.py``)."""
    first = rows.select(F.size(vector)).first()
    width = first[0] if first else 0
    chosen = rows.select(F.col(vector).cast("array<double>").alias("x"), F.col(label).cast("int").alias("label"), F.lit(0).cast("long").alias("draw"))
    blocks, n_blocks, per_block = to_blocks(chosen, width, _zeros_for_nan, block_cells)
    return grow_forest(blocks, n_blocks, _Kind(params, width, n_classes), per_block)


def fit_random_trees(rows: DataFrame, n_classes: int, params: TreeParams = TreeParams(), vector: str = "vector", label: str = "label",
                     block_cells: int = BLOCK_CELLS) -> RandomTrees:
    """The trees in the driver's memory."""
    parts: dict[int, dict[int, dict]] = defaultdict(dict)
    fall: dict[int, float] = {}
    for r in write_random_trees(rows, n_classes, params, vector, label, block_cells).orderBy("tree", "part").collect():
        parts[r["tree"]][r["part"]] = pickle.loads(r["nodes"])
        for f, v in json.loads(r["fall"]).items():
            fall[int(f)] = fall.get(int(f), 0.0) + v
    return RandomTrees(n_classes, [_whole(parts[k], n_classes) for k in sorted(parts)], dict(sorted(fall.items())))


def _whole(parts: dict[int, dict], n_classes: int) -> dict:
    """A tree out of its parts: each door becomes the first node of its part."""
    at = np.cumsum([0] + [len(parts[k]["feature"]) for k in sorted(parts)])
    feature, cut, left = (np.concatenate([parts[k][name] for k in sorted(parts)]) for name in ("feature", "cut", "left"))
    counts = np.concatenate([leaf_counts(parts[k], n_classes) for k in sorted(parts)])
    for k in sorted(parts):
        mine = slice(at[k], at[k + 1])
        left[mine] += np.where(feature[mine] >= 0, at[k], 0).astype(np.int32)
    for door in np.flatnonzero(feature == DOOR).tolist():
        root = at[left[door]]
        feature[door], cut[door], left[door], counts[door] = feature[root], cut[root], left[root], counts[root]
    for node in np.flatnonzero(feature >= 0)[::-1].tolist():  # children come after their node
        counts[node] = counts[left[node]] + counts[left[node] + 1]
    leaf, total = feature == LEAF, counts.sum(1, keepdims=True)
    return {"feature": feature.astype(np.int64), "cut": np.where(leaf, 0.0, cut), "left": np.where(leaf, -1, left).astype(np.int64), "rows": total[:, 0],
            "share": np.where(total > 0, counts / np.maximum(total, 1), 1 / n_classes)}


def _by_passes(blocks: DataFrame, kind: _Kind, limit: int) -> list[Tree]:
    """The trees down to nodes of ``limit`` rows."""
    width, n_classes = kind.width, kind.n_classes
    trees = [Tree(k, kind.params, width, n_classes, limit=limit) for k in range(kind.params.n_estimators)]
    context = blocks.sparkSession.sparkContext

    def summed(now, second: bool):
        def merge(a, b):
            return [x + y for x, y in zip(a, b)] if second else [np.minimum(a[0], b[0]), np.maximum(a[1], b[1])]

        def shapes(tree):
            n, widest = len(tree.open), max((len(t) for t in tree.tried), default=0)
            return [(n, widest, n_classes), (n, n_classes)] if second else [(n, width)] * 2

        def local(batches):
            total: dict[int, list] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    x, label, _ = read_block(row, kind)
                    for tree in now.value:
                        node, arrays = np.zeros(len(x), dtype=np.int64), tree.arrays()
                        for _ in range(tree.depth):
                            node = _step(arrays, x, node)
                        slot = tree.slots()[node]
                        mine = list(sides(x, label, slot, tree.tried, n_classes) if second else ranges(x, slot, len(tree.open)))
                        total[tree.number] = merge(total[tree.number], mine) if tree.number in total else mine
            yield from _rows(total)

        def reduce(batches):
            total: dict[int, list] = {}
            by = {tree.number: tree for tree in now.value}
            for batch in batches:
                for number, one, two in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    kind = np.int64 if second else np.float64
                    mine = [np.frombuffer(b, kind).reshape(s) for b, s in zip((one, two), shapes(by[number]))]
                    total[number] = merge(total[number], mine) if number in total else mine
            if not second:  # only the cuts go on
                for number, (low, high) in total.items():
                    by[number].choose(low, high)
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([json.dumps(by[number].tried).encode()], pa.binary()),
                                                      pa.array([b""], pa.binary())], ["tree", "one", "two"])
            else:
                for number, (left, counts) in total.items():  # only the chosen cuts and their sides go on
                    chosen = by[number].best(left, counts)
                    one = np.column_stack([chosen, _of_chosen(left, chosen)])
                    yield from _rows({number: (one, counts)})

        fields = "tree int, one binary, two binary"
        return blocks.mapInArrow(local, fields).repartition(max(1, min(len(now.value), int(
            blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "tree").mapInArrow(reduce, fields)

    while any(t.open for t in trees):
        alive = [t for t in trees if t.open]
        now = context.broadcast(alive)
        for r in summed(now, False).collect():
            trees[r["tree"]].tried = [[(f, c) for f, c in node] for node in json.loads(r["one"])]
        now.unpersist()
        now = context.broadcast(alive)
        for r in summed(now, True).collect():
            tree = trees[r["tree"]]
            total = np.frombuffer(r["two"], np.int64).reshape(len(tree.open), n_classes)
            one = np.frombuffer(r["one"], np.int64).reshape(len(tree.open), 1 + n_classes)
            tree.split(one[:, 0], one[:, 1:], total)
        now.unpersist()
    return trees


def _rows(total: dict):
    for number, (one, two) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([one.tobytes()], pa.binary()),
                                          pa.array([two.tobytes()], pa.binary())], ["tree", "one", "two"])


def trees_probability(model: RandomTrees, vector: Column | str) -> Column:
    """array<double> of class probabilities for a vector given as array<double>."""
    @F.pandas_udf("array<double>")
    def probability(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        x = np.array([[np.nan if v is None else v for v in row] for row in values], dtype=np.float64).reshape(len(values), -1)
        return pd.Series(list(model.probabilities(x)))
    return probability(vector)
