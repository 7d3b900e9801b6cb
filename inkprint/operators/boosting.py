"""Boosted trees by histograms, for one model or a crowd of them over the same rows.

One joint loss: softmax over the classes (logistic for two), one tree a class and round, second-order gains with L1 and L2
penalties. Feature values become bins once; the table is kept as blocks of rows, each a few arrays. All models of a crowd
(parameter sets, each with its held-out folds) read the same blocks, so one pass over them adds up the gradient sums of every model,
fold, class, open node, feature and bin, and the nodes of all of them are split in that pass. Models that have all their trees drop out.

* Several blocks: a pass is one job. Tasks sum their blocks, the sums are added by model and split there, and only the chosen
  splits reach the driver. Margins are kept beside the blocks, rewritten once a round, and cut off their lineage every
  ``CUT_EVERY`` rounds by a table in the shared folder.
* One block (at most ``BLOCK_CELLS`` cells): there is nothing to add up between blocks, so the passes of a model run in one
  task and the models are dealt over the tasks. The code of a pass is the same.

Gradients are rounded to multiples of 2^-24, so sums do not depend on their order: the same trees grow for any
partitioning, number of blocks or crowd. Draws of rows and columns are hashes of (round, row) and (round, column).

Defined cases: NaN and null values count as the smallest bin; a constant column is never split; without rows a model has no trees and
predicts equal shares; equal gains go to the first column, then the lowest cut.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkprint.session import materialize

BINS = 64
BLOCK_CELLS = 1 << 22
SPLIT_CELLS = 1 << 16
PAIR_CELLS = 1 << 15  # sums that a processor keeps close
CUT_EVERY = 10
FOLD_ROWS = 1 << 14
_UNIT = float(1 << 24)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_MIN_GAIN = 1e-9

# the customary names in Spark's trees
ALIASES = {"maxIter": "n_estimators", "maxDepth": "max_depth", "stepSize": "learning_rate", "subsamplingRate": "subsample",
           "minInstancesPerNode": "min_child_weight", "minInfoGain": "gamma"}


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    seed: int = 42

    @classmethod
    def of(cls, **params) -> BoostParams:
        named = {ALIASES.get(k, k): v for k, v in params.items()}
        known = {f.name: type(f.default) for f in fields(cls)}
        if set(named) - set(known):
            raise ValueError(f"unknown parameters: {sorted(set(named) - set(known))}")
        return cls(**{k: known[k](v) for k, v in named.items()})


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, _MIX[0]), (27, _MIX[1])):
        x ^= x >> np.uint64(shift)
        x *= factor
    return x ^ (x >> np.uint64(31))


def _draws(ids: np.ndarray, seed: int, turn: int, salt: int) -> np.ndarray:
    """A number in [0, 1) for each id, of its own for each turn."""
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xC2B2AE3D27D4EB4F + salt) & 0xFFFFFFFFFFFFFFFF)
    return (_mix(_mix(ids) ^ key) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


@dataclass
class Forest:
    """Trees of one round, one a column of the margins: node arrays; the roots come first. feature -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """One level down; node[row, column]."""
        inner = self.feature >= 0
        feature, cut = np.where(inner, self.feature, 0), np.where(inner, self.cut, BINS)  # a leaf has no bin above its cut
        left = np.where(inner, self.left, np.arange(len(inner)))
        at = feature.take(node) + (np.arange(len(bins)) * bins.shape[1])[:, None]
        return left.take(node) + (bins.ravel().take(at) > cut.take(node))


class Growing:
    """The trees of one model in the round it is at."""

    def __init__(self, params: BoostParams, columns: int):
        self.params, self.columns = params, columns
        self.feature, self.cut, self.left = ([-1] * columns, [0] * columns, [-1] * columns)
        self.sums: list = [None] * columns
        self.gain: dict[int, float] = {}
        self.open = list(range(columns))
        self.born: list[tuple[int, int]] = []  # place of a split node among those that were open, and its left child
        self.depth = 0

    def forest(self) -> Forest:
        p = self.params
        g, h = np.array([(0.0, 0.0) if s is None else s for s in self.sums], dtype=np.float64).reshape(-1, 2).T
        bent = h + p.reg_lambda
        value = np.where(bent > 0, -_soft(g, p.reg_alpha) / np.where(bent > 0, bent, 1.0) * p.learning_rate, 0.0)
        return Forest(np.array(self.feature, dtype=np.int64), np.array(self.cut, dtype=np.int64), np.array(self.left, dtype=np.int64), value)

    def slots(self) -> np.ndarray:
        """By node, its number among the open ones."""
        slot = np.full(len(self.feature), -1, dtype=np.int64)
        slot[self.open] = np.arange(len(self.open))
        return slot

    def split(self, found: list[tuple]) -> None:
        """One (gain, feature, cut, G and H on the left, G and H of the node) for each open node.

        A child with less than twice the least weight of a child has no split that is allowed: it is a leaf from the start.
        """
        after, self.born = [], []
        for place, (node, (gain, feature, cut, g_left, h_left, g, h)) in enumerate(zip(self.open, found)):
            self.sums[node] = (g, h)
            if feature < 0:
                continue
            self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
            self.gain[feature] = self.gain.get(feature, 0.0) + gain
            self.born.append((place, len(self.feature)))
            for sums in ((g_left, h_left), (g - g_left, h - h_left)):
                if sums[1] >= 2 * self.params.min_child_weight:
                    after.append(len(self.feature))
                self.feature.append(-1)
                self.cut.append(0)
                self.left.append(-1)
                self.sums.append(sums)
        self.depth += 1
        self.open = after if self.depth < self.params.max_depth else []


def _soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(hist: np.ndarray, params: BoostParams, chosen: np.ndarray) -> list[tuple]:
    """hist[2, node, feature, bin] of gradient sums and curvatures of the ``chosen`` features; some nodes at a time."""
    step = max(1, SPLIT_CELLS // max(1, hist.shape[2] * hist.shape[3]))
    return [found for at in range(0, hist.shape[1], step) for found in _best_of(hist[:, at:at + step], params, chosen)]


def _best_of(hist: np.ndarray, params: BoostParams, chosen: np.ndarray) -> list[tuple]:
    left = np.cumsum(hist, axis=3)
    total = left[:, :, :1, -1:]
    left = left[:, :, :, :-1]
    g, h, g_all, h_all = left[0], left[1], total[0], total[1]
    lam, alpha = params.reg_lambda, params.reg_alpha

    def worth(g, h):
        return _soft(g, alpha) ** 2 / np.maximum(h + lam, 1e-12)

    g_right, h_right = g_all - g, h_all - h
    gain = 0.5 * (worth(g, h) + worth(g_right, h_right) - worth(g_all, h_all)) - params.gamma
    gain[(np.minimum(h, h_right) < params.min_child_weight) | (np.minimum(h, h_right) <= 0)] = -np.inf
    nodes, _, cuts = gain.shape
    at = gain.reshape(nodes, -1).argmax(1)
    f, c = at // cuts, at % cuts
    k = np.arange(nodes)
    best = gain[k, f, c]
    good = best > _MIN_GAIN
    return list(zip(np.where(good, best, 0.0).tolist(), np.where(good, chosen[f], -1).tolist(), c.tolist(), g[k, f, c].tolist(),
                    h[k, f, c].tolist(), g_all[:, 0, 0].tolist(), h_all[:, 0, 0].tolist()))


@dataclass
class Spec:
    """One member of a crowd: parameters, and the folds each of which it is fitted without (-1: fitted on all rows)."""

    params: BoostParams
    folds: list[int] = field(default_factory=lambda: [-1])


class Block:
    """Some rows: bins[row, feature], label, fold and a hash of the row's key."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, fold: np.ndarray, draw: np.ndarray, n_classes: int):
        self.bins, self.label, self.fold, self.draw, self.n_classes = bins, label, fold, draw, n_classes
        self.trees = 1 if n_classes == 2 else n_classes
        self.bins_of = np.ascontiguousarray(bins.T)

    def zeros(self, spec: Spec) -> np.ndarray:
        return np.zeros((len(self.label), len(spec.folds) * self.trees))

    def gradients(self, margin: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
        """Rounded first and second derivatives, [row, fold x class]."""
        if self.n_classes == 2:
            p = 1 / (1 + np.exp(-margin))
            g, h = p - (self.label[:, None] == 1), p * (1 - p)
        else:
            m = margin.reshape(len(margin), len(spec.folds), self.trees)
            e = np.exp(m - m.max(2, keepdims=True))
            p = e / e.sum(2, keepdims=True)
            hit = self.label[:, None, None] == np.arange(self.trees)
            g, h = (p - hit).reshape(margin.shape), (2 * p * (1 - p)).reshape(margin.shape)
        return np.round(g * _UNIT) / _UNIT, np.round(np.maximum(h, 1e-6) * _UNIT) / _UNIT

    def used(self, spec: Spec, turn: int) -> np.ndarray:
        """Which rows each column of the margins learns from in this round."""
        mask = np.repeat(self.fold[:, None] != np.array(spec.folds), self.trees, axis=1)
        if spec.params.subsample < 1:
            mask &= (_draws(self.draw, spec.params.seed, turn, 1) < spec.params.subsample)[:, None]
        return mask

    def histogram(self, slot: np.ndarray, n_slots: int, g: np.ndarray, h: np.ndarray, chosen: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """[2, node, feature, bin]; slot[row, column] is the open node, -1 where the row is not in one. With ``rows`` of some (row, column)
        pairs, slot and gradients are those of the pairs."""
        met = np.flatnonzero(slot >= 0)
        rows = met // slot.shape[1] if rows is None else rows.take(met)
        slot, weights = slot.ravel().take(met), (g.ravel().take(met), h.ravel().take(met))
        out = np.empty((2, n_slots, len(chosen), BINS))
        pairs = len(chosen) // 2 if n_slots * BINS * BINS <= min(PAIR_CELLS, len(rows)) else 0
        base = slot * (BINS * BINS) if pairs else None
        for j in range(0, 2 * pairs, 2):  # few nodes: one count for two features
            one, two = (self.bins_of[f].take(rows) for f in chosen[j:j + 2])
            at = base + (one.astype(np.uint16) * np.uint16(BINS) + two)
            for k, x in enumerate(weights):
                both = np.bincount(at, x, n_slots * BINS * BINS).reshape(n_slots, BINS, BINS)
                out[k, :, j], out[k, :, j + 1] = both.sum(2), both.sum(1)
        base = slot * BINS
        for j, f in list(enumerate(chosen))[2 * pairs:]:
            at = base + self.bins_of[f].take(rows)
            for k, x in enumerate(weights):
                out[k, :, j] = np.bincount(at, x, n_slots * BINS).reshape(n_slots, BINS)
        return out

    def level(self, growing: Growing, node: np.ndarray, learns: Learns, chosen: np.ndarray, above: np.ndarray | None) -> np.ndarray:
        """The histogram of the open nodes. With that of the level ``above`` only the smaller child of a node is counted; its sibling
        is the rest of the node, exactly, as all sums are exact."""
        slots, node = growing.slots(), node.ravel().take(learns.at)

        if above is None:
            return self.histogram(slots.take(node), len(growing.open), learns.g, learns.h, chosen, learns.rows)
        place, left = np.array(growing.born, dtype=np.int64).T
        either = (slots[left] >= 0) | (slots[left + 1] >= 0)
        place, left = place[either], left[either]
        count = np.bincount(node, minlength=len(slots))
        small = left + (count[left + 1] < count[left])
        counted = np.full(len(slots), -1, dtype=np.int64)
        counted[small] = np.arange(len(small))
        part = self.histogram(counted.take(node), len(small), learns.g, learns.h, chosen, learns.rows)
        out = np.empty((2, len(growing.open), *part.shape[2:]))
        for at, child in ((slots[small], None), (slots[2 * left + 1 - small], place)):
            kept = np.flatnonzero(at >= 0)
            out[:, at[kept]] = part[:, kept] if child is None else above[:, child[kept]] - part[:, kept]
        return out


class Learns:
    """The (row, column) pairs that a round learns from, with their gradients."""

    def __init__(self, used: np.ndarray, g: np.ndarray, h: np.ndarray):
        self.at = np.flatnonzero(used)
        self.rows = self.at // used.shape[1]
        self.g, self.h = g.ravel().take(self.at), h.ravel().take(self.at)


def _columns(params: BoostParams, n: int, turn: int) -> np.ndarray:
    """The features a round may split, ascending."""
    take = max(1, int(np.ceil(params.colsample * n - 1e-9)))
    return np.arange(n) if take >= n else np.sort(np.argsort(_draws(np.arange(n), params.seed, turn, 2), kind="stable")[:take])


def _grow_here(block: Block, spec: Spec, keep: bool):
    """All rounds of one model on one block: (margins, rounds)."""
    margin, rounds = block.zeros(spec), []
    n = len(block.label)
    still = spec.params.subsample >= 1 and spec.params.colsample >= 1
    for turn in range(spec.params.n_estimators if n else 0):
        g, h = block.gradients(margin, spec)
        growing = Growing(spec.params, margin.shape[1])
        chosen = _columns(spec.params, block.bins.shape[1], turn)
        learns = Learns(block.used(spec, turn), g, h)
        node = np.tile(np.arange(margin.shape[1]), (n, 1))
        hist, forest = None, growing.forest()
        while growing.open:
            hist = block.level(growing, node, learns, chosen, hist)
            growing.split(best_splits(hist, spec.params, chosen))
            forest = growing.forest()
            node = forest.step(block.bins, node)
        margin += forest.value[node]
        if keep:
            rounds.append((forest, growing.gain))
        if still and not forest.value.any():
            break  # every later round would find the same
    return margin, rounds


def _hits(block: Block, margin: np.ndarray, spec: Spec) -> list[tuple[int, int]]:
    """(right, rows) of each fold's held-out rows."""
    m = margin.reshape(len(margin), len(spec.folds), block.trees)
    said = (m[:, :, 0] > 0).astype(np.int64) if block.n_classes == 2 else m.argmax(2)
    held = block.fold[:, None] == np.array(spec.folds)
    return [(int(((said[:, k] == block.label) & held[:, k]).sum()), int(held[:, k].sum())) for k in range(len(spec.folds))]


@dataclass
class Booster:
    """Fitted trees with cuts as values, for prediction."""

    n_classes: int
    rounds: list[Forest]  # cut = index into cuts of the feature
    cuts: list[list[float]]
    gain: dict[int, float]

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.cuts).astype(np.int64)
        out = np.zeros((len(x), 1 if self.n_classes == 2 else self.n_classes))
        for forest in self.rounds:
            node = np.tile(np.arange(out.shape[1]), (len(x), 1))
            while True:
                after = forest.step(bins, node)
                if (after == node).all():
                    break
                node = after
            out += forest.value[node]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        m = self.margins(x)
        if self.n_classes == 2:
            p = 1 / (1 + np.exp(-m[:, 0]))
            return np.stack([1 - p, p], axis=1)
        e = np.exp(m - m.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def to_json(self) -> str:
        return json.dumps({"n_classes": self.n_classes, "cuts": self.cuts, "gain": {str(k): v for k, v in self.gain.items()}, "rounds": [
            {k: v.tolist() for k, v in asdict(f).items()} for f in self.rounds]})

    @classmethod
    def from_json(cls, text: str) -> Booster:
        d = json.loads(text)
        rounds = [Forest(*(np.array(r[k], dtype=np.float64 if k == "value" else np.int64) for k in ("feature", "cut", "left", "value")))
                  for r in d["rounds"]]
        return cls(d["n_classes"], rounds, d["cuts"], {int(k): v for k, v in d["gain"].items()})


def to_bins(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """The number of cuts below each value."""
    out = np.zeros(x.shape, dtype=np.uint8)
    for k, c in enumerate(cuts):
        out[:, k] = np.where(np.isnan(x[:, k]), 0, np.searchsorted(c, x[:, k], side="left"))
    return out


def _cuts(rows: DataFrame, vector: str, width: int) -> list[list[float]]:
    """Up to BINS - 1 quantiles of each column; between a cut and the next lies a bin."""
    shares = [k / BINS for k in range(1, BINS)]
    cuts = []
    for at in range(0, width, 64):
        asked = [F.percentile_approx(F.nanvl(F.get(F.col(vector), F.lit(k)), F.lit(None).cast("double")), F.lit(shares).cast("array<double>"), F.lit(10_000))
                 .alias(f"c{k}") for k in range(at, min(width, at + 64))]
        asked += [F.max(F.nanvl(F.get(F.col(vector), F.lit(k)), F.lit(None).cast("double"))).alias(f"m{k}") for k in range(at, min(width, at + 64))]
        row = rows.agg(*asked).first()
        for k in range(at, min(width, at + 64)):
            cuts.append(sorted({float(v) for v in row[f"c{k}"] or [] if v < row[f"m{k}"]}))
    return cuts


_BLOCK = "bins binary, label binary, fold binary, draw binary"


def _to_blocks(cuts: list[list[float]], rows_of_block: int):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= rows_of_block:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    def pack(batches):
        rows = pa.Table.from_batches(batches)
        x = np.array(rows.column("vector").to_pylist(), dtype=np.float64).reshape(rows.num_rows, -1)
        made = [to_bins(x, cuts).tobytes(), rows.column("label").to_numpy().astype(np.int32).tobytes(),
                rows.column("fold").to_numpy().astype(np.int32).tobytes(), rows.column("draw").to_numpy().astype(np.int64).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], ["bins", "label", "fold", "draw"])
    return run


def _block(row: dict, width: int, n_classes: int) -> Block:
    label, fold = (np.frombuffer(row[c], np.int32) for c in ("label", "fold"))
    return Block(np.frombuffer(row["bins"], np.uint8).reshape(len(label), width), label, fold,
                 np.frombuffer(row["draw"], np.int64).view(np.uint64), n_classes)


class Table:
    """Binned rows, written once as blocks, for any number of crowds."""

    def __init__(self, df: DataFrame, vector: str, label: str, key: str, n_classes: int, fold: str | None = None,
                 block_cells: int = BLOCK_CELLS):
        rows = df.select(F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("int").alias("label"),
                         (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"), F.xxhash64(key).alias("draw"))
        first = rows.select(F.size("vector")).first()
        self.spark, self.n_classes, self.width = df.sparkSession, n_classes, first[0] if first else 0
        self.cuts = _cuts(rows, "vector", self.width)
        per_block = max(1, block_cells // max(1, self.width))
        self.n_rows = n = rows.count()
        wanted = max(1, -(-n // per_block))
        if wanted > 1:  # passes are jobs anyway: every core gets a block
            wanted = min(n, max(wanted, self.spark.sparkContext.defaultParallelism))
        # rows of a block are dealt by hash: blocks of equal size, whatever the order of the table
        dealt = rows.repartition(wanted, "draw") if wanted > 1 else rows.coalesce(1)
        self.blocks = materialize(dealt.mapInArrow(_to_blocks(self.cuts, 2 * per_block), _BLOCK), "blocks")
        self.n_blocks = self.blocks.count()

    def fit(self, specs: list[Spec], keep: bool = True) -> list[tuple[list[Booster], list[tuple[int, int]]]]:
        """For each spec, a booster for each of its folds (if ``keep``), and (right, rows) of each fold's held-out rows."""
        found = self._fit_in_tasks(specs, keep) if self.n_blocks <= 1 else self._fit_by_passes(specs, keep)
        trees = 1 if self.n_classes == 2 else self.n_classes
        out = []
        for spec, (rounds, hits) in zip(specs, found):
            boosters = [_booster_of(rounds, k, trees, self) for k in range(len(spec.folds))] if keep else []
            out.append((boosters, hits))
        return out

    def _fit_in_tasks(self, specs: list[Spec], keep: bool):
        width, n_classes = self.width, self.n_classes
        if not self.n_blocks:
            return [([], [(0, 0)] * len(s.folds)) for s in specs]
        # where only the hits are asked for, the folds of a model, which have nothing in common, are dealt one by one; on few rows they are
        # cheaper together
        apart = not keep and self.n_rows >= FOLD_ROWS
        fits = [(k, Spec(s.params, [f])) for k, s in enumerate(specs) for f in s.folds] if apart else list(enumerate(specs))
        fits.sort(key=lambda fit: -fit[1].params.n_estimators * fit[1].params.max_depth)
        tasks = min(len(fits), max(1, self.spark.sparkContext.defaultParallelism))
        shared = self.spark.sparkContext.broadcast(fits)

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    block = _block(row, width, n_classes)
                    for k, spec in shared.value[row["task"]::tasks]:
                        margin, rounds = _grow_here(block, spec, keep)
                        made = [(asdict(f), gain) for f, gain in rounds]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([k], pa.int32()), pa.array([spec.folds[0] if len(spec.folds) == 1 else -1], pa.int32()),
                            pa.array([_dump(made)], pa.binary()), pa.array([json.dumps(_hits(block, margin, spec))])],
                            ["spec", "fold", "rounds", "hits"])

        copies = self.blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))  # of the one block
        rows = copies.repartitionByRange(tasks, "task").mapInArrow(run, "spec int, fold int, rounds binary, hits string").collect()
        if apart:
            of = {(r["spec"], r["fold"]): tuple(json.loads(r["hits"])[0]) for r in rows}
            return [([], [of[k, f] for f in s.folds]) for k, s in enumerate(specs)]
        out: list = [None] * len(specs)
        for r in rows:
            out[r["spec"]] = ([(Forest(**f), gain) for f, gain in _load(r["rounds"])], [tuple(x) for x in json.loads(r["hits"])])
        return out

    def _fit_by_passes(self, specs: list[Spec], keep: bool):
        width, n_classes = self.width, self.n_classes
        trees = 1 if n_classes == 2 else n_classes
        context = self.spark.sparkContext
        kept: list[list] = [[] for _ in specs]
        state = self.blocks.withColumn("margins", F.lit(None).cast("binary"))
        held, past = None, None  # the margins that are kept in memory, and those that the next pass replaces
        for turn in range(max(s.params.n_estimators for s in specs)):
            alive = [k for k, s in enumerate(specs) if turn < s.params.n_estimators]
            growing = {k: Growing(specs[k].params, len(specs[k].folds) * trees) for k in alive}
            while any(g.open for g in growing.values()):
                now = context.broadcast((specs, {k: g for k, g in growing.items() if g.open}, turn))
                sums = state.mapInArrow(_pass(now, width, n_classes), "spec int, hist binary")
                found = sums.repartition(max(1, min(len(now.value[1]), int(self.spark.conf.get("spark.sql.shuffle.partitions")))), "spec") \
                    .mapInArrow(_split_sums(now, width), "spec int, splits string").collect()
                for r in found:
                    growing[r["spec"]].split([tuple(x) for x in json.loads(r["splits"])])
                now.unpersist()
                if past is not None:  # the pass has read all blocks of the state, so the one before it is not needed
                    past.unpersist()
                    past = None
            forests = {k: g.forest() for k, g in growing.items()}
            if keep:
                for k, f in forests.items():
                    kept[k].append((f, growing[k].gain))
            after = state.mapInArrow(_advance(context.broadcast((specs, forests)), width, n_classes), f"{_BLOCK}, margins binary")
            if past is not None:
                past.unpersist()
            if turn % CUT_EVERY == CUT_EVERY - 1:
                state, past, held = materialize(after, "margins"), held, None
            else:  # filled by the first pass of the next round
                state = after.persist()
                past, held = held, state
        counts = state.mapInArrow(_count_hits(context.broadcast(specs), width, n_classes), "spec int, fold int, hits long, n long") \
            .groupBy("spec", "fold").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
        for frame in (past, held):
            if frame is not None:
                frame.unpersist()
        of = {(r["spec"], r["fold"]): (r["hits"], r["n"]) for r in counts}
        return [(kept[k], [of.get((k, f), (0, 0)) for f in range(len(s.folds))]) for k, s in enumerate(specs)]


def _dump(rounds) -> bytes:
    import pickle
    return pickle.dumps(rounds)


def _load(data: bytes):
    import pickle
    return pickle.loads(data)


def _margins(row: dict, block: Block, specs: list[Spec]) -> list[np.ndarray]:
    """The margins of all models, one after another in the row."""
    sizes = [len(s.folds) * block.trees for s in specs]
    if row["margins"] is None:
        return [np.zeros((len(block.label), k)) for k in sizes]
    flat, out, at = np.frombuffer(row["margins"], np.float64), [], 0
    for k in sizes:
        out.append(flat[at:at + k * len(block.label)].reshape(len(block.label), k))
        at += k * len(block.label)
    return out


def _pass(shared, width: int, n_classes: int):
    """The gradient sums of the open nodes of every model, one row a model and task."""
    def run(batches):
        specs, growing, turn = shared.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(row, width, n_classes)
                margins = _margins(row, block, specs)
                for k, grown in growing.items():
                    spec, forest = specs[k], grown.forest()
                    g, h = block.gradients(margins[k], spec)
                    node = np.tile(np.arange(margins[k].shape[1]), (len(block.label), 1))
                    for _ in range(grown.depth):
                        node = forest.step(block.bins, node)
                    slot = np.where(block.used(spec, turn), grown.slots()[node], -1)
                    hist = block.histogram(slot, len(grown.open), g, h, _columns(spec.params, width, turn))
                    total[k] = total[k] + hist if k in total else hist
        for k, hist in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([hist.tobytes()], pa.binary())], ["spec", "hist"])
    return run


def _split_sums(shared, width: int):
    def run(batches):
        specs, growing, turn = shared.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, hist in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(hist, np.float64)
                total[k] = total[k] + x if k in total else x
        for k, hist in total.items():
            chosen = _columns(specs[k].params, width, turn)
            splits = best_splits(hist.reshape(2, len(growing[k].open), len(chosen), BINS), specs[k].params, chosen)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([json.dumps(splits)])], ["spec", "splits"])
    return run


def _advance(shared, width: int, n_classes: int):
    """The blocks with the margins after this round."""
    def run(batches):
        specs, forests = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(row, width, n_classes)
                margins = _margins(row, block, specs)
                for k, forest in forests.items():
                    node = np.tile(np.arange(margins[k].shape[1]), (len(block.label), 1))
                    for _ in range(specs[k].params.max_depth):
                        node = forest.step(block.bins, node)
                    margins[k] = margins[k] + forest.value[node]
                row["margins"] = b"".join(m.tobytes() for m in margins)
                yield pa.RecordBatch.from_arrays([pa.array([row[c]], pa.binary()) for c in ("bins", "label", "fold", "draw", "margins")],
                                                 ["bins", "label", "fold", "draw", "margins"])
    return run


def _count_hits(shared, width: int, n_classes: int):
    def run(batches):
        specs = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(row, width, n_classes)
                rows = [(k, f, hits, n) for k, (spec, m) in enumerate(zip(specs, _margins(row, block, specs)))
                        for f, (hits, n) in enumerate(_hits(block, m, spec))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                                 ["spec", "fold", "hits", "n"])
    return run


def _booster_of(rounds, fold: int, trees: int, table: Table) -> Booster:
    """The trees of one fold out of those of all folds of a model."""
    picked, gain = [], {}
    for forest, gains in rounds:
        roots = list(range(fold * trees, (fold + 1) * trees))
        place = {node: k for k, node in enumerate(roots)}
        for node in roots:  # grows while it is read
            if forest.feature[node] >= 0:
                for child in (int(forest.left[node]), int(forest.left[node]) + 1):
                    place[child] = len(roots)
                    roots.append(child)
        left = [place[int(forest.left[n])] if forest.feature[n] >= 0 else -1 for n in roots]
        picked.append(Forest(forest.feature[roots], forest.cut[roots], np.array(left, dtype=np.int64), forest.value[roots]))
        for f, v in gains.items():  # of all folds together; what matters is the share
            gain[f] = gain.get(f, 0.0) + v
    return Booster(table.n_classes, picked, table.cuts, gain)


def boosted_probability(booster: Booster, vector: Column | str) -> Column:
    """array<double> of class probabilities for a vector given as array<double>."""
    @F.pandas_udf("array<double>")
    def probability(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=object)
        x = np.array([[np.nan if v is None else v for v in row] for row in values], dtype=np.float64).reshape(len(values), -1)
        return pd.Series(list(booster.probabilities(x)))
    return probability(vector)
