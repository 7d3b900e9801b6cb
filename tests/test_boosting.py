from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint.operators import boosting as bo
from inkprint.operators import models as md
from inkprint.operators.boosting import BINS, Block, Booster, BoostParams, Spec, Table, _grow_here, best_splits, to_bins


def data(n=300, classes=2, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    x[:, 5] = 1.0
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int) + (x[:, 3] > 0.5).astype(int)) % classes
    return x, y


def block(x, y, classes=2, folds=3):
    cuts = [sorted(set(np.quantile(x[:, k], np.arange(1, BINS) / BINS)) - {x[:, k].max()}) for k in range(x.shape[1])]
    ids = np.arange(len(y), dtype=np.uint64)
    return Block(to_bins(x, cuts), y.astype(np.int32), (ids % np.uint64(folds)).astype(np.int32), ids, classes)


@pytest.mark.parametrize("alpha, lam", [(0.0, 1.0), (0.0, 7.5), (3.0, 1.0), (5.0, 10.0), (100.0, 0.1)])
def test_penalties_change_a_leaf_as_computed_by_hand(alpha, lam):
    """One split of 50 rows; first gradients are 0.5 - y, curvatures 0.25."""
    x = np.array([[0.0]] * 20 + [[1.0]] * 30)
    y = np.array([0] * 18 + [1] * 2 + [1] * 24 + [0] * 6)
    rows = Block(to_bins(x, [[0.5]]), y.astype(np.int32), np.zeros(50, np.int32), np.arange(50, dtype=np.uint64), 2)
    _, rounds = _grow_here(rows, Spec(BoostParams(n_estimators=1, max_depth=1, learning_rate=1.0, reg_alpha=alpha, reg_lambda=lam)), True)

    def leaf(g, h):
        return -np.sign(g) * max(abs(g) - alpha, 0) / (h + lam)

    left, right = leaf(18 * 0.5 - 2 * 0.5, 5.0), leaf(6 * 0.5 - 24 * 0.5, 7.5)
    forest = rounds[0][0]
    if alpha < 8:
        assert forest.feature.tolist() == [0, -1, -1] and forest.value[1:].tolist() == pytest.approx([left, right])
    else:
        assert forest.feature.tolist() == [-1] and forest.value.tolist() == [0.0]


def test_best_split_equals_trying_all():
    rng = np.random.default_rng(2)
    g, h = np.round(rng.normal(size=200) * 64) / 64, np.round(rng.random(200) * 64) / 64
    bins = rng.integers(0, 9, (200, 4)).astype(np.uint8)
    rows = Block(bins, np.zeros(200, np.int32), np.zeros(200, np.int32), np.zeros(200, np.uint64), 2)
    for params in (BoostParams(), BoostParams(gamma=0.4, reg_alpha=1.5, reg_lambda=3.0, min_child_weight=20)):
        hist = rows.histogram(np.zeros((200, 1), np.int64), 1, g[:, None], h[:, None], np.arange(4))
        (gain, feature, cut, *_), = best_splits(hist, params, np.arange(4))

        def worth(m):
            return max(abs(g[m].sum()) - params.reg_alpha, 0) ** 2 / (h[m].sum() + params.reg_lambda)

        tried = [(0.5 * (worth(bins[:, f] <= c) + worth(bins[:, f] > c) - worth(bins[:, f] >= 0)) - params.gamma, -f, -c)
                 for f in range(4) for c in range(8)
                 if min(h[bins[:, f] <= c].sum(), h[bins[:, f] > c].sum()) >= params.min_child_weight]
        want = max(tried)
        assert gain == pytest.approx(want[0]) and (feature, cut) == (-want[1], -want[2])


CROWD = [Spec(BoostParams(12, 3, 0.3), [0, 1, 2]), Spec(BoostParams(5, 6, 0.1, 0.7, 0.6, 2.0, 0.05, 0.5, 2.0), [0, 1, 2]), Spec(BoostParams(8, 2))]


def table(spark, classes=2, **kwargs):
    x, y = data(classes=classes)
    rows = [(k, [float(v) for v in r], int(c), k % 3) for k, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "message_id long, v array<double>, user int, fold int").repartition(5)
    return Table(df, "v", "user", "message_id", classes, "fold", **kwargs)


@pytest.mark.parametrize("classes", [2, 3])
def test_crowd_alone_and_blocks_grow_the_same_trees(spark, classes):
    one = table(spark, classes)
    together = one.fit(CROWD)
    assert one.n_blocks == 1
    for spec, (boosters, hits) in zip(CROWD, together):
        (alone, alone_hits), = one.fit([spec])
        assert [b.to_json() for b in alone] == [b.to_json() for b in boosters] and alone_hits == hits
    several = table(spark, classes, block_cells=400)
    assert several.n_blocks > 2 and several.cuts == one.cuts
    for (boosters, hits), (others, other_hits) in zip(together, several.fit(CROWD)):
        assert hits == other_hits
        x = np.array(data(classes=classes)[0])
        for a, b in zip(boosters, others):
            assert a.margins(x).tolist() == b.margins(x).tolist()


def test_a_fold_is_a_fit_without_its_rows(spark):
    x, y = data()
    rows = block(x, y)
    spec = Spec(BoostParams(6, 3, 0.3), [1])
    margin, _ = _grow_here(rows, spec, True)
    changed = np.where(rows.fold == 1, 1 - rows.label, rows.label).astype(np.int32)
    again, _ = _grow_here(Block(rows.bins, changed, rows.fold, rows.draw, 2), spec, True)
    assert (margin == again).all()  # the labels of the held-out rows have no effect


def test_joint_loss_of_three_classes():
    x, y = data(classes=3)
    rows = block(x, y, 3)
    margin, rounds = _grow_here(rows, Spec(BoostParams(40, 3, 0.3)), True)
    assert (margin.argmax(1) == y).mean() > 0.95
    g, h = rows.gradients(np.zeros((len(y), 3)), Spec(BoostParams()))
    assert g.sum(1) == pytest.approx(0, abs=1e-6) and h[0] == pytest.approx([4 / 9] * 3, abs=1e-6)
    eps = 1e-5
    m = np.random.default_rng(1).normal(size=(len(y), 3))

    def loss(m):
        e = np.exp(m)
        return -np.log(e[np.arange(len(y)), y] / e.sum(1))

    for c in range(3):
        step = np.zeros(3)
        step[c] = eps
        assert rows.gradients(m, Spec(BoostParams()))[0][:, c] == pytest.approx((loss(m + step) - loss(m - step)) / (2 * eps), abs=1e-4)


def test_odd_values(spark):
    rows = [(k, [float("nan") if k % 7 == 0 else None if k % 5 == 0 else float(k % 4), 3.0], k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "message_id long, v array<double>, user int")
    boosters, _ = Table(df, "v", "user", "message_id", 2).fit([Spec(BoostParams(3))])[0]
    scored = df.withColumn("p", bo.boosted_probability(boosters[0], F.col("v"))).collect()
    assert len(scored) == 60 and all(abs(sum(r["p"]) - 1) < 1e-9 for r in scored)
    again = Booster.from_json(boosters[0].to_json())
    assert again.margins(np.array([[1.0, 3.0]])).tolist() == boosters[0].margins(np.array([[1.0, 3.0]])).tolist()
    empty, hits = Table(df.limit(0), "v", "user", "message_id", 2).fit([Spec(BoostParams(3), [0])])[0]
    assert hits == [(0, 0)] and empty[0].rounds == []
    with pytest.raises(ValueError):
        BoostParams.of(depth=3)


def test_importance_names_the_inputs(spark):
    x, y = data()
    rows = [(k, int(c), *map(float, r)) for k, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "message_id long, user int, a double, b double, c double, d double, e double, same double")
    top = md.feature_importance(md.fit_classifier(df, "gradient_boosting", n_estimators=20)).collect()
    assert {r["feature"] for r in top[:4]} == {"a", "b", "c", "d"} and sum(r["importance"] for r in top) == pytest.approx(1)


def test_a_level_counts_only_smaller_children(monkeypatch):
    x, y = data(600)
    rows = block(x, y)
    counted, slots, whole = [], [], Block.histogram

    def histogram(self, slot, n_slots, *args):
        counted.append(int((slot >= 0).sum()))
        slots.append(n_slots)
        return whole(self, slot, n_slots, *args)

    monkeypatch.setattr(Block, "histogram", histogram)
    _, rounds = _grow_here(rows, Spec(BoostParams(1, 5, min_child_weight=4.0)), True)
    assert len(counted) > 3 and counted[0] == 600 and all(n <= 300 for n in counted[1:])
    forest = rounds[0][0]
    inner = (forest.feature >= 0).sum()
    assert sum(slots) <= inner  # a child that is too light for two children is never counted for itself


def test_passes_give_every_core_a_block(spark):
    several = table(spark, block_cells=1000)
    assert several.n_blocks >= spark.sparkContext.defaultParallelism > 1800 / 1000


def test_folds_of_larger_tables_are_dealt_one_by_one(spark, monkeypatch):
    """With the hits alone asked for, a model's folds are fits of their own, so the largest model of a crowd holds nobody up."""
    whole = [hits for _, hits in table(spark).fit(CROWD, keep=False)]

    monkeypatch.setattr(bo, "FOLD_ROWS", 1)
    fits, dealt = [], bo.Table._fit_in_tasks

    def seen(self, specs, keep):
        shared, real_broadcast = [], self.spark.sparkContext.broadcast
        monkeypatch.setattr(self.spark.sparkContext, "broadcast", lambda x: shared.append(x) or real_broadcast(x))
        out = dealt(self, specs, keep)
        fits.extend(shared[0])
        return out

    monkeypatch.setattr(bo.Table, "_fit_in_tasks", seen)
    assert [hits for _, hits in table(spark).fit(CROWD, keep=False)] == whole
    assert len(fits) == sum(len(s.folds) for s in CROWD) and all(len(s.folds) == 1 for _, s in fits)
