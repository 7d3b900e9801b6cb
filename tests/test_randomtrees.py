from __future__ import annotations

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint.operators import models as md
from inkprint.operators import randomtrees
from inkprint.operators.forest import forest_probability
from inkprint.operators.randomtrees import RandomTrees, TreeParams, fit_random_trees, grow_here, share, write_random_trees


def data(n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 9)), 3)
    x[:, 8] = 2.0
    return x, ((x[:, 0] > 0).astype(int) + (x[:, 1] > 0.4).astype(int))


def plain(x, y, number, params, classes, heap=0, depth=0):
    """The same tree by recursion over lists of rows: nested (feature, cut, left, right) or class counts."""
    counts = [int((y == c).sum()) for c in range(classes)]
    gini = lambda v: len(v) - sum(float((v == c).sum()) ** 2 for c in range(classes)) / len(v) if len(v) else 0.0
    vary = [f for f in range(x.shape[1]) if x[:, f].min() < x[:, f].max()]
    if depth == params.max_depth or len(y) < 2 or max(counts) == len(y) or not vary:
        return counts
    vary.sort(key=lambda f: (share(params.seed, number, heap, f, "order"), f))
    best = None
    for f in vary[:params.tried(x.shape[1])]:
        low, high = x[:, f].min(), x[:, f].max()
        cut = low + share(params.seed, number, heap, f) * (high - low)
        fall = gini(y) - gini(y[x[:, f] <= cut]) - gini(y[x[:, f] > cut])
        if best is None or round(fall, 9) > round(best[0], 9):
            best = (fall, f, cut)
    _, f, cut = best
    go = x[:, f] <= cut
    return (f, cut, plain(x[go], y[go], number, params, classes, 2 * heap + 1, depth + 1),
            plain(x[~go], y[~go], number, params, classes, 2 * heap + 2, depth + 1))


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return [int(v) for v in tree.counts[node]]
    return (tree.feature[node], tree.cut[node], nested(tree, tree.left[node]), nested(tree, tree.left[node] + 1))


@pytest.mark.parametrize("params", [TreeParams(), TreeParams(max_depth=3, max_features=5, seed=7)])
def test_equals_a_plain_version(params):
    x, y = data()
    for number in range(6):
        assert nested(grow_here(x, y, number, params, 3)) == plain(x, y, number, params, 3)


def frame(spark):
    x, y = data()
    return spark.createDataFrame([([float(v) for v in r], int(c)) for r, c in zip(x, y)], "vector array<double>, label int")


def test_blocks_and_partitions_grow_the_same_trees(spark):
    params = TreeParams(n_estimators=7, max_depth=6)
    one = fit_random_trees(frame(spark), 3, params)
    several = fit_random_trees(frame(spark).repartition(6), 3, params, block_cells=300)
    x, y = data()
    assert (one.probabilities(x) == several.probabilities(x)).all() and len(one.trees) == 7
    assert one.fall == pytest.approx(several.fall)
    again = RandomTrees.from_json(one.to_json())
    assert (again.probabilities(x) == one.probabilities(x)).all()


def test_odd_values(spark):
    df = spark.createDataFrame([([None, 1.0], 0), ([float("nan"), 1.0], 1), ([3.0, 1.0], 1), ([3.0, 1.0], 1)], "vector array<double>, label int")
    model = fit_random_trees(df, 2, TreeParams(n_estimators=3))
    assert model.probabilities(np.array([[3.0, 1.0], [np.nan, 1.0]])).tolist() == [[0, 1], [0.5, 0.5]]
    empty = fit_random_trees(df.limit(0), 2)
    assert empty.probabilities(np.zeros((1, 2))).tolist() == [[0.5, 0.5]]


def test_as_a_classifier(spark, tmp_path):
    x, y = data()
    rows = [(k, int(c), *map(float, r)) for k, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "message_id long, user int, " + ", ".join(f"f{k} double" for k in range(9)))
    model = md.fit_classifier(df.where("message_id < 150"), "extra_trees", n_classes=3)
    scored = model.predict(df.where("message_id >= 150"))
    assert scored.where(F.col("user") == F.col("prediction")).count() >= 38
    top = md.feature_importance(model).collect()
    assert {top[0]["feature"], top[1]["feature"]} == {"f0", "f1"}
    model.save(f"{tmp_path}/m")
    again = md.load_model(spark, f"{tmp_path}/m").predict(df).orderBy("message_id").select("probability").collect()
    assert again == model.predict(df).orderBy("message_id").select("probability").collect()


def test_a_tree_reaches_the_driver_as_arrays():
    rng = np.random.default_rng(3)
    x, label = rng.normal(size=(400, 6)), rng.integers(0, 10, 400)
    made = randomtrees._done(randomtrees.grow_here(x, label, 0, TreeParams(), 10))
    nodes = len(made["feature"])
    assert all(isinstance(made[k], np.ndarray) for k in ("feature", "cut", "left", "rows", "share"))
    assert nodes > 100 and len(pickle.dumps(made)) < 120 * nodes + 2000


def test_extra_trees_stay_in_their_table(spark):
    """Only nodes that do not fit a block are grown by passes; all the rest is never held by the driver."""
    rows, params = frame(spark).withColumn("id", F.monotonically_increasing_id()), TreeParams(n_estimators=5)
    held = fit_random_trees(rows, 3, params)
    parts = write_random_trees(rows, 3, params, block_cells=300)
    tops = [pickle.loads(r["nodes"]) for r in parts.filter("part = 0").collect()]
    assert len(tops) == 5 and parts.filter("part > 0").count() >= 10
    assert sum(len(t["feature"]) for t in tops) < sum(len(t["feature"]) for t in held.trees) / 2
    scored = forest_probability(parts, 5, rows.select("id", F.col("vector").alias("x")), 3, nan=0.0).join(rows, "id").collect()
    assert len(scored) == 200
    assert np.allclose([r["probability"] for r in scored], held.probabilities(np.array([r["vector"] for r in scored])), atol=1e-9)
