from __future__ import annotations

import json
import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint.operators import models as md
from inkprint.operators import randomforest as rf
from inkprint.operators.forest import LEAF, forest_probability, packed, walk
from inkprint.operators.randomforest import ForestParams, cuts_between, grow_bins, tried_features, write_forest


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 9)), 2)
    x[:, 8] = 2.0
    return x, (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.4).astype(int)


def frame(spark, n=400):
    x, y = data(n)
    return spark.createDataFrame([(k, [float(v) for v in r], int(c)) for k, (r, c) in enumerate(zip(x, y))], "id long, vector array<double>, label int")


def probabilities(parts, n_trees, rows, **args):
    found = forest_probability(parts, n_trees, rows.select("id", F.col("vector").alias("x")), 3, **args)
    return {r["id"]: r["probability"] for r in found.collect()}


def plain(x, y, w, number, p, classes, bins, heap=0, depth=0):
    """The same tree by recursion over lists of rows: nested (feature, bin, left, right) or class counts."""
    counts = [int(w[y == c].sum()) for c in range(classes)]
    square = lambda m: sum(float(w[m & (y == c)].sum()) ** 2 for c in range(classes)) / max(1, w[m].sum())
    best = None
    if depth < p.max_depth and max(counts) < sum(counts):
        for f in tried_features(p, number, np.array([heap], dtype=np.uint64), x.shape[1])[0]:
            for b in range(bins):
                go = x[:, f] <= b
                if w[go].sum() >= max(1, p.min_rows) and w[~go].sum() >= max(1, p.min_rows):
                    worth = square(go) + square(~go)
                    if best is None or worth > best[0] + 1e-12:
                        best = worth, f, b, go
    if best is None or best[0] - square(np.ones(len(y), dtype=bool)) <= 1e-9:
        return counts
    _, f, b, go = best
    return (int(f), b, plain(x[go], y[go], w[go], number, p, classes, bins, 2 * heap + 1, depth + 1),
            plain(x[~go], y[~go], w[~go], number, p, classes, bins, 2 * heap + 2, depth + 1))


def nested(feature, cut, left, counts, node=0):
    if feature[node] < 0:
        return [int(v) for v in counts[node]]
    return (int(feature[node]), int(cut[node]), *(nested(feature, cut, left, counts, left[node] + k) for k in range(2)))


@pytest.mark.parametrize("params", [ForestParams(), ForestParams(max_depth=3, min_rows=4, seed=7)])
def test_equals_a_plain_version(params, monkeypatch):
    rng = np.random.default_rng(1)
    x, y, w = rng.integers(0, 8, (150, 9)).astype(np.uint8), rng.integers(0, 3, 150), rng.poisson(1, 150)
    for number in range(4):
        expected = plain(x, y, w, number, params, 3, 8)
        assert nested(*grow_bins(x, y, w, number, 0, 0, params, 3, 8)[:4]) == expected
        monkeypatch.setattr(rf, "LEVEL_CELLS", 40)  # some nodes at a time
        assert nested(*grow_bins(x, y, w, number, 0, 0, params, 3, 8)[:4]) == expected
        monkeypatch.undo()


def test_any_number_of_blocks_and_groups_gives_the_same_forest(spark):
    rows, params = frame(spark), ForestParams(n_estimators=7, seed=5)
    one = write_forest(rows, 3, params, key="id")
    several = write_forest(rows.repartition(5), 3, params, key="id", block_cells=450)
    assert {r["part"] for r in one.select("part").collect()} == {0}
    assert several.filter("part > 0").count() >= 7  # what lies below the tops was grown by tasks
    expected = probabilities(one, 7, rows)
    assert expected == probabilities(several, 7, rows) == probabilities(several, 7, rows.repartition(3), group_cells=900)
    assert len(expected) == 400 and all(abs(sum(p) - 1) < 1e-9 for p in expected.values())
    x, y = data()
    assert np.mean([np.argmax(expected[k]) == y[k] for k in range(400)]) > 0.95


def test_a_large_forest_is_a_table(spark, tmp_path, monkeypatch):
    x, y = data(600)
    rows = [(k, int(c), *map(float, r)) for k, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "message_id long, user int, " + ", ".join(f"f{k} double" for k in range(9)))
    train, test = df.where("message_id < 400"), df.where("message_id >= 400")
    small = md.fit_classifier(train, "random_forest", n_classes=3, numTrees=20)
    monkeypatch.setattr(md, "DRIVER_ROWS", 1000)
    model = md.fit_classifier(train, "random_forest", n_classes=3, numTrees=20)
    assert isinstance(small, md.Fitted) and isinstance(model, md.FittedForest)
    right = [m.predict(test).where("user = prediction").count() for m in (small, model)]
    assert right[1] >= right[0] - 6 and right[1] > 180
    weights = [{r["feature"]: r["importance"] for r in md.feature_importance(m).collect()} for m in (small, model)]
    assert max(abs(weights[0].get(f, 0.0) - weights[1].get(f, 0.0)) for f in {*weights[0], *weights[1]}) < 0.1
    model.save(f"{tmp_path}/m")
    again = md.load_model(spark, f"{tmp_path}/m").predict(df).orderBy("message_id").select("probability").collect()
    assert again == model.predict(df).orderBy("message_id").select("probability").collect()
    assert isinstance(md.fit_classifier(train, "random_forest", n_classes=3, numTrees=20, impurity="entropy"), md.Fitted)


def test_odd_tables(spark):
    same = spark.createDataFrame([(None, [1.0, 2.0, 3.0], 0), (None, [1.0, 2.0, 3.0], 1)], "id long, vector array<double>, label int")
    parts = write_forest(same, 2, ForestParams(n_estimators=3), key="id")
    assert parts.count() == 3 and all((pickle.loads(r["nodes"])["feature"] == LEAF).all() for r in parts.collect())
    empty = write_forest(same.limit(0), 2, ForestParams(n_estimators=3))
    assert empty.count() == 0
    rows = same.select(F.lit(1).alias("id"), F.col("vector").alias("x")).limit(1)
    assert forest_probability(empty, 0, rows, 2).first()["probability"] == [0.5, 0.5]
    with pytest.raises(Exception, match="must not be null"):
        write_forest(same.withColumn("label", F.nullif("label", F.lit(1))), 2, ForestParams(n_estimators=3))
    with pytest.raises(Exception, match="takes no NaN"):
        write_forest(same.withColumn("vector", F.array(F.lit(float("nan")), F.lit(1.0), F.lit(1.0))), 2, ForestParams(n_estimators=3))


def test_cuts_and_weights():
    assert cuts_between([], 4) == [] and cuts_between([1.0, 1.0], 4) == [] and cuts_between([1.0, 1.0, 2.0], 4) == [1.5]
    assert len(cuts_between(list(range(1000)), 32)) == 31
    rare = cuts_between([0.0] * 900 + [float(k) for k in range(1, 101)], 32)  # a frequent value leaves its bins to the others
    assert rare[0] == 0.5 and 3 <= len(rare) <= 31
    kind = rf._Kind(ForestParams(), 2, 2, [[0.5], []])
    weights = np.stack([kind.weights(np.arange(5000, dtype=np.uint64), tree) for tree in range(4)])
    assert abs(weights.mean() - 1) < 0.03 and abs(weights.var() - 1) < 0.06 and (weights[0] != weights[1]).mean() > 0.5


def test_packed_nodes():
    nodes = packed([1, LEAF, LEAF], [0.5, 0.0, 0.0], [1, -1, -1], [[3, 2], [3, 0], [0, 2]])
    assert walk(nodes, np.array([[9.0, 0.5], [0.0, 0.6]])).tolist() == [1, 2]
    assert nodes["left"].tolist() == [1, 0, 1] and len(nodes["mixed"]) == 0 and json.dumps(nodes["cut"].tolist()) == "[0.5, 3.0, 2.0]"
