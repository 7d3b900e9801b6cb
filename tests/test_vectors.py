from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint.functions import probs as pr
from inkprint.operators import evaluate as ev
from inkprint.operators import neighbors as nb
from inkprint.plans import scoring as sc


def brute(queries, base, k):
    out = {}
    for qid, q in queries:
        ranked = sorted((round(float(((q - b) ** 2).sum()), 12), bid) for bid, b in base)
        out[qid] = [bid for _, bid in ranked[:k]]
    return out


@pytest.mark.parametrize("dims, block", [(2, 40), (8, 4000)])
def test_knn_equals_brute_force_on_clustered_rows(spark, dims, block):
    rng = np.random.default_rng(3)
    # a third of the base rows are copies of one vector, the rest lie in clusters
    points = np.concatenate([np.tile(rng.normal(size=dims), (200, 1)),
                             rng.normal(size=(10, dims)).repeat(40, 0) * 5 + rng.normal(size=(400, dims)) * 0.3])
    base = list(enumerate(points))
    queries = [(1000 + i, p) for i, p in enumerate(np.concatenate([points[::9], rng.normal(size=(30, dims)) * 4]))]
    make = lambda rows: spark.createDataFrame([(i, p.tolist()) for i, p in rows], "id long, vector array<double>")
    got = {}
    found = nb.knn_join(make(queries), make(base), 5, pivots=6, block_rows=block).orderBy("query_id", "rank").collect()
    for r in found:
        got.setdefault(r.query_id, []).append(r.neighbor_id)
    assert got == brute(queries, base, 5)


def test_knn_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "id long, vector array<double>")
    got = nb.knn_join(df, df, 5, exclude_self=True)
    assert [r.neighbor_id for r in got.filter("query_id = 3").orderBy("rank").collect()] == [2, 1]
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id long, label int")
    votes = nb.knn_votes(got, labels, 2)
    assert {r.query_id: r.prediction for r in nb.knn_predict(votes).collect()} == {1: 1, 2: 0, 3: 0}


def vectors(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "message_id long, probability array<double>")


def test_row_statistics(spark):
    rows = [[0.8, 0.2], [0.5, 0.5], [1.0], [0.1, 0.2, 0.7], [0.0, 1.0]]
    df = vectors(spark, rows)
    one = lambda c: [r[0] for r in df.orderBy("message_id").select(c).collect()]
    p = "probability"
    assert one(pr.argmax(p)) == [0, 0, 0, 2, 1]
    assert np.allclose(one(pr.std(p)), [np.std(r) for r in rows])
    assert np.allclose(one(pr.variance(p)), [np.var(r) for r in rows])
    assert np.allclose(one(pr.margin(p)), [0.6, 0, 1, 0.5, 1])
    assert np.allclose(one(pr.top2(p)), [1, 1, 1, 0.9, 1])
    assert np.allclose(one(pr.logit_max(p))[2], math.log(0.999 / 0.001))

    def entropy(r):
        q = np.array(r) + 1e-10
        q = q / q.sum()
        return float(-(q * np.log(q)).sum())

    assert np.allclose(one(pr.entropy(p)), [entropy(r) for r in rows])
    assert np.allclose([sum(v) for v in one(pr.softmax(p))], 1)
    assert np.allclose(one(pr.blend(p, p))[3], rows[3])
    assert one(pr.band(p)) == ["Certain", "Certain", "Certain", "Certain", "Certain"]
    low = vectors(spark, [[0.4, 0.3, 0.3], [0.6, 0.2, 0.2]])
    assert [r.certainty for r in sc.verdict(low).orderBy("message_id").collect()] == ["Doubtful", "Probable"]
    shown = sc.report(vectors(spark, [[0.12345, 0.87655]])).orderBy("user").collect()
    assert [(r.percent, r.highlight) for r in shown] == [("12.35", False), ("87.66", True)] or \
        [(r.percent, r.highlight) for r in shown] == [("12.35", False), ("87.65", True)]


def scored(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                 "message_id long, user int, prediction int, probability array<double>")


def test_report_with_an_unpredicted_class(spark):
    df = scored(spark, [(0, 0, [0.9, 0.1]), (0, 0, [0.8, 0.2]), (1, 0, [0.6, 0.4]), (2, 0, [0.7, 0.3])])
    report = {r.label: r for r in ev.classification_report(df).collect()}
    assert report["0"].precision == 0.5 and report["1"].recall == 0 and report["2"].f1 == 0
    assert report["accuracy"].f1 == 0.5 and report["weighted avg"].support == 4
    cells = {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(df).collect()}
    assert len(cells) == 9 and cells[(1, 0)] == 1 and cells[(2, 2)] == 0


def test_auc(spark):
    perfect = scored(spark, [(0, 0, [0.9, 0.1]), (1, 1, [0.2, 0.8]), (1, 1, [0.4, 0.6])])
    assert ev.model_auc(perfect, 2).first().auc == 1.0
    tied = scored(spark, [(0, 0, [0.5, 0.5]), (1, 1, [0.5, 0.5]), (1, 1, [0.4, 0.6])])
    assert ev.model_auc(tied, 2).first().auc == 0.75
    single = scored(spark, [(1, 1, [0.5, 0.5])])
    assert ev.model_auc(single, 2).first().auc is None
    curve = ev.roc_curve(ev.binarize(perfect, 2)).filter("class = 1").orderBy("fpr", "tpr").collect()
    assert [(r.fpr, r.tpr) for r in curve] == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0), (1.0, 1.0)]
    flat = ev.auc(ev.binarize(perfect, 2).filter("class = 1"), ())
    assert flat.first().auc == 1.0


def test_losses(spark):
    df = scored(spark, [(0, 0, [0.8, 0.2]), (1, 0, [0.6, 0.4])])
    ce = [-math.log(0.8), -math.log(0.4)]
    focal = [0.5 * (1 - math.exp(-c)) ** 2 * c for c in ce]
    assert math.isclose(ev.focal(df).first().loss, sum(focal) / 2)
    assert math.isclose(ev.focal(df, reduction="sum").first().loss, sum(focal))
    weighted = df.withColumn("weight", F.col("user") + 1.0)
    assert math.isclose(ev.weighted_log_loss(weighted).first().loss, (ce[0] + 2 * ce[1]) / 3)
    with pytest.raises(ValueError):
        ev.focal(df, reduction="max")
