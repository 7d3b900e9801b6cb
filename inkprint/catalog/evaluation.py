"""V1-V6: metrics as tables."""

from __future__ import annotations


from inkprint.catalog.base import SCORED, query, r6, scored
from inkprint.operators import evaluate as ev

K = 10


@query("v1_accuracy", f'SELECT round(avg(("user" = prediction)::INT), 6) AS accuracy FROM ({SCORED})')
def v1(spark, d):
    return ev.accuracy(scored(spark, d)).select(r6("accuracy").alias("accuracy"))


_PER_CLASS = f"""
WITH s AS ({SCORED}), labels AS (SELECT "user" AS label FROM s UNION SELECT prediction FROM s),
c AS (SELECT label, (SELECT count(*) FROM s WHERE "user" = label) AS support,
             (SELECT count(*) FROM s WHERE prediction = label) AS claimed,
             (SELECT count(*) FROM s WHERE "user" = label AND prediction = label) AS hits FROM labels),
p AS (SELECT label, support, hits, CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed::DOUBLE END AS precision,
             CASE WHEN support = 0 THEN 0 ELSE hits / support::DOUBLE END AS recall FROM c),
r AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM p)
"""


@query("v2_classification_report", _PER_CLASS + """
SELECT label::VARCHAR AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support::BIGINT AS support FROM r UNION ALL
SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
       round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM r UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM r UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM r""")
def v2(spark, d):
    return ev.classification_report(scored(spark, d)).select(
        "label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("v3_confusion_matrix", f"""
WITH s AS ({SCORED}), labels AS (SELECT "user" AS label FROM s UNION SELECT prediction FROM s)
SELECT a.label::INTEGER AS actual, b.label::INTEGER AS predicted,
       (SELECT count(*) FROM s WHERE "user" = a.label AND prediction = b.label)::BIGINT AS n
FROM labels a, labels b""")
def v3(spark, d):
    return ev.confusion_matrix(scored(spark, d))


_BINARY = f"""
SELECT message_id, i::INTEGER AS class, ("user" = i)::INTEGER AS positive, round(probability[i + 1], 6) AS score
FROM ({SCORED}), range({K}) r(i)"""


def _binary(spark, d):
    return ev.binarize(scored(spark, d), K).withColumn("score", r6("score"))


@query("v4_binarize", _BINARY)
def v4(spark, d):
    return _binary(spark, d)


@query("v5_roc_curve", f"""
WITH b AS ({_BINARY}), g AS (SELECT class, score, sum(positive) AS pos, sum(1 - positive) AS neg FROM b GROUP BY 1, 2)
SELECT class, score AS threshold,
       round(sum(neg) OVER up / sum(neg) OVER (PARTITION BY class)::DOUBLE, 6) AS fpr,
       round(sum(pos) OVER up / sum(pos) OVER (PARTITION BY class)::DOUBLE, 6) AS tpr
FROM g WINDOW up AS (PARTITION BY class ORDER BY score DESC) UNION ALL
SELECT DISTINCT class, 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM b""")
def v5(spark, d):
    return ev.roc_curve(_binary(spark, d)).select("class", "threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


# rank-sum form, with mean ranks for equal scores
_AUC = f"""
WITH b AS ({_BINARY}), ranked AS (
    SELECT *, rank() OVER (PARTITION BY class ORDER BY score)
              + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0::DOUBLE AS place FROM b)
SELECT class, (sum(place) FILTER (positive = 1) - sum(positive) * (sum(positive) + 1) / 2.0::DOUBLE)
       / (sum(positive) * (count(*) - sum(positive)))::DOUBLE AS auc FROM ranked GROUP BY class"""


@query("v6_auc", f"SELECT class, round(auc, 6) AS auc FROM ({_AUC})")
def v6(spark, d):
    return ev.auc(_binary(spark, d)).select("class", r6("auc").alias("auc"))


@query("v6_macro_auc", f"SELECT round(avg(auc), 6) AS auc FROM ({_AUC})")
def v6_macro(spark, d):
    return ev.macro_auc(_binary(spark, d)).select(r6("auc").alias("auc"))


@query("m11_fold_scores", _PER_CLASS + """
SELECT 'accuracy' AS metric, round(sum(hits) / sum(support), 6) AS value FROM r UNION ALL
SELECT 'precision_weighted', round(sum(precision * support) / sum(support), 6) FROM r UNION ALL
SELECT 'recall_weighted', round(sum(recall * support) / sum(support), 6) FROM r UNION ALL
SELECT 'f1_weighted', round(sum(f1 * support) / sum(support), 6) FROM r""")
def m11(spark, d):
    return ev.fold_scores(scored(spark, d)).select("metric", r6("value").alias("value"))


