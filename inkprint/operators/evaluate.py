"""Metrics as tables. Predictions are first reduced to counts, so later steps are small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkprint.functions import probs as pr
from inkprint.operators.order import sorted_running_sums
from inkprint.session import materialize


def accuracy(df: DataFrame, actual: str = "user", predicted: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def _counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    counts = df.groupBy(F.col(actual).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted"))
    return materialize(counts.agg(F.count("*").alias("n")), "confusion")


def _labels(counts: DataFrame) -> DataFrame:
    return counts.select(F.col("actual").alias("label")).union(counts.select("predicted")).distinct()


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _per_class(counts: DataFrame) -> DataFrame:
    by_actual = counts.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"))
    by_predicted = counts.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("claimed"))
    hits = counts.filter("actual = predicted").select(F.col("actual").alias("label"), F.col("n").alias("hits"))
    table = _labels(counts).join(by_actual, "label", "left").join(by_predicted, "label", "left") \
        .join(hits, "label", "left").na.fill(0, ["support", "claimed", "hits"])
    precision, recall = _ratio(F.col("hits"), F.col("claimed")), _ratio(F.col("hits"), F.col("support"))
    return table.select("label", "support", "hits", precision.alias("precision"), recall.alias("recall"),
                        _ratio(2 * precision * recall, precision + recall).alias("f1"))


def classification_report(df: DataFrame, actual: str = "user", predicted: str = "prediction") -> DataFrame:
    """label, precision, recall, f1, support per class, then accuracy, macro avg, weighted avg."""
    per_class = _per_class(_counts(df, actual, predicted))
    measures = ["precision", "recall", "f1"]
    rows = per_class.select(F.col("label").cast("string").alias("label"), *measures, "support")
    hit_rate = (F.sum("hits") / F.sum("support"))
    correct = per_class.agg(*[hit_rate.alias(m) for m in measures], F.sum("support").alias("support"))
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = per_class.agg(*[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
                             F.sum("support").alias("support"))
    for name, table in (("accuracy", correct), ("macro avg", macro), ("weighted avg", weighted)):
        rows = rows.unionByName(table.select(F.lit(name).alias("label"), *measures, "support"))
    return rows


def confusion_matrix(df: DataFrame, actual: str = "user", predicted: str = "prediction") -> DataFrame:
    """actual, predicted, n for every pair of labels, zeros included."""
    counts = _counts(df, actual, predicted)
    # one row per class at most, and the result itself holds every pair of classes
    names = _labels(counts).agg(F.sort_array(F.collect_set("label"))).scalar()
    grid = _labels(counts).select(F.col("label").alias("actual"), F.explode(names).alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def binarize(df: DataFrame, n_classes: int, actual: str = "user", probs: str = "probability",
             key: str = "message_id") -> DataFrame:
    """key, class, positive (0/1), score: every row against every class."""
    return df.select(key, F.col(actual).alias("_actual"), F.posexplode(probs).alias("class", "score")).filter(
        F.col("class") < n_classes).select(
        key, "class", (F.col("_actual") == F.col("class")).cast("int").alias("positive"), "score")


def _by_score(binary: DataFrame, keys: list[str]) -> DataFrame:
    counts = binary.groupBy(*keys, "score").agg(
        F.sum("positive").alias("pos"), F.sum(1 - F.col("positive")).alias("neg"))
    ranked = counts.withColumn("_down", -F.col("score"))
    return materialize(sorted_running_sums(ranked, keys, ["_down"], {"tp": "pos", "fp": "neg"}).drop("_down"), "roc")


def roc_curve(binary: DataFrame, keys: tuple[str, ...] = ("class",)) -> DataFrame:
    """threshold, fpr, tpr at every distinct score, and the origin (threshold infinity)."""
    keys = list(keys)
    points = _by_score(binary, keys)
    totals = points.groupBy(*keys).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    curve = points.join(totals, keys) if keys else points.withColumns({
        "_p": totals.select("_p").scalar(), "_n": totals.select("_n").scalar()})
    curve = curve.select(*keys, F.col("score").alias("threshold"),
                         _ratio(F.col("fp"), F.col("_n")).alias("fpr"), _ratio(F.col("tp"), F.col("_p")).alias("tpr"))
    origin = totals.select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                           F.lit(0.0).alias("tpr"))
    return curve.unionByName(origin)


def auc(binary: DataFrame, keys: tuple[str, ...] = ("class",)) -> DataFrame:
    """Area under the curve per class: pairs ranked rightly, ties half; null with one class only."""
    keys = list(keys)
    points = _by_score(binary, keys)
    area = F.sum(F.col("neg") * (F.col("tp").cast("double") - F.col("pos") / 2.0))
    whole = F.sum("pos").cast("double") * F.sum("neg")
    grouped = points.groupBy(*keys) if keys else points.groupBy()
    return grouped.agg(F.when(whole > 0, area / whole).alias("auc"))


def macro_auc(binary: DataFrame) -> DataFrame:
    return auc(binary).agg(F.avg("auc").alias("auc"))


def model_auc(df: DataFrame, n_classes: int, actual: str = "user", probs: str = "probability",
              key: str = "message_id") -> DataFrame:
    """Two classes: of the positive column; more: mean of one against the rest."""
    binary = binarize(df, n_classes, actual, probs, key)
    if n_classes == 2:
        return auc(binary.filter("class = 1"), ()).select("auc")
    return macro_auc(binary)


def score_summary(scores: DataFrame) -> DataFrame:
    """metric, mean, margin (twice the population standard deviation) over the folds."""
    return scores.groupBy("metric").agg(F.avg("value").alias("mean"),
                                        (2 * F.stddev_pop("value")).alias("margin"))


def true_probability(probs: str = "probability", actual: str = "user") -> Column:
    return F.get(F.col(probs), F.col(actual).cast("int"))


def focal(df: DataFrame, alpha: float = 0.5, gamma: float = 2.0, reduction: str = "mean",
          probs: str = "probability", actual: str = "user") -> DataFrame:
    """Focal loss of the true class: one value for mean or sum, a ``loss`` column for none."""
    loss = pr.focal_loss(true_probability(probs, actual), alpha, gamma)
    if reduction == "none":
        return df.withColumn("loss", loss)
    if reduction not in ("mean", "sum"):
        raise ValueError(f"unknown reduction: {reduction}")
    return df.agg((F.avg if reduction == "mean" else F.sum)(loss).alias("loss"))


def weighted_log_loss(df: DataFrame, weight: str = "weight", probs: str = "probability",
                      actual: str = "user") -> DataFrame:
    """Cross-entropy of the true class, averaged with the class weights."""
    loss = -F.ln(true_probability(probs, actual))
    return df.agg((F.sum(F.col(weight) * loss) / F.sum(weight)).alias("loss"))


def fold_scores(df: DataFrame, actual: str = "user", predicted: str = "prediction") -> DataFrame:
    """metric, value: accuracy and support-weighted precision, recall, F1."""
    per_class = _per_class(_counts(df, actual, predicted))
    weight = F.sum("support")
    row = per_class.agg(
        (F.sum("hits") / weight).alias("accuracy"),
        *[(F.sum(F.col(m) * F.col("support")) / weight).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")])
    names = row.columns
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))
