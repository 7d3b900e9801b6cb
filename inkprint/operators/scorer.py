"""Text classifiers for the sentiment and emotion features: logistic regression on a hashed bag, and naive Bayes on words.

Naive Bayes is counts and joins only: the model is a table with a row for each word, of any size, and the driver holds as many numbers
as there are classes.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.constants import BAG_WIDTH
from inkprint.functions import text as tx
from inkprint.operators.features import bag_of_words, sparse_vector
from inkprint.session import BROADCAST_BYTES, store


def _vectors(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    bag = bag_of_words(df, n, text=text, key=key)
    return df.join(bag, key, "left").withColumn(
        "_bag", sparse_vector(F.col("buckets"), F.col("values"), n)).drop("buckets", "values")


def fit_text_scorer(df: DataFrame, label: str, text: str = "message", key: str = "message_id", n: int = BAG_WIDTH,
                    max_iter: int = 50, penalty: float = 0.01):
    """Logistic regression on the hashed bag of words; ``label`` holds the class ids."""
    learner = LogisticRegression(featuresCol="_bag", labelCol=label, predictionCol="_class",
                                 probabilityCol="_p", rawPredictionCol="_raw", maxIter=max_iter, regParam=penalty)
    return learner.fit(_vectors(df, text, key, n))


def score_text(df: DataFrame, model, out: str, text: str = "message", key: str = "message_id",
               n: int = BAG_WIDTH) -> DataFrame:
    """Add the predicted class id; usable as the ``sentiment``/``emotion`` hook of build_features."""
    scored = model.transform(_vectors(df, text, key, n))
    return scored.withColumn(out, F.col("_class").cast("long")).drop("_bag", "_class", "_p", "_raw")


@dataclass
class WordClasses:
    """Multinomial naive Bayes: word, n (its occurrences), logs (of its share in each class), and the log share of each class."""

    words: DataFrame
    stored_bytes: int
    priors: list[float]


def fit_word_classes(df: DataFrame, label: str, n_classes: int, text: str = "message", smoothing: float = 1.0) -> WordClasses:
    """Counts of every word in every class. Rows with a null text hold no words; a class without rows is never chosen
    before one with rows; null labels are left out."""
    rows = df.where(F.col(label).isNotNull())
    words = rows.select(F.col(label).cast("int").alias("_class"), F.explode(tx.bag_tokens(text)).alias("word"))
    sums = [F.sum(F.when(F.col("_class") == c, 1).otherwise(0)).alias(f"n{c}") for c in range(n_classes)]
    counts, _ = store(words.groupBy("word").agg(*sums), "word-counts")
    total = counts.agg(F.count("*").alias("v"), *[F.coalesce(F.sum(f"n{c}"), F.lit(0)).alias(f"n{c}") for c in range(n_classes)]).first()
    share = [F.ln((F.col(f"n{c}") + smoothing) / (total[f"n{c}"] + smoothing * max(1, total["v"]))) for c in range(n_classes)]
    seen = sum((F.col(f"n{c}") for c in range(n_classes)), F.lit(0).cast("long"))
    logs, size = store(counts.select("word", seen.alias("n"), F.array(*share).alias("logs")), "word-classes")
    held = {r["c"]: r["n"] for r in rows.groupBy(F.col(label).cast("int").alias("c")).agg(F.count("*").alias("n")).collect()}
    every = sum(held.values())
    return WordClasses(logs, size, [log(held[c] / every) if held.get(c) else -1e9 for c in range(n_classes)])


def _level(n: str):
    return F.floor(F.log2(F.greatest(F.col(n), F.lit(1)).cast("double")) * 4)


def _head_level(words: DataFrame, n_classes: int, limit: int) -> int:
    """The lowest level of occurrences down to which the words fit into ``limit`` bytes."""
    row = F.octet_length("word") + 8 * n_classes + 32
    held, cut = 0, 1 << 30
    for r in words.groupBy(_level("n").alias("level")).agg(F.sum(row).alias("bytes")).orderBy(F.desc("level")).collect():
        held += r["bytes"]
        if held > limit:
            break
        cut = r["level"]
    return cut


def classify_words(df: DataFrame, model: WordClasses, out: str, text: str = "message", key: str = "message_id",
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add the most probable class id. Words that the model does not know are left out; equal scores go to the smaller id.

    The most frequent words of a model, as many as fit into a broadcast, meet the words of the messages in place, and their logs are
    added inside tasks; only the others, of which none is hot, go through a join.
    """
    met, n = df.select(key, F.explode(tx.bag_tokens(text)).alias("word")), len(model.priors)
    head, tail = model.words, None
    if model.stored_bytes > broadcast_bytes:
        cut = _head_level(model.words, n, broadcast_bytes)
        head, tail = model.words.where(_level("n") >= cut), model.words.where(_level("n") < cut)
    met = met.join(F.broadcast(head.select("word", "logs")), "word", "inner" if tail is None else "left")
    sums = [F.sum(F.get("logs", F.lit(c))).alias(f"_s{c}") for c in range(n)]
    if tail is not None:
        rest = met.where(F.col("logs").isNull()).select(key, "word").join(tail.select("word", "logs").hint("merge"), "word")
        met = met.where(F.col("logs").isNotNull()).groupBy(key).agg(*sums).unionByName(rest.groupBy(key).agg(*sums))
        sums = [F.sum(f"_s{c}").alias(f"_s{c}") for c in range(n)]
    sums = met.groupBy(key).agg(*sums)
    scores = [F.round(F.coalesce(F.col(f"_s{c}"), F.lit(0.0)) + model.priors[c], 6) for c in range(n)]
    best = F.array_position(F.array(*scores), F.array_max(F.array(*scores))) - 1
    return df.join(sums, key, "left").withColumn(out, best.cast("long")).drop(*[f"_s{c}" for c in range(n)])
