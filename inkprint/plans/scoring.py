"""Messages to author probabilities, verdicts and running averages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.functions import probs as pr
from inkprint.operators.clean import drop_blank
from inkprint.operators.order import blocked_running_sums
from inkprint.operators.stack import Stack
from inkprint.session import materialize


def explode_classes(df: DataFrame, probs: str = "probability") -> DataFrame:
    """One row per message and class: ..., user, p."""
    kept = [c for c in df.columns if c != probs]
    return df.select(*kept, F.posexplode(probs).alias("user", "p"))


def running_average(df: DataFrame, keys: tuple[str, ...] = ("chat_id",), pos: str = "pos", p: str = "p") -> DataFrame:
    """Add ``average``: mean of the class's probability over the conversation so far.

    ``df`` has one row per message and class. Without keys the whole table is one
    conversation.
    """
    keyed = df if keys else df.withColumn("_all", F.lit(0))
    by = [*(keys or ("_all",)), "user"]
    sums = blocked_running_sums(keyed.withColumn("_one", F.lit(1)), by, pos, {"_sum": p, "_count": "_one"})
    return sums.withColumn("average", F.col("_sum") / F.col("_count")).drop("_sum", "_count", "_one", "_all")


def overall_average(df: DataFrame, keys: tuple[str, ...] = ("chat_id",), p: str = "p") -> DataFrame:
    """Mean probability per conversation and class."""
    return df.groupBy(*keys, "user").agg(F.avg(p).alias("average"), F.count("*").alias("n"))


def score_messages(df: DataFrame, stack: Stack, to_features: Callable[[DataFrame], DataFrame],
                   to_embeddings: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ("chat_id",)) -> DataFrame:
    """``df(message_id, chat_id, pos, message)`` to one row per message and class: user, p, average,
    and author, where the stack knows the names of its classes.

    Blank messages are left out. The two functions make the feature and the embedding
    table of the messages, as in training.
    """
    rows = drop_blank(df, "message")
    probs = stack.predict(to_features(rows), to_embeddings(rows)).select("message_id", "probability")
    place = rows.select("message_id", *keys, "pos")
    # written once: the running sums read the scored rows more than once
    return stack.with_authors(running_average(explode_classes(materialize(place.join(probs, "message_id"), "scored")), keys))


def verdict(df: DataFrame, probs: str = "probability") -> DataFrame:
    """Add ``user`` (first largest class) and ``certainty``."""
    return df.withColumn("user", pr.argmax(probs)).withColumn("certainty", pr.band(probs))


def report(df: DataFrame, probs: str = "probability") -> DataFrame:
    """One row per class: user, percent text, and whether it is the highlighted one."""
    kept = [c for c in df.columns if c != probs]
    flat = df.select(*kept, pr.argmax(probs).alias("_best"), F.posexplode(probs).alias("user", "p"))
    return flat.select(*kept, F.col("user").cast("long").alias("user"), pr.percent("p").alias("percent"),
                       (F.col("user") == F.col("_best")).alias("highlight"))
