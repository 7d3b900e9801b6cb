"""Word lists, and vocabularies drawn from a corpus."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkprint.functions.tokens import token_texts
from inkprint.session import path_exists


def load_wordlist(spark: SparkSession, path: str, clipped: bool = False) -> DataFrame:
    """One entry per line, as a set; ``clipped`` adds each entry without its last character."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return word_set(spark.read.text(path).select(F.col("value").alias("word")), clipped)


def word_set(words: DataFrame, clipped: bool = False) -> DataFrame:
    words = words.select("word")
    if clipped:
        words = words.union(words.select(F.expr("left(word, length(word) - 1)").alias("word")))
    return words.distinct()


def union_words(lists: Iterable[DataFrame]) -> DataFrame:
    """Set union of several lists."""
    whole = None
    for words in lists:
        words = words.select("word")
        whole = words if whole is None else whole.union(words)
    return whole.distinct()


def inline_words(words: DataFrame, limit: int = 5_000) -> list[str] | None:
    """The list on the driver if it has at most ``limit`` entries, else None. Null entries match nothing."""
    rows = words.select("word").where("word IS NOT NULL").limit(limit + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= limit else None


def build_vocabulary(docs: DataFrame, text: str = "message", key: str = "message_id",
                     min_docs: int = 2, by: Iterable[str] = ()) -> DataFrame:
    """Lower-case alphabetic tokens that occur in at least ``min_docs`` texts: (by,) word, n_docs.

    With ``by``, such as the language, every group has a vocabulary of its own, from one scan.

    Each text first reduces its tokens to distinct words, so a word is counted once per
    text by a plain (map-side combined) count.
    """
    words = F.array_distinct(F.transform(
        F.filter(token_texts(text), lambda t: t.rlike(r"\A\p{L}")), lambda t: F.lower(t)))
    return (
        docs.select(key, *by, F.explode(words).alias("word"))
        .groupBy(*by, "word").agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )
