"""Balancing and splitting by hashed ids: exact sizes, the same rows on any partitioning.

Every row gets the key md5("id:seed"). Taking n rows of a class means taking its n
smallest keys. The n-th smallest key is found from a histogram of key prefixes and a
look into the single prefix it falls in; the rows are then chosen by a comparison with
that cut. No class is ever sorted or held in one task, and message bodies are not moved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkprint.constants import SEED
from inkprint.operators.joins import lookup
from inkprint.operators.order import dense_index, dimension_index
from inkprint.session import materialize

PREFIX = 4  # hex digits: 65,536 histogram cells per class


def hash_key(key: str | Column, seed: int = SEED) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def uniform(key: str | Column, seed: int = SEED) -> Column:
    """A number in (0, 1) from the hashed id."""
    whole = F.conv(F.substring(hash_key(key, seed), 1, 13), 16, 10).cast("double")
    return (whole + 0.5) / float(1 << 52)


def histogram(df: DataFrame, by: str, key: str, seed: int = SEED) -> DataFrame:
    """(by, cell, n): how many rows of each class have a key in each cell; written once."""
    keyed = df.select(by, F.substring(hash_key(key, seed), 1, PREFIX).alias("_cell"))
    return materialize(keyed.groupBy(by, "_cell").agg(F.count("*").alias("_n")), "cells")


def _sizes(cells: DataFrame, by: str) -> DataFrame:
    return cells.groupBy(by).agg(F.sum("_n").alias("n"))


def rank_cuts(df: DataFrame, cells: DataFrame, by: str, key: str, ranks: DataFrame, seed: int = SEED) -> DataFrame:
    """(by, label, cut): the hashed key at each wanted rank of its class.

    ``ranks`` holds (by, label, rank), ranks counting from 1. Ranks below 1 give no cut.
    """
    upto = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        cells.withColumn("_upto", F.sum("_n").over(upto)).join(ranks, by)
        .filter((F.col("rank") <= F.col("_upto")) & (F.col("rank") > F.col("_upto") - F.col("_n")))
        .select(by, "label", "_cell", (F.col("rank") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    keyed = df.select(by, hash_key(key, seed).alias("_key")).withColumn("_cell", F.substring("_key", 1, PREFIX))
    in_cell = Window.partitionBy(by, "label", "_cell").orderBy("_key")
    # written once, so that Spark knows its size; the cells spread even a class of most rows
    return (
        keyed.join(materialize(hit, "hit"), [by, "_cell"])
        .withColumn("_place", F.row_number().over(in_cell))
        .filter(F.col("_place") == F.col("_need"))
        .select(by, "label", F.col("_key").alias("cut"))
    )


def _with_cuts(df: DataFrame, by: str, cuts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Add one column ``_cut_<label>`` per label; null where the class takes no row."""
    wide = cuts.groupBy(by).agg(*[
        F.max(F.when(F.col("label") == label, F.col("cut"))).alias(f"_cut_{label}") for label in labels])
    return lookup(df, wide, by)


def undersample(df: DataFrame, by: str = "user", key: str = "message_id", seed: int = SEED,
                classes: DataFrame | None = None) -> DataFrame:
    """Every class down to the size of the smallest, without replacement.

    With ``classes`` given, a class that has no row at all is an error.
    """
    cells = histogram(df, by, key, seed)
    counts = _sizes(cells, by)
    if classes is not None and not classes.select(by).distinct().join(counts, by, "left_anti").isEmpty():
        raise ValueError("a class has no rows to balance")
    ranks = counts.select(by, F.lit("keep").alias("label"), counts.agg(F.min("n")).scalar().alias("rank"))
    order = df.columns
    return (
        _with_cuts(df, by, rank_cuts(df, cells, by, key, ranks, seed), ["keep"])
        .filter(hash_key(key, seed) <= F.col("_cut_keep")).select(*order)
    )


def _whole(df: DataFrame, column: str = "_all") -> DataFrame:
    return df.withColumn(column, F.lit(0))


def _driver_cuts(df: DataFrame, key: str, wanted, seed: int) -> tuple[int, list[str | None]]:
    """Row count of the undivided table and its cuts at the ranks ``wanted(count)``.

    The number of ranks is fixed by the caller (parts or folds), never by the data.
    """
    whole = _whole(df)
    cells = histogram(whole, "_all", key, seed)
    n = cells.agg(F.sum("_n")).first()[0] or 0
    ranks = list(wanted(n))
    rows = [(0, str(i), int(r)) for i, r in enumerate(ranks) if r > 0]
    if not rows:
        return n, [None] * len(ranks)
    table = df.sparkSession.createDataFrame(rows, "_all int, label string, rank long")
    found = {r["label"]: r["cut"] for r in rank_cuts(whole, cells, "_all", key, table, seed).collect()}
    return n, [found.get(str(i)) for i in range(len(ranks))]


def split(df: DataFrame, test_size: float = 0.2, key: str = "message_id", seed: int = SEED) -> DataFrame:
    """Add ``split`` = train/test, unstratified; the test part has ceil(n * test_size) rows."""
    cut = _driver_cuts(df, key, lambda n: [math.ceil(n * test_size - 1e-9)], seed)[1][0]
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    return df.withColumn("split", F.when(hash_key(key, seed) <= F.lit(cut), "test").otherwise("train"))


def stratified_sizes(counts: DataFrame, by: str, sizes: Sequence[tuple[str, float]]) -> DataFrame:
    """(by, label, rank): cumulative ranks per class of successive parts.

    ``sizes`` lists (label, fraction of what earlier parts left). Each part has
    ceil(fraction * remaining) rows in all, shared out by class in proportion; leftover
    rows go to the largest remainders, ties to the smaller class. ``counts`` is one row
    per class, so its window is bounded by the number of classes.
    """
    table = counts.select(by, F.col("n").cast("long").alias("_left"), F.lit(0).cast("long").alias("_taken"))
    parts = None
    for label, fraction in sizes:
        whole = Window.partitionBy(F.lit(0))
        total = F.sum("_left").over(whole)
        # the tiny slack undoes products such as 0.15 * 20 landing just above an integer
        wanted = F.ceil(total * F.lit(float(fraction)) - F.lit(1e-9))
        table = table.withColumn("_wanted", wanted).withColumn("_total", total)
        exact = F.col("_left") * F.col("_wanted") / F.col("_total")
        table = table.withColumn("_base", F.floor(exact)).withColumn("_rest", exact - F.floor(exact))
        spare = F.col("_wanted") - F.sum("_base").over(whole)
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.round("_rest", 9).desc(), by))
        take = F.col("_base") + F.when(place <= spare, 1).otherwise(0)
        table = (
            table.withColumn("_take", take)
            .withColumn("_taken", F.col("_taken") + F.col("_take"))
            .withColumn("_left", F.col("_left") - F.col("_take"))
        )
        part = table.select(by, F.lit(label).alias("label"), F.col("_taken").alias("rank"))
        parts = part if parts is None else parts.unionByName(part)
        table = table.select(by, "_left", "_taken")
    return parts


def stratified_split(df: DataFrame, by: str = "user", sizes: Sequence[tuple[str, float]] = (("test", 0.15),),
                     key: str = "message_id", seed: int = SEED, rest: str = "train") -> DataFrame:
    """Add ``split``: the parts of ``sizes`` in order, and ``rest`` for what remains."""
    sizes = [(label, fraction) for label, fraction in sizes if fraction > 0]
    if not sizes:
        return df.withColumn("split", F.lit(rest))
    cells = histogram(df, by, key, seed)
    ranks = stratified_sizes(_sizes(cells, by), by, sizes)
    labels = [label for label, _ in sizes]
    cut = _with_cuts(df, by, rank_cuts(df, cells, by, key, ranks, seed), labels)
    name = None
    for label in labels:
        here = hash_key(key, seed) <= F.col(f"_cut_{label}")
        name = F.when(here, label) if name is None else name.when(here, label)
    return cut.withColumn("split", name.otherwise(rest)).select(*df.columns, "split")


def train_val_test(df: DataFrame, by: str = "user", test_size: float = 0.2, val_size: float = 0.25,
                   key: str = "message_id", seed: int = SEED) -> DataFrame:
    """Stratified test part first, then validation from what remains; no test part if its size is 0."""
    return stratified_split(df, by, [("test", test_size), ("val", val_size)], key, seed)


def assign_folds(df: DataFrame, k: int = 5, key: str = "message_id", seed: int = SEED) -> DataFrame:
    """Add ``fold`` 0..k-1; the first n mod k folds have one row more."""
    if k < 2:
        raise ValueError("at least two folds are needed")

    def ends(n: int) -> list[int]:
        if n < k:
            raise ValueError(f"{n} rows cannot make {k} folds")
        sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
        return [sum(sizes[:i + 1]) for i in range(k - 1)]

    fold = F.lit(0)
    for cut in _driver_cuts(df, key, ends, seed)[1]:
        fold = fold + (hash_key(key, seed) > F.lit(cut)).cast("int")
    return df.withColumn("fold", fold)


def class_weights(df: DataFrame, by: str = "user") -> DataFrame:
    """by, n, weight = 1/n, and norm_weight scaled so that the weights of K classes sum to K."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    inverse = counts.withColumn("weight", 1.0 / F.col("n"))
    totals = inverse.agg(F.count("*").alias("k"), F.sum("weight").alias("w"))
    factor = totals.select(F.col("k") / F.col("w")).scalar()
    return inverse.withColumn("norm_weight", F.col("weight") * factor)


def with_class_weight(df: DataFrame, by: str = "user", out: str = "weight") -> DataFrame:
    weights = class_weights(df, by).select(by, F.col("norm_weight").alias(out))
    return lookup(df, weights, by, "inner")


def class_distribution(df: DataFrame, by: str = "user") -> DataFrame:
    return df.groupBy("split", by).agg(F.count("*").alias("n"))


def balanced_resample(df: DataFrame, by: str = "user", key: str = "message_id", seed: int = SEED) -> DataFrame:
    """Draw exactly n rows with replacement, every class equally likely; adds ``draw``, 0..n-1.

    The ids, sorted by class, are numbered over the whole table. A draw takes a class and a place in it from
    two hashes of its number, hence a row number; only ids are sorted and joined before the rows themselves.
    """
    placed = materialize(dense_index(df.select(by, key), [by, key], "_at"), "placed")
    first = placed.groupBy(by).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    numbers, size = dimension_index(first, by, "_class")
    n, k = placed.count(), numbers.count()
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"), F.floor(uniform("id", seed) * k).cast("long").alias("_class"),
        uniform("id", seed + 1).alias("_u"))
    drawn = lookup(draws, numbers.select("_class", "_first", "_n"), "_class", "inner", known_bytes=size) \
        .select("draw", (F.col("_first") + F.floor(F.col("_u") * F.col("_n"))).alias("_at"))
    ids = drawn.join(placed.select("_at", key), "_at").select(key, "draw")
    return df.join(ids, key).select(*df.columns, "draw")


def encode_labels(df: DataFrame, label: str, out: str = "user") -> DataFrame:
    """Class number by alphabetical order of the label."""
    names, size = dimension_index(df.select(label).distinct(), label, "_number")
    dim = names.select(label, F.col("_number").cast("int").alias(out))
    return lookup(df, dim, label, "inner", known_bytes=size)
