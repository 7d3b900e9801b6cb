from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from inkprint.operators import joins as jn
from inkprint.operators import sampling as sm


def skewed(spark, n=900):
    """Class 0 holds two thirds of the rows."""
    return spark.range(n).select(F.col("id").alias("message_id"),
                                 F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 4 + 1).cast("int").alias("user"))


def counts(df, *by):
    return {tuple(r)[:-1]: r[-1] for r in df.groupBy(*by).count().collect()}


def test_undersample_takes_the_smallest_keys(spark):
    df = skewed(spark)
    small = min(counts(df, "user").values())
    got = sm.undersample(df)
    assert set(counts(got, "user").values()) == {small}
    key = lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest()
    for user in (0, 1):
        ids = sorted((r.message_id for r in df.filter(F.col("user") == user).collect()), key=key)[:small]
        assert {r.message_id for r in got.filter(F.col("user") == user).collect()} == set(ids)


def test_undersample_with_an_absent_class(spark):
    classes = spark.createDataFrame([(0,), (9,)], "user int")
    with pytest.raises(ValueError):
        sm.undersample(skewed(spark), classes=classes)


@pytest.mark.parametrize("n, size, test", [(10, 0.2, 2), (11, 0.2, 3), (100, 0.15, 15), (3, 0.0, 0)])
def test_split_sizes(spark, n, size, test):
    got = counts(sm.split(spark.range(n).withColumnRenamed("id", "message_id"), size), "split")
    assert got.get(("test",), 0) == test and sum(got.values()) == n


def test_stratified_split(spark):
    df = skewed(spark)
    got = sm.train_val_test(df, test_size=0.2, val_size=0.25)
    whole = counts(got, "split")
    assert whole == {("test",): 180, ("val",): 180, ("train",): 540}
    for (user, _), n in counts(got, "user", "split").items():
        assert n > 0
    for user, n in counts(df, "user").items():
        assert abs(counts(got.filter("split = 'test'"), "user")[user] - n * 0.2) < 1
    assert set(counts(sm.train_val_test(df, test_size=0.0), "split")) == {("val",), ("train",)}


def test_folds(spark):
    got = counts(sm.assign_folds(spark.range(23).withColumnRenamed("id", "message_id"), 5), "fold")
    assert [got[(i,)] for i in range(5)] == [5, 5, 5, 4, 4]
    with pytest.raises(ValueError):
        sm.assign_folds(spark.range(3).withColumnRenamed("id", "message_id"), 5)


@pytest.mark.parametrize("parts", [1, 13])
def test_choice_does_not_depend_on_partitions(spark, parts):
    df = skewed(spark)
    assert sorted(map(tuple, sm.undersample(df.repartition(parts)).collect())) == sorted(
        map(tuple, sm.undersample(df).collect()))


def test_balanced_resample(spark):
    got = counts(sm.balanced_resample(skewed(spark, 9000)), "user")
    per_class = 9000 / len(got)
    assert sum(got.values()) == 9000
    assert all(abs(n - per_class) < 0.2 * per_class for n in got.values())
    rare = spark.range(1001).select(F.col("id").alias("message_id"), (F.col("id") == 0).cast("int").alias("user"))
    got = counts(sm.balanced_resample(rare), "user")
    assert 350 < got[(1,)] < 650  # one row drawn some 500 times


def test_lookup_beyond_the_broadcast_bound(spark):
    big = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    small = jn.lookup(big, dim, "k")
    salted = jn.lookup(big, dim, "k", size=0)
    assert sorted(map(str, small.select("k", "v", "name").collect())) == sorted(
        map(str, salted.select("k", "v", "name").collect()))


def test_weights(spark):
    got = {r.user: r for r in sm.class_weights(skewed(spark)).collect()}
    assert abs(sum(r.norm_weight for r in got.values()) - len(got)) < 1e-9
    assert got[0].weight == 1 / 600
