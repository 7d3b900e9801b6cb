from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inkprint.operators import clean as cl
from inkprint.operators import order as od


def messages(spark, rows):
    return spark.createDataFrame(
        [(c, p, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), a, b) for c, p, s, a, b in rows],
        "chat_id long, pos long, ts timestamp, author string, body string")


ROWS = [(1, 0, 0, "info", "group made"), (1, 1, 60, "Ann", "hi"), (1, 2, 50, "Bob", "yo <This message was edited>"),
        (1, 3, 90, "other", "me"), (2, 0, 100, "Ann", "x.pdf (file attached)"), (2, 1, 130, "Bob", "image omitted"),
        (2, 2, 140, "Ann", "more"), (2, 3, 150, "Bob", "end"), (2, 4, 160, "other", "last"), (2, 5, 170, "Ann", "third")]


@pytest.mark.parametrize("scope, expected", [
    ("corpus", [0, 60, 0, 40, 10, 30, 10, 10, 10, 10]), ("chat", [0, 60, 0, 40, 0, 30, 10, 10, 10, 10])])
@pytest.mark.parametrize("block", [2, 1 << 16])
def test_responsiveness(spark, monkeypatch, scope, expected, block):
    monkeypatch.setattr(od.blocked_lag, "__defaults__", (block,))
    got = cl.responsiveness(messages(spark, ROWS), scope).orderBy("chat_id", "pos").collect()
    assert [r.responsiveness for r in got] == expected


def test_chain(spark):
    clean = cl.clean_messages(messages(spark, ROWS))
    assert clean.messages.columns == ["message_id", "responsiveness", "user", "message"]
    users = {r.author: r.user for r in clean.users.collect()}
    assert users == {"Ann": 0, "Bob": 1, "other": 2}
    counts = {r.user: r.n for r in cl.class_counts(clean.messages, clean.users).collect()}
    assert counts == {0: 2, 1: 2, 2: 2}
    assert clean.messages.filter(F.col("message").contains("edited")).isEmpty()
    without = cl.clean_messages(messages(spark, ROWS), remove_placeholder=True)
    assert {r.user for r in without.messages.collect()} == {0, 1}
    with pytest.raises(ValueError, match="no author"):
        cl.clean_messages(messages(spark, ROWS), placeholder="absent", remove_placeholder=True)


def test_class_emptied_by_cleaning_is_an_error(spark):
    rows = [*ROWS, (3, 0, 200, "Dan", "image omitted")]
    with pytest.raises(ValueError, match="no rows"):
        cl.clean_messages(messages(spark, rows))


def test_bad_messages(spark):
    with pytest.raises(KeyError):
        cl.clean_messages(messages(spark, ROWS).drop("body"))
    with pytest.raises(ValueError):
        cl.clean_messages(messages(spark, ROWS).withColumn("ts", F.when(F.col("pos") > 1, F.col("ts"))))


def test_notices_keep_ordinary_text(spark):
    kept = ["Bob left", "he left early", "null", "Luca ha cambiato idea su tutto", "Ann changed the group plan for Monday",
            "She added milk"]
    df = spark.createDataFrame([("\u200eaudio omitted",), ("image omitted",), ("\u200eBob left",), *[(k,) for k in kept]], "body string")
    assert [r.body for r in cl.drop_notices(df).collect()] == kept
    assert cl.drop_notices(df, [r"he .*", " null "]).count() == 7


def test_message_ids_never_collide(spark):
    df = spark.createDataFrame([(1, 5), (2 ** 32 + 1, 5), (2 ** 33 + 1, 5), (-4, 5)], "chat_id long, pos long")
    assert cl.with_message_id(df).select("message_id").distinct().count() == 4
    with pytest.raises(ValueError):
        cl.with_message_id(df.withColumn("pos", F.lit(2 ** 32)))


def test_blank_messages(spark):
    df = spark.createDataFrame([("  a b \n",), (" \t",), ("",)], "body string")
    assert [r.body for r in cl.drop_blank(df).collect()] == ["a b"]


def test_dense_index_needs_no_single_task(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = od.dense_index(df, ["k"], "i").collect()
    assert all(r.k == r.i for r in got) and len(got) == 1000


def test_dimensions_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(od, "BROADCAST_BYTES", 0)
    names = spark.range(500).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("author"))
    assert all(int(r.author) == r.user for r in cl.index_users(names).collect())
    got = cl.responsiveness(messages(spark, ROWS), "corpus").orderBy("chat_id", "pos").collect()
    assert [r.responsiveness for r in got] == [0, 60, 0, 40, 10, 30, 10, 10, 10, 10]


@pytest.mark.parametrize("parts", ["1", "16"])
def test_running_sums_of_a_hot_key(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7).alias("k"),
                                      F.col("id").alias("pos"), F.lit(1).alias("one"))
        a = od.blocked_running_sums(df, ["k"], "pos", {"n": "one"}, block=100)
        b = od.sorted_running_sums(df, ["k"], ["pos"], {"n": "one"})
        assert sorted(map(tuple, a.select("k", "pos", "n").collect())) == sorted(
            map(tuple, b.select("k", "pos", "n").collect()))
        assert a.filter("k = 0").agg(F.max("n")).first()[0] == a.filter("k = 0").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
