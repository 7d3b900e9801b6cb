from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from inkprint.operators import parse as ps
from inkprint.sources.chats import load_aliases, read_chats

ANDROID = "12/03/2023, 14:05 - Ann: hello\nthere\n12/03/2023, 14:06 - Bob: hi Ann\n12/03/23, 14:07 - Bob left\n"
IOS = "[1/2/24, 09:08:07] Ann: first\n[1/2/24, 09:09:59] Bob: quoted [1/2/24, 09:08:07] Cat: inner: one\n"


def chats(spark, *texts):
    return spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "chat_id string, value string")


def rows(df):
    return [tuple(r) for r in df.select("chat_id", "pos", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "author", "body")
            .orderBy("chat_id", "pos").collect()]


EXPECTED = [
    ("c0", 0, "2023-03-12 14:05:00", "Ann", "hello there"),
    ("c0", 1, "2023-03-12 14:06:00", "Bob", "hi Ann"),
    ("c0", 2, "2023-03-12 14:07:00", "info", "Bob left\n"),
    ("c1", 0, "2024-02-01 09:08:00", "Ann", "first"),
    ("c1", 1, "2024-02-01 09:09:00", "Bob", "quoted"),
    ("c1", 2, "2024-02-01 09:08:00", "Cat", "inner: one"),
]


def test_both_dialects_and_inner_stamp(spark):
    assert rows(ps.extract_messages(chats(spark, ANDROID, IOS))) == EXPECTED


def test_line_mode_agrees(spark, tmp_path):
    (tmp_path / "a.txt").write_text(ANDROID, encoding="utf-8")
    (tmp_path / "b.txt").write_text(IOS, encoding="utf-8")
    got = rows(ps.extract_folder(spark, str(tmp_path)))
    assert [r[1:] for r in got] == [r[1:] for r in EXPECTED]


def test_line_mode_splits_one_large_file(spark, tmp_path):
    lines = [f"01/02/2024, {i // 60 % 24:02d}:{i % 60:02d} - A{i % 3}: message {i}\nmore {i}" for i in range(4000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = ps.extract_folder(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.pos, r.author, r.body) for r in got] == [
        (i, f"A{i % 3}", f"message {i} more {i}") for i in range(4000)]


def test_carriage_returns_are_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(ANDROID.replace("\n", "\r\n").encode())
    assert [r[1:] for r in rows(ps.extract_folder(spark, str(tmp_path)))] == [r[1:] for r in EXPECTED[:3]]
    assert [r[1:] for r in rows(ps.extract_messages(read_chats(spark, str(tmp_path))))] == [r[1:] for r in EXPECTED[:3]]


def test_unsupported_text(spark):
    bad = chats(spark, "no stamp here")
    with pytest.raises(Exception, match="Format not supported"):
        ps.extract_messages(bad).collect()
    assert ps.extract_messages(bad, strict=False).count() == 0
    assert ps.extract_messages(chats(spark).limit(0)).count() == 0


def test_impossible_date(spark):
    bad = chats(spark, "31/02/2024, 10:00 - Ann: x")
    with pytest.raises(Exception, match="Invalid date|DATETIME"):
        ps.extract_messages(bad).collect()
    assert ps.extract_messages(bad, strict=False).first().ts is None


@pytest.mark.parametrize("compat, body", [(False, "note: buy milk"), (True, "")])
def test_second_colon(spark, compat, body):
    got = ps.extract_messages(chats(spark, "1/1/24, 10:00 - John: note: buy milk"), compat=compat).first()
    assert (got.author, got.body) == ("John", body)


def test_line_start_option(spark):
    text = "1/1/24, 10:00 - Ann: see 1/1/24, 10:00 - Bob: x"
    assert ps.extract_messages(chats(spark, text), line_start=True).count() == 1
    assert ps.extract_messages(chats(spark, text)).count() == 2


def test_aliases(spark, tmp_path):
    path = tmp_path / "alias.json"
    path.write_text('{"Anna": ["Ann", "A."], "Robert": ["Bob", "A."]}', encoding="utf-8")
    aliases = load_aliases(spark, str(path))
    assert {(r.alias, r.canonical) for r in aliases.collect()} == {("Ann", "Anna"), ("Bob", "Robert"), ("A.", "Robert")}
    got = ps.extract_messages(chats(spark, ANDROID, IOS), aliases, placeholder="nobody")
    assert [r[3] for r in rows(got)] == ["Anna", "Robert", "info", "Anna", "Robert", "nobody"]
    got = ps.extract_messages(chats(spark, ANDROID), aliases, compat=True)
    assert [r[3] for r in rows(got)] == ["Anna", "Robert", "other"]
    assert load_aliases(spark, None) is None and load_aliases(spark, str(tmp_path / "none.json")) is None


def test_reading_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_chats(spark, str(tmp_path / "missing"))
    os.makedirs(tmp_path / "empty")
    with pytest.raises(ValueError):
        read_chats(spark, str(tmp_path / "empty"))
