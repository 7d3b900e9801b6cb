from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from inkprint.sources import datasets as ds


def users(spark, *names):
    return spark.createDataFrame(list(enumerate(names)), "user int, author string")


def state(spark, path):
    return {tuple(r) for r in ds.read_registry(spark, path).collect()}


def test_two_writers_of_one_entry_lose_nothing(spark, tmp_path, monkeypatch):
    path, real, other = str(tmp_path / "r"), ds._put_if_absent, []

    def put(session, target, text):
        if not other:  # another writer takes the entry between the look and the put
            other.append(1)
            ds.update_registry(spark, path, users(spark, "Bob"), "m2")
        return real(session, target, text)

    monkeypatch.setattr(ds, "_put_if_absent", put)
    ds.update_registry(spark, path, users(spark, "Ann"), "m1")
    assert state(spark, path) == {("m1", 0, "Ann"), ("m2", 0, "Bob")}
    assert sorted(ds._entries(spark, path)) == [1, 2]


def test_many_writers_and_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ds, "COMPACT_EVERY", 3)
    path = str(tmp_path / "r")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: ds.update_registry(spark, path, users(spark, f"a{k}", f"b{k}"), f"m{k % 5}"), range(10)))
    kept = state(spark, path)
    assert {m for m, _, _ in kept} == {f"m{k}" for k in range(5)} and len(kept) == 10
    assert sorted(ds._entries(spark, path)) == list(range(1, 11))
    assert sorted(ds._entries(spark, path, "snapshot")) == [3, 6, 9]
    for v in range(1, 11):  # a snapshot changes nothing
        with_snapshots = {tuple(r) for r in ds.read_registry(spark, path, v).collect()}
        monkeypatch.setattr(ds, "_entries", lambda s, p, kind="json", real=ds._entries: {} if kind == "snapshot" else real(s, p, kind))
        assert {tuple(r) for r in ds.read_registry(spark, path, v).collect()} == with_snapshots
        monkeypatch.undo()
    ds.compact_registry(spark, path, 9)
    assert state(spark, path) == kept


def test_an_unfinished_writer_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "r")
    ds.update_registry(spark, path, users(spark, "Ann"), "m1")
    ds.register_users(None, users(spark, "Eve"), "m1").write.parquet(f"{path}/data/left-behind")
    assert state(spark, path) == {("m1", 0, "Ann")}
    ds.update_registry(spark, path, users(spark).limit(0), "m1")
    assert state(spark, path) == set()
    assert not ds._put_if_absent(spark, f"{path}/log/0000000001.json", "{}")
    assert not [p for p in (tmp_path / "r" / "log").iterdir() if p.name.endswith("draft")]
    assert ds.read_registry(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(RuntimeError):
        real, ds._ATTEMPTS = ds._ATTEMPTS, 0
        try:
            ds.update_registry(spark, path, users(spark, "Ann"), "m1")
        finally:
            ds._ATTEMPTS = real
