from __future__ import annotations

import random
import re

import pytest

from inkprint.llm.decontaminate import contaminated, contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return text.encode().lower().decode()


def brute(docs, items, window):
    wins = {}
    for item, text in items:
        w = WORD.findall(lower(text)) if text else []
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w = WORD.findall(lower(text)) if text else []
        hit, names = set(), set()
        for g, owners in wins.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    names |= owners
        out[doc] = (len(w), len(hit), sorted(names))
    return out


def make(seed):
    r = random.Random(seed)
    vocab = ["a", "B", "Ç", "ñu", "x1", "the", "7", "日本"]
    text = lambda n: r.choice([" ", "\n", "--"]).join(r.choice(vocab) for _ in range(n))
    items = [(k, text(r.randint(0, 7))) for k in range(12)] + [(99, None), (100, "")]
    docs = [(k, text(r.randint(0, 40))) for k in range(30)] + [(200, None), (201, ""), (202, "?!")]
    return docs, items


def test_against_brute_force_with_one_and_many_automata(spark):
    docs, items = make(3)
    want = brute(docs, items, 4)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for shard_bytes in (1 << 20, 60):
        got = contamination(d, b, window=4, shard_bytes=shard_bytes).collect()
        assert len(got) == len(docs)
        for r in got:
            c = r["contamination"]
            assert (c["n_words"], c["n_hit"], c["items"]) == want[r["doc_id"]]


def test_spans_point_into_the_original_text(spark):
    d = spark.createDataFrame([(1, "É Pré, ONE-two: three Ünd")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    r = contamination(d, b).first()
    span = r["contamination"]["spans"][0]
    assert r["text"][span["start"]:span["end"]] == "ONE-two: three"


def test_clashing_column_empty_tables_and_repeated_rows(spark):
    d = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, None)],
                              "doc_id long, text string, contamination string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = contamination(d, none).where(~contaminated()).collect()
    assert len(got) == 3 and all(r["contamination"]["n_hit"] == 0 for r in got)
    assert contamination(d.limit(0), none).count() == 0


def test_one_word_in_twenty(spark):
    b = spark.createDataFrame([(1, "zz")], "item_id long, text string")
    d = spark.createDataFrame([(19, "zz " + "a " * 19), (20, "zz " + "a " * 20)], "doc_id long, text string")
    got = {r["doc_id"]: r["x"] for r in contamination(d, b).select("doc_id", contaminated().alias("x")).collect()}
    assert got == {19: True, 20: False}


@pytest.mark.parametrize("shard_bytes", [1 << 20, 20])
def test_items_without_id_count_but_have_no_name(spark, shard_bytes):
    b = spark.createDataFrame([(None, "one two three"), (None, "seven eight nine"), (7, "one two three"), (8, None)], "item_id long, text string")
    d = spark.createDataFrame([(1, "x seven eight nine y"), (2, "one two three"), (3, "x y")], "doc_id long, text string")
    got = {r["doc_id"]: (r["c"]["n_hit"], r["c"]["items"], r["gone"]) for r in
           contamination(d, b, window=3, shard_bytes=shard_bytes, into="c").withColumn("gone", contaminated("c")).collect()}
    assert got == {1: (3, [], True), 2: (3, ["7"], True), 3: (0, [], False)}
