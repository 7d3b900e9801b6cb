from __future__ import annotations

import random
import re

import numpy as np

from inkprint.llm.graph import components
from inkprint.llm.neardup import near_duplicates
from inkprint.llm.shingles import Darts, shingle_sets

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def shingles(text, width=5):
    w = WORD.findall((text or "").encode().lower())
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def classes(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def variants(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    docs = []
    for base in range(12):
        words = [word() for _ in range(r.choice([3, 30, 120, 300]))]
        for _ in range(r.randint(1, 6)):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                copy[r.randrange(len(copy))] = word()
            docs.append((len(docs) * 7 % 101, " ".join(copy).upper() if r.random() < 0.3 else ", ".join(copy)))
    return [*docs, (500, None), (501, ""), (502, "?!"), (503, "?!"), (504, "One"), (505, "one.")]


def test_against_brute_force(spark):
    docs = variants()
    sets = {k: shingles(t) for k, t in docs}
    near = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
            and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    want = classes(near, sets)
    for weigh in (False, True):
        got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), weigh=weigh).collect()
        assert {r["doc_id"]: r["class_id"] for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_ids_that_are_null_or_repeat_and_extra_columns(spark):
    text = "a b c d e f g h"
    d = spark.createDataFrame([(None, text, 1), (3, text, 1), (3, text, 1), (3, "other words", 2), (9, text, 1), (7, "other words", 0)],
                              "doc_id long, text string, node int")
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_duplicates(d).collect()}
    assert got == {None: (None, True), 3: (3, True), 9: (3, False), 7: (3, False)}
    assert near_duplicates(d.limit(0)).count() == 0


def test_darts_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(0)
    elements = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    x, y = elements[:200], elements[50:260]
    darts = Darts(512)
    same = lambda s: (s[0] == s[1]).mean()
    assert abs(same(darts.signatures([x, y])) - 150 / 260) < 0.09
    wx, wy = rng.integers(1, 4, 200) * 1.0, rng.integers(1, 4, 210) * 0.5
    both = dict(zip(x.tolist(), wx)), dict(zip(y.tolist(), wy))
    keys = set(both[0]) | set(both[1])
    weighted = sum(min(b.get(k, 0) for b in both) for k in keys) / sum(max(b.get(k, 0) for b in both) for k in keys)
    assert abs(same(darts.signatures([x, y], [wx, wy])) - weighted) < 0.09
    big = rng.integers(0, 2 ** 63, 400_000).astype(np.uint64)  # more elements than are thrown at once
    assert same(darts.signatures([big, big[::-1].copy()])) == 1.0


def test_shingle_sets():
    (a, n), (b, _), (c, _), (d, _) = shingle_sets([b"a b c d e a b c d e", b"A b", None, b"a, b"])
    assert len(a) == 5 and n.sum() == 6 and len(b) == 1 and len(c) == 0 and b.tolist() == d.tolist()


def test_components_of_random_graphs_and_a_chain(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, None)]
    real = [(a, b) for a, b in edges if b is not None and a != b]
    want = classes(real, {x for e in real for x in e})
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {x["id"]: x["component"] for x in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
