from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from inkprint.llm.lm import _Tokens, score, train, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall((text or "").encode().lower().decode()) + [""]


TEXTS = ["The cat sat", "the CAT ran\tfar", "É ß the\n\ncat sat on", "", None, "x" * 200 + " the", "\x0bthe\x0c"]


def brute(train_texts, text):
    c = Counter(w for t in train_texts for w in tokens(t))
    n, v = sum(c.values()), len(c)
    w = tokens(text)
    return len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_base_score_is_exact_with_any_head(spark, head):
    d = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id int, text string")
    model = train(d, head_words=head)
    other = spark.createDataFrame([(k, t) for k, t in enumerate([*TEXTS, "the unseen cat " + "y" * 90, "the the"])],
                                  "doc_id int, text string")
    rows = score(other, model).orderBy("doc_id").collect()
    for r, text in zip(rows, [*TEXTS, "the unseen cat " + "y" * 90, "the the"]):
        n, known, base = brute(TEXTS, text)
        assert (r["lm"]["n_tokens"], r["lm"]["n_known"]) == (n, known)
        assert r["lm"]["base_score"] == pytest.approx(base)
        assert r["lm"]["score"] < 0


def test_filter_never_loses_a_count_level(spark):
    texts = ["a b c d"] * 30 + ["b c"] * 5 + ["z q"]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), bits_per_item=16.0)
    t = _Tokens([words_of(b"a b c d")], 2)
    assert model.ngrams.counts(t.words)[t.codes][1:5].tolist() >= [25.0, 30.0, 30.0, 25.0]
    assert (model.ngrams.counts(t.grams[1][1:]) >= 20).all()  # 30 is stored as its level of base 1.5


def test_small_filter_keeps_the_frequent(spark):
    texts = ["a b"] * 200 + [f"w{k} v{k}" for k in range(3000)]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), max_bytes=2048)
    assert model.ngrams.lowest > 1 and len(model.ngrams.bits) <= 8192 * 2
    t = _Tokens([words_of(b"a b")], 2)
    assert (model.ngrams.counts(t.grams[1][1:2]) >= 100).all()


def test_familiar_text_scores_higher(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log"] * 20
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"))
    d = spark.createDataFrame([(1, "the cat sat on the log"), (2, "log the on sat cat the")], "doc_id int, text string")
    got = {r["doc_id"]: r["lm"] for r in score(d, model).collect()}
    assert got[1]["score"] > got[2]["score"] and got[1]["base_score"] == pytest.approx(got[2]["base_score"])


def test_without_training_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "text string")
    d = spark.createDataFrame([(1, "a b", 2), (1, "a b", 2), (None, None, None)], "doc_id int, text string, lm int")
    rows = score(d, train(empty)).collect()
    assert [r["lm"]["n_known"] for r in rows] == [0, 0, 0] and {r["lm"]["base_score"] for r in rows} == {0.0}
    assert score(d.limit(0), train(d)).count() == 0


def exact_score(train_texts, text, order, base=1.5, strength=100.0):
    """The score from exact counts, each replaced by what its level stands for."""
    counts = Counter()
    for t in train_texts:
        w = [None, *tokens(t)]
        counts.update(tuple(w[k:k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1))
    vocabulary = Counter(w for t in train_texts for w in tokens(t))

    def quantised(gram):
        c = counts[gram]
        if not c:
            return 0.0
        q = math.floor(math.log(c) / math.log(base) + 1e-9)
        low, high = math.ceil(base ** q - 1e-6), math.ceil(base ** (q + 1) - 1e-6) - 1
        return max(1.0, (low + high) / 2)

    w, total = [None, *tokens(text)], 0.0
    for k in range(1, len(w)):
        c = quantised((w[k],))
        p = (c + 1) / (sum(vocabulary.values()) + len(vocabulary) + 1)
        history = [quantised((w[j],)) for j in range(len(w))]
        shorter = [quantised((x,)) for x in w]
        for n in range(2, order + 1):
            longer = [min(quantised(tuple(w[j - n + 1:j + 1])), shorter[j - 1]) if j >= n - 1 else 0.0 for j in range(len(w))]
            if k >= n - 1:
                p = (longer[k] + strength * p) / (shorter[k - 1] + strength)
            shorter = longer
        total += math.log10(p)
    return total


@pytest.mark.parametrize("order, max_bytes", [(2, 2048), (3, 2048), (2, 64), (2, 1 << 20)])
def test_no_count_is_lost_beyond_the_filter(spark, order, max_bytes):
    rare = [f"w{k} v{k} u{k % 50}" for k in range(1500)]
    texts = ["a b a c"] * 200 + rare + rare[:700] + rare[:300]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), order=order, max_bytes=max_bytes, bits_per_item=24.0)
    assert (model.ngrams.lowest > 1) == (max_bytes < 1 << 20)
    asked = [*rare[:1500:100], "a b w3 v3 u3 a", "w1 unseen v1", "unseen", "", None, "b a c"]
    d = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string").repartition(3)
    got = {r["doc_id"]: r["lm"]["score"] for r in score(d, model).collect()}
    assert len(got) == len(asked)
    for k, text in enumerate(asked):
        assert got[k] == pytest.approx(exact_score(texts, text, order), rel=1e-9), text
