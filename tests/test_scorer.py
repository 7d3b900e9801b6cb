from __future__ import annotations

import math
import random
import re
from collections import Counter

from inkprint.operators.scorer import classify_words, fit_text_scorer, fit_word_classes, score_text


def texts(seed=1, n=120):
    rnd = random.Random(seed)
    kinds = [["good", "sun", "été"], ["bad", "rain", "été"], ["odd", "moon", "sun"]]
    return [(k, " ".join(rnd.choice(kinds[k % 3] + ["the", "a1"]) for _ in range(rnd.randint(0, 9))), k % 3) for k in range(n)] \
        + [(500, None, 0), (501, "", 1), (502, "unknown words only", None)]


def brute(train, text):
    words = lambda t: re.findall(r"\w\w+", (t or "").lower())
    counts = {c: Counter(w for _, t, y in train if y == c for w in words(t)) for c in range(3)}
    known = set().union(*counts.values())
    docs = Counter(y for _, _, y in train if y is not None)
    scores = [round(math.log(docs[c] / sum(docs.values())) + sum(
        math.log((counts[c][w] + 1) / (sum(counts[c].values()) + len(known))) for w in words(text) if w in known), 6) for c in range(3)]
    return scores.index(max(scores))


def test_naive_bayes_equals_a_plain_version(spark):
    rows, held = texts(), texts(seed=9, n=60)
    df = spark.createDataFrame(rows, "message_id long, message string, c int")
    model = fit_word_classes(df, "c", 3)
    other = spark.createDataFrame(held, "message_id long, message string, c int")
    got = {r["message_id"]: r["said"] for r in classify_words(other, model, "said").collect()}
    assert got == {k: brute(rows, t) for k, t, _ in held}
    assert sum(got[k] == y for k, t, y in held if t) > 0.8 * sum(bool(t) for _, t, _ in held)


def test_joined_models_say_the_same(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "message_id long, message string, c int")
    model = fit_word_classes(df, "c", 3)
    small = classify_words(df, model, "said").orderBy("message_id").collect()
    model.stored_bytes = 1 << 40  # too large to broadcast
    assert classify_words(df, model, "said").orderBy("message_id").collect() == small


def test_only_rare_words_are_joined(spark):
    rows = [*texts(), *[(1000 + k, f"rare{k} the sun rare{k}", k % 3) for k in range(300)]]
    df = spark.createDataFrame(rows, "message_id long, message string, c int")
    model = fit_word_classes(df, "c", 3)
    want = classify_words(df, model, "said").orderBy("message_id").collect()
    assert {r["message_id"]: r["said"] for r in want} == {k: brute(rows, t) for k, t, _ in rows}
    for limit in (0, 400, 2000):
        model.stored_bytes = limit + 1
        made = classify_words(df, model, "said", broadcast_bytes=limit)
        assert made.orderBy("message_id").collect() == want
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" not in plan and "UnionLoop" not in plan and "Union" in plan


def test_logistic_scorer(spark):
    df = spark.createDataFrame([r for r in texts() if r[2] in (0, 1)], "message_id long, message string, c int")
    scored = score_text(df, fit_text_scorer(df, "c"), "said").collect()
    assert sum(r["said"] == r["c"] for r in scored) > 0.75 * len(scored)
