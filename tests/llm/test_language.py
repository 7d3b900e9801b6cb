from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkprint.llm import common
from inkprint.llm.language import _viterbi, identify, train


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat and the dog were on that house with", "en"), ("le chat et le chien sont dans la maison avec", "fr"),
            ("кот и собака были в этом доме вместе", "ru"), (None, "en"), ("nothing", None)]
    return train(spark.createDataFrame([(k, *r) for k, r in enumerate(rows * 5)], "doc_id long, text string, lang string"),
                 penalty=6.0)


def labelled(spark, model, texts):
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    return [r["language"] for r in identify(d, model).orderBy("doc_id").collect()]


def test_held_out_accuracy(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    fitted = train(docs.where(~common.held_out("doc_id", 4)))
    out = identify(docs.where(common.held_out("doc_id", 4)), fitted)
    right, n = out.agg(F.sum((F.col("lang") == F.col("language.lang")).cast("int")), F.count("*")).first()
    assert n > 30 and right >= 0.95 * n


def test_texts_without_letters_are_undetermined(spark, model):
    for found in labelled(spark, model, [None, "", "12 ... 7!", " \n"]):
        assert (found["lang"], found["score"], found["spans"]) == ("und", 0.0, [])


def test_scripts_and_spans_of_mixed_text(spark, model):
    text = "the dog and the cat. КОТ и собака были в доме; le chien et le chat"
    found, = labelled(spark, model, [text])
    assert [s["lang"] for s in found["spans"]] == ["en", "ru", "fr"]
    assert text[found["spans"][1]["start"]:found["spans"][1]["end"]] == "КОТ и собака были в доме"
    assert 0 < found["score"] < 1


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(1)
    sizes = [4, 0, 1, 5]
    scores = rng.normal(size=(sum(sizes), 3)).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(sizes)])
    got = _viterbi(scores, first, 0.7)
    for a, b in zip(first[:-1], first[1:]):
        worth = lambda p: sum(scores[a + k, x] for k, x in enumerate(p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:]))
        best = max((worth(p) for p in itertools.product(range(3), repeat=b - a)), default=0)
        assert worth(tuple(got[a:b])) == pytest.approx(best, abs=1e-4)


def test_without_training_rows_everything_is_undetermined(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    nothing = train(empty)
    d = spark.createDataFrame([(1, "some text", "kept")], "doc_id long, text string, language string")
    r = identify(d, nothing).first()
    assert r["language"]["lang"] == "und" and r["text"] == "some text"
    assert identify(d.limit(0), nothing).count() == 0


def test_very_long_text_and_repeated_rows(spark, model):
    long = "the cat and the dog " * 40_000
    a, b, c = labelled(spark, model, [long, "le chat", "le chat"])
    assert a["lang"] == "en" and len(a["spans"]) == 1 and b == c and b["lang"] == "fr"
