from __future__ import annotations

import random

from pyspark.sql import functions as F

from inkprint.llm.toxicity import (_COUNTS, CLASSES, GRAMMAR, HARM, INSULT, Model, Reader, Transducer, _aimed, detect, grammar, op12, train)

MODEL = Model({"blorp": 5.0, "zurg*": 4.0}, grammar())


def weight(text):
    return sum(m[3] for m in Reader(MODEL).matches(text))


def test_grammar_by_hand():
    assert weight("what a blorp day") == 5
    assert abs(weight("you blorp") - 6) < 1e-6 and abs(weight("a blorp are you") - 6) < 0.01  # aimed, from either side
    assert weight("not a blorp") == 0 and weight("you are not a blorp, you blorp") > 5
    assert weight('she said blorp') == 5 + GRAMMAR["you"] + GRAMMAR["said"]  # "she" is a person meant
    assert weight("it says blorp") == 5 + GRAMMAR["said"]
    assert weight("never. blorp") == 5  # a clause ends there
    assert weight("I will kill you") == 4 - 0.001 and weight("he will kill time") == 4 and weight("to kill time") == 0
    assert weight("zurgish Zurgs") == 8 and weight("zurg") == 0
    assert weight("") == 0 and weight("...") == 0 and weight("word " * 200_000) == 0


def test_best_path_equals_all_paths():
    rnd = random.Random(5)
    machine = grammar()
    for _ in range(300):
        symbols = [rnd.choice(CLASSES) for _ in range(rnd.randint(1, 8))]
        symbols.append("end")
        gains = [3.0 if s == "insult" else 0.0 for s in symbols]
        want = max(w + sum(g for g, y in zip(gains, out) if y in _COUNTS) for w, out in machine.paths(symbols))
        assert abs(machine.best(symbols, gains, _COUNTS)[0] - want) < 1e-9


def test_composition_equals_one_after_the_other():
    a = Transducer([{"x": [("y", 1.0, 1), ("x", 0.0, 0)]}, {"x": [("z", 2.0, 0)]}], [0, 1])
    b = Transducer([{"y": [("q", 0.5, 0)], "z": [("z", 0.0, 1)]}, {"y": [("r", 4.0, 1)]}], [0, 0])
    both = a.compose(b)
    for symbols in (["x"], ["x", "x", "x"], ["x", "u", "x", "x"]):
        want = sorted((w + v, out) for w, mid in a.paths(symbols) for v, out in b.paths(mid))
        assert sorted(both.paths(symbols)) == want


def test_aimed_paths_need_their_target():
    machine = _aimed(2)
    assert (-0.001, ["insult-you", "other", "target", "end"]) in machine.paths(["insult", "other", "target", "end"])
    for symbols in (["insult", "end"], ["insult", "other", "other", "target", "end"]):
        assert all(w < -50 or "insult-you" not in out for w, out in machine.paths(symbols))


def labelled(spark, n=400):
    rnd = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        words = [rnd.choice(["sun", "moon", "tree", "river", "stone", "cloud"]) for _ in range(30)]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words[rnd.randrange(30)] = rnd.choice(["Glorf", "vexil" + rnd.choice("abcdefgh"), "snark!"])
        rows.append((k, " ".join(words) + "."))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_stems(spark):
    docs, labels = labelled(spark)
    model = train(docs.where("doc_id < 300"), labels)
    assert {"glorf", "snark"} <= set(model.terms) and any(t.startswith("vexi") and "*" in t for t in model.terms)
    got = detect(docs.where("doc_id >= 300"), model).join(labels, "doc_id").collect()
    assert all((r["toxicity"]["score"] >= 0.7) == (r["toxic"] == 1) for r in got)
    text = {r["doc_id"]: r for r in got if r["toxic"]}
    for r in text.values():
        for m in r["toxicity"]["matches"]:
            assert m["kind"] == "insult" and any(w in r["text"][m["start"]:m["end"]].lower() for w in ("glorf", "vexil", "snark"))


def test_odd_rows(spark):
    docs, labels = labelled(spark, 100)
    odd = spark.createDataFrame([(None, None), (1000, ""), (1001, " \n"), (1002, "glorf " * 100_000), (1002, "ééé 漢字 🙂")], "doc_id long, text string")
    model = train(docs, labels.union(labels.limit(3)).union(spark.createDataFrame([(None, 1), (5, None), (7, 9)], "doc_id long, toxic int")), least=2)
    got = detect(docs.union(odd).withColumn("toxicity", F.lit(0)).withColumn("start", F.lit("x")), model).collect()
    assert len(got) == 105 and all(0 <= r["toxicity"]["score"] <= 1 for r in got)
    plain = {r["toxicity"]["score"] for r in got if r["text"] in (None, "", " \n")}
    assert len(plain) == 1 and plain.pop() < 0.5
    assert detect(docs.limit(0), model).count() == 0
    none = train(docs, labels.limit(0))
    assert none.terms == {} and all(r["toxicity"]["score"] == 0.5 for r in detect(docs, none).collect())


def test_query_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = op12(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r for r in got if r["toxic"] == 1], [r for r in got if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)  # a twentieth of the labelled texts holds nothing toxic
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert HARM < INSULT
