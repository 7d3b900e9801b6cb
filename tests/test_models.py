from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from inkprint.config import FeatureConfig, config_or_default, model_name, placeholder_policy
from inkprint.operators import models as md
from inkprint.operators import search as se
from inkprint.operators.stack import Stack
from inkprint.plans.dataset import build_dataset
from inkprint.plans.scoring import score_messages
from inkprint.plans.training import train
from inkprint.sources import datasets as ds


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [(i, i % 3, float(i % 3) + rng.gauss(0, 0.2), rng.random(), 1.0,
             [float(i % 3 == c) + rng.gauss(0, 0.2) for c in range(3)]) for i in range(180)]
    return spark.createDataFrame(
        data, "message_id long, user int, a double, b double, c double, embedding array<double>").cache()


@pytest.mark.parametrize("name, params", [
    ("random_forest", {"numTrees": 10}), ("naive_bayes", {}), ("svc", {"maxIter": 20}),
    ("neural_network", {"maxIter": 60}), ("gradient_boosting", {"maxIter": 4}), ("extra_trees", {"numTrees": 10}),
    ("kneighbors", {})])
def test_every_classifier(rows, name, params):
    run = md.train_feature_model(rows.drop("embedding"), name, **params)
    assert run.accuracy() > 0.85
    first = run.scored.first()
    assert len(first.probability) == 3 and abs(sum(first.probability) - 1) < 1e-6
    assert run.scored.count() == 36


def test_a_forest_keeps_the_nodes_of_its_rows(rows):
    deep = md.fit_classifier(rows.drop("embedding"), "random_forest", numTrees=3)
    walked = md.fit_classifier(rows.drop("embedding"), "random_forest", numTrees=3, cacheNodeIds=False)
    assert deep.model.stages[-1].getCacheNodeIds() and not walked.model.stages[-1].getCacheNodeIds()
    assert deep.model.stages[-1].toDebugString.split("\n")[1:] == walked.model.stages[-1].toDebugString.split("\n")[1:]


def test_binary_boosting_and_svc(rows):
    two = rows.filter("user < 2").drop("embedding")
    for name, params in (("gradient_boosting", {"maxIter": 4}), ("svc", {"maxIter": 20})):
        scored = md.fit_classifier(two, name, **params).predict(two)
        assert scored.filter("user = prediction").count() > 110


def test_unknown_classifier(rows):
    with pytest.raises(ValueError):
        md.train_feature_model(rows, "oracle")


def test_save_and_load(spark, rows, tmp_path):
    plain = rows.drop("embedding")
    path = str(tmp_path / "model_x")
    model = md.fit_classifier(plain, "gradient_boosting", maxIter=2)
    model.save(path)
    again = md.Fitted.load(spark, path).predict(plain).orderBy("message_id").select("prediction").collect()
    assert again == model.predict(plain).orderBy("message_id").select("prediction").collect()
    with pytest.raises(ValueError, match="already exists"):
        model.save(path)
    model.save(path, overwrite=True)


def test_importance_and_cross_validation(rows):
    model = md.fit_classifier(rows.drop("embedding"), "random_forest", numTrees=10)
    top = md.feature_importance(model, n=2).collect()
    assert top[0].feature == "a" and [r["rank"] for r in top] == [1, 2]
    assert md.feature_importance(md.fit_classifier(rows.drop("embedding"), "naive_bayes")) is None
    scores = md.cross_validate(rows.drop("embedding"), "naive_bayes", 3).collect()
    assert len(scores) == 12 and all(r.value > 0.8 for r in scores)


def test_evolution_improves_and_stays_in_range():
    def score(genes):
        return [-abs(g["learning_rate"] - 0.2) - abs(g["subsample"] - 0.7) - abs(g["reg_alpha"] - 3) / 10 for g in genes]

    log = se.evolve(score, population=12, generations=8)
    mean = lambda n: sum(r["score"] for r in log if r["generation"] == n) / sum(r["generation"] == n for r in log)
    assert mean(7) > mean(0) + 0.1
    assert max(r["score"] for r in log if r["generation"] > 0) >= max(r["score"] for r in log if r["generation"] == 0) - 0.05
    assert all(se.SEARCH_SPACE[k][0] <= v <= se.SEARCH_SPACE[k][1] for r in log for k, v in r["genes"].items())


def test_whole_training_and_scoring(spark, rows, tmp_path):
    features, embeddings = rows.drop("embedding"), rows.select("message_id", "user", "embedding")
    space = {**se.SEARCH_SPACE, "n_estimators": (2, 3), "max_depth": (3, 3)}
    run = train(features, embeddings, folds=2, epochs=3, feature_args={"numTrees": 5},
                meta_args={"space": space, "population": 2, "generations": 1, "folds": 2})
    assert run.holdout.accuracy.first().accuracy > 0.8
    assert run.holdout.scored.count() == 27 and run.embedding.history.count() == 3
    run.stack.save(str(tmp_path / "stack"))
    stack = Stack.load(spark, str(tmp_path / "stack"))
    messages = rows.select("message_id", F.lit(1).alias("chat_id"), F.col("message_id").alias("pos"),
                           F.lit("text").alias("message"))
    pick = lambda cols: (lambda df: df.select("message_id").join(rows.select("message_id", *cols), "message_id"))
    out = score_messages(messages, stack, pick(["a", "b", "c"]), pick(["embedding"]))
    assert out.count() == 540
    last = out.filter("pos = 179").agg(F.sum("average")).first()[0]
    assert abs(last - 1) < 1e-6


def test_training_arguments(rows):
    with pytest.raises(ValueError):
        train(rows, mode="all")
    with pytest.raises(ValueError):
        train(None, rows, mode="both")
    with pytest.raises(ValueError):
        train(rows, None, mode="embeddings")


def test_names_and_policies(spark, tmp_path):
    assert placeholder_policy(False, "delete") == ("other", False)
    assert placeholder_policy(True) == ("other", False)
    assert placeholder_policy(True, "delete") == ("other", True)
    assert placeholder_policy(True, "rename", "rest") == ("rest", False)
    assert placeholder_policy(True, "rename", "rest", compat=True) == ("rest", True)
    assert model_name("meta", "meta_a") == "meta_a" and model_name("model", "a") == "model_a"
    (tmp_path / "mine.json").write_text("{}")
    assert config_or_default(spark, str(tmp_path), "mine") == "mine.json"
    assert config_or_default(spark, str(tmp_path), "absent") == "config.json"


CHAT = "".join(f"01/02/2024, 10:{i:02d} - {'Ann' if i % 2 else 'Bob'}: message number {i}\n" for i in range(20))


def test_dataset_is_cached(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "chat.txt").write_text(CHAT)
    config = FeatureConfig.only("char_count", "bag_of_words")
    args = {"chats": str(tmp_path / "in"), "config": config}
    out = str(tmp_path / "out")
    made = build_dataset(spark, out, "x", **args)
    assert made.features.count() == 20 and made.embeddings.count() == 20
    assert {r.author for r in ds.read_users(spark, f"{out}/users_x.json").collect()} == {"Ann", "Bob"}
    (tmp_path / "in" / "chat.txt").write_text(CHAT + "01/02/2024, 11:00 - Ann: a\n01/02/2024, 11:00 - Bob: b\n")
    assert build_dataset(spark, out, "x", **args).features.count() == 20
    assert build_dataset(spark, out, "x", refactor=True, **args).features.count() == 22
    with pytest.raises(ValueError):
        build_dataset(spark, out, "x", features=False, embeddings=False)
    with pytest.raises(TypeError):
        build_dataset(spark, out, "x", refactor="yes", **args)
    with pytest.raises(FileNotFoundError):
        ds.read_dataset(spark, f"{out}/absent")


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    make = lambda *names: spark.createDataFrame(list(enumerate(names)), "user int, author string")
    assert ds.read_registry(spark, path).count() == 0
    ds.update_registry(spark, path, make("Ann", "Bob"), "m1")
    ds.update_registry(spark, path, make("Cat"), "m2")
    ds.update_registry(spark, path, make("Dan"), "m1")
    assert {tuple(r) for r in ds.read_registry(spark, path).collect()} == {("m1", 0, "Dan"), ("m2", 0, "Cat")}


def test_neighbors_and_author_names_are_saved(spark, rows, tmp_path):
    plain = rows.drop("embedding")
    model = md.fit_classifier(plain, "kneighbors")
    model.save(f"{tmp_path}/knn")
    again = md.load_model(spark, f"{tmp_path}/knn")
    key = lambda m: sorted(tuple(r) for r in m.predict(plain).select("message_id", "prediction").collect())
    assert key(again) == key(model)
    with pytest.raises(ValueError):
        model.save(f"{tmp_path}/knn")
    users = spark.createDataFrame([("Ann", 0), ("Bob", 1), ("Cy", 2)], "author string, user int")
    network = md.train_embedding_model(rows, epochs=2).model
    Stack(model, network, md.fit_classifier(plain, "naive_bayes"), users).save(f"{tmp_path}/stack")
    loaded = Stack.load(spark, f"{tmp_path}/stack")
    named = loaded.with_authors(spark.range(3).select(F.col("id").cast("int").alias("user"))).orderBy("user")
    assert [r["author"] for r in named.collect()] == ["Ann", "Bob", "Cy"]


def test_search_queries_run_the_whole_search(spark, monkeypatch, sf_dir):
    """m19 and m20 leave the space and the sizes of the search to the operator; the stack of m21, v8, t1 and t2 is one fit."""
    from inkprint.catalog import models as cat
    from inkprint.plans import training
    calls = []
    empty = spark.createDataFrame([], "generation long, candidate long, score double")
    stop = RuntimeError("searched")

    def searched(df, *args, **kwargs):
        calls.append(kwargs)
        if kwargs.get("seed") is None:
            return {}, empty
        raise stop

    meta = spark.createDataFrame([(i, i % 2, 0.1 * i) for i in range(40)], "message_id long, user int, a double")
    monkeypatch.setattr(cat, "_meta_table", lambda *_: meta)
    monkeypatch.setattr(cat, "search", searched)
    monkeypatch.setattr(training, "search", searched)
    cat.m19(spark, sf_dir)
    with pytest.raises(RuntimeError, match="searched"):
        cat.m20(spark, sf_dir)
    assert len(calls) == 2 and not any({"space", "population", "generations", "folds", "meta_args"} & set(c) for c in calls)


def test_search_assigns_the_folds_once(rows, monkeypatch):
    made, real = [], se.assign_folds
    monkeypatch.setattr(se, "assign_folds", lambda *a, **k: made.append(1) or real(*a, **k))
    space = {**se.SEARCH_SPACE, "n_estimators": (2, 3), "max_depth": (3, 3), "subsample": (1, 1), "colsample": (1, 1)}
    two = rows.filter("user < 2").drop("embedding")
    best, log = se.search(two, space=space, population=2, generations=2, folds=2)
    assert len(made) == 1 and log.count() == 3
    again = md.cross_validate(two, "gradient_boosting", 2, **best).filter("metric = 'accuracy'").agg({"value": "avg"}).first()[0]
    assert again == pytest.approx(max(r["score"] for r in log.collect()))


@pytest.mark.parametrize("name", ["m6", "m18"])
def test_boosted_queries_fit_whole_models_and_score_other_rows(spark, monkeypatch, sf_dir, name):
    from inkprint.catalog import models as cat
    fits, real = [], md.fit_classifier

    def fit(df, learner, *args, **params):
        if learner != "gradient_boosting":
            return real(df, learner, *args, **params)
        fits.append(({r["message_id"] for r in df.select("message_id").collect()}, params))
        return real(df, "naive_bayes", *args, **params)

    monkeypatch.setattr(md, "fit_classifier", fit)
    scored = {r["message_id"] for r in getattr(cat, name)(spark, sf_dir).collect()}
    (fitted, params), = fits
    assert set(params) == {"n_classes"} and scored and fitted and not scored & fitted
