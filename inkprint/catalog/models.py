"""Training and prediction."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import functions as F

from inkprint.catalog.base import docs, label_rows, query, r6, table, vectors
from inkprint.catalog.joining import KNN, knn_table
from inkprint.config import FeatureConfig
from inkprint.functions import probs as pr
from inkprint.operators import evaluate as ev
from inkprint.operators import models as md
from inkprint.operators.embed import embed_hashed, vector_to_columns
from inkprint.operators.features import build_features
from inkprint.operators.neighbors import knn_predict, knn_votes
from inkprint.operators.randomtrees import TreeParams, fit_random_trees
from inkprint.operators.sampling import split
from inkprint.operators.search import search
from inkprint.operators.stack import Stack, meta_inputs, stack_oof
from inkprint.plans.training import train, train_meta
from inkprint.session import materialize, path_exists, shared_folder

STYLE = FeatureConfig.only(
    "uppercase_count", "char_count", "word_length", "message_composition", "englishness", "type_token_ratio",
    "simpsons_index", "readability", "functional_words", "common_words")


def wide_vectors(spark, d):
    return vector_to_columns(vectors(spark, d), 64, "mean")


def labelled(spark, d):
    """Every document that carries a quality label."""
    return docs(spark, d).select("message_id", "message").join(label_rows(spark, d), "message_id")


def _kept(spark, d: str, name: str) -> str:
    """A folder of this application, named by what is in it and by its input."""
    text = f"{name} {d} {spark.sparkContext.applicationId}"
    return f"{shared_folder(spark)}/inkprint-{name}-{sha256(text.encode()).hexdigest()[:16]}"


def _written(df, path: str):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quality_tables(spark, d):
    """Feature and embedding table of the labelled documents, written once for an application."""
    path = _kept(spark, d, "quality")
    if not path_exists(spark, f"{path}/vectors/_SUCCESS"):
        rows = materialize(labelled(spark, d), "labelled")
        _written(build_features(rows, STYLE), f"{path}/style")
        _written(embed_hashed(rows, "mean"), f"{path}/vectors")
    return spark.read.parquet(f"{path}/style"), spark.read.parquet(f"{path}/vectors")


def trained_stack(spark, d):
    """(stack, scored holdout), trained, saved and written once for an application. Its meta model is one fit on the out-of-fold rows."""
    path = _kept(spark, d, "stack")
    if not path_exists(spark, f"{path}/scored/_SUCCESS"):
        users = table(spark, d, "labels").select(F.col("quality").alias("user")).distinct() \
            .select(F.concat(F.lit("quality "), "user").alias("author"), "user")
        run = train(*quality_tables(spark, d), users=users, meta_args={"parameters": {}})
        run.stack.save(f"{path}/stack", overwrite=True)
        _written(run.holdout.scored, f"{path}/scored")
    return Stack.load(spark, f"{path}/stack"), spark.read.parquet(f"{path}/scored")


def _held_out(spark, d, name: str, **params):
    rows = materialize(split(wide_vectors(spark, d)), "split")
    model = md.fit_classifier(rows.filter("split = 'train'").drop("split"), name, n_classes=10, **params)
    return model.predict(rows.filter("split = 'test'").drop("split")).select("message_id", "user", "prediction")


@query("m2_random_forest")
def m2(spark, d):
    return _held_out(spark, d, "random_forest")


_GAUSS = """
WITH p AS (SELECT label, i, avg(v) AS mu, var_pop(v) AS var, count(*) AS n FROM (
        SELECT label, i, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) r(i)) GROUP BY label, i),
s AS (SELECT vec_id, p.label, ln(any_value(n) / (SELECT count(*) FROM embeddings)::DOUBLE)
             + sum(-0.5 * (ln((var + 1e-9) * 6.283185307179586) + (embedding[i + 1]::DOUBLE - mu) ** 2 / (var + 1e-9))) AS score
      FROM embeddings, p GROUP BY vec_id, p.label)"""


@query("m3_gaussian_scores", _GAUSS + "SELECT vec_id AS message_id, label AS class, round(score, 4) AS score FROM s")
def m3_scores(spark, d):
    rows = vectors(spark, d)
    scores = md.gaussian_scores(rows, md.gaussian_parameters(rows, 64), rows.count())
    return scores.select("message_id", "class", r6("score", 4).alias("score"))


@query("m3_naive_bayes", _GAUSS + "SELECT vec_id AS message_id, arg_max(label, score) AS prediction FROM s GROUP BY vec_id")
def m3(spark, d):
    rows = wide_vectors(spark, d)
    model = md.fit_classifier(rows, "naive_bayes", scale=False, n_classes=10)
    return model.predict(rows).select("message_id", "prediction")


@query("m4_svc")
def m4(spark, d):
    return _held_out(spark, d, "svc")


@query("m5_neural_network")
def m5(spark, d):
    return _held_out(spark, d, "neural_network")


@query("m6_gradient_boosting")
def m6(spark, d):
    return _held_out(spark, d, "gradient_boosting")


@query("m7_first_cuts", """
WITH u AS (SELECT t, f, ('0x' || substr(md5('order:0:' || t || ':0:' || f), 1, 8))::BIGINT AS place,
                  ('0x' || substr(md5('cut:0:' || t || ':0:' || f), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS share
           FROM range(20) a(t), range(64) b(f)),
v AS (SELECT f, embedding[f + 1]::DOUBLE AS x, label FROM embeddings, range(64) b(f)),
lim AS (SELECT f, min(x) AS low, max(x) AS high FROM v GROUP BY f HAVING min(x) < max(x)),
tried AS (SELECT t, f, low + share * (high - low) AS cut, row_number() OVER (PARTITION BY t ORDER BY place, f) AS rank
          FROM u JOIN lim USING (f) QUALIFY rank <= 8),
side AS (SELECT t, v.f, any_value(rank) AS rank, any_value(cut) AS cut, label, count(*) FILTER (x <= cut) AS nl, count(*) FILTER (x > cut) AS nr
         FROM tried JOIN v ON v.f = tried.f GROUP BY t, v.f, label),
worth AS (SELECT t, f, any_value(rank) AS rank, any_value(cut) AS cut, sum(nl)::BIGINT AS n_left,
                 sum(nl * nl)::DOUBLE / sum(nl) + sum(nr * nr)::DOUBLE / sum(nr) AS w FROM side GROUP BY t, f)
SELECT t AS tree, f AS feature, round(cut, 6) AS cut, n_left FROM worth
QUALIFY row_number() OVER (PARTITION BY t ORDER BY round(w, 6) DESC, rank) = 1""")
def m7_first_cuts(spark, d):
    """The first cut of 20 trees over the raw vectors."""
    rows = vectors(spark, d).select(F.col("embedding").alias("vector"), F.col("user").alias("label"))
    model = fit_random_trees(rows, md.count_classes(rows, "label"), TreeParams(n_estimators=20, max_depth=1))
    found = [(k, int(t["feature"][0]), float(t["cut"][0]), int(t["rows"][1])) for k, t in enumerate(model.trees)]
    return spark.createDataFrame(found, "tree long, feature long, cut double, n_left long").withColumn("cut", r6("cut"))


@query("m7_extra_trees")
def m7(spark, d):
    return _held_out(spark, d, "extra_trees")


@query("m8_kneighbors", f"""
SELECT query_id, arg_max(label, votes * 1000 - label) AS prediction FROM (
    SELECT query_id, label, count(*) AS votes FROM ({KNN}) JOIN embeddings ON neighbor_id = vec_id
    GROUP BY query_id, label) GROUP BY query_id""")
def m8(spark, d):
    neighbors, rows = knn_table(spark, d)
    return knn_predict(knn_votes(neighbors, rows))


@query("m8_kneighbors_model")
def m8_model(spark, d):
    return _held_out(spark, d, "kneighbors")


@query("m10_train_feature_model")
def m10(spark, d):
    run = md.train_feature_model(quality_tables(spark, d)[0], config=STYLE)
    return run.report().select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                               r6("f1").alias("f1"), "support")


@query("m11_cross_validate")
def m11(spark, d):
    scores = md.cross_validate(quality_tables(spark, d)[0])
    return ev.score_summary(scores)


@query("m12_train_embedding_model")
def m12(spark, d):
    return md.train_embedding_model(vectors(spark, d)).scored.select("message_id", "user", "prediction")


@query("a11_training_history")
def a11(spark, d):
    return md.train_embedding_model(vectors(spark, d)).history


@query("v7_training_history")
def v7(spark, d):
    return md.train_embedding_model(quality_tables(spark, d)[1], gamma=None).history


@query("o1_feature_importance")
def o1(spark, d):
    run = md.train_feature_model(quality_tables(spark, d)[0], config=STYLE)
    return run.importance(20)


@query("m15_predict")
def m15(spark, d):
    rows = materialize(split(wide_vectors(spark, d)), "split")
    model = md.fit_classifier(rows.filter("split = 'train'").drop("split"), "naive_bayes", n_classes=10)
    return model.predict(rows.filter("split = 'test'").drop("split")).select(
        "message_id", "prediction", F.posexplode("probability").alias("user", "p"))


@query("m16_stack_oof")
def m16(spark, d):
    features, embeddings = quality_tables(spark, d)
    oof = stack_oof(features, embeddings)
    return oof.select("message_id", "user", "fold", F.get("probs_feature", F.lit(1)).alias("probs_feature1"),
                      F.get("probs_embed", F.lit(1)).alias("probs_cnn1"))


def _meta_table(spark, d):
    """Meta table of the labelled documents: every row predicted by base models that have not seen it."""
    path = _kept(spark, d, "meta")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        oof = stack_oof(*quality_tables(spark, d))
        return _written(meta_inputs(oof.drop("fold").withColumns(pr.meta_columns()), 2), path)
    return spark.read.parquet(path)


@query("m18_meta_learner")
def m18(spark, d):
    rows = materialize(split(_meta_table(spark, d)), "split")
    model = md.fit_classifier(rows.filter("split = 'train'").drop("split"), "gradient_boosting", n_classes=2)
    return model.predict(rows.filter("split = 'test'").drop("split")).select("message_id", "user", "prediction")


@query("m19_search")
def m19(spark, d):
    return search(_meta_table(spark, d))[1].select("generation", "candidate", "score")


@query("m20_train_meta")
def m20(spark, d):
    return train_meta(_meta_table(spark, d), 2, test_size=0.2)[1].confusion


@query("m21_train")
def m21(spark, d):
    return trained_stack(spark, d)[1].select("message_id", "user", "prediction")


@query("v8_evaluate_stack")
def v8(spark, d):
    return ev.classification_report(trained_stack(spark, d)[1])
