"""Counts, weights, losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import DOCS, PROBS, SCORED, docs, label_rows, probs, query, r6, scored, table, vectors
from inkprint.constants import TOKEN_PATTERN
from inkprint.functions import probs as pr
from inkprint.functions import tokens as tk
from inkprint.functions.text import bag_tokens
from inkprint.operators import clean as cl
from inkprint.operators import evaluate as ev
from inkprint.operators import sampling as sm
from inkprint.operators.features import min_max, scale_min_max

_LANGS = """SELECT doc_id AS message_id, dense_rank() OVER (ORDER BY source)::INTEGER - 1 AS "user" FROM documents"""


def _source_rows(spark, d):
    rows = docs(spark, d).select("message_id", "author")
    users = cl.user_dimension(rows)
    return cl.attach_users(rows, users), users.table


@query("a1_class_counts", """
SELECT (dense_rank() OVER (ORDER BY source) - 1)::INTEGER AS "user", n FROM (
    SELECT source, sum((lang <> 'en')::INT)::BIGINT AS n FROM documents GROUP BY source)""")
def a1(spark, d):
    rows = docs(spark, d)
    users = cl.index_users(rows)
    kept = cl.attach_users(rows.filter("lang != 'en'").select("message_id", "author"), users)
    return cl.class_counts(kept, users)


@query("a2_smallest_class", "SELECT min(n)::BIGINT AS n FROM (SELECT count(*) AS n FROM labels GROUP BY quality)")
def a2(spark, d):
    return cl.class_counts(label_rows(spark, d)).agg(F.min("n").alias("n"))


@query("a3_class_names", """
SELECT source AS class_name, (row_number() OVER (ORDER BY source) - 1)::BIGINT AS class_index,
       count(*) OVER ()::BIGINT AS n_classes FROM (SELECT DISTINCT source FROM documents)""")
def a3(spark, d):
    return cl.class_names(table(spark, d, "documents"), "source")


_STRAT = """
WITH sized AS (SELECT "user", count(*) AS n FROM rows_ GROUP BY "user"),
shared AS (SELECT "user", n, ceil(sum(n) OVER () * {size} - 1e-9) AS want,
                  n * ceil(sum(n) OVER () * {size} - 1e-9) / sum(n) OVER () AS exact FROM sized),
taken AS (SELECT "user", floor(exact) + (row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, "user")
                 <= want - sum(floor(exact)) OVER ())::INT AS k FROM shared)
SELECT message_id, "user", CASE WHEN row_number() OVER (PARTITION BY "user" ORDER BY md5(message_id || ':42')) <= k
       THEN 'test' ELSE 'train' END AS split FROM rows_ JOIN taken USING ("user")"""


@query("a4_class_distribution", f"""
WITH rows_ AS (SELECT vec_id AS message_id, label AS "user" FROM embeddings),
parts AS ({_STRAT.format(size=0.2)}) SELECT split, "user", count(*)::BIGINT AS n FROM parts GROUP BY split, "user" """)
def a4(spark, d):
    rows = vectors(spark, d).select("message_id", "user")
    return sm.class_distribution(sm.stratified_split(rows, "user", [("test", 0.2)]))


@query("a5_class_weights", """
SELECT quality AS "user", n, round(1.0::DOUBLE / n, 8) AS weight,
       round((1.0::DOUBLE / n) / sum(1.0::DOUBLE / n) OVER () * count(*) OVER (), 6) AS norm_weight
FROM (SELECT quality, count(*)::BIGINT AS n FROM labels GROUP BY quality)""")
def a5(spark, d):
    return sm.class_weights(label_rows(spark, d)).select(
        "user", "n", r6("weight", 8).alias("weight"), r6("norm_weight").alias("norm_weight"))


@query("a6_distinct_tokens", rf"""
SELECT message_id, count(DISTINCT lower(t))::BIGINT AS n_distinct FROM (
    SELECT message_id, unnest(regexp_extract_all(message, '{TOKEN_PATTERN}')) AS t FROM ({DOCS}))
WHERE regexp_matches(t, '^\p{{L}}') GROUP BY message_id""")
def a6(spark, d):
    rows = tk.annotate(docs(spark, d))
    lemmas = F.size(F.array_distinct(tk.alpha_lemmas("tokens"))).cast("long")
    return rows.select("message_id", lemmas.alias("n_distinct")).filter("n_distinct > 0")


@query("a7_term_counts", r"""
SELECT message_id, w AS term, count(*)::BIGINT AS n FROM (
    SELECT doc_id AS message_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS w FROM documents)
GROUP BY message_id, w""")
def a7(spark, d):
    words = docs(spark, d).select("message_id", F.explode(bag_tokens("message")).alias("term"))
    return words.groupBy("message_id", "term").agg(F.count("*").alias("n"))


@query("a8_vector_statistics", f"""
SELECT message_id, round(list_sum(f), 6) AS total, round(list_avg(f), 6) AS mean, round(list_stddev_pop(f), 6) AS std,
       round(list_var_pop(f), 6) AS var, round(list_min(f), 6) AS low, round(list_max(f), 6) AS high FROM ({PROBS})""")
def a8(spark, d):
    p = "probs_feature"
    return probs(spark, d).select(
        "message_id", r6(pr.total(p)).alias("total"), r6(pr.mean(p)).alias("mean"), r6(pr.std(p)).alias("std"),
        r6(pr.variance(p)).alias("var"), r6(F.array_min(p)).alias("low"), r6(F.array_max(p)).alias("high"))


@query("a9_score_summary", """
SELECT 'class ' || label AS metric, round(avg(v), 6) AS mean, round(2 * stddev_pop(v), 6) AS margin
FROM (SELECT label, embedding[1]::DOUBLE AS v FROM embeddings) GROUP BY label""")
def a9(spark, d):
    scores = table(spark, d, "embeddings").select(
        F.concat(F.lit("class "), F.col("label")).alias("metric"), F.get("embedding", F.lit(0)).cast("double").alias("value"))
    return ev.score_summary(scores).select("metric", r6("mean").alias("mean"), r6("margin").alias("margin"))


@query("a12_min_max", """
SELECT 'n_chars' AS "column", min(n_chars)::DOUBLE AS low, max(n_chars)::DOUBLE AS high FROM documents UNION ALL
SELECT 'doc_id', min(doc_id)::DOUBLE, max(doc_id)::DOUBLE FROM documents""")
def a12(spark, d):
    return min_max(table(spark, d, "documents"), ["n_chars", "doc_id"])


@query("m1_scale_min_max", """
SELECT doc_id, round((n_chars - min(n_chars) OVER ()) / (max(n_chars) OVER () - min(n_chars) OVER ())::DOUBLE, 6)
       AS n_chars, 0.0::DOUBLE AS constant FROM documents""")
def m1(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "n_chars", F.lit(7).alias("constant"))
    out = scale_min_max(rows, ["n_chars", "constant"])
    return out.select("doc_id", r6("n_chars").alias("n_chars"), "constant")


_LOSS = """0.5 * power(1 - p, {g}) * -ln(p)"""
_TRUE = f'SELECT message_id, "user", probability["user" + 1] AS p FROM ({SCORED})'


@query("m13_focal_loss", f"SELECT message_id, round({_LOSS.format(g=4)}, 6) AS loss FROM ({_TRUE})")
def m13(spark, d):
    return ev.focal(scored(spark, d), 0.5, 4.0, "none").select("message_id", r6("loss").alias("loss"))


@query("m13_focal_loss_reduced", f"""
SELECT 'mean' AS reduction, round(avg({_LOSS.format(g=2)}), 6) AS loss FROM ({_TRUE}) UNION ALL
SELECT 'sum', round(sum({_LOSS.format(g=2)}), 6) FROM ({_TRUE})""")
def m13_reduced(spark, d):
    rows = scored(spark, d)
    tables = [ev.focal(rows, reduction=r).select(F.lit(r).alias("reduction"), r6("loss").alias("loss"))
              for r in ("mean", "sum")]
    return tables[0].unionByName(tables[1])


@query("m14_weighted_log_loss", f"""
SELECT round(sum(w * -ln(p)) / sum(w), 6) AS loss FROM ({_TRUE}) JOIN (
    SELECT label AS "user", 1.0::DOUBLE / count(*) AS w FROM embeddings GROUP BY label) USING ("user")""")
def m14(spark, d):
    rows = sm.with_class_weight(scored(spark, d))
    return ev.weighted_log_loss(rows).select(r6("loss").alias("loss"))


@query("u1_class_samples", """
SELECT message_id, "user" FROM (SELECT doc_id AS message_id, toxic AS "user",
    row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id || ':7')) AS place FROM labels)
WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))""")
def u1(spark, d):
    rows = table(spark, d, "labels").select(F.col("doc_id").alias("message_id"), F.col("toxic").alias("user"))
    return sm.undersample(rows, seed=7)
