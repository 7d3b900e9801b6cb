"""Joins and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.catalog.base import DOCS, PROBS, docs, label_rows, probs, query, r6, table, vectors
from inkprint.constants import TOKEN_PATTERN
from inkprint.functions import tokens as tk
from inkprint.operators import clean as cl
from inkprint.operators import joins as jn
from inkprint.operators.neighbors import knn_join, top_k
from inkprint.operators.sampling import assign_folds, split
from inkprint.sources.wordlists import build_vocabulary

_SPLIT = """
SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(message_id || ':42')) <= ceil(count(*) OVER () * 0.2)
          THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id AS message_id, quality AS "user" FROM labels)"""


def _ids(spark, d, part: str) -> DataFrame:
    return split(label_rows(spark, d)).filter(F.col("split") == part)


@query("j1_keep_ids", f"SELECT doc_id AS message_id, n_chars FROM documents "
       f"WHERE doc_id IN (SELECT message_id FROM ({_SPLIT}) WHERE split = 'train')")
def j1(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), "n_chars")
    return jn.keep_ids(rows, _ids(spark, d, "train"))


@query("j2_drop_ids", f"SELECT doc_id AS message_id, n_chars FROM documents "
       f"WHERE doc_id NOT IN (SELECT message_id FROM ({_SPLIT}) WHERE split = 'train')")
def j2(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), "n_chars")
    return jn.drop_ids(rows, _ids(spark, d, "train"))


@query("j3_lookup_or", """
SELECT c_custkey, coalesce(n_name, 'other') AS nation FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_name < 'K') ON c_nationkey = n_nationkey""")
def j3(spark, d):
    nations = table(spark, d, "nation").filter("n_name < 'K'").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"))
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return jn.lookup_or(rows, nations, "c_nationkey", "name", "other", "nation").select("c_custkey", "nation")


@query("j4_attach_users", f"""
SELECT message_id, dense_rank() OVER (ORDER BY author)::INTEGER - 1 AS "user" FROM ({DOCS})""")
def j4(spark, d):
    rows = docs(spark, d).select("message_id", "author")
    return cl.attach_users(rows, cl.user_dimension(rows)).select("message_id", "user")


@query("j5_align", f"""
SELECT message_id, "user", i::INTEGER AS i, round(f[i + 1], 6) AS pf, round(e[i + 1], 6) AS pe
FROM ({PROBS}), range(10) r(i)""")
def j5(spark, d):
    both = probs(spark, d)
    left = both.select("message_id", "user", "probs_feature")
    right = both.select("message_id", "user", "probs_embed")
    pairs = F.arrays_zip(F.col("probs_feature").alias("pf"), F.col("probs_embed").alias("pe"))
    return jn.align(left, right).select("message_id", "user", F.posexplode(pairs).alias("i", "p")).select(
        "message_id", "user", "i", r6("p.pf").alias("pf"), r6("p.pe").alias("pe"))


@query("j6_vocabulary_join", rf"""
WITH tok AS (SELECT message_id, lang, lower(t) AS w FROM (
         SELECT message_id, lang, unnest(regexp_extract_all(message, '{TOKEN_PATTERN}')) AS t FROM ({DOCS}))
     WHERE regexp_matches(t, '^\p{{L}}')),
vocab AS (SELECT w FROM tok WHERE lang = 'en' GROUP BY w HAVING count(DISTINCT message_id) >= 5)
SELECT message_id, coalesce(share, 0.0) AS englishness FROM ({DOCS}) LEFT JOIN (
    SELECT message_id, format('{{:.2f}}', sum((w IN (SELECT w FROM vocab))::INT) / count(*)::DOUBLE)::DOUBLE AS share
    FROM tok GROUP BY message_id) USING (message_id)""")
def j6(spark, d):
    rows = docs(spark, d)
    vocabulary = build_vocabulary(rows.filter("lang = 'en'"), min_docs=5)
    marked = tk.annotate(rows.select("message_id", "message"))
    return tk.vocabulary_share(marked, vocabulary, "englishness").select("message_id", "englishness")


@query("j7_decode_users", """SELECT vec_id AS message_id, 'author ' || label AS author FROM embeddings""")
def j7(spark, d):
    rows = vectors(spark, d).select("message_id", "user")
    users = rows.select("user").distinct().withColumn("author", F.concat(F.lit("author "), F.col("user")))
    return jn.decode_users(rows, users).select("message_id", "author")


KNN = """
SELECT query_id, rank, neighbor_id, round(d2, 6) AS distance2 FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, d2,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY round(d2, 12), b.vec_id) AS rank
    FROM (SELECT a, b, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2 AS d2
          FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)) WHERE rank <= 5"""


def knn_table(spark, d):
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label")
    return knn_join(rows, rows, 5, exclude_self=True), rows


@query("j8_knn_join", KNN)
def j8(spark, d):
    return knn_table(spark, d)[0].select("query_id", "rank", "neighbor_id", r6("distance2").alias("distance2"))


@query("u2_union_folds", """SELECT doc_id AS message_id, fold::INTEGER AS fold FROM (
SELECT doc_id, CASE WHEN p < (q + 1) * r THEN p // (q + 1) ELSE r + (p - (q + 1) * r) // q END AS fold FROM (
    SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42')) - 1 AS p, count(*) OVER () // 5 AS q,
           count(*) OVER () % 5 AS r FROM labels))""")
def u2(spark, d):
    folded = assign_folds(label_rows(spark, d), 5)
    parts = [folded.filter(F.col("fold") == i) for i in range(5)]
    return reduce(DataFrame.unionByName, parts).select("message_id", "fold")


@query("w4_top_k", """
SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 3""")
def w4(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_k(rows, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select(
        "o_custkey", "o_orderkey", "rank")
