"""Text to vector."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import DOCS, docs, query, r6, table
from inkprint.constants import TOKEN_PATTERN
from inkprint.operators import embed as em

DIMS = em.DIMS

# byte i of the digest of the token: two hex digits of part i // 16
_BYTE = "('0x' || substr(md5(lower(t) || ':' || (i // 16)), 2 * (i % 16) + 1, 2))::INTEGER"
_TOK = f"SELECT message_id, regexp_extract_all(message, '{TOKEN_PATTERN}') AS toks FROM ({DOCS})"
_MEAN = f"""
SELECT message_id, i::INTEGER AS i, round(coalesce(v, 0), 6) + 0.0 AS value FROM ({DOCS}) CROSS JOIN range({DIMS}) r(i)
LEFT JOIN (SELECT message_id, i, avg({_BYTE}) / 127.5 - 1 AS v
           FROM (SELECT message_id, unnest(toks) AS t FROM ({_TOK})), range({DIMS}) r(i)
           GROUP BY message_id, i) USING (message_id, i)"""
_FIRST = f"""
SELECT message_id, i::INTEGER AS i, CASE WHEN len(toks) = 0 THEN 0.0 ELSE round({_BYTE} / 127.5 - 1, 6) + 0.0 END AS value
FROM (SELECT message_id, toks, toks[1] AS t FROM ({_TOK})), range({DIMS}) r(i)"""


def _long(df):
    return df.select("message_id", F.posexplode("embedding").alias("i", "v")).select(
        "message_id", "i", r6("v").alias("value"))


def _rows(spark, d):
    return docs(spark, d).select("message_id", "message")


@query("e1_embed")
def e1(spark, d):
    return _long(em.embed(_rows(spark, d)))


@query("e2_mean_vectors", _MEAN)
def e2(spark, d):
    return _long(em.embed_hashed(_rows(spark, d), "mean", hasher="md5"))


@query("e3_first_vector", _FIRST)
def e3(spark, d):
    return _long(em.embed_hashed(_rows(spark, d), "cls", hasher="md5"))


@query("e4_mixed_vectors", f"SELECT * FROM ({_FIRST}) UNION ALL SELECT message_id, i + {DIMS}, value FROM ({_MEAN})")
def e4(spark, d):
    return _long(em.embed_hashed(_rows(spark, d), "mixed", hasher="md5"))


@query("e5_vector_columns", "SELECT vec_id AS message_id, label AS \"user\", "
       + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) + 0.0 AS mixed_embed_{i}" for i in range(64))
       + " FROM embeddings")
def e5(spark, d):
    t = table(spark, d, "embeddings").select(F.col("vec_id").alias("message_id"), F.col("label").alias("user"),
                                             "embedding")
    wide = em.vector_to_columns(t, 64)
    return wide.select("message_id", "user", *[r6(c).alias(c) for c in wide.columns if c.startswith("mixed_")])
