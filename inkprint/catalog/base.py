"""Registration of queries, and the driver tables as inputs of the operators.

Each adapter has a SQL twin, so that a query and its SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.session import spread

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c, places: int = 6):
    """Rounded at the edge of a query; adding zero turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), places) + F.lit(0.0)


# documents as messages: key doc_id, author source
def docs(spark, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select(
        F.col("doc_id").alias("message_id"), F.col("source").alias("author"), "lang", F.col("text").alias("message")),
        "message_id")


DOCS = "SELECT doc_id AS message_id, source AS author, lang, text AS message FROM documents"


# documents with some letter groups replaced by emoji, as the texts hold none
def emoji_docs(spark, d: str) -> DataFrame:
    text = F.replace(F.col("message"), F.lit("es"), F.lit("\U0001F600"))
    text = F.replace(text, F.lit("on"), F.lit("\U0001F44D\U0001F3FD"))
    text = F.replace(text, F.lit("la"), F.lit("\U0001F1EE\U0001F1F9"))
    text = F.replace(text, F.lit("th"), F.lit("\U0001F469‍\U0001F4BB"))
    return docs(spark, d).withColumn("message", text)


EMOJI_DOCS = (
    "SELECT doc_id AS message_id, replace(replace(replace(replace(text, 'es', '\U0001F600'), "
    "'on', '\U0001F44D\U0001F3FD'), 'la', '\U0001F1EE\U0001F1F9'), 'th', '\U0001F469‍\U0001F4BB') AS message "
    "FROM documents"
)


# conversations as parsed messages; some bodies carry the marks that cleaning looks for
def chat(spark, d: str) -> DataFrame:
    t = table(spark, d, "conversations")
    body = (
        F.when(F.contains(F.col("text"), F.lit("onsh")), F.concat("text", F.lit(" <This message was edited>")))
        .when(F.contains(F.col("text"), F.lit("euxre")), F.concat(F.lit("note.pdf (file attached) "), F.col("text")))
        .when(F.startswith(F.col("text"), F.lit("The")), F.lit("image omitted"))
        .when(F.startswith(F.col("text"), F.lit("Le")), F.lit("Ann added Bob"))
        .otherwise(F.col("text"))
    )
    sec = F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn") * 600 - F.length("text") * 60
    return t.select(
        F.col("conv_id").alias("chat_id"), F.col("turn").alias("pos"), F.timestamp_seconds(sec).alias("ts"),
        F.when(F.col("role") == "system", "info").otherwise(F.col("role")).alias("author"),
        F.translate(body, "\n", " ").alias("body"))


CHAT = """
SELECT conv_id AS chat_id, turn AS pos, 1704067200 + conv_id * 60 + turn * 600 - length(text) * 60 AS sec,
       CASE WHEN role = 'system' THEN 'info' ELSE role END AS author,
       replace(CASE WHEN contains(text, 'onsh') THEN text || ' <This message was edited>'
                    WHEN contains(text, 'euxre') THEN 'note.pdf (file attached) ' || text
                    WHEN starts_with(text, 'The') THEN 'image omitted'
                    WHEN starts_with(text, 'Le') THEN 'Ann added Bob' ELSE text END, chr(10), ' ') AS body
FROM conversations"""


# two probability vectors per row of embeddings, and its class
def probs(spark, d: str) -> DataFrame:
    from inkprint.functions.probs import softmax
    wide = F.transform("embedding", lambda x: x.cast("double") * 4)
    t = table(spark, d, "embeddings").withColumn("_z", wide)
    return t.select(
        F.col("vec_id").alias("message_id"), F.col("label").alias("user"),
        softmax(F.slice("_z", 1, 10)).alias("probs_feature"), softmax(F.slice("_z", 11, 10)).alias("probs_embed"))



PROBS = f"""
SELECT vec_id AS message_id, label AS "user", list_transform(pf, lambda y: y / list_sum(pf)) AS f,
       list_transform(pe, lambda y: y / list_sum(pe)) AS e
FROM (SELECT vec_id, label, list_transform(embedding[1:10], lambda x: exp(4 * x::DOUBLE)) AS pf,
             list_transform(embedding[11:20], lambda x: exp(4 * x::DOUBLE)) AS pe FROM embeddings)"""


# rows (message_id, user, probability, prediction) of a scored table
def scored(spark, d: str) -> DataFrame:
    from inkprint.functions.probs import argmax
    return probs(spark, d).select("message_id", "user", F.col("probs_feature").alias("probability"),
                                  argmax("probs_feature").cast("int").alias("prediction"))


SCORED = f"""
SELECT message_id, "user", f AS probability, list_position(f, list_max(f)) - 1 AS prediction FROM ({PROBS})"""


# a third of a table's rows may share one class; these ids and classes feed the splits
def label_rows(spark, d: str) -> DataFrame:
    return table(spark, d, "labels").select(F.col("doc_id").alias("message_id"), F.col("quality").alias("user"))


LABELS = 'SELECT doc_id AS message_id, quality AS "user" FROM labels'


def vectors(spark, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("message_id"), F.col("label").alias("user"), "embedding")
