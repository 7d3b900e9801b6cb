"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import DOCS, docs, label_rows, query, r6, table, vectors
from inkprint.config import FeatureConfig
from inkprint.constants import TOKEN_PATTERN
from inkprint.operators.clean import index_users
from inkprint.operators.features import build_features
from inkprint.operators.models import Fitted, fit_classifier
from inkprint.operators.parse import render_export
from inkprint.plans.dataset import build_dataset
from inkprint.session import scratch_path
from inkprint.sources.chats import load_aliases, read_chats
from inkprint.sources.datasets import (
    cached, clean_model_name, read_dataset, read_registry, read_users, register_users, update_registry,
    write_dataset, write_users,
)
from inkprint.sources.wordlists import build_vocabulary, load_wordlist, union_words, word_set


def write_exports(spark, d: str) -> str:
    """Conversations as export files: sorted, of bounded size, one dialect per file."""
    path = scratch_path(spark, "exports")
    t = table(spark, d, "conversations")
    dialect = F.when(F.col("role") == "assistant", "ios").otherwise("android")
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    author = F.concat_ws(" ", "role", "conv_id")
    (
        t.withColumn("dialect", dialect)
        .withColumn("value", render_export(ts, author, "text", "dialect"))
        .repartitionByRange("conv_id", "turn").sortWithinPartitions("dialect", "conv_id", "turn")
        .select("dialect", "value")
        .write.partitionBy("dialect").option("maxRecordsPerFile", 5000).text(path)
    )
    return path


EXPORT_LINES = r"""
SELECT unnest(string_split(
    CASE WHEN role = 'assistant'
         THEN '[' || strftime(ts, '%-d/%-m/%Y, %H:%M') || ':00] ' ELSE strftime(ts, '%d/%m/%Y, %H:%M') || ' - ' END
    || role || ' ' || conv_id || ': ' || text, chr(10))) AS line
FROM (SELECT *, make_timestamp((1704067200 + conv_id * 3600 + turn * 60) * 1000000) AS ts FROM conversations)"""


@query("s1_read_chats", f"SELECT line, count(*)::BIGINT AS n FROM ({EXPORT_LINES}) WHERE line <> '' GROUP BY line")
def s1(spark, d):
    chats = read_chats(spark, write_exports(spark, d))
    lines = chats.select(F.explode(F.split("value", "\n")).alias("line")).filter("line != ''")
    return lines.groupBy("line").agg(F.count("*").alias("n"))


@query("s2_load_aliases", "SELECT source AS alias, max(lang) AS canonical FROM documents GROUP BY source")
def s2(spark, d):
    path = scratch_path(spark, "aliases")
    # an alias file lists each language with its distinct sources, languages in order
    pairs = table(spark, d, "documents").select("lang", "source").distinct()
    entries = pairs.groupBy("lang").agg(F.sort_array(F.collect_set("source")).alias("names"))
    whole = entries.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("lang", "names"))))))
    whole.coalesce(1).write.text(path)
    return load_aliases(spark, path)


@query("s4_load_wordlist", """
WITH w AS (SELECT c_name AS word FROM customer UNION SELECT n_name FROM nation)
SELECT word FROM w UNION SELECT left(word, length(word) - 1) FROM w""")
def s4(spark, d):
    path = scratch_path(spark, "words")
    words = table(spark, d, "customer").select(F.col("c_name").alias("word")).union(
        table(spark, d, "nation").select("n_name"))
    words.write.text(path)
    return load_wordlist(spark, path, clipped=True)


@query("s5_build_vocabulary", rf"""
SELECT lang, word, count(*)::BIGINT AS n_docs FROM (
    SELECT DISTINCT lang, doc_id, lower(tok) AS word
    FROM (SELECT lang, doc_id, unnest(regexp_extract_all(text, '{TOKEN_PATTERN}')) AS tok FROM documents)
    WHERE regexp_matches(tok, '^\p{{L}}')) GROUP BY lang, word HAVING count(*) >= 3""")
def s5(spark, d):
    return build_vocabulary(docs(spark, d), min_docs=3, by=["lang"])


@query("s7_read_dataset", "SELECT doc_id, lang, source, n_chars FROM documents")
def s7(spark, d):
    return read_dataset(spark, f"{d}/documents").select("doc_id", "lang", "source", "n_chars")


@query("s8_write_features", """
SELECT doc_id AS message_id, length(text)::BIGINT AS char_count,
       length(regexp_replace(text, '[^\\p{Lu}]', '', 'g'))::BIGINT AS uppercase_count FROM documents""".replace("\\\\", "\\"))
def s8(spark, d):
    table_ = build_features(docs(spark, d), FeatureConfig.only("char_count", "uppercase_count"))
    path = write_dataset(table_, scratch_path(spark, "out"), "docs", "features")
    return read_dataset(spark, path.removesuffix(".parquet"))


@query("s9_write_embeddings", """
SELECT vec_id AS message_id, label AS "user", i::INTEGER AS i, round(embedding[i + 1]::DOUBLE, 6) + 0.0 AS value
FROM embeddings, range(64) r(i)""")
def s9(spark, d):
    path = write_dataset(vectors(spark, d), scratch_path(spark, "out"), "vecs", "embeddings")
    back = read_dataset(spark, path)
    return back.select("message_id", "user", F.posexplode("embedding").alias("i", "v")).select(
        "message_id", "user", "i", r6("v").alias("value"))


@query("s10_build_dataset", """
SELECT doc_id AS message_id, dense_rank() OVER (ORDER BY source)::INTEGER - 1 AS "user",
       length(text)::BIGINT AS char_count FROM documents""")
def s10(spark, d):
    rows = docs(spark, d)
    users = index_users(rows)
    messages = rows.join(users, "author").select("message_id", "user", "message")
    folder = scratch_path(spark, "dataset")
    first = build_dataset(spark, folder, "docs", messages=messages, config=FeatureConfig.only("char_count"),
                          embeddings=False)
    again = build_dataset(spark, folder, "docs", config=FeatureConfig.only("char_count"), embeddings=False)
    return again.features.select(*first.features.columns)


@query("s13_save_model")
def s13(spark, d):
    from inkprint.operators.embed import vector_to_columns
    wide = vector_to_columns(vectors(spark, d), 64, "mean")
    path = scratch_path(spark, "model")
    fit_classifier(wide, "naive_bayes").save(path)
    return Fitted.load(spark, path).predict(wide).select("message_id", "user", "prediction")


@query("s16_write_users", """
SELECT dense_rank() OVER (ORDER BY source)::INTEGER - 1 AS "user", source AS author
FROM (SELECT DISTINCT source FROM documents)""")
def s16(spark, d):
    return read_users(spark, write_users(index_users(docs(spark, d)), scratch_path(spark, "users"), "docs"))


@query("s17_register_users", """
SELECT 'first' AS model, (row_number() OVER (ORDER BY lang) - 1)::INTEGER AS "user", lang AS author
FROM (SELECT DISTINCT lang FROM documents) UNION ALL
SELECT 'second', (row_number() OVER (ORDER BY source) - 1)::INTEGER, source
FROM (SELECT DISTINCT source FROM documents)""")
def s17(spark, d):
    path = scratch_path(spark, "registry")
    sources = index_users(docs(spark, d))
    languages = index_users(docs(spark, d), "lang")
    update_registry(spark, path, sources, "first")
    update_registry(spark, path, sources, "second")
    update_registry(spark, path, languages, "first")
    return read_registry(spark, path)


@query("u3_union_words", "SELECT DISTINCT word FROM (SELECT lang AS word FROM documents UNION ALL "
       "SELECT source FROM documents UNION ALL SELECT left(source, length(source) - 1) FROM documents)")
def u3(spark, d):
    rows = docs(spark, d)
    names = word_set(rows.select(F.col("author").alias("word")), clipped=True)
    return union_words([rows.select(F.col("lang").alias("word")), names])


@query("t6_model_name", """
SELECT DISTINCT source, regexp_replace('model_' || source || '.joblib', 'model_|\\.joblib', '', 'g') AS model
FROM documents""".replace("\\\\", "\\"))
def t6(spark, d):
    names = docs(spark, d).select(F.col("author").alias("source")).distinct()
    return names.select("source", clean_model_name(F.concat(F.lit("model_"), "source", F.lit(".joblib"))).alias("model"))


@query("r_cached_table", 'SELECT doc_id AS message_id, quality AS "user" FROM labels')
def cached_table(spark, d):
    path = scratch_path(spark, "cached")
    cached(spark, path, lambda: label_rows(spark, d).limit(0))
    return cached(spark, path, lambda: label_rows(spark, d), refactor=True)


__all__ = ["write_exports", "register_users", "DOCS"]
