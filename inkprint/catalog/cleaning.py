"""The clean table."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import CHAT, chat, docs, query, table
from inkprint.config import FeatureConfig
from inkprint.constants import NOTICE_PATTERNS
from inkprint.operators import clean as cl
from inkprint.operators.embed import assemble_wide, vector_to_columns
from inkprint.operators.features import build_features, select_features

_NOTICE = "^(?:" + "|".join(f"(?:{p})" for p in NOTICE_PATTERNS).replace("'", "''").replace(r"\S", r"[^\s]") + ")$"
_EDITED = "replace(replace(body, '<This message was edited>', ''), '<Questo messaggio è stato modificato>', '')"


@query("c1_drop_info", f"SELECT chat_id, pos, author FROM ({CHAT}) WHERE author <> 'info'")
def c1(spark, d):
    return cl.drop_info(chat(spark, d)).select("chat_id", "pos", "author")


@query("c2_strip_edited", f"SELECT chat_id, pos, {_EDITED} AS body FROM ({CHAT})")
def c2(spark, d):
    return chat(spark, d).select("chat_id", "pos", cl.strip_edited("body").alias("body"))


@query("c3_drop_notices", f"SELECT chat_id, pos, body FROM ({CHAT}) WHERE NOT regexp_matches(body, '{_NOTICE}')")
def c3(spark, d):
    return cl.drop_notices(chat(spark, d)).select("chat_id", "pos", "body")


@query("c4_drop_attached", f"SELECT chat_id, pos, body FROM ({CHAT}) WHERE NOT contains(body, '(file attached)')")
def c4(spark, d):
    return cl.drop_attached(chat(spark, d)).select("chat_id", "pos", "body")


_INDEXED = """SELECT doc_id AS message_id, lang, dense_rank() OVER (ORDER BY lang)::INTEGER - 1 AS "user" FROM documents"""


@query("c5_drop_placeholder", f"SELECT message_id, \"user\" FROM ({_INDEXED}) WHERE lang <> 'en'")
def c5(spark, d):
    rows = docs(spark, d).select("message_id", F.col("lang").alias("author"))
    users = cl.index_users(rows)
    return cl.drop_placeholder(cl.attach_users(rows, users), users, "en").select("message_id", "user")


_TIMED = f"""
SELECT *, coalesce(greatest(sec - lag(sec) OVER (ORDER BY chat_id, pos), 0), 0)::BIGINT AS responsiveness
FROM ({CHAT})"""
_CLEAN = f"""
WITH timed AS ({_TIMED}), kept AS (SELECT * FROM timed WHERE author <> 'info'),
named AS (SELECT *, dense_rank() OVER (ORDER BY author)::INTEGER - 1 AS "user", {_EDITED} AS message FROM kept),
cleaned AS (SELECT chat_id * 4294967296 + pos AS message_id, responsiveness, "user", message FROM named
            WHERE NOT regexp_matches(message, '{_NOTICE}') AND NOT contains(message, '(file attached)')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY md5(message_id || ':42')) AS place FROM cleaned)
SELECT message_id::BIGINT AS message_id, responsiveness, "user", message FROM ranked
WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM cleaned GROUP BY "user"))"""


@query("c7_clean_messages", _CLEAN)
def c7(spark, d):
    return cl.clean_messages(chat(spark, d)).messages.select("message_id", "responsiveness", "user", "message")


@query("c7_renumbered", f"""
SELECT (row_number() OVER (ORDER BY "user", message_id) - 1)::BIGINT AS message_id, responsiveness, "user", message
FROM ({_CLEAN})""")
def c7_renumbered(spark, d):
    return cl.renumber(cl.clean_messages(chat(spark, d)).messages)


@query("c8_message_id", "SELECT conv_id AS chat_id, turn AS pos, conv_id * 4294967296 + turn AS message_id "
       "FROM conversations")
def c8(spark, d):
    return cl.with_message_id(chat(spark, d)).select("chat_id", "pos", "message_id")


@query("c8_dense_message_id", "SELECT conv_id AS chat_id, turn AS pos, "
       "(row_number() OVER (ORDER BY conv_id, turn) - 1)::BIGINT AS message_id FROM conversations")
def c8_dense(spark, d):
    return cl.with_message_id(chat(spark, d).select("chat_id", "pos"), dense=True)


@query("c8_large_chat_ids", "SELECT conv_id * 4294967296 + 7 AS chat_id, turn AS pos, "
       "(dense_rank() OVER (ORDER BY conv_id) - 1) * 4294967296 + turn AS message_id FROM conversations")
def c8_large(spark, d):
    rows = chat(spark, d).select((F.col("chat_id") * (1 << 32) + 7).alias("chat_id"), "pos")
    return cl.with_message_id(rows).select("chat_id", "pos", "message_id")


@query("c9_select_features", "SELECT doc_id AS message_id, length(text)::BIGINT AS char_count FROM documents")
def c9(spark, d):
    rows = build_features(docs(spark, d), FeatureConfig.only("char_count", "uppercase_count", "message_composition"))
    return select_features(rows, FeatureConfig.only("char_count"))


@query("c10_assemble_wide", """
SELECT vec_id AS message_id, i::INTEGER AS i, round(embedding[i + 1]::DOUBLE, 6) + 0.0 AS value
FROM embeddings, range(64) r(i)""")
def c10(spark, d):
    t = table(spark, d, "embeddings").select(F.col("vec_id").alias("message_id"), "embedding")
    back = assemble_wide(vector_to_columns(t, 64, "cls"), "cls_embed_")
    return back.select("message_id", F.posexplode("embedding").alias("i", "v")).select(
        "message_id", "i", (F.round(F.col("v").cast("double"), 6) + F.lit(0.0)).alias("value"))


def _events(spark, d: str):
    return table(spark, d, "events").select(
        F.col("user_id").alias("chat_id"), F.col("event_id").alias("pos"), "ts")


def _gap(order: str) -> str:
    return f"""
SELECT event_id AS pos, coalesce(greatest(sec - lag(sec) OVER ({order}), 0), 0)::BIGINT AS responsiveness
FROM (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS sec FROM events)"""


@query("w1_responsiveness", _gap("ORDER BY user_id, event_id"))
def w1(spark, d):
    return cl.responsiveness(_events(spark, d), "corpus").select("pos", "responsiveness")


@query("w1_responsiveness_chat", _gap("PARTITION BY user_id ORDER BY event_id"))
def w1_chat(spark, d):
    return cl.responsiveness(_events(spark, d), "chat").select("pos", "responsiveness")


@query("w2_index_users", """
SELECT author, (row_number() OVER (ORDER BY author) - 1)::INTEGER AS "user" FROM (SELECT DISTINCT c_name AS author
FROM customer)""")
def w2(spark, d):
    return cl.index_users(table(spark, d, "customer"), "c_name")


@query("t7_drop_blank", rf"""
SELECT doc_id, regexp_replace(line, '^[\s\x0b]+|[\s\x0b]+$', '', 'g') AS body
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE regexp_replace(line, '^[\s\x0b]+|[\s\x0b]+$', '', 'g') <> ''""")
def t7(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("body"))
    return cl.drop_blank(lines)
