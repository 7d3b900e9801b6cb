"""Exported text to message rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import query, table
from inkprint.catalog.sources import write_exports
from inkprint.constants import ANDROID_STAMP, IOS_STAMP, SPACE_CLASS
from inkprint.operators.parse import (
    detect_dialect, extract_folder, extract_messages, parse_stamp, render_export, resolve_aliases, split_author,
    split_records,
)

_ANDROID = ANDROID_STAMP.replace(r"\d", r"\p{Nd}")
_IOS = IOS_STAMP.replace(r"\d", r"\p{Nd}")


def single_exports(spark, d: str):
    """Each turn as a small export of its own, one role in each dialect and one in neither."""
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    dialect = F.when(F.col("role") == "assistant", "ios").otherwise("android")
    text = F.when(F.col("role") == "system", F.col("text")).otherwise(
        render_export(ts, F.col("role"), "text", dialect))
    return table(spark, d, "conversations").select("conv_id", "turn", text.alias("value"))


SINGLE = r"""
SELECT conv_id, turn, role, text, CASE role WHEN 'system' THEN text
    WHEN 'assistant' THEN '[' || strftime(ts, '%-d/%-m/%Y, %H:%M') || ':00] ' || role || ': ' || text
    ELSE strftime(ts, '%d/%m/%Y, %H:%M') || ' - ' || role || ': ' || text END AS value
FROM (SELECT *, make_timestamp((1704067200 + conv_id * 3600 + turn * 60) * 1000000) AS ts FROM conversations)"""


def document_exports(spark, d: str):
    """Each document as an export in which every line is a message, written by its language."""
    head = F.concat(F.lit("03/04/2024, 10:11 - "), F.col("lang"), F.lit(": "))
    value = F.concat(head, F.replace(F.col("text"), F.lit("\n"), F.concat(F.lit("\n"), head)))
    return table(spark, d, "documents").select(F.col("doc_id").alias("chat_id"), value.alias("value"))


DOC_LINES = """
SELECT doc_id AS chat_id, lang, generate_subscripts(lines, 1) - 1 AS pos, unnest(lines) AS line
FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents)"""


@query("p1_detect_dialect", f"""
SELECT conv_id, turn, CASE WHEN regexp_matches(value, '^{_IOS}') THEN 'ios'
    WHEN regexp_matches(value, '^{_ANDROID}') THEN 'android' END AS dialect FROM ({SINGLE})""")
def p1(spark, d):
    return detect_dialect(single_exports(spark, d)).select("conv_id", "turn", "dialect")


@query("p2_split_records", f"""
SELECT chat_id, pos::BIGINT AS pos, '03/04/2024, 10:11 - ' AS stamp, lang || ': ' || line ||
    CASE WHEN pos < max(pos) OVER (PARTITION BY chat_id) THEN chr(10) ELSE '' END AS record FROM ({DOC_LINES})""")
def p2(spark, d):
    found = detect_dialect(document_exports(spark, d))
    return split_records(found).select("chat_id", "pos", "stamp", "record")


@query("p3_parse_stamp", """
SELECT o_orderkey, epoch(make_timestamp(year(o_orderdate) , month(o_orderdate), day(o_orderdate),
       o_orderkey % 24, o_orderkey % 60, 0))::BIGINT AS sec FROM orders""")
def p3(spark, d):
    day = F.col("o_orderdate").cast("timestamp")
    stamp = F.concat(F.date_format(day, "dd/MM/yyyy, "), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"),
                     F.lit(":"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"), F.lit(" - "))
    return table(spark, d, "orders").select("o_orderkey", F.unix_seconds(parse_stamp(stamp)).alias("sec"))


@query("p4_split_author", rf"""
SELECT doc_id, CASE WHEN owned THEN lang ELSE 'info' END AS author, CASE WHEN owned
    THEN regexp_replace(replace(text, chr(10), ' '), '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g') ELSE text END AS body
FROM (SELECT doc_id, lang, text, source < 'src5' AS owned FROM documents)""")
def p4(spark, d):
    t = table(spark, d, "documents")
    record = F.when(F.col("source") < "src5", F.concat("lang", F.lit(": "), "text")).otherwise(F.col("text"))
    author, body = split_author("record")
    return t.withColumn("record", record).select("doc_id", author.alias("author"), body.alias("body"))


def _source_aliases(spark, d: str):
    return table(spark, d, "documents").filter("source < 'src5'").groupBy(F.col("source").alias("alias")).agg(
        F.concat(F.lit("team "), F.min("lang")).alias("canonical"))


_ALIASED = """
SELECT doc_id, CASE WHEN author = 'info' THEN 'info' ELSE coalesce(canonical, 'other') END AS author
FROM (SELECT doc_id, CASE WHEN source = 'src7' THEN 'info' ELSE source END AS author FROM documents)
LEFT JOIN (SELECT source AS alias, 'team ' || min(lang) AS canonical FROM documents
           WHERE source < 'src5' GROUP BY source) ON author = alias"""


@query("p5_resolve_aliases", _ALIASED)
def p5(spark, d):
    msgs = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("source") == "src7", "info").otherwise(F.col("source")).alias("author"))
    return resolve_aliases(msgs, _source_aliases(spark, d))


@query("p6_extract_messages", rf"""
SELECT chat_id, pos::BIGINT AS pos, epoch(TIMESTAMP '2024-04-03 10:11:00')::BIGINT AS sec, lang AS author,
       regexp_replace(line, '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g') AS body FROM ({DOC_LINES})""")
def p6(spark, d):
    return extract_messages(document_exports(spark, d)).select(
        "chat_id", "pos", F.unix_seconds("ts").alias("sec"), "author", "body")


@query("p6_extract_folder", rf"""
SELECT 1704067200 + conv_id * 3600 + turn * 60 AS sec, role || ' ' || conv_id AS author,
       regexp_replace(replace(text, chr(10), ' '), '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g') AS body
FROM conversations""")
def p6_folder(spark, d):
    msgs = extract_folder(spark, write_exports(spark, d))
    return msgs.select(F.unix_seconds("ts").alias("sec"), "author", "body")
