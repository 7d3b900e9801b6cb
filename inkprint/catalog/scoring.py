"""Scoring, verdicts, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import PROBS, probs, query, r6, table
from inkprint.catalog.models import STYLE, trained_stack
from inkprint.catalog.sources import write_exports
from inkprint.constants import SPACE_CLASS
from inkprint.operators.clean import with_message_id
from inkprint.operators.embed import embed_hashed
from inkprint.operators.features import build_features
from inkprint.plans import scoring as sc
from inkprint.session import scratch_path
from inkprint.streaming.ingest import ingest_stream
from inkprint.streaming.score import running_stream, score_stream, stream_totals


def _class_rows(spark, d: str):
    """Events as scored messages: conversation user_id, class by event type, value in cents.

    Whole numbers make the averages exact, so no rounding hides or makes a difference.
    """
    return table(spark, d, "events").select(
        F.col("user_id").alias("chat_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("user"),
        F.round(F.col("value") * 100).alias("p"))


_ROWS = "SELECT user_id AS chat_id, event_id AS pos, event_type AS \"user\", round(value * 100)::BIGINT AS p FROM events"
_RUNNING = f"""
SELECT chat_id, pos, "user", avg(p) OVER (PARTITION BY chat_id, "user" ORDER BY pos
       ROWS UNBOUNDED PRECEDING) AS average FROM ({_ROWS})"""


@query("w3_running_average", _RUNNING)
def w3(spark, d):
    return sc.running_average(_class_rows(spark, d)).select("chat_id", "pos", "user", "average")


@query("a10_overall_average", f"""
SELECT chat_id, "user", avg(p) AS average, count(*)::BIGINT AS n FROM ({_ROWS}) GROUP BY chat_id, "user" """)
def a10(spark, d):
    return sc.overall_average(_class_rows(spark, d)).select("chat_id", "user", "average", "n")


@query("t1_running_average_global", """
SELECT pos, "user", avg(p) OVER (PARTITION BY "user" ORDER BY pos ROWS UNBOUNDED PRECEDING) AS average
FROM (""" + _ROWS + ")")
def t1_global(spark, d):
    rows = _class_rows(spark, d).drop("chat_id")
    return sc.running_average(rows, ()).select("pos", "user", "average")


def _features(rows):
    return build_features(rows.select("message_id", "message"), STYLE)


def _embeddings(rows):
    return embed_hashed(rows.select("message_id", "message"), "mean")


def _messages(frame):
    rows = frame.select(F.col("conv_id").alias("chat_id"), F.col("turn").alias("pos"), F.col("text").alias("message"))
    return with_message_id(rows)


@query("t1_score_messages")
def t1(spark, d):
    stack, _ = trained_stack(spark, d)
    scored = sc.score_messages(_messages(table(spark, d, "conversations")), stack, _features, _embeddings)
    return scored.select("chat_id", "pos", "user", "author", r6("p").alias("p"), r6("average").alias("average"))


def _stream(spark, d: str, name: str):
    """A table as a stream, be it one file or a folder of files; the pattern matches only its name."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).parquet(f"{d}/{name}.parque[t]")


@query("t2_score_stream")
def t2(spark, d):
    stack, _ = trained_stack(spark, d)
    home = scratch_path(spark, "stream")

    def score(batch):
        rows = _messages(batch)
        probability = stack.predict(_features(rows), _embeddings(rows)).select("message_id", "probability")
        return sc.explode_classes(rows.select("message_id", "chat_id", "pos").join(probability, "message_id"))

    score_stream(_stream(spark, d, "conversations"), score, f"{home}/out", f"{home}/state",
                 f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{home}/out").select("chat_id", "pos", "user", r6("p").alias("p"),
                                                    r6("average").alias("average"))


@query("t2_stream_running_average", _RUNNING)
def t2_running(spark, d):
    """Events arrive in three deliveries; each is one run of the same stream."""
    home = scratch_path(spark, "stream")
    events = table(spark, d, "events")
    third = (events.agg(F.max("event_id")).first()[0] + 1) / 3
    for i in range(3):
        part = F.floor(F.col("event_id") / F.lit(third)) == i
        events.filter(part).write.mode("append").parquet(f"{home}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{home}/in").select(
            F.col("user_id").alias("chat_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("user"),
            F.round(F.col("value") * 100).alias("p"))
        score_stream(stream, lambda batch: batch, f"{home}/out", f"{home}/state", f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{home}/out").select("chat_id", "pos", "user", "average")


@query("t2_stream_state", _RUNNING)
def t2_state(spark, d):
    """As above, with the sums in the state store: two deliveries, two runs of one query."""
    home = scratch_path(spark, "stream")
    events = table(spark, d, "events")
    half = (events.agg(F.max("event_id")).first()[0] + 1) / 2
    for i in range(2):
        events.filter(F.floor(F.col("event_id") / F.lit(half)) == i).write.mode("append").parquet(f"{home}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{home}/in").select(
            F.col("user_id").alias("chat_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("user"),
            F.round(F.col("value") * 100).alias("p"))
        running_stream(stream).writeStream.outputMode("append").format("parquet").option("path", f"{home}/out") \
            .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{home}/out").select("chat_id", "pos", "user", "average")


@query("t2_stream_totals", f"""
SELECT chat_id, "user", avg(p) AS average, count(*)::BIGINT AS n FROM ({_ROWS}) GROUP BY chat_id, "user" """)
def t2_totals(spark, d):
    home = scratch_path(spark, "totals")
    stream = _stream(spark, d, "events").select(
        F.col("user_id").alias("chat_id"), F.col("event_type").alias("user"), F.round(F.col("value") * 100).alias("p"))
    (
        stream_totals(stream).writeStream.outputMode("complete")
        .foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{home}/out"))
        .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(f"{home}/out").select("chat_id", "user", "average", "n")


@query("t3_ingest_stream", rf"""
SELECT 1704067200 + conv_id * 3600 + turn * 60 AS sec, role || ' ' || conv_id AS author,
       regexp_replace(replace(text, chr(10), ' '), '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g') AS body
FROM conversations""")
def t3(spark, d):
    home = scratch_path(spark, "ingest")
    folder = write_exports(spark, d)
    ingest_stream(spark, f"{folder}/*", f"{home}/out", f"{home}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{home}/out").select(F.unix_seconds("ts").alias("sec"), "author", "body")


_GAP = "list_avg(list_transform(list_filter(f, lambda x: x <> list_max(f)), lambda x: list_max(f) - x))"


@query("t4_verdict", f"""
SELECT message_id, list_position(f, list_max(f)) - 1 AS "user",
       CASE WHEN {_GAP} < 0.25 THEN 'Doubtful' WHEN {_GAP} < 0.5 THEN 'Probable' ELSE 'Certain' END AS certainty
FROM ({PROBS})""".replace('- 1 AS "user"', '- 1::BIGINT AS "user"'))
def t4(spark, d):
    return sc.verdict(probs(spark, d).select("message_id", "probs_feature"), "probs_feature").select(
        "message_id", "user", "certainty")


@query("t5_report", f"""
SELECT message_id, i::BIGINT AS "user", format('{{:.2f}}', f[i + 1] * 100) AS percent,
       i = list_position(f, list_max(f)) - 1 AS highlight FROM ({PROBS}), range(10) r(i)""")
def t5(spark, d):
    return sc.report(probs(spark, d).select("message_id", "probs_feature"), "probs_feature")
