"""Tokens and stylometric features."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import DOCS, EMOJI_DOCS, docs, emoji_docs, label_rows, query, r6, table
from inkprint.config import FeatureConfig
from inkprint.constants import (
    BAG_TOKEN_PATTERN, COMMON_WORDS, EMOJI_PATTERN, EMOTION_IDS, ENGLISH_WORDS, FUNCTION_TAGS, ITALIAN_WORDS, POS_TAGS,
    SENTIMENT_IDS, SPACE_CLASS, TAG_LEXICON, TOKEN_PATTERN, WORD_CLASS,
)
from inkprint.functions import rounding
from inkprint.functions import text as tx
from inkprint.functions import tokens as tk
from inkprint.operators import features as ft
from inkprint.operators.scorer import classify_words, fit_word_classes
from inkprint.sources.wordlists import build_vocabulary


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_LEXICON = ", ".join(f"('{w}', '{tag}')" for tag, words in TAG_LEXICON.items() for w in words)

# one row per token, with the tag by lexicon and rule and the sentence it belongs to
TOKENS = rf"""
SELECT message_id, i, text, lower(text) AS lemma,
    CASE WHEN tag IS NOT NULL THEN tag WHEN regexp_matches(text, '^\p{{N}}') THEN 'NUM'
         WHEN regexp_matches(text, '^\p{{P}}') THEN 'PUNCT' WHEN regexp_matches(text, '^\p{{S}}') THEN 'SYM'
         ELSE 'X' END AS pos,
    regexp_matches(text, '^\p{{L}}') AS is_alpha, regexp_matches(text, '^\p{{P}}') AS is_punct,
    greatest(sum(opens) OVER (PARTITION BY message_id ORDER BY i) - 1, 0)::BIGINT AS sent
FROM (SELECT *, (text NOT IN ('.', '!', '?', '…') AND coalesce(lag(text) OVER (PARTITION BY message_id ORDER BY i), '.')
                 IN ('.', '!', '?', '…'))::INT AS opens
      FROM (SELECT message_id, unnest(t) AS text, generate_subscripts(t, 1)::BIGINT - 1 AS i
            FROM (SELECT message_id, regexp_extract_all(message, '{TOKEN_PATTERN}') AS t FROM ({DOCS}))))
LEFT JOIN (VALUES {_LEXICON}) lex(word, tag) ON lower(text) = word"""


def _per_message(expr: str, name: str, empty: str = "0.0") -> str:
    return f"""WITH tok AS ({TOKENS}) SELECT message_id, coalesce({name}, {empty}) AS {name} FROM ({DOCS})
LEFT JOIN (SELECT message_id, {expr} AS {name} FROM tok GROUP BY message_id) USING (message_id)"""


def _tokens(spark, d):
    return tk.annotate(docs(spark, d).select("message_id", "message"))


@query("k0_annotate", TOKENS)
def k0(spark, d):
    return tk.token_table(_tokens(spark, d))


@query("k0_annotate_lexicons", rf"""
WITH lex AS (SELECT source AS word, min('L' || lang) AS lemma FROM documents GROUP BY source),
first AS (SELECT lower(t) AS word, CASE WHEN count(DISTINCT doc_id) >= 100 THEN 'NOUN' ELSE 'VERB' END AS tag
          FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{TOKEN_PATTERN}')) AS t FROM documents)
          WHERE regexp_matches(t, '^\p{{L}}') GROUP BY 1)
SELECT pos, count(*)::BIGINT AS n FROM (
    SELECT coalesce(tag, t.pos) AS pos FROM ({TOKENS}) t LEFT JOIN first ON t.lemma = first.word) GROUP BY pos""")
def k0_lexicons(spark, d):
    rows = docs(spark, d).select("message_id", "message")
    words = build_vocabulary(rows, min_docs=1)
    tags = words.select(F.col("word").alias("text"),
                        F.when(F.col("n_docs") >= 100, "NOUN").otherwise("VERB").alias("pos"))
    return tk.token_table(tk.annotate(rows, pos_table=tags)).groupBy("pos").agg(F.count("*").alias("n"))


@query("k1_uppercase_count", rf"""
SELECT message_id, length(regexp_replace(message, '[^\p{{Lu}}\x{{2160}}-\x{{216F}}\x{{24B6}}-\x{{24CF}}]', '', 'g'))::BIGINT
       AS uppercase_count FROM ({DOCS})""")
def k1(spark, d):
    return docs(spark, d).select("message_id", tx.uppercase_count("message").alias("uppercase_count"))


@query("k2_char_count", f"SELECT message_id, length(message)::BIGINT AS char_count FROM ({DOCS})")
def k2(spark, d):
    return docs(spark, d).select("message_id", tx.char_count("message").alias("char_count"))


@query("k3_word_length", rf"""
SELECT message_id, CASE WHEN len(w) = 0 THEN 0.0 ELSE
    format('{{:.2f}}', list_sum(list_transform(w, lambda x: length(x)))::DOUBLE / len(w))::DOUBLE END AS word_length
FROM (SELECT message_id, list_filter(regexp_split_to_array(message, '[{SPACE_CLASS}]+'), lambda x: x <> '') AS w
      FROM ({DOCS}))""")
def k3(spark, d):
    return docs(spark, d).select("message_id", tx.word_length("message").alias("word_length"))


@query("k4_emoji_count", f"""
SELECT message_id, len(regexp_extract_all(message, '{EMOJI_PATTERN}'))::BIGINT AS emoji_count FROM ({EMOJI_DOCS})""")
def k4(spark, d):
    return emoji_docs(spark, d).select("message_id", tx.emoji_count("message").alias("emoji_count"))


@query("k5_unique_emoji_count", f"""
SELECT message_id, len(list_distinct(regexp_extract_all(message, '{EMOJI_PATTERN}')))::BIGINT AS unique_emoji_count
FROM ({EMOJI_DOCS})""")
def k5(spark, d):
    return emoji_docs(spark, d).select("message_id", tx.unique_emoji_count("message").alias("unique_emoji_count"))


def _share_sql(words: str) -> str:
    return (f"format('{{:.2f}}', count(*) FILTER (is_alpha AND lemma IN ({words})) "
            "/ nullif(count(*) FILTER (is_alpha), 0)::DOUBLE)::DOUBLE")


@query("k6_vocabulary_count", _per_message(_share_sql("SELECT lower(c_mktsegment) FROM customer UNION SELECT 'the' UNION "
                                                      "SELECT 'la' UNION SELECT lang FROM documents"), "share"))
def k6(spark, d):
    words = table(spark, d, "customer").select(F.lower("c_mktsegment").alias("word")).union(
        docs(spark, d).select("lang")).union(spark.range(1).select(F.explode(F.array(F.lit("the"), F.lit("la")))))
    return tk.vocabulary_share(_tokens(spark, d), words, "share").select("message_id", "share")


@query("k7_englishness", _per_message(_share_sql(_list(ENGLISH_WORDS)), "englishness"))
def k7(spark, d):
    return _tokens(spark, d).select(
        "message_id", tk.vocabulary_share_inline("tokens", ENGLISH_WORDS).alias("englishness"))


@query("k8_italianness", rf"""
WITH tok AS (SELECT message_id, lang, lower(t) AS w FROM (
         SELECT message_id, lang, unnest(regexp_extract_all(message, '{TOKEN_PATTERN}')) AS t FROM ({DOCS}))
     WHERE regexp_matches(t, '^\p{{L}}')),
vocab AS (SELECT w FROM tok WHERE lang = 'es' GROUP BY w HAVING count(DISTINCT message_id) >= 20)
SELECT message_id, coalesce(share, 0.0) AS italianness FROM ({DOCS}) LEFT JOIN (
    SELECT message_id, format('{{:.2f}}', sum((w IN (SELECT w FROM vocab))::INT) / count(*)::DOUBLE)::DOUBLE AS share
    FROM tok GROUP BY message_id) USING (message_id)""")
def k8(spark, d):
    rows = docs(spark, d)
    words = build_vocabulary(rows.filter("lang = 'es'"), min_docs=20)
    config = FeatureConfig.only("italianness")
    return ft.build_features(rows.select("message_id", "message"), config, vocabularies={"italianness": words})


@query("k9_type_token_ratio", _per_message(
    "round(count(DISTINCT lemma) FILTER (is_alpha) / nullif(count(*) FILTER (is_alpha), 0)::DOUBLE, 6)", "ttr"))
def k9(spark, d):
    return _tokens(spark, d).select("message_id", r6(tk.type_token_ratio("tokens")).alias("ttr"))


@query("k10_simpsons_index", f"""
WITH tok AS ({TOKENS}), counts AS (SELECT message_id, lemma, count(*) AS n FROM tok WHERE is_alpha GROUP BY 1, 2)
SELECT message_id, coalesce(simpson, 0.0) AS simpson FROM ({DOCS}) LEFT JOIN (
    SELECT message_id, round(sum(n * (n - 1)) / nullif(sum(n) * (sum(n) - 1), 0)::DOUBLE, 6) AS simpson
    FROM counts GROUP BY message_id) USING (message_id)""")
def k10(spark, d):
    return _tokens(spark, d).select("message_id", r6(tk.simpsons_index("tokens")).alias("simpson"))


_POS_COLUMNS = ", ".join(
    f"coalesce(format('{{:.2f}}', count(i) FILTER (pos = '{t}') / nullif(count(i), 0)::DOUBLE)::DOUBLE, 0.0) AS \"{t}\""
    for t in POS_TAGS)


@query("k11_message_composition", f"""
WITH tok AS ({TOKENS}) SELECT message_id, {_POS_COLUMNS} FROM ({DOCS}) LEFT JOIN tok USING (message_id)
GROUP BY message_id""")
def k11(spark, d):
    return tk.add_pos_shares(_tokens(spark, d)).select("message_id", *POS_TAGS)


@query("k12_first_word_type", f"""
WITH tok AS ({TOKENS}) SELECT message_id, coalesce(list_position([{_list(POS_TAGS)}], pos) - 1, -1)::BIGINT AS first_type
FROM ({DOCS}) LEFT JOIN (SELECT message_id, pos FROM tok WHERE i = 0) USING (message_id)""")
def k12(spark, d):
    return _tokens(spark, d).select("message_id", tk.first_word_type("tokens").alias("first_type"))


# words of the texts stand in for the cues of real messages
_SENTIMENT = {"negative": ["the", "le", "der"], "positive": ["of", "la", "die"]}
_EMOTION = {"anger": ["the", "que"], "fear": ["of", "und"], "joy": ["to", "de"], "sadness": ["and", "los"]}


def _cue_sql(cues, ids) -> str:
    names = [n for n, _ in sorted(ids.items(), key=lambda item: item[1])]
    counts = ", ".join(f"count(*) FILTER (lemma IN ({_list(cues[n])}))" for n in names)
    return f"list_position([{counts}], list_max([{counts}])) - 1"


@query("k13_sentiment", _per_message(_cue_sql(_SENTIMENT, SENTIMENT_IDS) + "::BIGINT", "sentiment", "0::BIGINT"))
def k13(spark, d):
    return _tokens(spark, d).select(
        "message_id", tk.cue_class("tokens", _SENTIMENT, SENTIMENT_IDS).alias("sentiment"))


def _bayes_sql(labels: str, n: int, name: str) -> str:
    """Naive Bayes of the rows of ``labels`` (message_id, c), for all documents."""
    share = ", ".join(f"ln((count(*) FILTER (c = {k}) + 1) / ((SELECT count(*) FROM w WHERE c = {k}) + (SELECT count(DISTINCT word) FROM w))::DOUBLE) "
                      f"AS l{k}" for k in range(n))
    prior = ", ".join(f"(SELECT ln(count(*) FILTER (c = {k}) / count(*)::DOUBLE) FROM lab) AS p{k}" for k in range(n))
    total = ", ".join(f"round(coalesce(sum(l{k}), 0) + any_value(p{k}), 6)" for k in range(n))
    return rf"""
WITH lab AS ({labels}), tok AS (SELECT message_id, unnest(regexp_extract_all(lower(message), '{BAG_TOKEN_PATTERN}')) AS word FROM ({DOCS})),
w AS (SELECT c, word FROM lab JOIN tok USING (message_id)), m AS (SELECT word, {share} FROM w GROUP BY word), p AS (SELECT {prior}),
s AS (SELECT d.message_id, [{total}] AS t FROM ({DOCS}) d CROSS JOIN p LEFT JOIN tok USING (message_id) LEFT JOIN m USING (word)
      GROUP BY d.message_id)
SELECT message_id, (list_position(t, list_max(t)) - 1)::BIGINT AS {name} FROM s"""


# a fifth of the ids, by their digest, is held out
_FIFTH = "('0x' || substr(md5({0}::VARCHAR), 1, 8))::BIGINT % 5 <> 0"


def _learned(column: str = "message_id"):
    return F.pmod(F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(5)) != 0


@query("k13_sentiment_fitted", _bayes_sql(f"SELECT doc_id AS message_id, quality AS c FROM labels WHERE {_FIFTH.format('doc_id')}", 2, "sentiment"))
def k13_fitted(spark, d):
    """The labels of quality stand in for sentiment; learned from four fifths of them, said of every document."""
    rows = docs(spark, d).select("message_id", "message")
    model = fit_word_classes(rows.join(label_rows(spark, d).where(_learned()), "message_id"), "user", 2)
    return classify_words(rows, model, "sentiment").select("message_id", "sentiment")


@query("k14_emotion_fitted", _bayes_sql(
    f"SELECT message_id, list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS c FROM ({DOCS}) WHERE {_FIFTH.format('message_id')}", 4, "emotion"))
def k14_fitted(spark, d):
    """The four languages stand in for the four emotions."""
    rows = docs(spark, d)
    label = F.array_position(F.array(*map(F.lit, ["de", "en", "es", "fr"])), F.col("lang")) - 1
    model = fit_word_classes(rows.where(_learned()).withColumn("c", label), "c", 4)
    return classify_words(rows, model, "emotion").select("message_id", "emotion")


@query("k14_emotion", _per_message(_cue_sql(_EMOTION, EMOTION_IDS) + "::BIGINT", "emotion", "0::BIGINT"))
def k14(spark, d):
    return _tokens(spark, d).select("message_id", tk.cue_class("tokens", _EMOTION, EMOTION_IDS).alias("emotion"))


# neutral entries that occur in the texts stand in for a list of swear words
_LISTED = ["the", "with", "of the", "elle", "und", "que", "leé"]
_CLIPPED = sorted(tx.with_clipped(_LISTED), key=lambda w: (-len(w), w))
_ALTERNATION = "|".join(w.replace(" ", "  ") for w in _CLIPPED)


@query("k15_swear_words", rf"""
SELECT message_id, len(regexp_extract_all(regexp_replace(message, '([^{WORD_CLASS}])', '\1\1', 'g'),
    '(?i)(?:^|[^{WORD_CLASS}])(?:{_ALTERNATION})(?:$|[^{WORD_CLASS}])'))::BIGINT AS swear_words FROM ({DOCS})""")
def k15(spark, d):
    return docs(spark, d).select("message_id", tx.swear_count("message", _LISTED).alias("swear_words"))


@query("k16_common_words", _per_message(
    f"round(count(*) FILTER (lemma IN ({_list(COMMON_WORDS)})) / count(*)::DOUBLE, 6)", "common"))
def k16(spark, d):
    return _tokens(spark, d).select("message_id", r6(tk.common_share_inline("tokens", COMMON_WORDS)).alias("common"))


@query("k16_common_words_join", _per_message(
    "round(count(*) FILTER (lemma IN (SELECT lower(p_type) FROM part UNION SELECT lang FROM documents UNION SELECT 'a')) "
    "/ count(*)::DOUBLE, 6)", "common"))
def k16_join(spark, d):
    words = table(spark, d, "part").select(F.lower("p_type").alias("word")).union(
        docs(spark, d).select("lang")).union(spark.range(1).select(F.lit("a")))
    return tk.common_share(_tokens(spark, d), words, "common").select("message_id", r6("common").alias("common"))


@query("k17_readability", _per_message("""
CASE WHEN count(*) FILTER (NOT is_punct) = 0 THEN 100.0 ELSE round(89 + (300 * (max(sent) + 1)
     - 10 * sum(length(text)) FILTER (NOT is_punct)) / (count(*) FILTER (NOT is_punct))::DOUBLE, 6) END""",
                                       "readability", "100.0"))
def k17(spark, d):
    return _tokens(spark, d).select("message_id", r6(tk.readability("tokens")).alias("readability"))


@query("k18_functional_words", _per_message(
    f"round(count(*) FILTER (pos IN ({_list(FUNCTION_TAGS)})) / nullif(count(*) FILTER (NOT is_punct), 0)::DOUBLE, 6)",
    "functional"))
def k18(spark, d):
    return _tokens(spark, d).select("message_id", r6(tk.functional_share("tokens")).alias("functional"))


BAG = rf"""
WITH words AS (SELECT message_id, md5(unnest(regexp_extract_all(lower(message), '{BAG_TOKEN_PATTERN}'))) AS h
               FROM ({DOCS})),
sums AS (SELECT message_id, (('0x' || substr(h, 1, 8))::BIGINT % 4096)::INTEGER AS bucket,
                sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS v FROM words GROUP BY 1, 2)
SELECT message_id, bucket, round(v / sqrt(sum(v * v) OVER (PARTITION BY message_id)), 6) AS value
FROM sums WHERE v <> 0"""


@query("k19_bag_of_words", BAG)
def k19(spark, d):
    bag = ft.bag_entries(ft.bag_of_words(docs(spark, d), hasher="md5"))
    return bag.select("message_id", "bucket", r6("value").alias("value"))


@query("k19_bag_of_words_murmur3")
def k19_murmur3(spark, d):
    return ft.bag_entries(ft.bag_of_words(docs(spark, d), hasher="murmur3"))


@query("k20_vocabulary_size", rf"""
SELECT n_words, power(2, ceil(log2(n_words)))::BIGINT AS width FROM (
    SELECT count(DISTINCT w)::BIGINT AS n_words FROM (
        SELECT unnest(regexp_extract_all(lower(text), '{BAG_TOKEN_PATTERN}')) AS w FROM documents))""")
def k20(spark, d):
    return ft.vocabulary_size(docs(spark, d))


@query("k21_responsiveness_switch", """
SELECT event_id AS message_id, length(event_type)::BIGINT AS char_count,
       coalesce(greatest(sec - lag(sec) OVER (PARTITION BY user_id ORDER BY event_id), 0), 0)::BIGINT AS responsiveness
FROM (SELECT *, floor(epoch(ts))::BIGINT AS sec FROM events)""")
def k21(spark, d):
    from inkprint.operators.clean import responsiveness
    events = table(spark, d, "events").select(F.col("user_id").alias("chat_id"), F.col("event_id").alias("pos"), "ts",
                                              F.col("event_id").alias("message_id"), F.col("event_type").alias("message"))
    config = FeatureConfig.only("responsiveness", "char_count")
    return ft.build_features(responsiveness(events, "chat"), config)


@query("k22_build_features", f"""
WITH tok AS ({TOKENS}), bag AS (SELECT message_id, count(*) AS bag_size, sum(round(value * 1000000))::BIGINT AS bag_sum FROM ({BAG})
                                GROUP BY message_id),
lex AS (SELECT message_id, {_share_sql(_list(ENGLISH_WORDS))} AS english, {_share_sql(_list(ITALIAN_WORDS))} AS italian,
               format('{{:.2f}}', count(*) FILTER (pos = 'PUNCT') / count(*)::DOUBLE)::DOUBLE AS punct FROM tok GROUP BY 1)
SELECT message_id, length(message)::BIGINT AS char_count, coalesce(english, 0.0) AS englishness,
       coalesce(italian, 0.0) AS italianness, coalesce(punct, 0.0) AS "PUNCT", coalesce(bag_size, 0)::BIGINT AS bag_size,
       coalesce(bag_sum, 0)::BIGINT AS bag_sum
FROM ({DOCS}) LEFT JOIN lex USING (message_id) LEFT JOIN bag USING (message_id)""")
def k22(spark, d):
    from pyspark.ml.functions import vector_to_array
    table_ = ft.build_features(docs(spark, d), FeatureConfig(), hasher="md5")
    values = F.filter(vector_to_array("bow"), lambda v: v != 0)
    total = F.aggregate(values, F.lit(0).cast("long"), lambda acc, v: acc + F.round(F.round(v, 6) * 1000000).cast("long"))
    return table_.select("message_id", "char_count", "englishness", "italianness", "PUNCT",
                         F.size(values).cast("long").alias("bag_size"), total.alias("bag_sum"))


@query("k23_scalar_helpers", """
SELECT event_id, round(least(greatest(value / 100, 0.001), 0.999), 6) AS clipped,
       round(ln(least(greatest(value / 100, 0.001), 0.999) / (1 - least(greatest(value / 100, 0.001), 0.999))), 6) AS odds,
       format('{:.2f}', value / 7)::DOUBLE AS seventh, abs(value - 20) AS gap FROM events""")
def k23(spark, d):
    share = F.col("value") / 100
    return table(spark, d, "events").select(
        "event_id", r6(tx.clip(share, 0.001, 0.999)).alias("clipped"), r6(tx.log_odds(share)).alias("odds"),
        rounding.round_binary(F.col("value") / 7).alias("seventh"), F.abs(F.col("value") - 20).alias("gap"))
