"""The flagship: conversations, cleaned and balanced, to the mean style of each author."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkprint.catalog.base import chat, query, r6
from inkprint.catalog.cleaning import _CLEAN
from inkprint.config import FeatureConfig
from inkprint.constants import ENGLISH_WORDS, SPACE_CLASS, TOKEN_PATTERN
from inkprint.operators.clean import clean_messages
from inkprint.operators.features import build_features

_WORDS = ", ".join(f"'{w}'" for w in ENGLISH_WORDS)

FLAGSHIP_SQL = rf"""
WITH clean AS ({_CLEAN}),
tok AS (SELECT message_id, unnest(regexp_extract_all(message, '{TOKEN_PATTERN}')) AS t FROM clean),
alpha AS (SELECT message_id, lower(t) AS w FROM tok WHERE regexp_matches(t, '^\p{{L}}')),
lexical AS (SELECT message_id, format('{{:.2f}}', sum((w IN ({_WORDS}))::INT) / count(*)::DOUBLE)::DOUBLE AS known,
                   count(DISTINCT w) / count(*)::DOUBLE AS ttr FROM alpha GROUP BY message_id),
scored AS (SELECT "user", length(regexp_replace(message, '[^\p{{Lu}}]', '', 'g')) AS upper_n, length(message) AS chars,
    coalesce(CASE WHEN regexp_matches(message, '[^{SPACE_CLASS}]') THEN
        format('{{:.2f}}', length(regexp_replace(message, '[{SPACE_CLASS}]', '', 'g'))::DOUBLE
        / len(regexp_extract_all(message, '[^{SPACE_CLASS}]+')))::DOUBLE END, 0) AS words,
    coalesce(known, 0) AS known, coalesce(ttr, 0) AS ttr FROM clean LEFT JOIN lexical USING (message_id))
SELECT "user", count(*)::BIGINT AS n, round(avg(upper_n), 6) AS uppercase_count, round(avg(chars), 6) AS char_count,
       round(avg(words), 6) AS word_length, round(avg(known), 6) AS englishness, round(avg(ttr), 6) AS type_token_ratio
FROM scored GROUP BY "user" """


@query("flagship_author_style", FLAGSHIP_SQL)
def flagship(spark, d):
    names = ["uppercase_count", "char_count", "word_length", "englishness", "type_token_ratio"]
    clean = clean_messages(chat(spark, d))
    features = build_features(clean.messages, FeatureConfig.only(*names))
    return features.groupBy("user").agg(F.count("*").alias("n"), *[r6(F.avg(c)).alias(c) for c in names])
