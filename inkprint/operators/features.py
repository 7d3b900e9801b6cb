"""The feature table: every enabled stylometric feature of every message."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.config import FeatureConfig
from inkprint.constants import (
    BAG_TOKEN_PATTERN, BAG_WIDTH, COMMON_WORDS, ENGLISH_WORDS, ITALIAN_WORDS, EMOTION_CUES, EMOTION_IDS, MILD_SWEAR_WORDS, POS_TAGS, SENTIMENT_CUES, SENTIMENT_IDS,
)
from inkprint.functions import text as tx
from inkprint.functions import tokens as tk
from inkprint.functions.hashing import murmur3_words
from inkprint.sources.wordlists import inline_words

_EXTRA: dict[str, Callable[[Column], Column]] = {}


def register_feature(name: str, fn: Callable[[Column], Column]) -> None:
    """Add a feature computed from the message column; enable it by name in a FeatureConfig."""
    _EXTRA[name] = fn


def _codes_md5(words: Column, n: int) -> Column:
    def code(word: Column) -> Column:
        return _let(F.md5(word), lambda digest: F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int") * 2
                    + F.when(F.substring(digest, 9, 1) < "8", 1).otherwise(0))
    return F.transform(words, code)


def _codes_xxhash64(words: Column, n: int) -> Column:
    return F.transform(words, lambda w: _let(F.xxhash64(w), lambda h: F.pmod(h, F.lit(n)).cast("int") * 2 + F.when(h >= 0, 1).otherwise(0)))


def _codes_murmur3(words: Column, n: int) -> Column:
    """Signed 32-bit MurmurHash3 with seed 0: column |h| mod n, sign of h."""
    hashed = murmur3_words(words)
    return F.transform(hashed, lambda h: F.pmod(F.abs(h.cast("long")), F.lit(n)).cast("int") * 2 + F.when(h >= 0, 1).otherwise(0))


# words to numbers 2 * bucket + (1 where the sign is positive)
_HASHERS = {"xxhash64": _codes_xxhash64, "md5": _codes_md5, "murmur3": _codes_murmur3}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def bag(m: Column | str, n: int = BAG_WIDTH, hasher: str = "xxhash64") -> Column:
    """struct(buckets, values): signed feature hashing of the words of one message, scaled to length 1.

    Words become numbers 2 * bucket + sign; sorted, equal ones are runs, and the two runs of a bucket stand side by side.
    """
    def ends(codes: Column) -> Column:
        last = F.transform(codes, lambda x, i: F.when((i == F.size(codes) - 1) | (x != F.get(codes, i + 1)), i))
        return F.filter(last, lambda i: i.isNotNull())

    def runs(codes: Column, last: Column) -> Column:
        return F.transform(last, lambda e, j: F.struct(F.get(codes, e).alias("code"), (e - F.coalesce(F.get(last, j - 1), F.lit(-1))).alias("n")))

    def entries(found: Column) -> Column:
        def one(r, j):
            before, after, positive = F.get(found, j - 1)["code"], F.get(found, j + 1), r["code"] % 2 == 1
            value = F.when(positive, r["n"]).otherwise(F.when(after["code"] == r["code"] + 1, after["n"]).otherwise(0) - r["n"])
            second = positive & F.coalesce(before == r["code"] - 1, F.lit(False))  # counted with the run before
            return F.struct(F.floor(r["code"] / 2).cast("int").alias("bucket"), F.when(second, 0).otherwise(value).cast("double").alias("v"))
        return F.filter(F.transform(found, one), lambda e: e["v"] != 0)

    def scaled(e: Column) -> Column:
        norm = F.sqrt(F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x["v"] * x["v"]))
        return _let(norm, lambda length: F.struct(F.transform(e, lambda x: x["bucket"]).alias("buckets"),
                                                  F.transform(e, lambda x: x["v"] / length).alias("values")))

    codes = F.sort_array(_HASHERS[hasher](F.coalesce(tx.bag_tokens(m), F.array().cast("array<string>")), n))
    return _let(codes, lambda c: _let(ends(c), lambda last: _let(runs(c, last), lambda found: _let(entries(found), scaled))))


def bag_of_words(df: DataFrame, n: int = BAG_WIDTH, hasher: str = "xxhash64", text: str = "message",
                 key: str = "message_id") -> DataFrame:
    """key, buckets, values of every message with words; nothing is exchanged."""
    worded = df.where(F.lower(tx.col(text)).rlike(BAG_TOKEN_PATTERN))
    return worded.select(key, bag(text, n, hasher).alias("_bag")).select(key, "_bag.*")


def bag_entries(bag: DataFrame, key: str = "message_id") -> DataFrame:
    """One row per non-zero column of a bag: key, bucket, value."""
    zipped = F.arrays_zip(F.col("buckets").alias("bucket"), F.col("values").alias("value"))
    return bag.select(key, F.inline(zipped))


def sparse_vector(buckets: Column, values: Column, n: int) -> Column:
    """ML sparse vector from its parts, inside the JVM."""
    shape = T.StructType([T.StructField("v", VectorUDT())])
    parts = F.struct(F.struct(
        F.lit(0).alias("type"), F.lit(n).alias("size"),
        F.coalesce(buckets, F.array().cast("array<int>")).alias("indices"),
        F.coalesce(values, F.array().cast("array<double>")).alias("values")).alias("v"))
    return F.from_json(F.to_json(parts), shape)["v"]


def vocabulary_size(df: DataFrame, text: str = "message") -> DataFrame:
    """n_words (distinct words of the corpus) and width, the next power of two."""
    words = df.select(F.explode(F.array_distinct(tx.bag_tokens(text))).alias("_word"))
    counted = words.groupBy("_word").count().agg(F.count("*").alias("n_words"))
    width = F.pow(F.lit(2.0), F.ceil(F.log2("n_words"))).cast("long")
    return counted.withColumn("width", width)


def _add_share(df: DataFrame, words, out: str, inline, joined) -> DataFrame:
    if isinstance(words, DataFrame):
        short = inline_words(words)
        if short is None:
            return joined(df, words, out)
        words = short
    return df.withColumn(out, inline("tokens", list(words)))


def build_features(df: DataFrame, config: FeatureConfig | None = None,
                   vocabularies: Mapping[str, DataFrame | Iterable[str]] | None = None,
                   swear_words: Sequence[str] | None = None,
                   common_words: DataFrame | Iterable[str] | None = None,
                   lemma_table: DataFrame | None = None, pos_table: DataFrame | None = None,
                   hasher: str = "xxhash64", bag_width: int = BAG_WIDTH,
                   sentiment=None, emotion=None, tagger=None) -> DataFrame:
    """message_id, user, the enabled features, 19 tag shares and the bag as one sparse vector.

    Everything but over-long word lists is computed in the scan of the messages; no text is exchanged. ``sentiment``/``emotion`` may be functions of a DataFrame that add the
    class column; without them the short cue lists decide. ``tagger`` takes the place of the rules and
    short lexicon that tag the tokens (see ``annotate_with``).
    """
    if "message" not in df.columns:
        raise KeyError("message")
    config = config or FeatureConfig()
    vocabularies = vocabularies or {}
    keys = [c for c in ("message_id", "user") if c in df.columns]
    use_bag = config.is_on("bag_of_words")
    out = tk.annotate(df, lemma_table=lemma_table, pos_table=pos_table) if tagger is None else tk.annotate_with(df, tagger)

    columns: list[str] = []
    shares: list[tuple] = []
    plain: dict[str, Column] = {}
    compose = False
    for name in config.enabled():
        if name == "bag_of_words":
            continue
        if name == "responsiveness":
            if "responsiveness" in df.columns:
                columns.append(name)
            continue
        if name == "message_composition":
            compose = True
            columns.extend(POS_TAGS)
            continue
        if name in ("englishness", "italianness"):
            words = vocabularies.get(name, ENGLISH_WORDS if name == "englishness" else ITALIAN_WORDS)
            shares.append((words, name, tk.vocabulary_share_inline, tk.vocabulary_share))
        elif name == "common_words":
            shares.append((COMMON_WORDS if common_words is None else common_words, name,
                           tk.common_share_inline, tk.common_share))
        elif name == "swear_words":
            plain[name] = tx.swear_count("message", MILD_SWEAR_WORDS if swear_words is None else swear_words)
        elif name == "sentiment":
            if sentiment is None:
                plain[name] = tk.cue_class("tokens", SENTIMENT_CUES, SENTIMENT_IDS)
            else:
                out = sentiment(out, name)
        elif name == "emotion":
            if emotion is None:
                plain[name] = tk.cue_class("tokens", EMOTION_CUES, EMOTION_IDS)
            else:
                out = emotion(out, name)
        elif name in _TEXT_FEATURES:
            plain[name] = _TEXT_FEATURES[name]("message")
        elif name in _TOKEN_FEATURES:
            plain[name] = _TOKEN_FEATURES[name]("tokens")
        elif name in _EXTRA:
            plain[name] = _EXTRA[name](F.col("message"))
        else:
            raise ValueError(f"unknown feature: {name}")
        columns.append(name)
    for words, name, inline, joined in shares:
        out = _add_share(out, words, name, inline, joined)
    out = out.withColumns(plain) if plain else out
    out = tk.add_pos_shares(out) if compose else out
    if use_bag:
        out = out.withColumn("_bag", bag("message", bag_width, hasher)) \
            .withColumn("bow", sparse_vector(F.col("_bag.buckets"), F.col("_bag.values"), bag_width))
    return out.select(*keys, *columns, *(["bow"] if use_bag else []))


_TEXT_FEATURES = {
    "uppercase_count": tx.uppercase_count,
    "char_count": tx.char_count,
    "word_length": tx.word_length,
    "emoji_count": tx.emoji_count,
    "unique_emoji_count": tx.unique_emoji_count,
}

_TOKEN_FEATURES = {
    "type_token_ratio": tk.type_token_ratio,
    "simpsons_index": tk.simpsons_index,
    "first_word_type": tk.first_word_type,
    "readability": tk.readability,
    "functional_words": tk.functional_share,
}


def select_features(df: DataFrame, config: FeatureConfig) -> DataFrame:
    """Drop the columns of disabled features, ignoring those that are absent.

    Columns named by digits only are single bag-of-words columns.
    """
    off = set(config.disabled_columns())
    if "bag_of_words" in off:
        off |= {"bow", "buckets", "values"} | {c for c in df.columns if c.isdigit()}
    return df.select(*[c for c in df.columns if c not in off])


def input_columns(df: DataFrame, exclude: Iterable[str] = ("user", "message_id")) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column as one row per column: column, low, high."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in columns
                   for n, f in (("low", F.min), ("high", F.max))])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_low").alias("low"),
                               F.col(f"{c}_high").alias("high")) for c in columns])
    return row.select(F.inline(pairs))


def scale_min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column to [0, 1]; a constant column becomes 0."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns)
                   for n, f in (("low", F.min), ("high", F.max))]).first()
    scaled = {}
    for i, c in enumerate(columns):
        low, high = row[f"low{i}"], row[f"high{i}"]
        scaled[c] = (F.col(c).cast("double") - F.lit(low)) / F.lit(high - low) if low is not None and high > low \
            else F.lit(0.0)
    return df.withColumns(scaled)
