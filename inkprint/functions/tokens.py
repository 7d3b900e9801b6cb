"""Tokens of one text as an array of structs, and the features counted on it.

A message is one row, so its tokens stay in that row: nothing here shuffles, except
where a lexicon is too large to be written into the plan (see ``annotate``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.constants import FUNCTION_TAGS, POS_TAGS, SENTENCE_END, TAG_LEXICON, TOKEN_PATTERN
from inkprint.functions.rounding import let, round_binary
from inkprint.functions.text import MAX_INLINE_WORDS, col
from inkprint.operators.joins import lookup

BLOCKS = 4  # of messages that meet a lexicon, for each shuffle partition


def token_texts(m) -> Column:
    return F.regexp_extract_all(col(m), F.lit(TOKEN_PATTERN), F.lit(0))


def _char_class(text: Column) -> Column:
    """L, N, P, S or X by the first character; a token never mixes classes.

    Plain Latin letters are told by comparison, the rest by pattern.
    """
    latin = ((text >= "a") & (text < "{")) | ((text >= "A") & (text < "["))
    return (
        F.when(latin | text.rlike(r"\A\p{L}"), "L").when(text.rlike(r"\A\p{N}"), "N")
        .when(text.rlike(r"\A\p{P}"), "P").when(text.rlike(r"\A\p{S}"), "S").otherwise("X")
    )


def _tag(kind: Column, lemma: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    named = None
    for name, words in lexicon.items():
        hit = lemma.isin(*words)
        named = F.when(hit, name) if named is None else named.when(hit, name)
    rule = F.when(kind == "N", "NUM").when(kind == "P", "PUNCT").when(kind == "S", "SYM").otherwise("X")
    if named is None:
        return rule
    # one look into the whole lexicon spares most tokens the look into each of its parts
    listed = sorted({w for words in lexicon.values() for w in words})
    return F.when(lemma.isin(*listed), named).otherwise(rule)


def token_structs(m, lexicon: Mapping[str, Sequence[str]] | None = None) -> Column:
    """array<struct<text, lemma, pos, is_alpha, is_punct>> by rule and inline lexicon."""
    lexicon = TAG_LEXICON if lexicon is None else lexicon
    if sum(len(words) for words in lexicon.values()) > MAX_INLINE_WORDS:
        raise ValueError("pass a large lexicon as a table")
    classed = F.transform(token_texts(m), lambda t: F.struct(
        t.alias("text"), F.lower(t).alias("lemma"), _char_class(t).alias("kind")))
    return F.transform(classed, lambda t: F.struct(
        t["text"].alias("text"),
        t["lemma"].alias("lemma"),
        _tag(t["kind"], t["lemma"], lexicon).alias("pos"),
        (t["kind"] == "L").alias("is_alpha"),
        (t["kind"] == "P").alias("is_punct"),
    ))


def _sentence_starts(tokens: Column) -> Column:
    """Positions of tokens that open a sentence: the first, and those after an end mark."""
    ends = lambda t: t["text"].isin(*SENTENCE_END)
    return F.filter(tokens, lambda t, i: ~ends(t) & ((i == 0) | ends(F.get(tokens, i - 1))))


def annotate(df: DataFrame, text: str = "message", lemma_table: DataFrame | None = None,
             pos_table: DataFrame | None = None, key: str = "message_id", out: str = "tokens",
             lexicon: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Add the token array.

    ``lemma_table(text, lemma)`` and ``pos_table(text, pos)`` (lower-case text, unique) may
    be of any size. Messages are dealt into blocks by key, and only the different words of a
    block are joined with the lexicons; what they hold goes back to the block, whose tokens
    find it there. So a hot word is one row of a block. What crosses the network of all tokens
    is the text, twice, and the arrays of what was found. A block is held by one Python call.
    """
    if lemma_table is None and pos_table is None:
        return df.withColumn(out, token_structs(text, lexicon))
    if lemma_table is None or pos_table is None:
        known = pos_table if lemma_table is None else lemma_table
        lemma = F.lit(None).cast("string") if lemma_table is None else F.col("lemma")
        pos = F.lit(None).cast("string") if pos_table is None else F.col("pos")
        known = known.select("text", lemma.alias("_lemma"), pos.alias("_pos"))
    else:
        known = lemma_table.select("text", F.col("lemma").alias("_lemma")).join(
            pos_table.select("text", F.col("pos").alias("_pos")), "text", "full")
    count = BLOCKS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(count)).cast("int").alias("_block")
    # rows that share a key have their tokens merged; those without a key have none
    texts = df.where(F.col(key).isNotNull()).select(block, F.col(key).alias("_key"), F.col(text).alias("_text")) \
        .repartition("_block").groupBy("_block", "_key").agg(F.collect_list("_text").alias("_texts"))
    lowered = F.flatten(F.transform("_texts", lambda t: F.transform(token_texts(t), lambda w: F.lower(w))))
    asked = texts.select("_block", F.explode(lowered).alias("text")).distinct()
    found = asked.join(known, "text").select(F.col("_block").alias("_home"), "text", "_lemma", "_pos")
    several = T.ArrayType(T.StringType())
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("_texts", several),
                           T.StructField("_at", T.ArrayType(T.IntegerType())), T.StructField("_lemma", several),
                           T.StructField("_pos", several)])
    hits = texts.withColumn("_words", lowered).groupBy("_block").cogroup(found.groupBy("_home")).applyInArrow(
        _find(schema.names), schema)
    fields = ("text", "lemma", "pos", "is_alpha", "is_punct")

    def looked_up(t: Column, i: Column) -> dict[str, Column]:
        other = {"lemma": F.coalesce(F.get("_lemma", i), t["lemma"]), "pos": F.coalesce(F.get("_pos", i), t["pos"])}
        return {c: other.get(c, t[c]) for c in fields}

    def struct(token: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(name) for name, c in token.items()])

    def merged(tokens: Column) -> Column:
        places = F.coalesce("_at", F.transform(tokens, lambda t, i: i))
        whole = F.sort_array(F.transform(places, lambda at, i: let(F.get(tokens, at), lambda e: struct(
            {"_i": e["_i"], **looked_up(e["t"], i)}))))
        return F.transform(whole, lambda t: struct({c: t[c] for c in fields}))

    each = F.flatten(F.transform("_texts", lambda m: F.transform(token_structs(m, lexicon), lambda t, i: F.struct(
        i.alias("_i"), t.alias("t")))))
    single = F.transform(token_structs(F.get("_texts", F.lit(0)), lexicon), lambda t, i: struct(looked_up(t, i)))
    whole = F.when((F.size("_texts") > 1) | F.col("_at").isNotNull(), let(each, merged)).otherwise(single)
    empty = F.array().cast("array<struct<text:string,lemma:string,pos:string,is_alpha:boolean,is_punct:boolean>>")
    return df.join(hits, key, "left").withColumn(out, F.coalesce(whole, empty)).drop("_texts", "_at", "_lemma", "_pos")


def _find(names: list[str]):
    """For the messages of one block and what the lexicons hold of its words: lemma and tag of each token, null where no
    lexicon holds it. Where a lexicon holds a word several times its tokens are repeated, and ``_at`` tells their places."""
    def run(messages: pa.Table, found: pa.Table) -> pa.Table:
        words = messages.column("_words").combine_chunks()
        flat, ends = words.flatten(), np.cumsum(pc.list_value_length(words).to_numpy())
        found = found.sort_by("text")
        entries = pc.value_counts(found.column("text"))  # in the order of the rows
        times = entries.field("counts").to_numpy()
        entry = pc.fill_null(pc.index_in(flat, value_set=entries.field("values")), -1).to_numpy()
        n = np.append(times, 1)[entry]
        token = np.repeat(np.arange(len(flat)), n)
        entry = entry[token]
        nth = np.arange(len(token)) - (np.cumsum(n) - n)[token]
        take = pa.array(np.append(np.cumsum(times) - times, 0)[entry] + nth, mask=entry < 0)
        begin = np.concatenate([[0], ends[:-1]])
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])], pa.int32())

        def lists(values: pa.Array, kind: pa.DataType) -> pa.Array:
            values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
            return pa.ListArray.from_arrays(offsets, values.cast(kind)) if values.null_count < len(values) \
                else pa.nulls(len(words), pa.list_(kind))

        at = pa.array(token - np.repeat(begin, ends - begin)[token]) if len(token) > len(flat) else pa.nulls(len(token))
        return pa.Table.from_arrays([
            messages.column("_key"), messages.column("_texts").cast(pa.list_(pa.string())), lists(at, pa.int32()),
            *(lists(found.column(c).combine_chunks().take(take), pa.string()) for c in ("_lemma", "_pos"))], names)
    return run


def annotate_with(df: DataFrame, tagger, text: str = "message", out: str = "tokens") -> DataFrame:
    """Annotate by an installed tagger.

    ``tagger(list of texts)`` yields, per text, a list of dicts with the five token fields.
    It runs on Arrow batches in the Python workers.
    """
    token = T.StructType([
        T.StructField("text", T.StringType()), T.StructField("lemma", T.StringType()),
        T.StructField("pos", T.StringType()), T.StructField("is_alpha", T.BooleanType()),
        T.StructField("is_punct", T.BooleanType()),
    ])
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(token))])

    def run(batches):
        for batch in batches:
            batch[out] = list(tagger(batch[text].tolist()))
            yield batch

    return df.mapInPandas(run, schema)


def token_table(df: DataFrame, tokens: str = "tokens", key: str = "message_id") -> DataFrame:
    """One row per token: key, i, text, lemma, pos, is_alpha, is_punct, sent."""
    ends = lambda t: t["text"].isin(*SENTENCE_END)
    places = F.transform(tokens, lambda t, i: i)
    starts = F.filter(places, lambda i: ~ends(F.get(F.col(tokens), i)) & (
        (i == 0) | ends(F.get(F.col(tokens), i - 1))))
    # sentence k runs from its start (the first one from 0) to the next start
    bounds = F.concat(F.array(F.lit(0)), F.slice(starts, F.lit(2), F.lit(1 << 30)), F.array(F.size(tokens)))
    marked = df.select(key, tokens, bounds.alias("_bounds"))
    runs = F.transform(F.slice("_bounds", F.lit(1), F.size("_bounds") - 1), lambda b, k: F.array_repeat(
        k.cast("long"), F.get(F.col("_bounds"), k + 1) - b))
    pairs = F.arrays_zip(F.col(tokens).alias("t"), F.flatten(runs).alias("sent"))
    return marked.select(key, F.posexplode(pairs).alias("i", "p")).select(
        key, F.col("i").cast("long").alias("i"), "p.t.*", "p.sent")


def _count(tokens, keep) -> Column:
    return F.size(F.filter(tokens, keep))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def alpha_lemmas(tokens) -> Column:
    return F.transform(F.filter(col(tokens), lambda t: t["is_alpha"]), lambda t: t["lemma"])


def type_token_ratio(tokens) -> Column:
    """Distinct lemmas per lemma over alphabetic tokens."""
    return let(alpha_lemmas(tokens), lambda lemmas: _share(F.size(F.array_distinct(lemmas)), F.size(lemmas)))


def simpsons_index(tokens) -> Column:
    """Chance that two alphabetic tokens drawn without replacement share their lemma.

    On the sorted lemmas the k-th repetition of a lemma adds 2k equal ordered pairs.
    """
    start = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("pairs"))

    def step(acc, lemma):
        run = F.when(acc["last"] == lemma, acc["run"] + 1).otherwise(F.lit(0).cast("long"))
        return F.struct(lemma.alias("last"), run.alias("run"), (acc["pairs"] + run * 2).alias("pairs"))

    def index(lemmas):
        # n(n-1) divides as doubles: the product of two token counts is exact far beyond any row size
        n = F.size(lemmas).cast("double")
        pairs = F.aggregate(lemmas, start, step, lambda acc: acc["pairs"])
        return F.when(n <= 1, F.lit(0.0)).otherwise(pairs / (n * (n - 1)))

    return let(F.sort_array(alpha_lemmas(tokens)), index)


def vocabulary_share_inline(tokens, words: Sequence[str]) -> Column:
    """Share of alphabetic tokens found in a short word list, to two places."""
    alpha = _count(col(tokens), lambda t: t["is_alpha"])
    known = _count(col(tokens), lambda t: t["is_alpha"] & F.lower(t["text"]).isin(*words)) if words else F.lit(0)
    return round_binary(_share(known, alpha))


def _known_share(words: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, _share): share of the words (key, _words array) that are known.

    The arrays are partitioned by message before they are spread out, so counting the
    distinct words of a message and adding up their hits need no exchange of their own.
    """
    # outer, as the filter Spark infers from a plain explode would tokenise every text once more
    each = words.repartition(F.col(key)).select(key, F.explode_outer("_words").alias("word"))
    each = each.filter(F.col("word").isNotNull())
    counts = each.groupBy(key, "word").agg(F.count("*").alias("_n"))
    flagged = lookup(counts, known.select("word").distinct().withColumn("_known", F.lit(1)), "word")
    hits = F.sum(F.when(F.col("_known") == 1, F.col("_n")).otherwise(0))
    return flagged.groupBy(key).agg((hits / F.sum("_n")).alias("_share"))


def vocabulary_share(df: DataFrame, vocabulary: DataFrame, out: str, tokens: str = "tokens",
                     key: str = "message_id") -> DataFrame:
    """Share of alphabetic tokens whose lower-case text is in ``vocabulary(word)``, of any size."""
    lower = F.transform(F.filter(tokens, lambda t: t["is_alpha"]), lambda t: F.lower(t["text"]))
    shares = _known_share(df.select(key, lower.alias("_words")), vocabulary, key)
    return df.join(shares, key, "left").withColumn(
        out, F.coalesce(round_binary(F.col("_share")), F.lit(0.0))).drop("_share")


def common_share_inline(tokens, words: Sequence[str]) -> Column:
    """Share of all lemmas, punctuation included, found in a short list; case-sensitive."""
    hits = _count(col(tokens), lambda t: t["lemma"].isin(*words)) if words else F.lit(0)
    return _share(hits, F.size(col(tokens)))


def common_share(df: DataFrame, words: DataFrame, out: str = "common_words", tokens: str = "tokens",
                 key: str = "message_id") -> DataFrame:
    """Same for a word list of any size."""
    lemmas = F.transform(tokens, lambda t: t["lemma"])
    shares = _known_share(df.select(key, lemmas.alias("_words")), words, key)
    return df.join(shares, key, "left").withColumn(out, F.coalesce("_share", F.lit(0.0))).drop("_share")


def pos_shares(tokens) -> Column:
    """Share of each tag among all tokens, to two places, as an array in tag order.

    The tags of a message become one text, in which each tag is counted by taking it out:
    far cheaper than one pass over the structs per tag.
    """
    joined = F.concat(F.lit(","), F.array_join(F.transform(col(tokens), lambda t: t["pos"]), ",,"), F.lit(","))
    total = F.size(col(tokens))

    def share(tags: Column, tag: str) -> Column:
        taken = F.length(tags) - F.length(F.replace(tags, F.lit(f",{tag},"), F.lit("")))
        return F.coalesce(round_binary(taken / F.lit(len(tag) + 2) / F.nullif(total, F.lit(0))), F.lit(0.0))

    return let(joined, lambda tags: F.array(*[share(tags, tag) for tag in POS_TAGS]))


def add_pos_shares(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One column per tag."""
    shared = df.withColumn("_shares", pos_shares(tokens))
    return shared.select(*df.columns, *[F.get("_shares", F.lit(i)).alias(tag) for i, tag in enumerate(POS_TAGS)])


def first_word_type(tokens) -> Column:
    """Index of the first token's tag, -1 without tokens."""
    tags = F.array(*[F.lit(tag) for tag in POS_TAGS])
    first = F.get(col(tokens), F.lit(0))["pos"]
    return F.coalesce(F.array_position(tags, first) - 1, F.lit(-1)).cast("long")


def readability(tokens) -> Column:
    """Gulpease index; 100 without words."""
    sentences = F.greatest(F.size(_sentence_starts(col(tokens))), F.lit(1))

    def index(words):
        letters = F.aggregate(words, F.lit(0).cast("long"), lambda acc, t: acc + F.length(t["text"]))
        n = F.size(words)
        return F.when(n == 0, F.lit(100.0)).otherwise(F.lit(89.0) + (sentences * 300 - letters * 10) / n)

    return let(F.filter(col(tokens), lambda t: ~t["is_punct"]), index)


def functional_share(tokens) -> Column:
    """Function-word tags per token that is not punctuation."""
    words = _count(col(tokens), lambda t: ~t["is_punct"])
    return _share(_count(col(tokens), lambda t: t["pos"].isin(*FUNCTION_TAGS)), words)


def cue_counts(tokens, cues: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    def count(words: Sequence[str]) -> Column:
        return _count(col(tokens), lambda t: t["lemma"].isin(*words))

    return {name: count(words) for name, words in cues.items()}


def cue_class(tokens, cues: Mapping[str, Sequence[str]], ids: Mapping[str, int]) -> Column:
    """Class with most cue words; the lowest id wins ties and empty texts."""
    counts = cue_counts(tokens, cues)
    ordered = [counts[name] for name, _ in sorted(ids.items(), key=lambda item: item[1])]
    scores = F.array(*ordered)
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("long")
