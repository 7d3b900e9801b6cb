from __future__ import annotations

import hashlib
import math
import random
import tracemalloc
from collections import Counter

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkprint.config import FeatureConfig
from inkprint.constants import POS_TAGS
from inkprint.functions import text as tx
from inkprint.functions import tokens as tk
from inkprint.functions.hashing import murmur3, murmur3_lists
from inkprint.functions.rounding import round_binary
from inkprint.operators import embed as em
from inkprint.operators import features as ft
from inkprint.operators.joins import lookup
from inkprint.sources.wordlists import build_vocabulary, load_wordlist

TEXTS = ["", "   ", "Hello World", "ÀÉ Ⅷ straße", "Ciao  ciao,\nCIAO! Come va? 3.14 € ok...", "one", "!!!",
         "the cat and the dog", "a b c\x1fd"]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "message_id long, message string")


def values(df, column):
    return [r[0] for r in df.orderBy("message_id").select(column).collect()]


def test_round_like_python(spark):
    rng = random.Random(1)
    numbers = [0.125, 2.675, 1.005, 0.375, 2.5, 0.0, 1 / 3, 0.285, 1.115] + [
        rng.randint(0, 4000) / rng.choice([8, 7, 200, 40, 1000, 3]) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = [tuple(r) for r in df.select("x", round_binary(F.col("x"))).collect()]
    assert all(round(x, 2) == y for x, y in got)


def test_plain_features(spark):
    df = frame(spark)
    assert values(df, tx.uppercase_count("message")) == [sum(c.isupper() for c in t) for t in TEXTS]
    assert values(df, tx.char_count("message")) == [len(t) for t in TEXTS]
    expected = [round(sum(map(len, t.split())) / len(t.split()), 2) if t.split() else 0 for t in TEXTS]
    assert values(df, tx.word_length("message")) == expected


def test_emoji_by_rule_and_by_table(spark):
    texts = ["\u2713 \u2610 \u2605", "\u00a9 \u203c \u2122 \u25b6\ufe0f \u3297", "1\ufe0f\u20e3 7 # *", "\U0001F1EE\U0001F1F9\U0001F1EB\U0001F1F7",
             "\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F",
             "\U0001F469\U0001F3FD\u200d\U0001F4BB\U0001F469", "\u2764\ufe0f\u200d\U0001F525 \u2764", "", None]
    df = frame(spark, texts)
    assert values(df, tx.emoji_count("message"))[:8] == [0, 5, 1, 2, 1, 2, 2, 0]
    assert values(df, tx.unique_emoji_count("message"))[:8] == [0, 5, 1, 2, 1, 2, 2, 0]
    table = ["\u2764\ufe0f", "\u2764\ufe0f\u200d\U0001F525", "\U0001F469", "\U0001F469\U0001F3FD", "\u2713"]
    assert values(df, tx.emoji_count("message", table))[:8] == [1, 0, 0, 0, 0, 2, 2, 0]
    assert values(df, tx.unique_emoji_count("message", table))[:8] == [1, 0, 0, 0, 0, 2, 2, 0]
    assert values(df, tx.emoji_count("message", []))[:8] == [0] * 8


def test_emoji(spark):
    texts = ["none", "😀😀 👍🏽", "👩‍💻 🇮🇹🇮🇹", "1️⃣ ❤️ 5"]
    df = frame(spark, texts)
    assert values(df, tx.emoji_count("message")) == [0, 3, 3, 2]
    assert values(df, tx.unique_emoji_count("message")) == [0, 2, 2, 2]


def test_swear_words(spark):
    df = frame(spark, ["Damn DAMN dam damned", "what the hell, hell", "perché è così perché", "a+b a+b"])
    words = ["damn", "hell", "what the hell", "perché", "a+b"]
    assert values(df, tx.swear_count("message", words)) == [3, 2, 2, 2]
    assert values(df, tx.swear_count("message", [])) == [0, 0, 0, 0]


def test_token_features(spark):
    df = tk.annotate(frame(spark))
    lemmas = [[t["lemma"] for t in row if t["is_alpha"]] for row in values(df, "tokens")]
    assert lemmas[4] == ["ciao", "ciao", "ciao", "come", "va", "ok"]
    ttr = [len(set(x)) / len(x) if x else 0 for x in lemmas]
    assert values(df, tk.type_token_ratio("tokens")) == ttr

    def simpson(x):
        n = len(x)
        return sum(c * (c - 1) for c in Counter(x).values()) / (n * (n - 1)) if n > 1 else 0

    assert values(df, tk.simpsons_index("tokens")) == [simpson(x) for x in lemmas]
    assert values(df, tk.first_word_type("tokens"))[:2] == [-1, -1]
    assert values(df, tk.first_word_type("tokens"))[6] == POS_TAGS.index("PUNCT")
    read = values(df, tk.readability("tokens"))
    assert read[0] == 100 and read[6] == 100 and read[5] == 89 + (300 - 30) / 1
    assert values(df, tk.functional_share("tokens"))[7] == 2 / 5
    shares = tk.add_pos_shares(df).orderBy("message_id").collect()
    assert (shares[7]["DET"], shares[7]["CCONJ"], shares[7]["X"]) == (0.4, 0.2, 0.4)
    assert all(shares[0][t] == 0 for t in POS_TAGS)


def test_token_table_sentences(spark):
    df = frame(spark, ["...Hi. You? 3.14 ok", "..."])
    got = tk.token_table(tk.annotate(df)).orderBy("message_id", "i").collect()
    assert [r.sent for r in got if r.message_id == 0] == [0, 0, 0, 0, 0, 1, 1, 2, 2]
    assert [r.sent for r in got if r.message_id == 1] == [0, 0, 0]


def test_lexicon_tables_equal_inline_lexicon(spark):
    df = frame(spark)
    lemmas = spark.createDataFrame([("ciao", "CIAO*"), ("dog", "hound")], "text string, lemma string")
    tags = spark.createDataFrame([("cat", "NOUN"), ("!", "SYM")], "text string, pos string")
    got = values(tk.annotate(df, lemma_table=lemmas, pos_table=tags), "tokens")
    plain = values(tk.annotate(df), "tokens")
    assert [[t["text"] for t in x] for x in got] == [[t["text"] for t in x] for x in plain]
    assert [t["lemma"] for t in got[4]][:3] == ["CIAO*", "CIAO*", ","]
    assert {t["pos"] for t in got[6]} == {"SYM"} and got[7][1]["pos"] == "NOUN"


def test_lexicon_meets_words_of_blocks(spark, monkeypatch):
    # beyond a broadcast too no token crosses the network, and the lexicon is not copied by salts
    monkeypatch.setattr(tk, "lookup", lambda *args: lookup(*args, size=0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        texts = ["dog dog cat " * 50, "Cat! the dog"]
        tags = spark.createDataFrame([("cat", "NOUN"), ("!", "SYM"), ("dog", None)], "text string, pos string")
        out = tk.annotate(frame(spark, texts), pos_table=tags)
        got = values(out, "tokens")
        assert [[t["pos"] for t in x] for x in got] == [["X", "X", "NOUN"] * 50, ["NOUN", "SYM", "DET", "X"]]
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_salt" not in plan and "posexplode" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lexicon_tables_with_odd_keys(spark):
    rows = [(1, "Cat dog!"), (1, "dog runs"), (None, "cat"), (None, "cat"), (2, None), (3, ""), (4, "the cat"), (2, "CAT")]
    df = spark.createDataFrame([(k, n, t) for n, (k, t) in enumerate(rows)], "message_id long, row int, message string")
    lemmas = spark.createDataFrame([("cat", "felis"), ("cat", "gatto"), (None, "n")], "text string, lemma string")
    tags = spark.createDataFrame([("cat", "NOUN"), ("dog", None)], "text string, pos string")
    out = tk.annotate(df, lemma_table=lemmas, pos_table=tags)
    assert out.columns == ["message_id", "row", "message", "tokens"]
    got = [[(t["text"], t["lemma"], t["pos"]) for t in r["tokens"]] for r in out.orderBy("row").collect()]
    merged = [("Cat", "felis", "NOUN"), ("Cat", "gatto", "NOUN"), ("dog", "dog", "X"), ("dog", "dog", "X"),
              ("runs", "runs", "X"), ("!", "!", "PUNCT")]
    two = [("CAT", "felis", "NOUN"), ("CAT", "gatto", "NOUN")]
    four = [("the", "the", "DET"), ("cat", "felis", "NOUN"), ("cat", "gatto", "NOUN")]
    assert got == [merged, merged, [], [], two, [], four, two]
    nothing = [[t["pos"] for t in x] for x in values(tk.annotate(frame(spark), pos_table=tags.limit(0)), "tokens")]
    assert nothing == [[t["pos"] for t in x] for x in values(tk.annotate(frame(spark)), "tokens")]


def test_vocabulary_share_both_ways(spark):
    df = tk.annotate(frame(spark))
    words = ["ciao", "the", "cat", "one"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    inline = values(df, tk.vocabulary_share_inline("tokens", words))
    assert inline == values(tk.vocabulary_share(df, table, "share"), "share")
    assert inline[4] == 0.5 and inline[7] == 0.6 and inline[0] == 0
    inline = values(df, tk.common_share_inline("tokens", words))
    assert inline == values(tk.common_share(df, table, "share"), "share")


def test_murmur3_known_values():
    texts = pd.Series(["", "hello", "hello, world", "The quick brown fox jumps over the lazy dog"])
    assert [int(h) & 0xFFFFFFFF for h in murmur3(texts)] == [0, 0x248BFA47, 0x149BBB7F, 0x2E4FF723]


def _murmur3_plain(text: str) -> int:
    data, h, m = text.encode(), 0, 0xFFFFFFFF
    rotl = lambda x, r: ((x << r) | (x >> (32 - r))) & m
    for i in range(0, len(data), 4):
        k = rotl(int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
        h ^= k
        h = (rotl(h, 13) * 5 + 0xE6546B64) & m if i + 4 <= len(data) else h
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def test_murmur3_of_lists_in_bounded_memory():
    rnd = random.Random(4)
    lists = [["".join(rnd.choices("abcé😀", k=rnd.randint(0, 9))) for _ in range(rnd.randint(0, 5))] for _ in range(300)]
    lists = [*lists[:100], None, [], ["x" * 20_001], *lists[100:]]
    array = pa.array([["cut off"], *lists], pa.list_(pa.string())).slice(1)
    assert murmur3_lists(array).to_pylist() == [w and [h - (h >> 31 << 32) for h in map(_murmur3_plain, w)] if w else w for w in lists]
    words = pa.array([["w%d" % (k % 1000) for k in range(100)]] * 500 + [["x" * 100_000]], pa.list_(pa.string()))
    tracemalloc.start()
    murmur3_lists(words)  # padding each word to the longest one would take 5 GB
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


@pytest.mark.parametrize("hasher", ["xxhash64", "md5", "murmur3"])
def test_bag_of_words(spark, hasher):
    df = frame(spark, ["alpha beta alpha x", "", "beta", "straße perché perché"])
    bag = {r.message_id: r for r in ft.bag_of_words(df, hasher=hasher).collect()}
    assert set(bag) == {0, 2, 3}
    assert all(abs(math.fsum(v * v for v in r["values"]) - 1) < 1e-12 for r in bag.values())
    assert sorted(abs(round(v, 6)) for v in bag[0]["values"]) == [round(1 / math.sqrt(5), 6), round(2 / math.sqrt(5), 6)]
    assert ft.vocabulary_size(df).first().asDict() == {"n_words": 4, "width": 4}


def test_build_features(spark):
    table = ft.build_features(frame(spark), FeatureConfig.all_features())
    row = table.filter("message_id = 7").first()
    assert row["char_count"] == 19 and row["DET"] == 0.4 and row["bow"].size == 4096
    assert "responsiveness" not in table.columns and "message" not in table.columns
    none = ft.build_features(frame(spark), FeatureConfig.only())
    assert none.columns == ["message_id"]
    with pytest.raises(KeyError):
        ft.build_features(frame(spark).drop("message"))
    ft.register_feature("question_marks", lambda m: F.regexp_count(m, F.lit(r"\?")))
    extra = ft.build_features(frame(spark), FeatureConfig({"question_marks": True}))
    assert extra.filter("message_id = 4").first()["question_marks"] == 1


def test_select_and_scale(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0, 1.0), (2, 4.0, 5.0, 1.0)], ["message_id", "char_count", "X", "12"])
    kept = ft.select_features(df, FeatureConfig.only("char_count"))
    assert kept.columns == ["message_id", "char_count"]
    scaled = ft.scale_min_max(df, ["char_count", "X"]).orderBy("message_id").collect()
    assert [(r["char_count"], r["X"]) for r in scaled] == [(0.0, 0.0), (1.0, 0.0)]


def test_config_file(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text('{"char_count": true, "message_composition": false, "emotion": 0}')
    config = FeatureConfig.load(spark, str(path))
    assert config.enabled() == ["char_count"] and set(POS_TAGS) <= set(config.disabled_columns())
    with pytest.raises(ValueError):
        FeatureConfig.load(spark, str(tmp_path / "none.json"))


def test_word_lists(spark, tmp_path):
    (tmp_path / "words.txt").write_text("abc\nabd\nabc\n")
    got = {r.word for r in load_wordlist(spark, str(tmp_path / "words.txt"), clipped=True).collect()}
    assert got == {"abc", "abd", "ab"}
    vocabulary = build_vocabulary(frame(spark, ["a b b", "B c", "x"]), min_docs=2)
    assert [tuple(r) for r in vocabulary.collect()] == [("b", 2)]


def test_embeddings(spark):
    df = frame(spark, ["one two two", "", "two"])
    mean = {r.message_id: r.embedding for r in em.embed_hashed(df, "mean", dims=16).collect()}
    cls = {r.message_id: r.embedding for r in em.embed_hashed(df, "cls", dims=16).collect()}
    mixed = {r.message_id: r.embedding for r in em.embed_hashed(df, "mixed", dims=16).collect()}
    assert mean[1] == [0.0] * 16 and mixed[0] == cls[0] + mean[0]
    assert all(abs(m - (a + 2 * b) / 3) < 1e-9 for m, a, b in zip(mean[0], cls[0], mean[2]))
    with pytest.raises(ValueError):
        em.embed_hashed(df, "sum")
    vectors = [r.embedding for r in em.embed(df, dims=8).orderBy("message_id").collect()]
    assert all(abs(sum(x * x for x in v) - 1) < 1e-5 for v in vectors)
    wide = em.vector_to_columns(em.embed_hashed(df, "cls", dims=4), 4, "cls")
    assert wide.columns == ["message_id", "cls_embed_0", "cls_embed_1", "cls_embed_2", "cls_embed_3"]


def test_large_swear_list_counts_the_longest_entry(spark):
    words = [f"w{k}" for k in range(9000)] + ["bad", "bad word", "a.b"]
    df = spark.createDataFrame([("W8999 and w90000 bad word, BAD a.b axb",)], "message string")
    assert df.select(tx.swear_count("message", words)).first()[0] == 4
    assert df.select(tx.swear_count("message", [])).first()[0] == 0


def test_tagger_and_separate_vocabularies(spark):
    from inkprint.config import FeatureConfig
    from inkprint.operators.features import build_features

    def tagger(texts):
        for t in texts:
            yield [{"text": w, "lemma": w.lower(), "pos": "VERB" if w.endswith("s") else "NOUN", "is_alpha": True, "is_punct": False}
                   for w in t.split()]

    df = spark.createDataFrame([(1, "the dog runs")], "message_id long, message string")
    r = build_features(df, FeatureConfig.only("message_composition", "englishness", "italianness"), tagger=tagger).first()
    assert (r["NOUN"], r["VERB"], r["englishness"], r["italianness"]) == (0.67, 0.33, 0.33, 0.0)


def test_md5_vectors_hash_a_word_once(spark, monkeypatch):
    def sums(words, dims):
        digests = [b"".join(hashlib.md5(f"{w}:{part}".encode()).digest() for part in range(2))[:dims] for w in words]
        return [sum(d[i] for d in digests) for i in range(dims)]

    texts = [["b", "a", "b"], None, [], ["ß", "b"], ["a"]]
    batch = pa.RecordBatch.from_arrays([pa.array([3, 1, None, 3, 5]), pa.array(texts, pa.list_(pa.string()))], ["key", "words"])
    hashed = []
    monkeypatch.setattr(em, "md5", lambda data: hashed.append(data) or hashlib.md5(data))
    whole = [r for b in em._md5_sums(20)([batch]) for r in b.to_pylist()]
    assert sorted(hashed) == sorted(f"{w}:{part}".encode() for w in ("a", "b", "ß") for part in range(2))
    assert whole == [{"key": k, "one": len(t or []), "sums": sums(t or [], 20)} for k, t in zip([3, 1, None, 3, 5], texts)]
    monkeypatch.setattr(em, "TOKENS_AT_ONCE", 2)
    assert [r for b in em._md5_sums(20)([batch.slice(1)]) for r in b.to_pylist()] == whole[1:]
    df = spark.createDataFrame([(1, "One two, TWO"), (1, "two"), (2, ""), (None, "x"), (4, None)], "message_id long, message string")
    got = sorted((r.message_id, r.embedding) for r in em.embed_hashed(df, "mean", dims=20, hasher="md5").collect())
    both = [x / 5 / 127.5 - 1.0 for x in sums(["one", "two", ",", "two", "two"], 20)]
    assert got == [(1, both), (1, both), (2, [0.0] * 20), (4, [0.0] * 20)]
