from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from inkprint.llm.alignment import Aligner, Tokenizers, _packed, _unpacked, _whole, align, alignment_counts, pieces_of

FILES = Tokenizers()
SCHEMA = "doc_id long, text string"
ODD = ["", " ", "  a", "a  ", "a ", "a\n b", "a \n\n  b\t c", "\n", "\t\tx", "é è  ñ", "日本語のテキスト 漢字", "🙂🙃 x🙂", "<|endoftext|> a<s></s><unk> b",
       "it's  we'll 'tis", "1234567890 12 3", "...... ----- ====", "a▁b c", "x y   z", "a  b", "\x00 a\x1c b", "a" * 300, "word " * 50,
       "ﬁ ½ Å", "a\u0085 b \u0085c", " 　x", "don't stop  now !!  ", "\r\n a \r b", "a\n\nb", "a.\nB\n", "a \nb", "\n\n", "a\n", "a \n", " \n", "x\n \ny", "x \n\n z\n "]


def corpus(size=60):
    rnd = random.Random(3)
    parts = [p for t in ODD for p in t.split(" ")] + ["the", "The", " ", "  ", "\n", "ing", "déjà", "naïve", "zz"]
    made = [rnd.choice(["", " "]).join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(size)]
    return [(k, t) for k, t in enumerate([*ODD, *made, *made[:9]])] + [(None, "again and again"), (900, None)]


@pytest.fixture(scope="module")
def tokenizers():
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(FILES.byte_bpe)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES.piece_bpe)


KNOWN = []


def plain(tokenizers, text):
    """(a, b, overlaps, group ends) of the whole text, by comparing every pair of tokens."""
    a, b = tokenizers
    KNOWN or KNOWN.append(Aligner(FILES))
    known = KNOWN[0]
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids if text else [], b.encode(text) if text else []
    bytes_a, bytes_b = [known.a_bytes[k] for k in ids_a], [known.b_bytes[k] for k in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], [], []
    ends_a, ends_b = [sum(map(len, bytes_a[:k + 1])) for k in range(len(ids_a))], [sum(map(len, bytes_b[:k + 1])) for k in range(len(ids_b))]
    shared = [(i, j) for i in range(len(ids_a)) for j in range(len(ids_b))
              if max(ends_a[i] - len(bytes_a[i]), ends_b[j] - len(bytes_b[j])) < min(ends_a[i], ends_b[j])]
    return ids_a, ids_b, shared, [(i + 1, ends_b.index(e) + 1) for i, e in enumerate(ends_a) if e in ends_b]


def expected(tokenizers, rows):
    found = [(k, *plain(tokenizers, t or "")) for k, t in rows]
    links, of_pair, best = {}, Counter(), defaultdict(int)
    for at, (_, a, b, _, groups) in enumerate(found):
        mine = []
        for (p, r), (q, s) in zip([(0, 0), *groups], groups):
            mine += [(x, y) for x in a[p:q] for y in b[r:s]]
        links[at] = mine
        of_pair.update(set(mine))
    for (x, _), n in of_pair.items():
        best[x] = max(best[x], n)
    out = []
    for at, (k, a, b, shared, groups) in enumerate(found):
        text = ";".join(",".join(map(str, a[p:q])) + "|" + ",".join(map(str, b[r:s])) for (p, r), (q, s) in zip([(0, 0), *groups], groups))
        out.append((k, len(a), len(b), len(groups), len(links[at]), len(shared), hashlib.sha256(text.encode()).hexdigest() if groups else "",
                    sum(of_pair[x] == best[x[0]] for x in links[at]), sum(of_pair[x] for x in links[at])))
    return sorted(out, key=str)


def test_pieces_do_not_change_the_tokens(tokenizers, sf_dir, spark):
    texts = [t for _, t in corpus() if t] + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    aligner = Aligner(FILES)
    a, b = tokenizers
    for t, codes in zip(texts, [__import__("numpy").array(c) for c in aligner.learn(texts)]):
        assert "".join(map(_whole, pieces_of(t))) == " " + t
        if not aligner.bad[codes].any():
            assert aligner.tokens_a.runs(codes).tolist() == a.encode(" " + t, add_special_tokens=False).ids
            assert aligner.tokens_b.runs(codes).tolist() == b.encode(t)
        else:
            assert "▁" in t


def test_overlaps_and_groups_equal_all_pairs(spark, tokenizers):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("alignment", F.lit("old")).withColumn("a", F.lit(1))
    got = align(df).collect()
    assert len(got) == len(rows)
    for r in got:
        a, b, shared, groups = plain(tokenizers, r["text"] or "")
        x = r["alignment"]
        assert (x["a"], x["b"]) == (a, b) and sorted(map(tuple, x["overlaps"])) == shared and list(map(tuple, x["groups"])) == groups


@pytest.mark.parametrize("head", [0, 40, 2_000_000])
def test_counts_equal_all_pairs(spark, tokenizers, head):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("n_a", F.lit("x")).withColumn("__row", F.lit(0))
    got = alignment_counts(df, ["doc_id"], head_pairs=head)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(tokenizers, rows)


def test_blocks_and_forgotten_pieces(spark, tokenizers, monkeypatch):
    from inkprint.llm import alignment
    monkeypatch.setattr(alignment, "GROUP_BYTES", 50)
    monkeypatch.setattr(alignment, "KNOWN_PIECES", 20)
    rows = corpus(20)
    texts = alignment._decoded([t.encode() if t else None for _, t in rows])
    numbers = [x for x in zip(*(a.to_pylist() for a in alignment._scan(FILES)(list(t.encode() if t else None for _, t in rows))[:6]))]
    want = {k: r for k, r in zip(range(len(rows)), [plain(tokenizers, t) for t in texts])}
    assert [n[0] for n in numbers] == [len(want[k][0]) for k in range(len(rows))]


def test_long_text_empty_table_and_packing(spark):
    long = "lorem ipsum dolor " * 60_000
    (row,) = alignment_counts(spark.createDataFrame([(1, long)], SCHEMA), ["doc_id"]).collect()
    assert row["n_groups"] == 3 * 60_000 + 1 and row["n_best"] == row["n_links"] == row["count_sum"] > 0
    assert alignment_counts(spark.createDataFrame([], SCHEMA), ["doc_id"]).count() == 0
    codes = __import__("numpy").array([0, 5, 70_000, 2**31 - 1])
    assert _unpacked(_packed(codes)).tolist() == codes.tolist() and _unpacked(_packed(codes[:0])).tolist() == []
