"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, one scan of the texts.

Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. The automaton
reads word numbers, not characters: its patterns are the windows of ``window`` consecutive item
words (a shorter item is one window of its own length), so every match begins and ends at words and
maps back to the characters of the original text.

Scale: the texts are scanned where they lie, without a shuffle. The automaton is broadcast; its size
is bounded by ``shard_bytes`` of item text. More item text is dealt over several automata, which
pass over the texts one after another; each pass is written to the shared folder before the next.

Defined cases: a null or empty text has no words and no hits; items without text or without words
have no windows; an item with a null id counts for the hit words, but has no name among the items; equal items all count; repeated rows are judged one by one; without items
nothing is contaminated; no row is dropped.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.llm.common import lists, query, table, with_struct
from inkprint.session import materialize

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_NORMAL = bytes(c if c in _WORD_BYTES else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()),
                                                    T.StructField("last", T.IntegerType())]))),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                     T.StructField("end", T.IntegerType())]))),
])
_PAIR = {"runs": ("first", "last"), "spans": ("start", "end")}


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


def _automaton(items: list[tuple[str | None, bytes | None]], window: int):
    """Word numbers, and the automaton over them: each pattern carries (its length, its items)."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            names = owners.setdefault(tuple(ids[at:at + window]), set())
            if item is not None:
                names.add(item)
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for pattern, names in owners.items():
        machine.add_word(pattern, (len(pattern), tuple(names)))
    if owners:
        machine.make_automaton()
    return numbers, machine if owners else None


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The character offsets, in the original text, of runs of words."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [(len(text[:at[a][0]].decode()), len(text[:at[b][1]].decode())) for a, b in runs]


def _scan(docs: DataFrame, text: str, into: str, items: list[tuple[str | None, bytes | None]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def start():
        numbers, machine = _automaton(shared.value, window)
        number = numbers.get

        def compute(texts):
            n_words, n_hit, found, runs, spans = [], [], [], [], []
            for t in texts:
                words = words_of(t)
                hits, names = [], set()
                if machine is not None and words:
                    for end, (length, owners) in machine.iter(tuple(map(number, words, repeat(0)))):
                        hits.append((end - length + 1, end))
                        names.update(owners)
                merged = _merge(hits) if hits else []
                n_words.append(len(words))
                n_hit.append(sum(b - a + 1 for a, b in merged))
                found.append(sorted(names))
                runs.append(merged)
                spans.append(_characters(t, merged) if merged else [])
            return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string())),
                    _pairs(runs, "runs"), _pairs(spans, "spans")]
        return compute

    return with_struct(docs, text, into, _FIELDS, start)


def _pairs(rows: list[list[tuple[int, int]]], name: str) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.array([p for r in rows for p in r], dtype=np.int32).reshape(-1, 2)
    values = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], list(_PAIR[name]))
    return lists(offsets, values)


def _joined(a, b):
    """Two lists of disjoint runs as one."""
    both = F.array_sort(F.concat(a, b))
    empty = F.expr("cast(array() as array<struct<first:int,last:int>>)")
    return F.aggregate(both, empty, lambda acc, r: F.when(
        (F.size(acc) > 0) & (r["first"] <= F.element_at(acc, -1)["last"] + 1),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["first"].alias("first"),
            F.greatest(F.element_at(acc, -1)["last"], r["last"]).alias("last")))),
    ).otherwise(F.concat(acc, F.array(r))))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, into: str = "contamination",
                  shard_bytes: int = 8 << 20) -> DataFrame:
    """Every row of ``docs`` with a struct ``into``: n_words, n_hit, items (sorted as strings), runs
    (of hit words, first and last number) and spans (of characters, one list per automaton)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text")) \
        .where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(-(-total // shard_bytes)) or 1
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))
    out = docs
    for k in range(shards):
        rows = [(r["item"], bytes(r["text"])) for r in dealt.where(F.col("shard") == k).collect()]
        if not k:
            out = _scan(out, text, into, rows, window)
            continue
        both = _scan(materialize(out, "decontaminate"), text, "__next", rows, window)
        a, b = F.col(into), F.col("__next")
        both = both.withColumn("__runs", _joined(a["runs"], b["runs"]))
        out = both.withColumn(into, F.struct(
            a["n_words"].alias("n_words"),
            F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1).alias("n_hit"),
            F.array_sort(F.array_union(a["items"], b["items"])).alias("items"), F.col("__runs").alias("runs"),
            F.concat(a["spans"], b["spans"]).alias("spans"))).drop("__next", "__runs")
    return out


def contaminated(into: str = "contamination"):
    """Some word is hit, and at least one word in twenty."""
    c = F.col(into)
    return (c["n_hit"] > 0) & (c["n_hit"] * 20 >= c["n_words"])


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, i, win.n, item_id FROM grams JOIN win
        ON win.n = grams.n AND win.g = array_to_string(w[i:i + grams.n - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
owners AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
           FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)"""


@query("op9_decontaminate", _SQL)
def op9(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    c = F.col("contamination")
    return contamination(docs, table(spark, d, "benchmark")).select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))
