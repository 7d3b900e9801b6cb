"""Language-model scoring with a log-frequency Bloom filter.

The filter holds n-grams up to ``order`` words with quantised counts: a count c is stored as level
1 + floor(log(c) / log(base)), by inserting the n-gram once with each number up to its level. A reader
probes (n-gram, 1), (n-gram, 2), ... until one is missing, and takes the count of the last level.
Probabilities are smoothed towards the next shorter history: p = (c(history, word) + strength * lower) /
(c(history) + strength), and the lowest order is (c(word) + 1) / (N + V + 1). The base score uses exact counts.

Scale: training counts n-grams inside tasks, ships packed blocks of them by hash range ("part"), and sums
each part in one task; only the finished bits come to the driver, at most ``max_bytes``, which is what is
broadcast. If more n-grams exist than fit at ``bits_per_item``, the lowest levels are left out of the filter,
so that its error rate does not depend on the input, and looked up: what the filter does not hold at a
level it covers is gathered, each n-gram once for a block of rows, and its level is read from the written table, part by
part, so that no count is lost at any size.

The exact counts of words are never cut either. The at most ``head_words`` most frequent words are broadcast (64
bytes a word at most; longer words are counted by their SHA-256), the others are joined. A joined word is rarer
than all broadcast ones, so no key of that join is hot.

Defined cases: a null or empty text has one token, its end; without training rows all counts are 0;
repeated rows are scored one by one; a task holds about ``GROUP_BYTES`` of text, or its longest text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.llm.common import groups, held_out, lists, mix64, query, table, texts_of, with_struct
from inkprint.session import materialize

GROUP_BYTES = 2 << 20
FLUSH_WORDS = 200_000
FLUSH_GRAMS = 2_000_000
HEAD_LEVEL = 1.25  # the head of the vocabulary is cut at a power of this count
PROBES = 4
END = b""  # no word is empty
_BEGIN = np.uint64(0x5851F42D4C957F2D)
_SPACES = bytes(0x20 if 9 <= c <= 13 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_LONGEST = 64


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words; one that is longer than 64 bytes is replaced by its digest."""
    if not text:
        return []
    words = text.translate(_SPACES).split(b" ")
    return [w if len(w) <= _LONGEST else b"\0" + hashlib.sha256(w).digest() for w in words if w]


def _groups(texts, size: int = GROUP_BYTES):
    """Lists of the words of consecutive texts, of bounded size."""
    group, held = [], 0
    for t in texts:
        group.append(words_of(t))
        held += len(t or b"")
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def _batch_groups(batch, rows: int = 500):
    """The groups of a batch whose first column is the text, without a copy of the whole batch."""
    for at in range(0, batch.num_rows, rows):
        yield from _groups(texts_of(batch.column(0).slice(at, rows)))
    pa.default_memory_pool().release_unused()


class _Tokens:
    """The texts of a group as one sequence: begin, words, end; and the hashes of its n-grams."""

    def __init__(self, group: list[list[bytes]], order: int):
        flat = [w for words in group for w in (None, *words, END)]
        code: dict = {}
        codes = np.fromiter((code.setdefault(w, len(code)) for w in flat), np.int64, len(flat))
        hashes = np.fromiter((int(_BEGIN) if w is None else xxhash.xxh64_intdigest(w) for w in code), np.uint64, len(code))
        sizes = np.array([len(words) + 2 for words in group], dtype=np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.at = np.arange(len(flat)) - np.repeat(self.first, sizes)  # place in its text; 0 is the begin
        self.codes, self.words, self.vocabulary = codes, mix64(hashes), list(code)
        grams = self.words[codes]
        self.grams = [grams]
        wide = hashes[codes]
        for n in range(2, order + 1):
            longer = np.zeros_like(grams)
            longer[1:] = mix64(grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + wide[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
                               + np.uint64(n))
            grams = longer
            self.grams.append(grams)

    def all(self) -> np.ndarray:
        return np.concatenate([g[self.at >= n] for n, g in enumerate(self.grams)])


@dataclass
class Filter:
    """The bits of all parts one after another, ``part_bits`` each; part = the first bits of the hash."""

    bits: np.ndarray
    part_shift: int
    part_bits: int
    levels: int
    values: np.ndarray  # the count that a level stands for
    lowest: int

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Estimated counts, never below the stored level; 0 for what is not stored."""
        return self.values[self.level(grams)]

    def level(self, grams: np.ndarray) -> np.ndarray:
        level = np.zeros(len(grams), dtype=np.int64)
        alive = np.arange(len(grams))
        for q in range(1, self.levels + 1):
            alive = alive[self._has(grams[alive], q)]
            if not len(alive):
                break
            level[alive] = q
        return level

    def _has(self, grams: np.ndarray, q: int) -> np.ndarray:
        """Probe by probe, each only for what the probes before it have found."""
        alive, x = np.arange(len(grams)), _spread(grams, q)
        part = (grams >> np.uint64(self.part_shift)).astype(np.int64) * self.part_bits
        for i in range(PROBES):
            at = part + _probe(x, i, self.part_bits)
            hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            alive, x, part = alive[hit], x[hit], part[hit]
        found = np.zeros(len(grams), dtype=bool)
        found[alive] = True
        return found


def _spread(grams: np.ndarray, q: int) -> np.ndarray:
    """64 bits for (n-gram, level)."""
    return mix64(grams + np.uint64(q * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))


def _probe(x: np.ndarray, i: int, part_bits: int) -> np.ndarray:
    """The i-th place inside the part."""
    a, b = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32) | np.uint64(1)
    return (((a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF)) * np.uint64(part_bits) >> np.uint64(32)).astype(np.int64)


@dataclass
class Model:
    tokens: int
    distinct: int
    counts: DataFrame  # word, n: exact, all words
    head: dict[bytes, int]
    head_level: int
    ngrams: Filter
    order: int
    strength: float
    stored: DataFrame  # part, grams, levels: all n-grams, by hash


def _count_words(batches):
    seen: Counter = Counter()
    for batch in batches:
        for group in _batch_groups(batch):
            for words in group:
                seen.update(words)
            seen[END] += len(group)
            if len(seen) > FLUSH_WORDS:
                yield _word_rows(seen)
                seen = Counter()
    yield _word_rows(seen)


def _word_rows(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                      ["word", "n"])


def _level(n, base: float):
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(base)) + 1e-9)


def _count_grams(order: int, part_shift: int):
    def pack(found: list[np.ndarray]) -> pa.RecordBatch:
        grams, n = np.unique(np.concatenate(found), return_counts=True)
        part = (grams >> np.uint64(part_shift)).astype(np.int32)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        last = np.append(first[1:], len(grams))
        return pa.RecordBatch.from_arrays([
            pa.array(part[first]), pa.array([grams[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
            pa.array([n[a:b].astype(np.uint32).tobytes() for a, b in zip(first, last)], pa.binary())], ["part", "grams", "n"])

    def run(batches):
        found, held = [], 0
        for batch in batches:
            for group in _batch_groups(batch):
                found.append(_Tokens(group, order).all())
                held += len(found[-1])
                if held >= FLUSH_GRAMS:
                    yield pack(found)
                    found, held = [], 0
        if held:
            yield pack(found)
    return run


def _sum_grams(base: float):
    def run(batches):
        parts: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for part, grams, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                parts.setdefault(part, []).append((grams, n))
        for part in list(parts):
            blocks = parts.pop(part)
            grams = np.concatenate([np.frombuffer(g, np.uint64) for g, _ in blocks])
            n = np.concatenate([np.frombuffer(c, np.uint32) for _, c in blocks]).astype(np.float64)
            order = np.argsort(grams, kind="stable")
            grams, n = grams[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            level = (1 + np.floor(np.log(np.add.reduceat(n, first)) / np.log(base) + 1e-9)).astype(np.uint8)
            seen = np.bincount(level, minlength=256).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([grams[first].tobytes()], pa.binary()),
                pa.array([level.tobytes()], pa.binary()), pa.array([seen.tolist()], pa.list_(pa.int64()))],
                ["part", "grams", "levels", "seen"])
    return run


def _set_bits(part_bits: int, lowest: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                grams = np.frombuffer(batch.column(1)[k].as_buffer(), np.uint64)
                level = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint8)
                bits = np.zeros(part_bits, dtype=np.uint8)
                grams, level = grams[level >= lowest], level[level >= lowest]
                for q in range(1, int(level.max(initial=0)) + 1):
                    x = _spread(grams[level >= q], q)
                    for i in range(PROBES):
                        bits[_probe(x, i, part_bits)] = 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array(
                    [np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])
    return run


def build_filter(texts: DataFrame, tokens: int, order: int, base: float, bits_per_item: float,
                 max_bytes: int) -> tuple[Filter, DataFrame]:
    """The filter over the n-grams of the one column of ``texts``, which has about ``tokens`` words, and the
    table (part, grams, levels) of all of them."""
    spark = texts.sparkSession
    part_log = max(10, int(np.ceil(np.log2(max(1, tokens * order * 9 / (16 << 20))))))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(tokens * order * 12 >> 26) + 1)
    blocks = texts.mapInArrow(_count_grams(order, 64 - part_log), "part int, grams binary, n binary")
    summed = materialize(blocks.repartition(partitions, "part").mapInArrow(
        _sum_grams(base), "part int, grams binary, levels binary, seen array<long>"), "ngrams")
    level = F.posexplode("seen").alias("level", "n")
    seen = {r["level"]: r["n"] for r in summed.select(level).groupBy("level").agg(F.sum("n").alias("n")).collect()}
    items, lowest = 0, 256
    for q in range(255, 0, -1):
        if (items + seen.get(q, 0) * q) * bits_per_item > max_bytes * 8:
            break
        items, lowest = items + seen.get(q, 0) * q, q
    part_bits = int(max(64, -(-items * bits_per_item // (1 << part_log) // 8 + 1) * 8))
    part_bits = min(part_bits, max(64, (max_bytes * 8 >> part_log) // 8 * 8))
    bits = np.zeros((1 << part_log) * part_bits // 8, dtype=np.uint8)
    for r in summed.select("part", "grams", "levels").mapInArrow(_set_bits(part_bits, lowest), "part int, bits binary").collect():
        bits[r["part"] * part_bits // 8:(r["part"] + 1) * part_bits // 8] = np.frombuffer(r["bits"], np.uint8)
    edges = base ** np.arange(257)
    ends = np.ceil(edges[1:] - 1e-6) - 1
    values = np.concatenate([[0.0], np.maximum(1.0, (np.ceil(edges[:-1] - 1e-6) + ends) / 2)])
    highest = max([q for q, n in seen.items() if n], default=0)
    return Filter(bits, 64 - part_log, part_bits, highest, values, lowest), summed.select("part", "grams", "levels")


def train(texts: DataFrame, text: str = "text", order: int = 2, strength: float = 100.0, base: float = 1.5,
          bits_per_item: float = 8.0, max_bytes: int = 64 << 20, head_words: int = 200_000) -> Model:
    """A model of all texts of the table."""
    rows = texts.select(F.col(text).cast("string").alias("text"))
    counts = materialize(rows.mapInArrow(_count_words, "word binary, n long").where("n > 0")
                         .groupBy("word").agg(F.sum("n").alias("n")), "words")
    levels = counts.withColumn("level", _level("n", HEAD_LEVEL).cast("int")).groupBy("level") \
        .agg(F.count("*").alias("words"), F.sum("n").alias("n")).orderBy("level").collect()
    tokens, distinct = sum(r["n"] for r in levels), sum(r["words"] for r in levels)
    held, cut = 0, 1 << 30
    for r in reversed(levels):
        held += r["words"]
        if held > head_words:
            break
        cut = r["level"]
    head_rows = counts.where(_level("n", HEAD_LEVEL) >= cut).toArrow()
    head = dict(zip(head_rows.column("word").to_pylist(), head_rows.column("n").to_pylist()))
    ngrams, stored = build_filter(rows, tokens, order, base, bits_per_item, max_bytes)
    return Model(tokens, distinct, counts, head, cut, ngrams, order, strength, stored)


_FIELDS = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_head", T.LongType()),
    T.StructField("head_sum", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("rest", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()),
                                                    T.StructField("n", T.IntegerType())]))),
])
_OPEN = T.StructType([  # of rows that wait for levels: their block, and what the block asks for (in its first row)
    *_FIELDS, T.StructField("block", T.LongType()), T.StructField("asked", T.BinaryType()),
    T.StructField("levels", T.BinaryType()), T.StructField("places", T.BinaryType())])


def _scores(group, ngrams: Filter, model: tuple[int, int, int, float], seen: dict, frequent: dict) -> np.ndarray:
    """``seen`` spares the probes of frequent words that the task has met before."""
    t = _Tokens(group, model[0])
    counts = np.fromiter((seen.get(w, -1.0) for w in t.vocabulary), np.float64, len(t.vocabulary))
    new = np.flatnonzero(counts < 0)
    counts[new] = ngrams.counts(t.words[new])
    seen.update((t.vocabulary[k], counts[k]) for k in new if t.vocabulary[k] in frequent)
    return _smoothed(counts[t.codes], lambda n, whole: ngrams.counts(t.grams[n - 1][whole]), t.at, t.first, model)


def _smoothed(shorter: np.ndarray, counts, at, first, model: tuple[int, int, int, float]) -> np.ndarray:
    """The score of each text, from the counts of its words and ``counts(n, which of them)`` of its n-grams."""
    order, tokens, distinct, strength = model
    p = (shorter + 1) / (tokens + distinct + 1)
    for n in range(2, order + 1):
        whole = at >= n - 1  # the history has n - 1 tokens
        history = np.concatenate([[0.0], shorter[:-1]])
        longer = np.zeros(len(p))
        longer[whole] = np.minimum(counts(n, whole), history[whole])
        p = np.where(whole, (longer + strength * p) / (history + strength), p)
        shorter = longer
    logs = np.log10(p)
    logs[at == 0] = 0.0  # the begin is not scored
    return np.add.reduceat(logs, first)


def _waiting(groups_of_words, ngrams: Filter, order: int):
    """The n-grams that the filter lacks, sorted, and for each text the levels of its n-grams (one order after another, 0
    where the filter lacks it) and the places of those in the sorted ones."""
    levels, missing = [], []
    for group in groups_of_words:
        t = _Tokens(group, order)
        found = np.stack([ngrams.level(t.words)[t.codes], *(ngrams.level(g) for g in t.grams[1:])])
        found[found < ngrams.lowest] = 0  # what is stored has at least the lowest level
        ask = (found == 0) & (t.at >= np.arange(order)[:, None])
        grams = np.stack(t.grams)
        for a, b in zip(t.first, np.append(t.first[1:], len(t.at))):
            levels.append(found[:, a:b].astype(np.uint8).tobytes())
            missing.append(grams[:, a:b][ask[:, a:b]])
    asked, places = np.unique(np.concatenate([np.zeros(0, np.uint64), *missing]), return_inverse=True)
    cuts = np.cumsum([len(m) for m in missing])[:-1] if missing else []
    return asked, levels, [p.astype(np.int32).tobytes() for p in np.split(places, cuts)][:len(levels)]


def _looked_up(scanned: DataFrame, model: Model) -> DataFrame:
    """__row and __score of the scanned rows whose n-grams were not all in the filter. The n-grams that a block of rows
    asks for go to the tables of their parts, and their levels back to the block; a task holds one part or one block."""
    shift, lowest, values = model.ngrams.part_shift, model.ngrams.lowest, model.ngrams.values
    sizes = (model.order, model.tokens, model.distinct, model.strength)
    partitions = int(scanned.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def asks(batches):
        for batch in batches:
            for block, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = np.frombuffer(asked, np.uint64)
                part = (grams >> np.uint64(shift)).astype(np.int32)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                last = np.append(first[1:], len(grams))
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[first]), pa.array(np.full(len(first), block)),
                    pa.array([grams[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
                    pa.array([b""] * len(first), pa.binary())], ["part", "block", "grams", "levels"])

    def answers(batches):
        held, grams, levels = None, None, None
        for batch in batches:
            parts, blocks, asked, known = (batch.column(k).to_pylist() for k in range(4))
            out = []
            for part, block, ask, level in zip(parts, blocks, asked, known):
                ask = np.frombuffer(ask, np.uint64)
                if block < 0:
                    held, grams, levels = part, ask, np.frombuffer(level, np.uint8)
                    continue
                found = np.zeros(len(ask), dtype=np.uint8)
                if held == part and len(grams):
                    at = np.minimum(np.searchsorted(grams, ask), len(grams) - 1)
                    found = np.where(grams[at] == ask, levels[at], 0).astype(np.uint8)
                out.append((part, block, found.tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array([b for _, b, _ in out], pa.int64()), pa.array([p for p, _, _ in out], pa.int64()),
                pa.array([f for _, _, f in out], pa.binary())], ["block", "row", "levels"])

    def finish(batches):
        for _, rows in groups(batches, 1):
            answer, texts = [], []
            for row, levels, places in zip(*(rows.column(k).to_pylist() for k in ("row", "levels", "places"))):
                if places is None:
                    answer.append((row, levels))
                else:
                    texts.append((row, levels, places))
            found = np.frombuffer(b"".join(x for _, x in sorted(answer)), np.uint8)  # in the order of the parts
            scores = []
            for _, levels, places in texts:
                level = np.frombuffer(levels, np.uint8).reshape(model_order, -1).copy()
                at = np.arange(level.shape[1])
                level[(level == 0) & (at >= np.arange(model_order)[:, None])] = found[np.frombuffer(places, np.int32)]
                scores.append(_smoothed(values[level[0]], lambda n, whole: values[level[n - 1][whole]], at, [0], sizes)[0])  # noqa: B023
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _, _ in texts], pa.int64()),
                                              pa.array(scores, pa.float64())], ["__row", "__score"])

    model_order = model.order
    c = F.col("__lm")
    asked = scanned.where(F.octet_length(c["asked"]) > 0).select(c["block"].alias("block"), c["asked"].alias("asked")) \
        .mapInArrow(asks, "part int, block long, grams binary, levels binary")
    stored = model.stored.select("part", F.lit(-1).cast("long").alias("block"), "grams", "levels")
    answered = stored.union(asked).repartition(partitions, "part").sortWithinPartitions("part", "block") \
        .mapInArrow(answers, "block long, row long, levels binary")
    rows = scanned.select(c["block"].alias("block"), F.col("__row").alias("row"), c["levels"].alias("levels"), c["places"].alias("places"))
    return answered.withColumn("places", F.lit(None).cast("binary")).union(rows).repartition(partitions, "block") \
        .sortWithinPartitions("block").mapInArrow(finish, "__row long, __score double")


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "lm") -> DataFrame:
    """Every row of ``docs`` with a struct ``into``: n_tokens, n_known, base_score (exact unigrams, one
    added to every count) and score (the smoothed model), both log10 of a probability.

    The rows are written once to the shared folder, without ``text``; words outside the
    broadcast head go through a join with the exact counts.
    """
    context = docs.sparkSession.sparkContext
    head: Broadcast = context.broadcast({w: float(np.log10(n + 1)) for w, n in model.head.items()})
    bits = context.broadcast(model.ngrams)
    sizes = (model.order, model.tokens, model.distinct, model.strength)
    order, waits = model.order, model.ngrams.lowest > 1  # some levels are not in the filter

    def start():
        logs, ngrams = head.value, bits.value
        log, seen = logs.get, {}
        blocks = count(TaskContext.get().partitionId() << 32)

        def compute(texts):
            held = []
            n_tokens, n_head, sums, scores, offsets, words, counts = [], [], [], [], [0], [], []
            for group in _groups(texts):
                for tokens in group:
                    found = list(map(log, tokens)) + [log(END)]
                    known = [x for x in found if x is not None]
                    n_tokens.append(len(found))
                    n_head.append(len(known))
                    sums.append(sum(known))
                    if len(known) < len(found):
                        rest = Counter(w for w, x in zip([*tokens, END], found) if x is None)
                        words += rest.keys()
                        counts += rest.values()
                    offsets.append(len(words))
                if waits:
                    held.append(group)
                else:
                    scores.append(_scores(group, ngrams, sizes, seen, logs))
            rest = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int32())], ["word", "n"])
            out = [pa.array(n_tokens, pa.int64()), pa.array(n_head, pa.int64()), pa.array(sums, pa.float64()),
                   pa.nulls(len(texts), pa.float64()) if waits else pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                   lists(np.array(offsets), rest)]
            if not waits:
                return out
            asked, levels, places = _waiting(held, ngrams, order)
            return [*out, pa.array([next(blocks)] * len(texts), pa.int64()),
                    pa.array([asked.tobytes(), *[None] * (len(texts) - 1)][:len(texts)], pa.binary()),
                    pa.array(levels, pa.binary()), pa.array(places, pa.binary())]
        return compute

    fields = _OPEN if waits else _FIELDS
    scanned = materialize(with_struct(docs, text, "__lm", fields, start, rows=500).drop(text)
                          .withColumn("__row", F.monotonically_increasing_id()), "scores")
    rest = scanned.select("__row", F.explode("__lm.rest").alias("w")).select("__row", "w.word", F.col("w.n").alias("times"))
    tail = model.counts.where(_level("n", HEAD_LEVEL) < model.head_level)
    log_sum = F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1))
    added = rest.join(tail, "word", "left").groupBy("__row").agg(
        log_sum.alias("__sum"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("__known"))
    c = F.col("__lm")
    norm = float(np.log10(model.tokens + model.distinct + 1))
    joined = scanned.join(added, "__row", "left")
    joined = joined.join(_looked_up(scanned, model), "__row", "left") if waits else joined.withColumn("__score", c["score"])
    return joined.withColumn(into, F.struct(
        c["n_tokens"].alias("n_tokens"), (c["n_head"] + F.coalesce("__known", F.lit(0))).alias("n_known"),
        (c["head_sum"] + F.coalesce("__sum", F.lit(0.0)) - c["n_tokens"] * norm).alias("base_score"),
        F.col("__score").alias("score"))).drop("__lm", "__row", "__sum", "__known", "__score")


@query("op10_lm_score")
def op10(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = train(docs.where(~held_out("doc_id", 7)))
    c = F.col("lm")
    return score(docs, model).select(
        "doc_id", held_out("doc_id", 7).alias("held_out"), c["n_tokens"].alias("n_tokens"), c["n_known"].alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), c["base_score"].alias("base_score"), c["score"].alias("score"))
