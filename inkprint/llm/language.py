"""Language identification: script ranges narrow the candidates, Viterbi labels spans of words.

A word is a run of letters. Its score for a language is the sum, over its letters, of the smoothed
log probability of the letter with its two neighbours (a trigram, hashed into ``BUCKETS`` counts). The
script of a word rules out languages that hardly use that script in training. Viterbi then finds the
labels of all words of a text with the largest total, where every change of language costs
``penalty``; neighbouring words of one label form a span. A text gets the language with the most letters.

Scale: training reads a bounded sample, at most about ``max_docs`` labelled texts of each language;
its counts are summed by Spark, and what is broadcast is a table of BUCKETS x languages, with at most
``MAX_LANGUAGES`` languages. Prediction is one scan without a shuffle; the memory of a task is bounded
by ``GROUP_CHARS`` or its longest text.

Defined cases: a null text, an empty one or one without letters is ``und`` with score 0 and no spans;
without any training row every text is; ties go to the language that sorts first; repeated rows are
judged one by one; null languages are not learned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.llm.common import held_out, lists, query, table, texts_of, with_struct

BUCKETS = 1 << 15
MAX_LANGUAGES = 512
CHUNK_CHARS = 1 << 20  # letters scored at once, divided by the number of languages
GROUP_CHARS = 8 << 20  # texts labelled at once

# First code points of the blocks of a script (Unicode), up to the next entry
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"),
    (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"),
    (0x2000, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x2E80, "han"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"),
    (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x1B000, "kana"), (0x1B170, "other"),
    (0x20000, "han"), (0x323B0, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS], dtype=np.uint32)
_SCRIPT_OF = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], dtype=np.int32)
_WORST = np.float32(-30.0)  # what one word can count against a language at most

_FIELDS = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("lang", T.StringType())]))),
])
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """By code point: the lower-case code point, or 0 where it is no letter. Built once a worker."""
    if not _TABLES:
        lower = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        _TABLES.append(lower)
    return _TABLES


class _Words:
    """The words of some texts: where they lie, their script and their trigrams' buckets."""

    def __init__(self, texts: list[str]):
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        low = _tables()[0][points]
        letter = low > 0
        edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.base = np.concatenate([[0], np.cumsum(lengths)])  # of each text, in characters
        self.first = np.searchsorted(self.start, self.base)  # of each text, in words
        at = np.flatnonzero(letter)
        wide = low.astype(np.uint64)
        before, after = wide[np.maximum(at - 1, 0)], wide[np.minimum(at + 1, len(wide) - 1)]
        before[at == 0] = 0
        h = before * np.uint64(0x9E3779B97F4A7C15) + wide[at] * np.uint64(0xC2B2AE3D27D4EB4F) \
            + after * np.uint64(0x165667B19E3779F9)
        self.bucket = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int32)
        self.letters = np.concatenate([[0], np.cumsum(self.end - self.start)])  # of each word, into bucket
        self.script = _SCRIPT_OF[np.searchsorted(_STARTS, points[self.start], side="right") - 1]


def _chunks(texts: list[str], size: int):
    chunk, held = [], 0
    for t in texts:
        chunk.append(t)
        held += len(t) + 1
        if held >= size:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; ``first`` bounds the words of each text. All texts step together."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    starts, n = first[:-1][order], n[order]
    left = np.zeros(len(scores), dtype=np.int16)  # the label before, for words whose best path changes there
    stays = np.zeros(scores.shape, dtype=bool)
    best = np.zeros((len(n), scores.shape[1]), dtype=np.float32)
    longest = int(n[0]) if len(n) else 0
    alive = np.searchsorted(-n, -np.arange(longest), side="left")
    for t in range(longest):
        k = alive[t]
        at, now = starts[:k] + t, best[:k]
        if t:
            top = now.argmax(1)
            change = now[np.arange(k), top] - np.float32(penalty)
            stay = now >= change[:, None]
            left[at], stays[at] = top, stay
            now = np.where(stay, now, change[:, None])
        now = now + scores[at]
        best[:k] = now - now.max(1, keepdims=True)
    labels = np.zeros(len(scores), dtype=np.int16)
    label = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        at, now = starts[:k] + t, label[:k]
        labels[at] = now
        if t:
            label[:k] = np.where(stays[at, now], now, left[at])
    return labels


class Model:
    """Log probabilities of trigrams by language, and which languages a script may be."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray, penalty: float, smoothing: float = 0.5):
        self.languages, self.penalty = languages, penalty
        total = counts.sum(0, keepdims=True) + smoothing * BUCKETS
        self.logp = np.log((counts + smoothing) / total).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(0, keepdims=True), 1)
        may = share >= 0.01
        self.barred = np.where(may | ~may.any(1, keepdims=True), np.float32(0), _WORST)

    def label(self, texts: list[str]):
        """(lang, score, span offsets, span starts, span ends, span languages) of the texts."""
        names, scores, counts, firsts, ends, langs = [], [], [], [], [], []
        for group in _chunks(texts, GROUP_CHARS):
            parts = [self._score(c) for c in _chunks(group, max(1 << 16, CHUNK_CHARS * 4 // max(4, len(self.languages))))]
            start = np.concatenate([p[0] for p in parts])
            end = np.concatenate([p[1] for p in parts])
            n = np.concatenate([p[2] for p in parts])
            first = np.concatenate([[0], np.cumsum(n)])
            label = _viterbi(np.concatenate([p[3] for p in parts]), first, self.penalty)
            doc = np.repeat(np.arange(len(n)), n)
            letters = np.zeros((len(n), len(self.languages)))
            np.add.at(letters, (doc, label), end - start)
            total = letters.sum(1)
            top = letters.argmax(1)
            names += [self.languages[k] if s else "und" for k, s in zip(top, total)]
            scores.append(np.divide(letters.max(1), total, out=np.zeros(len(n)), where=total > 0))
            new = np.ones(len(label), dtype=bool)
            new[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(label)) - 1 if len(at) else at
            counts.append(np.bincount(doc[at], minlength=len(n)))
            firsts.append(start[at])
            ends.append(end[last])
            langs.append(label[at])
        empty = np.zeros(0, dtype=np.int64)
        joined = [np.concatenate(x) if x else empty for x in (scores, counts, firsts, ends, langs)]
        return names, joined[0], np.concatenate([[0], np.cumsum(joined[1])]), *joined[2:]

    def _score(self, texts: list[str]):
        words = _Words(texts)
        n = np.diff(words.first)
        base = np.repeat(words.base[:-1], n)
        if not len(base):
            return words.start, words.end, n, np.zeros((0, len(self.languages)), dtype=np.float32)
        scores = np.add.reduceat(self.logp[words.bucket], words.letters[:-1], axis=0)
        scores -= scores.max(1, keepdims=True)
        scores = np.maximum(scores, _WORST) + self.barred[words.script]
        return words.start - base, words.end - base, n, scores


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", max_docs: int = 4000,
          penalty: float = 12.0) -> Model:
    """A model of the languages of ``labelled``, from at most about ``max_docs`` texts of each.

    ``key`` only spreads the sample evenly; rows with a null language or text are not used.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
                           F.xxhash64(F.col(key)).alias("draw")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    if languages:
        share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, max_docs / sizes[name]))])
        sample = rows.where(F.pmod("draw", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).select("lang", "text")
        summed = sample.mapInArrow(_count_trigrams, "lang string, feature int, n long") \
            .groupBy("lang", "feature").agg(F.sum("n").alias("n"))
        at = {name: k for k, name in enumerate(languages)}
        for r in summed.toLocalIterator():
            counts[r["feature"], at[r["lang"]]] = r["n"]
    return Model(languages, counts[:BUCKETS], counts[BUCKETS:], penalty)


def _count_trigrams(batches):
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), [t.decode() for t in texts_of(batch.column(1))]
        for name in sorted(set(langs)):
            total = np.zeros(BUCKETS + len(SCRIPT_NAMES), dtype=np.int64)
            for chunk in _chunks([t for t, x in zip(texts, langs) if x == name], CHUNK_CHARS):
                words = _Words(chunk)
                total[:BUCKETS] += np.bincount(words.bucket, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(words.script, weights=words.end - words.start,
                                               minlength=len(SCRIPT_NAMES)).astype(np.int64)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()),
                                              pa.array(total[seen], pa.int64())], ["lang", "feature", "n"])


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """Every row of ``docs`` with a struct ``into``: lang, score (the share of the letters that have that
    label) and spans (start and end in characters, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value
        names = pa.array(known.languages, pa.string())

        def compute(texts):
            if not known.languages:
                nothing = lists(np.zeros(len(texts) + 1, dtype=np.int32), _spans([], [], pa.array([], pa.string())))
                return [pa.array(["und"] * len(texts)), pa.array([0.0] * len(texts)), nothing]
            lang, score, offsets, first, last, label = known.label([t.decode() if t else "" for t in texts])
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                    lists(offsets, _spans(first, last, names.take(pa.array(label.astype(np.int32)))))]
        return compute

    return with_struct(docs, text, into, _FIELDS, start, rows=2000)


def _spans(first, last, langs) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(last, pa.int32()), langs],
                                      ["start", "end", "lang"])


@query("op3_language_id")
def op3(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out("doc_id", 4)))
    found = F.col("language")
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 4).alias("held_out"), found["lang"].alias("lang_pred"),
        found["score"].alias("score"), F.size(found["spans"]).alias("n_spans"))
