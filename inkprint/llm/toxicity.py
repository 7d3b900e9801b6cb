"""Toxicity by a weighted finite-state pattern grammar.

Words become classes: insult (with a learned weight), harm, future, target, negation, report, quote mark, other. Small transducers over
classes (and the end of the clause) are composed into one, in this order:

1. ``negation``: within ``WINDOW`` words after a negation, an insult or harm word may pass as a negated one,
2. ``reported``: within ``REPORT_WINDOW`` words after a word of reporting or an opening quote mark, as a reported one,
3. ``target``: an insult or harm word with a person meant within ``WINDOW`` words before it, or after it, as an aimed one,
4. ``threat``: harm counts if a future word stands within ``WINDOW`` words before it; else it is free of weight,
5. ``judge``: what an insult or threat weighs that is plain, aimed, negated, reported or both; any of them may pass for nothing.

A clause is what stands between sentence marks and line breaks. Its weight is the best path of the composed machine through its classes, plus
the learned weights of its insults, where they count. The heaviest clause of a text and the sum of the others make its score, by a
logistic curve that is fitted on the labelled texts.

The insult lexicon is learned: words, and first or last 4 to 8 letters of words, that toxic training texts hold and others do not, by the
lower confidence bound of their log odds. ``max_docs`` bounds the texts of each label that are read for it.

Scale: training reads a bounded sample and ships its counts; the lexicon (at most ``max_terms`` terms) and the machine are broadcast.
Scoring is one scan without a shuffle. A task holds a batch of texts and at most ``KNOWN_WORDS`` classified words.

Defined cases: a null or empty text, or one without words, has no matches and the score of a text without them; without training rows
of both labels there is no lexicon, only threats match; rows with a null label or text are not learned; repeated rows are scored one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.llm.common import lists, query, table, texts_of, with_struct
from inkprint.session import materialize

WINDOW = 3
REPORT_WINDOW = 6
KNOWN_WORDS = 1 << 20
CEILING = 12.0  # of either sum of weights, for the curve
AFFIXES = range(4, 9)
OTHER, FUTURE, TARGET, NEGATION, REPORT, QUOTE, HARM, INSULT = range(8)
CLASSES = ["other", "future", "target", "negation", "report", "quote", "harm", "insult"]

# Words of the closed classes, in the languages of the tables
WORDS = {
    "future": "will shall gonna going 'll werde wird werden vais vas va allons allez voy vas vamos voi",
    "target": "you your yours yourself u ya they them their he him she her du dich dir dein deine ihr euch sie ihn tu te toi ton ta vous "
              "votre il elle eux tú tu ti te usted ustedes él ella ellos",
    "negation": "not no never n't isn't aren't wasn't don't doesn't didn't won't nobody hardly nicht kein keine nie niemals ne pas jamais aucun "
                "no nunca jamás ningún ni",
    "report": "said says say saying called calls call wrote writes quoted quote quotes told tells reported reports sagte sagt schrieb nannte dit "
              "disait écrit appelle dijo dice escribió llamó",
    "harm": "kill hurt beat destroy stab shoot murder strangle crush punch töten schlagen umbringen erschießen tuer frapper écraser matar "
            "golpear herir destruir",
}
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»„]")
_CLAUSE = re.compile(r"[.!?;\n\r]+")

_FIELDS = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()),
        T.StructField("weight", T.DoubleType())]))),
])


@dataclass
class Transducer:
    """States 0..n-1 (start 0); arcs[state][symbol] = [(output, weight, state)]. A symbol without an arc copies itself and
    follows ``rest[state]``. Every state is final."""

    arcs: list[dict[str, list[tuple[str, float, int]]]]
    rest: list[int]

    def step(self, state: int, symbol: str) -> list[tuple[str, float, int]]:
        return self.arcs[state].get(symbol) or [(symbol, 0.0, self.rest[state])]

    def compose(self, other: Transducer) -> Transducer:
        """What ``other`` makes of the output of this one; only states that can be reached."""
        symbols = {s for m in (self, other) for arcs in m.arcs for s, out in arcs.items() for s in (s, *(o for o, _, _ in out))} | {"other"}
        states, queue, arcs, rest = {(0, 0): 0}, [(0, 0)], [], []

        def number(pair):
            if pair not in states:
                states[pair] = len(states)
                queue.append(pair)
            return states[pair]

        for a, b in queue:
            made = {}
            for s in sorted(symbols):
                made[s] = [(z, w + v, number((p, q))) for y, w, p in self.step(a, s) for z, v, q in other.step(b, y)]
            arcs.append(made)
            rest.append(number((self.rest[a], other.rest[b])))
        return Transducer(arcs, rest)

    def paths(self, symbols: list[str]) -> list[tuple[float, list[str]]]:
        """Weight and output of every path. For tests; their number grows with the length."""
        found = [(0.0, [], 0)]
        for s in symbols:
            found = [(w + v, [*out, y], q) for w, out, p in found for y, v, q in self.step(p, s)]
        return [(w, out) for w, out, _ in found]

    def best(self, symbols: list[str], gains: list[float], counts) -> tuple[float, list[str]]:
        """The heaviest path; an output y of ``counts`` at place k also gains gains[k]. Ties go to the first path found."""
        paths = {0: (0.0, ())}
        for s, gain in zip(symbols, gains):
            after: dict[int, tuple[float, tuple]] = {}
            for state, (w, out) in paths.items():
                for y, v, q in self.step(state, s):
                    total = w + v + (gain if y in counts else 0.0)
                    if q not in after or total > after[q][0]:
                        after[q] = (total, (y, out))
            paths = after
        weight, chain = max(paths.values(), key=lambda x: x[0])
        out = []
        while chain:
            out.append(chain[0])
            chain = chain[1]
        return weight, out[::-1]


def _forms(symbol: str) -> list[str]:
    """The marks a core word can carry, in the order in which the machines set them."""
    return [symbol + a + b + c for a in ("", "-not") for b in ("", "-said") for c in ("", "-you")]


CORE = ("insult", "harm")


def _after(trigger: set[str], mark: str, window: int, symbols: list[str], resets: set[str] = frozenset()) -> Transducer:
    """Within ``window`` words after a trigger, the symbols pass with ``mark``; elsewhere as they are."""
    arcs = []
    for state in range(window + 1):
        down = max(0, state - 1)
        own = {t: [(t, 0.0, window)] for t in trigger} | {r: [(r, 0.0, 0)] for r in resets}
        own |= {s: [(s + mark if state else s, 0.0, down)] for s in symbols}
        arcs.append(own)
    return Transducer(arcs, [max(0, s - 1) for s in range(window + 1)])


def _aimed(window: int) -> Transducer:
    """A core word with a target before it is aimed; one may also be taken as aimed if a target follows within the window. A path
    that took one so in vain loses at the end of the clause."""
    cores = [s for c in CORE for s in _forms(c) if not s.endswith("-you")]
    # states: 0..w = words since a target (0: none), w+1..2w = a target has to follow in so many words, 2w+1 = it did not
    sink = 2 * window + 1
    arcs, rest = [], []
    for state in range(sink + 1):
        waiting = window < state < sink
        down = (state - 1 if state > window + 1 else sink) if waiting else max(0, state - 1) if state <= window else sink
        own = {"target": [("target", 0.0, window if state < sink else sink)]}
        for s in cores:
            if state == sink:
                own[s] = [(s, 0.0, sink)]
            elif waiting:
                own[s] = [(s, 0.0, down)]
            elif state:
                own[s] = [(s + "-you", 0.0, down)]
            else:
                own[s] = [(s, 0.0, 0), (s + "-you", -0.001, 2 * window)]
        if state > window:
            own["end"] = [("end", -100.0, sink)]
        arcs.append(own)
        rest.append(down)
    return Transducer(arcs, rest)


def _judge(weights: dict[str, float]) -> Transducer:
    """What a marked word weighs; it may also pass as ``pass`` for nothing. Harm words must have become threats."""
    arcs = {}
    for form in _forms("insult") + _forms("threat"):
        kind = form.split("-")[0]
        weight = weights[kind] + sum(weights[m] for m in form.split("-")[1:])
        arcs[form] = [("pass", 0.0, 0), (form, weight, 0)]
    arcs |= {form: [("pass", 0.0, 0)] for form in _forms("harm")}
    return Transducer([arcs], [0])


def _threat(window: int) -> Transducer:
    arcs = []
    for state in range(window + 1):
        down = max(0, state - 1)
        own = {"future": [("future", 0.0, window)]}
        own |= {f: [(f.replace("harm", "threat") if state else f, 0.0, down)] for f in _forms("harm")}
        arcs.append(own)
    return Transducer(arcs, [max(0, s - 1) for s in range(window + 1)])


# Weights of marks, in the unit of log odds
GRAMMAR = {"insult": 0.0, "threat": 3.0, "you": 1.0, "not": -6.0, "said": -1.5}


def grammar(weights: dict[str, float] = GRAMMAR) -> Transducer:
    """All machines composed."""
    words = list(CORE)
    machine = _after({"negation"}, "-not", WINDOW, words)
    machine = machine.compose(_after({"report", "quote"}, "-said", REPORT_WINDOW, [s + n for s in words for n in ("", "-not")]))
    return machine.compose(_aimed(WINDOW)).compose(_threat(WINDOW)).compose(_judge(weights))


@dataclass
class Model:
    terms: dict[str, float]  # "word", "pre*" or "*end" -> weight
    grammar: Transducer
    curve: tuple[float, float, float] = (1.0, 0.0, 0.0)  # of the heaviest clause, of the others' sum, and the constant
    closed: dict[str, int] = field(default_factory=lambda: {w: CLASSES.index(c) for c, ws in WORDS.items() for w in ws.split()})

    def classify(self, word: str) -> tuple[int, float]:
        """Class and weight of a word."""
        if not word[0].isalpha():
            return QUOTE, 0.0
        word = word.lower()
        found = [self.terms[t] for t in _terms(word) if t in self.terms]
        if found:
            return INSULT, max(found)
        return self.closed.get(word, NEGATION if word.endswith(("n't", "n’t")) else OTHER), 0.0


def _terms(word: str) -> list[str]:
    """A word and its beginnings and ends."""
    return [word, *(word[:n] + "*" for n in AFFIXES if n < len(word)), *("*" + word[-n:] for n in AFFIXES if n < len(word))]


_COUNTS = frozenset(f for f in _forms("insult"))  # what gains the learned weight


class Reader:
    """Matches of texts, with a memory of the words met."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def matches(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, kind, weight) of each clause that weighs something."""
        words = _WORD.findall(text)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        classes = list(map(known.get, words))
        if None in classes:
            for k, c in enumerate(classes):
                if c is None:
                    classes[k] = known[words[k]] = self.model.classify(words[k])
        if not classes or max(classes)[0] < HARM:
            return []
        found, at, spans = [], 0, list(_WORD.finditer(text))
        ends = [m.start() for m in _CLAUSE.finditer(text)] + [len(text)]
        for end in ends:
            start = at
            while at < len(spans) and spans[at].start() < end:
                at += 1
            if at == start or max(classes[start:at])[0] < HARM:
                continue
            clause = classes[start:at]
            weight, out = self.model.grammar.best([*(CLASSES[c] for c, _ in clause), "end"], [*(g for _, g in clause), 0.0], _COUNTS)
            kinds = sorted({y.split("-")[0] for y in out if y.split("-")[0] in ("insult", "threat")})
            if weight > 0 and kinds:
                found.append((spans[start].start(), spans[at - 1].end(), "+".join(kinds), weight))
        return found

    def features(self, texts: list[str]) -> tuple[list, np.ndarray]:
        """Matches, and (heaviest, all others together) of each text."""
        found = [self.matches(t) for t in texts]
        weights = [[m[3] for m in x] for x in found]
        return found, np.array([[max(w, default=0.0), sum(w) - max(w, default=0.0)] for w in weights]).reshape(-1, 2)


def _sample(docs: DataFrame, labels: DataFrame, text: str, label: str, key: str, max_docs: int) -> DataFrame:
    """label and text of about ``max_docs`` documents of each label at most. The chosen ids, so few, are broadcast."""
    rows = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label"), F.xxhash64(key).alias("draw")) \
        .where(F.col("label").isin(0, 1))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    share = [min(1.0, max_docs / max(1, sizes.get(k, 0))) for k in (0, 1)]
    limit = F.when(F.col("label") == 1, share[1]).otherwise(share[0]) * (1 << 30)
    chosen = F.broadcast(rows.where(F.pmod("draw", F.lit(1 << 30)) < limit).select("__key", "label"))
    texts = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    return materialize(texts.join(chosen, "__key").select("label", "text"), "labelled")


def _count_terms(batches):
    """In how many texts of either label a term is; summed within a batch."""
    for batch in batches:
        seen = [Counter(), Counter()]
        for label, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            words = {w.lower() for w in _WORD.findall(text.decode(errors="replace"))}
            seen[label].update({t for w in words if w[0].isalpha() for t in _terms(w)})
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([seen[0][t] for t in terms], pa.int64()),
                                          pa.array([seen[1][t] for t in terms], pa.int64())], ["term", "clean", "toxic"])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id",
          max_docs: int = 10_000, least: int = 5, bound: float = 1.5, max_terms: int = 100_000) -> Model:
    """A model of the documents that ``labels`` (key, label) names. A term enters the lexicon if at least ``least`` toxic texts hold it and
    the lower bound of its log odds against clean texts (two standard errors) is ``bound`` or more."""
    sample = _sample(docs, labels, text, label, key, max_docs)
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    model = Model({}, grammar())
    if not (n0 and n1):
        return model
    counts = sample.mapInArrow(_count_terms, "term string, clean long, toxic long").groupBy("term") \
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1))
    low = odds - 2 * F.sqrt(1 / a + 1 / b)
    chosen = counts.select("term", "toxic", odds.alias("odds"), low.alias("low")).where(F.col("low") >= bound) \
        .orderBy(F.desc("low"), "term").limit(max_terms).collect()
    model.terms = _generalised({r["term"]: float(r["odds"]) for r in chosen}, {r["term"]: r["toxic"] for r in chosen})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches):
        reader = Reader(shared.value)
        for batch in batches:
            _, x = reader.features([t.decode(errors="replace") for t in texts_of(batch.column(1))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_cell(x[:, 0])),
                                              pa.array(_cell(x[:, 1]))], ["label", "first", "others"])

    cells = sample.mapInArrow(features, "label int, first int, others int").groupBy("label", "first", "others").count().collect()
    model.curve = _fit([(r["first"], r["others"], r["label"], r["count"]) for r in cells])
    return model


def _generalised(odds: dict[str, float], texts: dict[str, int]) -> dict[str, float]:
    """The lexicon without affixes that only repeat one chosen word: an affix stays if it has more texts than each word it covers."""
    words = {w: n for w, n in texts.items() if "*" not in w}
    covers: Counter = Counter()
    for w, n in words.items():
        for t in _terms(w)[1:]:
            covers[t] = max(covers[t], n)
    return {t: x for t, x in odds.items() if "*" not in t or texts[t] > covers[t]}


def _cell(x: np.ndarray) -> np.ndarray:
    """Weights as cells of a half, at most ``CEILING``."""
    return np.round(np.minimum(x, CEILING) * 2).astype(np.int32)


def _fit(cells: list[tuple[int, int, int, int]], ridge: float = 1e-2, rounds: int = 50) -> tuple[float, float, float]:
    """Logistic curve over weighted cells; labels are drawn in from 0 and 1 by one text each, classes weigh alike."""
    x = np.array([[c[0] / 2, c[1] / 2, 1.0] for c in cells], dtype=float)
    y, n = np.array([c[2] for c in cells]), np.array([c[3] for c in cells], dtype=float)
    pos, neg = n[y == 1].sum(), n[y == 0].sum()
    goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = n / np.where(y == 1, pos, neg)
    beta = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (goal - p)) - ridge * beta
        beta = beta + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), gradient)
    return float(beta[0]), float(beta[1]), float(beta[2])


def detect(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """Every row of ``docs`` with a struct ``into``: score (0 to 1) and matches (start and end of the clause in characters, kind, weight)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        reader = Reader(shared.value)
        slope, others, constant = shared.value.curve

        def compute(texts):
            found, x = reader.features([t.decode(errors="replace") if t else "" for t in texts])
            x = np.minimum(x, CEILING)
            score = 1 / (1 + np.exp(-(x[:, 0] * slope + x[:, 1] * others + constant)))
            flat = [m for f in found for m in f]
            made = pa.StructArray.from_arrays([
                pa.array([m[0] for m in flat], pa.int32()), pa.array([m[1] for m in flat], pa.int32()),
                pa.array([m[2] for m in flat], pa.string()), pa.array([m[3] for m in flat], pa.float64())], ["start", "end", "kind", "weight"])
            return [pa.array(score, pa.float64()), lists(np.cumsum([0, *map(len, found)]), made)]
        return compute

    return with_struct(docs, text, into, _FIELDS, start, rows=2000)


@query("op12_toxicity")
def op12(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = table(spark, d, "labels").select("doc_id", "toxic").where(~held_out)
    model = train(docs, labels)
    found = F.col("toxicity")
    return detect(docs, model).select(
        "doc_id", held_out.alias("held_out"), found["score"].alias("score"),
        F.when(found["score"] >= 0.7, 1).otherwise(0).alias("predicted"), F.size(found["matches"]).alias("n_matches"))
